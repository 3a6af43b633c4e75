"""Benchmark decontamination by latent semantic retrieval."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items of a benchmark that have a space of their own, and such blocks that a task
#: holds; more are further passes over the documents.
BLOCK, BLOCKS = 2_000, 10
#: Words between starts of passages, and steps that a passage is long. An item is
#: compared with the shortest passages that are not shorter than it. A longer one than
#: the longest is cut into parts of that length, which start every ``PART`` words.
STEP = 12
SIZES = (2, 3, 5)
PART = 30
#: Parts that passages are compared with at a time.
PARTS = 500
RANK, EXTRA = 32, 8
#: Words that are embedded at a time, which bounds the memory of a long text.
CHUNK = 1 << 16
#: Texts whose words a task holds at a time.
TEXTS = 500
#: A candidate passage points to an item at least so closely, and has at least this
#: share of the item's length in its direction.
LEAST_COSINE = 0.5
LEAST_LENGTH = 0.5
#: Share of an item's words that a text must have in order, and share of its rarest
#: words, the answer, that must be among them.
LEAST_COMMON = 0.6
LEAST_ANSWER = 0.5

_GAPS = bytes(x if 48 <= x < 58 or 97 <= x < 123 or x > 127 else 32 for x in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and characters beyond ASCII."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_GAPS).split()


@dataclass
class Items:
    """A block of benchmark items, numbers of their words, and of how many items each is.

    Items of the same words are one here, with the ids of all.
    """

    ids: list[list[int]]
    words: list[list[bytes]]
    vocabulary: dict[bytes, int]
    shares: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str | None]]) -> Items:
        held: dict[tuple[bytes, ...], dict[int, None]] = {}
        for i, text in rows:
            if words := tuple(words_of(text)):
                held.setdefault(words, {})[i] = None
        shares = Counter(w for words in held for w in set(words))
        every = sorted(shares)
        return cls(
            [list(ids) for ids in held.values()],
            [list(words) for words in held],
            {w: n for n, w in enumerate(every)},
            np.array([shares[w] for w in every], float),
        )

    def weights(self) -> np.ndarray:
        """By word, its rarity among the items, which no number of leaks changes.

        A word of all items still has some weight, so that every item has a direction.
        """
        return np.log1p(len(self.words) / self.shares)

    def parts(self) -> list[tuple[int, int, int]]:
        """(item, first word, end) of what passages are compared with."""
        most, out = SIZES[-1] * STEP, []
        for i, words in enumerate(self.words):
            last = max(0, len(words) - most)
            out += [(i, at, at + most) for at in range(0, last, PART)]
            out.append((i, last, len(words)))
        return out

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Each word's number; -1 for other words. Filled up to whole steps."""
        get = self.vocabulary.get
        out = np.full(max(-(-len(words) // STEP), SIZES[-1]) * STEP, -1, np.int32)
        out[: len(words)] = [get(w, -1) for w in words]
        return out


def _chunks(numbers: list[np.ndarray]) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """(text, first step, numbers), some texts at a time; long ones in overlapping parts."""
    held, size = [], 0
    steps, overlap = CHUNK // STEP * STEP, (SIZES[-1] - 1) * STEP
    for i, all_numbers in enumerate(numbers):
        for first in range(0, len(all_numbers), steps):
            part = all_numbers[first : first + steps + overlap]
            held.append((i, first // STEP, part))
            size += len(part)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def _sketch_part(items: Items, test: np.ndarray, split: list[list[bytes]]):
    """Of texts' words: passages, and per word: passages that hold it and its row of
    (counts' counts) test."""
    size = len(items.vocabulary)
    seen, rows, passages = np.zeros(size), np.zeros(test.shape), 0
    long = SIZES[-1] * STEP
    for held in _chunks([items.numbers(words) for words in split]):
        flat = np.concatenate([x for _, _, x in held])
        starts = np.concatenate([[0], np.cumsum([len(x) for _, _, x in held])])
        passage, made = np.empty(len(flat), np.int64), 0
        for low, high in zip(starts, starts[1:], strict=False):
            passage[low:high] = made + np.arange(high - low) // long
            made = passage[high - 1] + 1
        passages += int(made)
        known = flat >= 0
        flat, passage = flat[known], passage[known]
        if not len(flat):
            continue
        cells = np.unique(passage * size + flat) % size
        seen += np.bincount(cells, minlength=size)
        first = np.flatnonzero(np.diff(passage, prepend=-1))
        sums = np.add.reduceat(test[flat], first)
        place = np.cumsum(np.diff(passage, prepend=passage[0]) > 0)
        for k in range(test.shape[1]):
            rows[:, k] += np.bincount(flat, sums[place, k], size)
    return passages, seen, rows


@dataclass
class Space:
    """Directions of the passages' matrix of weighted words, for a block of items."""

    items: Items
    #: By word, its inverse document frequency among all passages.
    idf: np.ndarray
    #: By word, its weighted coordinates; the last row, zero, is that of other words.
    words: np.ndarray

    @classmethod
    def fit(cls, docs: DataFrame, blocks: list[Items]) -> list[Space]:
        """Randomised SVD over the passages of all ``docs`` and, in ``of``, of the items.

        A is the matrix of passages by words, T its counts, D the words' weights,
        A = T D. One pass gives T'T times a random matrix; with it, A'A is known on the
        random matrix scaled by D's inverse, and the Nystroem form of A'A on it has A's
        right singular vectors. A text is read once for all blocks. Each task sends one
        row a word of each block's items, however many passages it read.
        """
        wide = RANK + EXTRA
        sizes = [len(items.vocabulary) for items in blocks]
        tests = [
            np.random.default_rng(5).normal(size=(size, wide)).astype(np.float32) for size in sizes
        ]
        names = ["passages", "seen", *(f"c{k}" for k in range(wide))]

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            passages = [0] * len(blocks)
            seen = [np.zeros(size) for size in sizes]
            rows = [np.zeros((size, wide)) for size in sizes]
            for batch in batches:
                for at in range(0, len(batch), TEXTS):
                    texts = batch.column(0).slice(at, TEXTS).to_pylist()
                    split = [words_of(t) for t in texts]
                    for k, items in enumerate(blocks):
                        own = _sketch_part(items, tests[k], split)
                        passages[k] += own[0]
                        seen[k] += own[1]
                        rows[k] += own[2]
            for k in range(len(blocks)):
                met = np.flatnonzero(seen[k])
                columns = [np.full(len(met) + 1, passages[k]), seen[k][met], *rows[k][met].T]
                # The row of no word carries the number of passages.
                columns = [columns[0], *(np.append(c, 0.0) for c in columns[1:])]
                arrays = [pa.array(np.full(len(met) + 1, k), pa.int32())]
                arrays.append(pa.array(np.append(met, -1), pa.int32()))
                arrays += [pa.array(c.astype(float)) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["block", "word", *names])

        schema = "block int, word int, " + ", ".join(f"{n} double" for n in names)
        read = docs.select("text").mapInArrow(part, schema)
        sums = read.groupBy("block", "word").agg(*(F.sum(n).alias(n) for n in names))
        found = sums.toArrow()  # one row a word of the items
        block, word = (found[c].to_numpy() for c in ("block", "word"))
        values = np.stack([found[n].to_numpy() for n in names], 1)
        out = []
        for k, items in enumerate(blocks):
            seen, rows = np.zeros(sizes[k]), np.zeros((sizes[k], wide))
            own = (block == k) & (word >= 0)
            seen[word[own]], rows[word[own]] = values[own, 1], values[own, 2:]
            total = values[(block == k) & (word < 0), 0].sum()
            out.append(cls.of(items, tests[k], total, seen, rows))
        return out

    @classmethod
    def of(
        cls, items: Items, test: np.ndarray, total: float, seen: np.ndarray, rows: np.ndarray
    ) -> Space:
        """From the sums over the documents' passages; the items' are added here.

        Items weigh as much as all documents, else the space would have no room for
        what tells them apart.
        """
        own, own_seen, own_rows = _sketch_part(items, test, items.words)
        idf = np.log((total + own + 1) / (seen + own_seen + 1))
        rows = rows + max(1.0, total / own) * own_rows
        return cls(items, idf, _directions(test.astype(float), rows, items.weights()))

    def part_vectors(self, parts: list[tuple[int, int, int]]) -> np.ndarray:
        """The places of parts of items in the space."""
        get, words = self.items.vocabulary.__getitem__, self.items.words
        vectors = [self.words[[get(w) for w in words[i][at:end]]].sum(0) for i, at, end in parts]
        return np.stack(vectors).astype(np.float32)

    def search(self, split: list[list[bytes]]) -> Iterator[list[tuple[int, float]]]:
        """For each text's words, (item, share of its words in order) of the items held.

        Passages close to a part of an item in the space are candidates; the words
        around one, as far as the item goes, are then compared with all of its words
        in order.
        """
        parts = self.items.parts()
        vectors = self.part_vectors(parts)
        lengths = np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)
        vectors = (vectors / lengths[:, None]).T
        sizes = np.array([end - at for _, at, end in parts])
        group_of = np.searchsorted(np.array(SIZES[:-1]) * STEP, sizes)
        groups = [np.flatnonzero(group_of == i) for i in range(len(SIZES))]
        answers = [self.answer(i) for i in range(len(self.items.words))]
        # Starts of a long item's copy are told apart by a quarter of its length.
        longest = SIZES[-1] * STEP
        apart = np.array([len(w) // 4 if len(w) > longest else 1 for w in self.items.words])
        item_of, offset_of = np.array(parts)[:, :2].T
        words = self.words.astype(np.float32)
        distinct = [set(w) for w in split]
        near: list[dict[int, set[int]]] = [{} for _ in split]
        for held in _chunks([self.items.numbers(w) for w in split]):
            flat = np.concatenate([x for _, _, x in held])
            steps = np.add.reduceat(words[flat], np.arange(0, len(flat), STEP))
            text = np.concatenate([np.full(len(x) // STEP, i) for i, _, x in held])
            step = np.concatenate([n + np.arange(len(x) // STEP) for _, n, x in held])
            for group, length in zip(groups, SIZES, strict=True):
                if not len(group):
                    continue
                passages = sum(steps[k : len(steps) - length + 1 + k] for k in range(length))
                least = LEAST_COSINE * np.linalg.norm(passages, axis=1)
                least[text[: len(passages)] != text[length - 1 :]] = np.inf
                for first in range(0, len(group), PARTS):
                    own = group[first : first + PARTS]
                    along = passages @ vectors[:, own]
                    close = along >= np.maximum(least[:, None], LEAST_LENGTH * lengths[own])
                    at, part = np.nonzero(close)
                    item, number = item_of[own[part]], text[at]
                    start = step[at] * STEP - offset_of[own[part]]
                    start = start // apart[item] * apart[item]
                    pair = number * len(answers) + item
                    order = np.argsort(pair, kind="stable")
                    pair, start = pair[order], start[order]
                    bounds = np.append(np.flatnonzero(np.diff(pair, prepend=-1)), len(pair))
                    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                        key = int(pair[low])
                        i, k = divmod(key, len(answers))
                        # Words that the whole text has not are at none of its places.
                        if len(answers[k] & distinct[i]) >= LEAST_ANSWER * len(answers[k]):
                            near[i].setdefault(k, set()).update(start[low:high].tolist())
        for words_in, places in zip(split, near, strict=True):
            yield [
                (i, share)
                for item, starts in sorted(places.items())
                if (share := self.common(item, answers[item], words_in, sorted(starts))) is not None
                for i in self.items.ids[item]
            ]

    def common(
        self, item: int, answer: set[bytes], words: list[bytes], starts: list[int]
    ) -> float | None:
        """The largest share of the item's words in order, around one of the places.

        None below the least share, or where too little of the answer is there.
        """
        own = self.items.words[item]
        best = 0.0
        for start in starts:
            low = max(0, start - len(own) // 2)
            around = words[low : start + max(SIZES[-1] * STEP, len(own)) + len(own) // 2]
            if len(answer.intersection(around)) < LEAST_ANSWER * len(answer):
                continue
            best = max(best, common_words(own, around) / len(own))
        return best if best >= LEAST_COMMON else None

    def answer(self, item: int) -> set[bytes]:
        """The rarest quarter of an item's distinct words, by passages with them."""
        numbers = self.items.vocabulary
        rarity = lambda w: (-self.idf[numbers[w]], w)
        rarest = sorted(set(self.items.words[item]), key=rarity)
        return set(rarest[: -(-len(rarest) // 4)])


def _directions(test: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weights times the leading right singular vectors, from T'T test; a zero row last."""
    image = rows * weights[:, None]  # A'A times (test / weights)
    inner = test.T @ rows
    basis, upper = np.linalg.qr(image)
    middle = upper @ np.linalg.pinv((inner + inner.T) / 2, rcond=1e-10, hermitian=True) @ upper.T
    values, vectors = np.linalg.eigh((middle + middle.T) / 2)
    leading = basis @ vectors[:, np.argsort(-values)[:RANK]]
    return np.vstack([leading * weights[:, None], np.zeros((1, leading.shape[1]))])


def common_words(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, a bit for each word of ``a``."""
    places: dict[bytes, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        if met := places.get(word):
            kept = row & met
            row = (row + kept | row - kept) & full
    return len(a) - row.bit_count()


def blocks(benchmark: DataFrame, size: int = BLOCK) -> Iterator[Items]:
    """The items of ``benchmark`` (item_id, text), ``size`` at a time by item_id.

    The driver and a task hold ``BLOCKS`` of them at once. Items without an id or a
    word can't be reported and are left out.
    """
    rows = benchmark.where("item_id is not null and text is not null")
    rows = rows.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    last = None
    while True:
        rest = rows if last is None else rows.where(F.struct("item_id", "text") > last)
        held = [tuple(r) for r in rest.orderBy("item_id", "text").limit(size).collect()]
        if not held:
            return
        yield Items.of(held)
        last = F.struct(F.lit(held[-1][0]).alias("item_id"), F.lit(held[-1][1]).alias("text"))


def _searched(spaces: list[Space]) -> Column:
    def search(batches):
        for texts in batches:
            rows = []
            for at in range(0, len(texts), TEXTS):
                split = [words_of(t) for t in texts[at : at + TEXTS].tolist()]
                found = zip(*(space.search(split) for space in spaces), strict=True)
                rows += [[{"item_id": i, "common": c} for own in x for i, c in own] for x in found]
            yield pd.Series(rows)

    search.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(search, "array<struct<item_id long, common double>>")("text")


def leaks(docs: DataFrame, benchmark: DataFrame) -> Column:
    """An array (item_id, common) for the column ``text`` of ``docs``.

    It has each item of ``benchmark`` (item_id, text) of whose words a text holds
    enough in order, with the share of them. Every text meets every item, in blocks
    of items, ``BLOCKS`` of which are searched while a text is read once. Texts are
    searched one by one, so repeated rows, null ids and other columns make no
    difference; a null or empty text holds nothing, and an empty benchmark is held by
    nothing.
    """
    kind = "array<struct<item_id long, common double>>"
    found = [F.array().cast(kind)]
    held = (items for items in blocks(benchmark) if items.ids)
    while group := list(islice(held, BLOCKS)):
        found.append(_searched(Space.fit(docs, group)))
    return F.concat(*found)
