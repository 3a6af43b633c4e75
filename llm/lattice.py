"""Subword lattice likelihood: all segmentations of a text, weighted by a vocabulary."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import log, log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import stored

SPACE = "▁"
#: A word that is at least this share of all tokens is sent to every task, so there
#: are at most as many of them however large the corpus is.
SENT_SHARE = 1 / (1 << 19)
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 300_000
#: Rounds of expectation-maximisation, and what each piece has beside its count.
ROUNDS = 4
EXTRA_COUNT = 0.1
#: Words that are grouped by length together: of too few, most lengths have a handful.
WORDS_AT_ONCE = 50_000
#: Characters that are worked on together, and how pieces are hashed.
CELLS = 1 << 16
SLOT_BITS = 20
FACTOR, SPREAD, MASK = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, (1 << 64) - 1
#: Words of up to so many characters are first tried without logs, whose sums cost
#: most. A word less likely than the second figure is done with them: the pieces that
#: rounding to zero would lose weigh less than 1e-100 of it.
PLAIN_SIZE, LEAST_PLAIN = 64, 1e-200
#: What the end of a text is counted as; no word is empty.
END = b""


def vocabulary_path() -> str:
    """The file of the public vocabulary that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def words_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


@dataclass
class Lattice:
    """Pieces of a vocabulary with log probabilities; the last one ends a text.

    Words of one length are worked on together, as rows of arrays: ``grid`` finds the
    pieces at all places by a rolling hash, ``forward`` runs over the places.
    """

    pieces: list[str | None]
    bytes_at: int
    logs: np.ndarray

    def __post_init__(self):
        self.longest = max((len(x) for x in self.pieces if x), default=1)
        self.chances = np.exp(self.logs)
        self.hashes = np.zeros(len(self.pieces) + 1, np.uint64)  # the last is of none
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)
        shared: dict[int, int] = {}
        for i, piece in enumerate(self.pieces):
            if piece:
                mark = 0
                for sign in piece:
                    mark = (mark * FACTOR + ord(sign) + 1) & MASK
                self.hashes[i] = mark
                slot = (mark * SPREAD & MASK) >> (64 - SLOT_BITS)
                if self.slots[slot] >= 0:
                    shared[mark] = i
                self.slots[slot] = i if self.slots[slot] < 0 else self.slots[slot]
        # Pieces whose slot another one has, by hash.
        self.others = np.array(sorted(shared), np.uint64)
        self.other_pieces = np.array([shared[x] for x in sorted(shared)], np.int32)

    @classmethod
    def load(cls, path: str) -> Lattice:
        """From a vocabulary file. Its scores are orders: piece n weighs 1 / (n + 1)."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.vocab_size())
        no_text = [model.IsByte(i) or model.IsControl(i) or model.IsUnknown(i) for i in every]
        pieces = [None if no_text[i] else model.IdToPiece(i) for i in every]
        weights = [1e-6 if no_text[i] else 1 / (1 - model.GetScore(i)) for i in every]
        first_byte = next(i for i in every if model.IsByte(i))
        return cls([*pieces, None], first_byte, _logs(np.array([*weights, 1e-3])))

    def find(self, marks: np.ndarray) -> np.ndarray:
        """The pieces with these hashes; -1 for none."""
        slots = (marks * np.uint64(SPREAD)) >> np.uint64(64 - SLOT_BITS)
        found = self.slots.take(slots.view(np.int64))
        missed = self.hashes.take(found, mode="wrap") != marks
        out = np.where(missed, -1, found)
        if len(self.others):
            rest = np.flatnonzero(missed & (found >= 0))
            marks = marks.ravel()[rest]
            at = np.minimum(np.searchsorted(self.others, marks), len(self.others) - 1)
            hit = self.others[at] == marks
            out.ravel()[rest[hit]] = self.other_pieces[at[hit]]
        return out

    def spelled(self, sign: int) -> list[int]:
        """The pieces of the bytes of a character that has no piece."""
        return [self.bytes_at + b for b in chr(sign).encode("utf-8", "surrogatepass")]

    def grid(self, words: list[str]) -> tuple[np.ndarray, list]:
        """By place and word, the characters; by size of piece, the pieces there."""
        size = len(words[0])
        raw = "".join(words).encode("utf-32-le", "surrogatepass")
        signs = np.frombuffer(raw, "<u4").reshape(len(words), size).T.astype(np.uint64)
        marks, found = np.zeros(signs.shape, np.uint64), []
        for k in range(1, min(size, self.longest) + 1):
            marks = marks[: size - k + 1] * np.uint64(FACTOR) + signs[k - 1 :]
            marks += np.uint64(1)
            found.append(self.find(marks))
        return signs, found

    def weights(self, signs: np.ndarray, found: list, logs: bool) -> list[np.ndarray]:
        """The probabilities of the pieces of a grid, or their logs."""
        every = self.logs if logs else self.chances
        every = np.append(every, -np.inf if logs else 0.0)
        out = [every.take(pieces, mode="wrap") for pieces in found]
        unmet = found[0] < 0
        for sign in np.unique(signs[unmet]).tolist():
            weight = self.logs[self.spelled(sign)].sum()
            out[0][(signs == sign) & unmet] = weight if logs else np.exp(weight)
        return out

    @staticmethod
    def forward(weights: list, size: int) -> list[np.ndarray]:
        """By place, the log probability of all ways to get there."""
        alpha = [np.zeros(weights[0].shape[1])]
        for j in range(1, size + 1):
            sizes = range(1, min(j, len(weights)) + 1)
            alpha.append(_log_sum([alpha[j - k] + weights[k - 1][j - k] for k in sizes]))
        return alpha

    @staticmethod
    def forward_plain(weights: list, size: int) -> np.ndarray:
        """As ``forward``, of probabilities themselves."""
        alpha = np.zeros((size + 1, weights[0].shape[1]))
        alpha[0] = 1.0
        for j in range(1, size + 1):
            for k in range(1, min(j, len(weights)) + 1):
                alpha[j] += alpha[j - k] * weights[k - 1][j - k]
        return alpha

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Of each word with the blank before it, over all its segmentations."""
        out = np.empty(len(words))
        for size, places, marked in _by_size(words):
            signs, found = self.grid(marked)
            if size <= PLAIN_SIZE:
                ends = self.forward_plain(self.weights(signs, found, False), size)[-1]
                if ends.min() > LEAST_PLAIN:
                    out[places] = np.log(ends)
                    continue
            out[places] = self.forward(self.weights(signs, found, True), size)[-1]
        return out

    def add_expected(self, words: list[bytes], counts: np.ndarray, sums: np.ndarray) -> None:
        """Adds to ``sums`` how often each piece is expected in the counted words."""
        for size, places, marked in _by_size(words):
            signs, found = self.grid(marked)
            shares = self.shares(signs, found, size, counts[places])
            unmet = found[0] < 0
            for sign in np.unique(signs[unmet]).tolist():
                sums[self.spelled(sign)] += shares[0][(signs == sign) & unmet].sum()
            # One more place than pieces, for what has met none.
            met = np.concatenate([x.ravel() for x in found]) + 1
            share = np.concatenate([x.ravel() for x in shares])
            sums += np.bincount(met, share, len(sums) + 1)[1:]

    def shares(
        self, signs: np.ndarray, found: list, size: int, counts: np.ndarray
    ) -> list[np.ndarray]:
        """By size of piece, how often the piece at each place of a grid is expected."""
        if size <= PLAIN_SIZE:
            weights = self.weights(signs, found, False)
            alpha = self.forward_plain(weights, size)
            if alpha[-1].min() > LEAST_PLAIN:
                turned = [w[::-1] for w in weights]
                beta = self.forward_plain(turned, size)[::-1]
                alpha *= counts / alpha[-1]
                return [
                    alpha[: size - k + 1] * own * beta[k:]
                    for k, own in enumerate(weights, 1)
                ]
        weights = self.weights(signs, found, True)
        alpha = self.forward(weights, size)
        turned = [w[::-1] for w in weights]
        beta = self.forward(turned, size)[::-1]
        out = []
        for k, own in enumerate(weights, 1):
            ways = np.stack(alpha[: size - k + 1]) + own + np.stack(beta[k:])
            out.append(counts * np.exp(np.minimum(ways - alpha[-1], 0.0)))
        return out


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of about ``WORDS_AT_ONCE``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= WORDS_AT_ONCE:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _by_size(words: list[bytes]) -> Iterator[tuple[int, list[int], list[str]]]:
    """(size, places, words with a blank before) for words of one size each."""
    groups: dict[int, tuple[list[int], list[str]]] = {}
    for i, word in enumerate(words):
        marked = SPACE + word.decode("utf-8", "surrogatepass")
        places, texts = groups.setdefault(len(marked), ([], []))
        places.append(i)
        texts.append(marked)
    for size, (places, texts) in groups.items():
        step = max(1, CELLS // size)
        for at in range(0, len(places), step):
            yield size, places[at : at + step], texts[at : at + step]


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    if len(terms) == 1:
        return terms[0]
    every = np.stack(terms)
    top = every.max(0)
    return top + np.log(np.exp(every - top).sum(0))


def _logs(weights: np.ndarray) -> np.ndarray:
    return np.log(weights / weights.sum())


def word_counts(docs: DataFrame, learn: Column) -> DataFrame:
    """(word, n): every word of ``docs``, n of them in rows where ``learn`` holds.

    The end of each text is one more token, under an empty word.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        others: set[bytes] = {END}

        def handed() -> pa.RecordBatch:
            others.difference_update(seen)
            names = [*seen, *others]
            counts = [*seen.values(), *([0] * len(others))]
            return pa.RecordBatch.from_pydict({"word": names, "n": counts}, kinds)

        kinds = pa.schema([("word", pa.binary()), ("n", pa.int64())])
        for batch in batches:
            for text, learnt in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (seen if learnt else others).update(words_of(text))
                if learnt:
                    seen[END] += 1
                if len(seen) + len(others) > COUNTED_WORDS:
                    yield handed()
                    seen, others = Counter(), {END}
        yield handed()

    found = docs.select("text", learn.alias("learn")).mapInArrow(tally, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def learned(words: DataFrame, lattice: Lattice, rounds: int = ROUNDS) -> Lattice:
    """The lattice with probabilities that the counted ``words`` (word, n) teach.

    Each round takes the expected number of each piece over all segmentations of
    all words; of these sums there are as many as pieces.
    """
    for _ in range(rounds):
        now = lattice

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(len(now.logs))
            for batch in _larger(batches):
                words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                if END in words:
                    sums[-1] += counts[words.index(END)]
                    counts = np.delete(counts, words.index(END))
                    words.remove(END)
                now.add_expected(words, counts, sums)
            met = np.flatnonzero(sums)
            columns = [pa.array(met, pa.int32()), pa.array(sums[met], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["piece", "n"])

        found = words.where("n > 0").select("word", "n").mapInArrow(expect, "piece int, n double")
        found = found.groupBy("piece").agg(F.sum("n").alias("n")).collect()
        weights = np.full(len(lattice.logs), EXTRA_COUNT)
        for row in found:
            weights[row["piece"]] += row["n"]
        lattice = replace(lattice, logs=_logs(weights))
    return lattice


def scored_words(words: DataFrame, lattice: Lattice, total: int, once: int) -> DataFrame:
    """(word, n, pieces, log10): log10 of the word's probability, by pieces and by all.

    Beside the vocabulary's pieces, the lattice of a word that the training rows
    have has one edge over the whole word, which weighs as much as the word's share
    of the training tokens. Whole words have the say that tokens seen before have,
    by the number of words seen once.
    """
    whole = min(0.999, 1 - once / total) if total else 0.0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _larger(batches):
            names, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            logs = lattice.log_probabilities(names)
            if END in names:
                logs[names.index(END)] = lattice.logs[-1]
            both = logs + log(1 - whole)
            edge = np.log(whole * n[n > 0] / total) if whole else -np.inf
            both[n > 0] = np.logaddexp(both[n > 0], edge)
            columns = [*batch.columns, *(pa.array(x / log(10), pa.float64()) for x in (logs, both))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "pieces", "log10"])

    schema = "word binary, n long, pieces double, log10 double"
    return words.select("word", "n").mapInArrow(score, schema)


def score(docs: DataFrame, learn: Column, kept_out: Column, vocabulary: str) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text, ...) with its likelihoods.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    pieces_score: tokens are words and an end. base_score is the add-one unigram
    model of the words where ``learn`` holds. score is log10 of the marginal
    probability over all segmentations (see ``scored_words``), pieces_score that
    over segmentations into pieces of ``vocabulary`` alone. Pieces don't cross
    blanks, so a text's lattice is a chain of its words' lattices and its
    probability their product. A null text is like an empty one; repeated rows have
    a row each; an empty table gives an empty result.

    Frequent words, of bounded number, are looked up where the text is read; the
    others travel to their counts and back, by word and then by row. A row is known
    by its task and place, so ``docs`` should be read from files: a task that runs
    again then meets its rows in the same order.
    """
    words = stored(word_counts(docs, learn))
    n = F.col("n")
    sums = words.agg(F.sum(n), F.count(F.when(n > 0, 1)), F.count(F.when(n == 1, 1))).first()
    total, kinds, once = (x or 0 for x in sums)
    lattice = learned(words, Lattice.load(vocabulary))
    words = stored(scored_words(words, lattice, total, once))
    frequent = words.where((F.col("n") >= total * SENT_SHARE) | (F.col("word") == F.lit(END)))
    base = lambda n: log10((n + 1) / (total + kinds + 1))
    known = {
        bytes(r["word"]): (int(r["n"] > 0), base(r["n"]), r["log10"], r["pieces"])
        for r in frequent.collect()
    }
    sent = docs.sparkSession.sparkContext.broadcast(known)  # of at most 1 / SENT_SHARE words

    names = ["row", "word", "n", "doc_id", "held", "n_tokens", "n_known"]
    types = [pa.int64(), pa.binary(), *[pa.int64()] * 5, *[pa.float64()] * 3]
    names += ["base", "lattice", "alone"]
    kinds_of = pa.schema(list(zip(names, types, strict=True)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, end = sent.value.get, sent.value[END]
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            heads, rare, counts, rows = [], [], [], []
            for doc_id, held, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                split = words_of(text)
                n_known, base_sum, lattice_sum, alone = end
                for word, n in Counter(split).items():
                    found = get(word)
                    if found is None:
                        rare.append(word)
                        counts.append(n)
                        rows.append(row)
                    else:
                        n_known += n * found[0]
                        base_sum += n * found[1]
                        lattice_sum += n * found[2]
                        alone += n * found[3]
                # No word has a blank, so this one meets none, and each is another.
                own = b" %d" % row
                sums = (n_known, base_sum, lattice_sum, alone)
                heads.append((row, own, 0, doc_id, int(held), len(split) + 1, *sums))
                row += 1
            columns = list(zip(*heads, strict=True)) if heads else [()] * len(names)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, kinds_of, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=kinds_of)
            if rare:
                none = [pa.nulls(len(rare), f.type) for f in kinds_of][3:]
                arrays = [pa.array(rows, pa.int64()), pa.array(rare, pa.binary())]
                arrays += [pa.array(counts, pa.int64()), *none]
                yield pa.RecordBatch.from_arrays(arrays, schema=kinds_of)

    schema = (
        "row long, word binary, n long, doc_id long, held long, n_tokens long, "
        "n_known long, base double, lattice double, alone double"
    )
    texts = docs.select(F.col("doc_id").cast("long"), kept_out.alias("held"), "text")
    parts = texts.mapInArrow(read, schema)
    parts = parts.join(words.withColumnRenamed("n", "c"), "word", "left")
    n = F.when(F.col("c").isNotNull(), F.col("n")).otherwise(F.lit(0))
    rare_base = F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(total + kinds + 1)))
    tokens = parts.select(
        "row",
        "doc_id",
        "held",
        "n_tokens",
        F.coalesce("n_known", F.when(F.col("c") > 0, F.col("n")), F.lit(0)).alias("n_known"),
        F.coalesce("base", n * rare_base).alias("base"),
        F.coalesce("lattice", n * F.coalesce("log10", F.lit(0.0))).alias("lattice"),
        F.coalesce("alone", n * F.coalesce("pieces", F.lit(0.0))).alias("alone"),
    )
    found = tokens.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        (F.max("held") == 1).alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"),
        F.sum("lattice").alias("score"),
        F.sum("alone").alias("pieces_score"),
    )
    return found.drop("row")
