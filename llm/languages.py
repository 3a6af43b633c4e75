"""Language of texts and of their spans: scripts, word scores, and Viterbi's best path."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First and last code point of each script's main ranges.
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("latin", 0x2C60, 0x2C7F),
    ("greek", 0x370, 0x3FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x400, 0x52F), ("cyrillic", 0x1C80, 0x1C8F),
    ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x6FF), ("arabic", 0x750, 0x77F), ("arabic", 0x8A0, 0x8FF),
    ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("gurmukhi", 0xA00, 0xA7F),
    ("gujarati", 0xA80, 0xAFF), ("oriya", 0xB00, 0xB7F), ("tamil", 0xB80, 0xBFF),
    ("telugu", 0xC00, 0xC7F), ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F),
    ("sinhala", 0xD80, 0xDFF), ("thai", 0xE00, 0xE7F), ("lao", 0xE80, 0xEFF),
    ("tibetan", 0xF00, 0xFFF), ("myanmar", 0x1000, 0x109F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7A3),
    ("ethiopic", 0x1200, 0x139F), ("khmer", 0x1780, 0x17FF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
    ("han", 0xF900, 0xFAFF), ("han", 0x20000, 0x323AF),
)

#: Code points beyond are no letters.
CODES = 0x323B0
#: Letters of a word at most; a longer run is several words.
LONGEST = 24
#: Hashed places of n-grams, and their lengths, ends of words included.
BUCKETS = 1 << 16
GRAMS = (1, 2, 3, 4)
#: A share that every n-gram has in every language, so that unseen ones say nothing.
SMOOTHING = 1e-6
#: A language may be written in a script that this share of its letters is of.
SCRIPT_SHARE = 0.02
#: What a word can say against a language at most, and what a change of language costs.
MOST, PENALTY = 8.0, 16.0
#: Code points, and scores of code points, that a task takes at a time.
CHUNK, SCORES = 1 << 18, 1 << 22
#: What texts without a letter, or without any language learned, are in.
UNKNOWN = "und"


def script_names() -> list[str]:
    """Names by number; 0 is no letter, 1 a letter of any other script."""
    return ["", "other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]


class Letters:
    """Tables over code points: the script of letters, and lower case."""

    def __init__(self):
        self.script = np.zeros(CODES + 1, np.uint8)
        self.lower = np.arange(CODES + 1, dtype=np.uint32)
        letters = [i for i in range(CODES) if chr(i).isalpha()]
        self.script[letters] = 1
        names = script_names()
        for name, first, last in SCRIPTS:
            own = self.script[first : last + 1]
            own[own > 0] = names.index(name)
        for i in letters:
            # A letter that is several in lower case stays as it is.
            if len(low := chr(i).lower()) == 1:
                self.lower[i] = ord(low)


@dataclass
class Words:
    """The words of some texts one after the other.

    A word is a run of letters of one script. ``marked`` holds, for each word, a zero
    and its letters, and a zero at the end; ``at`` are the places of these zeros.
    """

    marked: np.ndarray
    at: np.ndarray  # one for each word
    script: np.ndarray
    start: np.ndarray  # code points in the pieces' sequence
    length: np.ndarray
    piece: np.ndarray  # which of the texts


def words_of(texts: list[str], letters: Letters) -> Words:
    """Words of ``texts``, which are of CHUNK code points together or one alone."""
    coded = [t.encode("utf-32-le", "surrogatepass") for t in texts]
    sizes = np.array([len(c) // 4 for c in coded], np.int64)
    codes = np.minimum(np.frombuffer(b"".join(coded), "<u4"), CODES)
    script = letters.script[codes]
    piece = np.repeat(np.arange(len(texts)), sizes)
    place = np.flatnonzero(script)
    script, own, codes = script[place], piece[place], letters.lower[codes[place]]
    # A run begins behind a gap, at another script and at another text.
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(place) > 1) | (script[1:] != script[:-1]) | (own[1:] != own[:-1])
    run = np.flatnonzero(new)
    within = np.arange(len(place)) - run[np.cumsum(new) - 1] if len(run) else place
    first = np.flatnonzero(within % LONGEST == 0)
    word = np.cumsum(within % LONGEST == 0) - 1
    marked = np.zeros(len(place) + len(first) + 1, np.uint32)
    marked[np.arange(len(place)) + word + 1] = codes
    length = np.diff(np.append(first, len(place)))
    at = first + np.arange(len(first))
    return Words(marked, at, script[first], place[first], length, own[first])


def hashed(marked: np.ndarray) -> Iterator[np.ndarray]:
    """For each length of n-grams, the place of the one that begins at each position.

    ``BUCKETS`` stands where an n-gram would go beyond a word's ends.
    """
    wide = marked.astype(np.uint64)
    total = np.zeros(len(marked), np.uint64)
    inside = np.ones(len(marked), bool)  # no zero between first and last so far
    for n in range(1, max(GRAMS) + 1):
        reach = max(len(marked) - n + 1, 0)
        total = total[:reach] * np.uint64(0x9E3779B97F4A7C15) + wide[n - 1 :] + np.uint64(1)
        if n == 1:
            there = marked != 0
        else:
            inside = inside[:reach]
            if n > 2:
                inside = inside & (marked[n - 2 : n - 2 + reach] != 0)
            there = inside
        if n in GRAMS:
            mixed = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            place = (mixed >> np.uint64(48)).astype(np.int32)
            out = np.full(len(marked), BUCKETS, np.int32)
            out[:reach] = np.where(there, place, BUCKETS)
            yield out


def pieces(texts: list[str | None], chunk: int = CHUNK) -> Iterator[list[tuple[int, int, str]]]:
    """(number, offset, part) of texts, whole ones together, long ones in parts.

    Where a text is cut depends on the text alone.
    """
    held, size = [], 0
    for i, text in enumerate(texts):
        for offset in range(0, len(text or ""), CHUNK):
            part = text[offset : offset + CHUNK]
            if held and size + len(part) > chunk:
                yield held
                held, size = [], 0
            held.append((i, offset, part))
            size += len(part)
    if held:
        yield held


@dataclass
class Model:
    """Scores of n-grams and scripts by language, the ones with most letters first."""

    languages: list[str]
    scores: np.ndarray  # by place, then language; the last place scores nothing
    may: np.ndarray  # by script, then language

    @classmethod
    def of(cls, found: pa.Table) -> Model:
        """From (lang, place, n); places from BUCKETS on are scripts."""
        lang, place = found["lang"].to_pylist(), found["place"].to_numpy()
        n = found["n"].to_numpy().astype(float)
        names = sorted(set(lang))
        number = {name: i for i, name in enumerate(names)}
        rows = np.array([number[x] for x in lang], int)
        counts = np.zeros((len(names), BUCKETS + len(script_names())))
        counts[rows, place] = n
        written = counts[:, BUCKETS:]
        order = sorted(range(len(names)), key=lambda i: (-written[i].sum(), names[i]))
        counts, written = counts[order], written[order]
        shares = counts[:, :BUCKETS] / np.maximum(counts[:, :BUCKETS].sum(1, keepdims=True), 1)
        scores = np.zeros((BUCKETS + 1, len(names)), np.float32)
        scores[:BUCKETS] = np.log(shares + SMOOTHING).T / len(GRAMS)
        of_script = written / np.maximum(written.sum(1, keepdims=True), 1)
        return cls([names[i] for i in order], scores, (of_script >= SCRIPT_SHARE).T)

    def word_scores(self, words: Words) -> np.ndarray:
        """For each word and language, how much is against it: 0 for the best, else less.

        Only languages of the word's script are candidates, any other is ``MOST``
        behind; a script of no language says nothing.
        """
        if not len(words.at):
            return np.zeros((0, len(self.languages)))
        total = sum(self.scores[place] for place in hashed(words.marked))
        own = np.add.reduceat(total, words.at, axis=0, dtype=np.float64)
        may = self.may[words.script]
        own = np.where(may, own, -np.inf)
        known = may.any(1)
        own[~known] = 0.0
        return np.maximum(own - own.max(1, keepdims=True), -MOST)

    def results(self, texts: list[str | None], letters: Letters) -> Iterator[tuple]:
        """(language, score, starts, ends, span languages) of each text."""
        held: list[tuple] = []
        chunk = min(CHUNK, SCORES // max(len(self.languages), 1))
        done = -1
        for group in pieces(texts, chunk) if self.languages else ():
            words = words_of([part for _, _, part in group], letters)
            scores = self.word_scores(words)
            ends = np.searchsorted(words.piece, np.arange(len(group)), "right")
            behind = np.cumsum([0, *(len(part) for _, _, part in group)])
            first = 0
            for k, (i, offset, _) in enumerate(group):
                if i != done:
                    yield from self._until(i, done, held)
                    held, done = [], i
                own = slice(first, ends[k])
                first = ends[k]
                start = words.start[own] - behind[k] + offset
                held.append((scores[own], start, words.length[own]))
        yield from self._until(len(texts), done, held)

    def _until(self, i: int, done: int, held: list[tuple]) -> Iterator[tuple]:
        """The result of text ``done``, and of those without a part before text ``i``."""
        if done >= 0:
            yield self.labelled(*(np.concatenate(x) for x in zip(*held, strict=True)))
        for _ in range(done + 1, i):
            yield (UNKNOWN, 0.0, [], [], [])

    def labelled(self, scores: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple:
        """A text's language is the one that most of its letters are in; the score is
        their share, times the chance of that language against others there."""
        if not len(scores):
            return (UNKNOWN, 0.0, [], [], [])
        path = best_path(scores)
        if path.min() == path.max():
            top, share = int(path[0]), 1.0
            sums = scores.sum(0)
        else:
            letters = np.bincount(path, length, len(self.languages))
            top = int(letters.argmax())
            share = float(letters[top] / letters.sum())
            sums = scores[path == top].sum(0)
        chance = 1 / float(np.exp(np.minimum(sums - sums[top], 50.0)).sum())
        first = np.flatnonzero(np.diff(path, prepend=-1))
        last = np.append(first[1:], len(path)) - 1
        names = [self.languages[i] for i in path[first]]
        ends = start[last] + length[last]
        score = min(1.0, share * chance)
        return (self.languages[top], score, start[first].tolist(), ends.tolist(), names)


def best_path(scores: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The language of each word: the largest sum of scores less a penalty a change.

    Where no run of words speaks for another language than the best one by over half
    the penalty, no change pays, and the rest of the search is spared.
    """
    totals = scores.sum(0)
    top = int(totals.argmax())
    gains = np.cumsum(scores - scores[:, top : top + 1], axis=0)
    lowest = np.minimum(np.minimum.accumulate(gains, axis=0), 0.0)
    most = (gains[1:] - lowest[:-1]).max(initial=0.0) if len(gains) > 1 else 0.0
    if max(most, gains[0].max()) <= penalty / 2:
        return np.full(len(scores), top)
    return viterbi(scores, penalty)


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best path by a step a word; of equal paths the one with fewer changes."""
    now = scores[0].tolist()
    sources, changed = [], []
    for row in scores[1:].tolist():
        top = max(now)
        source = now.index(top)
        least = top - penalty
        sources.append(source)
        changed.append([x < least for x in now])
        now = [(x if x >= least else least) + y for x, y in zip(now, row, strict=True)]
    path = [now.index(max(now))]
    for source, change in zip(reversed(sources), reversed(changed), strict=True):
        path.append(source if change[path[-1]] else path[-1])
    return np.array(path[::-1])


def fit(docs: DataFrame, kept_out: Column) -> Model:
    """Counts of hashed n-grams and scripts of all ``docs`` (text, lang) with a language
    that ``kept_out`` doesn't hold.

    A null language teaches nothing. The model has ``BUCKETS`` numbers a language,
    and so has what tasks send.
    """
    taught = docs.where(F.col("lang").isNotNull() & ~kept_out)
    taught = taught.select(F.col("lang").cast("string").alias("lang"), "text")
    size = BUCKETS + len(script_names())

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, counts = Letters(), {}
        for batch in batches:
            by_lang: dict[str, list] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                own = counts.setdefault(lang, np.zeros(size, np.int64))
                for group in pieces(texts):
                    words = words_of([part for _, _, part in group], letters)
                    for place in hashed(words.marked):
                        own[:BUCKETS] += np.bincount(place, minlength=BUCKETS + 1)[:BUCKETS]
                    own[BUCKETS:] += np.bincount(
                        words.script, words.length, size - BUCKETS
                    ).astype(np.int64)
        for lang, own in counts.items():
            places = np.flatnonzero(own)
            # A language without letters is learned too.
            places = places if len(places) else np.zeros(1, np.int64)
            columns = {"lang": [lang] * len(places), "place": places.astype(np.int32)}
            yield pa.RecordBatch.from_pydict({**columns, "n": own[places]})

    found = taught.mapInArrow(tally, "lang string, place int, n long")
    found = found.groupBy("lang", "place").agg(F.sum("n").alias("n"))
    return Model.of(found.toArrow())


FOUND = "lang string, score double, starts array<long>, ends array<long>, langs array<string>"


def identified(model: Model) -> Column:
    """Struct of lang, score and spans of the column ``text``.

    spans, in order, are a start, an end and a language each, in code points; a span
    goes from its first word to its last. A null text is like an empty one: it and
    texts without a letter are ``und``, score 0, without spans, and so is all text
    if no language was learned. Each row is labelled by its text alone, so repeated
    rows, null ids and other columns make no difference.
    """

    def of_texts(batches):
        letters = Letters()
        names = [x.split()[0] for x in FOUND.split(", ")]
        for texts in batches:
            rows = list(model.results(list(texts), letters))
            yield pd.DataFrame(rows, columns=names)

    of_texts.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    found = F.pandas_udf(of_texts, FOUND)("text")
    spans = F.arrays_zip(
        found["starts"].alias("start"), found["ends"].alias("end"), found["langs"].alias("lang")
    )
    return F.struct(found["lang"].alias("lang"), found["score"].alias("score"), spans.alias("spans"))
