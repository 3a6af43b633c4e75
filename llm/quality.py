"""Quality classifier: learned vectors of hashed words and character n-grams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq, mul
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import labelled_sample

#: Labelled rows that are learned from, at most.
LABELLED_ROWS = 4_000
BUCKETS = 1 << 16
SIZE = 12
GRAMS = (2, 3, 4)
CACHED_WORDS = 600_000
#: Stand beside a word that is the same as the one before, or the second before.
ECHOES = ("= =1", "= =2")


def place(name: str) -> int:
    return crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


def grams(word: str) -> list[str]:
    """The n-grams of a word, its ends marked."""
    marked = f"<{word}>"
    return [marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)]


def features(word: str) -> list[int]:
    """Hashed places of a word and of its n-grams."""
    return [place(x) for x in (word, *grams(word))]


def feature_count(words: list[str]) -> int:
    """How many features words have in all: of n-grams, none is longer than a sign
    between its two marks, the shortest word, and one."""
    letters = sum(map(len, words))
    return len(words) + sum(letters + (3 - n) * len(words) for n in GRAMS)


def echoes(words: list[str]) -> tuple[int, ...]:
    """How many words are the same as the one before, and the second before."""
    return tuple(sum(map(eq, words, words[n:])) for n in range(1, len(ECHOES) + 1))


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and their counts in a whole text."""
    split = (text or "").split()
    words = Counter(split)
    counts = np.zeros(BUCKETS, np.float32)
    for word, n in words.items():
        np.add.at(counts, features(word), n)
    for name, n in zip(ECHOES, echoes(split), strict=True):
        counts[place(name)] += n
    places = np.flatnonzero(counts)
    return places.astype("<i4"), counts[places].astype("<f4")


@dataclass
class Classifier:
    """Softmax over the mean of a document's vectors.

    As the mean is linear, each place's share of the odds is known beforehand.
    """

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def scores(self, texts) -> Iterator[float]:
        """Probability of good quality. A text without words has that of a zero vector."""
        shares = (self.vectors @ (self.output[:, 1] - self.output[:, 0])).tolist()
        bias = float(self.bias[1] - self.bias[0])
        echo = [shares[place(name)] for name in ECHOES]
        by_gram: dict[str, float] = {}
        by_word: dict[str, float] = {}

        def share(gram: str) -> float:
            found = by_gram[gram] = shares[place(gram)]
            return found

        for text in texts:
            words = (text or "").split()
            new = set(words).difference(by_word)
            if len(by_word) + len(new) > CACHED_WORDS:
                by_word.clear()
                by_gram.clear()
                new = set(words)
            for word in new:
                own = [by_gram[x] if x in by_gram else share(x) for x in grams(word)]
                by_word[word] = shares[place(word)] + sum(own)
            again = echoes(words)
            total = sum(map(mul, again, echo)) + sum(map(by_word.__getitem__, words))
            n = sum(again) + feature_count(words)
            odds = bias + (total / n if n else 0.0)
            yield 1 / (1 + float(np.exp(-min(max(odds, -30.0), 30.0))))


def train(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    steps: int = 750,
    rate: float = 100.0,
    batch: int = 32,
) -> Classifier:
    """Stochastic gradient descent on the cross entropy; the rate falls to zero.

    Few rows are gone through more often, so that there are as many steps.
    """
    chance = np.random.default_rng(11)
    vectors = chance.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE))
    output, bias = chance.normal(0, 0.1, (SIZE, 2)), np.zeros(2)
    batches = -(-len(rows) // batch)
    for epoch in range(-(-steps // batches) if rows else 0):
        order = chance.permutation(len(rows))
        for done, own in enumerate(np.array_split(order, batches), epoch * batches):
            now = rate * max(0.0, 1 - done / steps)
            places = np.concatenate([rows[i][0] for i in own])
            sizes = [len(rows[i][0]) for i in own]
            doc = np.repeat(np.arange(len(own)), sizes)
            shares = np.concatenate(
                [rows[i][1] / max(rows[i][1].sum(), 1) for i in own]
            ).astype(float)
            means = np.stack(
                [np.bincount(doc, shares * vectors[places, k], len(own)) for k in range(SIZE)], 1
            )
            odds = means @ output + bias
            likely = np.exp(odds - odds.max(1, keepdims=True))
            likely /= likely.sum(1, keepdims=True)
            likely[np.arange(len(own)), labels[own]] -= 1
            back = likely @ output.T / len(own)
            met, place = np.unique(places, return_inverse=True)
            for k in range(SIZE):
                change = np.bincount(place, shares * back[doc, k], len(met))
                vectors[met, k] -= now * change
            output -= 0.02 * now * means.T @ likely / len(own)
            bias -= 0.02 * now * likely.mean(0)
    return Classifier(vectors.astype(np.float32), output, bias)


def fit(
    docs: DataFrame, labels: DataFrame, kept_out: Column, rows: int = LABELLED_ROWS
) -> Classifier:
    """A classifier from at most ``rows`` distinct labelled texts, whole ones.

    A text teaches once, however often it is repeated. Rows that ``kept_out`` holds
    teach nothing. Without labels every score is 0.5.
    """
    sample = labelled_sample(docs, labels, "quality", kept_out, rows)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [counted(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "places": [p.tobytes() for p, _ in found],
                    "counts": [c.tobytes() for _, c in found],
                    "label": batch["label"].to_numpy(),
                }
            )

    schema = "places binary, counts binary, label int"
    found = sample.mapInPandas(count, schema).collect()  # bounded by the sample
    found.sort(key=lambda r: (bytes(r["places"]), bytes(r["counts"]), r["label"]))
    pairs = [(np.frombuffer(r["places"], "<i4"), np.frombuffer(r["counts"], "<f4")) for r in found]
    if not pairs:
        return Classifier(np.zeros((BUCKETS, SIZE)), np.zeros((SIZE, 2)), np.zeros(2))
    return train(pairs, np.array([int(r["label"] > 0) for r in found]))


def score(classifier: Classifier) -> Column:
    """The score, 0 to 1, of the column ``text``.

    Each row is scored by its text alone: repeated rows, null ids and other columns
    make no difference; a null text is like an empty one.
    """

    def of_texts(batches):
        for texts in batches:
            yield pd.Series(list(classifier.scores(texts)), dtype="float64")

    of_texts.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(of_texts, "double")("text")
