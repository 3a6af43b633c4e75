"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import labelled_sample, stored, summed

# Common insults in English, German, French and Spanish, the lexicon
# to start from.
INSULTS = (
    "asshole", "bastard", "bitch", "clown", "coward", "crap", "creep", "cretin",
    "disgusting", "dumb", "fool", "freak", "garbage", "idiot", "imbecile", "jerk",
    "liar", "loser", "lowlife", "moron", "parasite", "pathetic", "pig", "scum",
    "shit", "stupid", "trash", "ugly", "vermin", "worthless",
    "abschaum", "arschloch", "depp", "dummkopf", "hurensohn", "missgeburt", "scheiße",
    "schlampe", "trottel", "vollidiot", "wichser",
    "abruti", "connard", "connasse", "crétin", "débile", "enculé", "merde", "ordure",
    "pourriture", "salaud", "salope",
    "basura", "cabrón", "cretino", "escoria", "gilipollas", "imbécil", "inútil",
    "mierda", "pendejo", "puta", "zorra",
)

#: Labelled rows that are learned from, at most.
LABELLED_ROWS = 10_000
#: Learned lexicon entries, at most; with the patterns they fit into 62 bits.
LEARNED = 54
#: Words and beginnings that the classifier weighs, at most, the fixed lexicon aside.
FEATURES = 4_096
#: An entry's share of toxic texts against its share of others, at least.
LIFT = 4.0
LEAST_TEXTS = 4
PREFIXES = (3, 4, 5, 6)
STEPS = 4
#: Steps of the classifier's training, and its pull to zero.
ITERATIONS, PULL = 60, 1e-4
#: What a known label says against the label model.
KNOWN = 0.98
#: Patterns that are one row of numbers, and such rows of a task.
BLOCK, BLOCKS = 4_096, 16
WORD = re.compile(r"[^\W\d_]+")
CACHED_WORDS = 300_000


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def stems(word: str) -> list[str]:
    """A word and its beginnings, which end in a star."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


@dataclass
class Voters:
    """What is read of a text: which features its words have, and how often.

    Feature i is an entry of ``features``; the first ``learned`` of them, and the
    patterns, are bits of its vote.
    """

    features: dict[str, int]
    learned: int

    #: Patterns: insults among the words; two marked words; three; one in 50; none.
    PATTERNS = 5

    def count(self) -> int:
        return self.learned + self.PATTERNS

    def read(self, words: set[str], cache: dict[str, tuple]) -> tuple[int, bytes]:
        """The vote, and the sorted numbers of the features of all words."""
        hits, marked, found = 0, 0, []
        for word in words:
            known = cache.get(word)
            if known is None:
                own = [self.features[s] for s in stems(word) if s in self.features]
                bits = sum(1 << i for i in own if i < self.learned)
                known = cache[word] = (bits, bits > 0, own)
            if known[2]:
                hits |= known[0]
                marked += known[1]
                found += known[2]
        n = self.learned
        insult = not words.isdisjoint(INSULTS)
        dense = marked * 50 >= len(words) > 0
        signs = (insult, marked >= 2, marked >= 3, dense and marked > 0, marked == 0)
        vote = hits | sum(1 << (n + i) for i, x in enumerate(signs) if x)
        return vote, np.array(sorted(found), "<u2").tobytes()


def learned_features(sample: DataFrame, entries: int = LEARNED, features: int = FEATURES) -> Voters:
    """Words and beginnings of words that tell toxic labels, from all of a sample.

    A feature is ``LIFT`` times as frequent among toxic texts as among others.
    Lexicon entries are those in one of 50 toxic texts, at least in ``LEAST_TEXTS``, whose
    counts are the least likely by chance; of entries that begin alike one is taken.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = {s for w in words_of(text) for s in stems(w)}
                (toxic if label else clean).update(found)
            names = list(toxic.keys() | clean.keys())
            columns = [names, [toxic[x] for x in names], [clean[x] for x in names]]
            yield pa.RecordBatch.from_pydict(dict(zip(("stem", "t", "c"), columns, strict=True)))

    counts = sample.select("text", "label").mapInArrow(tally, "stem string, t long, c long")
    counts = counts.groupBy("stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    toxic = F.col("label") > 0
    texts = sample.agg(F.count_if(toxic), F.count_if(~toxic)).first()
    n_t, n_c = max(texts[0], 1), max(texts[1], 1)
    share_t, share_c = (F.col("t") + 0.5) / (n_t + 1), (F.col("c") + 0.5) / (n_c + 1)
    share = (F.col("t") + F.col("c") + 0.5) / (n_t + n_c + 1)

    def unlikely(n, of, own):
        return n * F.log(own / share) + (F.lit(of) - n) * F.log((1 - own) / (1 - share))

    told = counts.where((F.col("t") >= 2) & (share_t >= LIFT * share_c))
    by = unlikely(F.col("t"), n_t, share_t) + unlikely(F.col("c"), n_c, share_c)
    top = told.withColumn("by", by).orderBy(F.desc("by"), F.length("stem"), "stem")
    top = top.limit(features).collect()
    least, chosen = max(LEAST_TEXTS, n_t / 50), []
    for row in top:
        begun = row["stem"].rstrip("*")
        again = any(begun.startswith(x.rstrip("*")) or x.startswith(begun) for x in chosen)
        if row["t"] >= least and not again and len(chosen) < entries:
            chosen.append(row["stem"])
    names = dict.fromkeys([*chosen, *(row["stem"] for row in top), *INSULTS])
    return Voters({name: i for i, name in enumerate(names)}, len(chosen))


@dataclass
class LabelModel:
    """How often each voter fires for either class, and how voters depend.

    ``discount`` divides a voter's evidence by how much other voters repeat it.
    """

    prior: float
    fires: np.ndarray  # by class, then voter
    discount: np.ndarray

    @classmethod
    def of(cls, sums: np.ndarray) -> LabelModel:
        """From each class's weighted sums: [class, i, j] of votes i and j; 0 is always 1."""
        n = sums[:, 0, 0]
        share = (sums[:, 0, 1:] + 1) / (n[:, None] + 2)
        joint = sums[:, 1:, 1:] / np.maximum(n, 1e-9)[:, None, None]
        spread = np.sqrt(share * (1 - share))
        apart = joint - share[:, :, None] * share[:, None, :]
        alike = apart / np.maximum(spread[:, :, None] * spread[:, None, :], 1e-6)
        alike = np.clip(np.average(alike, axis=0, weights=np.maximum(n, 1e-9)), 0, 1)
        np.fill_diagonal(alike, 0)
        prior = float((n[1] + 0.5) / (n.sum() + 1))
        return cls(prior, np.clip(share, 1e-6, 1 - 1e-6), 1 / (1 + alike.sum(0)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of the toxic class for rows of 0/1 votes."""
        fired = np.log(self.fires[1] / self.fires[0])
        silent = np.log((1 - self.fires[1]) / (1 - self.fires[0]))
        odds = np.log(self.prior / (1 - self.prior))
        odds = odds + votes @ (self.discount * (fired - silent))
        odds = odds + (self.discount * silent).sum()
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def unpacked(votes: np.ndarray, n: int) -> np.ndarray:
    return ((votes[:, None] >> np.arange(n)) & 1).astype(float)


def weighted_sums(patterns: DataFrame, n: int, model: LabelModel | None) -> np.ndarray:
    """[class, i, j] over all ``patterns`` (votes, label, n); without a model, of labels."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            votes = unpacked(rows["votes"].to_numpy(), n)
            known = rows["label"].to_numpy(float)
            toxic = model.posterior(votes) if model else np.zeros(len(rows))
            toxic = np.where(known >= 0, known, toxic)
            ones = np.hstack([np.ones((len(rows), 1)), votes])
            share = rows["n"].to_numpy(float)
            sums = [(ones * (share * w)[:, None]).T @ ones for w in (1 - toxic, toxic)]
            values = np.concatenate([s.ravel() for s in sums])
            yield pd.DataFrame({"place": np.arange(len(values)), "value": values})

    used = patterns if model else patterns.where("label >= 0")
    found = used.mapInPandas(part, "place int, value double")
    found = found.groupBy("place").agg(F.sum("value").alias("value")).collect()
    sums = np.zeros(2 * (n + 1) ** 2)
    for row in found:  # as many as voters squared
        sums[row["place"]] = row["value"]
    return sums.reshape(2, n + 1, n + 1)


def label_model(votes: DataFrame, count: int, steps: int = STEPS) -> LabelModel:
    """Expectation-maximisation over ``votes`` (votes, label, n), labels or not.

    It starts from the labelled rows, whose labels stay as they are.
    """
    model = LabelModel.of(weighted_sums(votes, count, None))
    for _ in range(steps):
        model = LabelModel.of(weighted_sums(votes, count, model))
    return model


def patterns(docs: DataFrame, voters: Voters) -> DataFrame:
    """(votes, features, label, n) of ``docs`` (text, label): alike texts are one row."""

    def of_texts(texts: pd.Series) -> pd.DataFrame:
        cache: dict[str, tuple] = {}
        rows = []
        for text in texts:
            words = words_of(text)
            if len(cache) + len(words) > CACHED_WORDS:
                cache.clear()
            rows.append(voters.read(words, cache))
        return pd.DataFrame(rows, columns=["votes", "features"])

    read = F.pandas_udf(of_texts, "votes long, features binary")("text")
    rows = docs.select(read.alias("read"), "label").select("read.*", "label")
    return rows.groupBy("votes", "features", "label").agg(F.count("*").alias("n"))


def blocks(rows: DataFrame, model: LabelModel, count: int) -> DataFrame:
    """Stored ``rows`` of ``patterns`` with their targets, as arrays of ``BLOCK`` rows."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                features = part.column(1).to_pylist()
                likely = model.posterior(unpacked(part.column(0).to_numpy(), count))
                known = part.column(2).to_numpy().astype(float)
                target = np.where(known < 0, likely, KNOWN * known + (1 - KNOWN) * likely)
                n = part.column(3).to_numpy().astype(float)
                sizes = np.array([len(x) // 2 for x in features], np.int64)
                arrays = (b"".join(features), sizes.tobytes(), target.tobytes(), n.tobytes())
                names = ("features", "sizes", "target", "n")
                yield pa.RecordBatch.from_pydict(
                    {k: pa.array([v], pa.large_binary()) for k, v in zip(names, arrays, strict=True)}
                )

    schema = "features binary, sizes binary, target binary, n binary"
    # Each step of the training is a job, so its tasks shouldn't be many small ones.
    rows = rows.coalesce(rows.count() // (BLOCKS * BLOCK) + 1)
    return rows.select("votes", "features", "label", "n").mapInArrow(gather, schema)


def _sums(rows: DataFrame, size: int, use) -> np.ndarray:
    """Sum over all blocks of what ``use`` adds to ``size`` numbers."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for features, sizes, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sizes = np.frombuffer(sizes, np.int64)
                row = np.repeat(np.arange(len(sizes)), sizes)
                use(total, np.frombuffer(features, "<u2"), row, *map(np.frombuffer, rest))
        yield pa.RecordBatch.from_pydict({"sum": [total.tobytes()]})

    return summed(rows.mapInArrow(of_task, "sum binary"), size)


def train(rows: DataFrame, features: int, iterations: int = ITERATIONS) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels, over all ``blocks``.

    Each step sums the gradients of all rows in their tasks. Its size goes by a bound
    of the curvature, and momentum speeds it up. Words speak for toxicity or say
    nothing: weights are not negative, so clean text around an insult doesn't outweigh
    it.
    """

    def curvature(total, flat, row, target, n):
        width = np.bincount(row, minlength=len(n)) + 1.0
        total[:features] += np.bincount(flat, (n * width)[row], features)
        total[features] += (n * width).sum()
        total[features + 1] += n.sum()

    bound = _sums(rows, features + 2, curvature)
    total = max(bound[-1], 1.0)
    size = 1 / (0.25 * bound[:-1] / total + PULL)
    place = before = np.zeros(features + 1)
    momentum = 1.0
    for _ in range(iterations if bound[-1] else 0):
        at = place

        def slope(total, flat, row, target, n):
            odds = np.bincount(row, at[flat], len(n)) + at[features]  # noqa: B023
            error = n * (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target)
            total[:features] += np.bincount(flat, error[row], features)
            total[features] += error.sum()

        down = _sums(rows, features + 1, slope) / total
        down[:features] += PULL * at[:features]
        now = at - size * down
        now[:features] = np.maximum(now[:features], 0.0)
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        if ((at - now) * (now - before)).sum() > 0:  # it went past the valley
            faster = 1.0
        place = now + (momentum - 1) / faster * (now - before)
        before, momentum = now, faster
    return before[:features], float(before[features])


@dataclass
class Classifier:
    """Weights of words and beginnings of words that are over zero."""

    weights: dict[str, float]
    bias: float

    def scores(self, texts) -> Iterator[float]:
        """Probability that a text is toxic; null is like empty."""
        cache: dict[str, float] = {}
        known = self.weights.get
        for text in texts:
            words = words_of(text)
            if len(cache) + len(words) > CACHED_WORDS:
                cache.clear()
            for word in words.difference(cache):
                cache[word] = sum(known(s, 0.0) for s in stems(word))
            odds = self.bias + sum(map(cache.__getitem__, words))
            yield 1 / (1 + float(np.exp(-min(max(odds, -30.0), 30.0))))


def fit(
    docs: DataFrame, labels: DataFrame, kept_out: Column, rows: int = LABELLED_ROWS
) -> Classifier:
    """A classifier for ``docs``, from labels of rows that ``kept_out`` doesn't hold.

    Labels come from at most ``rows`` distinct labelled texts. The label model sees the
    votes on all documents, and the linear classifier is trained on its posterior
    labels of all of them; where a label is known, it has 98 % of the say. Alike
    documents are one weighed row. Without labels of both classes, only the fixed
    lexicon speaks.
    """
    sample = labelled_sample(docs, labels, "toxic", kept_out, rows)
    sample = sample.withColumn("label", (F.col("label") > 0).cast("int"))
    if sample.select("label").distinct().count() < 2:
        return Classifier(dict.fromkeys(INSULTS, 4.0), -2.0)
    voters = learned_features(sample)
    every = docs.select("text", F.lit(-1).alias("label")).unionByName(sample)
    read = stored(patterns(every, voters))
    votes = stored(read.groupBy("votes", "label").agg(F.sum("n").alias("n")))
    model = label_model(votes, voters.count())
    weights, bias = train(stored(blocks(read, model, voters.count())), len(voters.features))
    own = {name: float(weights[i]) for name, i in voters.features.items() if weights[i] > 0}
    return Classifier(own, bias)


def score(classifier: Classifier) -> Column:
    """The score, 0 to 1, of the column ``text``.

    Each row is scored by its text alone, so repeated rows, ties, null ids and other
    columns make no difference; empty and null texts have the score of no words.
    """

    def of_texts(batches):
        for texts in batches:
            yield pd.Series(list(classifier.scores(texts)), dtype="float64")

    of_texts.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(of_texts, "double")("text")
