"""Toxicity: the parts of the label model, and held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import toxicity
from llm.common import held_out, labelled_sample

LABELS = "doc_id long, toxic int"


def corpus(n, seed):
    """Texts of neutral words; toxic ones have insults or made-up words of two stems."""
    chance = random.Random(seed)
    neutral = [f"neutral{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    insults = ["idiot", "moron", "trash", "zorbqui", "zorbtat", "zorblem", "kvanpla", "kvansor"]
    rows, labels = [], []
    for i in range(n):
        words = chance.choices(neutral, k=chance.choice([8, 40, 200]))
        toxic = int(i % 6 == 0)
        for _ in range(toxic * (1 + len(words) // 40)):
            words.insert(chance.randrange(len(words)), chance.choice(insults))
        rows.append((i, " ".join(words)))
        if i % 3 < 2:
            labels.append((i, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark, documents):
    rows, labels = corpus(900, 1)
    docs, labels = documents(rows), spark.createDataFrame(labels, LABELS)
    return docs, toxicity.fit(docs, labels, held_out(F.col("doc_id"), 5, 0))


def test_held_out_accuracy(fitted, spark):
    docs, model = fitted
    found = docs.withColumn("s", toxicity.score(model)).collect()
    right = [(r.s >= 0.5) == (r.doc_id % 6 == 0) for r in found]
    assert sum(right) >= 0.98 * len(right)
    assert all(0 <= r.s <= 1 for r in found)
    rows, _ = corpus(300, 2)
    scores = list(model.scores([t for _, t in rows]))
    assert sum((s >= 0.5) == (i % 6 == 0) for (i, _), s in zip(rows, scores, strict=True)) >= 290


def test_a_clean_text_of_any_size_is_clean(fitted):
    clean = " ".join(f"neutral{chr(97 + i % 26)}b" for i in range(20_000))
    assert list(fitted[1].scores([clean, "", None]))[0] < 0.5


def test_held_out_labels_teach_nothing(spark, documents):
    rows, labels = corpus(200, 3)
    out = held_out(F.col("doc_id"), 5, 0)
    turned = spark.createDataFrame(labels, LABELS)
    turned = turned.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    docs = documents(rows)
    one = toxicity.fit(docs, spark.createDataFrame(labels, LABELS), out)
    two = toxicity.fit(docs, turned, out)
    assert one.weights == pytest.approx(two.weights, abs=1e-9)
    assert one.bias == pytest.approx(two.bias, abs=1e-9)


def test_label_model_finds_accuracies_and_copies():
    """Three voters of known accuracy, and one that repeats the first."""
    chance = np.random.default_rng(0)
    truth = chance.random(20_000) < 0.3
    votes = np.stack([np.where(chance.random(len(truth)) < p, truth, ~truth) for p in (0.9, 0.8, 0.7)], 1)
    votes = np.hstack([votes, votes[:, :1]]).astype(float)
    ones = np.hstack([np.ones((len(truth), 1)), votes])
    sums = np.stack([(ones * w[:, None]).T @ ones for w in (~truth, truth)])
    model = toxicity.LabelModel.of(sums)
    assert model.prior == pytest.approx(0.3, abs=0.02)
    assert model.fires[1] == pytest.approx([0.9, 0.8, 0.7, 0.9], abs=0.02)
    assert model.discount[[0, 3]] == pytest.approx([0.5, 0.5], abs=0.03)
    assert model.discount[[1, 2]].min() > 0.9
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.9


def test_lexicon_takes_the_stem(spark):
    rows = [(f"zorbqui{x} plain words", 1) for x in "abcdefgh"] + [("plain words", 0)] * 30
    sample = spark.createDataFrame(rows, "text string, label int")
    voters = toxicity.learned_features(sample)
    assert voters.learned == 1
    assert list(voters.features)[0] == "zor*"
    assert {"zor*", "zorb*", "zorbq*", "zorbqu*", "idiot"} <= set(voters.features)
    assert not {"plain", "words"} & set(voters.features)


def test_votes():
    voters = toxicity.Voters({"zor*": 0, "bad": 1, "zorba": 2, "idiot": 3}, 2)
    vote, found = voters.read({"zorba", "zorro", "bad", "fine"}, {})
    assert np.frombuffer(found, "<u2").tolist() == [0, 0, 1, 2]
    assert vote == 0b11 | 0b01110 << 2  # two and three marked words, one in 50
    vote, found = voters.read({"idiot"}, {})
    assert (vote, found) == (0b10001 << 2, b"\x03\x00")  # an insult; none of the lexicon
    assert voters.read(set(), {})[0] == 0b10000 << 2


def test_patterns_are_weighed_rows(spark):
    voters = toxicity.Voters({"bad": 0}, 1)
    rows = [("bad day", -1)] * 500 + [("bad bad night", -1)] * 3 + [("bad day", 1), (None, -1)]
    found = toxicity.patterns(spark.createDataFrame(rows, "text string, label int"), voters).collect()
    assert sorted((len(r.features) // 2, r.label, r.n) for r in found) == [(0, -1, 1), (1, -1, 503), (1, 1, 1)]


@pytest.fixture(scope="module")
def trained(spark):
    """Weighed rows of features with targets, and what training makes of them."""
    chance = np.random.default_rng(4)
    truth = np.array([2.0, 1.0, 0.0, 0.0, 3.0])
    rows = []
    for _ in range(300):
        own = sorted(chance.integers(0, 5, chance.integers(0, 4)).tolist())
        odds = truth[own].sum() - 2
        rows.append((own, float(1 / (1 + np.exp(-odds))), float(chance.integers(1, 20))))
    binary = []
    for part in (rows[:100], rows[100:]):
        arrays = (
            np.array([x for r in part for x in r[0]], "<u2"), np.array([len(r[0]) for r in part], np.int64),
            np.array([r[1] for r in part]), np.array([r[2] for r in part]),
        )
        binary.append(tuple(bytearray(x.tobytes()) for x in arrays))
    df = spark.createDataFrame(binary, "features binary, sizes binary, target binary, n binary")
    return rows, toxicity.train(df.coalesce(1), 5, 100)


def test_training_against_plain_gradients(trained):
    rows, (weights, bias) = trained
    total = sum(n for _, _, n in rows)
    slope, level = toxicity.PULL * weights, 0.0
    for own, target, n in rows:
        error = n / total * (1 / (1 + np.exp(-(weights[own].sum() + bias))) - target)
        np.add.at(slope, own, error)
        level += error
    # At the minimum, what is over zero has no slope, what is zero is pushed down.
    assert level == pytest.approx(0, abs=1e-4)
    assert slope[weights > 0] == pytest.approx(0, abs=1e-4)
    assert (slope[weights == 0] >= -1e-4).all()
    assert weights == pytest.approx([2, 1, 0, 0, 3], abs=0.2)


def test_all_documents_teach(spark, documents):
    """An insult that only stands beside known ones, in texts without a label, gets a
    say by their posterior labels."""
    rows, labels = corpus(300, 5)
    more = [(10_000 + i, f"vermin idiot moron neutral{chr(97 + i % 26)}a") for i in range(300)]
    labels = spark.createDataFrame(labels, LABELS)
    assert "vermin" not in toxicity.fit(documents(rows), labels, F.lit(False)).weights
    assert toxicity.fit(documents(rows + more), labels, F.lit(False)).weights["vermin"] > 0.5


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_sample_is_bounded_by_rows(spark, documents, name):
    """A third of the rows have one labelled id; some are copies, some are not."""
    rows = [(i, f"text {i}") for i in range(400)] + [(7, "copy")] * 100 + [(7, f"own {i}") for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 400, 3)] + [(7, 1)], f"doc_id long, {name} int")
    found = labelled_sample(documents(rows), labels, name, F.lit(False), 1000).collect()
    assert len(found) == len({(r.text, r.label) for r in found}) == 134 + 1 + 1 + 100
    few = labelled_sample(documents(rows), labels, name, F.col("doc_id") != 7, 20)
    assert few.count() == 20
    again = labelled_sample(documents(rows[::-1]), labels, name, F.col("doc_id") != 7, 20)
    assert sorted(few.collect()) == sorted(again.collect())


def test_hot_labelled_id(spark, documents):
    """Half of the rows are one labelled text; the rest is judged as without them."""
    rows, labels = corpus(300, 8)
    hot = [(1, rows[1][1])] * 300
    model = toxicity.fit(documents(rows + hot), spark.createDataFrame(labels, LABELS), F.lit(False))
    right = [(s >= 0.5) == (i % 6 == 0) for (i, _), s in zip(rows, model.scores([t for _, t in rows]), strict=True)]
    assert sum(right) >= 0.97 * len(right)


def test_odd_rows(odd_documents, spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (6, None), (77, 1)], LABELS)
    out = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(odd_documents, labels, out)
    found = odd_documents.select("doc_id", "text", toxicity.score(model).alias("s")).collect()
    assert len(found) == odd_documents.count()
    assert len({r.s for r in found if not (r.text or "").strip()}) == 1
    assert len({r.s for r in found if (r.text or "").startswith("one two")}) == 1


def test_no_rows_and_no_labels(odd_documents, spark, documents):
    none, empty = odd_documents.where(F.lit(False)), spark.createDataFrame([], LABELS)
    out = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(none, empty, out)
    assert none.select(toxicity.score(model)).collect() == []
    model = toxicity.fit(documents([(1, "you idiot"), (2, "good day")]), empty, out)
    assert [s >= 0.5 for s in model.scores(["you idiot", "good day"])] == [True, False]
