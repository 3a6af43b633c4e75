"""Lattice likelihood against brute force over all segmentations."""

import random
from collections import Counter
from math import exp, log, log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import lattice
from llm.common import held_out

PATH = lattice.vocabulary_path()


@pytest.fixture(scope="module")
def pieces():
    return lattice.Lattice.load(PATH)


def ways(own, word):
    """Each segmentation as (pieces, log probability)."""
    known = {p: i for i, p in enumerate(own.pieces) if p}

    def go(at):
        if at == len(word):
            yield [], 0.0
        for end in range(at + 1, len(word) + 1):
            part = word[at:end]
            if part in known:
                used = [known[part]]
            elif end == at + 1:
                used = own.spelled(ord(part))
            else:
                continue
            for rest, weight in go(end):
                yield used + rest, weight + sum(own.logs[i] for i in used)

    return list(go(0))


WORDS = ["the", "thereouon", "a", "é", "日本ü語", "x\U0001f600y", "aaaaaaa", "tion,tion", "▁", "zq"]


def test_probabilities(pieces):
    found = pieces.log_probabilities([w.encode() for w in WORDS])
    for word, value in zip(WORDS, found, strict=True):
        assert value == pytest.approx(log(sum(exp(w) for _, w in ways(pieces, "▁" + word))))


def test_expected_counts(pieces):
    counts = np.arange(1, len(WORDS) + 1)
    sums = np.zeros(len(pieces.logs))
    pieces.add_expected([w.encode() for w in WORDS], counts, sums)
    expected = np.zeros(len(pieces.logs))
    for word, n in zip(WORDS, counts, strict=True):
        every = ways(pieces, "▁" + word)
        total = sum(exp(w) for _, w in every)
        for used, weight in every:
            for piece in used:
                expected[piece] += n * exp(weight) / total
    assert sums == pytest.approx(expected)


def test_sums_without_logs_equal_those_with(pieces, monkeypatch):
    rng = random.Random(5)
    signs = "abcdefgheiou-\u00e9\u65e5\U0001f600"
    words = ["".join(rng.choices(signs, k=rng.randint(1, 70))).encode() for _ in range(400)]
    words += ["\U0001f600".encode() * n for n in (5, 20, 63, 64)]  # too unlikely without
    counts = np.array([rng.randint(1, 9) for _ in words])

    def found():
        sums = np.zeros(len(pieces.logs))
        pieces.add_expected(words, counts, sums)
        return sums, pieces.log_probabilities(words)

    by_plain, plain = found()
    monkeypatch.setattr(lattice, "PLAIN_SIZE", 0)
    by_logs, logs = found()
    assert by_plain == pytest.approx(by_logs, rel=1e-9) and by_logs.sum() > 0
    assert plain == pytest.approx(logs, rel=1e-12)
    assert plain.min() < np.log(lattice.LEAST_PLAIN)


def test_likely_words_are_summed_without_logs(pieces, monkeypatch):
    words = [b"the", b"thereupon", "\u00e9t\u00e9".encode()]
    monkeypatch.setattr(lattice, "_log_sum", lambda terms: pytest.fail("it took logs"))
    assert (pieces.log_probabilities(words) < 0).all()
    pieces.add_expected(words, np.ones(3), np.zeros(len(pieces.logs)))


def test_small_batches_are_joined(monkeypatch):
    monkeypatch.setattr(lattice, "WORDS_AT_ONCE", 5)
    made = [pa.RecordBatch.from_pydict({"n": [i, i]}) for i in range(7)]
    larger = list(lattice._larger(iter(made)))
    assert [b.num_rows for b in larger] == [6, 6, 2]
    assert [n for b in larger for n in b.column(0).to_pylist()] == [i for i in range(7) for _ in "xx"]
    assert not list(lattice._larger(iter([])))


def test_a_very_long_word(pieces):
    word = b"reallylongword" * 3_000
    one = pieces.log_probabilities([word[:14_000]])[0]
    two = pieces.log_probabilities([word[:28_000]])[0]
    assert np.isfinite(two)
    assert two == pytest.approx(2 * one, rel=0.01)


def test_shared_slots(pieces, monkeypatch):
    words = [p.lstrip("▁").encode() or b"x" for p in pieces.pieces if p][::37]
    expected = pieces.log_probabilities(words)
    monkeypatch.setattr(lattice, "SLOT_BITS", 16)
    crowded = lattice.Lattice(pieces.pieces, pieces.bytes_at, pieces.logs)
    assert len(crowded.others) > 100
    assert crowded.log_probabilities(words) == pytest.approx(expected)


def test_rounds_raise_the_likelihood(spark, pieces):
    words = [(w.encode(), 9_000) for w in "thereouon ouon tion thtion erouon".split()]
    df = spark.createDataFrame([*words, (b"", 9_000)], "word binary, n long")
    own = [w for w, _ in words]
    n = np.array([n for _, n in words])
    before = -1e9
    for rounds in range(4):
        now = lattice.learned(df, pieces, rounds)
        assert np.exp(now.logs).sum() == pytest.approx(1)
        likely = (now.log_probabilities(own) * n).sum() + 9_000 * now.logs[-1]
        assert likely > before
        before = likely


def made(n, seed):
    chance = random.Random(seed)
    frequent, parts = ["the", "of", "and"], ["th", "er", "on", "ou", "tion", "é"]
    rows = []
    for i in range(n):
        size = chance.choice([0, 1, 5, 80])
        words = [
            chance.choice(frequent) if chance.random() < 0.5 else "".join(chance.choices(parts, k=4))
            for _ in range(size)
        ]
        rows.append((i, " ".join(words).title()))
    return rows


@pytest.mark.parametrize("share", [1 / (1 << 19), 1 / 50, 2.0])
def test_scores(spark, documents, monkeypatch, share):
    """The same whatever words travel: none, the rare ones, or all."""
    monkeypatch.setattr(lattice, "SENT_SHARE", share)
    monkeypatch.setattr(lattice, "COUNTED_WORDS", 50)
    rows = [*made(120, 2), (500, None), (501, "the the  Ünï")]
    out = held_out(F.col("doc_id"), 7, 2)
    found = lattice.score(documents(rows), ~out, out, PATH).collect()
    held = {r.doc_id: r.held_out for r in found}
    split = {i: (t or "").encode().lower().split() for i, t in rows}
    counts = Counter()
    for i, words in split.items():
        if not held[i]:
            counts.update([*words, b""])
    total, kinds = sum(counts.values()), len(counts)
    words = spark.createDataFrame([(w, n) for w, n in counts.items()], "word binary, n long")
    own = lattice.learned(words, lattice.Lattice.load(PATH))
    once = sum(n == 1 for n in counts.values())
    whole = min(0.999, 1 - once / total)
    assert len(found) == len(rows)
    for row in found:
        tokens = [*split[row.doc_id], b""]
        base = sum(log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)
        alone = [own.log_probabilities([w])[0] if w else own.logs[-1] for w in tokens]
        both = [log10((1 - whole) * exp(a) + whole * counts[w] / total) for a, w in zip(alone, tokens, strict=True)]
        assert (row.n_tokens, row.train_tokens) == (len(tokens), total)
        assert row.n_known == sum(counts[w] > 0 for w in tokens)
        assert row.base_score == pytest.approx(base)
        assert row.pieces_score == pytest.approx(sum(alone) / log(10))
        assert row.score == pytest.approx(sum(both))


def test_odd_rows_and_none(odd_documents):
    out = held_out(F.col("doc_id"), 7, 2)
    found = lattice.score(odd_documents, ~out, out, PATH).collect()
    assert len(found) == odd_documents.count()
    assert sorted(r.n_tokens for r in found if r.doc_id in (2, 3, 4)) == [1, 1, 1]
    assert lattice.score(odd_documents.where(F.lit(False)), ~out, out, PATH).collect() == []
