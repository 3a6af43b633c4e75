"""Language identification: words, scores and paths against plain versions; accuracy."""

import itertools
import random
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import languages
from llm.languages import BUCKETS, LONGEST, Letters, Model
from llm.queries import op13_languages

LETTERS = Letters()
NAMES = languages.script_names()

ENGLISH = "the quick brown fox jumps over the lazy dog while other animals are sleeping in this house".split()
GERMAN = "der schnelle braune fuchs springt über den faulen hund während andere tiere in diesem haus schlafen".split()
RUSSIAN = "быстрая коричневая лиса прыгает через ленивую собаку пока другие животные спят в доме".split()


def plain_words(text):
    """(script, start, letters) of each word of a text."""
    out, last = [], None
    for i, c in enumerate(text):
        code = min(ord(c), languages.CODES)
        script = int(LETTERS.script[code])
        if script:
            if last == script and len(out[-1][2]) < LONGEST:
                out[-1][2].append(int(LETTERS.lower[code]))
            else:
                out.append((script, i, [int(LETTERS.lower[code])]))
        last = script
    return out


def plain_places(letters):
    """The hashed places of a word's n-grams, by length, in order."""
    marked, out = [0, *letters, 0], {n: [] for n in languages.GRAMS}
    for n in languages.GRAMS:
        for i in range(len(marked) - n + 1):
            gram = marked[i : i + n]
            if n == 1 and gram == [0] or 0 in gram[1:-1]:
                continue
            total = 0
            for code in gram:
                total = (total * 0x9E3779B97F4A7C15 + code + 1) % 2**64
            mixed = (total ^ (total >> 29)) * 0xBF58476D1CE4E5B9 % 2**64
            out[n].append(mixed >> 48)
    return out


TEXTS = [
    "", "a", "Hello, World! don't", "ÄÖÜ straße İstanbul", "日本語とkana mixed русский",
    "x" * 100 + " y", "\ud800 lone", "no1digits2here", "\U0001f600 smile \U00020000\U00020001", "тест test тест",
]


def test_words_are_runs_of_a_script():
    words = languages.words_of(TEXTS, LETTERS)
    starts = np.cumsum([0, *map(len, TEXTS)])
    expected = [(i, s, at + starts[i], len(w)) for i, t in enumerate(TEXTS) for s, at, w in plain_words(t)]
    columns = (words.piece, words.script, words.start, words.length)
    assert list(zip(*(c.tolist() for c in columns), strict=True)) == expected
    assert NAMES[plain_words("日本")[0][0]] == "han"


def test_hashed_places_against_plain_ones():
    words = languages.words_of(TEXTS, LETTERS)
    own = [w for t in TEXTS for _, _, w in plain_words(t)]
    bounds = [*words.at.tolist(), len(words.marked) - 1]
    for n, place in zip(languages.GRAMS, languages.hashed(words.marked), strict=True):
        for k, letters in enumerate(own):
            there = place[bounds[k] : bounds[k + 1]].tolist()
            assert [p for p in there if p < BUCKETS] == plain_places(letters)[n]


def test_a_letter_is_what_python_says():
    for code in (*range(0x3000), 0xAC00, 0x4E00, 0x1F600, 0x20001):
        assert (LETTERS.script[code] > 0) == chr(code).isalpha()


@pytest.mark.parametrize("seed", range(30))
def test_best_path_against_all_paths(seed):
    chance = np.random.default_rng(seed)
    scores = np.minimum(chance.normal(-1, 3, (6, 3)), 0)
    scores -= scores.max(1, keepdims=True)
    penalty = [1.0, 3.0, 8.0][seed % 3]

    def total(path):
        changes = sum(a != b for a, b in itertools.pairwise(path))
        return scores[np.arange(6), list(path)].sum() - penalty * changes

    best = max(map(total, itertools.product(range(3), repeat=6)))
    assert total(languages.best_path(scores, penalty)) == pytest.approx(best)
    assert total(languages.viterbi(scores, penalty)) == pytest.approx(best)


def prose(words, n, seed):
    return " ".join(random.Random(seed).choices(words, k=n))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, prose(w, 40, i), lang) for i in range(30) for w, lang in ((ENGLISH, "en"), (GERMAN, "de"), (RUSSIAN, "ru"))]
    rows += [(99, "no language", None), (98, None, "en"), (97, "12", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return languages.fit(docs, F.lit(False))


def test_counts_are_of_all_taught_rows(spark):
    rows = [(1, "aab b", "x"), (2, "ab", "x"), (3, "жж", "y"), (4, "zz", None), (5, "zz", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = languages.fit(docs, F.col("doc_id") == 5)
    assert model.languages == ["x", "y"]
    counts = np.zeros(BUCKETS)
    for word in ("aab", "b", "ab"):
        for places in plain_places([ord(c) for c in word]).values():
            np.add.at(counts, places, 1)
    expected = np.log(counts / counts.sum() + languages.SMOOTHING) / len(languages.GRAMS)
    assert model.scores[:BUCKETS, 0] == pytest.approx(expected, rel=1e-5)
    assert model.may[NAMES.index("latin")].tolist() == [True, False]
    assert model.may[NAMES.index("cyrillic")].tolist() == [False, True]


def test_spans_of_mixed_text(spark, model):
    first, second, third = prose(ENGLISH, 30, 1), prose(GERMAN, 50, 2), prose(RUSSIAN, 9, 3)
    text = f"{first}. {second} -- {third}!"
    df = spark.createDataFrame([(text,)], "text string")
    found = df.select(languages.identified(model).alias("f")).first().f
    assert found.lang == "de"
    spans = [(text[s.start : s.end], s.lang) for s in found.spans]
    assert [lang for _, lang in spans] == ["en", "de", "ru"]
    for (span, _), own in zip(spans, (first, second, third), strict=True):
        assert abs(len(span) - len(own)) < 15
    letters = [sum(c.isalpha() for c in own) for own in (first, second, third)]
    assert found.score == pytest.approx(letters[1] / sum(letters), abs=0.1)


def test_scripts_narrow_candidates(model):
    words = languages.words_of(["the лиса ελλάδα"], LETTERS)
    scores = model.word_scores(words)
    ru = model.languages.index("ru")
    assert scores[0, ru] == -languages.MOST
    assert scores[1, ru] == 0 and (np.delete(scores[1], ru) == -languages.MOST).all()
    assert (scores[2] == 0).all()  # a script of no language says nothing


def test_results_depend_on_the_text_alone(model, monkeypatch):
    texts = [prose(ENGLISH, 30, 5), None, "", prose(GERMAN, 700, 6) + prose(ENGLISH, 400, 7), "1 2", prose(RUSSIAN, 50, 8)]
    monkeypatch.setattr(languages, "CHUNK", 1000)
    together = list(model.results(texts, LETTERS))
    alone = [next(iter(model.results([t], LETTERS))) for t in texts]
    assert together == alone
    assert [r[0] for r in together] == ["en", "und", "und", "de", "und", "ru"]


def test_odd_rows(spark, odd_documents, model):
    found = odd_documents.select("doc_id", "text", languages.identified(model).alias("f")).collect()
    assert len(found) == odd_documents.count()
    for r in found:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.f.lang == "und") == (not letter)
        assert (r.f.score > 0) == letter and r.f.score <= 1
        assert (len(r.f.spans) > 0) == letter
    # Rows without a language teach nothing; then all is unknown.
    none = languages.fit(odd_documents.withColumn("lang", F.lit(None).cast("string")), F.lit(False))
    assert none.languages == []
    assert {r.f.lang for r in odd_documents.select(languages.identified(none).alias("f")).collect()} == {"und"}
    empty = odd_documents.where(F.lit(False))
    assert languages.fit(empty, F.lit(False)).languages == []
    assert empty.select(languages.identified(model).alias("f")).collect() == []


def test_a_language_without_letters_and_ties():
    table = pa.table({"lang": ["b", "a", "a", "b"], "place": [5, 5, BUCKETS + 2, BUCKETS + 2], "n": [3, 3, 9, 9]})
    tied = Model.of(table)
    assert tied.languages == ["a", "b"]
    assert next(iter(tied.results(["word"], LETTERS)))[0] == "a"


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op13_languages(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    right = 0
    for r in found:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        right += r.held_out and r.lang_pred == docs[r.doc_id].lang
    assert right >= 0.99 * sum(r.held_out for r in found)
