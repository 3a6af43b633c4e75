"""Packing: ids, cuts, slots and plan."""

import random
import struct
from pathlib import Path
from zlib import crc32

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import packing

VOCABULARY = packing.vocabulary_path()


def test_ids_are_the_vocabulary_s():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = [
        "a b.c's don't 12,5 Ünïcode İstanbul ΣΑΣ ΣΑΣ. <|endoftext|> x<|endoftext|>.",
        "é é .́ a b　c ,,. .", "", "   ", "\n\na\tb\r\n", "ﬁ ﬀ ǅ ª º.",
        "日本語。テスト, 한국어.", "of%%% \"quoted\" (in) [x] a_b wörter!! ÉCOLE. I'M they're", "\x00 \x85 x",
    ]
    for text, found in zip(texts, packing.WordIds(tokenizer).encode(texts), strict=True):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(found) // 4}I", found)) == ids, text


def test_cache_may_run_over(monkeypatch):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = [f"word{i} other{i % 7}. again" for i in range(40)]
    whole = list(packing.WordIds(tokenizer).encode(texts))
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    monkeypatch.setattr(packing, "SIGNS", 30)
    assert list(packing.WordIds(tokenizer).encode(texts)) == whole


def test_tasks_need_no_vocabulary_file(spark, documents, tmp_path):
    docs = documents([(1, "the first text"), (2, None)])
    whole = packing.tokenised(docs, VOCABULARY).collect()
    own = tmp_path / "vocabulary.json"
    own.write_bytes(Path(VOCABULARY).read_bytes())
    found = packing.tokenised(docs, str(own))
    own.unlink()
    assert sorted(found.collect()) == sorted(whole)


def slots_of(plan):
    for length, first, last, each, sequence, offset in plan:
        for rank in range(first, last):
            at = rank - first
            yield length, rank, sequence + at // each, offset + at % each * length


@pytest.mark.parametrize("seed", range(60))
def test_plan_fills_without_gaps(seed):
    chance = random.Random(seed)
    sizes = range(1, 51)
    counts = {chance.choice(sizes): chance.randint(1, 60) for _ in range(chance.randint(0, 25))}
    ranks, used = {}, {}
    for length, rank, sequence, offset in slots_of(packing.plan(counts, 50)):
        ranks.setdefault(length, []).append(rank)
        used.setdefault(sequence, []).append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 50
    assert len(used) <= best_fit(counts, 50)
    assert sorted(used) == list(range(len(used)))


def best_fit(counts, capacity):
    """Best-fit decreasing, one piece after the other."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [i for i, room in enumerate(rooms) if room >= length]
            if fits:
                rooms[min(fits, key=rooms.__getitem__)] -= length
            else:
                rooms.append(capacity - length)
    return len(rooms)


def check(df, texts, capacity):
    """Every token of every text once, in place."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = df.collect()
    expected, used = [], {}
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            expected.append((doc_id or -1, piece, at, len(own), crc32(struct.pack(f"<{len(own)}I", *own))))
    found = [(r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(found) == sorted(expected)
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(used), sum(r.length for r in rows)


def test_pack(documents):
    chance = random.Random(9)
    words = "alpha beta, gamma. Delta Épsilon 42 zeta".split()
    texts = [(i, " ".join(chance.choices(words, k=chance.choice([0, 3, 3, 3, 50, 400])))) for i in range(300)]
    used, tokens = check(packing.pack(documents(texts), VOCABULARY, 64), texts, 64)
    assert used <= 1.02 * tokens / 64 + 1


def test_odd_rows(odd_documents):
    texts = [(r.doc_id, r.text) for r in odd_documents.collect()]
    check(packing.pack(odd_documents, VOCABULARY), texts, 4096)


def test_alike_rows_spread(spark, documents):
    """Most pieces are alike in all columns: their ranks come from many slices."""
    adaptive = "spark.sql.adaptive.enabled"
    docs = documents([(None, "the same text") if i % 5 else (i, "the same text") for i in range(3000)])
    pieces = packing.tokenised(docs.repartition(4), VOCABULARY)
    try:
        spark.conf.set(adaptive, "false")
        found = packing.packed(pieces, 64).select("sequence_id", "offset", "length").collect()
    finally:
        spark.conf.unset(adaptive)
    assert len({(r.sequence_id, r.offset) for r in found}) == 3000
    length = found[0].length
    assert len({r.sequence_id for r in found}) == -(-3000 // (64 // length))
    rows = spark.range(3000).select(F.pmod(F.xxhash64("id"), F.lit(16)).alias("slice"))
    sizes = sorted(r["count"] for r in rows.groupBy("slice").count().collect())
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_no_rows(odd_documents):
    assert packing.pack(odd_documents.where(F.lit(False)), VOCABULARY).collect() == []


def test_sequences_can_be_rebuilt(documents):
    """The ids themselves come out, also of repeated rows and ids with several texts."""
    texts = [(1, "alpha beta. " * 40), (1, "alpha beta. " * 40), (1, "gamma, delta"), (None, "x"), (2, None), (3, "")]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = packing.pack(documents(texts), VOCABULARY, 64).collect()
    expected, sequences = [], {}
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        expected += [(doc_id or -1, at, ids[at : at + 64]) for at in range(0, len(ids), 64)]
    found = []
    for r in sorted(rows, key=lambda r: r.offset):
        ids = list(struct.unpack(f"<{r.length}I", r.ids))
        found.append((r.doc_id or -1, r.start, ids))
        sequence = sequences.setdefault(r.sequence_id, [])
        assert len(sequence) == r.offset
        sequence += ids
    assert sorted(found) == sorted(expected)
    assert max(map(len, sequences.values())) <= 64
