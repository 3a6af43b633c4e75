"""The registered queries' columns against brute force on a small table."""

import math
import re
from collections import Counter
from struct import pack
from zlib import crc32

import pytest
import xxhash
from tokenizers import Tokenizer

from llm import decontamination, packing, queries

SF_DIR = "/root/testdata/sf0.01"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def remainder(doc_id, folds):
    return crc32(str(doc_id).encode()) % folds


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}


def fingerprint(text):
    words = SPACES.findall(lowered(text))
    if not words:
        return 0
    width = min(3, len(words))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op1(spark, docs):
    prints = {i: fingerprint(r.text) for i, r in docs.items()}
    component = {i: i for i in docs}

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    distinct = sorted(set(prints.values()))
    first = {}
    for i, fp in sorted(prints.items()):
        first.setdefault(fp, i)
        component[i] = first[fp]
    for n, a in enumerate(distinct):
        for b in distinct[n + 1 :]:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((root(first[a]), root(first[b])))
                component[y] = x
    expected = sorted((i, f"{prints[i]:016x}", root(i)) for i in docs)
    assert sorted(tuple(r)[:3] for r in queries.op1_simhash(spark, SF_DIR).collect()) == expected


@pytest.mark.parametrize(
    ("query", "name", "folds", "fold"), [("op2_toxicity", "toxic", 5, 0), ("op7_quality", "quality", 3, 1)]
)
def test_op2_and_op7(spark, docs, labels, query, name, folds, fold):
    found = queries.QUERIES[query](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    right, by_text = [], {}
    for r in found:
        assert r.held_out == (remainder(r.doc_id, folds) == fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert by_text.setdefault(docs[r.doc_id].text, r.score) == r.score
        if r.held_out and r.doc_id in labels:
            right.append(r.predicted == labels[r.doc_id][name])
    assert sum(right) >= 0.93 * len(right) > 50


def test_op4(spark, docs):
    """Texts that hold an item whole are found with it; items that are found share
    enough words in order with the text, and their answer."""
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    items = {r.item_id: decontamination.words_of(r.text) for r in benchmark}
    found = queries.op4_decontamination(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    planted = 0
    for r in found:
        words = decontamination.words_of(docs[r.doc_id].text)
        joined = b" %s " % b" ".join(words)
        whole = {i for i, own in items.items() if b" %s " % b" ".join(own) in joined}
        planted += len(whole)
        assert whole <= set(r.item_ids) and r.item_ids == sorted(r.item_ids)
        assert r.contaminated == bool(r.item_ids)
        assert r.common == 1.0 if whole else r.common < 1 or r.item_ids
        for i in set(r.item_ids) - whole:
            assert decontamination.common_words(items[i], words) >= decontamination.LEAST_COMMON * len(items[i])
    assert planted > 20


def test_op5(spark, docs):
    tokens = {i: SPACES.findall(lowered(r.text)) + [None] for i, r in docs.items()}
    counts = Counter(t for i, own in tokens.items() if remainder(i, 7) != 2 for t in own)
    total, kinds = counts.total(), len(counts)
    found = queries.op5_lattice(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    for r in found:
        own = tokens[r.doc_id]
        base = sum(math.log10((counts[t] + 1) / (total + (kinds + 1))) for t in own)
        assert r.held_out == (remainder(r.doc_id, 7) == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[t] > 0 for t in own), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0


def test_op6(spark, docs):
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    expected = set()
    for i, r in docs.items():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 4096):
            own = ids[at : at + 4096]
            expected.add((i, at // 4096, at, len(own), crc32(pack(f"<{len(own)}I", *own))))
    found = queries.op6_packing(spark, SF_DIR).collect()
    assert len(found) == len(expected)
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found} == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) <= 1.01 * math.ceil(sum(x[3] for x in expected) / 4096) + 1
