"""The manifest against a tree made in plain Python."""

import hashlib
from zlib import crc32

import duckdb
import pytest
from pyspark.sql import functions as F

from llm import merkle
from llm.queries import OP12_SQL, op12_merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, more=0):
    n = None if row.n_chars is None else row.n_chars + more
    return h(*map(encoded, (row.doc_id, row.source, row.lang, n, row.text)))


def grown(nodes, fanout):
    """The top, and of each node the siblings left and right, level by level."""
    paths, levels = [[] for _ in nodes], [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        for i, path in enumerate(paths):
            at = i // fanout ** (len(levels) - 1)
            start = at - at % fanout
            path.append(("".join(now[start:at]), "".join(now[at + 1 : start + fanout])))
        levels.append([h(*now[i : i + fanout]) for i in range(0, len(now), fanout)])
    return levels[-1][0], paths


def brute(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of all rows, sorted."""
    groups = {}
    for row in rows:
        groups.setdefault(row.lang, []).append(row)
    first = lambda x: (x is not None, x)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (*first(r.doc_id), leaf_of(r)))
        trees[lang] = grown([leaf_of(r) for r in groups[lang]], fanout)
    root, above = grown([trees[lang][0] for lang in langs], fanout)
    out = []
    for lang, upper in zip(langs, above, strict=True):
        for row, lower in zip(groups[lang], trees[lang][1], strict=True):
            path = [*lower, *upper]
            more = row.doc_id is not None and crc32(str(row.doc_id).encode()) % 7 == 0
            node = leaf_of(row, int(more))
            for left, right in path:
                node = h(left, node, right)
            proof = h(*(x for step in path for x in step))
            out.append((row.doc_id, leaf_of(row), trees[lang][0], root, proof, node, node == root))
    return sorted(out, key=str)


def test_query_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = [tuple(r) for r in op12_merkle(spark, sf_dir).collect()]
    assert sorted(found, key=str) == brute(rows)
    assert {r[-1] for r in found} == {True, False}


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Nulls in all columns, repeated rows and ids, one language with most rows."""
    rows = [(i * 3 % 101, f"text {i}", "en", f"src{i % 3}", i) for i in range(101)]
    rows += [(5, "again", "de", None, None)] * 40 + [(5, "again", "de", None, 7)] * 3
    rows += [(None, "no id", "de", "x", 1), (None, None, None, None, None), (7, "", "", "", 0)]
    rows += [(8, "naïve 日本語 \U0001f600", "ä", "b:1", -4), (9, "x" * 300_000, "z", "-", 2**63 - 1)]
    rows += [(-3, "one", "日", "s", 1), (4, None, None, "s", None)]
    folder = str(tmp_path_factory.mktemp("odd"))
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = {c: F.lit(1) for c in ("key", "place", "size", "digest", "path", "row", "leaf", "order")}
    docs.withColumns(clashing).repartition(5).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_odd_rows(spark, odd):
    rows = spark.read.parquet(f"{odd}/documents.parquet").collect()
    found = [tuple(r) for r in op12_merkle(spark, odd).collect()]
    assert sorted(found, key=str) == brute(rows)


def test_sql_says_the_same(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet").where("n_chars is null or n_chars < 1000")
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").collect()
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text text, lang text, source text, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", [tuple(r) for r in rows])
    assert sorted(con.execute(OP12_SQL).fetchall(), key=str) == brute(rows)


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (3, 2), (2, 5)])
def test_other_shapes(spark, odd, fanout, levels):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    found = merkle.manifest(docs, {"doc_id": F.col("doc_id")}, fanout=fanout, levels=levels)
    found = found.withColumn("folded", merkle.folded(F.col("leaf"), F.col("path")))
    seen = [tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "folded").collect()]
    expected = [(*r[:4], r[3]) for r in brute(docs.collect(), fanout)]
    assert sorted(seen, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 16, 17, 33])
def test_sizes(spark, tmp_path, n):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in op12_merkle(spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == (brute(docs.collect()) if n else [])


def test_places_of_a_hot_key_spread(spark):
    """Half of the rows are alike: no task of the sort gets much more than its share."""
    rows = spark.range(4000).selectExpr("'k' as key", "if(id < 2000, 1, id) as o")
    found = merkle.placed(rows.repartition(4), "key", ["o"])
    assert sorted(r.place for r in found.collect()) == list(range(4000))
    assert {r["size"] for r in found.collect()} == {4000}
