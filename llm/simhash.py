"""SimHash near-duplicates, linked by multi-index hashing."""

from __future__ import annotations

from itertools import chain, combinations, islice, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import free_name, stored
from llm.components import components

BITS = 64
SEED = 42
#: Shingles that are counted at a time, which bounds the memory a long text takes.
CHUNK = 1 << 16


def simhash(text: str | None, words: int) -> int:
    """The fingerprint of a text as a signed 64-bit number; null is like empty."""
    split = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return 0
    width = min(words, len(split))
    shingles = map(b" ".join, zip(*(islice(split, i, None) for i in range(width))))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    counts, total = np.zeros(BITS, np.int64), 0
    while len(part := np.fromiter(islice(hashes, CHUNK), np.uint64)):
        bits = part.astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bits, axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, text_key, fp) for each row: its SimHash and a hash of its text.

    Words are runs without ASCII white space, A-Z in lower case. A text with fewer
    words than a shingle is one shingle; empty and null texts have fingerprint 0.
    """

    def of_texts(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(x, words) for x in texts], dtype="int64")

    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    fp = F.pandas_udf(of_texts, "long")("text").alias("fp")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), key, fp)


def balls(parts: int, max_bits: int) -> list[tuple[int, int, list[int]]]:
    """(shift, width, masks) of each segment that needs a search.

    Of fingerprints that differ in at most ``max_bits``, one segment differs in at
    most ``max_bits // parts`` bits; after the first ``max_bits % parts + 1``
    segments, one bit less is enough.
    """
    edges = [BITS * i // parts for i in range(parts + 1)]
    out = []
    for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        radius = max_bits // parts - (i > max_bits % parts)
        flips = chain(*(combinations(range(high - low), r) for r in range(radius + 1)))
        if masks := [sum(1 << b for b in bits) for bits in flips]:
            out.append((low, high - low, masks))
    return out


def links(
    fps: DataFrame, max_bits: int = 2, parts: int = 2, large_bucket: int = 2048
) -> DataFrame:
    """Pairs (a, b), a and b of ``fps`` (fp, distinct), at most ``max_bits`` apart.

    Each fingerprint stands in a table under the value of each segment. Its own
    Hamming ball around that value is looked up there; of two segments the one with
    the smaller value asks, so each pair is found once a segment. Whole fingerprints
    are compared as part of the join. Buckets over ``large_bucket`` fingerprints
    don't form pairs: see ``_links_by_cleared_bits``. Neither way loses a link.
    """
    near = balls(parts, max_bits)
    own = [
        F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        for low, width, _ in near
    ]
    entry = [
        F.struct(F.lit(i).alias("part"), x.alias("key")) for i, x in enumerate(own)
    ]
    table = fps.select("fp", F.explode(F.array(*entry)).alias("at"))
    table = table.select(F.col("fp").alias("other"), "at.part", "at.key")

    def asked(i: int):
        value = own[i]
        keys = F.transform(F.lit(near[i][2]), lambda mask: value.bitwiseXOR(mask))
        return F.transform(
            F.filter(keys, lambda key: key >= value),
            lambda key: F.struct(
                F.lit(i).alias("part"), key.alias("key"), (key > value).alias("moved")
            ),
        )

    probes = fps.select(
        "fp", F.explode(F.concat(*(asked(i) for i in range(len(near))))).alias("at")
    ).select("fp", "at.*")

    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    close = apart.between(1, max_bits) & (F.col("moved") | (F.col("fp") < F.col("other")))
    sizes = table.groupBy("part", "key").count().where(F.col("count") > large_bucket)
    large = stored(sizes.select("part", "key"))
    if large.isEmpty():
        pairs = probes.join(table, ["part", "key"]).where(close)
        return pairs.select(F.col("fp").alias("a"), F.col("other").alias("b"))
    rest = probes.join(large, ["part", "key"], "left_anti")
    pairs = rest.join(table, ["part", "key"]).where(close)
    pairs = pairs.select(F.col("fp").alias("a"), F.col("other").alias("b"))
    crowded = table.withColumnRenamed("other", "fp").unionByName(probes.drop("moved"))
    crowded = crowded.join(large, ["part", "key"], "left_semi").select("fp").distinct()
    return pairs.unionByName(_links_by_cleared_bits(crowded, max_bits))


def _links_by_cleared_bits(fps: DataFrame, max_bits: int) -> DataFrame:
    """All links within ``fps``, without a pair that is no link.

    Fingerprints at most ``max_bits`` apart agree once some ``max_bits`` bits are
    cleared, and at most 2 ** max_bits fingerprints agree on what is left.
    """
    masks = [sum(1 << b for b in x) for x in combinations(range(BITS), max_bits)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    keyed = fps.select("fp", F.explode(F.lit(signed)).alias("mask"))
    left = F.col("fp").bitwiseAND(F.bitwise_not("mask"))
    groups = keyed.groupBy("mask", left.alias("left")).agg(F.collect_set("fp").alias("f"))
    groups = groups.where(F.size("f") > 1).withColumn("a", F.array_min("f"))
    return groups.select("a", F.explode("f").alias("b")).where("a <> b").distinct()


def groups(fingerprinted: DataFrame, max_bits: int = 2) -> DataFrame:
    """(fp, root, doc_id, text_key) for each fingerprint: its group and the group's first row.

    First is the smallest doc_id, null last, then the smallest text_key. Copies are
    one fingerprint here, so they form no links.
    """
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = stored(fingerprinted.groupBy("fp").agg(F.min(first).alias("first")))
    roots = components(links(classes.select("fp"), max_bits))
    roots = roots.withColumnRenamed("node", "fp")
    classes = classes.join(roots, "fp", "left")
    classes = classes.withColumn("root", F.coalesce("root", "fp"))
    heads = classes.groupBy("root").agg(F.min("first").alias("head"))
    found = classes.select("fp", "root").join(heads, "root")
    return found.select("fp", "root", "head.doc_id", "head.text_key")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs`` (doc_id, text, ...).

    component_id is the smallest doc_id that links reach, null where all reached ids
    are null. Repeated rows stay; other columns are ignored; an empty table gives
    an empty result.
    """
    rows = stored(fingerprints(docs, words).select("doc_id", "text_key", "fp"))
    found = groups(rows, max_bits).select("fp", F.col("doc_id").alias("component_id"))
    return rows.join(found, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: its smallest doc_id.

    All columns stay as they are. Of rows with that id, the one with the smallest
    text hash stays; of equal rows, one.
    """
    heads = groups(fingerprints(docs, words), max_bits).select("doc_id", "text_key").distinct()
    own_id, own_key = free_name(docs, "own_id"), free_name(docs, "own_key")
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    marked = docs.withColumns({own_id: F.col("doc_id").cast("long"), own_key: key})
    same = marked[own_id].eqNullSafe(heads["doc_id"]) & (marked[own_key] == heads["text_key"])
    kept = marked.join(heads, same, "left_semi")
    return kept.dropDuplicates([own_id, own_key]).drop(own_id, own_key)
