"""Bottom-k sketches of word shingles, in DataFrame functions only."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import partitions, stored

WORDS = 5
SIZE = 128
SPLIT = r"[\x20\x09-\x0D]+"


def sketch(text: Column, words: int = WORDS, size: int = SIZE) -> Column:
    """The ``size`` smallest distinct hashes of a text's shingles, in order.

    A shingle is ``words`` lower-cased words; a text with fewer is one shingle; a
    null text or one without words has an empty sketch.
    """
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), SPLIT)
    hashes = F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        last = F.size(h) - words
        joined = lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(words)))
        whole = F.array(F.xxhash64(F.array_join(F.transform(h, F.hex), " ")))
        none = F.array().cast("array<bigint>")
        return (
            F.when(F.size(h) == 0, none)
            .when(last < 0, whole)
            .otherwise(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), joined))
        )

    return smallest(_let(hashes, shingles), size)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def smallest(hashes: Column, size: int = SIZE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    """The sketch of two texts' joint shingles, from their sketches."""
    return smallest(F.concat(a, b), size)


def merge_groups(parts: DataFrame, by: list[str], size: int = SIZE) -> DataFrame:
    """(by, sketch): one sketch for each group of ``parts`` (by, sketch, ...).

    A group of empty or null sketches has an empty one. Hashes are made distinct
    and cut to ``size`` a task before they meet, so a large group is no burden.
    """
    hashes = parts.select(*by, F.explode("sketch").alias("hash")).distinct()
    first = Window.partitionBy(*by).orderBy("hash")
    hashes = hashes.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= size)
    found = hashes.groupBy(*by).agg(F.sort_array(F.collect_list("hash")).alias("sketch"))
    keys = parts.select(*by).distinct()
    same = [keys[c].eqNullSafe(found[c]) for c in by]
    joined = keys.join(found, same, "left").select(*(keys[c] for c in by), "sketch")
    empty = F.array().cast("array<bigint>")
    return joined.withColumn("sketch", F.coalesce("sketch", empty))


def distinct_shingles(s: Column, size: int = SIZE) -> Column:
    """Estimated count of distinct shingles: exact below ``size``."""
    share = (F.element_at(s, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    full = F.lit(size - 1.0) / share
    return F.when(F.size(s) < size, F.size(s).cast("double")).otherwise(full)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated Jaccard likeness, 0 to 1; 1 for two empty sketches."""
    union = merged(a, b, size)
    common = F.size(F.array_intersect(F.array_intersect(a, b), union))
    both = F.size(union)
    return F.when(both == 0, F.lit(1.0)).otherwise(common / F.greatest(both, F.lit(1)))


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1; 1 for an empty a."""
    union = distinct_shingles(merged(a, b, size), size)
    shared = resemblance(a, b, size) * union
    share = F.least(F.lit(1.0), shared / distinct_shingles(a, size))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(share)


def as_text(s: Column) -> Column:
    """The hashes of a sketch as 16 hex digits each."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(doc_id, text, next_text, sketch, next_sketch) of each row.

    Next is the row that follows by descending doc_id (null ids come last, ties in
    order of hashes of the text), the first one after the last. Rows are dealt to
    ranges in that order, each of which is one window and gets the first row of the
    next range as its end. An id, or the lack of one, that more rows share than a
    range should hold is several ranges, by hash. Of that many equal rows one is
    placed; the others are each followed by its like, so they need no window. Null
    texts are empty; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * partitions(spark)
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    docs = docs.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    keys = stored(docs.groupBy("doc_id", "h1", "h2").agg(F.count("*").alias("n")))
    share = (keys.agg(F.sum("n")).first()[0] or 0) // buckets + 1
    # More rows than a share: at most as many keys, and ids, as buckets.
    copies = keys.where(F.col("n") > share)
    kept = F.least("n", F.lit(share))
    crowded = keys.groupBy("doc_id").agg(F.sum(kept).alias("n")).where(F.col("n") > share)
    parts = [(r.doc_id, r.n // share + 1) for r in crowded.collect()]
    percents = [i / buckets for i in range(1, buckets)] or [0.5]
    accuracy = max(10_000, 10 * buckets)
    bounds = keys.agg(F.percentile_approx("doc_id", percents, accuracy)).first()[0] or []
    # A crowded id is a range of its own.
    apart = [b for i, _ in parts if i is not None for b in (i - 1, i) if b >= -(2**63)]
    bounds = sorted({*bounds, *apart})
    parts = F.broadcast(spark.createDataFrame(parts, "crowded long, parts long"))

    def dealt(rows: DataFrame) -> DataFrame:
        rows = rows.join(parts, rows["doc_id"].eqNullSafe(parts["crowded"]), "left")
        height = F.col("h1").cast("double") / F.lit(2.0**64) + 0.5
        part = F.least(F.floor(height * F.col("parts")), F.col("parts") - 1)
        bucket = F.coalesce(part, F.lit(0)) - _bucket(F.col("doc_id"), bounds) * F.lit(1 << 32)
        return rows.withColumn("bucket", bucket).drop("crowded", "parts")

    order = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("down"), "h1", "h2")
    heads = dealt(keys).groupBy("bucket").agg(F.min(order).alias("head")).collect()
    heads.sort()  # one row a bucket
    after = [
        (x.bucket, None if y.head.none else ~y.head.down, y.head.h1, y.head.h2)
        for x, y in zip(heads, heads[1:] + heads[:1], strict=True)
    ]
    plan = F.broadcast(spark.createDataFrame(after, "bucket long, of long, h1_ long, h2_ long"))
    first = docs["doc_id"].eqNullSafe(plan["of"]) & (docs.h1 == plan.h1_) & (docs.h2 == plan.h2_)
    ends = docs.join(plan, first).groupBy("bucket", "doc_id", "h1", "h2")
    ends = ends.agg(F.first("text").alias("text")).withColumn("end", F.lit(True))

    many = F.broadcast(copies.toDF("id", "h1_", "h2_", "n"))
    alike = docs["doc_id"].eqNullSafe(many["id"]) & (docs.h1 == many.h1_) & (docs.h2 == many.h2_)
    ones = docs.join(many, alike).groupBy("doc_id", "h1", "h2", "n").agg(F.first("text").alias("text"))
    rest = docs.join(many, alike, "left_anti").unionByName(ones.drop("n"))
    rows = dealt(rest).withColumn("end", F.lit(False)).unionByName(ends)
    rows = rows.repartitionByRange(partitions(spark), "bucket")
    window = Window.partitionBy("bucket").orderBy("end", F.desc_nulls_last("doc_id"), "h1", "h2")
    rows = rows.withColumn("sketch", sketch(F.col("text")))
    found = rows.withColumns(
        {"next_text": F.lead("text").over(window), "next_sketch": F.lead("sketch").over(window)}
    )
    names = ("doc_id", "text", "next_text", "sketch", "next_sketch")
    found = found.where(~F.col("end")).select(*names)
    if copies.isEmpty():
        return found
    # The other copies, by the thousand, so that no task makes all of them.
    more = F.sequence(F.lit(0).cast("long"), F.col("n") - 2, F.lit(1000).cast("long"))
    again = ones.where("n > 1").withColumn("sketch", sketch(F.col("text"))).withColumn("at", F.explode(more))
    again = again.repartition(partitions(spark), "h1", "h2", "at")
    each = F.sequence(F.col("at"), F.least(F.col("n") - 2, F.col("at") + 999))
    again = again.withColumn("copy", F.explode(each))
    again = again.withColumns({"next_text": F.col("text"), "next_sketch": F.col("sketch")})
    return found.unionByName(again.select(*names))


def _bucket(value: Column, bounds: list[int]) -> Column:
    """How many bounds are below a value, found in two steps; -1 for null."""
    step = isqrt(len(bounds)) + 1
    coarse = F.lit(bounds[step - 1 :: step] or [-(2**63)])
    fine = F.lit(bounds or [-(2**63)])
    blocks = F.size(F.filter(coarse, lambda b: b < value)) if bounds else F.lit(0)
    rest = F.slice(fine, blocks * step + 1, F.lit(step))
    below = F.size(F.filter(rest, lambda b: b < value)) if bounds else F.lit(0)
    return F.when(value.isNull(), F.lit(-1)).otherwise(blocks * step + below).cast("long")


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last half replaced by as many code points of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))
