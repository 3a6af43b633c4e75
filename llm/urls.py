"""URL filter: rules, and a ratio of two character language models for the rest."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import free_name, held_out, stored

# Verdict, host and path of each rule.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Longest context of a character.
ORDER = 5
#: A window that is this part of all windows or more is frequent.
FREQUENT = 1 << 17
#: Windows that a task counts before it hands them on.
HELD = 200_000
#: Steps of a logarithm of one.
UNIT = 1 << 32
SYMBOLS = 257  # bytes and the end
#: Steps that scores are counted in for calibration, and their range.
BINS, REACH = 400, 4.0
#: One fold of the judged URLs calibrates, the others train.
FOLDS = 5
END = "\n"


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty for null or without ``://``."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    fits = []
    for verdict, of, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        inside = (host == of) | F.endswith(host, F.lit(f".{of}"))
        fits.append((inside & F.startswith(path, F.lit(start)), of + start, verdict))
    none = F.lit(None).cast("string")
    choose = lambda i: F.coalesce(*(F.when(f[0], F.lit(f[i])) for f in fits), none)
    return choose(1), choose(2)


def symbols(url: str | None) -> str:
    """What the models read: the URL's bytes as characters, and an end."""
    return (url or "").encode("utf-8", "surrogatepass").decode("latin-1").lower() + END


def windows(text: str) -> list[str]:
    """Each character behind its longest context."""
    padded = END * ORDER + text
    return [padded[i : i + ORDER + 1] for i in range(len(text))]


def window_counts(urls: DataFrame, *by: str) -> DataFrame:
    """(gram, by, n) of the windows of all rows of ``urls`` (url, by).

    A task counts ahead what it can hold, so a hot URL is a row a task.
    """
    names = ["gram", *by, "n"]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = {}

        def told() -> pa.RecordBatch:
            rows = [(g, *k, n) for k, found in counts.items() for g, n in found.items()]
            counts.clear()
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            kinds = (pa.string(), *[pa.bool_()] * len(by), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for url, *key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts.setdefault(tuple(key), Counter()).update(windows(symbols(url)))
                if sum(map(len, counts.values())) > HELD:
                    yield told()
        yield told()

    schema = ", ".join(["gram string", *(f"{c} boolean" for c in by), "n long"])
    found = urls.select("url", *by).mapInArrow(tally, schema)
    return found.groupBy("gram", *by).agg(F.sum("n").alias("n"))


def differences(judged: DataFrame, asked: DataFrame) -> DataFrame:
    """(gram, n, difference) of each window of ``asked`` (gram, n).

    The difference is by how much the model of accepted URLs finds the window's last
    character likelier behind the others, as a logarithm in steps of 1 / ``UNIT``; 0
    if ``judged`` (url, allow) is of one kind. The models are of variable order, after
    Witten and Bell: a context speaks as its count against its distinct successors,
    an unseen one leaves the word to the next shorter. Counts and contexts of all
    lengths are tables and meet by joins, so none is left out; at most as many rows
    as there are characters share a key.
    """
    kind = lambda allow: F.sum(F.when(F.col("allow") == allow, F.col("n")).otherwise(0))
    both = [kind(True).alias("n_a"), kind(False).alias("n_b")]
    grams = stored(window_counts(judged, "allow").groupBy("gram").agg(*both))
    totals = grams.agg(F.sum("n_a"), F.sum("n_b")).first()
    if not all(totals):
        return asked.withColumn("difference", F.lit(0).cast("long"))
    shorter = F.substring("gram", 2, ORDER + 1)
    tables = [(grams, asked.select("gram"))]
    for _ in range(ORDER):
        grams, asked_too = tables[-1]
        sums = [F.sum(c).alias(c) for c in ("n_a", "n_b")]
        grams = stored(grams.groupBy(shorter.alias("gram")).agg(*sums))
        tables.append((grams, asked_too.select(shorter.alias("gram")).distinct()))
    context = F.expr("substring(gram, 1, length(gram) - 1)")
    chances = None
    for grams, wanted in reversed(tables):
        seen = grams.groupBy(context.alias("context")).agg(
            *(F.sum(f"n_{x}").alias(f"seen_{x}") for x in "ab"),
            *(F.count_if(F.col(f"n_{x}") > 0).alias(f"kinds_{x}") for x in "ab"),
        )
        if chances is None:
            own = wanted.withColumns({f"less_{x}": F.lit(1 / SYMBOLS) for x in "ab"})
        else:
            own = wanted.withColumn("tail", shorter).join(chances, "tail")
        own = own.withColumn("context", context).join(grams, "gram", "left")
        own = own.join(seen, "context", "left")

        def chance(x: str) -> Column:
            less, kinds, all_seen = F.col(f"less_{x}"), F.col(f"kinds_{x}"), F.col(f"seen_{x}")
            likely = (F.coalesce(f"n_{x}", F.lit(0)) + kinds * less) / (all_seen + kinds)
            return F.when(all_seen > 0, likely).otherwise(less).alias(f"less_{x}")

        chances = stored(own.select(F.col("gram").alias("tail"), chance("a"), chance("b")))
    more = F.round((F.log("less_a") - F.log("less_b")) * UNIT).cast("long")
    found = chances.select(F.col("tail").alias("gram"), more.alias("difference"))
    return asked.join(found, "gram")


def compared(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """(_row, difference) of each of ``rows`` (_row, url): per character, by how much
    the model of accepted URLs likes it more.

    Windows that are 1 / ``FREQUENT`` of all, so of bounded number, are looked up where
    a URL is read; others, of which none is a hot key, travel to their differences and
    back. Sums are of whole steps, so their order makes no difference.
    """
    asked = stored(window_counts(rows))
    total = asked.agg(F.sum("n")).first()[0] or 0
    table = stored(differences(judged, asked))
    often = table.where(F.col("n") * FREQUENT >= total).select("gram", "difference").toArrow()
    known = dict(zip(*(c.to_pylist() for c in often.columns), strict=True))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = symbols(url)
                found = windows(text)
                rest = [x for x in found if x not in known]
                out.append((row, len(text), sum(map(known.get, found, [0] * len(found))), rest))
            names = ["_row", "length", "sum", "rest"]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()))
            columns = zip(*out, strict=True) if out else [()] * 4
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "_row long, length long, sum long, rest array<string>"
    read = stored(rows.select("_row", "url").mapInArrow(look_up, schema))
    rare = read.select("_row", F.explode("rest").alias("gram")).join(table.drop("n"), "gram")
    rare = rare.groupBy("_row").agg(F.sum("difference").alias("more"))
    every = read.join(rare, "_row", "left")
    found = (F.col("sum") + F.coalesce("more", F.lit(0))) / UNIT / F.col("length")
    return every.select("_row", found.alias("difference"))


def calibrated(seen: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve for counts by class and step."""
    x = (np.arange(BINS) + 0.5) * (2 * REACH / BINS) - REACH
    weight = seen / np.maximum(seen.sum(1, keepdims=True), 1)  # both classes alike
    slope, shift = 1.0, 0.0
    for _ in range(2_000 if seen.sum(1).all() else 0):
        likely = 1 / (1 + np.exp(-(slope * x + shift)))
        error = weight[0] * likely - weight[1] * (1 - likely)
        slope -= 2.0 * ((error * x).sum() + 1e-4 * slope)
        shift -= 2.0 * error.sum()
    return max(float(slope), 1e-6), float(shift)


def calibration(compared_rows: DataFrame) -> tuple[float, float]:
    """Slope and shift for ``compared_rows`` (difference, allow), counted in steps."""
    place = F.floor((F.col("difference") + REACH) * (BINS / (2 * REACH)))
    place = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), place)).cast("int")
    bins = compared_rows.select(place.alias("bin"), "allow")
    seen = np.zeros((2, BINS))
    for row in bins.groupBy("bin", "allow").count().collect():  # at most 2 * BINS
        seen[int(row["allow"]), row["bin"]] = row["count"]
    return calibrated(seen)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` (url, ...) with host, path, rule, difference, chance and verdict, which
    replace columns of these names.

    Where no rule fits, the models that the URLs under rules teach decide: a URL is
    allowed where its calibrated chance is one half or more. One fold of the URLs
    under rules, by a hash of the URL, calibrates: a logistic curve is fitted to the
    differences of both kinds. Without URLs of both kinds all differences are zero. A
    null URL is like an empty one; repeated rows and other columns make no difference.
    """
    own = free_name(pages, "_row")
    kept = stored(pages.withColumn(own, F.monotonically_increasing_id()))
    host, path = parts(F.col("url"))
    known = kept.withColumns({"host": host, "path": path})
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    known = known.withColumns({"rule": rule, "verdict": verdict})
    allow = (F.col("verdict") == "allow").alias("allow")
    last = held_out(F.col("url"), FOLDS, 0)
    judged = known.where(F.col("verdict").isNotNull()).select("url", allow, F.col(own).alias("_row"))
    found = stored(compared(kept.select(F.col(own).alias("_row"), "url"), judged.where(~last)))
    slope, shift = calibration(judged.where(last).join(found, "_row"))
    odds = F.col("difference") * slope + shift
    known = known.drop("difference").join(found.withColumnRenamed("_row", own), own).drop(own)
    known = known.withColumn("chance", 1 / (1 + F.exp(-odds)))
    by_chance = F.when(F.col("chance") >= 0.5, F.lit("allow")).otherwise(F.lit("block"))
    return known.withColumn("verdict", F.coalesce("verdict", by_chance))
