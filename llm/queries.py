"""The operators over whole tables, with the columns that their contracts fix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import (
    decontamination,
    fingerprints,
    languages,
    lattice,
    licenses,
    merkle,
    packing,
    pii,
    quality,
    simhash,
    toxicity,
    urls,
    whitening,
)
from llm.common import held_out, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, labels, out)
    score = toxicity.score(model).alias("score")
    found = docs.select("doc_id", out.alias("held_out"), score)
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("licenses")
    base, starts = found["base_labels"], found["base_starts"]
    every = F.concat(base, found["labels"])
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return licenses.scan(docs).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(every).alias("labels"),
        found["score"].alias("score"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.leaks(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.col("leaks.item_id"))
    return docs.select("doc_id", found.alias("leaks")).select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        items.alias("item_ids"),
        F.coalesce(F.array_max(F.col("leaks.common")), F.lit(0.0)).alias("common"),
    )


def op5_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 7, 2)
    return lattice.score(docs, ~out, out, lattice.vocabulary_path())


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = packing.pack(docs, packing.vocabulary_path())
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"), 3, 1)
    model = quality.fit(docs, labels, out)
    score = quality.score(model).alias("score")
    found = docs.select("doc_id", out.alias("held_out"), score)
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", pii.found(pii.fit(docs)).alias("pii"))
    base, spans = F.col("pii.base"), F.col("pii.spans")

    def number(kind: str):
        found = F.filter(base, lambda x: F.startswith(x, F.lit(f"{kind}:")))
        return F.size(found).cast("long").alias(f"n_{kind}")

    return docs.select(
        "doc_id",
        *(number(kind) for kind in pii.BASE),
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(spans, ",").alias("spans"),
    )


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "chance")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fingerprints.with_next(table(spark, sf_dir, "documents"))
    docs = docs.withColumn("edited", fingerprints.edited(F.col("text"), F.col("next_text")))
    docs = docs.withColumn("edited_sketch", fingerprints.sketch(F.col("edited")))
    own, changed = F.col("sketch"), F.col("edited_sketch")
    return docs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(own).alias("fingerprint"),
        fingerprints.as_text(changed).alias("edited_fingerprint"),
        fingerprints.resemblance(own, changed).alias("near_edited"),
        fingerprints.resemblance(own, F.col("next_sketch")).alias("near_next"),
        fingerprints.containment(own, changed).alias("within_edited"),
        fingerprints.distinct_shingles(own).alias("n_shingles"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    error = whitening.identity_error(vectors, model)
    found = vectors.select("vec_id", whitening.whitened(model).alias("found"))
    found = found.select(
        "vec_id", "found.deviation", F.posexplode("found.whitened").alias("place", "whitened")
    )
    explained = F.array(*map(F.lit, model.explained)) if model.explained else F.lit(None).cast("array<double>")
    return found.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = {name: F.col(name) for name in merkle.FIELDS}
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    changed = merkle.leaf([*{**fields, "n_chars": more}.values()])
    tampered = held_out(F.col("doc_id"), 7, 0) & F.col("n_chars").isNotNull()
    carried = {"doc_id": F.col("doc_id"), "changed": F.when(tampered, changed)}
    found = merkle.manifest(docs, carried)
    seen = F.coalesce("changed", "leaf")
    found = found.withColumn("folded_root", merkle.folded(seen, F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.digest(merkle.proof(F.col("path"))).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 3, 1)
    found = languages.identified(languages.fit(docs, out))
    docs = docs.select("doc_id", out.alias("held_out"), found.alias("found"))
    spans = F.size("found.spans").alias("n_spans")
    return docs.select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score"), spans
    )


#: The same from recursive queries on lists. The crc32 goes over a number's bits.
OP12_SQL = """
WITH RECURSIVE bits AS (
  SELECT *, list_reduce(
      flatten([[(ascii(c)::BIGINT >> k) & 1 FOR k IN range(8)]
               FOR c IN string_split(doc_id::VARCHAR, '')]),
      lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT) AS crc
  FROM documents
), texts AS (
  SELECT doc_id, lang, coalesce((4294967295 - crc) % 7 = 0, false) AS tampered, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM bits
), leaves AS (
  SELECT doc_id, lang,
    sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + tampered::INT)::VARCHAR) || ':'
      || (n_chars + tampered::INT), '-') || tail) AS seen
  FROM texts
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM leaves
), up AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM numbered GROUP BY lang
  UNION ALL
  SELECT lang, level + 1,
    [sha256(nodes[i] || coalesce(nodes[i + 1], '')) FOR i IN range(1, len(nodes) + 1, 2)]
  FROM up WHERE len(nodes) > 1
), subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS top
  FROM up WHERE len(nodes) = 1
), roof AS (
  SELECT 0 AS level, list(subroot ORDER BY top) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1,
    [sha256(nodes[i] || coalesce(nodes[i + 1], '')) FOR i IN range(1, len(nodes) + 1, 2)]
  FROM roof WHERE len(nodes) > 1
), trees AS (
  SELECT lang, list(nodes ORDER BY level) FILTER (len(nodes) > 1) AS levels FROM up GROUP BY lang
), roofs AS (
  SELECT list(nodes ORDER BY level) FILTER (len(nodes) > 1) AS levels,
    max(nodes[1]) FILTER (len(nodes) = 1) AS root
  FROM roof
), steps AS (
  SELECT n.doc_id, n.leaf, n.seen, s.subroot, r.root, list_concat(
    [[coalesce(t.levels[k + 1][xor(n.place >> k, 1) + 1], ''), ((n.place >> k) & 1)::VARCHAR]
     FOR k IN range(coalesce(len(t.levels), 0))],
    [[coalesce(r.levels[k + 1][xor(s.top >> k, 1) + 1], ''), ((s.top >> k) & 1)::VARCHAR]
     FOR k IN range(coalesce(len(r.levels), 0))]) AS path
  FROM numbered n
  JOIN subroots s ON s.lang IS NOT DISTINCT FROM n.lang
  JOIN trees t ON t.lang IS NOT DISTINCT FROM n.lang
  CROSS JOIN roofs r
), ends AS (
  SELECT *, list_reduce(
      [CASE WHEN x[2] = '1' THEN x[1] || '@' ELSE '@' || x[1] END FOR x IN path],
      lambda node, x: sha256(replace(x, '@', node)), seen) AS folded_root
  FROM steps
)
SELECT doc_id, leaf, subroot, root,
  sha256(coalesce(list_aggregate([x[1] FOR x IN path], 'string_agg', ''), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM ends
"""


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_licenses": op3_licenses,
    "op4_decontamination": op4_decontamination,
    "op5_lattice": op5_lattice,
    "op6_packing": op6_packing,
    "op7_quality": op7_quality,
    "op8_pii": op8_pii,
    "op9_urls": op9_urls,
    "op10_fingerprints": op10_fingerprints,
    "op11_whitening": op11_whitening,
    "op12_merkle": op12_merkle,
    "op13_languages": op13_languages,
}

#: What SQL can express of them.
ORACLE_SQL: dict[str, str] = {"op12_merkle": OP12_SQL}
