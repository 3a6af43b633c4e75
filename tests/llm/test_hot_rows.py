"""A third of the rows under one id, a third copies of one text: every row has its result."""

import json

import pytest
from pyspark.sql import functions as F

from llm.queries import QUERIES

LANGS = ("en", "de")


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    words = {"en": "the house of this and that with green".split(), "de": "das haus und der wald mit grünem".split()}
    made = lambda i, lang: " ".join(words[lang][(i * k) % 7] for k in range(1, 9 + i % 5))
    rows = [(i, f"{made(i, LANGS[i % 2])} {i}", LANGS[i % 2], "a", 10) for i in range(400)]
    rows += [(5, f"{made(i, 'en')} own {i}", "en", "a", None) for i in range(400)]
    rows += [(1000 + i, "one text that many rows share, mail a@b.example.com now", "en", "b", 54) for i in range(400)]
    folder = str(tmp_path_factory.mktemp("hot"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 1400, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, rows[7][1]), (2, "nothing of this stands anywhere else at all today")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n not in ("op9_urls", "op11_whitening")])
def test_every_row_has_its_result(spark, hot, name):
    folder, rows = hot
    found = QUERIES[name](spark, folder)
    found = [r.asDict(recursive=True) for r in (found.where("piece = 0") if name == "op6_packing" else found).collect()]
    assert sorted(r["doc_id"] for r in found) == sorted(r[0] for r in rows)
    # What depends on the text alone is the same for all copies.
    alone = {
        "op1_simhash": ("fingerprint", "component_id"), "op2_toxicity": ("score",), "op3_licenses": ("n_words", "labels"),
        "op4_decontamination": ("item_ids",), "op5_lattice": ("n_tokens", "base_score", "score"), "op6_packing": ("ids_crc32",),
        "op7_quality": ("score",), "op8_pii": ("base_sha256", "spans"), "op10_fingerprints": ("fingerprint",),
        "op12_merkle": ("subroot", "root"), "op13_languages": ("lang_pred", "score"),
    }
    copies = {json.dumps([r[c] for c in alone[name]]) for r in found if r["doc_id"] >= 1000}
    assert len(copies) == 1


def test_hot_url_and_hot_vector(spark, tmp_path):
    urls = [(i, f"http://site{i % 40}.{'net' if i % 2 else 'example.net'}/en/{i}") for i in range(300)]
    urls += [(7, "http://hot.info/x")] * 200
    spark.createDataFrame(urls, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    found = QUERIES["op9_urls"](spark, str(tmp_path)).collect()
    assert len(found) == 500
    assert len({r.verdict for r in found if r.host == "hot.info"}) == 1
    vectors = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 3).otherwise(F.col("id")).alias("vec_id"),
        F.transform(
            F.sequence(F.lit(1), F.lit(9)),
            lambda k: F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.sin(F.col("id") * k).cast("double")),
        ).alias("embedding"),
    )
    vectors.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = QUERIES["op11_whitening"](spark, str(tmp_path)).collect()
    assert len(found) == 300 * 8
    assert len({(r.component, r.whitened, r.deviation) for r in found if r.vec_id == 3}) == 8
    assert max(r.identity_error for r in found) < 1e-9
