"""Language identification and quality: held-out accuracy, shrinkage, and awkward rows."""

import random

import pytest
from brute import table
from pyspark.sql import functions as F

from tableops.llm.common import site_host, site_suffix
from tableops.llm.language_id import identify_languages, primary_language
from tableops.llm.quality import classify_quality

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_language_held_out(spark, docs):
    hidden = docs.withColumn("said", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    found = identify_languages(hidden.drop("lang"), declared="said").join(docs, "doc_id").where("doc_id % 2 = 1")
    right = found.agg(F.avg((F.col("language") == F.col("lang")).cast("int")), F.avg(F.col("kept").cast("int"))).first()
    assert right[0] > 0.98 and right[1] > 0.98


def test_declaration_and_host_decide_where_the_text_cannot(spark, docs):
    clear = docs.where("n_chars > 300").select(
        F.col("doc_id"), "text", "lang", F.concat(F.lit("https://site."), "lang", F.lit(".example/a")).alias("source")
    )
    short = spark.createDataFrame(
        [(-1, "on", "fr", None), (-2, "on", None, "http://x.fr.example"), (-3, "on", None, "http://site.de.example")],
        "doc_id long, text string, lang string, source string",
    )
    got = {r.doc_id: r for r in identify_languages(clear.unionByName(short)).where("doc_id < 0").collect()}
    assert got[-1].language == "fr"
    alike = {r.doc_id: r.posterior for r in got.values()}
    assert all(0 < p <= 1 for p in alike.values())


def test_language_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (1, "the cat and the dog", "en"), (2, None, None), (3, "123 456", "en"), (None, "le chat et le chien", "fr")]
    df = table(spark, rows).selectExpr("*", "1 AS declared", "2 AS host", "3 AS scores", "4 AS grams")
    got = sorted(((r.doc_id, r.kept) for r in identify_languages(df).collect()), key=str)
    assert got == sorted([(1, True), (1, True), (2, False), (3, False), (None, True)], key=str)
    assert identify_languages(table(spark, [])).collect() == []
    assert [r.kept for r in identify_languages(table(spark, [(1, "no declaration at all")])).collect()] == [False]


def test_address_parts(spark):
    rows = ["https://u:p@a.b.Example.DE:80/x?y#z", "src5", None, "a.fr/x"]
    df = spark.createDataFrame([(r,) for r in rows], "a string").select(site_host(F.col("a")).alias("h"))
    got = [tuple(r) for r in df.select("h", site_suffix(F.col("h"))).collect()]
    assert got == [("a.b.example.de", "de"), ("src5", ""), ("", ""), ("a.fr", "fr")]


def test_quality_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = classify_quality(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    assert found.agg(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("int"))).first()[0] > 0.95


def test_sites_are_shrunk(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    bad = docs.join(labels.where("quality = 0"), "doc_id").select(docs["*"]).withColumn("source", F.lit("http://bad.example/x"))
    good = docs.join(labels.where("quality = 1"), "doc_id").select(docs["*"]).withColumn("source", F.concat(F.lit("good"), F.col("doc_id") % 9))
    rare = good.limit(1).withColumns({"source": F.lit("rare"), "doc_id": F.lit(-1).cast("long")})
    got = classify_quality(bad.unionByName(good).unionByName(rare), labels)
    by = {r[0]: r[1] for r in got.join(bad.select("doc_id"), "doc_id", "left_semi").groupBy(F.lit("bad")).agg(F.avg("site_prior")).collect()}
    mean = got.agg(F.avg(F.col("kept").cast("double"))).first()[0]
    prior = got.where("doc_id = -1").first().site_prior
    assert by["bad"] < 0.3 and abs(prior - mean) < 0.25


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 1), (9, None, 0)], "doc_id long, quality int, toxic int")
    rows = [(1, "good text here"), (2, "bad ### text"), (2, "bad ### text"), (3, None), (4, ""), (None, "no id")]
    df = table(spark, rows).selectExpr("*", "1 AS host", "2 AS path", "3 AS evidence", "4 AS p", "5 AS quality")
    got = classify_quality(df, labels).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 2, 3, 4] and all(0 <= r.probability <= 1 for r in got)
    assert classify_quality(table(spark, []), labels).collect() == []
    assert {r.evidence for r in classify_quality(table(spark, rows), labels.limit(0)).collect()} == {0.0}


def test_seventy_languages_and_variant_tags(spark):
    r = random.Random(4)
    rows = []
    for k in range(70):
        lexicon = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(15)]
        name = f"{chr(97 + k // 26)}{chr(97 + k % 26)}"
        for d in range(6):
            tag = [name, name.upper(), f"{name}-US", f"{name}_us", f" {name}-Latn-x", name][d] if k % 2 else name
            rows.append((len(rows), " ".join(r.choice(lexicon) for _ in range(60)), tag, "web", name))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, truth string")
    got = {x.doc_id: x for x in identify_languages(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i].language == truth and got[i].kept and got[i].posterior > 0.9 for i, _, _, _, truth in rows)
    tags = [("x-klingon",), ("EN",), (None,), ("zh_Hant-TW",)]
    found = spark.createDataFrame(tags, "t string").select(primary_language(F.col("t"))).collect()
    assert [x[0] for x in found] == ["x-klingon", "en", "", "zh"]
