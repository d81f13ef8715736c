"""The shrinkage of op1 and the fusion of op7 against plain Python over small tables, and op2 on one unbroken run."""

import math
import random
import time
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import table
from pyspark.sql import functions as F

from tableops.llm.language_id import DECLARED_WEIGHT, HOST_WEIGHT, SUFFIX_WEIGHT, fit, identify_languages
from tableops.llm.piece_bpe import load
from tableops.llm.quality import MAX_WEIGHT, MIN_WEIGHT, classify_quality
from tableops.scratch import Tables

SF_DIR = "/root/testdata/sf0.001"


def prior_weight(sites):
    """sites of (n, share, share above)."""
    big = [(n, p, q) for n, p, q in sites if n >= 2]
    if not big:
        return MAX_WEIGHT
    noise = sum(q * (1 - q) for _, _, q in big) / len(big)
    between = sum((p - q) ** 2 - q * (1 - q) / n for n, p, q in big) / len(big)
    return MAX_WEIGHT if between <= 0 else min(max(noise / between - 1, MIN_WEIGHT), MAX_WEIGHT)


def test_quality_shrinkage(spark):
    r = random.Random(5)
    good, bad = "the cat sat on the mat and was glad of it", "BUY!!! $$$ now | now | now 1234 ###"
    rows = []
    for i in range(160):
        site = r.choice(["a", "a", "a", "b", "c", f"rare{i}"])
        text = r.choice([good, good, bad] if site == "a" else [bad, bad, good])
        rows.append((i, " ".join(r.sample(text.split(), r.randrange(3, 9))), r.choice(["x", "y", None]), f"https://{site}.example/z"))
    labels = [(i, int("!" not in t and "$" not in t)) for i, t, _, _ in rows if i % 2]
    got = {x.doc_id: x for x in classify_quality(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    base = math.log((sum(q for _, q in labels) + 1) / (len(labels) - sum(q for _, q in labels) + 1))
    p = {i: 1 / (1 + math.exp(-(x.evidence + base))) for i, x in got.items()}
    site = {i: (a.split("/")[2], c or "") for i, _, c, a in rows}
    hosts, paths = defaultdict(list), defaultdict(list)
    for i in p:
        hosts[site[i][0]].append(p[i])
        paths[site[i]].append(p[i])
    mean = sum(p.values()) / len(p)
    host_weight = prior_weight([(len(v), sum(v) / len(v), mean) for v in hosts.values()])
    shrunk = {h: (sum(v) + host_weight * mean) / (len(v) + host_weight) for h, v in hosts.items()}
    path_weight = prior_weight([(len(v), sum(v) / len(v), shrunk[k[0]]) for k, v in paths.items()])
    assert MIN_WEIGHT <= host_weight < MAX_WEIGHT
    for i, x in got.items():
        mine, own = hosts[site[i][0]], paths[site[i]]
        host = (sum(mine) - p[i] + host_weight * mean) / (len(mine) - 1 + host_weight)
        prior = (sum(own) - p[i] + path_weight * host) / (len(own) - 1 + path_weight)
        assert x.site_prior == pytest.approx(prior)
        assert x.probability == pytest.approx(1 / (1 + math.exp(-(x.evidence + math.log(prior / (1 - prior))))))


def shares(logs):
    weights = np.exp(logs - logs.max())
    return weights / weights.sum()


def test_language_fusion(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id % 2 = 0").select(
        "doc_id", F.substring("text", 1, 60).alias("text"), F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("lang"), F.concat("source", F.lit("."), "lang").alias("source")
    )
    rows = docs.collect()
    with Tables(spark) as tables:
        prepared = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("declared"))
        languages, model = fit(prepared, 500, tables)
    from tableops.llm.language_id import EVIDENCE_GRAMS, trigrams
    import pyarrow as pa

    n, scores, grams = len(model), {}, {}
    for r in rows:
        buckets = np.concatenate([b for _, b, _ in trigrams(pa.array([r.text]))])
        grams[r.doc_id] = len(buckets)
        scores[r.doc_id] = np.array([m[buckets].sum(dtype=np.float64) for m in model]) * min(1, EVIDENCE_GRAMS / max(len(buckets), 1))
    alone = {i: shares(s) for i, s in scores.items()}
    sums = {by: defaultdict(lambda: np.zeros(n)) for by in ("host", "suffix", "declared")}
    keys = {r.doc_id: {"host": r.source.lower(), "suffix": r.source.rpartition(".")[2], "declared": r.lang or ""} for r in rows}
    for i, k in keys.items():
        for by, value in k.items():
            sums[by][value] += alone[i]
    total = sum(alone.values())
    values = len({k["declared"] for k in keys.values()})
    got = {r.doc_id: r for r in identify_languages(docs).collect()}
    for i, k in keys.items():
        host, suffix, said = (sums[by][k[by]] - alone[i] for by in ("host", "suffix", "declared"))
        suffix = (suffix + SUFFIX_WEIGHT * (total + 1) / (len(rows) + n)) / (suffix.sum() + SUFFIX_WEIGHT)
        prior = (host + HOST_WEIGHT * suffix) / (host.sum() + HOST_WEIGHT)
        declaration = (said + DECLARED_WEIGHT) / (total - alone[i] + DECLARED_WEIGHT * (values + 1))
        posterior = shares(scores[i] + np.log(np.maximum(prior, 1e-9)) + np.log(np.maximum(declaration, 1e-9)))
        best = int(posterior.argmax())
        assert got[i].language == (languages[best] if best < n - 1 else None)
        assert got[i].posterior == pytest.approx(posterior[best], abs=1e-6)
        assert got[i].kept == (grams[i] > 0 and best < n - 1 and got[i].posterior >= 0.5)


def test_one_unbroken_run():
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    bpe, r = load(public_tokenizers.path("piece_bpe_32k.model")), random.Random(1)
    text = "".join(chr(r.randrange(0x4E00, 0x4E80)) for _ in range(500_000))
    start = time.perf_counter()
    ids = bpe.encode(text)
    assert time.perf_counter() - start < 20
    assert ids == [*sp.encode(text), sp.eos_id()]
    text = "".join(r.choice("abcdefghijklmnop") for _ in range(200_000))
    assert bpe.encode(text) == [*sp.encode(text), sp.eos_id()]
