"""Language identification by Bayesian evidence fusion.

Evidence: likelihood of the text's byte trigrams per language, the declared language (markup), and a prior of the address:
the host's language shares, smoothed towards those of its suffix, smoothed towards those of all. Shares and the reliability
of declarations are sums of text posteriors by grouped aggregation over all documents; each document's own part is taken
out again before it is judged. Unknown is a candidate of its own: trigrams spread evenly.

Only the trigram model is fitted on a sample: ``per_language`` documents of each language, those with the smallest id hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableops.llm.common import broadcast_if_small, inner_id, outer_id, site_host, site_suffix
from tableops.llm.words import buffers, slices
from tableops.scratch import Tables

BUCKETS = 1 << 14
EVIDENCE_GRAMS = 200.0  # neighbouring trigrams repeat each other: a text counts as this many at most
HOST_WEIGHT, SUFFIX_WEIGHT, DECLARED_WEIGHT = 10.0, 100.0, 1.0  # prior observations of the level above

_LETTER = np.full(256, 0x20, np.uint32)
for _first, _last, _shift in ((0x41, 0x5A, 32), (0x61, 0x7A, 0), (0x80, 0xFF, 0)):
    _LETTER[_first : _last + 1] = np.arange(_first, _last + 1) + _shift


def trigrams(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bucket of each trigram, bounds of the rows' trigrams); white space in the middle gives no trigram."""
    data, offsets = buffers(column)
    for low, high in slices(offsets):
        codes = _LETTER[data[offsets[low] : offsets[high]]]
        begin = offsets[low : high + 1] - offsets[low]
        whole = np.full(len(codes) + 2, 0x20, np.uint32)
        whole[1:-1] = codes
        left, right = whole[:-2].copy(), whole[2:].copy()
        inner = begin[(begin > 0) & (begin < len(codes))]
        left[inner], right[inner - 1] = 0x20, 0x20  # texts do not touch
        keep = codes != 0x20
        mixed = (left << np.uint32(16) | codes << np.uint32(8) | right) * np.uint32(0x9E3779B1)
        yield low, (mixed >> np.uint32(18))[keep].astype(np.int64), np.concatenate([[0], np.cumsum(keep)])[begin]


def _count_language(rows: pd.DataFrame) -> pd.DataFrame:
    counts = np.zeros(BUCKETS, np.float32)
    for _, buckets, _ in trigrams(pa.array(rows["text"], pa.string())):
        counts += np.bincount(buckets, minlength=BUCKETS)
    return pd.DataFrame({"language": [rows["language"].iloc[0]], "counts": [counts.tobytes()]})


def fit(docs: DataFrame, per_language: int, tables: Tables) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities by bucket, the unknown language last; docs has doc_id, text, declared.

    Languages are all declared values with a trigram of text. The sample is bounded by per_language texts of each.
    """
    known = docs.where("declared <> ''").groupBy("declared").agg(F.count("*").alias("documents"))
    known = broadcast_if_small(tables.put(known, "known"))
    order = Window.partitionBy("declared").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)), "doc_id")
    # About four times the sample is ranked, by the same hash, so that no task ranks all ids of a frequent language.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    chosen = docs.select("doc_id", "declared").join(known, "declared").where(place < (4 * per_language + 100) / F.col("documents"))
    chosen = chosen.select("doc_id", "declared").withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).drop("n")
    chosen = broadcast_if_small(tables.put(tables.put(chosen, "chosen").select("doc_id").distinct(), "chosen_ids"))
    sample = docs.select("doc_id", "text", F.col("declared").alias("language"))
    sample = sample.join(chosen, "doc_id", "left_semi").where("language <> ''")
    sums = sample.groupBy("language").applyInPandas(_count_language, "language string, counts binary").collect()
    found = {r.language: np.frombuffer(r["counts"], np.float32) for r in sums}
    languages = sorted(x for x, counts in found.items() if counts.any())
    table = np.stack([*[found[x] + 0.05 for x in languages], np.ones(BUCKETS)])
    return languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _likelihoods(model: np.ndarray, columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, grams = np.zeros((batch.num_rows, len(model))), np.zeros(batch.num_rows, np.int64)
            for low, buckets, bounds in trigrams(batch.column("text")):
                rows = slice(low, low + len(bounds) - 1)
                grams[rows] = np.diff(bounds)
                for i, log in enumerate(model):
                    sums = np.concatenate([[0.0], np.cumsum(log[buckets], dtype=np.float64)])[bounds]
                    scores[rows, i] = np.diff(sums)
            scores *= np.minimum(1, EVIDENCE_GRAMS / np.maximum(grams, 1))[:, None]
            arrays = [batch.column(c) for c in columns]
            vectors = pa.list_(pa.float64())
            arrays += [pa.array(grams), pa.array(list(scores), vectors), pa.array(list(_shares(scores)), vectors)]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "grams", "scores", "alone"])

    return run


def _shares(logs: np.ndarray) -> np.ndarray:
    weights = np.exp(logs - logs.max(axis=1, keepdims=True)) if len(logs) else logs
    return weights / weights.sum(axis=1, keepdims=True)


def _fuse(
    languages: list[str], totals: np.ndarray, rows: float, values: float, least: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Posterior from scores, own text shares, and the sums of the host, suffix and declaration of each row."""
    n = len(totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, own, host, suffix, said = (
                batch.column(c).flatten().to_numpy().reshape(-1, n) for c in ("scores", "alone", "of_host", "of_suffix", "of_declared")
            )
            share = (totals + 1) / (rows + n)
            suffix = (suffix - own + SUFFIX_WEIGHT * share) / (suffix.sum(axis=1, keepdims=True) - 1 + SUFFIX_WEIGHT)
            prior = (host - own + HOST_WEIGHT * suffix) / (host.sum(axis=1, keepdims=True) - 1 + HOST_WEIGHT)
            declaration = (said - own + DECLARED_WEIGHT) / (totals - own + DECLARED_WEIGHT * (values + 1))
            # Rounding may leave a tiny negative count.
            posterior = _shares(scores + np.log(np.maximum(prior, 1e-9)) + np.log(np.maximum(declaration, 1e-9)))
            best = posterior.argmax(axis=1) if len(posterior) else np.zeros(0, int)
            top = posterior[np.arange(len(best)), best]
            kept = (batch.column("grams").to_numpy() > 0) & (best < n - 1) & (top >= least)
            names = pa.array([languages[i] if i < n - 1 else None for i in best], pa.string())
            arrays = [batch.column("doc_id"), batch.column("row_key"), names, pa.array(top), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "row_key", "language", "posterior", "kept"])

    return run


def primary_language(declared: Column) -> Column:
    """Primary subtag of a language tag in lower case (en of EN or en_US); whole for x- and i- tags, empty for null."""
    tag = F.lower(F.trim(F.coalesce(declared.cast("string"), F.lit(""))))
    return F.regexp_replace(tag, "^([^-_]{2,})[-_].*$", "$1")


def row_key(declared: str, address: str) -> Column:
    """Hash that tells apart rows that share an id."""
    return F.xxhash64(inner_id(), F.coalesce("text", F.lit("")), F.col(declared).cast("string"), F.col(address).cast("string"))


def identify_languages(
    docs: DataFrame, declared: str = "lang", address: str = "source", per_language: int = 500, least: float = 0.5
) -> DataFrame:
    """(doc_id, row_key, language, posterior, kept) of every row of docs (doc_id, text, declared, address); runs jobs.

    Declarations count by their primary subtag, and every declared language has a model (64 KB in the driver and each task).
    language is the most probable one, null where it is unknown; posterior is its probability. A document is rejected
    (kept is false) if it has no letters, if unknown is most probable, or if the posterior is below ``least``. Null or
    empty text has no letters. Null declarations and addresses are one value of their own, empty. Rows are judged one by one,
    repeated ones alike; row_key is the hash of doc_id, text, declared and address. A null doc_id comes back as null. Without
    any declared language all are unknown. An empty table gives an empty result; other columns are ignored.
    """
    text, said = F.coalesce("text", F.lit("")), primary_language(F.col(declared))
    host = site_host(F.col(address))
    docs = docs.select(
        inner_id().alias("doc_id"),
        row_key(declared, address).alias("row_key"),
        text.alias("text"),
        said.alias("declared"),
        host.alias("host"),
        site_suffix(host).alias("suffix"),
    )
    with Tables(docs.sparkSession) as tables:
        languages, model = fit(docs, per_language, tables)
        kept = ["doc_id", "row_key", "declared", "host", "suffix"]
        schema = "doc_id long, row_key long, declared string, host string, suffix string, grams long, scores array<double>, alone array<double>"
        scored = tables.put(docs.mapInArrow(_likelihoods(model, kept), schema), "scored", keep=True)
        n = len(model)

        def level(by: str) -> DataFrame:
            sums = scored.groupBy(by).agg(F.array(*[F.sum(F.get("alone", F.lit(i))) for i in range(n)]).alias(f"of_{by}"))
            return broadcast_if_small(tables.put(sums, by, keep=True))

        whole = [F.sum(F.get("alone", F.lit(i))) for i in range(n)]
        whole = scored.agg(F.array(*whole).alias("sums"), F.count_distinct("declared").alias("values"), F.count("*").alias("rows")).first()
        rows = scored.join(level("host"), "host").join(level("suffix"), "suffix").join(level("declared"), "declared")
        rows = rows.select("doc_id", "row_key", "grams", "scores", "alone", "of_host", "of_suffix", "of_declared")
    totals = np.array([x or 0.0 for x in whole["sums"]])
    judged = rows.mapInArrow(
        _fuse(languages, totals, whole["rows"], whole["values"], least),
        "doc_id long, row_key long, language string, posterior double, kept boolean",
    )
    return judged.withColumn("doc_id", outer_id("doc_id"))


def keep_identified(docs: DataFrame, declared: str = "lang", address: str = "source", **options: float) -> DataFrame:
    """The rows of docs, with all their columns, that identify_languages does not reject."""
    judged = identify_languages(docs, declared, address, **options)
    with Tables(docs.sparkSession) as tables:
        rejected = judged.where("NOT kept").select(F.col("row_key").alias("__row_key")).distinct()
        rejected = broadcast_if_small(tables.put(rejected, "rejected", keep=True))
    marked = docs.withColumn("__row_key", row_key(declared, address))
    return marked.join(rejected, "__row_key", "left_anti").select(*docs.columns)
