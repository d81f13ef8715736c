"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic regression on counts of a text's bytes, words and repeats gives each document's evidence. The prior of a document
is the quality share of its site's path, shrunk towards its host's, shrunk towards that of all documents; a document's own
probability is taken out of its site. How strongly to shrink is estimated from the spread between sites beyond what their
sizes explain, so sparse sites stay near the level above. Sums per path and host are grouped aggregates over all documents.

Only the regression is fitted on a sample: up to max_labels labelled documents, those with the smallest id hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableops.llm.common import broadcast_if_small, inner_id, outer_id, site_host
from tableops.llm.words import batch_words, buffers
from tableops.scratch import Tables

_CLASSES = {  # shares of bytes
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "symbol": b"#$%&*+<=>@\\^_`{}~",
    "bar": b"|",
    "mark": b"!?",
    "stop": b".,;:",
    "newline": b"\n",
    "space": b" \t",
}
FEATURES = [*_CLASSES, "other", "size", "word_length", "distinct_words", "distinct_pairs", "same_as_before", "one_letter"]
MIN_WEIGHT, MAX_WEIGHT = 1.0, 1e6  # bounds of the prior observations of a level


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    out = np.zeros((len(column), len(FEATURES)))
    data, offsets = buffers(column)
    for words in batch_words(column):
        rows = slice(words.row, words.row + len(words))
        part = data[offsets[rows.start] : offsets[rows.stop]]
        size = np.maximum(np.diff(words.begin), 1)
        count = np.diff(words.first)

        def per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0.0], np.cumsum(mask, dtype=np.float64)])[bounds])

        for i, chars in enumerate(_CLASSES.values()):
            member = np.zeros(256, bool)
            member[list(chars)] = True
            out[rows, i] = per_text(member[part], words.begin) / size
        i = len(_CLASSES)
        out[rows, i] = per_text(part >= 0x80, words.begin) / size
        out[rows, i + 1] = np.log1p(count)
        some = np.maximum(count, 1)
        lengths = words.end - words.start
        out[rows, i + 2] = per_text(lengths, words.first) / some
        again = np.zeros(len(words.hash), bool)
        again[1:] = words.hash[1:] == words.hash[:-1]
        pairs = words.hash[:-1] * np.uint64(3) + words.hash[1:]
        for j, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
            out[words.row + j, i + 3] = len(np.unique(words.hash[a:b])) / max(b - a, 1)
            out[words.row + j, i + 4] = len(np.unique(pairs[a : b - 1])) / max(b - a - 1, 1) if b - a > 1 else 1.0
        out[rows, i + 5] = per_text(again, words.first) / some
        out[rows, i + 6] = per_text(lengths == 1, words.first) / some
    return out


class Logistic:
    """Logistic regression on standardised features and their squares, fitted by Newton steps with a ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> None:
        x = self._expand(x)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = self._standard(x)
        w = np.zeros(z.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
            step = np.linalg.solve(h, z.T @ (y - p) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        self.w = w
        self.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))  # log-odds of the sample

    @staticmethod
    def _expand(x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, x * x], axis=1)

    def _standard(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of good to bad: log-odds without the sample's own."""
        return np.clip(self._standard(self._expand(x)) @ self.w, -30, 30) - self.base


def fit(docs: DataFrame, labels: DataFrame, max_labels: int, tables: Tables) -> Logistic | None:
    """The regression from at most max_labels labelled rows; None without labels of both kinds.

    Labels (doc_id, quality) are taken in the order of their ids' hashes, and of the rows of docs that they join, where ids
    repeat, again max_labels in the order of the texts' hashes: the same ones at every run.
    """
    labels = labels.select(inner_id().alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    labels = labels.where("quality IN (0, 1)").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_labels)
    labels = tables.put(labels, "labels")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(list(features(batch.column("text"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([x, batch.column("quality")], ["x", "quality"])

    sample = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")
    if docs.select("doc_id").join(F.broadcast(labels), "doc_id").count() > max_labels:
        sample = sample.orderBy(F.xxhash64("doc_id", "text"), "quality").limit(max_labels)
    rows = sample.select("text", "quality").mapInArrow(run, "x array<double>, quality int").toPandas()
    if rows["quality"].nunique() < 2:
        return None
    return Logistic(np.stack(rows["x"]), rows["quality"].to_numpy(float))


def _score(model: Logistic | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["doc_id", "row_key", "host", "path"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence = model.evidence(features(batch.column("text"))) if model else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(evidence)], [*names, "evidence"])

    return run


def _prior_weight(sites: DataFrame, n: str, share: str, above: Column | float) -> float:
    """Prior observations of the level above: its variance over the variance between sites that sizes do not explain."""
    above = above if isinstance(above, Column) else F.lit(above)
    big = sites.where(F.col(n) >= 2)
    noise = above * (1 - above)
    row = big.agg(
        F.avg((F.col(share) - above) ** 2 - noise / F.col(n)).alias("between"), F.avg(noise).alias("noise"), F.count("*").alias("c")
    ).first()
    if not row["c"] or row["between"] is None or row["between"] <= 0:
        return MAX_WEIGHT
    return float(np.clip(row["noise"] / row["between"] - 1, MIN_WEIGHT, MAX_WEIGHT))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def classify_quality(
    docs: DataFrame, labels: DataFrame, address: str = "source", path: str = "lang", max_labels: int = 20_000, least: float = 0.5
) -> DataFrame:
    """(doc_id, row_key, evidence, site_prior, probability, kept) of every row of docs; runs jobs.

    docs has doc_id, text, address (a URL or a source name, of which the host counts) and path (a section of the host, such as
    a directory or a language). evidence is the log-likelihood ratio of the text, site_prior the shrunk quality share of its
    path, probability their combination; kept is probability >= least. Null or empty text is text without words. Null
    addresses and paths are one value of their own. Rows are judged one by one, repeated ones alike; labels that contradict
    each other all count. Without labels of both kinds the evidence is 0. A null doc_id comes back as null. An empty table
    gives an empty result; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(
        inner_id().alias("doc_id"),
        F.xxhash64(inner_id(), text, F.col(address).cast("string"), F.col(path).cast("string")).alias("row_key"),
        text.alias("text"),
        site_host(F.col(address)).alias("host"),
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
    )
    with Tables(docs.sparkSession) as tables:
        model = fit(docs, labels, max_labels, tables)
        base = model.base if model else 0.0
        scored = docs.mapInArrow(_score(model), "doc_id long, row_key long, host string, path string, evidence double")
        scored = tables.put(scored.withColumn("p", 1 / (1 + F.exp(-(F.col("evidence") + base)))), "scored", keep=True)
        mean = scored.agg(F.avg("p")).first()[0]
        mean = 0.5 if mean is None else mean
        paths = scored.groupBy("host", "path").agg(F.count("*").alias("n_path"), F.sum("p").alias("sum_path"))
        paths = tables.put(paths, "paths", keep=True)
        hosts = paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("sum_path").alias("sum_host"))
        hosts = tables.put(hosts, "hosts", keep=True)
        host_weight = _prior_weight(hosts.withColumn("share", F.col("sum_host") / F.col("n_host")), "n_host", "share", mean)
        both = paths.join(broadcast_if_small(hosts), "host")
        shrunk = (F.col("sum_host") + host_weight * mean) / (F.col("n_host") + host_weight)
        both = both.withColumn("share", F.col("sum_path") / F.col("n_path"))
        path_weight = _prior_weight(both, "n_path", "share", shrunk)
        rows = scored.join(broadcast_if_small(paths), ["host", "path"]).join(broadcast_if_small(hosts), "host")
    host = (F.col("sum_host") - F.col("p") + host_weight * mean) / (F.col("n_host") - 1 + host_weight)
    prior = (F.col("sum_path") - F.col("p") + path_weight * host) / (F.col("n_path") - 1 + path_weight)
    probability = 1 / (1 + F.exp(-(F.col("evidence") + _logit(prior))))
    return rows.select(
        outer_id("doc_id").alias("doc_id"),
        "row_key",
        "evidence",
        prior.alias("site_prior"),
        probability.alias("probability"),
        (probability >= least).alias("kept"),
    )
