"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches of ascending ids. A run holds the hashes of lines that were new in its batch, in sorted buckets.
Each batch is merge-anti-joined with the runs; the lines that are still there are new and become a run of level 0. When a
level has ``fanout`` runs they are merged into one run of the next level, so the number of runs grows with the
logarithm of the number of batches and a hash is rewritten once per level. Runs are disjoint.

Everything is DataFrame operations. A hot line costs one row per task in the grouping of hashes, and the join that marks
its copies is on hash and document, so the copies spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableops.llm.common import id_and_text, inner_id, outer_id, with_text
from tableops.scratch import Tables

# The white space that is stripped and the letters that are lower-cased.
WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    key = F.btrim(line, F.lit(WHITE_SPACE))
    ascii_only = F.length(key) == F.octet_length(key)  # lower() changes other letters as well
    return F.when(ascii_only, F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, version, pos, h1, h2) of every line whose key has min_chars code points; 128 bits of hash.

    ``version`` is the hash of the text, which tells rows apart that share an id.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("doc_id", "version", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    hashes = [F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.reverse("key")).alias("h2")]
    return lines.select("doc_id", "version", "pos", *hashes)


class LineRuns:
    """Sorted runs of line hashes by level."""

    def __init__(self, tables: Tables, fanout: int = 2) -> None:
        self.tables, self.fanout = tables, fanout
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """The batch's lines that repeat an earlier line, of a run or of a smaller doc_id in the batch; others are added."""
        new = lines.groupBy(*HASH).agg(F.min("doc_id").alias("doc_id"))
        for run in self.runs():
            new = new.join(run.select(*HASH).hint("merge"), HASH, "left_anti")
        run = self.tables.put(new, "run", sort=HASH)
        self._push(run, 0)
        return lines.join(run, [*HASH, "doc_id"], "left_anti")

    def _push(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionByName(other)
            self.levels[level] = []
            self._push(self.tables.put(merged, "run", sort=HASH), level + 1)


def _dropped_lines(docs: DataFrame, tables: Tables, min_chars: int, batches: int, fanout: int) -> DataFrame:
    """(doc_id, version, dropped): positions of the lines to drop; docs is id_and_text(...). A stored table."""
    cuts = sorted(set(docs.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01))) if batches > 1 else []
    batch = F.lit(0)
    for cut in cuts:  # approxQuantile gives doubles: compare as such
        batch = batch + (F.col("doc_id").cast("double") > F.lit(cut)).cast("int")
    lines = tables.put(line_hashes(docs, min_chars).withColumn("batch", batch), "lines", by="batch")
    runs, repeated = LineRuns(tables, fanout), []
    for i in range(len(cuts) + 1):
        repeats = runs.add(lines.where(F.col("batch") == i).drop("batch"))
        repeated.append(tables.put(repeats.select("doc_id", "version", "pos"), "repeated"))
    dropped = repeated[0]
    for more in repeated[1:]:
        dropped = dropped.unionByName(more)
    dropped = dropped.groupBy("doc_id", "version").agg(F.collect_set("pos").alias("dropped"))
    return tables.put(dropped, "dropped", keep=True)


def _cut(text: str, dropped: str) -> Column:
    """(n_lines, n_left, kept) of a text without the lines at the dropped positions; all lines stay where these are null."""

    def keep(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
        kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
        return F.struct(F.size(lines).cast("long").alias("n_lines"), F.size(left).cast("long").alias("n_left"), kept.alias("kept"))

    # Lines are bound once as an argument of the outer function, not split again for each position.
    cut = F.get(F.transform(F.array(F.split(text, "\n")), keep), F.lit(0))
    n_lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    whole = F.struct(n_lines.alias("n_lines"), n_lines.alias("n_left"), F.col(text).alias("kept"))
    return F.when(F.col(dropped).isNull(), whole).otherwise(cut)


def deduplicate_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """(doc_id, version, text, n_lines, n_dropped, kept_text) of every row of docs (doc_id, text); runs jobs.

    Lines are the parts between newlines; null or empty text is one empty line. A line's key is the line stripped of white
    space and with A-Z lower-cased. Keys of min_chars code points or more keep their lines in the smallest doc_id that
    holds them, all of them, and lose them in all others. A text that loses all its lines is empty. Rows that share an id
    are one document here: they keep or lose a key together. A null doc_id counts as the largest id and comes back as null.
    An empty table gives an empty result; other columns are ignored.
    """
    docs = id_and_text(docs)
    with Tables(docs.sparkSession) as tables:
        dropped = _dropped_lines(docs, tables, min_chars, batches, fanout)
    rows = docs.withColumn("version", F.xxhash64("text")).join(dropped, ["doc_id", "version"], "left")
    return rows.withColumn("cut", _cut("text", "dropped")).select(
        outer_id("doc_id").alias("doc_id"),
        "version",
        "text",
        "cut.n_lines",
        (F.col("cut.n_lines") - F.col("cut.n_left")).alias("n_dropped"),
        F.col("cut.kept").alias("kept_text"),
    )


def drop_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """docs with all their columns and the text that deduplicate_lines keeps; null text stays null."""
    with Tables(docs.sparkSession) as tables:
        dropped = _dropped_lines(id_and_text(docs), tables, min_chars, batches, fanout)
    dropped = dropped.select(F.col("doc_id").alias("__id"), F.col("version").alias("__version"), F.col("dropped").alias("__dropped"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumns({"__id": inner_id(), "__version": F.xxhash64(text)}).join(dropped, ["__id", "__version"], "left")
    kept = F.when(F.col("__dropped").isNull(), F.col("text")).otherwise(_cut("text", "__dropped")["kept"])
    return with_text(rows, kept).select(*docs.columns)
