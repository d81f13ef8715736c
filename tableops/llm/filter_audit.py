"""What each filter of a chain removes, for every order of the filters, from one count of rows per set of failed filters.

Each row becomes a cell number: the bits of the filters it fails. Rows are counted per part and cell, before any shuffle
where they can be, so a part of any size is 2**n small rows. Those cells are walked through all subsets of active filters in
Gray-code order: each step toggles one filter, moves the counter of active failures of the cells that fail it by one, and
adds to or takes from the survivors only the cells whose counter leaves or reaches zero. The survivors of all subsets are
kept, and each step of each order is the difference of two of them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableops.llm.common import broadcast_if_small, inner_id
from tableops.scratch import Tables

MAX_FILTERS = 7  # 5,040 orders
SPACE = r"[\x20\x09-\x0D]+"


def gray_walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of each subset of active filters. cells: (2**n, measures) counts per set of failed filters, as bits."""
    number = np.arange(len(cells))
    failing = np.zeros(len(cells), np.int64)  # active filters that the cell fails
    alive = cells.sum(axis=0)
    states, active = np.zeros_like(cells), 0
    states[0] = alive
    for step in range(1, len(cells)):
        bit = step & -step  # the filter that the reflected Gray code toggles here
        active ^= bit
        touched = number[(number & bit) > 0]
        if active & bit:
            alive = alive - cells[touched[failing[touched] == 0]].sum(axis=0)
            failing[touched] += 1
        else:
            failing[touched] -= 1
            alive = alive + cells[touched[failing[touched] == 0]].sum(axis=0)
        states[active] = alive
    return states


def shapley_sums(kept: np.ndarray, n: int) -> np.ndarray:
    """Rows that each filter removes, summed over all orders. kept: survivors of each subset."""
    subsets = np.arange(len(kept))
    sizes = np.array([int(s).bit_count() for s in subsets])
    orders = np.array([factorial(k) * factorial(max(n - 1 - k, 0)) for k in range(n + 1)], np.int64)
    return np.array([(orders[sizes[without]] * (kept[without] - kept[without | 1 << f])).sum() for f in range(n) for without in [subsets[(subsets >> f) & 1 == 0]]])


def _steps(filters: Sequence[str], losses: Sequence[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    n = len(filters)
    orders = np.array(list(permutations(range(n))), np.int64)
    after = np.cumsum(1 << orders, axis=1).ravel()
    chosen = orders.ravel()
    before = after - (1 << chosen)
    names = np.repeat(["".join(filters[f] for f in order) for order in orders], n)
    step = np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        cells = np.zeros((1 << n, 1 + len(losses)), np.int64)
        cells[rows["cell"].to_numpy()] = rows[["n", *losses]].to_numpy(np.int64)
        states = gray_walk(cells)
        number = np.arange(1 << n)
        fails = np.array([cells[(number >> f) & 1 == 1, 0].sum() for f in range(n)])
        unique = cells[1 << np.arange(n), 0]
        gone = states[before] - states[after]
        columns = {
            "part": rows["part"].iloc[0],
            "filter_order": names,
            "step": step,
            "kept": states[after, 0],
            "removed": gone[:, 0],
            "redundant": fails[chosen] - gone[:, 0],
            "unique_fails": unique[chosen],
        }
        columns |= {name: gone[:, 1 + i] for i, name in enumerate(losses)}
        return pd.DataFrame(columns | {"shapley": shapley_sums(states[:, 0], n)[chosen]})

    return run


def audit_filters(rows: DataFrame, part: Column, fails: Mapping[str, Column], losses: Mapping[str, Column]) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, *losses, shapley): a row per part, order and step.

    ``fails`` maps each filter's letter to its failure condition, ``losses`` a result column to a condition whose rows are
    counted among the removed ones; a null condition is false, a null part the empty string. Counts are of rows: kept after
    the step, removed at it, redundant ones that fail its filter but went before, unique_fails that fail no other filter,
    and the filter's removed rows summed over all orders (shapley). Parts come from the rows, so an empty table gives an
    empty result. Repeated rows count as often as they occur. Reads ``rows`` once; lazy.
    """
    if not 1 <= len(fails) <= MAX_FILTERS or any(len(name) != 1 for name in fails):
        raise ValueError(f"Name 1 to {MAX_FILTERS} filters by one letter each")
    cell = sum((F.coalesce(c, F.lit(False)).cast("int") * (1 << i) for i, c in enumerate(fails.values())), F.lit(0))
    counted = [F.coalesce(c, F.lit(False)).cast("long").alias(name) for name, c in losses.items()]
    counted = rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), cell.alias("cell"), *counted)
    counts = counted.groupBy("part", "cell").agg(F.count(F.lit(1)).alias("n"), *[F.sum(name).alias(name) for name in losses])
    schema = ["part string", "filter_order string", "step int", "kept long", "removed long", "redundant long", "unique_fails long"]
    schema = ", ".join([*schema, *[f"`{name}` long" for name in losses], "shapley long"])
    return counts.groupBy("part").applyInPandas(_steps(list(fails), list(losses)), schema)


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text, which is not null."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """audit_filters of docs (doc_id, text, source) by source, with good_lost and toxic_lost from labels (doc_id, quality, toxic).

    Filters, by their failures: A under 50 words; B under 65 % distinct words; C over 5 % capitals A-Z; D any of #$%&*|; E a
    text that a smaller doc_id has, anywhere in the table. Null text is empty, and empty texts are equal. A null doc_id is
    larger than any other and has no label; rows that share the smallest doc_id of a text all pass E. A document is good or
    toxic if any of its labels says so. Other columns are ignored. Runs jobs.

    The first holder of a text joins by digest and doc_id, which no group of copies shares, so a frequent text is one row
    per task and never a hot key.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    known = docs.select(inner_id().alias("doc_id"), F.col("source").cast("string").alias("part"), text.alias("text"))
    known = known.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(f) for f, c in text_conditions(F.col("text")).items()])
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    with Tables(docs.sparkSession) as tables:
        known = tables.put(known, "conditions")
        first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
        marks = broadcast_if_small(tables.put(marks.where("good OR toxic"), "marks"))
        joined = known.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
        fails = {f: F.col(f) for f in "ABCD"} | {"E": F.col("first").isNull()}
        losses = {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")}
        return tables.put(audit_filters(joined, F.col("part"), fails, losses), "steps", keep=True)
