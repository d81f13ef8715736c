"""Tumbling windows and sessions over event time, with late rows, as a stream of files that is run until it is done."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableops.streaming.runs import Run, run_available

WINDOW = "window"


def event_windows(rows: DataFrame, time: str, by: Sequence[str], length: str, metrics: Sequence[Column], delay: str | None = None, slide: str | None = None) -> DataFrame:
    """Aggregates of windows of ``length`` (and every ``slide``): (window_start, window_end, by, metrics).

    The same on a table and on a stream. On a stream ``delay`` is how long after the latest time seen a row may come: a window
    is given out once, when no row can reach it any more, and its state is dropped; rows that come later are dropped and
    counted by the run. Rows without a time are in no window.
    """
    window = F.window(F.col(time), length, slide) if slide else F.window(F.col(time), length)
    return _grouped(rows, time, by, window, metrics, delay)


def sessions(rows: DataFrame, time: str, by: Sequence[str], gap: str, metrics: Sequence[Column], delay: str | None = None) -> DataFrame:
    """Aggregates of sessions: rows of a key that follow each other within ``gap``; window_end is the last time plus the gap.

    As event_windows otherwise. Partial sessions are merged before the shuffle.
    """
    return _grouped(rows, time, by, F.session_window(F.col(time), gap), metrics, delay)


def _grouped(rows: DataFrame, time: str, by: Sequence[str], window: Column, metrics: Sequence[Column], delay: str | None) -> DataFrame:
    if rows.isStreaming and delay is None:
        raise ValueError("A stream needs a delay, or its state would grow without end")
    rows = rows.where(F.col(time).isNotNull())
    rows = rows.withWatermark(time, delay) if rows.isStreaming else rows
    found = rows.groupBy(window.alias(WINDOW), *by).agg(*metrics)
    return found.select(F.col(f"{WINDOW}.start").alias("window_start"), F.col(f"{WINDOW}.end").alias("window_end"), *[c for c in found.columns if c != WINDOW])


def run_windows(windows: DataFrame, target: str, checkpoint: str) -> Run:
    """Append the windows that have closed to ``target``; open ones stay in the checkpoint's state for the next run."""
    return run_available(windows, target, checkpoint)
