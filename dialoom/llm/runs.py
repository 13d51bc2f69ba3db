"""Runs of consecutive events that say the same line, collapsed into one event each.

Events are ranged by (entity, time, number), so that one hot entity, or one time that very many events share,
spreads over all tasks row by row. In every task the starts of runs form a sorted array and every event finds
its run by binary search in it; then the runs are aggregated. Only the first and last run of an entity in
a task can reach across its border: those few are compared with their neighbours and joined by a window over
the entity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from dialoom.session import cut_lineage

from .sameline import same_line

_PIECE = ("video_id string, chunk int, piece bigint, is_first boolean, is_last boolean, speaker string, first_event_id string, "
          "last_event_id string, first_text string, last_text string, n bigint, start_ms bigint, end_ms bigint")
_COLUMNS = [x.split(" ")[0] for x in _PIECE.split(", ")]


def _starts(video: np.ndarray, speaker: np.ndarray, text: np.ndarray, before: tuple | None) -> np.ndarray:
    """Whether each row begins a run; before: video, speaker and text of the row before the first one."""
    first = before if before is not None else (None, None, None)
    own = [np.concatenate([np.array([f], dtype=object), a]) for f, a in zip(first, (video, speaker, text))]
    fits = (own[0][1:] == own[0][:-1]) & (own[1][1:] == own[1][:-1])
    start = ~(fits & (own[2][1:] == own[2][:-1]))
    for k in np.flatnonzero(fits & start):  # another text of the same speaker
        start[k] = not same_line(own[2][k], own[2][k + 1])
    return start


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The runs of a task's rows. Rows come sorted; a row that was delivered again follows the first one."""
    chunk = TaskContext.get().partitionId()
    before: tuple | None = None  # video, speaker, text and event of the last row
    open_: list | None = None  # the run that may go on with the next batch
    number = 0

    for batch in batches:
        video, event = batch["video_id"].to_numpy(dtype=object), batch["event_id"].to_numpy(dtype=object)
        again = (video == np.concatenate([[before[0] if before else None], video[:-1]])) & (event == np.concatenate([[before[3] if before else None], event[:-1]]))
        batch = batch[~again]
        if not len(batch):
            continue
        video, event = video[~again], event[~again]
        speaker, text = (batch[c].astype(object).where(batch[c].notna(), None).to_numpy(dtype=object) for c in ("speaker", "text"))
        start = _starts(video, speaker, text, before[:3] if before else None)
        before = (video[-1], speaker[-1], text[-1], event[-1])
        size = len(batch)
        goes_on = open_ is not None and not start[0]
        starts = np.flatnonzero(start) if not goes_on else np.concatenate([[0], np.flatnonzero(start)])
        run = np.searchsorted(starts, np.arange(size), side="right") - 1  # an event belongs to the last start at or before it
        ends = np.append(starts[1:], size) - 1
        begin = batch["start_ms"].to_numpy(dtype=float)
        end = np.fmax(begin, batch["end_ms"].to_numpy(dtype=float))
        runs = [[v, chunk, 0, False, False, *rest] for v, *rest in zip(
            video[starts], speaker[starts], event[starts], event[ends], text[starts], text[ends], np.bincount(run, minlength=len(starts)).tolist(),
            np.fmin.reduceat(begin, starts).tolist(), np.fmax.reduceat(end, starts).tolist())]
        if goes_on:
            more = runs.pop(0)
            open_[7], open_[9], open_[10] = more[7], more[9], open_[10] + more[10]
            open_[11], open_[12] = np.fmin(open_[11], more[11]), np.fmax(open_[12], more[12])
        out = []
        for following in runs:
            following[3] = open_ is None or open_[0] != following[0]
            if open_ is not None:
                open_[4] = following[3]
                out.append(open_)
            number += 1
            open_, following[2] = following, number
        yield _frame(out)
    if open_ is not None:
        open_[4] = True
        yield _frame([open_])


def _frame(runs: list[list]) -> pd.DataFrame:
    out = pd.DataFrame(runs, columns=_COLUMNS)
    for c in ("start_ms", "end_ms"):
        out[c] = out[c].astype("Float64").mask(out[c].isna()).astype("Int64")
    return out


@F.pandas_udf(BooleanType())
def _joins(before: pd.Series, after: pd.Series) -> pd.Series:
    return pd.Series([a is not None and b is not None and same_line(a, b) for a, b in zip(before, after)])


def collapse_runs(events: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per run: video_id, speaker, first_event_id, last_event_id, text, n_events, start_ms, end_ms, duration_ms.

    A run is a longest stretch of events of one video, consecutive by start_ms, then by the number at the end of the
    event id, then by the id, with the same stored speaker (null equals null) that say the same line. Single events are
    runs of one. start_ms and end_ms are the least and greatest times in the run; text is its first text. Redelivered
    rows (same video_id and event_id at the same time) count once. Events without start_ms follow after
    all others; null texts are equal to each other; events without video_id or event_id
    are dropped, as they have no place. Other columns are not read. An empty table gives none. parts: of the sorted rows; the
    result does not depend on it.
    """
    rows = events.filter("video_id is not null and event_id is not null").select(
        "video_id", F.col("start_ms").cast("bigint").alias("start_ms"), F.col("end_ms").cast("bigint").alias("end_ms"),
        F.regexp_extract("event_id", r"(\d{1,18})$", 1).try_cast("bigint").alias("number"), "event_id", "speaker", "text")
    place = ["video_id", F.col("start_ms").asc_nulls_last(), "number", "event_id"]
    ordered = rows.repartitionByRange(*([parts] if parts else []), *place).sortWithinPartitions(*place)
    pieces = cut_lineage(ordered.mapInPandas(_pieces, _PIECE))
    # only runs at the border of a task can go on beyond it
    order = Window.partitionBy("video_id").orderBy("chunk", "piece")
    border = pieces.filter("is_first or is_last").withColumns({
        "before": F.lag("last_text").over(order), "same_speaker": F.lag("speaker").over(order).eqNullSafe(F.col("speaker")) & F.lag("n").over(order).isNotNull(),
        "no_text": F.lag("last_text").over(order).isNull() & F.col("first_text").isNull()})
    candidate = F.col("is_first") & F.col("same_speaker")
    joined = border.withColumn("goes_on", candidate & (F.col("no_text") | _joins(F.when(candidate, F.col("before")), F.when(candidate, F.col("first_text")))))
    joined = joined.withColumn("run", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct("chunk", "piece")
    merged = joined.groupBy("video_id", "run").agg(
        F.min_by("speaker", place).alias("speaker"), F.min_by("first_event_id", place).alias("first_event_id"),
        F.max_by("last_event_id", place).alias("last_event_id"), F.min_by("first_text", place).alias("first_text"),
        F.sum("n").alias("n"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))
    columns = ["video_id", "speaker", "first_event_id", "last_event_id", F.col("first_text").alias("text"), F.col("n").alias("n_events"),
               "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms")).alias("duration_ms")]
    inner = pieces.filter("not (is_first or is_last)")
    return inner.select(*columns).unionByName(merged.select(*columns))
