"""Timelines: sampling on a grid, the state at a time, and changes between neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.session import cut_lineage

from .ordered import neighbour, running, time_chunk

#: A frame this much before the grid time still serves.
TOLERANCE_S = 0.1


def sample_grid(frames: DataFrame, step: float, columns: list[str], key: str = "key", ts: str = "ts", start: float = 0.0,
                end: float | None = None, tolerance: float = TOLERANCE_S, chunk_s: float = 3600.0) -> DataFrame:
    """(key, grid_ts, frame_ts, columns): for each grid time the first frame at or after it, less the tolerance, however far ahead.

    A forward as-of join without a join: a frame serves the grid times that lie after what its predecessor
    serves, so every result row is made once, from its frame and that one's time. The grid ends with the
    last frame of a key, or before `end`. Of frames at one time the one with the least values serves.
    Frames without a time serve none; an empty table gives no rows.
    """
    rows = frames.filter(F.col(ts).isNotNull()).select(key, ts, *columns).withColumn("_chunk", time_chunk(F.col(ts), chunk_s))
    near = neighbour(rows, [key], "_chunk", [ts, *columns], [ts], "before_")
    slot_of = lambda time: F.floor((time + tolerance - start) / float(step)).cast("bigint")
    # one slot more at either side; the exact comparison below decides, as a division is rounded
    low = F.greatest(F.coalesce(slot_of(F.col(f"before_{ts}")), F.lit(0)), F.lit(0))
    slots = F.sequence(low, F.greatest(slot_of(F.col(ts)) + 1, low))
    sent = near.select(key, ts, f"before_{ts}", *columns, F.explode(slots).alias("slot")).withColumn("grid_ts", F.col("slot") * F.lit(float(step)) + start)
    from_ = F.col("grid_ts") - tolerance
    served = (F.col(ts) >= from_) & ~F.coalesce(F.col(f"before_{ts}") >= from_, F.lit(False))
    if end is not None:
        served = served & (F.col("grid_ts") < end)
    return sent.filter(served).select(key, "grid_ts", F.col(ts).alias("frame_ts"), *columns)


def frame_at(frames: DataFrame, times: DataFrame, key: str = "key", ts: str = "ts", columns: tuple[str, ...] = (), chunk_s: float = 3600.0) -> DataFrame:
    """(key, at, frame_ts, columns): the first frame at or after each asked time; null where there is none.

    Asked times and frames are one sequence in which every asked time looks ahead to the next frame, so no
    pairs are made. Of frames at one time the one with the least values counts.
    """
    frame = F.struct(F.col(ts), *columns)
    shown = frames.filter(F.col(ts).isNotNull()).select(key, F.col(ts).cast("double").alias("_at_ts"), frame.alias("_frame"))
    asked = times.select(key, F.col("at").cast("double").alias("_at_ts")).distinct().select(key, "_at_ts", F.lit(None).cast(shown.schema["_frame"].dataType).alias("_frame"))
    both = shown.unionByName(asked).withColumns({"_chunk": time_chunk(F.col("_at_ts"), chunk_s), "_shown": F.col("_frame").isNotNull()})
    ahead = running(both, [key], "_chunk", ["_at_ts", "_shown", "_frame"], F.col("_frame"), "last", "_next", backwards=True)
    return ahead.filter(~F.col("_shown")).select(
        key, F.col("_at_ts").alias("at"), F.col("_next")[ts].alias("frame_ts"), *[F.col("_next")[c].alias(c) for c in columns])


def detect_changes(signal: DataFrame, key: str = "key", ts: str = "ts", value: str = "value", threshold: float = 0.05, scale: float = 255.0, chunk_s: float = 86_400.0, ties: tuple[str, ...] = ()) -> DataFrame:
    """(key, ts, value, diff_ratio, changed): the difference from the value before, as a share of `scale`.

    Strictly greater than the threshold is a change; the first value of a key is one, with ratio 1.
    """
    chunked = signal.select(key, ts, value, *ties).withColumn("_chunk", time_chunk(F.col(ts), chunk_s))
    with_before = neighbour(chunked, [key], "_chunk", [ts, *ties], [value], "before_")
    ratio = F.when(F.col("before_found"), F.abs(F.col(value) - F.col(f"before_{value}")) / scale).otherwise(1.0)
    return with_before.select(key, ts, *ties, value, F.round(ratio, 9).alias("diff_ratio"), (ratio > threshold).alias("changed"))


def progress_ticks(signal: DataFrame, key: str, ts: str, every: float = 30.0) -> DataFrame:
    """(key, tick, n): the rows per stretch of `every` seconds."""
    return signal.groupBy(key, F.floor(F.col(ts) / every).cast("bigint").alias("tick")).agg(F.count("*").alias("n"))


def run_lengths(signal: DataFrame, key: str, order: list[str], state: str, chunk_size: float = 1_800_000) -> DataFrame:
    """(key, state, first, last, n): runs of equal state in the given order; first and last are values of the first order column."""
    rows = signal.select(key, *order, state).withColumn("_chunk", time_chunk(F.col(order[0]), chunk_size))
    before = neighbour(rows, [key], "_chunk", order, [state], "before_")
    starts = cut_lineage(before.select(key, *order, state, "_chunk", F.when(F.col("before_found") & F.col(f"before_{state}").eqNullSafe(F.col(state)), 0).otherwise(1).alias("_start")))
    numbered = running(starts, [key], "_chunk", order, F.col("_start"), "sum", "_run")
    return numbered.groupBy(key, "_run").agg(
        F.min_by(state, F.struct(*order)).alias(state), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.count("*").alias("n")).drop("_run")
