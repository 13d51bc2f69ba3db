"""Fragments of one line merged with the whole line that follows, and display text dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions import text as T
from dialoom.functions.similarity import fuzzy_prefix
from dialoom.session import cut_lineage

from .ordered import NO_CHUNK, neighbour, time_chunk

MAX_GAP_MS = 5000


def exact_prefix(shorter: Column, longer: Column) -> Column:
    a, b = T.ascii_punctuation(shorter), T.ascii_punctuation(longer)
    return (F.char_length(shorter) >= 2) & (F.char_length(shorter) < F.char_length(longer)) & F.startswith(b, a)


def merge_fragments(events: DataFrame, is_prefix: Callable[[Column, Column], Column] = fuzzy_prefix, max_gap_ms: int = MAX_GAP_MS,
                    drop_hud: bool = True, compat: bool = True, chunk_ms: int = 1_800_000) -> DataFrame:
    """events with fragments merged: the next event stays, with the start of the fragment before it.

    A fragment is an event whose text is a prefix of the next one's, of the same speaker (null equals
    null), less than `max_gap_ms` before it. From left to right every pair is merged once, and a merged
    event is not compared again; so in a run of fragments every second one goes. `merged_from` names the
    fragment. Display text is dropped; with `compat` not in videos of fewer than two events. Events without a
    start come first and never merge; those without a video form one of their own.
    """
    order, part = ["start_ms", "event_id"], ["video_id", "_chunk"]
    rows = events.withColumn("_chunk", F.coalesce(time_chunk(F.col("start_ms"), chunk_ms), F.lit(NO_CHUNK)))
    ahead = neighbour(rows, ["video_id"], "_chunk", order, ["start_ms", "speaker", "text"], "next_", following=True)
    gap = F.col("next_start_ms") - F.col("end_ms") < max_gap_ms
    cheap = F.col("next_found") & gap & F.col("speaker").eqNullSafe(F.col("next_speaker")) & (F.char_length("text") < F.char_length("next_text"))
    # the similarity runs for pairs that can merge at all
    flag = F.coalesce(cheap & is_prefix(F.when(cheap, F.col("text")), F.when(cheap, F.col("next_text"))), F.lit(False))
    saved = cut_lineage(ahead.select(*events.columns, "_chunk", flag.alias("_flag"), "next_found"))

    # the length of the run of flags that ends at a row: its parity says who merges
    inside = Window.partitionBy(*part).orderBy(*order)
    numbered = saved.withColumn("_row", F.row_number().over(inside))
    counted = numbered.withColumn("_off", F.max(F.when(F.col("_flag"), 0).otherwise(F.col("_row"))).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    runs = counted.withColumn("_run", F.col("_row") - F.col("_off"))
    last = F.struct(*order)
    chunks = runs.groupBy(*part).agg(
        F.max_by("_run", last).alias("run"), (F.max("_off") == 0).alias("whole"), F.max_by(F.struct("_flag", "start_ms", "event_id"), last).alias("end"))
    # a chunk of flags only goes on with the run of the chunks before it
    between = Window.partitionBy("video_id").orderBy("_chunk")
    linked = chunks.withColumn("group", F.sum(F.when(F.col("whole"), 0).otherwise(1)).over(between.rowsBetween(Window.unboundedPreceding, 0)))
    summed = linked.withColumn("total", F.sum("run").over(Window.partitionBy("video_id", "group").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)))
    carried = summed.select(*part, F.lag("total").over(between).alias("_before"), F.lag("end").over(between).alias("_end"))
    joined = runs.withColumn("_video", F.struct("video_id")).join(  # a video without an id has a struct, too
        carried.select(F.struct("video_id").alias("_video"), "_chunk", "_before", "_end"), ["_video", "_chunk"])
    length = F.col("_run") + F.when(F.col("_off") == 0, F.coalesce("_before", F.lit(0))).otherwise(0)
    marked = joined.withColumn("_goes", F.col("_flag") & (length % 2 == 1))
    here = F.lag(F.struct("_goes", "start_ms", "event_id")).over(inside)
    beyond = F.when(F.col("_end").isNotNull(), F.struct((F.col("_end._flag") & (F.col("_before") % 2 == 1)).alias("_goes"), "_end.start_ms", "_end.event_id"))
    kept = marked.withColumn("_prev", F.coalesce(here, beyond)).filter(~F.col("_goes"))
    came = F.coalesce("_prev._goes", F.lit(False))
    out = kept.withColumns({"start_ms": F.when(came, F.col("_prev.start_ms")).otherwise(F.col("start_ms")), "merged_from": F.when(came, F.col("_prev.event_id"))})
    if drop_hud:
        hud = F.coalesce(T.is_hud(F.col("text")), F.lit(False))
        if compat:  # the only event of a video has no event before and none after it
            hud = hud & (F.col("_prev").isNotNull() | F.col("next_found"))
        out = out.filter(~hud)
    return out.select(*events.columns, "merged_from")
