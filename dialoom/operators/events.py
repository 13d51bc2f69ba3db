"""Event rows: one row per key, run and batch summaries, corrections, numbering, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions import text as T

KEY = ["video_id", "event_id"]


def distinct_events(events: DataFrame) -> DataFrame:
    """One row per (video_id, event_id); of redelivered rows the greatest value of each field that may differ.

    Aggregated before the shuffle, so a key that was delivered very often is no hot key.
    """
    return events.groupBy(*KEY).agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.max("speaker").alias("speaker"), F.max("text").alias("text"),
        F.max("confidence").alias("confidence"), F.max("review_required").alias("review_required"), F.max("source_file").alias("source_file"))


def transcript(events: DataFrame, include_flagged: bool = False, *others: str) -> DataFrame:
    """(video_id, event_id, others, line): rendered lines; without the events that need review unless asked for."""
    kept = events if include_flagged else events.filter(~F.coalesce("review_required", F.lit(False)))
    return kept.select(*KEY, *others, T.transcript_line(F.col("start_ms"), F.col("speaker"), F.col("text")).alias("line"))


def srt(events: DataFrame) -> DataFrame:
    body = F.when(F.coalesce("speaker", F.lit("")) != "", F.concat("speaker", F.lit(": "), "text")).otherwise(F.col("text"))
    times = F.concat(T.srt_stamp(F.col("start_ms")), F.lit(" --> "), T.srt_stamp(F.col("end_ms")))
    return events.select(*KEY, F.concat(times, F.lit("\n"), body).alias("cue"))


def markdown(events: DataFrame) -> DataFrame:
    body = F.when(F.coalesce("speaker", F.lit("")) != "", F.concat(F.lit("**"), "speaker", F.lit("**: "), "text")).otherwise(F.col("text"))
    return events.select(*KEY, F.concat(F.lit("- `"), T.stamp(F.col("start_ms")), F.lit("` "), body).alias("line"))


def review_cards(events: DataFrame) -> DataFrame:
    """(video_id, event_id, card): an HTML card for each flagged event; values are escaped."""
    safe = {c: T.escape_html(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in (*KEY, "speaker", "text")}
    card = F.concat(F.lit('<div class="card" data-event="'), safe["event_id"], F.lit('"><span class="time">'), T.stamp(F.col("start_ms")),
                    F.lit('</span><input name="speaker" value="'), safe["speaker"], F.lit('"><textarea name="text">'), safe["text"], F.lit("</textarea></div>"))
    return events.filter("review_required").select(*KEY, card.alias("card"))


#: Cards on one page of a review.
PAGE_CARDS = 500
PAGE_TOP = """<!DOCTYPE html><html><head><meta charset="utf-8"><title>Review</title><style>.card{border:1px solid #999;margin:8px;padding:8px}</style></head><body><button onclick="save()">Save</button>"""
PAGE_END = """<script>function save(){var out=[].map.call(document.querySelectorAll(".card"),function(c){return{event_id:c.dataset.event,speaker:c.querySelector("input").value,text:c.querySelector("textarea").value,accepted:true}});var a=document.createElement("a");a.href=URL.createObjectURL(new Blob([JSON.stringify(out)],{type:"application/json"}));a.download="corrections.json";a.click()}</script></body></html>"""


def review_pages(events: DataFrame, cards: int = PAGE_CARDS) -> DataFrame:
    """(video_id, page, html): self-contained pages of the flagged events, whose corrections can be saved as JSON.

    Event numbers cut a video into pages, so that no page grows with the video.
    """
    made = review_cards(events).withColumn("page", F.floor(F.coalesce(number_of(F.col("event_id")), F.lit(0)) / cards).cast("bigint"))
    ordered = F.array_sort(F.collect_list(F.struct("event_id", "card")))  # `cards` of them at most
    whole = F.array_join(F.transform(ordered, lambda c: c["card"]), "")
    return made.groupBy("video_id", "page").agg(F.concat(F.lit(PAGE_TOP), whole, F.lit(PAGE_END)).alias("html"))


def artifact_columns(events: DataFrame, save_crops: bool = False) -> DataFrame:
    """The image files that belong to each event: crops if asked for or flagged, the whole frame if flagged."""
    flagged = F.coalesce("review_required", F.lit(False))
    crop = flagged | F.lit(save_crops)
    base = F.concat(F.lit("crops/"), "video_id", F.lit("/"), "event_id")
    return events.select(
        *KEY, F.when(crop, F.concat(base, F.lit("_dialog.png"))).alias("roi_crop_file"),
        F.when(crop & F.col("speaker").isNotNull(), F.concat(base, F.lit("_name.png"))).alias("name_crop_file"),
        F.when(flagged, F.concat(base, F.lit("_frame.png"))).alias("frame_file"))


def apply_corrections(events: DataFrame, corrections: DataFrame, last: Column) -> DataFrame:
    """Events with the last correction of each applied: speaker and text are overwritten, a null stays; an accepted one clears the flag.

    `last` orders the corrections of one event. Corrections that point at no event are ignored.
    """
    latest = corrections.groupBy(*KEY).agg(F.max_by(F.struct("speaker", "text", "accepted"), last).alias("c"))
    joined = events.join(latest, KEY, "left")
    hit = F.col("c").isNotNull()
    return joined.withColumns({
        "speaker": F.when(hit, F.coalesce("c.speaker", "speaker")).otherwise(F.col("speaker")),
        "text": F.when(hit, F.coalesce("c.text", "text")).otherwise(F.col("text")),
        "review_required": F.when(hit & F.coalesce("c.accepted", F.lit(False)), False).otherwise(F.col("review_required")),
        "corrected": hit}).drop("c")


def run_summary(events: DataFrame) -> DataFrame:
    return events.groupBy("video_id").agg(
        F.count("*").alias("total_events"), F.count_if("review_required").alias("review_count"), F.round(F.max("end_ms") / 1000, 3).alias("duration_processed"))


def batch_summary(runs: DataFrame) -> DataFrame:
    return runs.groupBy("work_id").agg(
        F.count("*").alias("total_videos"), F.count_if(F.col("status") == "ok").alias("succeeded"), F.count_if(F.col("status") == "error").alias("failed"),
        F.sum("total_events").alias("total_events"))


def union_summaries(ok: DataFrame, errors: DataFrame) -> DataFrame:
    """Summaries of different fields in one table."""
    return ok.unionByName(errors, allowMissingColumns=True)


def number_of(event_id: Column) -> Column:
    """The number at the end of an event id; null where it has none."""
    return F.regexp_extract(event_id, r"(\d{1,18})$", 1).try_cast("bigint")


def last_event(events: DataFrame) -> DataFrame:
    """Per video the id of the event that was written last, which is the one with the greatest number, and the number of events."""
    place = F.struct(number_of(F.col("event_id")), F.col("event_id"))
    return events.groupBy("video_id").agg(F.max_by("event_id", place).alias("last_event_id"), F.count("*").alias("event_count"))


def resume_points(events: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """(video_id, last_processed_ms, event_count): where each checkpointed video goes on, and the number of its last event.

    A checkpoint (video_id, last_event_id, last_processed_ms) that names another last event than the
    written events have raises an error: going on would repeat or lose some. One without a last event, or
    a video without events, goes on with what is there.
    """
    tail = last_event(events).withColumnRenamed("last_event_id", "_written")
    joined = checkpoints.select("video_id", "last_event_id", "last_processed_ms").join(tail, "video_id", "left")
    differs = (F.coalesce("last_event_id", F.lit("")) != "") & F.col("_written").isNotNull() & (F.col("_written") != F.col("last_event_id"))
    message = F.concat(F.lit("checkpoint of "), "video_id", F.lit(" names "), "last_event_id", F.lit(", its events end with "), "_written")
    count = F.when(differs, F.raise_error(message).cast("bigint")).otherwise(F.coalesce("event_count", F.lit(0)))
    return joined.select("video_id", "last_processed_ms", count.alias("event_count"))


def after_checkpoint(events: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """The events that start after their video's last processed time; all of a video without a checkpoint."""
    joined = events.join(checkpoints.select("video_id", "last_processed_ms"), "video_id", "left")
    return joined.filter(F.col("last_processed_ms").isNull() | (F.col("start_ms") > F.col("last_processed_ms"))).drop("last_processed_ms")


def pending(inputs: DataFrame, outputs: DataFrame, on: str = "video_id") -> DataFrame:
    """Inputs without an output."""
    return inputs.join(outputs.select(on).distinct(), on, "left_anti")
