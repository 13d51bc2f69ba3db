"""Quality of events against a gold transcript, and of themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.functions import text as T

from .ordered import neighbour, time_chunk


def match_intervals(events: DataFrame, gold: DataFrame, bucket_ms: int = 60_000) -> DataFrame:
    """(video_id, gold_id, gold_text, event_id, text, overlap_ms): for each gold row the event that overlaps it most, the earliest of several; nulls without one.

    gold: (video_id, gold_id, start_ms, end_ms, text). Both sides are sent to the time buckets they
    touch and joined by (video, bucket), so that no video is joined with itself as a whole.
    """
    def bucketed(df: DataFrame) -> DataFrame:
        low, high = F.floor(F.col("start_ms") / bucket_ms), F.floor(F.greatest("start_ms", "end_ms") / bucket_ms)
        return df.withColumn("_bucket", F.explode(F.sequence(low, high)))

    e = bucketed(events.select("video_id", F.col("event_id"), F.col("start_ms"), F.col("end_ms"), F.col("text")))
    g = bucketed(gold.select("video_id", "gold_id", "start_ms", "end_ms").dropDuplicates()).select("video_id", "_bucket", "gold_id", F.col("start_ms").alias("g0"), F.col("end_ms").alias("g1"))
    pairs = g.join(e, ["video_id", "_bucket"]).filter((F.col("start_ms") < F.col("g1")) & (F.col("g0") < F.col("end_ms")))
    overlap = F.least("end_ms", "g1") - F.greatest("start_ms", "g0")
    best = pairs.groupBy("video_id", "gold_id").agg(
        F.max_by(F.struct("event_id", "text", overlap.alias("overlap_ms")), F.struct(overlap, -F.col("start_ms"), F.col("event_id"))).alias("m"))
    return gold.select("video_id", "gold_id", F.col("text").alias("gold_text")).join(best, ["video_id", "gold_id"], "left").select(
        "video_id", "gold_id", "gold_text", "m.event_id", "m.text", "m.overlap_ms")


def recall(matches: DataFrame) -> DataFrame:
    return matches.agg(F.count("*").alias("n_gold"), F.count("event_id").alias("n_recalled"), F.round(F.count("event_id") / F.count("*"), 6).alias("recall"))


def character_error_rate(matches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean edit distance in code points as a share of the gold text's length, over matched rows with a gold text; a null text counts as empty."""
    scored = matches.filter("event_id is not null and gold_text <> ''").withColumn("cer", F.levenshtein(F.coalesce("text", F.lit("")), F.col("gold_text")) / F.char_length("gold_text"))
    return scored.groupBy(*(by or [])).agg(F.count("*").alias("n_matched"), F.round(F.avg("cer"), 6).alias("mean_cer"))


def duplicate_rate(events: DataFrame, chunk_ms: int = 1_800_000) -> DataFrame:
    """(n_events, n_duplicates, duplicate_rate): events whose normalised text equals that of the event of the same video and speaker before."""
    rows = events.select("video_id", "event_id", "start_ms", F.coalesce("speaker", F.lit("")).alias("speaker"), T.strip(T.ascii_punctuation(F.col("text"))).alias("norm"))
    near = neighbour(rows.withColumn("_chunk", time_chunk(F.col("start_ms"), chunk_ms)), ["video_id", "speaker"], "_chunk", ["start_ms", "event_id"], ["norm"], "before_")
    repeated = F.col("before_found") & (F.col("before_norm") == F.col("norm"))
    return near.agg(F.count("*").alias("n_events"), F.count_if(repeated).alias("n_duplicates"), F.round(F.count_if(repeated) / F.count("*"), 6).alias("duplicate_rate"))


def review_rate(events: DataFrame, by: list[str]) -> DataFrame:
    return events.groupBy(*by).agg(F.count("*").alias("n_events"), F.count_if("review_required").alias("n_review"), F.round(F.count_if("review_required") / F.count("*"), 6).alias("review_rate"))


def speaker_accuracy(events: DataFrame, corrections: DataFrame) -> DataFrame:
    """Over events with an accepted correction: how often the stored speaker was the corrected one."""
    right = corrections.filter("accepted and speaker is not null").groupBy("video_id", "event_id").agg(F.max_by("speaker", "submitted_at").alias("meant"))
    both = events.join(right, ["video_id", "event_id"])
    same = F.coalesce("speaker", F.lit("")) == F.col("meant")
    return both.agg(F.count("*").alias("n_checked"), F.count_if(same).alias("n_right"), F.round(F.count_if(same) / F.count("*"), 6).alias("accuracy"))
