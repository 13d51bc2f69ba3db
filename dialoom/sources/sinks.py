"""Transcripts, events, summaries and review pages as files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.functions import text as T
from dialoom.operators import events as E


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines with all fields, null ones too: a record without one could not be read again."""
    events.write.mode(mode).option("ignoreNullFields", "false").json(path)


def replace_events(events: DataFrame, path: str) -> None:
    """Writes beside the folder, then swaps: Spark cannot overwrite what it still reads.

    A lost job leaves the old folder whole; so does a swap that fails, which raises OSError. The old rows
    are deleted only when the new ones stand in their place.
    """
    spark = events.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fresh, old = f"{path}.{uuid.uuid4().hex}", f"{path}.{uuid.uuid4().hex}"
    events.write.mode("errorifexists").option("ignoreNullFields", "false").json(fresh)
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(hadoop(path))
    if had and not fs.rename(hadoop(path), hadoop(old)):
        raise OSError(f"{path} could not be put aside; the new events are in {fresh}")
    if not fs.rename(hadoop(fresh), hadoop(path)):
        restored = not had or fs.rename(hadoop(old), hadoop(path))
        raise OSError(f"the new events could not be put in place and are in {fresh}" + ("" if restored else f"; the old ones are in {old}"))
    if had and not fs.delete(hadoop(old), True):
        raise OSError(f"the old events could not be deleted from {old}")


def write_transcripts(events: DataFrame, path: str) -> None:
    """Folders clean and review under `path`, partitioned by video, lines in time order with a blank one after each."""
    for name, flagged in (("clean", False), ("review", True)):
        lines = E.transcript(events, flagged, "start_ms")
        ordered = lines.repartitionByRange("video_id", "start_ms", "event_id").sortWithinPartitions("video_id", "start_ms", "event_id")
        ordered.select("video_id", F.concat("line", F.lit("\n")).alias("value")).write.mode("overwrite").partitionBy("video_id").text(f"{path}/{name}")


def write_review_pages(events: DataFrame, path: str) -> None:
    """The pages of `review_pages`, a file each, partitioned by video and page."""
    E.review_pages(events).select("video_id", "page", F.col("html").alias("value")).repartition("video_id", "page").write.mode("overwrite").partitionBy("video_id", "page").text(path)


def write_books(books: DataFrame, path: str, key: str = "path") -> None:
    """The text of each book (key, text) as a file of its own."""
    books.select(key, F.col("text").alias("value")).repartition(key).write.mode("overwrite").partitionBy(key).text(path)


def write_recognised(segments: DataFrame, path: str) -> None:
    """Lines `[HH:MM:SS] text` of recognised speech (video_id, start_ms, text), partitioned by video; videos with a folder under `path` are skipped."""
    spark = segments.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    there = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if there.exists(hadoop(path)) and len(there.globStatus(hadoop(f"{path}/video_id=*"))):
        written = spark.read.text(path).select("video_id").distinct()  # the folders alone would do, but the driver need not hold them
        segments = segments.join(written, "video_id", "left_anti")
    lines = segments.select("video_id", "start_ms", F.concat(T.stamp(F.col("start_ms")), F.lit(" "), T.strip(F.col("text"))).alias("value"))
    ordered = lines.repartitionByRange("video_id", "start_ms").sortWithinPartitions("video_id", "start_ms", "value")
    ordered.select("video_id", "value").write.mode("append").partitionBy("video_id").text(path)


def write_batch_summary(runs: DataFrame, path: str) -> None:
    E.batch_summary(runs).write.mode("overwrite").json(path)
