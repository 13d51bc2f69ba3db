"""The inputs of the operators, taken from the tables at hand."""

from __future__ import annotations

import io
import zipfile
from html import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators import events as E


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Event rows, one per key."""
    return E.distinct_events(table(spark, folder, "dialogue_events"))


def events_with_work(spark: SparkSession, folder: str) -> DataFrame:
    runs = table(spark, folder, "video_runs").select("video_id", "work_id", "kind", "status")
    return events(spark, folder).join(runs, "video_id")


def with_number(df: DataFrame) -> DataFrame:
    return df.withColumn("number", F.regexp_extract("event_id", r"(\d+)$", 1).cast("bigint"))


#: What a frame shows of an event: i counts the frames, n the characters of the text. Lines are typed out in steps or come at
#: once, flicker, linger, give way to the next one, or are followed by one to four empty frames. Null: no such frame.
SHOWN = """case "number" % 6
    when 0 then case when i = 0 then left("text", cast(floor(n * 3 / 10) as int)) when i = 1 then left("text", cast(floor(n * 6 / 10) as int))
                     when i <= 8 then "text" when i <= 11 then '' end
    when 1 then case when i <= 3 then "text" end
    when 2 then case when i <= 8 then "text" when i <= 10 then '' end
    when 3 then case when i = 0 then left("text", cast(floor(n * 2 / 10) as int)) when i = 1 then left("text", cast(floor(n * 5 / 10) as int))
                     when i = 2 then left("text", cast(floor(n * 8 / 10) as int)) when i <= 5 then "text" when i = 6 then '' end
    when 4 then case when i <= 1 then "text" when i = 2 then '' when i <= 5 then "text" when i <= 9 then '' end
    else case when i <= 11 then "text" end end"""
#: The same for lines whose segmentation SQL can follow: four fifths are typed, then the whole line stands until it is stable.
SHOWN_PLAINLY = """case when i = 0 then left("text", cast(floor(n * 8 / 10) as int)) when i <= 8 then "text" else '' end"""


def frames(spark: SparkSession, folder: str, shown: str = SHOWN) -> DataFrame:
    """Observations of every event, up to twelve frames each, with what stands in the name box and the candidates.

    The box is blank on the first frame of some events, and never read for sure on others.
    """
    rows = with_number(events(spark, folder)).select(
        "video_id", "number", "confidence", "text", "speaker", F.char_length("text").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("i"))
    text = F.expr(shown.replace('"', "`"))
    name = F.when((F.col("number") % 3 != 0) | (F.col("i") > 0), F.col("speaker"))
    candidate = F.struct(F.format_string("frame %d", F.col("i")).alias("engine"), text.alias("text"), F.col("confidence"))
    return rows.select(
        "video_id", "number", (F.col("number") * 6.0 + F.col("i") * 0.5).alias("ts"), text.alias("text"), "confidence", name.alias("name"),
        F.when(F.col("number") % 3 == 1, 0.4).otherwise(0.9).alias("name_confidence"), F.array(candidate).alias("candidates")).filter("text is not null")


def fragments(spark: SparkSession, folder: str) -> DataFrame:
    """Event rows with the first half of every third event put before it as a fragment."""
    rows = with_number(events(spark, folder)).select("video_id", "event_id", "number", "start_ms", "end_ms", "speaker", "text", "confidence", "review_required")
    cut = rows.filter((F.col("number") % 3 == 0) & (F.char_length("text") >= 8)).select(
        "video_id", F.concat("event_id", F.lit("a")).alias("event_id"), "number", (F.col("start_ms") - 1000).alias("start_ms"), (F.col("start_ms") - 100).alias("end_ms"),
        "speaker", F.left("text", F.floor(F.char_length("text") / 2).cast("int")).alias("text"), "confidence", "review_required")
    return rows.unionByName(cut).drop("number")


def gold(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted corrections as a gold transcript with the times of their events; the greatest text of an event."""
    accepted = table(spark, folder, "corrections").filter("accepted and text is not null").groupBy("video_id", "event_id").agg(F.max("text").alias("text"))
    times = events(spark, folder).select("video_id", "event_id", "start_ms", "end_ms")
    return accepted.join(times, ["video_id", "event_id"]).select("video_id", F.col("event_id").alias("gold_id"), "start_ms", "end_ms", "text")


#: The pages: well-formed markup with entities around the whole text, whose own signs are escaped. Lists, tables, headings and empty
#: elements stand in turn; a script holds what looks like an end tag.
PAGE_HEAD = """<html><head><title>{title}</title><style>p > b {{ color: red }}</style></head><body><h2>{title} &amp; more</h2><script>var a = "</p>";</script>"""
PAGE_TAIL = """<ul><li>first</li><li>second &lt;2&gt;</li></ul><table><tr><td>a</td></tr></table><p/><br/>end&nbsp;of page<br></body></html>"""


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as HTML pages; every blank line of a text ends a paragraph."""
    safe = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    body = F.concat(F.lit("<p>"), F.replace(safe, F.lit("\n\n"), F.lit("</p><p>")), F.lit("</p>"))
    head = F.replace(F.lit(PAGE_HEAD.format(title="@")), F.lit("@"), F.coalesce("source", F.lit("")))
    return table(spark, folder, "documents").filter("text is not null").select("doc_id", F.concat(head, body, F.lit(PAGE_TAIL)).alias("html"))


def signal(spark: SparkSession, folder: str) -> DataFrame:
    """A numeric timeline per user."""
    return table(spark, folder, "events").select(F.col("user_id").alias("key"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).alias("ts"), "value", "event_id")


def books(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content): the chapters of each work as an e-book; what is not read stands between them."""
    rows = table(spark, folder, "documents").filter("source = 'novel_chapter' and work_id is not null").select("work_id", "doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def bind(chapters: pd.DataFrame) -> pd.DataFrame:
        chapters = chapters.sort_values("doc_id")
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="in/b.opf"/></rootfiles></container>')
            items = "".join(f'<item id="c{d}" href="{d}.xhtml" media-type="application/xhtml+xml"/>' for d in chapters["doc_id"])
            spine = "".join(f'<itemref idref="c{d}"/><itemref idref="cover"/>' for d in chapters["doc_id"])
            z.writestr("in/b.opf", f'<package><manifest>{items}<item id="cover" href="c.png" media-type="image/png"/></manifest><spine>{spine}</spine></package>')
            for d, text in zip(chapters["doc_id"], chapters["text"]):
                z.writestr(f"in/{d}.xhtml", f"<html><body><p>{escape(text)}</p></body></html>".encode("utf-8", "replace"))
        return pd.DataFrame({"path": [chapters["work_id"].iloc[0]], "content": [out.getvalue()]})

    return rows.groupBy("work_id").applyInPandas(bind, "path string, content binary")  # a book is one file, whatever makes it
