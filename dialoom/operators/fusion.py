"""Choice between a primary and a fallback recognition of the same thing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.7


def choose(primary: Column, fallback: Column, threshold: Column | float = THRESHOLD) -> Column:
    """struct(engine, text, confidence, reason) of two candidates, each a struct(engine, text, confidence).

    The fallback is looked at only where it exists and the primary is below the threshold; it wins with
    more confidence, or with equal confidence and more text.
    """
    tried = fallback.isNotNull() & (primary["confidence"] < threshold)
    surer = tried & (fallback["confidence"] > primary["confidence"])
    longer = tried & (fallback["confidence"] == primary["confidence"]) & (F.char_length(fallback["text"]) > F.char_length(primary["text"]))
    reason = (F.when(surer, F.format_string("fallback:%s(conf %.3f>%.3f)", fallback["engine"], fallback["confidence"], primary["confidence"]))
              .when(longer, F.format_string("fallback:%s(longer text)", fallback["engine"]))
              .when(tried, F.format_string("primary:%s(fallback tried, primary kept)", primary["engine"]))
              .otherwise(F.format_string("primary:%s", primary["engine"])))
    pick = lambda c: F.when(surer | longer, fallback[c]).otherwise(primary[c])
    return F.struct(pick("engine").alias("engine"), pick("text").alias("text"), pick("confidence").alias("confidence"), reason.alias("reason"))


def fuse_candidates(events: DataFrame, candidates: str = "ocr_candidates", threshold: float = THRESHOLD) -> DataFrame:
    """events with chosen_engine, chosen_text, chosen_confidence, selection_reason and n_candidates, from the first two candidates."""
    first, second = F.try_element_at(candidates, F.lit(1)), F.try_element_at(candidates, F.lit(2))
    chosen = F.when(first.isNotNull(), choose(first, second, threshold))
    tried = second.isNotNull() & (first["confidence"] < threshold)
    return events.withColumn("_c", chosen).withColumns({
        "chosen_engine": F.col("_c.engine"), "chosen_text": F.col("_c.text"), "chosen_confidence": F.col("_c.confidence"), "chosen_reason": F.col("_c.reason"),
        "n_candidates": F.when(first.isNull(), 0).when(tried, 2).otherwise(1)}).drop("_c")


def fuse_tables(primary: DataFrame, fallback: DataFrame, key: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """The same from two tables (key, engine, text, confidence). Only rows below the threshold meet the fallback table,
    so a recogniser behind it runs for those only."""
    fields = F.struct("engine", "text", "confidence")
    low = primary.filter(F.col("confidence") < threshold).select(*key, fields.alias("p")).join(
        fallback.select(*key, fields.alias("f")), key, "left")
    high = primary.filter(~F.coalesce(F.col("confidence") < threshold, F.lit(False))).select(*key, fields.alias("p")).withColumn("f", F.lit(None).cast(low.schema["f"].dataType))
    both = low.unionByName(high)
    return both.select(*key, choose(F.col("p"), F.col("f"), threshold).alias("c")).select(*key, "c.*")


def combine_lines(lines: DataFrame, key: list[str], position: str = "position", text: str = "text", confidence: str = "confidence") -> DataFrame:
    """One row per key: the texts in order joined by a blank, and the plain mean of the confidences."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    return lines.groupBy(*key).agg(F.array_join(F.transform(ordered, lambda x: x["t"]), " ").alias("text"), F.round(F.avg(confidence), 6).alias("confidence"))
