"""The queries of this subpackage: name -> (session, folder of the tables) -> result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.session import cut_lineage

from . import lookalike, mixture, names, reading, runs, tokens, truncation, turns


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.collapse_runs(_table(spark, folder, "dialogue_events"))
    return found.filter("n_events > 1").select("video_id", "first_event_id", "last_event_id").distinct()


def p1_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    """Every event, runs as one with their count and duration."""
    return runs.collapse_runs(_table(spark, folder, "dialogue_events"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.detect_cuts(_table(spark, folder, "dialogue_events")).select("video_id", "event_id").distinct()


def p2_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Per capture source the share of events that were cut."""
    return truncation.cut_shares(_table(spark, folder, "dialogue_events"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    found = names.link_events(_table(spark, folder, "dialogue_events"), _table(spark, folder, "video_runs"), _table(spark, folder, "work_configs"))
    return found.select("video_id", "event_id", "canonical").distinct()


def p4_spellings(spark: SparkSession, folder: str) -> DataFrame:
    """The spellings of each member of a cast, the round that merged them, and the number of events."""
    found = names.link_events(_table(spark, folder, "dialogue_events"), _table(spark, folder, "video_runs"), _table(spark, folder, "work_configs"))
    return found.groupBy("canonical", "speaker", "round").agg(F.count("*").alias("n_events"))


def p4_others(spark: SparkSession, folder: str) -> DataFrame:
    """The spellings of whoever is in no cast, merged with each other."""
    typed = cut_lineage(names.typed_speakers(_table(spark, folder, "dialogue_events"), _table(spark, folder, "video_runs")))
    spellings = typed.groupBy("work_id", "speaker").agg(F.sum("n").alias("n"))
    linked = names.link_spellings(spellings.select("work_id", "speaker"), _table(spark, folder, "work_configs"))
    return names.group_others(spellings, linked)


def _forms(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.normal_forms(_table(spark, folder, "dialogue_events"), ["video_id", "event_id"], ["speaker", "text"])


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _forms(spark, folder).select("video_id", "event_id", "field").distinct()


def p5_forms(spark: SparkSession, folder: str) -> DataFrame:
    """The values that needed another form, with it and the number of events."""
    return _forms(spark, folder).groupBy("field", "value", "normal").agg(F.count("*").alias("n_events"))


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    return turns.speaker_turns(_table(spark, folder, "spoken_events"), _table(spark, folder, "video_runs"), _table(spark, folder, "work_configs"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    found = _turns(spark, folder).filter("speaker is not null")
    return found.select("video_id", "first_event_id", "last_event_id", "speaker").distinct()


def p6_turns(spark: SparkSession, folder: str) -> DataFrame:
    """The clean turns with their text and times."""
    return _turns(spark, folder)


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_corpus(_table(spark, folder, "documents"))


def _mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    sized = cut_lineage(tokens.count_tokens(docs))
    return mixture.mix(sized, _table(spark, folder, "mix_targets"))[0]


def p8_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return _mixture(spark, folder)


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.share_report(_mixture(spark, folder), _table(spark, folder, "mix_targets"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    found = reading.reading_levels(_table(spark, folder, "documents"), _table(spark, folder, "reading_labels"))
    return found.select("doc_id", "level").distinct()


def p9_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus by source and level."""
    docs = _table(spark, folder, "documents")
    found = reading.reading_levels(docs, _table(spark, folder, "reading_labels"))
    return docs.select("doc_id", "source").join(found, "doc_id").groupBy("source", "level").agg(
        F.count("*").alias("n_docs"), F.round(F.avg("score"), 3).alias("mean_score"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_collapsed": p1_collapsed,
    "p2_found": p2_found,
    "p2_shares": p2_shares,
    "p4_found": p4_found,
    "p4_spellings": p4_spellings,
    "p4_others": p4_others,
    "p5_found": p5_found,
    "p5_forms": p5_forms,
    "p6_found": p6_found,
    "p6_turns": p6_turns,
    "p7_ids": p7_ids,
    "p8_mixture": p8_mixture,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_profile": p9_profile,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {}
