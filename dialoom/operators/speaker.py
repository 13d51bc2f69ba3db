"""Speakers: dictionaries, carry-forward, and labels inside the text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.functions import text as T

from .ordered import running, time_chunk

CONFIDENCE_FLOOR = 0.5
#: The special speakers of a work that names none of its own.
SPECIAL_SPEAKERS = {"旁白": "[旁白]", "系统": "[系统]", "???": "[未知]", "？？？": "[未知]"}


def alias_table(configs: DataFrame) -> DataFrame:
    """(work_id, alias, canonical): the listed aliases; of canonical names that share an alias the last one listed has it."""
    entries = configs.select("work_id", F.posexplode("speaker_aliases").alias("place", "canonical", "aliases"))
    typed = entries.select("work_id", "place", "canonical", F.explode("aliases").alias("alias")).filter("alias is not null")
    return typed.groupBy("work_id", "alias").agg(F.max_by("canonical", F.struct("place", "canonical")).alias("canonical"))


def special_table(configs: DataFrame) -> DataFrame:
    """(work_id, alias, special): the special names, which win over aliases."""
    special = configs.select("work_id", F.explode("special_speakers").alias("alias", "special")).filter("special is not null")
    return special.groupBy("work_id", "alias").agg(F.max("special").alias("special"))


def normalize_speakers(events: DataFrame, configs: DataFrame) -> DataFrame:
    """events (with work_id) with speaker_norm: the special name, else the canonical one, else what was there."""
    special = special_table(configs).withColumnRenamed("alias", "speaker")
    aliases = alias_table(configs).withColumnRenamed("alias", "speaker")
    joined = events.join(special, ["work_id", "speaker"], "left").join(aliases, ["work_id", "speaker"], "left")
    return joined.withColumn("speaker_norm", F.coalesce("special", "canonical", "speaker")).drop("special", "canonical")


def known_speakers(configs: DataFrame) -> DataFrame:
    """(work_id, speaker): special names as they are typed, canonical names and all their aliases, each once."""
    canonical = configs.select("work_id", F.explode(F.map_keys("speaker_aliases")).alias("speaker"))
    aliases = configs.select("work_id", F.explode(F.map_values("speaker_aliases")).alias("typed")).select("work_id", F.explode("typed").alias("speaker"))
    special = configs.select("work_id", F.explode(F.map_keys("special_speakers")).alias("speaker"))
    return canonical.union(aliases).union(special).filter("speaker is not null").distinct()


def inherit_speakers(rows: DataFrame, floor: float = CONFIDENCE_FLOOR, chunk_ms: int = 1_800_000) -> DataFrame:
    """rows (video_id, event_id, start_ms, speaker, speaker_confidence) with inherited_speaker and inherited_confidence.

    A blank speaker or one below the floor takes the last good one of its video, with that one's
    confidence; null and 0 where there is none.
    """
    good = (F.trim("speaker") != "") & (F.col("speaker_confidence") >= floor)
    value = F.when(good, F.struct("speaker", "speaker_confidence"))
    chunked = rows.withColumn("_chunk", time_chunk(F.col("start_ms"), chunk_ms))
    carried = running(chunked, ["video_id"], "_chunk", ["start_ms", "event_id"], value, "last", "_good").drop("_chunk")
    return carried.withColumns({"inherited_speaker": F.col("_good.speaker"), "inherited_confidence": F.coalesce("_good.speaker_confidence", F.lit(0.0))}).drop("_good")


def parse_labels(rows: DataFrame, configs: DataFrame) -> DataFrame:
    """rows (work_id, speaker, text, confidence) where a text without a speaker may begin with a known name and a blank.

    The stripped text is cut at its first blank. If the part before it is a known name (special, canonical
    or alias) and something follows, that name, normalised, becomes the speaker, the rest the text, and the event's
    confidence that of the speaker. Other rows stay as they are, with a null speaker_confidence.
    """
    whole = T.strip(F.col("text"))
    label, rest = T.strip(F.substring_index(whole, " ", 1)), T.strip(F.expr("substring(_whole, instr(_whole, ' ') + 1)"))
    could = F.col("speaker").isNull() & (F.instr("_whole", " ") > 0) & (rest != "")
    marked = rows.withColumn("_whole", whole).withColumn("_label", F.when(could, label))
    names = known_speakers(configs).select("work_id", F.col("speaker").alias("_label"), F.lit(True).alias("_known"))
    special = special_table(configs).withColumnsRenamed({"alias": "_label", "special": "_special"})
    aliases = alias_table(configs).withColumnsRenamed({"alias": "_label", "canonical": "_canonical"})
    named = names.join(special, ["work_id", "_label"], "left").join(aliases, ["work_id", "_label"], "left")
    meant = named.select("work_id", "_label", "_known", F.coalesce("_special", "_canonical", "_label").alias("_meant"))
    joined = marked.join(meant, ["work_id", "_label"], "left")
    hit = F.coalesce("_known", F.lit(False))
    return joined.withColumns({
        "speaker": F.when(hit, F.col("_meant")).otherwise(F.col("speaker")), "text": F.when(hit, rest).otherwise(F.col("text")),
        "speaker_confidence": F.when(hit, F.col("confidence"))}).drop("_whole", "_label", "_known", "_meant")


def attribute_events(events: DataFrame, configs: DataFrame) -> DataFrame:
    """events (work_id, speaker, speaker_confidence, text, confidence) with final speakers.

    A speaker that was read is normalised and keeps its confidence; an event without one may carry it at
    the beginning of its text. Else the speaker is null and its confidence 0.
    """
    named = normalize_speakers(events, configs).withColumn("speaker", F.col("speaker_norm")).drop("speaker_norm")
    read = named.withColumnRenamed("speaker_confidence", "_read")
    return parse_labels(read, configs).withColumn("speaker_confidence", F.coalesce("speaker_confidence", "_read", F.lit(0.0))).drop("_read")
