"""Per-frame observations folded into events.

One pure state machine serves batch, streaming and tests. In batch the frames of a video are first cut
where three or more empty frames in a row leave the machine in its initial state whatever came before;
the pieces are independent, so that a long video spreads over all tasks, and the result is the same as
that of one pass.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions import text as T
from dialoom.functions.similarity import ratio_of
from dialoom.session import cut_lineage

from .ordered import neighbour, running, running_all, time_chunk

EVENT_SCHEMA = "video_id string, start_ts double, end_ts double, text string, confidence double, cause string, n_frames int"
_NAME_SCHEMA = ("first_speaker string, first_confidence double, any_speaker string, any_confidence double, "
                "candidates array<struct<engine: string, text: string, confidence: double>>")
#: A name that is read with less confidence is not taken.
NAME_FLOOR = 0.5

#: A name read in the name box, and its confidence.
Name = tuple[str, float]


class Event(NamedTuple):
    """A finished event. first_name was read on its first frame, name is the first that was read on any of its frames,
    speaker the one it goes by where the frames are folded one after the other; candidates are those its text is chosen from."""

    start: float
    end: float
    text: str
    confidence: float
    cause: str
    n_frames: int
    first_name: Name | None = None
    name: Name | None = None
    speaker: Name | None = None
    candidates: list | None = None


@dataclass(frozen=True)
class Rules:
    """stable: unchanged frames that end an event; grown: the same after growth; empty: empty frames that end one;
    least: shortest text; similarity: of a text and what follows it in one event; back: frames looked back for growth."""

    stable: int = 3
    grown: int = 5
    empty: int = 2
    least: int = 2
    similarity: float = 0.6
    back: int = 3


@dataclass
class Open:
    """The event that is going on: its observations, and how long it has been stable or empty."""

    start: float
    texts: list[str] = field(default_factory=list)
    confidences: list[float] = field(default_factory=list)
    unchanged: int = 0
    empty: int = 0
    grew: bool = False
    first_name: Name | None = None
    name: Name | None = None
    speaker: Name | None = None


@dataclass
class Fold:
    """The state of one video: the event going on, the text that was just finished and may linger, the last name that was
    read, and the candidates of the frame before unless that one finished an event."""

    rules: Rules = Rules()
    event: Open | None = None
    lingering: str = ""
    last_name: Name | None = None
    before: list | None = None

    def feed(self, ts: float, text: str | None, confidence: float, name: Name | None = None, candidates: list | None = None) -> list[Event]:
        """The events that this frame finishes. name: what stands in the name box, None if it cannot be read for sure."""
        going_on = self.event
        done = self._step(ts, text, confidence)
        if done:
            done = [e._replace(candidates=self.before or candidates) for e in done]
        self.before = None if done else candidates
        event = self.event
        if event is not None:
            # the box is read until the event has a speaker; an earlier one's name serves where it cannot be read
            if event.speaker is None:
                self.last_name = name or self.last_name
                event.speaker = self.last_name
            if event is not going_on:
                event.first_name = name
            event.name = event.name or name
        return done

    def _step(self, ts: float, text: str | None, confidence: float) -> list[Event]:
        text, r = (text or "").strip(), self.rules
        if self.event is None:
            if len(text) < r.least:
                self.lingering = ""
            elif not (self.lingering and ratio_of(text, self.lingering) > r.similarity):
                self._begin(ts, text, confidence)
                self.lingering = ""
            return []
        event = self.event
        if len(text) < r.least:
            event.empty += 1
            return [self._finish(ts, "empty")] if event.empty >= r.empty else []
        event.empty = 0
        if ratio_of(event.texts[-1], text) < r.similarity:
            done = self._finish(ts, "replaced")
            self._begin(ts, text, confidence)
            return [done]
        event.texts.append(text)
        event.confidences.append(confidence)
        if self._growing(event.texts):
            event.unchanged, event.grew = 0, True
            return []
        event.unchanged += 1
        return [self._finish(ts, "stable")] if event.unchanged >= (r.grown if event.grew else r.stable) else []

    def flush(self, ts: float) -> list[Event]:
        return [self._finish(ts, "flush")._replace(candidates=self.before)] if self.event else []

    def _begin(self, ts: float, text: str, confidence: float) -> None:
        self.event = Open(ts, [text], [confidence])

    def _growing(self, texts: list[str]) -> bool:
        new = texts[-1]
        before = texts[-1 - self.rules.back : -1]
        return any(len(new) > len(old) and ratio_of(old, new[: len(old)]) >= self.rules.similarity for old in before)

    def _finish(self, ts: float, cause: str) -> Event:
        event, self.event = self.event, None
        text, confidence = best_text(event.texts, event.confidences)
        self.lingering = text
        return Event(event.start, ts, text, confidence, cause, len(event.texts), event.first_name, event.name, event.speaker)


def best_text(texts: list[str], confidences: list[float]) -> tuple[str, float]:
    """The longest text; of several the most frequent, then the surest in sum, then the first; and its mean confidence."""
    longest = max(map(len, texts))
    counts = Counter(t for t in texts if len(t) == longest)
    sums = {t: sum(c for x, c in zip(texts, confidences) if x == t) for t in counts}
    best = max(counts, key=lambda t: (counts[t], sums[t]))  # a dictionary keeps the order of first sight
    return best, sums[best] / counts[best]


def fold_frames(frames: list[tuple], end: float | None = None, rules: Rules = Rules()) -> list[Event]:
    """All events of one video's frames (the arguments of `feed`) in order; the one still open ends at `end`."""
    machine, out = Fold(rules), []
    for frame in frames:
        out += machine.feed(*frame)
    return out + (machine.flush(end if end is not None else frames[-1][0]) if frames else [])


def segment(frames: DataFrame, rules: Rules = Rules(), tail_s: float = 0.5, chunk_s: float = 3600.0) -> DataFrame:
    """(video_id, event_id, start_ms, end_ms, text, confidence, cause, n_frames) from frames (video_id, ts, text, confidence).

    Frames of one time come in the order of their text. An event still open at the end of a video ends
    `tail_s` after its last frame. Ids count from 1 in each video. Null texts are empty frames, null
    confidences count as 0; rows without video_id or ts are dropped; an empty table gives none.
    """
    return number_events(_fold(frames, rules, tail_s, chunk_s, ()), chunk_s)


def segment_with_speakers(frames: DataFrame, rules: Rules = Rules(), tail_s: float = 0.5, chunk_s: float = 3600.0, floor: float = NAME_FLOOR) -> DataFrame:
    """As `segment`, with speaker, speaker_confidence and candidates; frames also have name, name_confidence and candidates.

    The name box of an event is read from its first frame on until there is a name; from then on the event
    keeps it. Where the box is blank, null or read with less confidence than `floor`, the last name read in
    the video serves with its confidence, which settles the speaker at once. So before any name was read in
    a video the first one on an event's frames counts, afterwards what its first frame shows. Without any the
    speaker is null and its confidence 0. Candidates are those of the frame before the one that ended the
    event; its own if the frame before ended another event or had none. An event that begins on the last frame of a
    video, where another one ends, has null candidates.
    """
    sure = (T.strip(F.col("name")) != "") & (F.col("name_confidence") >= floor)
    named = frames.withColumns({"_name": F.when(sure, T.strip(F.col("name"))), "_name_confidence": F.when(sure, F.col("name_confidence"))})
    events = _fold(named, rules, tail_s, chunk_s, ("_name", "_name_confidence", "candidates"))
    order = ["start_ts", "end_ts", "text"]
    # counting ends where the first name of a video is read; from there on the first frames count
    counted = running_all(events.withColumn("_chunk", time_chunk(F.col("start_ts"), chunk_s)), ["video_id"], "_chunk", order, {
        "_n": (F.lit(1), "sum"), "_named": (F.when(F.col("any_speaker").isNotNull(), 1).otherwise(0), "sum")})
    any_, first = F.struct(F.col("any_speaker").alias("s"), F.col("any_confidence").alias("c")), F.struct(F.col("first_speaker").alias("s"), F.col("first_confidence").alias("c"))
    earliest = F.col("any_speaker").isNotNull() & (F.col("_named") == 1)
    read = F.when(earliest, any_).when((F.col("_named") > 0) & F.col("first_speaker").isNotNull(), first)
    carried = running(counted, ["video_id"], "_chunk", order, read, "last", "_speaker")
    return carried.select(*_numbered("_n"), F.col("_speaker.s").alias("speaker"), F.coalesce("_speaker.c", F.lit(0.0)).alias("speaker_confidence"), "candidates")


def _fold(frames: DataFrame, rules: Rules, tail_s: float, chunk_s: float, extra: tuple[str, ...]) -> DataFrame:
    """Events without numbers, checkpointed. extra: no columns, or those of the name, its confidence and the candidates."""
    clean = frames.filter("video_id is not null and ts is not null").select(
        "video_id", "ts", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), *extra)
    order = ["ts", "text"]
    inside = Window.partitionBy("video_id", "_chunk").orderBy(*order)
    rows = clean.withColumns({"_chunk": time_chunk(F.col("ts"), chunk_s), "_empty": F.char_length(T.strip(F.col("text"))) < rules.least})
    # after `empty` + 1 empty frames nothing of what came before is left; such a place inside a chunk is where a new piece begins
    reset = F.col("_empty")
    for k in range(1, rules.empty + 1):
        reset = reset & F.coalesce(F.lag("_empty", k).over(inside), F.lit(False))
    reset = reset & ~F.coalesce(F.lag("_empty", rules.empty + 1).over(inside), F.lit(False))
    marked = rows.withColumn("_reset", F.when(reset, F.col("ts")))
    pieces = running(marked, ["video_id"], "_chunk", order, F.col("_reset"), "last", "_piece").select(
        "video_id", F.coalesce("_piece", F.lit(float("-inf"))).alias("_piece"), *order, "confidence", *extra)
    ordered = pieces.repartition("video_id", "_piece").sortWithinPartitions("video_id", "_piece", *order)
    schema = f"{EVENT_SCHEMA}, {_NAME_SCHEMA}" if extra else EVENT_SCHEMA
    columns = [c.strip().split(" ")[0] for c in EVENT_SCHEMA.split(", ")]
    columns += ["first_speaker", "first_confidence", "any_speaker", "any_confidence", "candidates"] if extra else []

    def rows_of(video: str, events: list[Event]) -> list[tuple]:
        if not extra:
            return [(video, *e[:6]) for e in events]
        none = (None, None)
        return [(video, *e[:6], *(e.first_name or none), *(e.name or none), e.candidates) for e in events]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, machine, last = None, Fold(rules), 0.0
        for batch in batches:
            out: list[tuple] = []
            for video, piece, ts, text, confidence, *more in batch.itertuples(index=False):
                if (video, piece) != here:
                    if here is not None:
                        out += rows_of(here[0], machine.flush(last + tail_s))
                    here, machine = (video, piece), Fold(rules)
                last = ts
                if more:
                    name, sure, shown = more
                    shown = None if shown is None else list(shown)
                    found = machine.feed(ts, text, confidence, (name, sure) if isinstance(name, str) else None, shown)
                else:
                    found = machine.feed(ts, text, confidence)
                if found:
                    out += rows_of(video, found)
            yield pd.DataFrame(out, columns=columns)
        if here is not None:  # only the last piece of a video can leave an event open
            yield pd.DataFrame(rows_of(here[0], machine.flush(last + tail_s)), columns=columns)

    return cut_lineage(ordered.mapInPandas(run, schema))


def _numbered(number: str) -> list[Column]:
    return [F.col("video_id"), F.format_string("event_%06d", F.col(number).cast("bigint")).alias("event_id"), T.seconds_to_ms(F.col("start_ts")).alias("start_ms"),
            T.seconds_to_ms(F.col("end_ts")).alias("end_ms"), F.col("text"), F.round("confidence", 6).alias("confidence"), F.col("cause"), F.col("n_frames")]


def number_events(events: DataFrame, chunk_s: float = 3600.0) -> DataFrame:
    """Events with ids event_000001, ... in each video, and times in ms."""
    chunked = events.withColumn("_chunk", time_chunk(F.col("start_ts"), chunk_s))
    counted = running(chunked, ["video_id"], "_chunk", ["start_ts", "end_ts", "text"], F.lit(1), "sum", "_n")
    return counted.select(*_numbered("_n"))


def merge_candidates(observations: DataFrame, key: list[str], text: str = "text", confidence: str = "confidence", position: str = "ts") -> DataFrame:
    """The text choice of `best_text` as aggregates: (key, text, confidence, n_seen)."""
    per_text = observations.groupBy(*key, text).agg(F.count("*").alias("n_seen"), F.sum(confidence).alias("total"), F.min(position).alias("first"))
    rank = F.struct(F.char_length(text).alias("a"), F.col("n_seen").alias("b"), F.round("total", 9).alias("c"), (-F.col("first")).alias("d"))
    return per_text.groupBy(*key).agg(F.max_by(F.struct(text, "n_seen", "total"), rank).alias("w")).select(
        *key, F.col("w")[text].alias("text"), F.round(F.col("w.total") / F.col("w.n_seen"), 6).alias("confidence"), F.col("w.n_seen").alias("n_seen"))


def longest_so_far(frames: DataFrame, chunk_s: float = 3600.0) -> DataFrame:
    """(video_id, ts, text, longest): the longest text seen up to each frame; of equally long ones the earliest."""
    rows = frames.select("video_id", "ts", "text").withColumn("_chunk", time_chunk(F.col("ts"), chunk_s))
    value = F.struct(F.char_length("text").alias("n"), (-F.col("ts")).alias("t"), F.col("text").alias("x"))
    best = running(rows, ["video_id"], "_chunk", ["ts", "text"], value, "max", "_best")
    return best.select("video_id", "ts", "text", F.col("_best.x").alias("longest"))


def previous_candidates(frames: DataFrame, columns: list[str], chunk_s: float = 3600.0) -> DataFrame:
    """Each frame with the columns of the frame before it, else its own: what a finished event is attributed to."""
    rows = frames.withColumn("_chunk", time_chunk(F.col("ts"), chunk_s))
    near = neighbour(rows, ["video_id"], "_chunk", ["ts", "text"], columns, "before_")
    return near.select("video_id", "ts", *[F.when(F.col("before_found"), F.col(f"before_{c}")).otherwise(F.col(c)).alias(c) for c in columns])
