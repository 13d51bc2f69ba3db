"""Segmentation of frames that arrive as a stream.

The state of a video is the same pure machine that serves the batch operator, kept in a value state;
an exactly-once checkpoint of the query replaces checkpoint files, and also keeps the event going on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from dialoom.operators.segment import NAME_FLOOR, Fold, Open, Rules

#: Fits the batch operator's event rows; number counts from 1 in each video.
OUTPUT = ("video_id string, number bigint, start_ts double, end_ts double, text string, confidence double, cause string, n_frames int, "
          "speaker string, speaker_confidence double")
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def pack(machine: Fold, number: int, last_ts: float | None, late: int) -> str:
    state = {"event": asdict(machine.event) if machine.event else None, "lingering": machine.lingering, "name": machine.last_name, "before": machine.before}
    return json.dumps({**state, "number": number, "last": last_ts, "late": late}, ensure_ascii=False)


def unpack(text: str | None, rules: Rules) -> tuple[Fold, int, float | None, int]:
    if text is None:
        return Fold(rules), 0, None, 0
    values = json.loads(text)
    event = Open(**{k: tuple(v) if k in ("first_name", "name", "speaker") and v else v for k, v in values["event"].items()}) if values["event"] else None
    name = tuple(values["name"]) if values["name"] else None
    return Fold(rules, event, values["lingering"], name, values["before"]), values["number"], values["last"], values["late"]


class Segmenter(StatefulProcessor):
    """Frames come in the order of ts inside a micro-batch; a frame older than what was folded before is late and only counted.

    A row with is_last ends its video: the event going on is flushed. Without one, a video that is silent
    for `idle_ms` of processing time is flushed too.
    """

    def __init__(self, rules: Rules = Rules(), tail_s: float = 0.5, idle_ms: int | None = None, floor: float = NAME_FLOOR):
        self.rules, self.tail_s, self.idle_ms, self.floor = rules, tail_s, idle_ms, floor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("machine", "packed string")

    def _load(self) -> tuple[Fold, int, float | None, int]:
        return unpack(self.state.get()[0] if self.state.exists() else None, self.rules)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        machine, number, last, late = self._load()
        frames = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "text"], kind="stable", na_position="last")
        done: list[tuple] = []
        ended = False
        for ts, text, confidence, is_last, name, sure in zip(*[frames[c] for c in ("ts", "text", "confidence", "is_last", "name", "name_confidence")]):
            if last is not None and ts < last:
                late += 1
                continue
            last = float(ts)
            read = (name.strip(), float(sure)) if isinstance(name, str) and name.strip() and sure >= self.floor else None
            done += machine.feed(last, text if isinstance(text, str) else "", float(confidence) if confidence == confidence else 0.0, read)
            if is_last:
                done += machine.flush(last + self.tail_s)
                ended = True
        out = self._rows(key[0], number, done)
        if ended:
            self.state.clear()
        else:
            self.state.update((pack(machine, number + len(done), last, late),))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not ended:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        machine, number, last, _ = self._load()
        done = machine.flush((last or 0.0) + self.tail_s)
        self.state.clear()
        yield self._rows(key[0], number, done)

    def close(self) -> None:
        pass

    @staticmethod
    def _rows(video: str, number: int, done: list[tuple]) -> pd.DataFrame:
        rows = [(video, number + k, *e[:6], *(e.speaker or (None, 0.0))) for k, e in enumerate(done, 1)]
        columns = ["video_id", "number", "start_ts", "end_ts", "text", "confidence", "cause", "n_frames", "speaker", "speaker_confidence"]
        return pd.DataFrame(rows, columns=columns).astype(
            {"number": "int64", "start_ts": "float64", "end_ts": "float64", "confidence": "float64", "n_frames": "int32", "speaker_confidence": "float64"})


def segment_stream(frames: DataFrame, rules: Rules = Rules(), tail_s: float = 0.5, idle_ms: int | None = None) -> DataFrame:
    """Events of a stream of frames (video_id, ts, text, confidence, is_last), in append mode.

    Frames may also have name and name_confidence, what stands in the name box; the events then have the
    speaker that `segment_with_speakers` gives them. Without these columns the speaker is null.

    The session needs the RocksDB state store (STATE_STORE under spark.sql.streaming.stateStore.providerClass).
    """
    kinds = {"name": "string", "name_confidence": "double"}
    named = [F.col(c) if c in frames.columns else F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]
    rows = frames.select("video_id", "ts", "text", "confidence", "is_last", *named)
    return rows.groupBy("video_id").transformWithStateInPandas(
        statefulProcessor=Segmenter(rules, tail_s, idle_ms), outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime" if idle_ms is not None else "None")


def windowed_counts(events: DataFrame, time: str = "ingested_at", width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """(window_start, source, n_events, n_review): arrivals per window of a stream or table; what is later than `late` is dropped from a stream."""
    timed = events.withColumn("_time", F.col(time).cast("timestamp"))
    counted = timed.withWatermark("_time", late).groupBy(F.window("_time", width).alias("w"), F.substring_index("source_file", "/", 1).alias("source")).agg(
        F.count("*").alias("n_events"), F.count_if("review_required").alias("n_review"))
    return counted.select(F.col("w.start").alias("window_start"), "source", "n_events", "n_review")
