"""Event records, corrections and settings in files."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field, fields

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = (
    "video_id string, event_id string, start_ms bigint, end_ms bigint, speaker string, text string, confidence double, review_required boolean, "
    "source_file string, frame_file string, roi_crop_file string, name_crop_file string, "
    "ocr_candidates array<struct<engine: string, text: string, confidence: double>>, selection_reason string")
#: Fields without which a record is none.
REQUIRED = ("video_id", "event_id", "start_ms", "end_ms", "speaker", "text", "confidence", "review_required")
_CORRUPT = "_corrupt"


def read_events(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Events from JSON lines. Blank lines, broken ones and records with unknown or missing fields are skipped; with `strict` a broken line raises."""
    if strict:
        return spark.read.schema(EVENT_SCHEMA).option("mode", "FAILFAST").json(path)
    names = [c.strip().split(" ")[0] for c in EVENT_SCHEMA.split(", ") if not c.strip().startswith(("text: ", "confidence: "))]
    lines = spark.read.text(path).filter(F.trim("value") != "")
    keys = F.json_object_keys("value")
    whole = keys.isNotNull() & (F.size(F.array_except(keys, F.array(*map(F.lit, names)))) == 0) & (F.size(F.array_except(F.array(*map(F.lit, REQUIRED)), keys)) == 0)
    parsed = lines.filter(whole).select(F.from_json("value", f"{EVENT_SCHEMA}, {_CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("r"))
    return parsed.filter(F.col(f"r.{_CORRUPT}").isNull()).select("r.*").drop(_CORRUPT)


def read_tail(spark: SparkSession, path: str) -> DataFrame:
    """(last_event_id, event_count) of a file of JSON lines: the id of the last line and the number of lines that are not blank;
    an empty id and 0 if any of them cannot be read."""
    lines = spark.read.text(path).filter(F.trim("value") != "").select("value", F.monotonically_increasing_id().alias("place"))
    event = F.get_json_object("value", "$.event_id")
    broken = F.json_object_keys("value").isNull()
    found = lines.agg(F.max_by(event, "place").alias("last"), F.count("*").alias("n"), F.max(broken).alias("broken"))
    usable = ~F.coalesce("broken", F.lit(False))
    return found.select(F.when(usable, F.coalesce("last", F.lit(""))).otherwise("").alias("last_event_id"), F.when(usable, F.col("n")).otherwise(0).alias("event_count"))


def read_work_configs(spark: SparkSession, path: str) -> DataFrame:
    """(file, work_id, name, target_fps, review_threshold, ocr_engine, error): the settings in the JSON files under a path, one work
    in each; a file that holds none gives a row with its error."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for file, text in zip(batch["file"], batch["value"]):
                try:
                    c = work_config(json.loads(text))
                    out.append((file, c.work_id, c.name, c.target_fps, c.review_threshold, c.ocr_engine, None))
                except (ValueError, TypeError) as error:
                    out.append((file, None, None, None, None, None, str(error)))
            yield pd.DataFrame(out, columns=["file", "work_id", "name", "target_fps", "review_threshold", "ocr_engine", "error"])

    return files.mapInPandas(run, "file string, work_id string, name string, target_fps double, review_threshold double, ocr_engine string, error string")


def skipped_lines(spark: SparkSession, path: str) -> DataFrame:
    """(n_lines, n_blank, n_read, n_skipped) of a file of JSON lines."""
    lines = spark.read.text(path)
    read = read_events(spark, path).agg(F.count("*").alias("n_read"))
    return lines.agg(F.count("*").alias("n_lines"), F.count_if(F.trim("value") == "").alias("n_blank")).join(read).withColumn(
        "n_skipped", F.col("n_lines") - F.col("n_blank") - F.col("n_read"))


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """Corrections from files that each hold one JSON array, with their place in it; the last of an event counts."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    one = "video_id string, event_id string, speaker string, text string, accepted boolean"
    return text.select("file", F.posexplode(F.from_json("value", f"array<struct<{one.replace(' ', ': ').replace(',:', ',')}>>")).alias("position", "c")).select("file", "position", "c.*")


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(file, start_ms, speaker, text) from rendered transcripts; lines of another form are skipped."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), "value")
    part = lambda k: F.regexp_extract("value", r"^\[(\d+):(\d\d):(\d\d)\] (?:(.*?): )?(.*)$", k)
    ms = (part(1).try_cast("bigint") * 3600 + part(2).try_cast("bigint") * 60 + part(3).try_cast("bigint")) * 1000
    return lines.select("file", ms.alias("start_ms"), F.nullif(part(4), F.lit("")).alias("speaker"), part(5).alias("text")).filter("start_ms is not null")


@dataclass(frozen=True)
class WorkConfig:
    """The settings of a work; what the three required fields lack raises ValueError."""

    work_id: str
    dialog_box: dict
    name_box: dict
    name: str = ""
    dialog_preprocess: str = "default"
    name_preprocess: str = "default"
    ocr_engine: str = "paddleocr"
    fallback_engine: str | None = None
    fallback_threshold: float = 0.7
    speaker_aliases: dict = field(default_factory=dict)
    special_speakers: dict = field(default_factory=dict)
    target_fps: float = 2.0
    review_threshold: float = 0.7


def region_problem(box: object) -> str | None:
    """The first thing that is wrong with a normalised region, else None."""
    if not isinstance(box, dict):
        return "missing"
    values = [box.get(k) for k in ("x", "y", "w", "h")]
    if any(isinstance(v, bool) or not isinstance(v, (int, float)) for v in values):
        return "missing"
    x, y, w, h = values
    if not all(0 <= v <= 1 for v in values):
        return "range"
    if w <= 0 or h <= 0:
        return "area"
    return "overflow" if x + w > 1 or y + h > 1 else None


def work_config(values: object) -> WorkConfig:
    """A WorkConfig from a mapping; unknown keys are dropped."""
    if not isinstance(values, dict):
        raise ValueError("the settings are no mapping")
    for key in ("work_id", "dialog_box", "name_box"):
        if key not in values:
            raise ValueError(f"{key} is missing")
    for key in ("dialog_box", "name_box"):
        if problem := region_problem(values[key]):
            raise ValueError(f"{key}: {problem}")
    known = {f.name for f in fields(WorkConfig)}
    return WorkConfig(**{k: v for k, v in values.items() if k in known})


def load_work_config(path: str) -> WorkConfig:
    """The settings in a YAML or JSON file."""
    return work_config(_load(path))


def _load(path: str) -> object:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    if not path.endswith((".yaml", ".yml")):
        raise ValueError(f"neither JSON nor YAML: {path}")
    try:
        import yaml
    except ImportError as error:
        raise ValueError("YAML files need a YAML library") from error
    return yaml.safe_load(text)


#: Least width and height of the pixel regions of a frame.
LEAST_SIZE = {"dialogue_box": (100, 20), "name_box": (50, 20)}


def region_problems(values: object) -> list[str]:
    """Everything that is wrong with pixel regions {work_id, resolution {width, height}, dialogue_box {roi}, name_box {roi}}."""
    if not isinstance(values, dict):
        return ["no mapping"]
    size = values.get("resolution") or {}
    width, height = size.get("width"), size.get("height")
    out = [] if values.get("work_id") else ["work_id"]
    if not all(isinstance(v, int) and v > 0 for v in (width, height)):
        return [*out, "resolution"]
    for name in LEAST_SIZE:
        box = (values.get(name) or {}).get("roi")
        parts = [box.get(k) for k in ("x", "y", "width", "height")] if isinstance(box, dict) else []
        if len(parts) != 4 or not all(isinstance(v, int) for v in parts):
            out.append(f"{name}: roi")
            continue
        x, y, w, h = parts
        out += [f"{name}: {what}" for what, bad in (("x", x < 0), ("y", y < 0), ("width", w <= 0), ("height", h <= 0), ("right", x + w > width), ("bottom", y + h > height)) if bad]
    return out


def load_regions(path: str) -> dict:
    """Pixel regions from a JSON or YAML file; ValueError with all that is wrong with them."""
    values = _load(path)
    if problems := region_problems(values):
        raise ValueError("; ".join(problems))
    return values


def save_regions(values: dict, path: str) -> None:
    """Pixel regions as JSON, or as YAML if the name says so."""
    if path.endswith(".json"):
        text = json.dumps(values, ensure_ascii=False, indent=2)
    else:
        import yaml

        text = yaml.safe_dump(values, allow_unicode=True, sort_keys=False)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def rescale_regions(values: dict, width: int, height: int) -> dict:
    """The regions for another resolution; every value is truncated."""
    sx, sy = width / values["resolution"]["width"], height / values["resolution"]["height"]
    scaled = {n: {**values[n], "roi": {k: int(v * (sx if k in ("x", "width") else sy)) for k, v in values[n]["roi"].items()}} for n in LEAST_SIZE}
    return {**values, "resolution": {"width": width, "height": height}, **scaled}
