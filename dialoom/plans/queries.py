"""The core queries: name -> (session, folder of the tables) -> result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import text as T
from dialoom.operators import evaluate, fusion, inlining, merge, persona, regions, sampling, segment, speaker
from dialoom.operators import events as E
from dialoom.session import shared_folder
from dialoom.sources import books, records, sinks
from dialoom.streaming.segments import windowed_counts

from . import adapters as A
from .oracle import ORACLE_SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def transcript_clean(spark, folder):
    return E.transcript(A.events(spark, folder))


@query
def transcript_review(spark, folder):
    return E.transcript(A.events(spark, folder), include_flagged=True)


@query
def transcript_srt(spark, folder):
    return E.srt(A.events(spark, folder))


@query
def transcript_markdown(spark, folder):
    return E.markdown(A.events(spark, folder))


@query
def review_cards(spark, folder):
    return E.review_cards(A.events(spark, folder))


@query
def artifact_columns(spark, folder):
    return E.artifact_columns(A.events(spark, folder))


@query
def review_flag(spark, folder):
    limits = A.table(spark, folder, "work_configs").select("work_id", "review_threshold")
    rows = A.events_with_work(spark, folder).join(limits, "work_id")
    sure = T.effective_confidence(F.col("confidence"), F.col("speaker"), F.lit(0.9))
    return rows.select("video_id", "event_id", sure.alias("confidence"), T.needs_review(F.col("text"), F.col("speaker"), sure, F.col("review_threshold")).alias("flag"))


@query
def text_quality(spark, folder):
    return A.events(spark, folder).select("video_id", "event_id", T.content_count(F.col("text")).alias("content"), T.passes_quality(F.col("text")).alias("passes"))


@query
def hud_filter(spark, folder):
    return A.events(spark, folder).filter(T.is_hud(F.col("text"))).select("video_id", "event_id", "text")


@query
def punct_normalize(spark, folder):
    return A.events(spark, folder).select("video_id", "event_id", T.strip(T.ascii_punctuation(F.col("text"))).alias("norm"))


@query
def ocr_fusion(spark, folder):
    rows = A.table(spark, folder, "dialogue_events").select("video_id", "event_id", "ocr_candidates")
    return fusion.fuse_candidates(rows).drop("ocr_candidates")


@query
def ocr_fusion_tables(spark, folder):
    each = A.table(spark, folder, "dialogue_events").select("video_id", "event_id", F.posexplode("ocr_candidates").alias("position", "c"))
    pick = lambda k: each.filter(F.col("position") == k).groupBy("video_id", "event_id").agg(F.max("c").alias("c")).select("video_id", "event_id", "c.*")
    return fusion.fuse_tables(pick(0), pick(1), ["video_id", "event_id"])


@query
def engine_line_combine(spark, folder):
    lines = A.table(spark, folder, "dialogue_events").select("video_id", "event_id", F.posexplode("ocr_candidates").alias("position", "c"))
    return fusion.combine_lines(lines.select("video_id", "event_id", "position", "c.text", "c.confidence").distinct(), ["video_id", "event_id"])


@query
def speaker_normalize(spark, folder):
    rows = A.events_with_work(spark, folder).select("work_id", "video_id", "event_id", "speaker")
    return speaker.normalize_speakers(rows, A.table(spark, folder, "work_configs")).select("video_id", "event_id", "speaker", "speaker_norm")


@query
def speaker_inherit(spark, folder):
    rows = A.events(spark, folder).select("video_id", "event_id", "start_ms", "speaker", F.col("confidence").alias("speaker_confidence"))
    return speaker.inherit_speakers(rows, floor=0.8).select("video_id", "event_id", "inherited_speaker", "inherited_confidence")


@query
def speaker_from_text(spark, folder):
    """Every event of both paths with its own speaker and text."""
    columns = ["video_id", "event_id", "speaker", "text", "confidence"]
    both = A.events(spark, folder).select(*columns).unionByName(E.distinct_events(A.table(spark, folder, "spoken_events")).select(*columns))
    works = A.table(spark, folder, "video_runs").select("video_id", "work_id")
    return speaker.parse_labels(both.join(works, "video_id"), A.table(spark, folder, "work_configs")).drop("work_id")


@query
def known_speakers(spark, folder):
    return speaker.known_speakers(A.table(spark, folder, "work_configs"))


@query
def prefix_merge(spark, folder):
    return merge.merge_fragments(A.fragments(spark, folder), merge.exact_prefix).select("video_id", "event_id", "start_ms", "end_ms", "text", "merged_from")


@query
def prefix_merge_fuzzy(spark, folder):
    return merge.merge_fragments(A.fragments(spark, folder)).select("video_id", "event_id", "start_ms", "end_ms", "text", "merged_from")


@query
def candidate_merge(spark, folder):
    seen = A.frames(spark, folder).filter("text <> ''")
    return segment.merge_candidates(seen, ["video_id", "number"])


@query
def longest_so_far(spark, folder):
    return segment.longest_so_far(A.frames(spark, folder))


@query
def event_segment(spark, folder):
    return segment.segment(A.frames(spark, folder))


@query
def event_attribution(spark, folder):
    """From frames to events with normalised speakers and the candidates of the text."""
    found = segment.segment_with_speakers(A.frames(spark, folder, A.SHOWN_PLAINLY))
    return _attributed(spark, folder, found)


@query
def event_attribution_all(spark, folder):
    """The same over frames of every kind."""
    return _attributed(spark, folder, segment.segment_with_speakers(A.frames(spark, folder)))


def _attributed(spark, folder, found):
    configs = A.table(spark, folder, "work_configs")
    works = A.table(spark, folder, "video_runs").select("video_id", "work_id")
    named = speaker.attribute_events(found.join(works, "video_id"), configs)
    return named.select("video_id", "event_id", "start_ms", "end_ms", "speaker", "text", "confidence", "speaker_confidence", F.col("candidates")[0]["engine"].alias("shown_on"))


@query
def frame_sample_asof(spark, folder):
    frames = A.events(spark, folder).groupBy("video_id", (F.col("start_ms") / 1000).alias("ts")).agg(F.min("event_id").alias("event_id"))
    return sampling.sample_grid(frames, 5.0, ["event_id"], key="video_id")


@query
def frame_at(spark, folder):
    frames = A.events(spark, folder).groupBy("video_id", (F.col("start_ms") / 1000).alias("ts")).agg(F.min("event_id").alias("event_id"))
    times = A.table(spark, folder, "video_runs").select("video_id", F.explode(F.array(F.lit(30.0), F.lit(120.0), F.lit(600.0))).alias("at"))
    return sampling.frame_at(frames, times, key="video_id", columns=("event_id",))


@query
def change_detect(spark, folder):
    return sampling.detect_changes(A.signal(spark, folder), ties=("event_id",)).select("key", "event_id", "diff_ratio", "changed")


@query
def progress_ticks(spark, folder):
    return sampling.progress_ticks(A.events(spark, folder).withColumn("ts", F.col("start_ms") / 1000), "video_id", "ts")


@query
def speaker_runs(spark, folder):
    return sampling.run_lengths(A.events(spark, folder).withColumn("speaker", F.coalesce("speaker", F.lit(""))), "video_id", ["start_ms", "event_id"], "speaker")


@query
def arrival_windows(spark, folder):
    counts = windowed_counts(A.table(spark, folder, "dialogue_events"))
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query
def corrections_apply(spark, folder):
    last = F.struct("submitted_at", "reviewer", "text", "speaker", "accepted")
    return E.apply_corrections(A.events(spark, folder), A.table(spark, folder, "corrections"), last).select(
        "video_id", "event_id", "speaker", "text", "review_required", "corrected")


@query
def pending_outputs(spark, folder):
    return E.pending(A.table(spark, folder, "video_runs").filter("kind = 'ocr'").select("video_id", "status"), A.table(spark, folder, "dialogue_events"))


@query
def run_summary(spark, folder):
    return E.run_summary(A.events(spark, folder))


@query
def batch_summary(spark, folder):
    return E.batch_summary(A.table(spark, folder, "video_runs"))


@query
def batch_records(spark, folder):
    runs = A.table(spark, folder, "video_runs")
    ok = runs.filter("status = 'ok'").select("video_id", "status", "total_events", "review_count")
    return E.union_summaries(ok, runs.filter("status = 'error'").select("video_id", "status", "error"))


@query
def jsonl_tail(spark, folder):
    return E.last_event(A.events(spark, folder))


@query
def resume_cut(spark, folder):
    done = A.table(spark, folder, "video_runs").filter("duration_processed is not null").select("video_id", F.floor(F.col("duration_processed") * 500).alias("last_processed_ms"))
    return E.after_checkpoint(A.events(spark, folder), done).select("video_id", "event_id")


@query
def resume_points(spark, folder):
    """Where checkpointed videos go on; a checkpoint that names another last event than the written ones would be an error."""
    rows = A.events(spark, folder)
    done = A.table(spark, folder, "video_runs").filter("duration_processed is not null").select("video_id", F.floor(F.col("duration_processed") * 1000).alias("last_processed_ms"))
    checkpoints = done.join(E.last_event(rows).drop("event_count"), "video_id", "left")
    return E.resume_points(rows, checkpoints)


@query
def spine_order(spark, folder):
    docs = A.table(spark, folder, "documents").filter("work_id is not null")
    spine = docs.filter("source = 'novel_chapter'").select(F.col("work_id").alias("book"), F.col("doc_id").alias("item"), F.col("doc_id").alias("place"))
    manifest = docs.filter("lang is not null").select(F.col("work_id").alias("book"), F.col("doc_id").alias("item"), F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("href"))
    return books.spine_order(spine, manifest)


@query
def chapter_concat(spark, folder):
    chapters = A.table(spark, folder, "documents").filter("source = 'novel_chapter' and work_id is not null and text is not null")
    whole = books.join_chapters(chapters, "work_id", "doc_id")
    return whole.select("work_id", F.char_length("text").cast("bigint").alias("n_chars"), F.md5(F.encode("text", "utf-8")).alias("digest"))


@query
def html_to_text(spark, folder):
    return A.pages(spark, folder).select("doc_id", books.html_to_text(F.col("html")).alias("text"))


@query
def html_to_text_sql(spark, folder):
    return A.pages(spark, folder).select("doc_id", books.html_to_text_sql(F.col("html")).alias("text"))


@query
def roi_box(spark, folder):
    box = regions.crop_box(F.col("dialog_box"), F.lit(1920), F.lit(1080))
    return A.table(spark, folder, "work_configs").select("work_id", box.alias("b")).select("work_id", "b.*")


@query
def roi_validate(spark, folder):
    return A.table(spark, folder, "work_configs").select("work_id", regions.region_error(F.col("dialog_box")).alias("dialog_error"), regions.region_error(F.col("name_box")).alias("name_error"))


def _pixel_box(name):
    b = F.col(name)
    return F.struct(*[F.floor(b[k] * s - o).cast("int").alias(n) for k, s, o, n in (("x", 1280, 200, "x"), ("y", 720, 0, "y"), ("w", 1600, 0, "width"), ("h", 900, 0, "height"))])


@query
def roi_validate_pixel(spark, folder):
    errors = regions.pixel_errors(_pixel_box("dialog_box"), F.lit(1280), F.lit(720))
    return A.table(spark, folder, "work_configs").select("work_id", F.array_join(errors, ",").alias("errors"))


@query
def roi_rescale(spark, folder):
    box = regions.rescale(_pixel_box("name_box"), (F.lit(1280), F.lit(720)), (F.lit(1920), F.lit(1080)))
    return A.table(spark, folder, "work_configs").select("work_id", box.alias("b")).select("work_id", "b.*")


@query
def roi_frame_check(spark, folder):
    box = regions.crop_box(F.col("name_box"), F.lit(640), F.lit(360))
    return A.table(spark, folder, "work_configs").select("work_id", regions.fits_frame(box, F.lit(640), F.lit(360), 50, 20).alias("fits"))


@query
def profile_override(spark, folder):
    own = A.table(spark, folder, "work_configs").groupBy(F.concat(F.lit("own_"), "dialog_preprocess").alias("name")).agg(F.max("target_fps").alias("upscale_factor"))
    named = own.unionByName(spark.createDataFrame([("dark_bg", 4.0)], "name string, upscale_factor double"))
    return regions.override_profiles(named)


@query
def profile_steps(spark, folder):
    """The steps that the profiles of each work stand for."""
    used = A.table(spark, folder, "work_configs").select("work_id", F.explode(F.array("dialog_preprocess", "name_preprocess")).alias("name")).distinct()
    return used.join(regions.steps(regions.builtin_profiles(spark)), "name", "left")


@query
def tag_rules(spark, folder):
    tags = A.table(spark, folder, "work_configs").select("work_id", F.explode(F.array("dialog_preprocess", "ocr_engine")).alias("tag"))
    rules = spark.createDataFrame([("easyocr", "slow"), ("paddleocr", "fast"), ("outline_heavy", "sharpen first")], "tag string, rule string")
    return persona.apply_rules(tags, rules)


@query
def catchphrase_ngrams(spark, folder):
    return persona.phrases(A.events(spark, folder))


@query
def particle_counts(spark, folder):
    return persona.token_counts(A.events(spark, folder))


@query
def address_forms(spark, folder):
    names = A.table(spark, folder, "work_configs").select("work_id", F.explode(F.map_keys("speaker_aliases")).alias("name"))
    return persona.mentions(A.events_with_work(spark, folder), names)


@query
def info_routing(spark, folder):
    kinds = F.array(*[F.lit(k) for k in ("world", "style", "both", "plot", "unknown")])
    items = A.with_number(A.events(spark, folder)).select("video_id", "event_id", F.element_at(kinds, (F.col("number") % 5 + 1).cast("int")).alias("kind"))
    return persona.route(items)


@query
def correction_triggers(spark, folder):
    rows = A.table(spark, folder, "corrections").select("video_id", "event_id", "submitted_at", "text")
    return rows.select("video_id", "event_id", "submitted_at", T.objects(F.col("text"), (*T.OBJECTIONS, "never", "nunca", "从没", "ない")).alias("objects"))


@query
def fact_classify(spark, folder):
    old = A.events(spark, folder).select("video_id", "event_id", F.col("speaker").alias("value"))
    new = A.table(spark, folder, "corrections").groupBy("video_id", "event_id").agg(F.max("speaker").alias("value"))
    return persona.classify_facts(old, new, ["video_id", "event_id"])


@query
def name_slug(spark, folder):
    return A.table(spark, folder, "work_configs").select("work_id", T.slug(F.col("name")).alias("slug"))


@query
def seconds_to_ms(spark, folder):
    return A.table(spark, folder, "video_runs").select("video_id", T.seconds_to_ms(F.col("duration_processed")).alias("ms"), T.stamp(T.seconds_to_ms(F.col("duration_processed"))).alias("stamp"))


@query
def event_numbering(spark, folder):
    rows = A.events(spark, folder).select("video_id", (F.col("start_ms") / 1000).alias("start_ts"), (F.col("end_ms") / 1000).alias("end_ts"), "text", "confidence", F.lit("stable").alias("cause"), F.lit(1).alias("n_frames"))
    return segment.number_events(rows).select("video_id", "event_id", "text", "confidence")


@query
def eval_interval_match(spark, folder):
    return evaluate.match_intervals(A.events(spark, folder), A.gold(spark, folder)).select("video_id", "gold_id", "event_id", "overlap_ms")


@query
def eval_recall(spark, folder):
    return evaluate.recall(evaluate.match_intervals(A.events(spark, folder), A.gold(spark, folder)))


@query
def eval_cer(spark, folder):
    return evaluate.character_error_rate(evaluate.match_intervals(A.events(spark, folder), A.gold(spark, folder)), ["video_id"])


@query
def eval_duplicate_rate(spark, folder):
    return evaluate.duplicate_rate(A.events(spark, folder))


@query
def eval_review_rate(spark, folder):
    return evaluate.review_rate(A.events(spark, folder), ["video_id"])


@query
def eval_speaker_accuracy(spark, folder):
    return evaluate.speaker_accuracy(A.events(spark, folder), A.table(spark, folder, "corrections"))


@query
def p3_found(spark, folder):
    return inlining.child_links(A.table(spark, folder, "raw_records")).distinct()


@query
def p3_schema(spark, folder):
    return inlining.schema_graph(A.table(spark, folder, "raw_records"))


def _shredded(spark, folder):
    raw = A.table(spark, folder, "raw_records")
    return inlining.shred(raw, inlining.table_types(inlining.schema_graph(raw)) | set(inlining.CHILD_FIELDS))


@query
def p3_candidates(spark, folder):
    return inlining.flat_table(_shredded(spark, folder), "ocr_candidates", ["engine", "text", "confidence"])


@query
def p3_lines(spark, folder):
    return inlining.flat_table(_shredded(spark, folder), "lines", ["text", "box.x", "box.y", "box.w", "box.h", "conf"])


@query
def p3_records(spark, folder):
    return inlining.flat_table(_shredded(spark, folder), inlining.ROOT, ["video_id", "event_id", "start_ms", "end_ms", "speaker", "text", "confidence", "provenance.source_file", "key.video_id", "key.event_id"])


@query
def p3_glyphs(spark, folder):
    return inlining.flat_table(_shredded(spark, folder), "glyphs", ["ch", "conf"])


@query
def p3_attempts(spark, folder):
    return inlining.flat_table(_shredded(spark, folder), "attempts", ["profile", "ms"])


@query
def p3_crops(spark, folder):
    return inlining.flat_table(_shredded(spark, folder), "crops", ["kind", "file"])


@query
def p3_unreadable(spark, folder):
    """The records that give no rows, and why."""
    return inlining.readability(A.table(spark, folder, "raw_records"))


def _fresh(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def event_files(spark, folder):
    """Events written as JSON lines, replaced by those with a speaker, and read again."""
    path = _fresh(spark, "events")
    columns = ["video_id", "event_id", "start_ms", "end_ms", "speaker", "text", "confidence", "review_required", "source_file"]
    sinks.write_events(A.events(spark, folder).select(*columns), path)
    sinks.replace_events(records.read_events(spark, path).filter("speaker is not null or review_required").select(*columns), path)
    return records.read_events(spark, path, strict=True).select(*columns)


@query
def event_file_tail(spark, folder):
    """The last event and the number of events of one file."""
    path = _fresh(spark, "tail")
    one = A.table(spark, folder, "video_runs").agg(F.max(F.when(F.col("status") == "running", F.col("video_id"))).alias("video_id"))
    rows = A.events(spark, folder).join(F.broadcast(one), "video_id").sort("event_id").coalesce(1)  # one file has one writer
    sinks.write_events(rows, path)
    return records.read_tail(spark, path)


@query
def correction_files(spark, folder):
    """Corrections of each video in a file of its own; the last one of an event counts."""
    path = _fresh(spark, "corrections")
    place = F.struct("submitted_at", "reviewer", "text", "speaker", "accepted")
    one = F.struct(place.alias("place"), F.struct("video_id", "event_id", "speaker", "text", "accepted").alias("c"))
    lists = A.table(spark, folder, "corrections").groupBy(F.col("video_id").alias("v")).agg(F.array_sort(F.collect_list(one)).alias("all"))  # what people typed for a video
    lists.select("v", F.to_json(F.transform("all", lambda x: x["c"])).alias("value")).repartition("v").write.partitionBy("v").text(path)
    read = records.read_corrections(spark, f"{path}/v=*")
    return read.groupBy("video_id", "event_id").agg(F.max_by(F.struct("speaker", "text", "accepted"), "position").alias("c")).select("video_id", "event_id", "c.*")


@query
def config_files(spark, folder):
    path = _fresh(spark, "configs")
    rows = A.table(spark, folder, "work_configs")
    rows.select("work_id", F.to_json(F.struct(*[F.col(c) for c in rows.columns], F.lit(1).alias("unknown"))).alias("value")).repartition("work_id").write.partitionBy("work_id").text(path)
    return records.read_work_configs(spark, f"{path}/work_id=*").drop("file")


@query
def recognised_files(spark, folder):
    """Lines of recognised speech; a second run finds every video done and writes nothing."""
    path = _fresh(spark, "recognised")
    rows = E.distinct_events(A.table(spark, folder, "spoken_events")).filter("start_ms is not null and text is not null")
    for _ in range(2):
        sinks.write_recognised(rows, path)
    return spark.read.text(path).groupBy("video_id").agg(F.count("*").alias("n_lines"), F.min(F.left("value", F.lit(10))).alias("first_stamp"))


@query
def review_pages(spark, folder):
    return E.review_pages(A.events(spark, folder), 50).select("video_id", "page", F.md5(F.encode("html", "utf-8")).alias("digest"))


@query
def book_chapters(spark, folder):
    """The chapters of e-books in the order of their spines."""
    return books.chapters(A.books(spark, folder)).select("path", "place", "href", "error")
