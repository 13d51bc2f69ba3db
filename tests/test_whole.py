"""Queries over texts in several scripts, held against plain Python on small tables."""

import json

import pytest

import __spark_entry__ as entry

SCHEMAS = {
    "dialogue_events": "video_id string, event_id string, start_ms bigint, end_ms bigint, speaker string, text string, confidence double, review_required boolean, source_file string",
    "corrections": "video_id string, event_id string, text string, accepted boolean",
    "video_runs": "video_id string, work_id string, kind string, status string",
    "work_configs": "work_id string, speaker_aliases map<string,array<string>>, special_speakers map<string,string>",
    "raw_records": "raw_id bigint, payload string",
    "spoken_events": "video_id string, event_id string, start_ms bigint, end_ms bigint, speaker string, text string, confidence double, review_required boolean, source_file string",
}


@pytest.fixture
def run(spark, tmp_path):
    """The rows of a query over tables of the given rows."""

    def run(name, **tables):
        for table, schema in SCHEMAS.items():
            spark.createDataFrame(tables.get(table, []), schema).write.parquet(str(tmp_path / f"{table}.parquet"))
        return entry.queries()[name](spark, str(tmp_path)).collect()

    return run


def event(video, number, text, speaker=None):
    return (video, f"event_{number:06d}", number * 1000, number * 1000 + 900, speaker, text, 0.9, False, "x.mp4")


def distance(a, b):
    """Edit distance by code points, by plain recursion over a table."""
    table = {(i, j): max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i, j] = min(table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
    return table[len(a), len(b)]


def test_error_rate_in_every_script(run):
    pairs = {"zh": [("你好世界", "你好世间"), ("再见", "再见了")], "ja": [("フィカタさん", "フィカダさん")], "es": [("¿Qué pasó?", "¿Que pasó?"), ("ok", "ok")], "en": [("hello", "hallo")],
             "rare": [("𠮷野家😀", "吉野家😀")], "none": [(None, "你好")]}
    events = [event(v, k, seen) for v, rows in pairs.items() for k, (seen, _) in enumerate(rows)]
    gold = [(v, f"event_{k:06d}", meant, True) for v, rows in pairs.items() for k, (_, meant) in enumerate(rows)]
    got = {r.video_id: (r.n_matched, r.mean_cer) for r in run("eval_cer", dialogue_events=events, corrections=gold)}
    assert got == {v: (len(rows), round(sum(distance(a or "", b) / len(b) for a, b in rows) / len(rows), 6)) for v, rows in pairs.items()}


RUNS = [("v", "w", "ocr", "ok"), ("u", "w", "ocr", "ok")]
CAST = {"Anna": ["Annie"], "Bramuck Sidel": [], "Silent Anchor Society": [], "沅音漪": ["小漪"], "フィカタ・ロルタノ": []}


def test_speakers_from_every_stored_text(run):
    events = [event("v", 1, "Anna  come here "), event("v", 2, "Annie wait"), event("v", 3, "沅音漪 你好"), event("v", 4, "旁白 夜深了"), event("v", 5, " Guard halt"), event("v", 6, "Anna"), event("v", 7, None),
              event("v", 8, "Anna no label", "Bramuck Sidel"), event("u", 1, "小漪 走吧"), event("u", 2, "Anna said", "Anna")]
    spoken = [event("u", 9, "Annie from the other path")]
    got = {(r.video_id, r.event_id[-1]): (r.speaker, r.text, r.speaker_confidence) for r in run(
        "speaker_from_text", dialogue_events=events, spoken_events=spoken, video_runs=RUNS, work_configs=[("w", CAST, {"旁白": "[旁白]"})])}
    assert got == {("v", "1"): ("Anna", "come here", 0.9), ("v", "2"): ("Anna", "wait", 0.9), ("v", "3"): ("沅音漪", "你好", 0.9), ("v", "4"): ("[旁白]", "夜深了", 0.9), ("v", "5"): (None, " Guard halt", None),
                   ("v", "6"): (None, "Anna", None), ("v", "7"): (None, None, None), ("v", "8"): ("Bramuck Sidel", "Anna no label", None), ("u", "1"): ("沅音漪", "走吧", 0.9), ("u", "2"): ("Anna", "Anna said", None), ("u", "9"): ("Anna", "from the other path", 0.9)}


def test_names_of_any_length_and_script(run):
    events = [event("v", 1, "Anna, the Silent  Anchor Society and Bramuck Sidel. Anna!", "a"), event("v", 2, "Annabel and Sidel", "a"), event("v", 3, "我看见沅音漪了,沅音漪!", "b"), event("v", 4, "あのフィカタ・ロルタノさん", "b"),
              event("v", 5, "Anna"), event("u", 6, None, "a")]
    got = {(r.speaker, r.name): r.n for r in run("address_forms", dialogue_events=events, video_runs=RUNS, work_configs=[("w", CAST, None)])}
    assert got == {("a", "Anna"): 2, ("a", "Silent Anchor Society"): 1, ("a", "Bramuck Sidel"): 1, ("b", "沅音漪"): 2, ("b", "フィカタ・ロルタノ"): 1}


def test_phrases_in_unspaced_scripts(run):
    texts = ["没关系的。", "真的没关系", "没关系", "Well I never", "well, I never!", "WELL I never did"]
    got = {(r.phrase, r.n) for r in run("catchphrase_ngrams", dialogue_events=[event("v", k, t, "a") for k, t in enumerate(texts)])}
    assert got == {("没关系", 3), ("well i never", 3)}


def test_every_table_of_the_raw_records_comes_out(spark, run, tmp_path):
    record = {"key": {"videoId": "v", "eventId": "e"}, "startMs": 5, "endMs": 9, "speaker": "Anna", "text": "你好", "confidence": 0.5, "provenance": {"source_file": "x.mp4"}, "attempts": [{"profile": "p", "ms": 7}],
              "crops": [{"kind": "name", "file": "a.png"}], "ocr_candidates": [{"engine": "o", "text": "你", "lines": [{"text": "你", "glyphs": [{"ch": "你", "conf": 0.9}, {"ch": "好"}]}]}]}
    rows = [(1, json.dumps(record)), (2, "broken"), (3, None)]
    (r,) = run("p3_records", raw_records=rows)
    assert (r.raw_id, r.key_video_id, r.key_event_id, r.start_ms, r.end_ms, r.speaker, r.text, r.confidence, r.provenance_source_file) == (1, "v", "e", "5", "9", "Anna", "你好", "0.5", "x.mp4")
    got = {name: {tuple(x[c] for c in columns) for x in entry.queries()[name](spark, str(tmp_path)).collect()} for name, columns in {
        "p3_glyphs": ("path", "parent_path", "ch", "conf"), "p3_attempts": ("path", "profile", "ms"), "p3_crops": ("path", "kind", "file")}.items()}
    line = "$.ocr_candidates[0].lines[0]"
    assert got == {"p3_glyphs": {(f"{line}.glyphs[0]", line, "你", "0.9"), (f"{line}.glyphs[1]", line, "好", None)}, "p3_attempts": {("$.attempts[0]", "p", "7")}, "p3_crops": {("$.crops[0]", "name", "a.png")}}


CONFIGS = "work_id string, speaker_aliases map<string,array<string>>, special_speakers map<string,string>"


def test_the_last_one_listed_has_a_shared_alias(spark):
    from dialoom.operators import speaker as P

    configs = spark.createDataFrame([("w", {"Zed": ["Boss", None], "Amy": ["Boss", "Zed"], "Bob": None}, {"???": "[unknown]", "Gone": None}), ("n", None, None)], CONFIGS)
    assert {(r.alias, r.canonical) for r in P.alias_table(configs).collect()} == {("Boss", "Amy"), ("Zed", "Amy")}
    assert {r.speaker for r in P.known_speakers(configs).collect()} == {"Zed", "Amy", "Bob", "Boss", "???", "Gone"}
    rows = spark.createDataFrame([("w", "Zed"), ("w", "Boss"), ("w", "???"), ("w", "Who"), ("x", "Zed"), ("w", None)], "work_id string, speaker string")
    assert {(r.work_id, r.speaker, r.speaker_norm) for r in P.normalize_speakers(rows, configs).collect()} == {
        ("w", "Zed", "Amy"), ("w", "Boss", "Amy"), ("w", "???", "[unknown]"), ("w", "Who", "Who"), ("x", "Zed", "Zed"), ("w", None, None)}


def test_grid_times_are_served_however_far_the_next_frame_is(spark):
    import random

    from dialoom.operators import sampling as M

    rng = random.Random(4)
    frames = [(k, round(t, 3), n) for k in "ab" for n, t in enumerate(sorted(rng.uniform(0, 90) for _ in range(25)))] + [("a", 7.4, 99), ("a", 7.4, 98), ("b", None, 1), ("a", 300.0, 50)]
    expected = set()
    for key in "ab":
        mine = sorted((t, n) for k, t, n in frames if k == key and t is not None)
        slot = 0
        while any(t >= slot * 2.5 - 0.1 for t, _ in mine):
            expected.add((key, slot * 2.5, *min(x for x in mine if x[0] >= slot * 2.5 - 0.1)))
            slot += 1
    df = spark.createDataFrame(frames, "key string, ts double, n int")
    for chunk_s in (3.0, 3600.0):
        assert {tuple(r) for r in M.sample_grid(df, 2.5, ["n"], chunk_s=chunk_s).collect()} == expected
    assert {r.grid_ts for r in M.sample_grid(df, 2.5, ["n"], start=5.0, end=10.0).collect()} == {5.0, 7.5}
    times = spark.createDataFrame([("a", 7.4), ("a", 7.41), ("b", 1000.0), ("c", 1.0), ("a", 7.4)], "key string, at double")
    after = min((t, n) for k, t, n in frames if k == "a" and t is not None and t >= 7.41)
    assert {tuple(r) for r in M.frame_at(df, times, columns=("n",), chunk_s=5.0).collect()} == {("a", 7.4, 7.4, 98), ("a", 7.41, *after), ("b", 1000.0, None, None), ("c", 1.0, None, None)}


def test_merging_keeps_events_without_a_time_or_a_video(spark):
    from dialoom.operators import merge

    schema = "video_id string, event_id string, start_ms bigint, end_ms bigint, speaker string, text string"
    rows = [("v", "a", 0, 900, "x", "We sail"), ("v", "b", 1000, 1900, "x", "We sail at dawn"), ("v", "c", None, None, "x", "We sail at"), (None, "d", 0, 900, None, "Who"), (None, "e", 1000, 1900, None, "Who is there")]
    got = {(r.event_id, r.start_ms, r.merged_from) for r in merge.merge_fragments(spark.createDataFrame(rows, schema), merge.exact_prefix).collect()}
    assert got == {("b", 0, "a"), ("c", None, None), ("e", 0, "d")}


def test_a_chunked_window_shuffles_three_times_and_scans_once(spark, folder):
    from dialoom.operators import speaker as P
    from pyspark.sql import functions as F

    rows = spark.read.parquet(f"{folder}/dialogue_events.parquet").select("video_id", "event_id", "start_ms", "speaker", F.col("confidence").alias("speaker_confidence"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = P.inherit_speakers(rows).select("video_id", "event_id", "inherited_speaker", "inherited_confidence")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("+- Exchange hashpartitioning") == 3 and plan.count("FileScan") == 1, plan


def test_a_checkpoint_has_to_name_the_last_written_event(spark):
    from dialoom.operators import events as E

    events = spark.createDataFrame([("v", "event_999999"), ("v", "event_1000000"), ("u", "event_000001")], "video_id string, event_id string")
    schema = "video_id string, last_event_id string, last_processed_ms bigint"
    good = spark.createDataFrame([("v", "event_1000000", 5), ("u", "", 7), ("new", "event_000009", None)], schema)
    assert {tuple(r) for r in E.resume_points(events, good).collect()} == {("v", 5, 2), ("u", 7, 1), ("new", None, 0)}
    with pytest.raises(Exception, match="event_999999"):
        E.resume_points(events, spark.createDataFrame([("v", "event_999999", 5)], schema)).collect()
