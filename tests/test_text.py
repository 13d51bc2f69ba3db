"""Text functions, similarity, merging and ordered windows against plain Python."""

from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialoom.functions import similarity as Sim
from dialoom.functions import text as T
from dialoom.operators import merge, ordered

HUD = ["2635/2635", "HP 100/100", "27HV2", "LV50", "OK", "HP", "第3章", "12/34 abc", " 12 "]
NO_HUD = ["第三章", "", "a1b2", "Hello 12", "第三章", "  ", None]


def column(spark, values, expression):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, text string")
    return [r[1] for r in sorted(df.select("k", expression(F.col("text"))).collect())]


def test_hud(spark):
    assert all(column(spark, HUD, T.is_hud))
    assert not any(column(spark, NO_HUD, T.is_hud))


def test_strip_is_that_of_python(spark):
    values = ["　a　", " b ", "\x1fc", " d e ", "", "\t\n"]
    assert column(spark, values, T.strip) == [v.strip() for v in values]


def test_quality(spark):
    values = ["你好。", "。，！", "a", "（你好", "「你好」", "ab", "（你好）", ""]
    assert column(spark, values, T.passes_quality) == [True, False, False, False, True, True, True, False]


def test_review(spark):
    rows = [("测试对话", "A", 0.85, False), ("低置信度文本", None, 0.55, True), ("测试对话", "A", 0.4, True), ("嗯。", "A", 0.9, False), ("嗯", "A", 0.9, True), ("测试", "", 0.9, True), ("（嗯。", "A", 0.9, True)]
    df = spark.createDataFrame(rows, "text string, speaker string, confidence double, expected boolean")
    got = df.select("expected", T.needs_review(F.col("text"), F.col("speaker"), F.col("confidence"), 0.7).alias("flag")).collect()
    assert [r.flag for r in got] == [r.expected for r in got]


def test_times_and_lines(spark):
    df = spark.createDataFrame([(125300, "A", "x", 1.001), (0, None, "y", 2.3), (360_000_000, "", "z", 0.29), (1, "B", "w", 4.35)], "ms bigint, speaker string, text string, s double")
    got = df.select(T.transcript_line(F.col("ms"), F.col("speaker"), F.col("text")), T.seconds_to_ms(F.col("s")), T.srt_stamp(F.col("ms"))).collect()
    assert [r[0] for r in got] == ["[00:02:05] A: x", "[00:00:00] y", "[100:00:00] z", "[00:00:00] B: w"]
    assert [r[1] for r in got] == [1000, 2300, 290, 4350]
    assert got[0][2] == "00:02:05,300"


@pytest.mark.parametrize("short, long, expected", [("你好", "你好世界", True), ("你", "你好", False), ("你好世界", "你好", False), ("你妤世", "你好世界", True), ("等等…", "等等...我", True), ("完全不同", "你好世界啊", False), (None, "x", False)])
def test_fuzzy_prefix(short, long, expected):
    assert Sim.is_fuzzy_prefix(short, long) is expected


def test_ratio_keeps_the_order_of_its_arguments(spark):
    noisy = "".join("ab" if k % 5 else "xy" for k in range(220))
    pairs = [("tide", "diet"), ("diet", "tide"), (noisy[:-3], noisy), (None, "a")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(Sim.ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [None if a is None else SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def greedy(rows, drop_hud=True):
    """Merging as one loop over a video's events (id, start, end, speaker, text)."""
    rows, out, k = sorted(rows, key=lambda r: (r[1], r[0])), [], 0
    many = len(rows) > 1
    while k < len(rows):
        a, b = rows[k], rows[k + 1] if k + 1 < len(rows) else None
        if b and a[3] == b[3] and b[1] - a[2] < 5000 and Sim.is_fuzzy_prefix(a[4], b[4]):
            out.append((b[0], a[1], b[4], a[0]))
            k += 2
        else:
            out.append((a[0], a[1], a[4], None))
            k += 1
    import re

    def hud(t):
        t = t.strip()
        return bool(t) and bool(re.match(r"^[\d\s/]+$", t) or re.match(r"^\d+\s*/\s*\d+", t) or re.match(r"^[A-Z0-9]{2,}$", t) or re.match(r"^[A-Z]{2,}\s*\d", t) or len(t) <= 3 and any(c.isdigit() for c in t))

    return [r for r in out if not (drop_hud and many and hud(r[2]))]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.sampled_from(["A", "B", None]), st.sampled_from(["他", "你好", "你好世", "你好世界", "你好世界啊我", "LV50", "abc", "abcd", "abcdefg"])), min_size=0, max_size=25),
       st.sampled_from([700, 10_000_000]))
def test_merge_equals_the_greedy_scan(spark, events, chunk):
    rows = [("v", f"event_{k:06d}", 400 * s, 400 * s + 300, who, text) for k, (s, who, text) in enumerate(events)]
    df = spark.createDataFrame(rows, "video_id string, event_id string, start_ms bigint, end_ms bigint, speaker string, text string")
    got = sorted((r.event_id, r.start_ms, r.text, r.merged_from) for r in merge.merge_fragments(df, chunk_ms=chunk).collect())
    assert got == sorted(greedy([r[1:] for r in rows]), key=lambda r: r[0])


def test_running_and_neighbour_equal_plain_windows(spark):
    rows = [(k % 3, k * 7 % 50, k, None if k % 4 else k) for k in range(120)]
    df = spark.createDataFrame(rows, "key int, t int, id int, v int").withColumn("c", F.floor(F.col("t") / 9).cast("bigint"))
    got = {r.id: (r.s, r.l, r.before_id) for r in ordered.neighbour(ordered.running(ordered.running(df, ["key"], "c", ["t", "id"], F.lit(1), "sum", "s"), ["key"], "c", ["t", "id"], F.col("v"), "last", "l"), ["key"], "c", ["t", "id"], ["id"], "before_").collect()}
    for key in range(3):
        last, before = None, None
        for n, (_, _, i, v) in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])), 1):
            last = v if v is not None else last
            assert got[i] == (n, last, before)
            before = i
