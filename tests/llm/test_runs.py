import random

import pytest

from dialoom.llm import runs
from dialoom.llm.sameline import same_line


@pytest.mark.parametrize("a, b", [
    ("Hold the coat steady and breathe.", "H01d the coat steady and breathe."), ("Give me ten minutes and a clock.", "GIVE ME TEN MINUTES AND A CLOCK."),
    ("I'll pay you back, I promise.", "I'll pay you back, I pr0mise.."), ("手の震えが止まらない。", "手の震え□止まらない。"), ("我会还给你的，我保证。", "我会还给给你的，我保证"),
    ("Soтething new", "Soтething new "), ("Someone painted this letter.", "Someone paintedthis letter."), ("no", "No!"), ("let us go now", "letusgonow"), ("no\u200b\u200b\u200b\u200b\u200b\u200b\u200b\u200b\u200b\u200b\u200b!", "no"),
    ("Linin Vonick told no one.", "Liin Vonick told no one."), ("How many times must I climb there?", "How many times must I c1imb there?"), ("The wind smells of salt.", "The wind smells of sl."),
    ("So this is where the key was hidden.", "So this is where the key w hidden."), (None, None), ("…", "……"), ("", "")])
def test_same(a, b):
    assert same_line(a, b) and same_line(b, a)


@pytest.mark.parametrize("a, b", [
    ("Take the key to room 14.", "Take the key to room 17."), ("Open the left gate now.", "Open the right gate now."), ("I believed every word.", "I believed no word."),
    ("He will come back.", "She will come back."), ("I can carry this alone.", "I can't carry this alone."), ("他一定会回到这里来的。", "她一定会回到这里来的。"),
    ("我一个人能把它搬走。", "我一个人不能把它搬走。"), ("私はその話を信じる。", "私はその話を信じない。"), ("Él volverá pronto.", "Ella volverá pronto."), ("Tell me about the coat.", "Tell me about the boat."),
    ("Tell me about the light.", "Tell me about the night."), ("Room 12 3", "Room 1 23"), ("a", None), ("", "a"), ("…", "—"), ("Hello", "Goodbye my friend")])
def test_different(a, b):
    assert not same_line(a, b) and not same_line(b, a)


def brute(rows):
    once, out = {}, []
    for v, k, s, e, who, text in rows:
        if v is not None and k is not None:
            once[(v, k)] = (v, k, s, e, who, text)
    ordered = sorted(once.values(), key=lambda r: (r[0], r[2] is None, r[2] or 0, r[1]))
    for r in ordered:
        if out and out[-1][-1][0] == r[0] and out[-1][-1][4] == r[4] and same_line(out[-1][-1][5], r[5]):
            out[-1].append(r)
        else:
            out.append([r])
    return sorted((g[0][0], f"event_{g[0][1]:06d}", f"event_{g[-1][1]:06d}", len(g)) for g in out)


def collapsed(df, **options):
    return sorted((r.video_id, r.first_event_id, r.last_event_id, r.n_events) for r in runs.collapse_runs(df, **options).collect())


@pytest.mark.parametrize("parts, batch", [(1, 10_000), (1, 7), (5, 3), (13, 10_000)])
def test_equals_one_scan(spark, make_events, parts, batch):
    rng = random.Random(1)
    lines = ["Hold the coat steady.", "Hold the coat steady..", "Hold the caot steady.", "Something else is said.", None, ""]
    rows = [(f"v{k % 3}", k, rng.choice([k * 700, k * 700, 40_000, None]), k * 700 + 500, rng.choice(["A", "A", None]), rng.choice(lines)) for k in range(200)]
    rows += rows[:40] + [(None, 1, 0, 1, "A", "x"), ("v0", None, 0, 1, "A", "x")]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert collapsed(make_events(rows), parts=parts) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("parts", [1, 6])
def test_many_events_at_one_time_follow_their_numbers(spark, parts):
    rows = [("v", f"e{k}", None if k > 60 else 0, 0, "A", "one line" if k % 10 else "another thing") for k in range(120)]
    df = spark.createDataFrame(rows, "video_id string, event_id string, start_ms bigint, end_ms bigint, speaker string, text string")
    got = {(r.first_event_id, r.last_event_id, r.n_events) for r in runs.collapse_runs(df, parts=parts).collect() if r.n_events > 1}
    assert got == {(f"e{k * 10 + 1}", f"e{k * 10 + 9}", 9) for k in range(12)}


def test_times_and_edges(make_events):
    rows = [("v", 1, 0, 500, "A", "x " * 60_000), ("v", 2, 900, 900, "A", "x " * 60_000), ("v", 3, 1000, None, None, None)]
    got = {r.first_event_id: r for r in runs.collapse_runs(make_events(rows)).collect()}
    assert got["event_000001"].n_events == 2 and (got["event_000001"].start_ms, got["event_000001"].end_ms, got["event_000001"].duration_ms) == (0, 900, 900)
    assert got["event_000003"].n_events == 1 and got["event_000003"].duration_ms == 0
    assert runs.collapse_runs(make_events([])).count() == 0
