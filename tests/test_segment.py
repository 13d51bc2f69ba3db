"""The state machine, and its batch and streaming operators."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dialoom.operators import segment as S
from dialoom.streaming.segments import pack, segment_stream, unpack


def frames(*steps):
    return [(k * 0.5, text, confidence) for k, (text, confidence) in enumerate(steps)]


def folded(steps, rules=S.Rules()):
    got = S.fold_frames(frames(*steps), len(steps) * 0.5, rules)
    return [(e.start, e.end, e.text, round(e.confidence, 4), e.cause) for e in got]


E = ("", 0.0)
OARS, GATE = "Ship the oars, quickly", "Nobody guards the north gate"


@pytest.mark.parametrize("steps, rules, expected", [
    # typed out in three steps, then gone before it is stable
    ([E, ("Ship the oar", 0.8), ("Ship the oars, qui", 0.8), *[(OARS, 0.6), (OARS, 0.8)] * 2, E, E], S.Rules(), [(0.5, 4.0, OARS, 0.7, "empty")]),
    # a step so long that the line counts as another one
    ([("Ship", 0.7), *[(OARS, 0.8)] * 4], S.Rules(), [(0.0, 0.5, "Ship", 0.7, "replaced"), (0.5, 2.0, OARS, 0.8, "stable")]),
    ([("Ship", 0.7), *[(OARS, 0.8)] * 3], S.Rules(similarity=0.2), [(0.0, 2.0, OARS, 0.8, "flush")]),
    # one line gives way to another in one frame
    ([*[(OARS, 0.5)] * 3, *[(GATE, 0.75)] * 3, E, E], S.Rules(), [(0.0, 1.5, OARS, 0.5, "replaced"), (1.5, 3.5, GATE, 0.75, "empty")]),
    # stable, at once and after growth
    ([(GATE, 0.9)] * 4, S.Rules(), [(0.0, 1.5, GATE, 0.9, "stable")]),
    ([(GATE[:20], 0.9), *[(GATE, 0.9)] * 8], S.Rules(), [(0.0, 4.0, GATE, 0.9, "stable")]),
    # what lingers after its end is no new event, nor is its late tail; after three empty frames it is one
    ([(GATE, 0.9)] * 9, S.Rules(), [(0.0, 1.5, GATE, 0.9, "stable")]),
    ([(GATE, 0.9)] * 4 + [(GATE + "!", 0.9)] * 3, S.Rules(), [(0.0, 1.5, GATE, 0.9, "stable")]),
    ([(GATE, 0.9), E, E, *[(GATE, 0.9)] * 3], S.Rules(), [(0.0, 1.0, GATE, 0.9, "empty")]),
    ([(GATE, 0.9), E, E, E, *[(GATE, 0.9)] * 3], S.Rules(), [(0.0, 1.0, GATE, 0.9, "empty"), (2.0, 3.5, GATE, 0.9, "flush")]),
    # one empty frame is a flicker
    ([(GATE, 0.9), E, *[(GATE, 0.9)] * 3], S.Rules(), [(0.0, 2.0, GATE, 0.9, "stable")]),
])
def test_transitions(steps, rules, expected):
    assert folded(steps, rules) == expected


def test_best_text():
    # of the two longest readings one was seen twice
    text, confidence = S.best_text(["oar", "oars now", "oars new", "oars now", "oa"], [0.9, 0.5, 0.95, 0.75, 0.9])
    assert text == "oars now" and confidence == 0.625
    assert S.best_text(["abc", "abd"], [0.5, 0.6])[0] == "abd" and S.best_text(["abc", "abd"], [0.5, 0.5])[0] == "abc"


def named(*steps):
    return [(k * 0.5, text, 0.9, name, [f"frame {k}"]) for k, (text, name) in enumerate(steps)]


def test_a_speaker_is_read_once_and_then_kept():
    ada, bo = ("Ada", 0.8), ("Bo", 0.7)
    steps = [(OARS, None), (OARS, ada), (GATE, bo), (GATE, ada), (OARS, None), (OARS, bo), ("", None), ("", None)]
    got = S.fold_frames(named(*steps))
    assert [e.speaker for e in got] == [ada, bo, bo] and [e.first_name for e in got] == [None, bo, None] and [e.name for e in got] == [ada, bo, bo]
    # the frame before the one that ends an event; an event that ends right after another has its own
    assert [e.candidates for e in got] == [["frame 1"], ["frame 3"], ["frame 6"]]
    assert S.fold_frames(named((OARS, None), (GATE, None), ("", None), ("", None)))[0].speaker is None


TEXTS = st.sampled_from(["", " ", "ab", "abc", "abcd", "abcdefgh", "xyz", "xyzzy", "你好世界"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(TEXTS, st.sampled_from([0.5, 0.9])), max_size=40))
def test_events_are_ordered_and_long_enough(steps):
    got = folded(steps)
    assert all(a <= b for a, b, *_ in got) and all(len(t) >= 2 for _, _, t, *_ in got)
    assert all(got[k][1] <= got[k + 1][0] for k in range(len(got) - 1))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(TEXTS, st.sampled_from([0.5, 0.9])), max_size=30), st.integers(0, 30))
def test_state_survives_packing(steps, cut):
    machine, out, number = S.Fold(), [], 0
    for k, (ts, text, confidence) in enumerate(frames(*steps)):
        if k == cut:
            machine, number, _, _ = unpack(pack(machine, number, ts, 0), S.Rules())
        out += machine.feed(ts, text, confidence)
    assert out + machine.flush(len(steps) * 0.5) == S.fold_frames(frames(*steps), len(steps) * 0.5)


def random_frames(seed, videos=4, n=400):
    rng = random.Random(seed)
    rows = []
    for v in range(videos):
        ts, text = 0.0, ""
        for _ in range(n):
            if rng.random() < 0.25:
                text = rng.choice(["", "", "", "Hello there", "Hello there my friend", "Another line", "你好", "你好世界", "x"])
            rows.append((f"v{v}", ts, text, rng.choice([0.5, 0.8, 0.9])))
            ts += 0.5
    return rows


def expected_events(rows):
    out = {}
    for v in sorted({r[0] for r in rows}):
        mine = sorted((r[1:] for r in rows if r[0] == v), key=lambda r: (r[0], r[1]))
        found = S.fold_frames([r[:3] for r in mine], mine[-1][0] + 0.5)
        out[v] = [(f"event_{k:06d}", int(e.start * 1000), int(e.end * 1000), e.text, round(e.confidence, 6), e.cause, e.n_frames) for k, e in enumerate(found, 1)]
    return out


def with_names(rows, seed):
    rng = random.Random(seed)
    names = [(None, None)] * 6 + [("Ada", 0.9), ("Bo ", 0.6), (" ", 0.9), ("Cy", 0.3)]
    return [(*r, *(rng.choice(names) if r[0] != "v0" or r[1] > 60 else (None, None)), [("o", f"{r[1]}", 0.5)]) for r in rows]


def named_events(rows):
    out = {}
    for v in sorted({r[0] for r in rows}):
        mine = sorted((r[1:] for r in rows if r[0] == v), key=lambda r: (r[0], r[1]))
        steps = [(ts, text, c, (name.strip(), sure) if name and name.strip() and sure >= 0.5 else None, shown) for ts, text, c, name, sure, shown in mine]
        found = S.fold_frames(steps, mine[-1][0] + 0.5)
        out[v] = [(f"event_{k:06d}", e.text, *(e.speaker or (None, 0.0)), e.candidates[0][1] if e.candidates else None) for k, e in enumerate(found, 1)]
    return out


NAMED = "video_id string, ts double, text string, confidence double, name string, name_confidence double, candidates array<struct<engine string, text string, confidence double>>"


@pytest.mark.parametrize("chunk_s", [7.0, 3600.0])
def test_speakers_in_batch_equal_one_pass(spark, chunk_s):
    rows = with_names(random_frames(5), 6)
    got = {}
    for r in S.segment_with_speakers(spark.createDataFrame(rows, NAMED).repartition(3), chunk_s=chunk_s).collect():
        got.setdefault(r.video_id, []).append((r.event_id, r.text, r.speaker, r.speaker_confidence, r.candidates[0].text if r.candidates else None))
    expected = named_events(rows)
    assert {v: sorted(e) for v, e in got.items()} == expected and any(e[2] for e in expected["v0"]) and not expected["v0"][0][2]
    assert S.segment_with_speakers(spark.createDataFrame([], NAMED)).count() == 0


@pytest.mark.parametrize("chunk_s", [7.0, 3600.0])
def test_batch_equals_one_pass(spark, chunk_s):
    rows = random_frames(1)
    df = spark.createDataFrame(rows, "video_id string, ts double, text string, confidence double").repartition(3)
    got = {}
    for r in S.segment(df, chunk_s=chunk_s).collect():
        got.setdefault(r.video_id, []).append((r.event_id, r.start_ms, r.end_ms, r.text, r.confidence, r.cause, r.n_frames))
    assert {v: sorted(e) for v, e in got.items()} == {v: e for v, e in expected_events(rows).items() if e}


def test_batch_edge_cases(spark):
    schema = "video_id string, ts double, text string, confidence double, extra string"
    assert S.segment(spark.createDataFrame([], schema)).count() == 0
    rows = [("v", 0.0, None, None, "x"), ("v", 0.5, "hi there", None, None), ("v", None, "lost", 0.5, None), (None, 1.0, "lost", 0.5, None), ("w", 0.0, "long " * 5000, 0.5, None)]
    got = {r.video_id: r for r in S.segment(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"v", "w"} and got["v"].text == "hi there" and got["v"].confidence == 0.0 and len(got["w"].text) == 24999


def test_stream_equals_batch(spark, tmp_path):
    rows = with_names(random_frames(2, videos=2, n=120), 3)
    source, sink = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    schema = "video_id string, ts double, text string, confidence double, is_last boolean, name string, name_confidence double"
    for k in range(3):
        part = [r for i, r in enumerate(rows) if (i % 120) // 40 == k]
        lines = [json.dumps(dict(zip(("video_id", "ts", "text", "confidence", "is_last", "name", "name_confidence"), (*r[:4], r[1] == 59.5, *r[4:6])))) for r in part]
        (source / f"part{k}.json").write_text("\n".join(lines))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").json(str(source))
    query = segment_stream(stream).writeStream.format("parquet").option("path", str(sink)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).outputMode("append").start()
    query.awaitTermination(180)
    got, spoken = {}, {}
    for r in spark.read.parquet(str(sink)).collect():
        spoken.setdefault(r.video_id, []).append((f"event_{r.number:06d}", r.speaker, r.speaker_confidence))
        got.setdefault(r.video_id, []).append((f"event_{r.number:06d}", int(r.start_ts * 1000), int(r.end_ts * 1000), r.text, round(r.confidence, 6), r.cause, r.n_frames))
    assert {v: sorted(e) for v, e in got.items()} == {v: e for v, e in expected_events(rows).items() if e}
    assert {v: sorted(e) for v, e in spoken.items()} == {v: [(e[0], *e[2:4]) for e in events] for v, events in named_events(rows).items()}
