"""Files: event records, settings, books, transcripts."""

import io
import json
import zipfile

import pytest

from dialoom.sources import books, records, sinks

EVENT = {"video_id": "v", "event_id": "event_000001", "start_ms": 0, "end_ms": 1000, "speaker": None, "text": "你好", "confidence": 0.9, "review_required": False,
         "ocr_candidates": [{"engine": "a", "text": "你好", "confidence": 0.9}]}


def test_lenient_and_strict_records(spark, tmp_path):
    lines = [json.dumps(EVENT, ensure_ascii=False), "", "   ", "{broken", json.dumps({**EVENT, "unknown": 1}), json.dumps({k: v for k, v in EVENT.items() if k != "text"}), json.dumps({**EVENT, "event_id": "event_000002"})]
    path = tmp_path / "e.jsonl"
    path.write_text("\n".join(lines), encoding="utf-8")
    got = records.read_events(spark, str(path))
    assert sorted(r.event_id for r in got.collect()) == ["event_000001", "event_000002"]
    assert got.first().ocr_candidates[0].engine == "a"
    row = records.skipped_lines(spark, str(path)).first()
    assert (row.n_lines, row.n_blank, row.n_read, row.n_skipped) == (7, 2, 2, 3)
    with pytest.raises(Exception, match="(?s)FAILFAST|MALFORMED|FAILED_READ_FILE"):
        records.read_events(spark, str(path), strict=True).collect()


def test_corrections_keep_their_place(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"video_id": "v", "event_id": "a", "speaker": "x", "text": "1", "accepted": False}, {"video_id": "v", "event_id": "a", "speaker": "y", "text": "2", "accepted": True}]))
    got = records.read_corrections(spark, str(tmp_path / "c.json")).orderBy("position").collect()
    assert [(r.position, r.speaker, r.accepted) for r in got] == [(0, "x", False), (1, "y", True)]


def test_work_config():
    box = {"x": 0.1, "y": 0.7, "w": 0.5, "h": 0.2}
    config = records.work_config({"work_id": "w", "dialog_box": box, "name_box": box, "unknown": 1})
    assert config.target_fps == 2.0 and config.fallback_engine is None
    for bad in ({"work_id": "w"}, [], {"work_id": "w", "dialog_box": {**box, "x": 0.9}, "name_box": box}, {"work_id": "w", "dialog_box": {**box, "w": 0}, "name_box": box}):
        with pytest.raises(ValueError):
            records.work_config(bad)


def test_work_config_file(tmp_path):
    box = {"x": 0.1, "y": 0.7, "w": 0.5, "h": 0.2}
    (tmp_path / "w.json").write_text(json.dumps({"work_id": "w", "name": "W", "dialog_box": box, "name_box": box}))
    assert records.load_work_config(str(tmp_path / "w.json")).name == "W"


def book(with_container=True):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        if with_container:
            z.writestr("META-INF/container.xml", '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/b.opf"/></rootfiles></container>')
        z.writestr("OEBPS/b.opf", '<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="a" href="a.xhtml" media-type="application/xhtml+xml"/><item id="b" href="b.xhtml" media-type="application/xhtml+xml"/>'
                   '<item id="c" href="c.xhtml" media-type="application/xhtml+xml"/><item id="gone" href="gone.xhtml" media-type="text/html"/><item id="img" href="i.png" media-type="image/png"/></manifest>'
                   '<spine><itemref idref="b"/><itemref idref="a"/><itemref idref="gone"/><itemref idref="c"/><itemref idref="img"/><itemref idref="b"/></spine></package>')
        z.writestr("OEBPS/a.xhtml", "<html><head><title>T</title></head><body><h1>One</h1><p>a &amp; b</p><script>x('</p>')</script></body></html>")
        z.writestr("OEBPS/b.xhtml", "<p>Two</p>")
        z.writestr("OEBPS/c.xhtml", b"<p>\xff\xfe</p>")
    return out.getvalue()


@pytest.mark.parametrize("with_container", [True, False])
def test_chapters(with_container):
    assert [(p, h) for p, h, _ in books.chapters_of(book(with_container))] == [(0, "b.xhtml"), (1, "a.xhtml"), (5, "b.xhtml")]


def test_read_books(spark, tmp_path):
    (tmp_path / "x.epub").write_bytes(book())
    (tmp_path / "y.epub").write_bytes(b"no zip")
    got = books.read_chapters(spark, str(tmp_path))
    assert got.filter("error is not null").count() == 1
    text = books.join_chapters(got).filter("path like '%x.epub'").first().text
    assert text.split(books.CHAPTER_BREAK) == ["Two", "TOne\n\na & b", "Two"] or text.split(books.CHAPTER_BREAK)[0] == "Two"


@pytest.mark.parametrize("html, text", [("<p>a</p><p>b</p>", "a\n\nb"), ("a<br>b", "a\nb"), ("a<br/>b", "a\nb"), ("a &am", ""), ("<style>p{}</style>x<b>y</b>", "xy"), (None, None), ("", ""), ("<p>a</p>" + "<br>" * 9 + "<p>b</p>", "a\n\n\nb")])
def test_html(html, text):
    assert books.text_of_html(html) == text


def test_replace_events_reads_and_writes_one_folder(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([("v", "a", 1), ("v", "b", 2)], "video_id string, event_id string, n int").write.json(path)
    sinks.replace_events(spark.read.json(path).filter("n > 1"), path)
    assert [r.event_id for r in spark.read.json(path).collect()] == ["b"]


def test_transcripts_round_trip(spark, tmp_path):
    rows = [("v", "event_000001", 0, 1000, "A", "hi", False), ("v", "event_000002", 65_000, 66_000, None, "there", True)]
    df = spark.createDataFrame(rows, "video_id string, event_id string, start_ms bigint, end_ms bigint, speaker string, text string, review_required boolean")
    sinks.write_transcripts(df, str(tmp_path / "t"))
    clean = records.read_transcripts(spark, str(tmp_path / "t/clean/video_id=v")).collect()
    both = records.read_transcripts(spark, str(tmp_path / "t/review/video_id=v")).orderBy("start_ms").collect()
    assert [(r.start_ms, r.speaker, r.text) for r in clean] == [(0, "A", "hi")]
    assert [(r.start_ms, r.speaker, r.text) for r in both] == [(0, "A", "hi"), (65_000, None, "there")]


REGIONS = {"work_id": "w", "resolution": {"width": 1920, "height": 1080}, "dialogue_box": {"roi": {"x": 100, "y": 800, "width": 1000, "height": 200}}, "name_box": {"roi": {"x": 100, "y": 700, "width": 301, "height": 80}}}


def test_regions(tmp_path):
    path = str(tmp_path / "r.json")
    records.save_regions(REGIONS, path)
    assert records.load_regions(path) == REGIONS
    small = records.rescale_regions(REGIONS, 960, 540)
    assert small["name_box"]["roi"] == {"x": 50, "y": 350, "width": 150, "height": 40}
    bad = {**REGIONS, "dialogue_box": {"roi": {"x": -1, "y": 800, "width": 3000, "height": 0}}, "name_box": {}}
    assert records.region_problems(bad) == ["dialogue_box: x", "dialogue_box: height", "dialogue_box: right", "name_box: roi"]
    assert records.region_problems([]) == ["no mapping"] and "resolution" in records.region_problems({"work_id": "w"})
    with pytest.raises(ValueError):
        records.load_regions(str(tmp_path / "r.txt")) if (tmp_path / "r.txt").write_text("x") else None


def test_engines_run_the_fallback_only_where_needed(spark):
    from dialoom.functions.engines import engine_factory, recognize, register_engine
    from dialoom.operators.fusion import fuse_candidates

    register_engine("first", lambda: lambda image: (image.decode(), 0.5 if image.startswith(b"low") else 0.9))
    register_engine("second", lambda: lambda image: (image.decode() + " better", 0.85))
    df = spark.createDataFrame([(1, bytearray(b"low text")), (2, bytearray(b"fine")), (3, None)], "n int, image binary")
    got = {r.n: r for r in fuse_candidates(recognize(df, "first", "second"), "candidates").collect()}
    assert (got[1].chosen_text, got[1].chosen_reason, len(got[1].candidates)) == ("low text better", "fallback:second(conf 0.850>0.500)", 2)
    assert (got[2].chosen_text, got[2].n_candidates) == ("fine", 1) and got[3].chosen_text is None
    with pytest.raises(ValueError):
        engine_factory("none")
