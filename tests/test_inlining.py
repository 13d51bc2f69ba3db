"""Nested records into tables, against a recursive walk."""

import json
import re

import pytest

from dialoom.operators import inlining as I

SCHEMA = "raw_id bigint, writer string, payload string"


def walk(rows):
    """(raw_id, event_id, parent, child) by plain recursion."""
    out = set()
    for raw, _, text in rows:
        try:
            record = json.loads(text)
        except (TypeError, ValueError, RecursionError):
            continue
        if not isinstance(record, dict):
            continue
        names = lambda o: {re.sub(r"(?<!^)(?=[A-Z])", "_", k).lower(): v for k, v in o.items()}
        top = names(record)
        event = top.get("event_id") or names(top.get("key") or {}).get("event_id")

        def go(o, parent, path):
            for k, v in names(o).items():
                if k in I.CHILD_FIELDS:
                    if isinstance(v, str):
                        try:
                            v = json.loads(v)
                        except ValueError:
                            continue
                    for n, x in enumerate(v if isinstance(v, list) else [v]):
                        if isinstance(x, dict):
                            out.add((raw, event, parent, f"{path}.{k}[{n}]"))
                            go(x, f"{path}.{k}[{n}]", f"{path}.{k}[{n}]")
                elif isinstance(v, dict):
                    go(v, parent, f"{path}.{k}")

        go(record, "$", "$")
    return out


EDGE = [
    (1, "w", json.dumps({"event_id": "e1", "ocr_candidates": [{"engine": "a", "lines": {"text": "x", "glyphs": [1, None, {"ch": "x"}]}}, None, "no", {"engine": "b"}]})),
    (2, "w", json.dumps({"key": {"eventId": "e2"}, "ocrCandidates": json.dumps({"engine": "c", "attempts": json.dumps([{"ms": 1}])})})),
    (3, "w", None), (4, "w", ""), (5, "w", "  "), (6, "w", '{"event_id": "e6", "lines": [{"te'), (7, "w", "[1, 2]"), (8, "w", '"text"'),
    (9, "w", json.dumps({"event_id": "e9", "provenance": {"source_file": "f", "crops": {"kind": "x"}}, "lines": "not json", "glyphs": []})),
    (10, "w", json.dumps({"event_id": "e1", "ocr_candidates": [{"engine": "a"}]})), (11, "w", json.dumps({"event_id": "e1", "ocr_candidates": [{"engine": "a"}]})),
    (12, "w", json.dumps({"lines": [{"text": "y" * 100_000}]})), (None, "w", json.dumps({"event_id": "e", "lines": [{}]})),
    (13, "w", "[" * 100_000), (14, "w", '{"event_id": "\\ud800", "lines": [{}]}'),
]


def links(spark, rows):
    return [tuple(r) for r in I.child_links(spark.createDataFrame(rows, SCHEMA)).collect()]


def test_edge_cases(spark):
    got = set(links(spark, EDGE))
    assert (14, "?", "$", "$.lines[0]") in got
    assert {g for g in got if g[0] != 14} == {w for w in walk(EDGE) if w[0] != 14}


def test_empty_table_and_repeated_rows(spark):
    assert links(spark, []) == []
    assert len(links(spark, [EDGE[0], EDGE[0]])) == 2 * len(links(spark, [EDGE[0]]))


def test_whole_table(spark, folder):
    raw = spark.read.parquet(f"{folder}/raw_records.parquet")
    rows = [tuple(r) for r in raw.select("raw_id", "writer", "payload").collect()]
    assert set(links(spark, rows)) == walk(rows)


def test_tables_join_back(spark):
    df = spark.createDataFrame(EDGE, SCHEMA)
    tables = I.table_types(I.schema_graph(df)) | set(I.CHILD_FIELDS)
    rows = I.shred(df, tables).cache()
    parents = {(r.raw_id, r.path) for r in rows.collect()}
    assert all((r.raw_id, r.parent_path) in parents for r in rows.collect() if r.parent_path is not None)
    lines = I.flat_table(rows, "lines", ["text", "event_id"]).filter("raw_id = 1").collect()
    assert [(r.event_id, r.parent_path, r.path, r.text) for r in lines] == [("e1", "$.ocr_candidates[0]", "$.ocr_candidates[0].lines[0]", "x")]


def test_schema_graph_finds_repeated_shared_and_recursive_types(spark):
    rows = [(1, "w", json.dumps({"a": {"box": {"x": 1}}, "b": {"box": {"x": 2}}, "list": [{"y": 1}], "tree": {"tree": {"z": 1}}, "once": {"v": 1}}))]
    graph = I.schema_graph(spark.createDataFrame(rows, SCHEMA))
    assert I.table_types(graph) == {"box", "list", "tree"}


@pytest.mark.parametrize("name, expected", [("ocrCandidates", "ocr_candidates"), ("OCRCandidates", "ocr_candidates"), ("ocr-candidates", "ocr_candidates"), ("lines", "lines")])
def test_snake_case(name, expected):
    assert I.snake_case(name) == expected


def test_a_deep_record_is_read_whole(spark):
    depth = 20_000
    deep = '{"eventId": "e", "note": ' + '{"a": [' * depth + '"x, \\"y\\""' + "]}" * depth + ', "crops": [{"file": "f"}, 3]}'
    rows = [(1, deep), (2, deep[:-1]), (3, None), (4, " \n"), (5, "[1]"), (6, "null"), (7, '{"crops": "\\"\\\\\\"[{}]\\\\\\"\\""}')]
    df = spark.createDataFrame(rows, "raw_id bigint, payload string")
    assert {(r.raw_id, r.event_id, r.parent_path, r.child_path) for r in I.child_links(df).collect()} == {(1, "e", "$", "$.crops[0]"), (7, None, "$", "$.crops[0]")}
    assert tuple(I.readability(df).first()) == (7, 1, 1, 1, 2)


@pytest.mark.parametrize("text", ['{"a": [1, -2.5e3, true, null, {"b": {}}], "c": "\\u00e9\\n", "a2": []}', "[]", "{}", ' [ { } , [ ] ] ', '"x"', "3", "true"])
def test_the_deep_parser_reads_what_the_other_one_reads(text):
    assert I.parse_deep(text) == json.loads(text)


@pytest.mark.parametrize("text", ["", "[1,]", "{", '{"a" 1}', "{1: 2}", "[1] 2", "[1}", '{"a": }', "nul"])
def test_the_deep_parser_refuses_what_is_broken(text):
    with pytest.raises(ValueError):
        I.parse_deep(text)


def test_deep_values_are_written_whole(spark):
    deep = "[" * 30_000 + '1, "x"' + "]" * 30_000
    assert I.dump_deep(json.loads('{"a": [1, [], {}, {"b": null}], "c": "é\\""}')) == '{"a": [1, [], {}, {"b": null}], "c": "é\\""}'
    df = spark.createDataFrame([(1, '{"event_id": "e", "note": ' + deep + "}")], "raw_id bigint, payload string")
    assert I.shred(df, set()).first()["values"]["note"] == deep
