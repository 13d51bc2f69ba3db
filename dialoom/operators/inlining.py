"""Deeply nested records into related flat tables, by shared inlining.

The schema graph of the records has an element type for every field that holds objects, and an edge
from each type to the types below it. A type gets a table of its own where it is repeated (it occurs
in an array), shared (below several types) or recursive (below itself); every other object is inlined
into the nearest table above it. A row of a table is named by its path in the record, and holds the
path of its parent row, so (record id, parent path) is the foreign key.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Collection, Iterator
from json.decoder import scanstring

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.session import cut_lineage

ROOT = "$"
#: The repeated children of an event record.
CHILD_FIELDS = ("ocr_candidates", "lines", "glyphs", "attempts", "crops")
#: A schema with more edges than this is not a schema but data in field names.
MAX_EDGES = 100_000

_EDGES = "parent string, child string, kind string, n bigint, n_repeated bigint"
_LOWER_UPPER = re.compile(r"([a-z0-9])([A-Z])")
_UPPER_WORD = re.compile(r"([A-Z]+)([A-Z][a-z])")
_OTHER = re.compile(r"[\s\-.]+")


def snake_case(name: str) -> str:
    """ocrCandidates, OCRCandidates and ocr-candidates become ocr_candidates."""
    return _OTHER.sub("_", _UPPER_WORD.sub(r"\1_\2", _LOWER_UPPER.sub(r"\1_\2", name))).lower()


_SPACE = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?|true|false|null|-?Infinity|NaN")


def _parsed(text):
    """The value of a JSON text, None where it is null, blank or broken."""
    if not isinstance(text, str) or not text.strip():
        return None
    try:
        return json.loads(text)
    except RecursionError:
        try:
            return parse_deep(text)
        except ValueError:
            return None
    except ValueError:
        return None


def parse_deep(text: str):
    """As json.loads, for texts nested more deeply than a recursive parser can follow."""
    stack: list[tuple[dict | list, str | None]] = []  # what is open, and the key that a value of a dict belongs to
    at = _SPACE.match(text).end()
    value, done = None, False
    while True:
        here = text[at : at + 1]
        if here in ("{", "["):
            opened: dict | list = {} if here == "{" else []
            at = _SPACE.match(text, at + 1).end()
            if text[at : at + 1] == ("}" if here == "{" else "]"):
                value, at = opened, at + 1
            else:
                key = None
                if here == "{":
                    key, at = _key(text, at)
                stack.append((opened, key))
                continue
        elif here == '"':
            value, at = scanstring(text, at + 1, True)
        else:
            found = _SCALAR.match(text, at)
            if not found:
                raise ValueError(f"no value at {at}")
            value, at = json.loads(found[0]), found.end()
        while True:  # the value is whole: put it into what is open
            at = _SPACE.match(text, at).end()
            if not stack:
                done = True
                break
            inside, key = stack.pop()
            if isinstance(inside, dict):
                inside[key] = value
            else:
                inside.append(value)
            sign = text[at : at + 1]
            at = _SPACE.match(text, at + 1).end()
            if sign == ",":
                if isinstance(inside, dict):
                    key, at = _key(text, at)
                stack.append((inside, key))
                break
            if sign != ("}" if isinstance(inside, dict) else "]"):
                raise ValueError(f"no end at {at}")
            value = inside
        if done:
            if at != len(text):
                raise ValueError(f"more than a value at {at}")
            return value


def _key(text: str, at: int) -> tuple[str, int]:
    if text[at : at + 1] != '"':
        raise ValueError(f"no key at {at}")
    key, at = scanstring(text, at + 1, True)
    at = _SPACE.match(text, at).end()
    if text[at : at + 1] != ":":
        raise ValueError(f"no colon at {at}")
    return key, _SPACE.match(text, at + 1).end()


def _unpacked(value):
    """A value that was encoded as a string of an array or object, however often, else the value itself."""
    while isinstance(value, str) and value.lstrip()[:1] in ("[", "{", '"'):
        inner = _parsed(value)
        if not isinstance(inner, (dict, list, str)):
            break
        value = inner  # shorter than the string that held it
    return value


def readability(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(n_records, n_null, n_blank, n_broken, n_no_object): the records that cannot be shredded, and why."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            broken = no_object = 0
            for text in batch["payload"]:
                value = _parsed(text)
                broken += value is None and text.strip() != "null"
                no_object += not isinstance(value, dict) and (value is not None or text.strip() == "null")
            yield pd.DataFrame([(broken, no_object)], columns=["n_broken", "n_no_object"])

    text = F.col(payload)
    blank = F.trim(F.translate(text, "\t\n\r", "   ")) == ""
    counts = df.agg(F.count("*").alias("n_records"), F.count_if(text.isNull()).alias("n_null"), F.count_if(blank).alias("n_blank"))
    read = df.filter(text.isNotNull() & ~blank).select(text.alias("payload")).mapInPandas(run, "n_broken bigint, n_no_object bigint").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_broken", "n_no_object")])
    return counts.join(F.broadcast(read))  # one row on either side


def _storable(text: str) -> str:
    return text.encode("utf-8", "replace").decode("utf-8")


class _Names(dict):
    def __missing__(self, name: str) -> str:
        self[name] = value = _storable(snake_case(name))
        return value


def schema_graph(df: DataFrame, payload: str = "payload", packed: Collection[str] = CHILD_FIELDS) -> DataFrame:
    """(parent, child, kind, n, n_repeated): the edges between element types.

    kind is `object` or `value`; n counts the children, n_repeated those that lay in an array. Fields in
    `packed` may hold their array or object encoded as a string. Records that cannot be read have no edges.
    """
    packed = frozenset(packed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, n, repeated = _Names(), Counter(), Counter()
        for batch in batches:
            for text in batch["payload"]:
                record = _parsed(text)
                if not isinstance(record, dict):
                    continue
                stack = [(record, ROOT)]
                while stack:
                    here, kind = stack.pop()
                    for key, value in here.items():
                        name = names[key]
                        if name in packed:
                            value = _unpacked(value)
                        many = isinstance(value, list)
                        for child in value if many else [value]:
                            edge = (kind, name, "object" if isinstance(child, dict) else "value")
                            n[edge] += 1
                            repeated[edge] += many
                            if isinstance(child, dict):
                                stack.append((child, name))
        yield pd.DataFrame([(*e, k, repeated[e]) for e, k in n.items()], columns=["parent", "child", "kind", "n", "n_repeated"])

    edges = df.select(F.col(payload).alias("payload")).mapInPandas(run, _EDGES)
    return edges.groupBy("parent", "child", "kind").agg(F.sum("n").alias("n"), F.sum("n_repeated").alias("n_repeated"))


def table_types(graph: DataFrame) -> set[str]:
    """The element types that get a table: repeated, shared or recursive objects. graph: as `schema_graph` gives it."""
    edges = graph.filter("kind = 'object'").limit(MAX_EDGES + 1).collect()  # bounded by the schema, not by the records
    if len(edges) > MAX_EDGES:
        raise ValueError(f"more than {MAX_EDGES} edges in the schema graph")
    parents: dict[str, set[str]] = {}
    below: dict[str, set[str]] = {}
    tables = set()
    for e in edges:
        parents.setdefault(e.child, set()).add(e.parent)
        below.setdefault(e.parent, set()).add(e.child)
        if e.n_repeated:
            tables.add(e.child)
    for kind in parents:
        seen, todo = set(), [kind]
        while todo:
            for child in below.get(todo.pop(), ()):
                if child not in seen:
                    seen.add(child)
                    todo.append(child)
        if kind in seen or len(parents[kind]) > 1:
            tables.add(kind)
    return tables


def _event_id(record: dict, names: _Names) -> str | None:
    found = {names[k]: v for k, v in record.items()}
    value = found.get("event_id")
    if value is None and isinstance(found.get("key"), dict):
        value = next((v for k, v in found["key"].items() if names[k] == "event_id"), None)
    return None if value is None else _storable(value if isinstance(value, str) else json.dumps(value))


def dump_deep(value) -> str:
    """As json.dumps, for values nested more deeply than a recursive writer can follow."""
    out: list[str] = []
    todo: list[tuple[bool, object]] = [(False, value)]
    while todo:
        written, item = todo.pop()
        if written:
            out.append(item)
        elif isinstance(item, dict) and item:
            parts = [p for k, v in item.items() for p in ((True, ", "), (True, json.dumps(k, ensure_ascii=False) + ": "), (False, v))][1:]
            todo += reversed([(True, "{"), *parts, (True, "}")])
        elif isinstance(item, list) and item:
            parts = [p for v in item for p in ((True, ", "), (False, v))][1:]
            todo += reversed([(True, "["), *parts, (True, "]")])
        else:
            out.append(json.dumps(item, ensure_ascii=False))
    return "".join(out)


def _text(value) -> str | None:
    if value is None:
        return None
    if isinstance(value, str):
        return _storable(value)
    try:
        return _storable(json.dumps(value, ensure_ascii=False))
    except RecursionError:
        return _storable(dump_deep(value))


_EDGE = "edge struct<parent: string, child: string, kind: string, n: bigint, n_repeated: bigint>"


def shred(df: DataFrame, tables: Collection[str], id_col: str = "raw_id", payload: str = "payload", values: bool = True, graph: bool = False) -> DataFrame:
    """(id_col, event_id, table, parent_path, path, position, values map<string, string>): one row per table row.

    The root row of each readable record has table `$`, path `$` and a null parent. Objects of the types
    in `tables` become rows at name[position]; they may lie in an array (elements that are no objects
    keep their position but give no row), stand alone (position 0), or be either of these encoded as a
    string. Inlined objects contribute their fields as `name.field`. With `graph` the same pass counts the schema graph: rows
    with a column `edge` that is not null hold its edges, counted within a task, and nothing else. Null, blank and broken payloads and
    payloads that are no object give no row; a record that was delivered twice gives rows under both ids.
    """
    tables = frozenset(tables)
    key_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = _Names()
        columns = ["id", "event_id", "table", "parent_path", "path", "position", "values"] + ["edge"] * graph
        n, repeated = Counter(), Counter()
        none = (None,) * graph
        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(batch["id"], batch["payload"]):
                record = _parsed(text)
                if not isinstance(record, dict):
                    continue
                event = _event_id(record, names)
                # what to visit: object, table, parent row's path, own row's path or None, prefix of fields, path
                stack = [(record, ROOT, None, ROOT, 0)]
                while stack:
                    row, table, parent, path, position = stack.pop()
                    fields: dict[str, str | None] = {}
                    inner = [(row, "", path, table)]
                    while inner:
                        here, prefix, at, kind = inner.pop()
                        for name, value in here.items():
                            name = names[name]
                            if name in tables:
                                value = _unpacked(value)
                            if graph:
                                many = isinstance(value, list)
                                for child in value if many else (value,):
                                    edge = (kind, name, "object" if isinstance(child, dict) else "value")
                                    n[edge] += 1
                                    repeated[edge] += many
                            if name in tables:
                                for k, child in enumerate(value if isinstance(value, list) else [value]):
                                    if isinstance(child, dict):
                                        stack.append((child, name, path, f"{at}.{name}[{k}]", k))
                            elif isinstance(value, dict):
                                inner.append((value, f"{prefix}{name}.", f"{at}.{name}", name))
                            elif isinstance(value, list) and any(isinstance(x, dict) for x in value):
                                for k, child in enumerate(value):
                                    if isinstance(child, dict):
                                        inner.append((child, f"{prefix}{name}[{k}].", f"{at}.{name}[{k}]", name))
                            elif values:
                                fields[prefix + name] = _text(value)
                    out.append((key, event, table, parent, path, position, fields, *none))
                if len(out) > 200_000:
                    yield pd.DataFrame(out, columns=columns).astype({"position": "Int32"})
                    out = []
            yield pd.DataFrame(out, columns=columns).astype({"position": "Int32"})
        if n:
            edges = [{"parent": e[0], "child": e[1], "kind": e[2], "n": k, "n_repeated": repeated[e]} for e, k in n.items()]
            yield pd.DataFrame([(None,) * 7 + (e,) for e in edges], columns=columns).astype({"position": "Int32"})

    schema = f"id {key_type}, event_id string, table string, parent_path string, path string, position int, values map<string, string>" + f", {_EDGE}" * graph
    rows = df.select(F.col(id_col).alias("id"), F.col(payload).alias("payload")).mapInPandas(run, schema)
    return rows.withColumnRenamed("id", id_col)


def flat_table(rows: DataFrame, table: str, columns: Collection[str], id_col: str = "raw_id") -> DataFrame:
    """One table of `shred`: keys and the named fields, `a.b` as column a_b; a field that a row lacks is null."""
    keys = {id_col, "event_id", "parent_path", "path", "position"}
    picked = [F.col("values")[c].alias(c.replace(".", "_") if c.replace(".", "_") not in keys else f"{table.strip('$') or 'record'}_{c}".replace(".", "_")) for c in columns]
    return rows.filter(F.col("table") == table).select(id_col, "event_id", "parent_path", "path", "position", *picked)


def child_links(df: DataFrame, id_col: str = "raw_id", payload: str = "payload", children: Collection[str] = CHILD_FIELDS) -> DataFrame:
    """(id_col, event_id, parent_path, child_path): the foreign keys of all children in the fields `children`.

    One pass shreds the records at the fields in `children` and counts their schema graph. The graph then decides which
    element types are tables: those that are repeated, shared or recursive, and of the given fields also those that only
    ever hold a single object. Rows of other types are none; all else is inlined, so that a row's parent is the nearest
    enclosing child or the record.
    """
    seen = cut_lineage(shred(df, children, id_col, payload, values=False, graph=True))
    edges = seen.filter("edge is not null").select("edge.*").groupBy("parent", "child", "kind").agg(F.sum("n").alias("n"), F.sum("n_repeated").alias("n_repeated"))
    objects = edges.filter("kind = 'object'")
    single = {r.child for r in objects.filter(F.col("child").isin(list(children))).select("child").distinct().collect()}
    tables = (table_types(objects) | single) & set(children)
    rows = seen.filter(F.col("edge").isNull() & F.col("table").isin(sorted(tables)))
    return rows.select(id_col, "event_id", "parent_path", F.col("path").alias("child_path"))
