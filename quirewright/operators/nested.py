"""Deeply nested records as related flat tables, by Dewey labels.

Every object and value of a record gets the ordinal path that leads to it. The parent's label is the label without its
last ordinal, so links need no identifiers from elsewhere and no join; nodes of one schema path form one table.
A record is parsed where it lies: one pass, no shuffle, whatever its depth.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Collection, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirewright.session import settled

NODE_FIELDS = "label array<int>, steps array<string>, schema_path string, kind string, value string, members map<string,string>"
_NODE = pa.struct(
    [
        ("label", pa.list_(pa.int32())),
        ("steps", pa.list_(pa.string())),
        ("schema_path", pa.string()),
        ("kind", pa.string()),
        ("value", pa.string()),
        ("members", pa.map_(pa.string(), pa.string())),
    ]
)


def _scalar(v: object) -> str | None:
    return v if v is None or isinstance(v, str) else json.dumps(v)


def _kind(v: object) -> str:
    return "null" if v is None else "boolean" if isinstance(v, bool) else "number" if isinstance(v, int | float) else "string" if isinstance(v, str) else "object" if isinstance(v, dict) else "array"


def _at(v: object, path: str) -> object:
    for name in path.split("."):
        v = v.get(name) if isinstance(v, dict) else None
    return v


_BLANK = re.compile(r"[ \t\n\r]*")


def deep_value(text: str) -> object:
    """The JSON value of a text however deep it is nested: containers are kept on a stack, not in calls. Raises ValueError."""
    scalar = json.JSONDecoder().raw_decode
    holders: list[tuple[list | dict, str | None]] = []  # open containers, with the member awaiting its value
    at = _BLANK.match(text, 0).end()
    while True:
        # a value begins here
        sign = text[at : at + 1]
        if sign and sign in "[{":
            holders.append(([] if sign == "[" else {}, None))
            at = _BLANK.match(text, at + 1).end()
            closing = "]" if sign == "[" else "}"
            if text[at : at + 1] != closing:
                if sign == "{":
                    at = _member(text, at, holders, scalar)
                continue
            value, at = holders.pop()[0], at + 1
        else:
            value, at = scalar(text, at)
        # it is over: place it, and close what ends with it
        while True:
            at = _BLANK.match(text, at).end()
            if not holders:
                if at != len(text):
                    raise ValueError("text behind the value")
                return value
            holder, name = holders[-1]
            if isinstance(holder, dict):
                holder[name] = value
            else:
                holder.append(value)
            sign = text[at : at + 1]
            at = _BLANK.match(text, at + 1).end()
            if sign == ",":
                if isinstance(holder, dict):
                    at = _member(text, at, holders, scalar)
                break
            if sign != ("}" if isinstance(holder, dict) else "]"):
                raise ValueError("a container isn't closed")
            value = holders.pop()[0]


def _member(text: str, at: int, holders: list, scalar: Callable[[str, int], tuple[object, int]]) -> int:
    """Reads a member's name and colon; where its value begins."""
    if text[at : at + 1] != '"':
        raise ValueError("no member name")
    name, at = scalar(text, at)
    at = _BLANK.match(text, at).end()
    if text[at : at + 1] != ":":
        raise ValueError("no colon")
    holders[-1] = holders[-1][0], name
    return _BLANK.match(text, at + 1).end()


def record_nodes(text: str | None, lists: Collection[str] = (), skip: Collection[str] = (), prefer: Collection[tuple[str, str]] = ()) -> list[tuple]:
    """Nodes of one JSON object in document order, the root first; none if the text isn't exactly one JSON object.

    ``lists``: member names whose value counts as a list even if it is a single object. ``skip``: names of members whose
    subtrees are left out. ``prefer``: (dotted path, member) pairs; where an object has something at the path, its member
    of that name is left out. Iterative, so that any depth is read.
    """
    try:
        try:
            root = json.loads(text) if text else None
        except RecursionError:
            root = deep_value(text)
    except ValueError:
        return []
    if not isinstance(root, dict):
        return []
    out: list[tuple] = []
    stack: list[tuple[object, tuple, tuple]] = [(root, (), ("$",))]
    while stack:
        v, label, steps = stack.pop()
        below: list[tuple[object, tuple, tuple]] = []
        if isinstance(v, dict):
            # an object carries its own scalars; its objects and lists become nodes
            beaten = {loser for winner, loser in prefer if loser in v and _at(v, winner) is not None}
            members = [(k, _scalar(x)) for k, x in v.items() if not isinstance(x, dict | list) and k not in beaten]
            out.append((label, steps, "object", None, members))
            for i, (k, x) in enumerate(v.items(), 1):
                if k in skip or k in beaten:
                    continue
                if isinstance(x, dict) and k in lists:
                    below.append((x, (*label, i, 1), (*steps, k, "[]")))
                elif isinstance(x, dict | list):
                    below.append((x, (*label, i), (*steps, k)))
        elif isinstance(v, list):
            out.append((label, steps, "array", None, []))
            below = [(x, (*label, i), (*steps, "[]")) for i, x in enumerate(v, 1) if x is not None]
        else:
            out.append((label, steps, _kind(v), _scalar(v), []))
        stack.extend(reversed(below))
    return out


def _shredder(lists: Collection[str], skip: Collection[str], prefer: Collection[tuple[str, str]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 256):  # bounds the nodes held at once by 256 records
                part = b.slice(start, 256)
                keys, nodes = [], []
                for key, text in zip(part.column(0), part.column(1).to_pylist()):
                    for label, steps, kind, value, members in record_nodes(text, lists, skip, prefer):
                        keys.append(key)
                        nodes.append(
                            {
                                "label": label,
                                "steps": steps,
                                "schema_path": ".".join(steps).replace(".[]", "[]"),
                                "kind": kind,
                                "value": value,
                                "members": members,
                            }
                        )
                if keys:
                    s = pa.array(nodes, _NODE)
                    key_column = pa.array([k.as_py() for k in keys], part.schema.field(0).type)
                    yield pa.RecordBatch.from_arrays([key_column, *s.flatten()], names=["key", *[f.name for f in _NODE]])

    return run


def dewey_nodes(
    df: DataFrame, key: str, record: str, lists: Collection[str] = (), skip: Collection[str] = (), prefer: Collection[tuple[str, str]] = ()
) -> DataFrame:
    """``key`` and :data:`NODE_FIELDS` of every object, list and list entry of the JSON text in ``record``.

    A null, blank, broken or cut text, or one that isn't an object, gives no rows. Null entries of lists give no row but
    keep their ordinal. Of members that a text names twice the last holds. Equal rows of ``df`` give equal nodes; other
    columns of ``df`` aren't read, so clashing names don't matter.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{record}`").cast("string").alias("record"))
    return rows.mapInArrow(_shredder(frozenset(lists), frozenset(skip), tuple(prefer)), f"key {kind}, {NODE_FIELDS}")


def parent_label(label: Column | str) -> Column:
    """A node's parent by truncation."""
    label = F.col(label) if isinstance(label, str) else label
    return F.slice(label, 1, F.greatest(F.size(label) - 1, F.lit(0)))


def list_ordinals(last: int = 0) -> Column:
    """The label's ordinals of list entries alone, without the last ``last`` of them."""
    # label[i] belongs to steps[i+1], as steps begin with the root
    pairs = F.arrays_zip(F.col("label").alias("o"), F.slice("steps", 2, F.size("label") + 1).alias("s"))
    kept = F.transform(F.filter(pairs, lambda p: p["s"] == "[]"), lambda p: p["o"].cast("string"))
    return F.slice(kept, 1, F.size(kept) - last) if last else kept


#: Members of an artifact that are lists even where one object stands in place of the list, and members that are never entities.
ARTIFACT_LISTS = ("pages", "blocks", "rows")
ARTIFACT_SKIP = ("layers", "bbox", "signals", "text_provenance", "polygon", "evidence", "evidence_layers")
ARTIFACT_PREFER = (("authoritative", "blocks"), ("routing.structure_gate", "structure_gate"))
_ON, _OFF = ("true", "yes", "on", "1", "1.0", "enabled", "y", "t"), ("false", "no", "off", "0", "0.0", "disabled", "n", "f")
_BLOCKS = r"^\$(\.result)?\.pages\[\](\.authoritative)?(\.blocks\[\])+$"
_CELL = r"^\$(\.result)?\.pages\[\](\.authoritative)?(\.blocks\[\])+\.table\.rows\[\]\[\]$"
_PAGE = r"^\$(\.result)?\.pages\[\]$"
_GATE = r"^\$(\.result)?\.pages\[\](\.routing)?\.structure_gate$"


def artifact_nodes(df: DataFrame, key: str = "artifact_id", record: str = "artifact_json") -> DataFrame:
    return dewey_nodes(df, key, record, ARTIFACT_LISTS, ARTIFACT_SKIP, ARTIFACT_PREFER)


def artifact_entities(df: DataFrame, key: str = "artifact_id", record: str = "artifact_json") -> DataFrame:
    """Flat rows of an artifact's pages, blocks, cells and gates, each with its own and its parent's path.

    Columns: key, entity (page, block, cell, gate_on, gate_off), entity_path, parent_path, label, parent_label, members
    (the object's own scalar members). A page's blocks are those of its authoritative result; only where a page has none
    (older writers) those directly on the page. A gate in the routing goes before one on the page. See ``dewey_nodes``
    for nulls, broken texts, repeated rows and clashing columns.
    """
    nodes = artifact_nodes(df, key, record)
    page = F.col("schema_path").rlike(_PAGE) & (F.col("kind") == "object")
    block = F.col("schema_path").rlike(_BLOCKS) & (F.col("kind") == "object")
    cell = F.col("schema_path").rlike(_CELL) & (F.col("kind") == "object")
    gate = F.col("schema_path").rlike(_GATE) & (F.col("kind") == "object")
    own = F.array_join(list_ordinals(), "/")
    row_and_column = F.concat(F.lit("/r"), F.element_at(list_ordinals(), -2), F.lit("c"), F.element_at(list_ordinals(), -1))
    up2, up1 = F.array_join(list_ordinals(2), "/"), F.array_join(list_ordinals(1), "/")

    def state(word: Column) -> Column:
        word = F.lower(F.trim(word))
        return F.when(word.isin(*_ON), "gate_on").when(word.isin(*_OFF), "gate_off")

    # a gate that is itself a truth value is a scalar member of its page or of the page's routing
    routing = F.col("schema_path").rlike(r"^\$(\.result)?\.pages\[\]\.routing$") & (F.col("kind") == "object")
    member_gate = F.when(page | routing, state(F.when(F.element_at("members", "structure_gate").isin("true", "false"), F.element_at("members", "structure_gate"))))
    rows = (
        nodes.select(
            "key", "label", "members", "schema_path",
            F.array_compact(
                F.array(
                    F.when(page, F.struct(F.lit("page").alias("entity"), own.alias("path"), F.lit("").alias("parent"))),
                    F.when(block, F.struct(F.lit("block").alias("entity"), own.alias("path"), up1.alias("parent"))),
                    F.when(cell, F.struct(F.lit("cell").alias("entity"), F.concat(up2, row_and_column).alias("path"), up2.alias("parent"))),
                    F.when(gate, F.struct(state(F.element_at("members", "enabled")).alias("entity"), F.concat(own, F.lit("/gate")).alias("path"), own.alias("parent"))),
                    F.when(member_gate.isNotNull(), F.struct(member_gate.alias("entity"), F.concat(own, F.lit("/gate")).alias("path"), own.alias("parent"))),
                )
            ).alias("found"),
        )
        .select("*", F.explode("found").alias("f"))
        .filter("f.entity IS NOT NULL")
    )
    return rows.select(
        F.col("key").alias(key),
        F.col("f.entity").alias("entity"),
        F.col("f.path").alias("entity_path"),
        F.col("f.parent").alias("parent_path"),
        "label",
        parent_label("label").alias("parent_label"),
        "members",
        "schema_path",
    )


def artifact_tables(df: DataFrame, key: str = "artifact_id", record: str = "artifact_json") -> dict[str, DataFrame]:
    """The flat tables ``pages``, ``blocks``, ``cells`` and ``gates``, each row with its own and its parent's path.

    Every record is parsed once for all four; members that the record lacks are null, a missing span is 1.
    """
    rows = settled(artifact_entities(df, key, record).select(key, "entity", "entity_path", "parent_path", "members"), "entities")
    m = lambda name, kind="string": F.element_at("members", name).try_cast(kind)
    columns = {
        "pages": [m("page", "int").alias("page"), m("engine").alias("engine"), m("outcome").alias("outcome")],
        "blocks": [m("type").alias("block_type"), m("text").alias("text"), m("reading_order", "int").alias("reading_order"), m("confidence", "double").alias("confidence")],
        "cells": [m("text").alias("text"), m("is_header", "boolean").alias("is_header"), F.coalesce(m("rowspan", "int"), F.lit(1)).alias("rowspan"), F.coalesce(m("colspan", "int"), F.lit(1)).alias("colspan")],
        "gates": [(F.col("entity") == "gate_on").alias("enabled")],
    }
    return {name: rows.filter(F.col("entity").startswith(name[:-1])).select(key, "entity_path", "parent_path", *own) for name, own in columns.items()}
