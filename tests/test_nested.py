import json

import pyarrow.parquet as pq

from conftest import DATA
from quirewright.operators.nested import artifact_entities, dewey_nodes

ON, OFF = {"true", "1", "yes", "on"}, {"false", "0", "no", "off"}


def listed(x):
    return x if isinstance(x, list) else [x] if isinstance(x, dict) else []


def brute(key, text):
    try:
        o = json.loads(text)
    except (ValueError, TypeError):
        return
    if not isinstance(o, dict):
        return
    o = o if "pages" in o else o.get("result") or {}

    def blocks(xs, at):
        for i, b in enumerate(listed(xs), 1):
            if isinstance(b, dict):
                yield key, "block", f"{at}/{i}", at
                for r, row in enumerate(listed((b.get("table") or {}).get("rows")), 1):
                    for c, cell in enumerate(row or [], 1):
                        if isinstance(cell, dict):
                            yield key, "cell", f"{at}/{i}/r{r}c{c}", f"{at}/{i}"
                yield from blocks(b.get("blocks"), f"{at}/{i}")

    for n, p in enumerate(listed(o.get("pages")), 1):
        if isinstance(p, dict):
            yield key, "page", str(n), ""
            yield from blocks((p["authoritative"] if p.get("authoritative") is not None else p).get("blocks"), str(n))
            g = (p.get("routing") or {}).get("structure_gate")
            g = p.get("structure_gate") if g is None else g
            e = g.get("enabled") if isinstance(g, dict) else g if isinstance(g, bool) else None
            e = str(e).strip().lower()
            if e in ON | OFF:
                yield key, "gate_on" if e in ON else "gate_off", f"{n}/gate", str(n)


def test_entities_against_brute_force(spark):
    rows = pq.read_table(f"{DATA}/sf0.1/rich_artifacts.parquet", columns=["artifact_id", "artifact_json"]).to_pylist()
    want = sorted(x for r in rows for x in brute(r["artifact_id"], r["artifact_json"]))
    df = spark.read.parquet(f"{DATA}/sf0.1/rich_artifacts.parquet")
    got = sorted(tuple(r) for r in artifact_entities(df).select("artifact_id", "entity", "entity_path", "parent_path").collect())
    assert len(got) > 5000 and got == want


def test_odd_records(spark):
    rows = [
        (1, None, "a"), (2, "", "a"), (3, "  ", "a"), (4, "[1]", "a"), (5, '{"pages": [1', "a"), (6, '{"pages": {"blocks": {"blocks": [null, {}]}}}', "a"),
        (6, '{"pages": {"blocks": {"blocks": [null, {}]}}}', "a"), (7, '{"result": {"pages": [null, {"structure_gate": true}]}} ', "b"), (8, '{"pages": []} x', "b"),
        (9, '{"pages": [{"routing": {"structure_gate": {"enabled": "OFF"}}, "structure_gate": true, "authoritative": {"blocks": null}, "blocks": [{}]}]}', "c"),
        (10, '{"a":' * 5000 + "1" + "}" * 5000, "deep"), (11, json.dumps({"pages": [{"authoritative": {"blocks": [{"text": "x" * 300_000}]}}]}), "long"),
    ]
    df = spark.createDataFrame(rows, "artifact_id bigint, artifact_json string, label string")
    got = sorted((r.artifact_id, r.entity, r.entity_path, r.parent_path) for r in artifact_entities(df).collect())
    six = [(6, "block", "1/1", "1"), (6, "block", "1/1/2", "1/1"), (6, "page", "1", "")]
    assert got == sorted(six * 2 + [(7, "gate_on", "2/gate", "2"), (7, "page", "2", ""), (9, "gate_off", "1/gate", "1"), (9, "page", "1", ""), (11, "block", "1/1", "1"), (11, "page", "1", "")])
    assert artifact_entities(df.limit(0)).count() == 0


def test_parent_is_truncation(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": [{"c": 1}, 5, null, "x"]}, "d": {}}')], "k int, j string")
    nodes = {tuple(r.label): r for r in dewey_nodes(df, "k", "j").collect()}
    assert nodes[(1, 1, 1)].schema_path == "$.a.b[]" and nodes[(1, 1, 1)].members == {"c": "1"}
    assert nodes[(1, 1, 2)].value == "5" and nodes[(1, 1, 4)].value == "x" and (1, 1, 3) not in nodes
    assert all(label[:-1] in nodes for label in nodes if label)


def test_any_depth():
    from quirewright.operators.nested import deep_value, record_nodes

    deep = '{"pages": [{"blocks": ' * 3_000 + "[]" + "}]}" * 3_000
    assert len(record_nodes(deep)) > 6_000
    value, depth = deep_value("[" * 50_000 + "]" * 50_000), 0
    while value:
        value, depth = value.pop(), depth + 1
    assert depth == 49_999
    for text in ('{"a": [1, {"b": null}, "x\\"]"], "c": {}, "d": []}', "[[], [1, 2.5e3, true]]", ' "x" ', '{"a": 1, "a": {"b": [ ]}}'):
        assert deep_value(text) == json.loads(text)
    for text in ("", "[1", "[1,]", '{"a" 1}', '{"a": 1,}', "{} x", "[}", '{1: 2}', "nul"):
        try:
            deep_value(text)
        except ValueError:
            continue
        raise AssertionError(text)
