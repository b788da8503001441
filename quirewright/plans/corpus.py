"""Queries of the general corpus problems: repeated messages (4) and nested records (5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quirewright.operators.deliveries import exactly_once, repeated_deliveries
from quirewright.operators.nested import artifact_entities, artifact_tables
from quirewright.plans.tables import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_deliveries(table(spark, sf_dir, "pages"))


def p4_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactly_once(table(spark, sf_dir, "pages")).select("delivery_id", "message_id", "batch_id", "page", "status")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifact_entities(table(spark, sf_dir, "rich_artifacts")).select("artifact_id", "entity", "entity_path", "parent_path")


def p5_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifact_tables(table(spark, sf_dir, "rich_artifacts"))["pages"]


def p5_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifact_tables(table(spark, sf_dir, "rich_artifacts"))["blocks"]


def p5_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifact_tables(table(spark, sf_dir, "rich_artifacts"))["cells"]


def p5_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifact_tables(table(spark, sf_dir, "rich_artifacts"))["gates"]


_RANKED = r"""
SELECT *, row_number() OVER (PARTITION BY m ORDER BY delivered_at NULLS LAST, delivery_id) AS n
FROM (SELECT *, nullif(lower(regexp_replace(message_id, '^\s+|\s+$', '', 'g')), '') AS m FROM pages)
"""

def _listed(j: str, path: str) -> str:
    """A JSON value as a list: an object stands for a list of one."""
    return f"CASE json_type({j}, '{path}') WHEN 'ARRAY' THEN json_extract({j}, '{path}[*]') WHEN 'OBJECT' THEN [json_extract({j}, '{path}')] ELSE [] END"


_ARTIFACTS = f"""
WITH RECURSIVE a AS (
    SELECT artifact_id, CASE WHEN json_exists(j, '$.pages') THEN j ELSE json_extract(j, '$.result') END AS j
    FROM (SELECT artifact_id, CASE WHEN json_valid(artifact_json) THEN CAST(artifact_json AS JSON) END AS j FROM rich_artifacts) WHERE json_type(j) = 'OBJECT'),
p AS (SELECT * FROM (SELECT artifact_id, unnest(l) AS p, generate_subscripts(l, 1) AS n FROM (SELECT artifact_id, {_listed("j", "$.pages")} AS l FROM a)) WHERE json_type(p) = 'OBJECT'),
b AS (
    SELECT artifact_id, 0 AS depth, '' AS parent, CAST(n AS VARCHAR) AS path, CASE WHEN coalesce(json_type(p, '$.authoritative'), 'NULL') <> 'NULL' THEN json_extract(p, '$.authoritative') ELSE p END AS x FROM p
    UNION ALL
    SELECT artifact_id, depth + 1, path, path || '/' || k, x FROM (
        SELECT artifact_id, depth, path, unnest(l) AS x, generate_subscripts(l, 1) AS k FROM (SELECT artifact_id, depth, path, {_listed("x", "$.blocks")} AS l FROM b)) WHERE json_type(x) = 'OBJECT'),
r AS (SELECT artifact_id, path, unnest(l) AS y, generate_subscripts(l, 1) AS k FROM (SELECT artifact_id, path, {_listed("x", "$.table.rows")} AS l FROM b WHERE depth > 0)),
c AS (SELECT artifact_id, path, k, unnest(l) AS z, generate_subscripts(l, 1) AS m FROM (SELECT artifact_id, path, k, json_extract(y, '$[*]') AS l FROM r WHERE json_type(y) = 'ARRAY')),
g AS (
    SELECT artifact_id, n, lower(trim(CASE json_type(g) WHEN 'OBJECT' THEN json_extract_string(g, '$.enabled') WHEN 'BOOLEAN' THEN CAST(g AS VARCHAR) END)) AS state FROM (
    SELECT artifact_id, n, CASE WHEN coalesce(json_type(p, '$.routing.structure_gate'), 'NULL') <> 'NULL' THEN json_extract(p, '$.routing.structure_gate') ELSE json_extract(p, '$.structure_gate') END AS g FROM p))
"""

QUERIES = {"p4_found": p4_found, "p4_kept": p4_kept, "p5_found": p5_found, "p5_pages": p5_pages, "p5_gates": p5_gates, "p5_blocks": p5_blocks, "p5_cells": p5_cells}
SQL = {
    "p4_found": f"SELECT delivery_id FROM ({_RANKED}) WHERE m IS NOT NULL AND n > 1",
    "p4_kept": f"SELECT delivery_id, message_id, batch_id, page, status FROM ({_RANKED}) WHERE m IS NULL OR n = 1",
    "p5_found": f"""{_ARTIFACTS} SELECT artifact_id, 'page' AS entity, CAST(n AS VARCHAR) AS entity_path, '' AS parent_path FROM p
        UNION ALL SELECT artifact_id, 'block', path, parent FROM b WHERE depth > 0
        UNION ALL SELECT artifact_id, 'cell', path || '/r' || k || 'c' || m, path FROM c WHERE json_type(z) = 'OBJECT'
        UNION ALL SELECT artifact_id, CASE WHEN state IN ('true', 'yes', 'on', '1', '1.0', 'enabled', 'y', 't') THEN 'gate_on' ELSE 'gate_off' END, n || '/gate', CAST(n AS VARCHAR) FROM g
        WHERE state IN ('true', 'yes', 'on', '1', '1.0', 'enabled', 'y', 't', 'false', 'no', 'off', '0', '0.0', 'disabled', 'n', 'f')""",
    "p5_pages": f"""{_ARTIFACTS} SELECT artifact_id, CAST(n AS VARCHAR) AS entity_path, '' AS parent_path, TRY_CAST(json_extract_string(p, '$.page') AS INT) AS page, json_extract_string(p, '$.engine') AS engine, json_extract_string(p, '$.outcome') AS outcome FROM p""",
    "p5_gates": f"""{_ARTIFACTS} SELECT artifact_id, n || '/gate' AS entity_path, CAST(n AS VARCHAR) AS parent_path, state IN ('true', 'yes', 'on', '1', '1.0', 'enabled', 'y', 't') AS enabled FROM g
        WHERE state IN ('true', 'yes', 'on', '1', '1.0', 'enabled', 'y', 't', 'false', 'no', 'off', '0', '0.0', 'disabled', 'n', 'f')""",
    "p5_blocks": f"""{_ARTIFACTS} SELECT artifact_id, path AS entity_path, parent AS parent_path, json_extract_string(x, '$.type') AS block_type, json_extract_string(x, '$.text') AS text,
        TRY_CAST(json_extract_string(x, '$.reading_order') AS INT) AS reading_order, TRY_CAST(json_extract_string(x, '$.confidence') AS DOUBLE) AS confidence FROM b WHERE depth > 0""",
    "p5_cells": f"""{_ARTIFACTS} SELECT artifact_id, path || '/r' || k || 'c' || m AS entity_path, path AS parent_path, json_extract_string(z, '$.text') AS text, TRY_CAST(json_extract_string(z, '$.is_header') AS BOOLEAN) AS is_header,
        coalesce(TRY_CAST(json_extract_string(z, '$.rowspan') AS INT), 1) AS rowspan, coalesce(TRY_CAST(json_extract_string(z, '$.colspan') AS INT), 1) AS colspan FROM c WHERE json_type(z) = 'OBJECT'""",
}
