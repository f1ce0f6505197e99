"""Canonical relations made from the driver tables, with faults of every kind, and what their constraints find."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.canonical import canonical_faults
from .carriers import query, read

#: Each relation's columns over a driver table, in expressions that Spark and DuckDB read alike.
MADE = {
    "source_release": ("supplier", {
        "source_release_id": "concat('rel_', s_suppkey)", "source_id": "concat('src_', s_nationkey)", "release_label": "'r'", "reference_start": "CAST(NULL AS STRING)", "reference_end": "CAST(NULL AS STRING)",
        "survey_date": "CAST(NULL AS STRING)", "published_at": "CAST(NULL AS STRING)", "retrieved_at": "CASE WHEN s_suppkey % 31 = 0 THEN NULL ELSE '2026-01-01' END", "source_url": "'https://example.org'",
        "byte_size": "CAST(floor(s_acctbal) AS BIGINT)", "sha256": "substr(concat(SHA(s_suppkey % 40), ''), 1, CASE WHEN s_suppkey % 17 = 0 THEN 63 ELSE 64 END)", "license_id": "'cc'", "correction_note": "CAST(NULL AS STRING)",
    }),
    "metric_definition": ("nation", {
        "metric_code": "concat('m_', n_nationkey)", "display_name_ja": "n_name", "unit": "'count'", "value_type": "CASE n_nationkey % 8 WHEN 0 THEN 'count' WHEN 1 THEN 'ratio' WHEN 2 THEN 'area' WHEN 3 THEN 'volume' ELSE 'score' END",
        "allowed_score_domain": "'none'", "definition_version": "'1'",
    }),
    "line": ("nation", {
        "line_id": "concat('lin_', n_nationkey)", "display_name_ja": "n_name", "operator_id": "CAST(NULL AS STRING)", "line_kind": "CASE n_nationkey % 4 WHEN 0 THEN 'tram' ELSE 'infrastructure' END", "lifecycle_status": "'active'",
        "valid_from": "CAST(NULL AS STRING)", "valid_to": "CAST(NULL AS STRING)", "created_at": "'2026'",
    }),
    "station": ("customer", {
        "station_id": "concat(CASE WHEN c_custkey % 83 = 0 THEN 'st_' ELSE 'sta_' END, c_custkey)", "display_name_ja": "CASE WHEN c_custkey % 61 = 0 THEN NULL ELSE c_name END", "operator_id": "CAST(NULL AS STRING)",
        "station_kind": "CASE c_custkey % 5 WHEN 0 THEN 'surface' WHEN 1 THEN 'underground' WHEN 2 THEN 'mixed' WHEN 3 THEN 'unknown' ELSE 'air' END", "lifecycle_status": "'active'", "valid_from": "CAST(NULL AS STRING)", "valid_to": "CAST(NULL AS STRING)",
        "centroid_wkb": "CAST(NULL AS BINARY)", "geometry_crs": "CAST(NULL AS STRING)", "created_at": "'2026'",
    }),
    "station_line_membership": ("orders", {
        "station_id": "concat('sta_', o_custkey)", "line_id": "concat('lin_', o_orderkey % 26)", "sequence_index": "CAST(o_orderkey % 9 AS INT)", "distance_from_origin_km": "CAST(o_orderkey % 11 - 1 AS DOUBLE)",
        "valid_from": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE substr(CAST(o_orderdate AS STRING), 1, 4) END", "valid_to": "CAST(NULL AS STRING)",
    }),
    "feature_observation": ("lineitem", {
        "observation_id": "concat(CASE WHEN l_partkey % 97 = 0 THEN 'ob_' ELSE 'obs_' END, l_orderkey, '_', l_linenumber)", "entity_type": "'mesh'", "entity_id": "CAST(l_partkey AS STRING)", "metric_code": "concat('m_', l_suppkey % 27)",
        "numeric_value": "CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN 0.0 ELSE CAST(l_quantity AS DOUBLE) END", "raw_value": "CAST(NULL AS STRING)",
        "observation_status": "CASE (l_orderkey + l_linenumber) % 14 WHEN 0 THEN 'observed' WHEN 1 THEN 'observed_zero' WHEN 2 THEN 'imputed' WHEN 3 THEN 'suppressed' WHEN 4 THEN 'aggregation_destination' WHEN 5 THEN 'not_public' WHEN 6 THEN 'not_surveyed' WHEN 7 THEN 'not_applicable' WHEN 8 THEN 'source_absent' WHEN 9 THEN 'duplicate_on_other_record' WHEN 10 THEN 'station_absent' WHEN 11 THEN 'outside_scope' WHEN 12 THEN 'invalid' ELSE 'guessed' END",
        "unit": "'count'", "source_release_id": "concat(CASE WHEN l_suppkey % 13 = 0 THEN 'rel_x' ELSE 'rel_' END, l_suppkey)", "source_record_key": "CAST(l_orderkey % 50 AS STRING)", "reference_start": "CAST(NULL AS STRING)", "reference_end": "CAST(NULL AS STRING)",
        "published_at": "CAST(NULL AS STRING)", "retrieved_at": "'2026'", "provenance_json": "CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE '{}' END",
    }),
}


def _relation_sql(name: str) -> str:
    source, columns = MADE[name]
    spelled = ", ".join(f"{e} AS {c}" for c, e in columns.items()).replace("AS STRING", "AS VARCHAR").replace("AS BINARY", "AS BLOB").replace("SHA(s_suppkey % 40)", "sha256(CAST(s_suppkey % 40 AS VARCHAR))")
    return f"{name} AS (SELECT {spelled} FROM {source})"


def _made(spark, d, name):
    source, columns = MADE[name]
    return read(spark, d, source).select(*[F.expr(e.replace("SHA(s_suppkey % 40)", "sha2(CAST(s_suppkey % 40 AS STRING), 256)")).alias(c) for c, e in columns.items()])


def _alone(relation: str, key: str, constraint: str, fault: str) -> str:
    return f"SELECT '{relation}' AS relation, '{constraint}' AS \"constraint\", {key} AS key, count(*) AS rows FROM {relation} WHERE {fault} GROUP BY ALL"


def _twice(relation: str, columns: list[str], key: str) -> str:
    return f"SELECT '{relation}', 'unique:{'+'.join(columns)}', {key}, count(*) FROM {relation} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in columns)} GROUP BY ALL HAVING count(*) > 1"


def _lost(relation: str, column: str, target: str, there: str) -> str:
    return f"SELECT '{relation}', 'refers:{column}', {column}, count(*) FROM {relation} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {there} FROM {target} WHERE {there} IS NOT NULL) GROUP BY ALL"


_OBS, _SLM, _STA, _REL = "feature_observation", "station_line_membership", "station", "source_release"
_VALUELESS = "('suppressed', 'not_public', 'not_surveyed', 'not_applicable', 'source_absent', 'duplicate_on_other_record', 'station_absent', 'outside_scope')"
_FITS = f"""(observation_status = 'observed' AND numeric_value IS NOT NULL AND numeric_value > 0) OR (observation_status = 'observed_zero' AND numeric_value IS NOT NULL AND numeric_value = 0)
  OR (observation_status IN ('imputed', 'aggregation_destination') AND numeric_value IS NOT NULL) OR (observation_status NOT IN ('observed', 'observed_zero', 'imputed', 'aggregation_destination') AND numeric_value IS NULL)"""
_PARTS = [
    _alone(_REL, "source_release_id", "required:retrieved_at", "retrieved_at IS NULL"), _alone(_REL, "source_release_id", "least:byte_size", "byte_size < 0"), _alone(_REL, "source_release_id", "length:sha256", "length(sha256) <> 64"),
    _twice(_REL, ["source_id", "sha256"], "CAST(to_json([source_id, sha256]) AS VARCHAR)"),
    _alone("metric_definition", "metric_code", "one_of:value_type", "value_type NOT IN ('count', 'ratio', 'currency', 'area', 'distance', 'score', 'category')"),
    _alone("line", "line_id", "one_of:line_kind", "line_kind NOT IN ('infrastructure', 'service_corridor', 'analysis_corridor')"),
    _alone(_STA, "station_id", "required:display_name_ja", "display_name_ja IS NULL"), _alone(_STA, "station_id", "like:station_id", "station_id NOT LIKE 'sta_%'"),
    _alone(_STA, "station_id", "one_of:station_kind", "station_kind NOT IN ('surface', 'underground', 'mixed', 'unknown')"),
    _alone(_SLM, "CAST(to_json([station_id, line_id, valid_from]) AS VARCHAR)", "least:distance_from_origin_km", "distance_from_origin_km < 0"),
    _twice(_SLM, ["station_id", "line_id", "valid_from"], "CAST(to_json([station_id, line_id, valid_from]) AS VARCHAR)"), _lost(_SLM, "station_id", _STA, "station_id"), _lost(_SLM, "line_id", "line", "line_id"),
    _alone(_OBS, "observation_id", "required:provenance_json", "provenance_json IS NULL"), _alone(_OBS, "observation_id", "like:observation_id", "observation_id NOT LIKE 'obs_%'"),
    _alone(_OBS, "observation_id", "rule:known_status", f"observation_status NOT IN ('observed', 'observed_zero', 'imputed', 'aggregation_destination') AND observation_status NOT IN {_VALUELESS}"),
    _alone(_OBS, "observation_id", "rule:status_fits_value", f"NOT ({_FITS})"),
    _twice(_OBS, ["observation_id"], "observation_id"), _twice(_OBS, ["entity_type", "entity_id", "metric_code", "source_release_id", "source_record_key"], "CAST(to_json([entity_type, entity_id, metric_code, source_release_id, source_record_key]) AS VARCHAR)"),
    _lost(_OBS, "metric_code", "metric_definition", "metric_code"), _lost(_OBS, "source_release_id", _REL, "source_release_id"),
]


@query(f"WITH {', '.join(map(_relation_sql, MADE))} {' UNION ALL '.join(_PARTS)}")
def canonical_violations(spark, d):
    return canonical_faults({name: _made(spark, d, name) for name in MADE})
