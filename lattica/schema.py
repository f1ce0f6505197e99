"""Statuses, allowed sets and the canonical relations as Spark schemas."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

#: The thirteen statuses of an observation, by what they say of the value.
NUMERIC = ("observed", "observed_zero")
VALUED = (*NUMERIC, "imputed", "aggregation_destination")
VALUELESS = ("suppressed", "not_public", "not_surveyed", "not_applicable", "source_absent", "duplicate_on_other_record", "station_absent", "outside_scope")
STATUSES = (*VALUED, *VALUELESS, "invalid")

#: Enumerations of the canonical relations.
ENUMS = {
    "run_status": ("candidate", "accepted", "rejected"),
    "line_kind": ("infrastructure", "service_corridor", "analysis_corridor"),
    "lifecycle_status": ("active", "closed", "planned", "unknown"),
    "station_kind": ("surface", "underground", "mixed", "unknown"),
    "group_rule": ("source_seed", "same_facility", "manual_adjudication"),
    "group_review": ("candidate", "confirmed", "rejected", "deprecated"),
    "transfer_basis": ("official", "paid_area", "signed_walk", "manual"),
    "center_level": ("parent", "center", "subarea"),
    "identity_status": ("candidate", "confirmed", "retired"),
    "relation_type": ("split_into", "merged_into", "superseded_by", "reidentified_as"),
    "role": ("core", "auxiliary", "edge", "transfer_only", "multi_entry"),
    "alias_entity": ("station", "station_group", "hub", "line", "center"),
    "match_method": ("exact_source_seed", "crosswalk", "spatial_name", "manual"),
    "alias_review": ("candidate", "confirmed", "rejected"),
    "issue_type": ("no_match", "ambiguous_match", "collision", "split_candidate", "merge_candidate"),
    "queue_status": ("open", "resolved", "wont_fix"),
    "value_type": ("count", "ratio", "currency", "area", "distance", "score", "category"),
    "score_domain": ("core_scale", "access", "type", "confidence", "validation", "none"),
    "operation": ("insert", "replace", "retire", "link", "unlink"),
    "split": ("calibration", "holdout"),
    "golden_status": ("candidate", "adjudicated", "retired"),
}

#: Prefix of each kind's opaque identity.
ID_PREFIX = {"line": "lin_", "station": "sta_", "station_group": "stg_", "hub": "hub_", "alias": "als_", "review": "idr_", "center": "ctr_", "official_route": "rte_"}

OBSERVATION = T.StructType([
    T.StructField("raw", T.StringType()),
    T.StructField("value", T.DecimalType(38, 6)),
    T.StructField("status", T.StringType(), False),
])


def fields(spec: str) -> T.StructType:
    """``"a string!, b int"``: a ``!`` marks a required column."""
    out = T.StructType()
    for part in spec.split(","):
        name, kind = part.split()
        out.add(name, _kind(kind.rstrip("!")), not kind.endswith("!"))
    return out


def _kind(name: str) -> T.DataType:
    return {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "binary": T.BinaryType(), "byte": T.ByteType()}[name]


@dataclass(frozen=True)
class Relation:
    """A canonical relation and what its rows must satisfy.

    ``like``: patterns; ``one_of``: enumerations by name; ``sizes``: lengths;
    ``least``: lower bounds; ``shares``: columns from 0 to 1; ``flags``: 0 or 1;
    ``rules``: named predicates.  A predicate that is null holds, as in SQL.
    """

    columns: T.StructType
    key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    refers: Mapping[str, str] = field(default_factory=dict)
    like: Mapping[str, str] = field(default_factory=dict)
    one_of: Mapping[str, str] = field(default_factory=dict)
    sizes: Mapping[str, int] = field(default_factory=dict)
    least: Mapping[str, int] = field(default_factory=dict)
    shares: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    rules: Mapping[str, str] = field(default_factory=dict)


def _quoted(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


#: An observation's value must be there, be positive, be zero or be absent, as its status says.
STATUS_VALUE = f"""CASE WHEN observation_status = '{NUMERIC[0]}' THEN coalesce(numeric_value > 0, false)
  WHEN observation_status = '{NUMERIC[1]}' THEN coalesce(numeric_value = 0, false)
  WHEN observation_status IN ({_quoted(VALUED)}) THEN numeric_value IS NOT NULL ELSE numeric_value IS NULL END"""

#: The canonical relations, their columns and constraints.
RELATIONS = {
    "source_release": Relation(
        fields("source_release_id string!, source_id string!, release_label string!, reference_start string, reference_end string, survey_date string, published_at string, retrieved_at string!, source_url string!, byte_size long!, sha256 string!, license_id string!, correction_note string"),
        ("source_release_id",), (("source_id", "sha256"),), sizes={"sha256": 64}, least={"byte_size": 0},
    ),
    "model_run": Relation(
        fields("model_run_id string!, model_version string!, parameter_set_sha256 string!, source_bundle_sha256 string!, created_at string!, run_status string!"),
        ("model_run_id",), like={"model_run_id": "run_%"}, one_of={"run_status": "run_status"}, sizes={"parameter_set_sha256": 64, "source_bundle_sha256": 64},
    ),
    "line": Relation(
        fields("line_id string!, display_name_ja string!, operator_id string, line_kind string!, lifecycle_status string!, valid_from string, valid_to string, created_at string!"),
        ("line_id",), like={"line_id": "lin_%"}, one_of={"line_kind": "line_kind", "lifecycle_status": "lifecycle_status"},
    ),
    "station": Relation(
        fields("station_id string!, display_name_ja string!, operator_id string, station_kind string!, lifecycle_status string!, valid_from string, valid_to string, centroid_wkb binary, geometry_crs string, created_at string!"),
        ("station_id",), like={"station_id": "sta_%"}, one_of={"station_kind": "station_kind", "lifecycle_status": "lifecycle_status"},
    ),
    "station_line_membership": Relation(
        fields("station_id string!, line_id string!, sequence_index int, distance_from_origin_km double, valid_from string, valid_to string"),
        ("station_id", "line_id", "valid_from"), refers={"station_id": "station", "line_id": "line"}, least={"distance_from_origin_km": 0},
    ),
    "station_group": Relation(
        fields("station_group_id string!, display_name_ja string!, group_rule string!, review_status string!, created_at string!"),
        ("station_group_id",), like={"station_group_id": "stg_%"}, one_of={"group_rule": "group_rule", "review_status": "group_review"},
    ),
    "station_group_member": Relation(
        fields("station_group_id string!, station_id string!, membership_basis string!, confidence double, reviewed_by string, reviewed_at string"),
        ("station_group_id", "station_id"), refers={"station_group_id": "station_group", "station_id": "station"}, shares=("confidence",),
    ),
    "hub": Relation(
        fields("hub_id string!, display_name_ja string!, transfer_basis string!, review_status string!, created_at string!"),
        ("hub_id",), like={"hub_id": "hub_%"}, one_of={"transfer_basis": "transfer_basis", "review_status": "group_review"},
    ),
    "hub_station_group_link": Relation(
        fields("hub_id string!, station_group_id string!, walking_distance_m double, evidence_json string!, is_manual int!"),
        ("hub_id", "station_group_id"), refers={"hub_id": "hub", "station_group_id": "station_group"}, least={"walking_distance_m": 0}, flags=("is_manual",),
    ),
    "center": Relation(
        fields("center_id string!, display_name_ja string!, parent_center_id string, center_level string!, identity_status string!, created_at string!, retired_at string"),
        ("center_id",), refers={"parent_center_id": "center"}, like={"center_id": "ctr_%"}, one_of={"center_level": "center_level", "identity_status": "identity_status"},
        rules={"not_its_own_parent": "parent_center_id <> center_id"},
    ),
    "center_version": Relation(
        fields("center_id string!, model_run_id string!, polygon_wkb binary, centroid_wkb binary, geometry_crs string!, boundary_method string!, boundary_confidence double, manual_override_id string, geometry_sha256 string"),
        ("center_id", "model_run_id"), refers={"center_id": "center", "model_run_id": "model_run"}, sizes={"geometry_sha256": 64}, shares=("boundary_confidence",),
    ),
    "center_lineage": Relation(
        fields("predecessor_center_id string!, successor_center_id string!, relation_type string!, effective_model_run_id string!, rationale string!"),
        ("predecessor_center_id", "successor_center_id", "effective_model_run_id"),
        refers={"predecessor_center_id": "center", "successor_center_id": "center", "effective_model_run_id": "model_run"}, one_of={"relation_type": "relation_type"},
        rules={"not_its_own_successor": "predecessor_center_id <> successor_center_id"},
    ),
    "station_center_link": Relation(
        fields("station_center_link_id string!, station_group_id string!, center_id string!, model_run_id string!, role string!, link_confidence double, evidence_json string!, is_manual int!"),
        ("station_center_link_id",), (("station_group_id", "center_id", "model_run_id", "role"),),
        refers={"station_group_id": "station_group", "center_id": "center", "model_run_id": "model_run"}, like={"station_center_link_id": "scl_%"}, one_of={"role": "role"}, shares=("link_confidence",), flags=("is_manual",),
    ),
    "line_center_link": Relation(
        fields("line_center_link_id string!, line_id string!, center_id string!, model_run_id string!, first_sequence int, last_sequence int, linked_station_group_count int!, distance_along_line_km double, link_confidence double"),
        ("line_center_link_id",), (("line_id", "center_id", "model_run_id"),),
        refers={"line_id": "line", "center_id": "center", "model_run_id": "model_run"}, like={"line_center_link_id": "lcl_%"},
        least={"linked_station_group_count": 1, "distance_along_line_km": 0}, shares=("link_confidence",), rules={"first_before_last": "first_sequence <= last_sequence"},
    ),
    "entity_alias": Relation(
        fields("entity_alias_id string!, entity_type string!, entity_id string!, source_release_id string!, source_namespace string!, source_key string!, source_name string, valid_from string, valid_to string, match_method string!, match_confidence double, review_status string!"),
        ("entity_alias_id",), (("source_release_id", "source_namespace", "source_key", "entity_type"),), refers={"source_release_id": "source_release"},
        like={"entity_alias_id": "als_%"}, one_of={"entity_type": "alias_entity", "match_method": "match_method", "review_status": "alias_review"}, shares=("match_confidence",),
    ),
    "identity_review_queue": Relation(
        fields("review_id string!, entity_type string!, source_release_id string!, source_key string!, issue_type string!, candidate_entity_ids_json string!, status string!, resolution_note string, resolved_at string"),
        ("review_id",), refers={"source_release_id": "source_release"}, like={"review_id": "idr_%"}, one_of={"issue_type": "issue_type", "status": "queue_status"},
    ),
    "metric_definition": Relation(
        fields("metric_code string!, display_name_ja string!, unit string!, value_type string!, allowed_score_domain string!, definition_version string!"),
        ("metric_code",), one_of={"value_type": "value_type", "allowed_score_domain": "score_domain"},
    ),
    "feature_observation": Relation(
        fields("observation_id string!, entity_type string!, entity_id string!, metric_code string!, numeric_value double, raw_value string, observation_status string!, unit string!, source_release_id string!, source_record_key string!, reference_start string, reference_end string, published_at string, retrieved_at string!, provenance_json string!"),
        ("observation_id",), (("entity_type", "entity_id", "metric_code", "source_release_id", "source_record_key"),),
        refers={"metric_code": "metric_definition", "source_release_id": "source_release"}, like={"observation_id": "obs_%"},
        rules={"known_status": f"observation_status IN ({_quoted((*VALUED, *VALUELESS))})", "status_fits_value": STATUS_VALUE},
    ),
    "manual_override": Relation(
        fields("manual_override_id string!, target_table string!, target_key string!, operation string!, patch_json string!, reason string!, evidence_urls_json string!, author string!, created_at string!, supersedes_override_id string"),
        ("manual_override_id",), refers={"supersedes_override_id": "manual_override"}, like={"manual_override_id": "ovr_%"}, one_of={"operation": "operation"},
    ),
    "golden_eval": Relation(
        fields("golden_eval_id string!, registry_version string!, display_name_ja string!, split string!, expected_constraints_json string!, status string!"),
        ("golden_eval_id",), like={"golden_eval_id": "GE%"}, one_of={"split": "split", "status": "golden_status"},
    ),
}
