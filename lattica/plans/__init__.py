"""Queries over the driver tables: ``QUERIES`` by name, and their SQL in ``SQL``."""

from __future__ import annotations

from . import assembly_queries, canonical_queries, column_queries, corridor_queries, geo_queries, identity_queries, lock_queries, model_queries, observation_queries, payload_queries, publication_queries, rail_queries, ranking_queries, surface_queries  # noqa: F401
from .carriers import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
