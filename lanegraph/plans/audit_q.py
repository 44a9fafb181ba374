"""Registered queries: data audit / profiling."""

from __future__ import annotations

from ..operators import audit as AU
from .registry import finish, legs, query

for _name in ["graph_feasibility", "corridor_frequency", "route_type_per_corridor", "trip_structure",
              "schedule_structure", "temporal_profile", "target_percentiles", "actual_vs_planned",
              "target_correlation", "state_profile", "factor_profile", "cutoff_profile", "profile_missing",
              "quality_summary", "profile_columns", "profile_types", "profile_top_values", "trip_size_distribution",
              "temporal_range", "top_states"]:
    def _q(spark, sf_dir, _fn=getattr(AU, _name)):
        return finish(_fn(legs(spark, sf_dir)))
    query(_name)(_q)
