"""Event-time quality, scoring and drift analytics as plain Spark jobs.

Operators take DataFrames and return DataFrames; the streaming package binds
them to sources, sinks and checkpoints.
"""

from tidemark.functions.columns import label, mean_ci_bounds, psi_term, verdict, zorder_key
from tidemark.operators.clustering import (
    assign,
    feature_moments,
    lloyd,
    standardise,
    train_trip_model,
    train_zone_model,
    trip_features,
    zone_features,
)
from tidemark.operators.drift import drift_onset, drift_baseline, psi, retrain_signal, share_by_batch, streaks
from tidemark.operators.joins import enrich
from tidemark.operators.kpi import component_rates, mean_ci, window_kpi, window_summary
from tidemark.operators.quality import flag, quality_summary, reference_stats, repair, route, taxi_rules, z_score
from tidemark.operators.schema import schema_diff
from tidemark.operators.scoring import cluster_profile, derive_labels, score_by_lookup
from tidemark.plans.layout import compact, file_stats, layer_of, write_lookup_layer, zorder_rewrite
from tidemark.sources.files import ingest, pinned_schema, read_csv_dimension, stream_dir, stream_table
from tidemark.sources.rescue import rescue, rescue_json, rescue_variant
from tidemark.streaming.stages import Stage, run_continuously, run_stage, run_stages, start_stage, stop_started

__all__ = [
    "Stage", "assign", "cluster_profile", "compact", "component_rates", "derive_labels", "drift_baseline", "drift_onset",
    "enrich", "feature_moments", "file_stats", "flag", "ingest", "label", "layer_of", "lloyd", "mean_ci",
    "mean_ci_bounds", "pinned_schema", "psi", "psi_term", "quality_summary", "read_csv_dimension",
    "reference_stats", "repair", "rescue", "rescue_json", "rescue_variant", "retrain_signal", "route",
    "run_continuously", "run_stage", "run_stages",
    "schema_diff", "score_by_lookup", "share_by_batch", "standardise", "start_stage",
    "stop_started", "stream_dir", "stream_table", "streaks", "taxi_rules", "train_trip_model",
    "train_zone_model", "trip_features", "verdict", "window_kpi", "window_summary", "write_lookup_layer", "z_score",
    "zone_features", "zorder_key", "zorder_rewrite",
]
