"""DataFrame to DataFrame operators."""

from tremorlane.operators.arrivals import backfill_union, first_seen, gate_open
from tremorlane.operators.clean import (
    clean_events,
    drop_incomplete,
    drop_null_island,
    require_id,
    within_box,
)
from tremorlane.operators.clustering import (
    ClusterModel,
    cluster_events,
    cluster_quality,
    fit_clusters,
    fit_scaler,
    standardize,
    with_nearest,
)
from tremorlane.operators.enrich import enrich
from tremorlane.operators.flatten import flatten_events
from tremorlane.operators.recent import archive_window, live_window, newest
from tremorlane.operators.summary import (
    cluster_sizes,
    magnitude_histogram,
    map_points,
    row_count,
    severity_counts,
    value_counts,
)

__all__ = [
    "ClusterModel",
    "archive_window",
    "backfill_union",
    "clean_events",
    "cluster_events",
    "cluster_quality",
    "cluster_sizes",
    "drop_incomplete",
    "drop_null_island",
    "enrich",
    "first_seen",
    "fit_clusters",
    "fit_scaler",
    "flatten_events",
    "gate_open",
    "live_window",
    "magnitude_histogram",
    "map_points",
    "newest",
    "require_id",
    "row_count",
    "severity_counts",
    "standardize",
    "value_counts",
    "with_nearest",
    "within_box",
]
