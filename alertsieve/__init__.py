"""alertsieve: filtering and classification of astronomical transient alerts on Spark.

Alerts are rows of a (batch or streaming) DataFrame: the newest measurement in a
``candidate`` struct, the packaged history in ``prv_candidates`` and upstream
scores as top-level columns. Every filter, light-curve operator and the
classifier are plain ``pyspark.sql.Column`` expressions, so Catalyst sees them,
prunes nested columns and pushes predicates into the parquet scan.
"""

__version__ = "0.1.0"

# Public API (lazy imports keep `import alertsieve` free of a Spark session).
__all__ = [
    "apply_filter", "register_filter", "register_pandas_filter", "with_flags", "classify", "with_class",
    "read_alerts", "write_alerts", "write_topics", "route_topics", "catalogue_flags",
    "early_kn_candidates", "rate_based_kn_candidates", "build_galaxy_catalogue", "read_catalogue",
    "topic_stream", "classify_stream",
]

_WHERE = {
    "apply_filter": "operators.filters", "register_filter": "operators.filters", "with_flags": "operators.filters",
    "register_pandas_filter": "operators.user_filters",
    "classify": "operators.classify", "with_class": "operators.classify",
    "read_alerts": "sources.alerts", "write_alerts": "sources.alerts", "write_topics": "sources.alerts",
    "route_topics": "operators.routing",
    "catalogue_flags": "operators.kilonova", "early_kn_candidates": "operators.kilonova",
    "rate_based_kn_candidates": "operators.kilonova",
    "build_galaxy_catalogue": "operators.catalogue", "read_catalogue": "operators.catalogue",
    "topic_stream": "streaming.stream", "classify_stream": "streaming.stream",
}


def __getattr__(name):
    if name in _WHERE:
        import importlib
        return getattr(importlib.import_module(f"{__name__}.{_WHERE[name]}"), name)
    raise AttributeError(name)
