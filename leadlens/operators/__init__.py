from . import aggregates, asof, cells, dedup, joins, ordered  # noqa: F401
