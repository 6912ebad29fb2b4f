from .events import stream_dedup, stream_hourly_cells  # noqa: F401
