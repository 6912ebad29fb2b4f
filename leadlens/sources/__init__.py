from .files import read_cohorts, read_hourly, read_profiles, scan  # noqa: F401
from .publish import publish_json, published  # noqa: F401
