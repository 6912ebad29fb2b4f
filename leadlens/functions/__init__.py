from . import labels, maps, predicates, rates, temporal  # noqa: F401
