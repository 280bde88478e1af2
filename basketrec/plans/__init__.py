"""Plan-level helpers: size-checked broadcast, the query registry and the
DuckDB oracle SQL used by the correctness gate."""

from basketrec.plans.broadcast import broadcast_if_small  # noqa: F401
