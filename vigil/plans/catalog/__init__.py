"""Query catalog: every operator of the inventory as (Spark DataFrame job, DuckDB oracle SQL).

Each entry builds its Spark DataFrame from the driver's tables (through the fixture views) with the
library operators; the oracle is independent SQL text over the same tables. Output columns are
normalised (DECIMAL -> DOUBLE, INT -> BIGINT) so that both sides have one schema.
"""

from __future__ import annotations

from vigil.plans.catalog.base import REGISTRY, Query  # noqa: F401
from vigil.plans.catalog import (  # noqa: F401  (registration side effects)
    q_analysis,
    q_relational,
    q_series,
    q_text,
    q_posts,
    q_io,
)
