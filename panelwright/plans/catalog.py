"""All registered queries."""

from __future__ import annotations

from . import (  # noqa: F401
    queries_consolidated,
    queries_models,
    queries_read,
    queries_series,
    queries_tables,
    queries_views,
)
from .registry import ORACLES, QUERIES  # noqa: F401

FLAGSHIP = "consolidated_panel"
