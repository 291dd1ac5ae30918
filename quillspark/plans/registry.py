"""All core queries by name."""

from __future__ import annotations

from quillspark.plans import core_queries, data_queries

_MODULES = [data_queries, core_queries]
FLAGSHIP = "ag1_ag2_ag4_scorecard"


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.ORACLES.items()}
