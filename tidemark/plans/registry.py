"""All named queries and their DuckDB twins: importing it imports every plan module, and these register themselves."""

from __future__ import annotations

from tidemark.plans import classes, composites, inputs, measure, panel, stores  # noqa: F401
from tidemark.plans.base import ORACLES, QUERIES  # noqa: F401
