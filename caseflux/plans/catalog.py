"""All core queries by name, with their SQL oracles."""

from __future__ import annotations

from caseflux.plans import checks, decisions, dedupe, extraction, further, identity, joins, kernels, ledger, lifecycle, periodic, recurrence, registry, resolution, series, streams, survival  # noqa: F401  (they register themselves)

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
