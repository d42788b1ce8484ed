"""All registered queries; importing the plan modules fills the registry."""

from __future__ import annotations

from cairn.plans import archives, cost, files, joins, models, places, promotion, quality, records, rollups, rules, score, sets, similar, stats, streams, terms, text, windows, worklists  # noqa: F401
from cairn.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
