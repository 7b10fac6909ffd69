"""All queries of the research engine by name, with their SQL."""

from __future__ import annotations

from . import campaigns, discovery, events, evidence, feeds, filings, intraday, lookups, market, pairs, placebos, regulatory, reports, ridge, scanner, streams, technicals

FLAGSHIP = "q4_daily_features"
_MODULES = (market, campaigns, events, reports, scanner, discovery, lookups, technicals, intraday, filings, evidence, pairs, ridge, streams, feeds, regulatory, placebos)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
