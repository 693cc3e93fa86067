"""Wiring: dataset context (sources → clean tables → facts, built once and
reused) and the registry of named queries."""

from .context import MarketContext, get_context

__all__ = ["MarketContext", "get_context"]
