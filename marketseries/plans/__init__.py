"""Registered queries by area."""

from __future__ import annotations


def _load() -> None:
    from marketseries.plans import basics, models, series, strategies  # noqa: F401


def all_queries() -> dict:
    from marketseries.plans.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles() -> dict:
    from marketseries.plans.registry import ORACLES

    _load()
    return dict(ORACLES)
