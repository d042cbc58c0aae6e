"""All registered queries."""

from __future__ import annotations

from functools import lru_cache
from importlib import import_module

from tallywork.plans.registry import Registry

STUDIES = ("purchases", "orders", "subscriptions", "bank", "weekly", "baskets", "interests", "growth")


@lru_cache(maxsize=1)
def registry() -> Registry:
    r = Registry()
    for name in STUDIES:
        import_module(f"tallywork.plans.{name}").register(r)
    return r
