"""All registered queries."""

from __future__ import annotations

from checks import clean, dims, features, gold, governance, jobs, learning, measures, refresh, sources
from checks.common import Registry

MODULES = (sources, dims, clean, gold, features, governance, jobs, measures, learning, refresh)


def build() -> Registry:
    reg = Registry()
    for module in MODULES:
        module.register(reg)
    return reg
