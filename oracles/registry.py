"""All oracles by query key."""

from . import cookbook, extract, merge, projection, rules, search

MODULES = [merge, cookbook, rules, projection, extract, search]


def all_oracles() -> dict[str, str]:
    return {key: sql for module in MODULES for key, sql in module.ORACLES.items()}
