"""Ready-made queries over the test tables, each with an independent SQL check.

``all_queries`` maps a name to ``(spark, folder) -> DataFrame``; ``all_checks`` maps
the same names to the SQL that gives the same rows, where SQL can express it.
"""

from oddlens.catalog import diagnosing, evaluating, modelling, preparing, profiling, reading, reviewing, separating, splitting, tracking

_MODULES = (reading, profiling, diagnosing, preparing, separating, tracking, splitting, evaluating, reviewing, modelling)


def all_queries() -> dict:
    found: dict = {}
    for module in _MODULES:
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query '{name}' is defined twice")
            found[name] = query
    return found


def all_checks() -> dict:
    found: dict = {}
    for module in _MODULES:
        found.update(module.CHECKS)
    return found
