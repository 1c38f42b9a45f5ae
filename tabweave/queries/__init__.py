"""Queries registered for the correctness check, one module per area."""

from __future__ import annotations


def registered() -> dict[str, tuple]:
    """Name to (query, SQL or None)."""
    from tabweave.queries import catalogs, imports, lookups, rules, sheets, states, steps

    found: dict[str, tuple] = {}
    for module in (lookups, sheets, steps, rules, imports, states, catalogs):
        for name, pair in module.QUERIES.items():
            if name in found:
                raise ValueError(f"Query {name} is registered twice")
            found[name] = pair
    return found
