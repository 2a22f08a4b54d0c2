"""Named queries over the star schema, each with its SQL check where one exists."""

from __future__ import annotations


def all_cases() -> dict:
    from millrace.plans import (
        aggregates,
        graphs,
        joining,
        learning,
        projections,
        sinking,
        sourcing,
        streams,
    )

    merged: dict = {}
    for module in (sourcing, sinking, projections, joining, aggregates, streams, learning, graphs):
        for key, case in module.CASES.items():
            if key in merged:
                raise ValueError(f"query {key!r} is defined twice")
            merged[key] = case
    return merged
