"""SQL statements that recompute the registered queries independently."""

from __future__ import annotations


def all_statements() -> dict[str, str]:
    from oracle import (
        aggregates,
        evaluating,
        ingest,
        joins,
        live,
        modelling,
        ordering,
        parsing,
        projections,
        windows,
    )

    groups = (ingest, parsing, projections, joins, aggregates, windows, ordering, modelling, evaluating, live)
    return {name: text for group in groups for name, text in group.STATEMENTS.items()}
