"""Named queries over the test tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gavel.catalog.tables import Tables
from gavel.session import tune

Query = Callable[[SparkSession, str], DataFrame]


def _bind(build: Callable[[Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Tables(tune(spark), sf_dir))

    run.__doc__ = build.__doc__
    return run


def all_queries() -> dict[str, Query]:
    from gavel.catalog import (
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
    return {name: _bind(build) for group in groups for name, build in group.QUERIES.items()}
