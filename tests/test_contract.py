"""The driver contract, and a sample of the queries against their statements."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, compare

SAMPLE = [
    "w09_prev_win_bids_tied", "w10_history_sums_tied", "w11_prev_auction_count_tied", "j11_column_diff", "e07_best_threshold",
    "e08_roc_auc", "p05_upcoming_pages", "l05_next_bid_features", "a16_density_by_outcome", "m05_undersample_size",
]


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_statement_has_a_query():
    queries, statements = entry.queries(), entry.oracle_sql()
    assert set(statements) <= set(queries)
    assert len(queries) > 140


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 82


@pytest.mark.parametrize("name", SAMPLE)
def test_query_against_sql(spark, sf_dir, con, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    assert compare(got, con.execute(entry.oracle_sql()[name]).df()) == "ok"
