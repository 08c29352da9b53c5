import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gavel.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def make_bids(spark, rows):
    """rows: (auctionid, bid, username, is_bidomatic)"""
    from gavel.schemas import BIDS

    return spark.createDataFrame(rows, BIDS)


def make_auctions(spark, ids, times=None, **over):
    import datetime as dt

    from gavel.schemas import AUCTIONS

    base = {
        "cardvalue": 0, "bidvalue": 10, "tracking": 100.0, "runtime": 60, "limited_allowed": True, "cashvalue": 10,
        "cardtype": "None", "lock_price": 0,
    }
    base.update(over)
    rows = []
    for i, q in enumerate(ids):
        when = times[i] if times else dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)
        rows.append(
            (q, base["cardvalue"], base["bidvalue"], base["tracking"], when, base["runtime"], base["limited_allowed"],
             base["cashvalue"], base["cardtype"], base["lock_price"])
        )
    return spark.createDataFrame(rows, AUCTIONS)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def same(a, b, keys):
    import pandas as pd

    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    x = a.toPandas()[cols].sort_values(keys).reset_index(drop=True)
    y = b.toPandas()[cols].sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(x, y, check_dtype=False)
