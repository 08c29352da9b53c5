from oracle.base import day_times, sql


def _feature(col: str) -> str:
    return sql(f"SELECT auctionid, bid, {col} FROM bt", "bt")


PREV_WIN_BODY = """SELECT auctionid, bid, username,
       CAST(CASE WHEN lag(is_winner, CAST(bids_so_far AS INTEGER)) OVER mine
                 THEN lag(bidvalue, CAST(bids_so_far AS INTEGER)) OVER mine ELSE 0 END AS INTEGER) AS prev_win_bids
FROM bt WINDOW mine AS (PARTITION BY username ORDER BY auctiontime, bid, auctionid)"""
PREV_WIN = sql(PREV_WIN_BODY, "bt")
SUMS = sql("SELECT * EXCLUDE (prev_auction_count) FROM hist", "hist")
COUNT = sql("SELECT username, auctionid, prev_auction_count FROM hist", "hist")

STATEMENTS = {
    "w01_eventual_win_price": _feature("eventual_win_price"),
    "w02_eventual_bids": _feature("eventual_bids"),
    "w03_bids_so_far": _feature("bids_so_far"),
    "w04_bids_of_this_type": _feature("bids_of_this_type"),
    "w05_prestreak": _feature("prestreak"),
    "w06_bom_streak": _feature("bom_streak"),
    "w06_strict_islands": sql(
        """SELECT auctionid, bid, CASE WHEN is_bidomatic THEN row_number() OVER island ELSE 0 END AS bom_streak FROM bt
WINDOW island AS (PARTITION BY auctionid, username, is_bidomatic, prestreak ORDER BY bid)""",
        "bt",
    ),
    "w06_any_type_streak": sql(
        """SELECT auctionid, bid, row_number() OVER (PARTITION BY auctionid, username, prestreak ORDER BY bid) AS bom_streak FROM bt""",
        "bt",
    ),
    "w07_debut": _feature("debut"),
    "w08_prevusers": _feature("prevusers"),
    "w09_prev_win_bids": PREV_WIN,
    "w09_prev_win_bids_tied": day_times(PREV_WIN),
    "w10_history_sums": SUMS,
    "w10_history_sums_tied": day_times(SUMS),
    "w11_prev_auction_count": COUNT,
    "w11_prev_auction_count_tied": day_times(COUNT),
    "w12_auction_full": sql("SELECT * FROM full_table", "full_table"),
    "w12_older_opponents": sql(
        "SELECT f.auctionid, f.bid, "
        + ", ".join(
            ", ".join(f"f.{c}{i}" for c in ["username", "distance", "is_bidomatic", "bids_so_far", "bom_bids_so_far", "bom_streak", "perc_to_bin"])
            + f", w{i}.prev_win_bids AS prev_win_bids{i}"
            for i in range(4)
        )
        + " FROM full_table f "
        + " ".join(
            f"LEFT JOIN prior w{i} ON w{i}.auctionid = f.auctionid AND w{i}.bid = f.bid - f.distance{i}" for i in range(4)
        ),
        "full_table",
        prior=PREV_WIN_BODY,
    ),
    "w13_ev_chunks": sql(
        """SELECT a.chunk, round(a.ep, 6) AS low, round(b.ep, 6) AS high,
       (SELECT count(*) FROM bets WHERE ep >= a.ep AND ep < b.ep) AS bets,
       coalesce((SELECT round(sum(actual), 6) FROM bets WHERE ep >= a.ep AND ep < b.ep), 0) AS profit
FROM bounds a JOIN bounds b ON b.chunk = a.chunk + 1""",
        "ev",
        bets="SELECT ep, actual FROM ev WHERE ep > 0",
        bounds="""SELECT place // 1000 AS chunk, ep FROM (SELECT ep, row_number() OVER (ORDER BY ep) - 1 AS place FROM bets)
  WHERE place % 1000 = 0""",
    ),
}
