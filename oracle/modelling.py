from oracle.base import shuffled, sql

PER_OPPONENT = [
    "distance", "bids_so_far", "bom_bids_so_far", "bom_streak", "perc_to_bin", "prev_is_new_user", "prev_auction_count",
    "prev_overbid", "prev_giveup_one", "prev_give_before_six", "prev_wins", "prev_bids", "prev_bom_bids",
]
NUMBERS = ["bid", "cashvalue", "bidvalue", "prevusers"] + [
    f"{c}{i}" for i in range(4) for c in PER_OPPONENT if f"{c}{i}" != "distance0"
]


def _text(c: str) -> str:
    return f"CASE WHEN {c} THEN 'True' WHEN NOT {c} THEN 'False' ELSE 'None' END AS {c}"


STATEMENTS = {
    "m01_impute_numbers": sql(
        "SELECT auctionid, bid, "
        + ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), -1e0), 6) AS x_{c}" for c in NUMBERS)
        + ", CAST(isodow(auctiontime) = 7 AS DOUBLE) AS x_is_weekend, CAST(hour(auctiontime) AS DOUBLE) AS x_time_of_day FROM full_table",
        "full_table",
    ),
    "m02_impute_categories": sql(
        "SELECT auctionid, bid, CASE WHEN limited_allowed THEN cardtype ELSE 'unknown' END AS cardtype, "
        + ", ".join(_text(c) for c in ["limited_allowed", "is_locked", "is_bidomatic"] + [f"is_bidomatic{i}" for i in range(4)])
        + " FROM full_table",
        "full_table",
    ),
    "m03_one_hot": sql(
        """SELECT auctionid, bid, CAST(coalesce(is_bidomatic0, false) AS INTEGER) AS type_true,
CAST(is_bidomatic0 IS NULL AS INTEGER) AS type_none FROM full_table""",
        "full_table",
    ),
    "m05_undersample_size": sql(
        """SELECT is_winner, CASE WHEN is_winner THEN count(*) ELSE 2 * (SELECT count(*) FROM scored WHERE is_winner) END AS n
FROM scored GROUP BY is_winner""",
        "scored",
    ),
    "m05_undersample": sql(
        f"""SELECT auctionid, bid, is_winner FROM (SELECT *, row_number() OVER (PARTITION BY is_winner ORDER BY {shuffled(17)}, auctionid, bid) AS place
FROM scored) WHERE is_winner OR place <= 2 * (SELECT count(*) FROM scored WHERE is_winner)""",
        "scored",
    ),
    "m14_random_split": sql(
        f"""SELECT auctionid, bid, CASE WHEN {shuffled(0)} % 1000000 / 1000000e0 < 0.75e0 THEN 'train' ELSE 'test' END AS split FROM scored""",
        "scored",
    ),
    "m06_scored_rows": sql(
        """SELECT auctionid, count(*) AS n, count(*) AS n_probabilities FROM full_table
WHERE auctiontime > '2024-01-10' AND auctiontime <= '2024-02-01' AND auctionid IN (SELECT auctionid FROM full_table WHERE is_bidomatic)
GROUP BY auctionid""",
        "full_table",
    ),
    "m07_calibrated": sql(
        """SELECT auctionid, bid, round(yes / (yes + no), 6) AS prob FROM (SELECT auctionid, bid,
 prob * rate / (1e0 / 3) AS yes, (1 - prob) * (1 - rate) / (1 - 1e0 / 3) AS no FROM scored,
 (SELECT avg(CAST(is_winner AS INTEGER)) AS rate FROM scored))""",
        "scored",
    ),
    "m10_shuffled_column": sql('SELECT cashvalue, count(*) AS n, count(*) AS "rows" FROM scored GROUP BY cashvalue', "scored"),
    "m15_time_split": sql(
        """SELECT qauctionid, CASE WHEN auctiontime <= '2024-01-10' THEN 'train' WHEN auctiontime <= '2024-01-20' THEN 'test'
ELSE 'holdout' END AS split FROM auctions""",
        "auctions",
    ),
}
