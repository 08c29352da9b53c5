from oracle.base import sql


def _avg(c: str, flag: bool = False) -> str:
    return f"round(avg({f'CAST({c} AS INTEGER)' if flag else c}), 6) AS avg_{c}"


STATEMENTS = {
    "a01_auction_user_rollup": sql("SELECT * FROM roll", "roll"),
    "a01_rollup_from_features": sql("SELECT * FROM roll", "roll"),
    "a02_latest_opponent_bid": sql(
        "SELECT auctionid, p_username, max(max_bid) AS max_bid, count(*) AS times_seen FROM pairs GROUP BY ALL",
        "pairs",
    ),
    "a03_last_time_per_user": sql("SELECT username, max(auctiontime) AS max_auctiontime FROM bt GROUP BY username", "bt"),
    "a04_bids_per_user": sql("SELECT username, count(*) AS my_count FROM bids GROUP BY username ORDER BY my_count DESC", "bids"),
    "a05_giveup_profile": sql(
        """SELECT username, count(*) AS giveups, round(avg(perc_to_bin), 6) AS avg_perc_to_bin,
round(avg(bids_so_far), 6) AS g_avg_bid, round(avg(bom_bids_so_far), 6) AS g_bom_bid_avg,
round(avg(bom_streak), 6) AS g_bom_streak_avg FROM bt WHERE giveup GROUP BY username""",
        "bt",
    ),
    "a06_entry_profile": sql(
        """SELECT username, count(*) AS auctions, round(avg(bid), 6) AS avg_debut, round(avg(cashvalue), 6) AS avg_cashvalue
FROM bt WHERE debut = 1 GROUP BY username HAVING count(*) > 10""",
        "bt",
    ),
    "a07_win_profile": sql(
        """SELECT username, round(avg(CAST(is_winner AS INTEGER)), 6) AS win_perc,
round(avg(cashvalue - fee - bid // 100 - 0.4e0), 6) AS profit_avg FROM bt GROUP BY username""",
        "bt",
    ),
    "a08_giveup_by_streak": sql(
        """SELECT bom_streak, (SELECT round(avg(CAST(giveup AS INTEGER)), 6) FROM bt) AS avg_giveup,
round(avg(CAST(giveup AS INTEGER)), 6) AS giveup_frac FROM bt WHERE is_bidomatic AND bom_streak < 200 GROUP BY bom_streak""",
        "bt",
    ),
    "a08_giveup_by_share": sql(
        """SELECT perc_of_bin, (SELECT round(avg(CAST(giveup AS INTEGER)), 6) FROM bt) AS avg_giveup,
round(avg(CAST(giveup AS INTEGER)), 6) AS giveup_frac FROM (SELECT *, round(perc_to_bin * 100, 6) AS perc_of_bin FROM bt)
WHERE perc_of_bin > 0 AND perc_of_bin < 100 GROUP BY perc_of_bin""",
        "bt",
    ),
    "a09_means_by_opponent_bids": sql(
        f"SELECT bids_so_far0, {_avg('is_winner', True)}, {_avg('giveup', True)}, {_avg('cashvalue')}, {_avg('bid')} "
        "FROM full_table GROUP BY bids_so_far0",
        "full_table",
    ),
    "a09_means_by_opponent_types": sql(
        f"SELECT is_bidomatic0, is_bidomatic1, {_avg('is_winner', True)}, {_avg('prevusers')}, {_avg('bids_so_far')} "
        "FROM full_table GROUP BY ALL",
        "full_table",
    ),
    "a09_near_price": sql(
        f"""SELECT percent_near_bin, {_avg('is_winner', True)} FROM
(SELECT *, bids_so_far0 / (cashvalue * 2.5e0) AS percent_near_bin FROM full_table)
WHERE percent_near_bin > 0.95e0 AND percent_near_bin < 1.1e0 GROUP BY percent_near_bin""",
        "full_table",
    ),
    "a09_means_by_hour": sql(
        f"""SELECT CAST(hour(auctiontime) AS INTEGER) AS hour, {_avg('is_winner', True)}, {_avg('perc_to_bin')}, {_avg('bid')}
FROM bt GROUP BY hour(auctiontime)""",
        "bt",
    ),
    "a09_means_by_time": sql(
        f"SELECT auctiontime, {_avg('limited_allowed', True)}, {_avg('is_winner', True)} FROM bt GROUP BY auctiontime", "bt"
    ),
    "a09_lowest_bids": sql(
        """SELECT bid, round(avg(ep) + 1e-9, 6) AS avg_ep, round(avg(actual) + 1e-9, 6) AS avg_actual
FROM ev GROUP BY bid ORDER BY bid LIMIT 30""",
        "ev",
    ),
    "a09_means_by_cardvalue": sql(
        f"SELECT cardvalue, {_avg('is_winner', True)}, {_avg('bid')}, {_avg('fee')} FROM bt GROUP BY cardvalue", "bt"
    ),
    "a10_product_counts": sql(
        """SELECT cardtype, cardvalue, bidvalue, count(*) AS n, CAST(count(*) FILTER (WHERE is_winner) AS BIGINT) AS winners,
round(avg(bid), 6) AS avg_bid FROM bt GROUP BY cardtype, cardvalue, bidvalue""",
        "bt",
    ),
    "a10_product_profit": sql(
        """SELECT cardtype, cardvalue, bidvalue, limited_allowed, CAST(count(*) FILTER (WHERE is_winner) AS BIGINT) AS winners,
count(*) AS bets, round(sum(ep), 6) AS ep, round(sum(actual), 6) AS actual FROM ev WHERE ep > 0 GROUP BY ALL""",
        "ev",
    ),
    "a11_conditional_rates": sql(
        """SELECT is_bidomatic, round(avg(CAST(giveup AS INTEGER)), 6) AS giveup_rate, count(*) AS n,
(SELECT round(avg(CAST(is_winner AS INTEGER)), 6) FROM bt) AS win_rate FROM bt GROUP BY is_bidomatic""",
        "bt",
    ),
    "a12_win_rate_by_streak": sql(
        """SELECT bom_streak0, round(avg(CAST(is_winner AS INTEGER)), 6) AS win_rate, count(*) AS n FROM full_table
WHERE is_bidomatic0 AND bom_streak0 < 300 GROUP BY bom_streak0""",
        "full_table",
    ),
    "a12_win_rate_by_streak_product": sql(
        """SELECT cardtype, cardvalue, bidvalue, bom_streak0, round(avg(CAST(is_winner AS INTEGER)), 6) AS win_rate, count(*) AS n
FROM full_table WHERE is_bidomatic0 AND bom_streak0 < 300 GROUP BY ALL""",
        "full_table",
    ),
    "a13_win_rate_by_cashvalue": sql(
        """SELECT cashvalue, bids_so_far0, round(avg(CAST(is_winner AS INTEGER)), 6) AS win_rate,
cashvalue * 2.5e0 AS break_even FROM full_table WHERE cashvalue IN (1, 2, 3, 4) GROUP BY cashvalue, bids_so_far0""",
        "full_table",
    ),
    "a14_auctions_per_hour": sql(
        "SELECT CAST(hour(auctiontime) AS INTEGER) AS my_hour, count(*) AS c FROM auctions GROUP BY hour(auctiontime)", "auctions"
    ),
    "a15_bucket_means": sql(
        """SELECT bucket, round(avg(perc_to_bin), 6) AS perc_to_bin, round(avg(CAST(giveup AS INTEGER)), 6) AS giveup
FROM (SELECT *, CAST(floor(floor(perc_to_bin * 300) / 30.0e0) AS BIGINT) AS bucket FROM bt) GROUP BY bucket ORDER BY bucket LIMIT 11""",
        "bt",
    ),
    "a16_giveup_histogram": sql(
        """SELECT giveup, CAST(floor(perc_to_bin / 0.03125e0) AS BIGINT) AS bin, count(*) AS n
FROM bt WHERE perc_to_bin > 0.1e0 AND perc_to_bin < 1 GROUP BY ALL""",
        "bt",
    ),
    "a16_density_by_outcome": sql(
        """SELECT is_winner, bin, n, round(n / (sum(n) OVER (PARTITION BY is_winner) * 0.0625e0), 6) AS density FROM
(SELECT is_winner, CAST(floor(share / 0.0625e0) AS BIGINT) AS bin, count(*) AS n
 FROM (SELECT is_winner, bids_so_far0 / (cashvalue * 2.5e0) AS share FROM full_table) WHERE share IS NOT NULL GROUP BY ALL)""",
        "full_table",
    ),
    "a16_winning_bids_by_product": sql(
        """SELECT cardtype, cardvalue, bidvalue, CAST(eventual_win_price // 2 AS BIGINT) AS bin, count(*) AS n
FROM bt WHERE is_winner GROUP BY ALL""",
        "bt",
    ),
    "a16_streaks_by_outcome": sql(
        """SELECT is_winner, CAST(bom_streak0 // 2 AS BIGINT) AS bin, count(*) AS n
FROM full_table WHERE is_bidomatic0 AND bom_streak0 IS NOT NULL GROUP BY ALL""",
        "full_table",
    ),
    "a16_bid_density_by_outcome": sql(
        """SELECT is_winner, bin, n, round(n / (sum(n) OVER (PARTITION BY is_winner) * 4e0), 6) AS density FROM
(SELECT is_winner, CAST(bid // 4 AS BIGINT) AS bin, count(*) AS n FROM scored GROUP BY ALL)""",
        "scored",
    ),
    "a16_winners_bids_by_product": sql(
        """SELECT cardtype, cardvalue, bidvalue, CAST(bids_so_far // 2 AS BIGINT) AS bin, count(*) AS n FROM bt
WHERE is_winner AND (cardtype, cardvalue, bidvalue) IN (SELECT (cardtype, cardvalue, bidvalue) FROM bt WHERE giveup) GROUP BY ALL""",
        "bt",
    ),
    "a16_values_of_bets": sql(
        """SELECT CAST(floor(ep / 0.0625e0) AS BIGINT) AS bin, count(*) AS n FROM ev WHERE ep > 0.1e0 GROUP BY ALL""",
        "ev",
    ),
    "a16_log_bids_per_user": sql(
        """SELECT my_count > 200 AS many, my_count // 50 AS bin, count(*) AS users, round(log10(count(*)), 6) AS log_users
FROM (SELECT username, count(*) AS my_count FROM bids GROUP BY username) GROUP BY ALL""",
        "bids",
    ),
    "a17_probability_counts": sql(
        "SELECT prob, count(*) AS n, (SELECT count(DISTINCT prob) FROM scored) AS distinct_probs FROM scored GROUP BY prob",
        "scored",
    ),
    "a18_overall_counts": sql(
        """SELECT count(*) AS n, CAST(count(*) FILTER (WHERE is_winner) AS BIGINT) AS winners,
round(avg(CAST(is_winner AS INTEGER)), 6) AS win_rate, round(avg(CAST(limited_allowed AS INTEGER)), 6) AS limited_rate,
CAST(count(*) FILTER (WHERE is_winner AND distance1 IS NULL) AS BIGINT) AS winners_one_opponent FROM full_table""",
        "full_table",
    ),
    "a19_distinct_keys": sql("SELECT DISTINCT auctionid FROM bids", "bids"),
}
