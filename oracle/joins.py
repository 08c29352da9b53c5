from oracle.base import sql

SNAP = """SELECT u.username, f.prev_auction_count0, f.prev_overbid0, f.prev_giveup_one0, f.prev_give_before_six0,
  f.prev_wins0, f.prev_bids0, f.prev_bom_bids0
FROM (SELECT username, max(auctiontime) AS last_time FROM full_table GROUP BY username) u
LEFT JOIN full_table f ON f.username0 = u.username AND f.auctiontime = u.last_time AND f.bids_so_far0 = 1"""
RATIOS = ["prev_overbid", "prev_giveup_one", "prev_give_before_six", "prev_wins", "prev_bids", "prev_bom_bids"]


def _placed(col: str, i: int) -> str:
    return f"max({col}) FILTER (WHERE place = {i + 1})"


STATEMENTS = {
    "j01_bids_with_auctions": sql(
        """SELECT auctionid, bid, username, is_bidomatic, cardvalue, bidvalue, tracking, auctiontime, runtime, limited_allowed,
cashvalue, cardtype, lock_price FROM bids JOIN auctions ON auctionid = qauctionid""",
        "bids",
        "auctions",
    ),
    "j02_rows_with_history": sql("SELECT * EXCLUDE (is_locked, is_pen) FROM uni", "uni"),
    "j03_latest_bid_per_opponent": sql("SELECT * FROM pairs", "pairs"),
    "j03_opponent_runs": sql(
        """SELECT auctionid, username AS p_username, bid AS max_bid, bid + 1 AS first, coalesce(later - 1, top) AS last,
coalesce(later_pos - 1, n) - pos AS times_seen
FROM (SELECT *, lead(bid) OVER own AS later, lead(pos) OVER own AS later_pos FROM
  (SELECT *, row_number() OVER (PARTITION BY auctionid ORDER BY bid) AS pos, max(bid) OVER (PARTITION BY auctionid) AS top,
   count(*) OVER (PARTITION BY auctionid) AS n FROM bids) WINDOW own AS (PARTITION BY auctionid, username ORDER BY bid))
WHERE coalesce(later_pos - 1, n) > pos""",
        "bids",
    ),
    "j03_nearest_opponents": sql("SELECT * EXCLUDE (place) FROM places WHERE place <= 4", "places"),
    "j04_opponent_lookup": sql(
        "SELECT m.auctionid, m.bid, "
        + ", ".join(
            f"{_placed('p_username', i)} AS username{i}, {_placed('distance', i)} AS distance{i}, "
            f"{_placed('p_bids_so_far', i)} AS bids_so_far{i}, {_placed('p_bom_streak', i)} AS bom_streak{i}"
            for i in range(4)
        )
        + " FROM bids m LEFT JOIN opp o ON o.auctionid = m.auctionid AND o.bid = m.bid GROUP BY m.auctionid, m.bid",
        "opp",
    ),
    "j05_anti_join_new_bids": sql(
        """SELECT * FROM bids WHERE auctionid NOT IN (SELECT qauctionid FROM auctions
WHERE auctiontime < '2024-01-10' OR tracking <> 100 OR auctiontime < '2019-09-19')""",
        "auctions",
        "bids",
    ),
    "j06_semi_join_bidomatic": sql(
        "SELECT * FROM bids WHERE auctionid IN (SELECT auctionid FROM bids WHERE is_bidomatic)", "bids"
    ),
    "j07_user_snapshot": sql(
        "SELECT username, prev_auction_count0, " + ", ".join(f"round({c}0, 6) AS {c}0" for c in RATIOS) + " FROM snap",
        "full_table",
        snap=SNAP,
    ),
    "j07_user_snapshot_until": sql(
        "SELECT username, prev_auction_count0, " + ", ".join(f"round({c}0, 6) AS {c}0" for c in RATIOS) + " FROM snap",
        "full_table",
        until="SELECT * FROM full_table WHERE auctiontime <= '2024-01-10'",
        snap=SNAP.replace("FROM full_table", "FROM until").replace("JOIN full_table", "JOIN until"),
    ),
    "j08_snapshot_lookup": sql(
        "SELECT n.username, CAST(s.username IS NULL AS INTEGER) AS prev_is_new_user, "
        "CASE WHEN s.username IS NULL THEN 1 ELSE prev_auction_count0 END AS prev_auction_count, "
        + ", ".join(f"CASE WHEN s.username IS NULL THEN 0e0 ELSE round({c}0, 6) END AS {c}" for c in RATIOS)
        + """ FROM (SELECT DISTINCT username FROM bids UNION ALL SELECT DISTINCT username || 'x' FROM bids) n
LEFT JOIN snap s ON s.username = n.username""",
        "full_table",
        snap=SNAP,
    ),
    "j09_user_profile": sql(
        """SELECT e.*, g.* EXCLUDE (username), w.* EXCLUDE (username) FROM
(SELECT username, count(*) AS auctions, round(avg(bid), 6) AS avg_debut, round(avg(cashvalue), 6) AS avg_cashvalue
 FROM bt WHERE debut = 1 GROUP BY username HAVING count(*) > 10) e
LEFT JOIN (SELECT username, count(*) AS giveups, round(avg(perc_to_bin), 6) AS avg_perc_to_bin,
 round(avg(bids_so_far), 6) AS g_avg_bid, round(avg(bom_bids_so_far), 6) AS g_bom_bid_avg,
 round(avg(bom_streak), 6) AS g_bom_streak_avg FROM bt WHERE giveup GROUP BY username) g ON g.username = e.username
LEFT JOIN (SELECT username, round(avg(CAST(is_winner AS INTEGER)), 6) AS win_perc,
 round(avg(cashvalue - fee - bid // 100 - 0.4e0), 6) AS profit_avg FROM bt GROUP BY username) w ON w.username = e.username""",
        "bt",
    ),
    "j10_live_against_batch": sql(
        """SELECT auctionid, bid, round((cashvalue - fee - bid / 100.0e0) * prob - 0.4e0, 6) AS batch_ev,
round((cashvalue - fee - bid / 100.0e0) * CASE WHEN is_bidomatic THEN (bid * 7) % 100 / 100.0e0
ELSE (bid * 3) % 100 / 100.0e0 END - 0.4e0, 6) AS live_ev,
round(CASE WHEN is_winner THEN cashvalue - fee - bid / 100.0e0 ELSE -0.4e0 END, 6) AS actual
FROM scored""",
        "scored",
    ),
    "j11_column_diff": sql(
        """SELECT auctionid, bid, 'bom_streak' AS "column", CAST(bom_streak AS VARCHAR) AS "left", CAST(strict AS VARCHAR) AS "right"
FROM (SELECT *, CASE WHEN is_bidomatic THEN row_number() OVER
      (PARTITION BY auctionid, username, is_bidomatic, prestreak ORDER BY bid) ELSE 0 END AS strict FROM bt)
WHERE bom_streak <> strict""",
        "bt",
    ),
    "j12_known_auction": sql(
        "SELECT bids.* FROM bids JOIN auctions ON auctionid = qauctionid WHERE tracking = 100 AND auctiontime >= '2019-09-19'",
        "bids",
        "auctions",
    ),
    "j13_concat_by_key": sql(
        "SELECT auctionid, bid, round(potential, 6) AS potential, prob, is_winner FROM valued", "valued"
    ),
}
