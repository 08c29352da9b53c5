from oracle.base import HISTORY, sql

BOARD = """SELECT CAST(auctionid AS VARCHAR) AS auction_id,
  CASE WHEN cashvalue = 1 THEN 'None' ELSE cardtype END AS cardtype, cardvalue, bidvalue, runtime % 600 AS sl,
  cashvalue - fee - bid / 100.0e0 - 0.4e0 AS potential_profit, proba AS bom_proba,
  proba * (cashvalue - fee - bid / 100.0e0 - 0.4e0) - (1e0 - proba) * 0.4e0 AS bom_ev,
  proba / 2 * (cashvalue - fee - bid / 100.0e0 - 0.4e0) - (1e0 - proba / 2) * 0.4e0 AS manual_ev,
  limited_allowed AS is_live, tracking = 100 AS tracking_ok
FROM (SELECT a.*, qauctionid AS auctionid, b.bid,
             CASE WHEN cardvalue = 0 THEN 0e0 WHEN cardvalue < 50 THEN 1e0 ELSE 1.99e0 END AS fee,
             ((qauctionid * 31 + b.bid * 17) % 100) / 100.0e0 AS proba
      FROM auctions a JOIN (SELECT auctionid, max(bid) AS bid FROM bids GROUP BY auctionid) b ON auctionid = qauctionid)"""
UPCOMING = """SELECT CAST(p_partkey AS VARCHAR) AS auctionid,
  CASE p_size % 4 WHEN 0 THEN 'None' WHEN 1 THEN 'Buster' ELSE p_brand END AS cardtype,
  CAST(CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN 10 ELSE 75 END AS INTEGER) AS cardvalue,
  p_size AS bidvalue, p_size * 13 % 700 AS seconds_left FROM part"""


def _text(i: int) -> str:
    return f"CASE WHEN is_bidomatic{i} THEN 'True' WHEN NOT is_bidomatic{i} THEN 'False' ELSE 'None' END AS is_bidomatic{i}"


STATEMENTS = {
    "f01_quality_filter": sql(
        "SELECT qauctionid, tracking = 100 AND auctiontime >= '2019-09-19' AS kept FROM auctions", "auctions"
    ),
    "f02_load_projection": sql(
        """SELECT * REPLACE (CAST(sign(cashvalue - cardvalue) * floor(abs(cashvalue - cardvalue) * 2.5e0 + 0.5e0) AS INTEGER)
AS bidvalue) FROM auctions WHERE tracking = 100 AND auctiontime >= '2019-09-19'""",
        "auctions",
    ),
    "f03_is_locked": sql("SELECT auctionid, bid, is_locked FROM bt", "bt"),
    "f04_fee": sql(
        "SELECT qauctionid, CASE WHEN cardvalue = 0 THEN 0e0 WHEN cardvalue < 50 THEN 1e0 ELSE 1.99e0 END AS fee FROM auctions",
        "auctions",
    ),
    "f05_outcome_flags": sql("SELECT auctionid, bid, is_winner, is_pen, giveup FROM bt", "bt"),
    "f06_perc_to_bin": sql("SELECT auctionid, bid, perc_to_bin FROM bt", "bt"),
    "f07_bom_bids_so_far": sql("SELECT auctionid, bid, bom_bids_so_far FROM bt", "bt"),
    "f08_pending_before_cutoff": sql(
        """SELECT qauctionid, auctiontime FROM auctions WHERE auctiontime < '2024-01-10' AND qauctionid NOT IN
(SELECT auctionid FROM bt WHERE auctiontime < '2024-01-05')""",
        "bt",
    ),
    "f09_model_rows": sql(
        """SELECT auctionid, bid, username FROM full_table WHERE auctiontime >= '2024-01-10' AND auctionid IN
(SELECT auctionid FROM full_table WHERE is_bidomatic)""",
        "full_table",
    ),
    "f10_time_features": sql(
        """SELECT qauctionid, CAST(hour(auctiontime) AS INTEGER) AS time_of_day, isodow(auctiontime) = 7 AS is_weekend,
CASE WHEN cardvalue = 0 THEN 0e0 WHEN cardvalue < 50 THEN 1e0 ELSE 1.99e0 END AS fee,
CAST(hour(auctiontime) * 60 + minute(auctiontime) AS INTEGER) AS minute_of_day, CAST(day(auctiontime) AS INTEGER) AS day
FROM auctions""",
        "auctions",
    ),
    "f11_flag_text": sql(f"SELECT auctionid, bid, {', '.join(map(_text, range(4)))} FROM full_table", "full_table"),
    "f12_normalised_history": sql(
        "SELECT auctionid, username, greatest(prev_auction_count, 1) AS prev_auction_count, "
        "CAST(prev_auction_count = 0 AS INTEGER) AS prev_is_new_user, "
        + ", ".join(
            f"round(CAST({src} AS DOUBLE) / greatest(prev_auction_count, 1), 6) AS {out}"
            for (out, _), src in zip(
                HISTORY,
                ["prev_overbid_count", "prev_giveup_one_count", "prev_giveup_before_six_count", "prev_wins_count",
                 "prev_bid_count", "prev_bom_bid_count"],
            )
        )
        + " FROM hist",
        "hist",
    ),
    "f13_directly_followed": sql("SELECT auctionid, bid, distance0 FROM full_table", "full_table"),
    "f14_upcoming_candidates": sql(
        """SELECT * FROM upcoming WHERE (cardtype IN ('None', 'Buster') OR cardvalue >= 25) AND seconds_left < 350
AND auctionid NOT IN (SELECT CAST(qauctionid AS VARCHAR) FROM auctions WHERE limited_allowed)""",
        "auctions",
        upcoming=UPCOMING,
    ),
    "f05_older_giveup": sql("SELECT auctionid, bid, bid = eventual_bids AND NOT is_winner AS giveup FROM bt", "bt"),
    "f15_upcoming_labels": sql(
        """SELECT auctionid, (seconds_left // 60) || 'm ' || (seconds_left % 60) || 's :' ||
CASE WHEN cardtype = 'None' THEN 'Bid Pack ' || bidvalue ELSE cardtype || ' $' || cardvalue END || ' (' || auctionid || ')' AS line
FROM upcoming""",
        upcoming=UPCOMING,
    ),
    "f15_board_labels": sql(
        """SELECT auction_id,
auction_id || ': ' || CASE WHEN cardtype = 'None' THEN 'Bid Pack ' || bidvalue ELSE cardtype || ' $' || cardvalue END AS title,
(sl // 60) || 'm ' || (sl % 60) || 's' AS time_left,
printf('%.2f', round(potential_profit, 6) + 1e-9) AS profit_text, printf('%.4f', bom_proba) AS proba_text, printf('%.2f', round(bom_ev, 6) + 1e-9) AS ev_text,
CASE WHEN bom_ev >= 0 THEN 'green' ELSE 'red' END AS console_color,
CASE WHEN bom_ev <= 0 THEN 'red' ELSE 'green' END AS page_color,
is_live AND greatest(manual_ev, bom_ev) >= 0 AS alert,
CASE WHEN tracking_ok THEN '' ELSE 'NOT FULLY TRACKING!' END AS tracking_text FROM board""",
        "auctions",
        "bids",
        board=BOARD,
    ),
    "f16_giveup_by_parameter": sql(
        """SELECT bidvalue, round(perc_to_bin, 6) AS perc_of_bin, round(avg(CAST(giveup AS INTEGER)), 6) AS giveup_frac
FROM bt WHERE cardvalue = 0 AND bidvalue IN (3, 5, 8, 10, 15, 25) GROUP BY ALL""",
        "bt",
    ),
    "f16_giveup_against_parameter": sql(
        """SELECT bidvalue, perc_of_bin, round(rate, 6) AS avg_giveup, round(avg(CAST(giveup AS INTEGER)), 6) AS giveup_frac
FROM (SELECT bidvalue, round(perc_to_bin, 6) AS perc_of_bin, giveup, avg(CAST(giveup AS INTEGER)) OVER (PARTITION BY bidvalue) AS rate
 FROM bt WHERE cardvalue = 0 AND bidvalue IN (3, 5, 8, 10, 15, 25))
WHERE perc_of_bin > 0 AND perc_of_bin < 5 GROUP BY bidvalue, perc_of_bin, rate""",
        "bt",
    ),
    "f17_fill_zero": sql(
        """SELECT username, count(*) AS n, coalesce(round(avg(bids_so_far) FILTER (WHERE giveup), 6), 0) AS avg_giveup
FROM bt GROUP BY username""",
        "bt",
    ),
    "f18_column_contract": sql(
        "SELECT * EXCLUDE (username0, username1, username2, username3) FROM full_table", "full_table"
    ),
}
