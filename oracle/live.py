from oracle.base import sql
from oracle.joins import RATIOS, SNAP
from oracle.parsing import MESSAGES
from oracle.projections import BOARD

ME = "u1"
# Rows as the next bid sees them: every bid joined with each user's latest bid
# up to it, own bids left out, nearest four.
STREAKS = """SELECT *, CASE WHEN is_bidomatic THEN row_number() OVER
  (PARTITION BY auctionid, username, is_bidomatic, prestreak ORDER BY bid) ELSE 0 END AS streak FROM bt"""
SEEN = f"""SELECT n.auctionid, n.bid, p.username, max(p.bid) AS at FROM bids n JOIN bids p
  ON p.auctionid = n.auctionid AND p.bid <= n.bid AND p.username <> '{ME}' GROUP BY n.auctionid, n.bid, p.username"""
NEAR = """SELECT s.auctionid, s.bid, s.username, s.at, k.is_bidomatic, k.bids_so_far, k.bom_bids_so_far, k.streak, k.perc_to_bin,
  row_number() OVER (PARTITION BY s.auctionid, s.bid ORDER BY s.at DESC) AS place
FROM seen s JOIN streaks k ON k.auctionid = s.auctionid AND k.bid = s.at"""


def _at(expr: str, i: int) -> str:
    return f"any_value({expr}) FILTER (WHERE place = {i + 1})"


WIDE = ", ".join(
    f"{_at('n.username', i)} AS username{i}, {_at('b.bid + 1 - n.at', i)} AS distance{i}, "
    f"{_at('n.is_bidomatic', i)} AS is_bidomatic{i}, {_at('n.bids_so_far', i)} AS bids_so_far{i}, "
    f"{_at('n.bom_bids_so_far', i)} AS bom_bids_so_far{i}, {_at('n.streak', i)} AS bom_streak{i}, "
    f"{_at('n.perc_to_bin', i)} AS perc_to_bin{i}"
    for i in range(4)
)
NEXT = f"""SELECT b.auctionid, CAST(b.bid + 1 AS BIGINT) AS bid, count(n.place) AS prevusers, {WIDE}
FROM bids b LEFT JOIN near n ON n.auctionid = b.auctionid AND n.bid = b.bid GROUP BY b.auctionid, b.bid"""
ENDS = f"""SELECT auctionid, max(bid) AS last_bid, arg_max(username, bid) AS last_user,
  count(DISTINCT username) FILTER (WHERE username <> '{ME}') AS prevusers FROM bids GROUP BY auctionid"""
CHAIN = {"streaks": STREAKS, "seen": SEEN, "near": NEAR}

STATEMENTS = {
    "l01_ingest_stream": sql("SELECT * FROM messages", "bids", messages=MESSAGES),
    "l02_kept_bids": sql("SELECT CAST(auctionid AS VARCHAR) AS auction_id, bid, username, is_bidomatic FROM bids", "bids"),
    "l02_stream_states": sql(
        """SELECT CAST(auctionid AS VARCHAR) AS auction_id, CAST(last_bid AS BIGINT) AS n_bids, last_bid, last_user, prevusers,
limited_allowed AS is_live, cashvalue = 4 AS complete, true AS tracking_ok FROM ends JOIN auctions ON auctionid = qauctionid""",
        "bids",
        "auctions",
        ends=ENDS,
    ),
    "l03_gap_flags": sql(
        """SELECT CAST(auctionid AS VARCHAR) AS auction_id, max(bid) AS last_bid, count(*) AS n_bids, max(bid) = count(*) AS tracking_ok
FROM bids GROUP BY auctionid""",
        "bids",
    ),
    "l04_go_live": sql(
        "SELECT CAST(qauctionid AS VARCHAR) AS auction_id, limited_allowed AS went_live FROM auctions", "auctions"
    ),
    "l05_next_bid_features": sql("SELECT * FROM next_bids", "bt", **CHAIN, next_bids=NEXT),
    "l05_stream_opponents": sql(
        """SELECT CAST(n.auctionid AS VARCHAR) AS auction_id, CAST(place - 1 AS INTEGER) AS place, n.username, n."at" AS bid, is_bidomatic,
bids_so_far, bom_bids_so_far, streak AS bom_streak FROM near n JOIN ends e ON e.auctionid = n.auctionid AND e.last_bid = n.bid WHERE place <= 4""",
        "bt",
        **CHAIN,
        ends=ENDS,
    ),
    "l06_padding": sql(
        "SELECT auctionid, bid, CAST(4 - least(prevusers, 4) AS INTEGER) AS empty FROM next_bids", "bt", **CHAIN, next_bids=NEXT
    ),
    "l07_auction_rows": sql(
        """SELECT qauctionid AS auctionid, CAST(bid + 1 AS BIGINT) AS bid,
auctiontime - INTERVAL 4 HOUR + to_seconds(runtime % 600) AS auctiontime,
CASE WHEN cardvalue = 0 THEN 0e0 WHEN cardvalue < 50 THEN 1e0 ELSE 1.99e0 END AS fee, CAST(NULL AS BOOLEAN) AS is_winner,
false AS is_locked, 'me' AS username, true AS is_bidomatic
FROM auctions JOIN (SELECT auctionid, max(bid) AS bid FROM bids GROUP BY auctionid) ON auctionid = qauctionid""",
        "auctions",
        "bids",
    ),
    "l08_snapshot_join": sql(
        "SELECT e.auctionid, "
        + ", ".join(
            f"any_value(n.username) FILTER (WHERE place = {i + 1}) AS username{i}, "
            f"any_value(CAST(s.username IS NULL AS INTEGER)) FILTER (WHERE place = {i + 1}) AS prev_is_new_user{i}, "
            f"CAST(any_value(CASE WHEN s.username IS NULL THEN 1 ELSE prev_auction_count0 END) FILTER (WHERE place = {i + 1}) AS DOUBLE) AS prev_auction_count{i}, "
            + ", ".join(
                f"any_value(CASE WHEN s.username IS NULL THEN 0e0 ELSE round({c}0, 6) END) FILTER (WHERE place = {i + 1}) AS {c}{i}"
                for c in RATIOS
            )
            for i in range(4)
        )
        + """ FROM ends e LEFT JOIN near n ON n.auctionid = e.auctionid AND n.bid = e.last_bid LEFT JOIN snap s ON s.username = n.username
GROUP BY e.auctionid""",
        "full_table",
        **CHAIN,
        ends=ENDS,
        snap=SNAP,
    ),
    "l09_emit_on_change": sql(
        """SELECT CAST(qauctionid AS VARCHAR) AS auction_id, n + CAST(limited_allowed AS INTEGER) + CAST(cashvalue = 4 AS INTEGER) AS rows_out
FROM auctions JOIN (SELECT auctionid, count(*) AS n FROM bids GROUP BY auctionid) ON auctionid = qauctionid""",
        "auctions",
        "bids",
    ),
    "l10_current_board": sql(
        """SELECT CAST(auctionid AS VARCHAR) AS auction_id, CAST(last_bid AS BIGINT) AS n_bids, last_bid, last_user, prevusers,
limited_allowed AS is_live FROM ends JOIN auctions ON auctionid = qauctionid WHERE cashvalue < 4""",
        "bids",
        "auctions",
        ends=ENDS,
    ),
    "l11_state_before_own_bid": sql(
        f"""SELECT CAST(m.auctionid AS VARCHAR) AS auction_id, m.bid AS my_bid, CAST(m.bid - 1 AS BIGINT) AS n_bids, p.username AS last_user,
(SELECT count(DISTINCT q.username) FROM bids q WHERE q.auctionid = m.auctionid AND q.bid < m.bid AND q.username <> '{ME}') AS prevusers
FROM bids m JOIN bids p ON p.auctionid = m.auctionid AND p.bid = m.bid - 1 WHERE m.username = '{ME}'""",
        "bids",
    ),
    "l10_valued_board": sql(
        """SELECT CAST(e.auctionid AS VARCHAR) AS auction_id, CAST(e.last_bid AS BIGINT) AS n_bids, e.last_bid, e.last_user, e.prevusers, a.limited_allowed AS is_live,
any_value(n.username) FILTER (WHERE place = 1) AS username0, any_value(e.last_bid + 1 - n."at") FILTER (WHERE place = 1) AS distance0,
any_value(CAST(s.username IS NULL AS INTEGER)) FILTER (WHERE place = 1) AS prev_is_new_user0,
CAST(any_value(CASE WHEN s.username IS NULL THEN 1 ELSE prev_auction_count0 END) FILTER (WHERE place = 1) AS DOUBLE) AS prev_auction_count0,
any_value(CASE WHEN s.username IS NULL THEN 0e0 ELSE round(prev_bids0, 6) END) FILTER (WHERE place = 1) AS prev_bids0,
any_value(n.username) FILTER (WHERE place = 4) AS username3,
any_value(CASE WHEN s.username IS NULL THEN 0e0 ELSE round(prev_bids0, 6) END) FILTER (WHERE place = 4) AS prev_bids3,
any_value(round(pot, 6)) AS potential_profit, any_value(round(bp * pot - (1e0 - bp) * 0.4e0, 6)) AS bom_ev,
any_value(round(mp * pot - (1e0 - mp) * 0.4e0, 6)) AS manual_ev
FROM (SELECT *, cashvalue - CASE WHEN cardvalue = 0 THEN 0e0 WHEN cardvalue < 50 THEN 1e0 ELSE 1.99e0 END - (last_bid + 1) / 100.0e0 - 0.4e0 AS pot,
        (auctionid * 31 + (last_bid + 1) * 17 + 1) % 100 / 100.0e0 AS bp, (auctionid * 31 + (last_bid + 1) * 17) % 100 / 100.0e0 AS mp
      FROM ends JOIN auctions ON auctionid = qauctionid WHERE cashvalue < 4) e JOIN auctions a ON a.qauctionid = e.auctionid
LEFT JOIN near n ON n.auctionid = e.auctionid AND n.bid = e.last_bid LEFT JOIN snap s ON s.username = n.username
GROUP BY e.auctionid, e.last_bid, e.last_user, e.prevusers, a.limited_allowed""",
        "full_table",
        "auctions",
        **CHAIN,
        ends=ENDS,
        snap=SNAP,
    ),
    "l12_upcoming_replaced": sql(
        """SELECT * FROM (SELECT CAST(p_partkey AS VARCHAR) AS auctionid,
  CASE p_size % 4 WHEN 0 THEN 'None' WHEN 1 THEN 'Buster' ELSE p_brand END AS cardtype,
  CAST(CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN 10 ELSE 75 END AS INTEGER) AS cardvalue,
  p_size AS bidvalue, p_size * 13 % 700 AS seconds_left FROM part)
WHERE (cardtype IN ('None', 'Buster') OR cardvalue >= 25) AND auctionid NOT IN (SELECT CAST(qauctionid AS VARCHAR) FROM auctions)""",
        "auctions",
    ),
    "l13_first_on_board": sql(
        "SELECT auction_id, round(bom_ev, 6) AS bom_ev FROM board WHERE is_live ORDER BY auction_id LIMIT 10",
        "auctions",
        "bids",
        board=BOARD,
    ),
    "m08_two_scenarios": sql(
        """SELECT auctionid, CAST(bid AS BIGINT) AS bid, b AS is_bidomatic, round(p * pot - (1e0 - p) * 0.4e0, 6) AS ev FROM
(SELECT auctionid, bid + 1 AS bid, b, (auctionid * 31 + (bid + 1) * 17 + CAST(b AS INTEGER)) % 100 / 100.0e0 AS p,
        cashvalue - fee - (bid + 1) / 100.0e0 - 0.4e0 AS pot FROM bt, (VALUES (true), (false)) s(b) WHERE is_winner)""",
        "bt",
    ),
}
STATEMENTS["l11_stream_state_before_own_bid"] = STATEMENTS["l11_state_before_own_bid"]
