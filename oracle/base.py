"""DuckDB statements that rebuild the derived tables from the test tables."""

from __future__ import annotations

from gavel.schemas import BASE_COLUMNS

HISTORY = [
    ("prev_overbid", "prev_overbid"), ("prev_giveup_one", "prev_giveup_one"),
    ("prev_give_before_six", "prev_giveup_before_six"), ("prev_wins", "prev_wins"),
    ("prev_bids", "prev_bids"), ("prev_bom_bids", "prev_bom_bids"),
]
PLAIN = ["is_bidomatic", "bids_so_far", "bom_bids_so_far", "bom_streak", "perc_to_bin"]


def _wide() -> str:
    cols = []
    for i in range(4):
        at = f"FILTER (WHERE o.place = {i + 1})"
        cols.append(f"max(o.p_username) {at} AS username{i}")
        cols.append(f"max(o.distance) {at} AS distance{i}")
        cols += [f"any_value(o.p_{c}) {at} AS {c}{i}" for c in PLAIN]
        cols.append(f"max(o.p_new) {at} AS prev_is_new_user{i}")
        cols.append(f"max(o.p_count) {at} AS prev_auction_count{i}")
        cols += [f"max(o.p_{out}) {at} AS {out}{i}" for out, _ in HISTORY]
    return ",\n  ".join(cols)


CTES = {
    "kept": """
  SELECT CASE WHEN place < size THEN run * 2 ELSE run * 2 + 1 END AS auctionid,
         CAST(CASE WHEN place < size THEN place + 1 ELSE place - size + 1 END AS INTEGER) AS bid,
         'u' || CAST(user_id // 6 AS VARCHAR) AS username,
         event_type IN ('click', 'view') AS is_bidomatic, ts
  FROM (SELECT *, event_id // 40 AS run, event_id % 40 AS place, 12 + ((event_id // 40) * 7) % 29 AS size FROM events)""",
    "bids": "SELECT auctionid, bid, username, is_bidomatic FROM kept",
    "auctions": """
  SELECT auctionid AS qauctionid,
         CAST(CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN 25 ELSE 75 END AS INTEGER) AS cardvalue,
         CAST(round((1 + p_size % 4 - CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN 25 ELSE 75 END) * 2.5e0) AS INTEGER) AS bidvalue,
         CASE WHEN auctionid % 50 = 0 THEN 99.5e0 ELSE 100.0e0 END AS tracking,
         last_ts AS auctiontime,
         CAST(date_diff('second', first_ts, last_ts) AS INTEGER) AS runtime,
         p_size % 2 = 0 AS limited_allowed,
         CAST(1 + p_size % 4 AS INTEGER) AS cashvalue,
         brand AS cardtype,
         CAST(CASE WHEN p_size % 5 = 0 THEN 10 ELSE 0 END AS INTEGER) AS lock_price
  FROM (SELECT k.*, coalesce(part.p_size, 1) AS p_size, coalesce(p_brand, 'None') AS brand
        FROM (SELECT auctionid, max(ts) AS last_ts, min(ts) AS first_ts FROM kept GROUP BY auctionid) k
        LEFT JOIN part ON p_partkey = k.auctionid)""",
    "numbered": """
  SELECT b.*, a.* EXCLUDE (qauctionid, tracking, runtime),
         max(bid) OVER (PARTITION BY auctionid) AS eventual_win_price,
         count(*) OVER (PARTITION BY auctionid, username) AS eventual_bids,
         row_number() OVER mine AS bids_so_far,
         row_number() OVER alike AS bids_of_this_type
  FROM bids b JOIN auctions a ON b.auctionid = a.qauctionid
  WINDOW mine AS (PARTITION BY auctionid, username ORDER BY bid),
         alike AS (PARTITION BY auctionid, username, is_bidomatic ORDER BY bid)""",
    "bt": """
  SELECT auctionid, cashvalue, cardvalue, auctiontime, bidvalue, cardtype, limited_allowed, bid, username,
         is_bidomatic, lock_price <> 0 AND bid >= lock_price AS is_locked, eventual_win_price, bids_so_far,
         eventual_bids, bids_of_this_type, bids_so_far - bids_of_this_type AS prestreak,
         CAST(bids_so_far = 1 AS INTEGER) AS debut,
         CASE WHEN cardvalue = 0 THEN 0e0 WHEN cardvalue < 50 THEN 1e0 ELSE 1.99e0 END AS fee,
         CASE WHEN is_bidomatic THEN row_number() OVER island ELSE 0 END AS bom_streak,
         CAST(count(*) FILTER (WHERE bids_so_far = 1) OVER (PARTITION BY auctionid ORDER BY bid) - 1 AS BIGINT) AS prevusers,
         bid = eventual_win_price AS is_winner, bid + 1 = eventual_win_price AS is_pen,
         bids_so_far = eventual_bids AND bid < eventual_win_price AS giveup,
         CASE WHEN is_bidomatic THEN bids_of_this_type ELSE bids_so_far - bids_of_this_type END AS bom_bids_so_far,
         bids_so_far / (cashvalue * 2.5e0) AS perc_to_bin
  FROM numbered
  WINDOW island AS (PARTITION BY auctionid, username, bids_so_far - bids_of_this_type ORDER BY bid)""",
    "roll": """
  SELECT auctionid, username, auctiontime, count(*) AS bids,
         CAST(count(*) FILTER (WHERE is_bidomatic) AS BIGINT) AS bidomatic_bids, min(bid) AS entry,
         CAST(count(*) FILTER (WHERE is_winner) AS BIGINT) AS wins,
         CAST(coalesce(bool_or(giveup AND bids_so_far = 1), false) AS DOUBLE) AS giveup_at_one,
         CAST(coalesce(bool_or(giveup AND bids_so_far <= 5), false) AS DOUBLE) AS giveup_before_six,
         CAST(coalesce(bool_or(perc_to_bin >= 1), false) AS DOUBLE) AS overbid
  FROM bt GROUP BY auctionid, username, auctiontime""",
    "hist": """
  SELECT auctiontime, username, auctionid,
         sum(overbid) OVER past - overbid AS prev_overbid_count,
         sum(giveup_at_one) OVER past - giveup_at_one AS prev_giveup_one_count,
         sum(giveup_before_six) OVER past - giveup_before_six AS prev_giveup_before_six_count,
         CAST(sum(wins) OVER past - wins AS BIGINT) AS prev_wins_count,
         CAST(sum(bidomatic_bids) OVER past - bidomatic_bids AS BIGINT) AS prev_bom_bid_count,
         CAST(sum(bids) OVER past - bids AS BIGINT) AS prev_bid_count,
         row_number() OVER (PARTITION BY username ORDER BY auctiontime, auctionid) - 1 AS prev_auction_count
  FROM roll WINDOW past AS (PARTITION BY username ORDER BY auctiontime)""",
    "uni": """
  SELECT bt.*, greatest(prev_auction_count, 1) AS prev_auction_count,
         CAST(prev_auction_count = 0 AS INTEGER) AS prev_is_new_user,
         prev_overbid_count AS prev_overbid, prev_giveup_one_count AS prev_giveup_one,
         prev_giveup_before_six_count AS prev_giveup_before_six, prev_wins_count AS prev_wins,
         prev_bid_count AS prev_bids, prev_bom_bid_count AS prev_bom_bids
  FROM bt JOIN hist USING (auctionid, username)""",
    "pairs": """
  SELECT n.auctionid, n.bid, p.username AS p_username, max(p.bid) AS max_bid
  FROM bids n JOIN bids p ON n.auctionid = p.auctionid AND p.bid < n.bid AND p.username <> n.username
  GROUP BY n.auctionid, n.bid, p.username""",
    "places": """
  SELECT *, row_number() OVER (PARTITION BY auctionid, bid ORDER BY max_bid DESC) AS place FROM pairs""",
    "opp": """
  SELECT q.auctionid, q.bid, q.place, q.bid - q.max_bid AS distance, q.p_username, """
    + ", ".join(f"p.{c} AS p_{c}" for c in PLAIN)
    + """, p.prev_is_new_user AS p_new, p.prev_auction_count AS p_count, """
    + ", ".join(f"CAST(p.{src} AS DOUBLE) / p.prev_auction_count AS p_{out}" for out, src in HISTORY)
    + """
  FROM places q JOIN uni p ON p.auctionid = q.auctionid AND p.bid = q.max_bid WHERE q.place <= 4""",
    "wide": "\n  SELECT "
    + ", ".join(f"any_value(m.{c}) AS {c}" if c not in ("auctionid", "bid") else f"m.{c}" for c in BASE_COLUMNS)
    + ",\n  "
    + _wide()
    + "\n  FROM uni m LEFT JOIN opp o ON o.auctionid = m.auctionid AND o.bid = m.bid GROUP BY m.auctionid, m.bid",
    "full_table": "SELECT * FROM wide WHERE distance0 IS NULL OR distance0 = 1",
    "scored": """
  SELECT auctionid, bid, username, is_winner, cashvalue, fee, is_bidomatic, auctiontime, cardtype, cardvalue,
         bidvalue, limited_allowed, ((auctionid * 31 + bid * 17) % 100) / 100.0e0 AS prob FROM bt""",
    "valued": """
  SELECT *, cashvalue - fee - bid / 100.0e0 - 0.4e0 AS potential,
         CAST(is_winner AS INTEGER) * (cashvalue - fee - bid / 100.0e0) - 0.4e0 AS actual FROM scored""",
    "ev": "SELECT *, prob * potential - (1.0e0 - prob) * 0.4e0 AS ep FROM valued",
}
NEEDS = {
    "kept": [], "bids": ["kept"], "auctions": ["kept"], "numbered": ["bids", "auctions"], "bt": ["numbered"],
    "roll": ["bt"], "hist": ["roll"], "uni": ["bt", "hist"], "pairs": ["bids"], "places": ["pairs"],
    "opp": ["places", "uni"], "wide": ["uni", "opp"], "full_table": ["wide"], "scored": ["bt"], "valued": ["scored"],
    "ev": ["valued"],
}


def _closure(names: list[str], extra: dict[str, str]) -> list[str]:
    order = list(CTES)
    wanted, stack = set(), list(names)
    while stack:
        name = stack.pop()
        if name not in wanted:
            wanted.add(name)
            stack += NEEDS[name]
    return [n for n in order if n in wanted]


def sql(body: str, *needs: str, **extra: str) -> str:
    """A statement over the derived tables it needs; `extra` adds own CTEs."""
    parts = [f"{n} AS ({CTES[n]})" for n in _closure(list(needs), extra)]
    parts += [f"{n} AS ({text})" for n, text in extra.items()]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body


def shuffled(seed: int) -> str:
    """The pseudo-random number of a bid: the first 60 bits of an MD5 digest."""
    return f"CAST('0x' || substr(md5(concat_ws(',', auctionid, bid, {seed})), 1, 15) AS BIGINT)"


def day_times(statement: str) -> str:
    """The same statement over auctions whose end times are cut to the day."""
    return statement.replace(" last_ts AS auctiontime", " date_trunc('day', last_ts)::TIMESTAMP AS auctiontime")
