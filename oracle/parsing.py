from oracle.base import sql

FIELDS = """SELECT p_partkey, p_size, p_partkey % 6 AS kind, p_brand, p_size % 4 AS word,
  CAST(CASE p_partkey % 6 WHEN 0 THEN p_size + 10 WHEN 1 THEN p_size + 3 WHEN 2 THEN p_size + 1 WHEN 3 THEN p_size + 40
    WHEN 5 THEN p_size + 3 END AS INTEGER) AS cash,
  CAST(CASE p_size % 4 WHEN 0 THEN 30 WHEN 1 THEN 15 WHEN 2 THEN 60 END AS INTEGER) AS buster FROM part"""
TITLES = """SELECT p_partkey, p_size, kind,
  CASE WHEN kind <> 3 OR word < 3 THEN cash END AS cashvalue,
  CAST(CASE kind WHEN 0 THEN p_size WHEN 1 THEN p_size WHEN 5 THEN p_size WHEN 2 THEN 0 WHEN 3 THEN buster END AS INTEGER) AS cardvalue,
  CASE WHEN kind IN (0, 1, 5) THEN p_brand WHEN kind = 2 THEN 'None' WHEN kind = 3 AND word < 3 THEN 'Buster' END AS cardtype,
  CAST(CASE kind WHEN 0 THEN p_size * 2 WHEN 1 THEN 7 WHEN 5 THEN 9 WHEN 2 THEN p_size
    WHEN 3 THEN trunc((cash - buster) * 2.5e0) END AS INTEGER) AS bidvalue FROM fields"""
OLDER = """SELECT p_partkey, CASE WHEN kind IN (0, 1, 2, 5) THEN cash END AS cashvalue,
  CAST(CASE kind WHEN 0 THEN p_size WHEN 1 THEN p_size WHEN 5 THEN p_size WHEN 2 THEN 0 END AS INTEGER) AS cardvalue,
  CASE WHEN kind IN (0, 1, 5) THEN p_brand WHEN kind = 2 THEN 'None' END AS cardtype,
  CAST(CASE kind WHEN 0 THEN p_size * 2 WHEN 1 THEN 0 WHEN 5 THEN 0 WHEN 2 THEN p_size END AS INTEGER) AS bidvalue FROM fields"""
MISSING = """SELECT CAST(qauctionid AS VARCHAR) AS auction_id,
  CASE qauctionid % 4 WHEN 0 THEN bidvalue || ' Voucher Bids' WHEN 1 THEN 'The One Buster'
    ELSE '$' || (cardvalue + 5) || ' Gift Card' END AS title
FROM auctions WHERE qauctionid % 4 < 3 AND NOT limited_allowed
  AND qauctionid % 3 <> 0 AND CAST(auctiontime AS DATE) >= '2020-01-01' AND date_diff('day', CAST(auctiontime AS DATE), DATE '2024-01-25') > 1
UNION ALL
SELECT CAST(qauctionid AS VARCHAR), CASE qauctionid % 4 WHEN 0 THEN bidvalue || ' Voucher Bids' WHEN 1 THEN 'The One Buster'
    ELSE '$' || (cardvalue + 5) || ' Gift Card' END
FROM auctions WHERE qauctionid % 4 < 3 AND NOT limited_allowed AND qauctionid % 3 = 0"""
MESSAGES = """SELECT n.auctionid * 4294967296 + n.bid AS seq, CAST(n.auctionid AS VARCHAR) AS auction_id,
  CAST(n.bid - e.bid AS INTEGER) AS pos, e.bid, e.username, e.is_bidomatic
FROM bids n JOIN bids e ON e.auctionid = n.auctionid AND e.bid BETWEEN n.bid - 2 AND n.bid"""

STATEMENTS = {
    "p01_titles": sql("SELECT p_partkey, cashvalue, cardvalue, cardtype, bidvalue FROM titles", fields=FIELDS, titles=TITLES),
    "p01_titles_older": sql("SELECT * FROM older", fields=FIELDS, older=OLDER),
    "p02_auction_pages": sql(
        "SELECT qauctionid, cashvalue, cardvalue, bidvalue, cardtype, limited_allowed FROM auctions", "auctions"
    ),
    "p03_table_pages": sql(
        """SELECT qauctionid, tracking, CAST(date_trunc('second', auctiontime) AS TIMESTAMP) AS auctiontime, runtime,
nullif(lock_price, 0) AS lock_price FROM auctions""",
        "auctions",
    ),
    "p04_history_pages": sql("SELECT * FROM bids", "bids"),
    "p05_upcoming_pages": sql(
        """SELECT page_id, CAST(p_partkey AS VARCHAR) AS auctionid, cashvalue, cardvalue, cardtype, bidvalue, p_size % 2 = 0 AS limited_allowed,
CAST((p_size * 3 % 100) % 60 * 60 + p_size % 60 AS INTEGER) AS seconds_left FROM
(SELECT *, p_partkey // 20 AS page_id, bool_and(p_size * 3 < 100) OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) AS near
 FROM titles WHERE cashvalue IS NOT NULL) WHERE near""",
        fields=FIELDS,
        titles=TITLES,
    ),
    "p06_parse_new_only": sql(
        "SELECT qauctionid, cashvalue, cardtype FROM auctions WHERE auctiontime >= '2024-01-10'", "auctions"
    ),
    "p07_auction_ids": sql(
        "SELECT qauctionid // 50 AS page_id, CAST(qauctionid AS VARCHAR) AS auction_id FROM auctions", "auctions"
    ),
    "p08_missing_auctions": sql("SELECT * FROM missing", "auctions", missing=MISSING),
    "p08_missing_by_title": sql(
        "SELECT title, count(*) AS n FROM missing WHERE title NOT LIKE '$%' GROUP BY title", "auctions", missing=MISSING
    ),
    "p09_unwrap_messages": sql(
        "SELECT auctionid * 4294967296 + bid AS seq, CAST(auctionid AS VARCHAR) AS auction_id FROM bids", "bids"
    ),
    "p10_classify_messages": sql(
        """SELECT qauctionid AS seq, CAST(qauctionid AS VARCHAR) AS auction_id, CASE WHEN qauctionid % 6 = 0 THEN 'complete'
WHEN qauctionid % 6 = 1 THEN 'bids' WHEN qauctionid % 6 = 2 AND runtime % 40 BETWEEN 13 AND 29 THEN 'live' END AS kind FROM auctions""",
        "auctions",
    ),
    "p11_feed_bids": sql("SELECT * FROM messages", "bids", messages=MESSAGES),
    "p11_newest_bids": sql("SELECT * EXCLUDE (pos) FROM messages WHERE pos = 0", "bids", messages=MESSAGES),
}
