from oracle.base import shuffled, sql

STATEMENTS = {
    "t01_order_by": sql("SELECT qauctionid, auctiontime FROM auctions ORDER BY auctiontime, qauctionid", "auctions"),
    "t02_head": sql("SELECT auctionid, bid, round(ep, 6) AS ep FROM ev ORDER BY 3 DESC, auctionid, bid LIMIT 25", "ev"),
    "t02_tail_of_head": sql(
        """SELECT bid, cashvalue, round(sum(actual), 6) AS actual FROM ev WHERE ep > 0 GROUP BY bid, cashvalue
ORDER BY bid, cashvalue LIMIT 50 OFFSET 50""",
        "ev",
    ),
    "t03_four_latest_opponents": sql(
        "SELECT auctionid, bid, p_username, max_bid, CAST(place - 1 AS INTEGER) AS position FROM places WHERE place <= 4", "places"
    ),
    "t04_scan_cap": sql("SELECT qauctionid FROM auctions ORDER BY qauctionid LIMIT 100", "auctions"),
    "t05_winners_and_some_losers": sql(
        f"""SELECT auctionid, bid, username, is_winner, cashvalue, fee, is_bidomatic, auctiontime, cardtype, cardvalue, bidvalue,
 limited_allowed, prob FROM scored WHERE is_winner OR {shuffled(17)} % 1000000 / 1000000e0 < 0.1e0""",
        "scored",
    ),
    "t06_new_ids": sql(
        """SELECT DISTINCT auctionid FROM bids WHERE auctionid NOT IN
(SELECT qauctionid FROM auctions WHERE auctiontime < '2024-01-10')""",
        "auctions",
        "bids",
    ),
}
