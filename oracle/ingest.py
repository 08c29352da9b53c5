from oracle.base import sql
from oracle.joins import SNAP

STATEMENTS = {
    "s01_scan": "SELECT p_partkey, p_brand, p_size FROM part WHERE p_size > 25",
    "s02_csv_round_trip": sql("SELECT * FROM auctions", "auctions"),
    "s03_documents": sql(
        "SELECT qauctionid, cardtype, cashvalue, lock_price FROM auctions WHERE auctiontime >= '2024-01-10'", "auctions"
    ),
    "s04_store_pages": sql(
        """SELECT CAST(qauctionid AS VARCHAR) AS auction_id, cardtype AS auction_group FROM auctions
WHERE auctiontime >= '2024-01-10' AND limited_allowed""",
        "auctions",
    ),
    "s05_append": sql("SELECT * FROM bt", "bt"),
    "s06_incremental": sql("SELECT * FROM full_table", "full_table"),
    "s07_modulo_batch": sql("SELECT * FROM bids WHERE auctionid % 10 = 3", "bids"),
    "s08_snapshot_saved": sql("SELECT username, prev_auction_count0 FROM snap", "full_table", snap=SNAP),
    "s09_purge": sql(
        "SELECT bids.* FROM bids JOIN auctions ON auctionid = qauctionid WHERE auctiontime > '2024-01-10'", "bids", "auctions"
    ),
}
