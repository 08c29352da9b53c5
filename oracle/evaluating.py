from oracle.base import sql

BETS = """CAST(count(*) FILTER (WHERE is_winner) AS BIGINT) AS winners, count(*) AS bets, round(sum(ep), 6) AS ep,
round(sum(actual), 6) AS actual FROM ev WHERE ep > 0"""


# Profits are summed in whole cents and rounded in whole numbers, so no sum depends on the order of rows.
CENTS = "(CASE WHEN is_winner THEN cashvalue * 100 - CAST(round(fee * 100) AS BIGINT) - bid ELSE 0 END - 40)"


def _exact(num: str, den: str) -> str:
    return f"(sign({num}) * ((abs({num})::HUGEINT * 2000000 + ({den})::HUGEINT) // nullif(({den})::HUGEINT * 2, 0))::DOUBLE / 1e6)"


def _sweep(first: int, last: int, op: str) -> str:
    return sql(
        f"""SELECT thresh, tn, fp, fn, tp, round((tp + tn) * 100 / total, 6) AS accuracy,
round(tp * 100 / nullif(tp + fp, 0), 6) AS precision, round(tp * 100 / nullif(tp + fn, 0), 6) AS recall,
{_exact("profit", "100")} AS profit, {_exact("profit", "(tp + fp) * 100")} AS profit_per_bet, {_exact("profit", "total * 100")} AS profit_per_row
FROM (SELECT t.k / 20.0e0 AS thresh, count(*) AS total,
  CAST(count(*) FILTER (WHERE NOT prob {op} t.k / 20.0e0 AND NOT is_winner) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE prob {op} t.k / 20.0e0 AND NOT is_winner) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE NOT prob {op} t.k / 20.0e0 AND is_winner) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE prob {op} t.k / 20.0e0 AND is_winner) AS BIGINT) AS tp,
  coalesce(sum({CENTS})
    FILTER (WHERE prob {op} t.k / 20.0e0), 0) AS profit
 FROM scored, range({first}, {last + 1}) t(k) GROUP BY t.k)""",
        "scored",
    )


BANDS = "(0, 5.7e0), (5.7e0, 9.7e0), (9.7e0, 19.7e0), (19.7e0, 40), (40, 62), (62, 100), (100, 200)"

STATEMENTS = {
    "e01_profits": sql("SELECT auctionid, bid, round(potential, 6) AS potential, round(actual, 6) AS actual FROM valued", "valued"),
    "e02_expected_value": sql("SELECT auctionid, bid, round(ep, 6) AS ep, ep > 0 AS bet FROM ev", "ev"),
    "e02_strategy_profit": sql(
        """SELECT round(sum(actual) FILTER (WHERE ep > 0), 6) AS profit, CAST(count(*) FILTER (WHERE ep > 0) AS BIGINT) AS bets,
count(*) AS n FROM ev""",
        "ev",
    ),
    "e03_threshold_sweep": _sweep(8, 22, ">="),
    "e03_threshold_sweep_strict": _sweep(10, 19, ">"),
    "e03_sweep_winners": sql(
        """SELECT cashvalue, t.k / 20.0e0 AS thresh, count(*) AS winners FROM scored, range(8, 23) t(k)
WHERE is_winner AND prob >= t.k / 20.0e0 GROUP BY cashvalue, t.k""",
        "scored",
    ),
    "e03_sweep_every_probability": sql(
        f"""SELECT thresh, tn, fp, fn, tp, {_exact("profit", "100")} AS profit, {_exact("profit", "(tp + fp) * 100")} AS profit_per_bet
FROM (SELECT p.prob AS thresh,
CAST(count(*) FILTER (WHERE s.prob < p.prob AND NOT is_winner) AS BIGINT) AS tn,
CAST(count(*) FILTER (WHERE s.prob >= p.prob AND NOT is_winner) AS BIGINT) AS fp,
CAST(count(*) FILTER (WHERE s.prob < p.prob AND is_winner) AS BIGINT) AS fn,
CAST(count(*) FILTER (WHERE s.prob >= p.prob AND is_winner) AS BIGINT) AS tp,
sum({CENTS}) FILTER (WHERE s.prob >= p.prob) AS profit
FROM (SELECT DISTINCT prob FROM scored WHERE prob > 0.4e0) p, scored s GROUP BY p.prob)""",
        "scored",
    ),
    "e03_label_above_cutoffs": sql(
        """SELECT CAST(t.k AS BIGINT) AS cutoff, CAST(count(*) FILTER (WHERE is_winner AND prob * 100 > t.k) AS BIGINT) AS winners
FROM scored, range(0, 100) t(k) GROUP BY t.k""",
        "scored",
    ),
    "e04_ev_bins": sql(
        """SELECT t.k / 10.0e0 AS bin, count(*) AS n, round(avg(actual), 6) AS mean_actual,
CAST(count(*) FILTER (WHERE is_winner) AS BIGINT) AS wins, round(avg(CAST(is_winner AS INTEGER)), 6) AS win_rate
FROM ev, range(-5, 100) t(k) WHERE is_bidomatic AND ep > t.k / 10.0e0 AND ep <= (t.k + 1) / 10.0e0 GROUP BY t.k""",
        "ev",
    ),
    "e05_ev_curve": sql(
        """SELECT (2 * t.k + 1) / 20.0e0 AS middle, count(*) AS n, round(avg(actual), 6) AS mean_actual
FROM ev, range(-10, 10) t(k) WHERE ep > t.k / 10.0e0 AND ep < (2 * t.k + 1) / 20.0e0 GROUP BY t.k""",
        "ev",
    ),
    "e06_ev_chunk_totals": sql(
        """SELECT CAST(count(*) AS BIGINT) AS bets, round(sum(actual), 6) AS profit, round(sum(actual) / count(*), 6) AS profit_per_bet
FROM bets WHERE ep >= (SELECT min(ep) FROM bounds) AND ep < (SELECT max(ep) FROM bounds)""",
        "ev",
        bets="SELECT ep, actual FROM ev WHERE ep > 0",
        bounds="""SELECT ep FROM (SELECT ep, row_number() OVER (ORDER BY ep) - 1 AS place FROM bets) WHERE place % 1000 = 0""",
    ),
    "e07_best_threshold": sql(
        f"""SELECT low, high, p, profit / 100e0 AS profit FROM (SELECT *, row_number() OVER (PARTITION BY low, high ORDER BY profit DESC, p) AS place FROM
(SELECT CAST(b.low AS DOUBLE) AS low, CAST(b.high AS DOUBLE) AS high, t.k / 100.0e0 AS p,
        coalesce(sum({CENTS}) FILTER (WHERE prob > t.k / 100.0e0), 0) AS profit
 FROM range(0, 100) t(k), bands b LEFT JOIN valued v ON v.potential > b.low AND v.potential < b.high GROUP BY b.low, b.high, t.k))
WHERE place = 1""",
        "valued",
        bands=f"SELECT * FROM (VALUES {BANDS}) x(low, high)",
    ),
    "e08_roc_points": sql(
        """SELECT p.prob AS thresh,
round(CAST(count(*) FILTER (WHERE s.prob >= p.prob AND NOT is_winner) AS DOUBLE) / count(*) FILTER (WHERE NOT is_winner), 6) AS fpr,
round(CAST(count(*) FILTER (WHERE s.prob >= p.prob AND is_winner) AS DOUBLE) / count(*) FILTER (WHERE is_winner), 6) AS tpr
FROM (SELECT DISTINCT prob FROM scored) p, scored s GROUP BY p.prob""",
        "scored",
    ),
    "e08_roc_auc": sql(
        """SELECT round(avg(CASE WHEN w.prob > l.prob THEN 1e0 WHEN w.prob = l.prob THEN 0.5e0 ELSE 0e0 END), 6) AS auc
FROM scored w, scored l WHERE w.is_winner AND NOT l.is_winner""",
        "scored",
    ),
    "e09_ev_confusion": sql(
        """SELECT count(*) AS n, CAST(count(*) FILTER (WHERE ep > 0) AS BIGINT) AS bets,
CAST(count(*) FILTER (WHERE actual > 0 AND ep > 0) AS BIGINT) AS won_bets, CAST(count(*) FILTER (WHERE actual > 0 AND ep < 0) AS BIGINT) AS missed,
CAST(count(*) FILTER (WHERE actual < 0 AND ep > 0) AS BIGINT) AS lost_bets, CAST(count(*) FILTER (WHERE actual < 0 AND ep < 0) AS BIGINT) AS avoided
FROM ev""",
        "ev",
    ),
    "e10_bets_by_bid": sql(f"SELECT bid, {BETS} GROUP BY bid", "ev"),
    "e10_bets_by_hour": sql(f"SELECT CAST(hour(auctiontime) AS INTEGER) AS hour, {BETS} GROUP BY hour(auctiontime)", "ev"),
    "e10_bets_by_day": sql(f"SELECT CAST(day(auctiontime) AS INTEGER) AS day, {BETS} GROUP BY day(auctiontime)", "ev"),
    "e10_bets_by_product": sql(f"SELECT cardtype, cardvalue, bidvalue, {BETS} GROUP BY cardtype, cardvalue, bidvalue", "ev"),
    "e10_bets_of_a_type_by_outcome": sql(f"SELECT is_winner, {BETS} AND cardtype = 'Brand#1' GROUP BY is_winner", "ev"),
    "e11_daily_profit": sql(
        f"SELECT CAST(CAST(auctiontime AS DATE) AS VARCHAR) AS date, {BETS} GROUP BY CAST(auctiontime AS DATE)", "ev"
    ),
    "e12_live_validation": sql(
        """SELECT username, count(*) AS n, round(sum((cashvalue - fee - bid / 100.0e0) * prob - 0.4e0), 6) AS batch_ev,
round(sum((cashvalue - fee - bid / 100.0e0) * CASE WHEN is_bidomatic THEN (bid * 7) % 100 / 100.0e0
ELSE (bid * 3) % 100 / 100.0e0 END - 0.4e0), 6) AS live_ev,
round(sum(CASE WHEN is_winner THEN cashvalue - fee - bid / 100.0e0 ELSE -0.4e0 END), 6) AS actual
FROM scored GROUP BY username""",
        "scored",
    ),
    "e13_next_bid_value": sql(
        """SELECT auctionid, CAST(bid AS INTEGER) AS bid, round(pot, 6) AS potential_profit,
round(bp * pot - (1e0 - bp) * 0.4e0, 6) AS bom_ev, round(mp * pot - (1e0 - mp) * 0.4e0, 6) AS manual_ev FROM
(SELECT auctionid, bid + 1 AS bid, cashvalue - fee - (bid + 1) / 100.0e0 - 0.4e0 AS pot,
 ((bid + 1) * 7) % 100 / 100.0e0 AS bp, ((bid + 1) * 3) % 100 / 100.0e0 AS mp FROM bt WHERE is_winner)""",
        "bt",
    ),
    "e14_predicted_rates": sql(
        """SELECT is_bidomatic, prob > 0.6e0 AS predicted, count(*) AS n, round(avg(CAST(is_winner AS INTEGER)), 6) AS win_rate
FROM scored GROUP BY ALL""",
        "scored",
    ),
}
