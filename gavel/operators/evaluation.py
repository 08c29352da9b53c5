"""Expected value, profit and calibration reports over scored rows.

Sweeps over thresholds or bins first place each row on the grid, aggregate once
per grid cell, and then run totals over the few cells. No row is compared with
every threshold. Where a report needs the cells more than once they are written
to a working table, so the scored rows are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.functions import scalar
from gavel.functions.scalar import BID_CENTS, BID_COST, grid_below
from gavel.operators.blocks import double_blocks, running
from gavel.operators.exploration import rounded
from gavel.session import written

# Bands of potential profit for the best-threshold report.
PROFIT_BANDS = [(0.0, 5.7), (5.7, 9.7), (9.7, 19.7), (19.7, 40.0), (40.0, 62.0), (62.0, 100.0), (100.0, 200.0)]


def profits(scored: DataFrame) -> DataFrame:
    """Add the profit if the bid wins, and the profit it made."""
    args = (F.col("cashvalue"), F.col("fee"), F.col("bid"))
    return scored.withColumns(
        {
            "potential": scalar.potential_profit(*args),
            "actual": scalar.actual_profit(F.col("is_winner"), *args),
        }
    )


def expected(scored: DataFrame) -> DataFrame:
    """Add profits and the expected value `ep` of the bid."""
    return profits(scored).withColumn("ep", scalar.expected_value(F.col("prob"), F.col("potential")))


def strategy_profit(scored: DataFrame) -> DataFrame:
    bet = F.col("ep") > 0
    return expected(scored).agg(
        rounded(F.sum(F.when(bet, F.col("actual")))).alias("profit"),
        F.sum(bet.cast("int")).alias("bets"),
        F.count("*").alias("n"),
    )


def _suffix_totals(cells: DataFrame, by: list[str], cell: str, names: list[str]) -> DataFrame:
    """Totals over this cell and all higher ones; the cells are few."""
    above = Window.partitionBy(*by).orderBy(F.desc(cell)).rowsBetween(Window.unboundedPreceding, 0)
    return cells.select(*by, cell, *[F.sum(n).over(above).alias(n) for n in names])


def _grid(spark, cell: str, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").alias(cell))


def _won_cents() -> Column:
    """What the won bids bring, in whole cents."""
    gain = scalar.gain_cents(F.col("cashvalue"), F.col("fee"), F.col("bid"))
    return F.sum(F.when(F.col("is_winner"), gain).otherwise(0))


def _sweep_cells(scored: DataFrame, step: int, first: int, last: int, by: list[str], strict: bool) -> DataFrame:
    """Sums per threshold cell: rows whose highest passed threshold is `cell`."""
    cell = grid_below(F.col("prob"), step, strict) - 1
    cell = F.when(cell < first, F.lit(first - 1)).otherwise(F.least(cell, F.lit(last))).cast("long")
    won = F.col("is_winner").cast("int")
    return scored.groupBy(*by, cell.alias("cell")).agg(
        F.count("*").alias("n"),
        F.sum(won).alias("won"),
        _won_cents().alias("gain"),
    )


def threshold_sweep(scored: DataFrame, step: int = 20, first: int = 8, last: int = 22, strict: bool = False) -> DataFrame:
    """Confusion counts, scores and profit at thresholds first/step..last/step.

    A row is predicted positive at probability >= threshold (> when strict).
    """
    cells = written(_sweep_cells(scored, step, first, last, [], strict), "cells")
    totals = cells.agg(F.sum("n").alias("all_n"), F.sum("won").alias("all_won"))
    grid = _grid(scored.sparkSession, "cell", first, last)
    passed = _suffix_totals(
        grid.join(cells, "cell", "left").na.fill(0), [], "cell", ["n", "won", "gain"]
    )
    n, tp = F.col("n"), F.col("won")
    fp = n - tp
    all_n, all_won = totals.select("all_n").scalar(), totals.select("all_won").scalar()
    fn = all_won - tp
    tn = all_n - n - fn
    profit = F.col("gain") - n * F.lit(BID_CENTS)
    return passed.select(
        (F.col("cell") / F.lit(float(step))).alias("thresh"),
        tn.alias("tn"),
        fp.alias("fp"),
        fn.alias("fn"),
        tp.alias("tp"),
        rounded((tp + tn) * 100 / all_n).alias("accuracy"),
        rounded(scalar.ratio(tp * 100, n)).alias("precision"),
        rounded(scalar.ratio(tp * 100, all_won)).alias("recall"),
        scalar.exact_ratio(profit, F.lit(100)).alias("profit"),
        scalar.exact_ratio(profit, n * 100).alias("profit_per_bet"),
        scalar.exact_ratio(profit, all_n * 100).alias("profit_per_row"),
    )


def sweep_winners(scored: DataFrame, step: int = 20, first: int = 8, last: int = 22) -> DataFrame:
    """Winners caught at each threshold, per cash value."""
    cells = written(_sweep_cells(scored.where("is_winner"), step, first, last, ["cashvalue"], False), "cells")
    values = cells.select("cashvalue").distinct()
    full = values.withColumn("cell", F.explode(F.sequence(F.lit(first), F.lit(last)).cast("array<long>")))
    caught = _suffix_totals(
        full.join(cells, ["cashvalue", "cell"], "left").na.fill(0), ["cashvalue"], "cell", ["won"]
    )
    return caught.where(F.col("won") > 0).select(
        "cashvalue", (F.col("cell") / F.lit(float(step))).alias("thresh"), F.col("won").alias("winners")
    )


def sweep_every_probability(scored: DataFrame, above: float = 0.4) -> DataFrame:
    """The sweep at every distinct probability above a floor (>=).

    Rows are first summed per distinct probability; the totals from the top run
    in blocks of probability, so many distinct values stay spread out.
    """
    won = F.col("is_winner").cast("long")
    points = scored.groupBy("prob").agg(
        F.count("*").alias("n"),
        F.sum(won).alias("won"),
        _won_cents().alias("gain"),
    )
    points = written(points, "points")
    down, blocks = double_blocks(points.withColumn("below", -F.col("prob")), F.col("below"), "below")
    measures = {f"{c}_up": F.col(c) for c in ("n", "won", "gain")}
    totals = running(down, [], blocks, ["below"], measures)
    all_n = points.select(F.sum("n")).scalar()
    all_won = points.select(F.sum("won")).scalar()
    n, tp = F.col("n_up"), F.col("won_up")
    profit = F.col("gain_up") - n * F.lit(BID_CENTS)
    return totals.where(F.col("prob") > above).select(
        F.col("prob").alias("thresh"),
        (all_n - n - (all_won - tp)).alias("tn"),
        (n - tp).alias("fp"),
        (all_won - tp).alias("fn"),
        tp.alias("tp"),
        scalar.exact_ratio(profit, F.lit(100)).alias("profit"),
        scalar.exact_ratio(profit, n * 100).alias("profit_per_bet"),
    )


def label_above_cutoffs(scored: DataFrame, value: Column, first: int = 0, last: int = 99) -> DataFrame:
    """Sum of the label over rows with value > cutoff, for whole-number cutoffs."""
    cell = F.ceil(value) - 1
    cells = (
        scored.where(value > first)
        .groupBy(F.least(cell, F.lit(last)).cast("long").alias("cutoff"))
        .agg(F.sum(F.col("is_winner").cast("long")).alias("winners"))
    )
    grid = _grid(scored.sparkSession, "cutoff", first, last)
    return _suffix_totals(grid.join(cells, "cutoff", "left").na.fill(0), [], "cutoff", ["winners"])


def ev_bins(scored: DataFrame, first: int = -5, last: int = 99) -> DataFrame:
    """Bidomatic rows by EV bin (i/10, (i+1)/10]: count, mean profit, wins."""
    i = grid_below(F.col("ep"), 10, strict=True) - 1
    won = F.col("is_winner").cast("int")
    return (
        expected(scored)
        .where("is_bidomatic")
        .groupBy(i.alias("i"))
        .agg(
            F.count("*").alias("n"),
            rounded(F.avg("actual")).alias("mean_actual"),
            F.sum(won).alias("wins"),
            rounded(F.avg(won)).alias("win_rate"),
        )
        .where(F.col("i").between(first, last))
        .withColumn("bin", F.col("i") / F.lit(10.0))
        .drop("i")
    )


def ev_curve(scored: DataFrame, first: int = -10, last: int = 9) -> DataFrame:
    """Mean profit in the lower half of each EV bin of 0.1, open at both ends."""
    i = grid_below(F.col("ep"), 10, strict=True) - 1
    inside = (F.col("ep") > F.col("i") / F.lit(10.0)) & (F.col("ep") < (F.col("i") * 2 + 1) / F.lit(20.0))
    return (
        expected(scored)
        .withColumn("i", i)
        .where(F.col("i").between(first, last) & inside)
        .groupBy("i")
        .agg(F.count("*").alias("n"), rounded(F.avg("actual")).alias("mean_actual"))
        .select(((F.col("i") * 2 + 1) / F.lit(20.0)).alias("middle"), "n", "mean_actual")
    )


def ev_chunks(scored: DataFrame, size: int = 1000) -> DataFrame:
    """Bets sorted by EV in chunks of `size`: bounds and profit in [low, high).

    Bets are summed per distinct EV, so ties cost one row; running counts and
    profits over those values (in blocks) locate every chunk boundary.
    """
    bets = expected(scored).where(F.col("ep") > 0)
    points = bets.groupBy("ep").agg(F.count("*").alias("n"), F.sum("actual").alias("profit"))
    points, blocks = double_blocks(written(points, "points"), F.col("ep"), "ep")
    totals = running(points, [], blocks, ["ep"], {"upto": F.col("n"), "profit_upto": F.col("profit")})
    before = F.col("upto") - F.col("n")
    first_k = F.ceil(before / size).cast("long")
    last_k = F.floor((F.col("upto") - 1) / size).cast("long")
    bounds = totals.where(first_k <= last_k).select(
        F.explode(F.sequence(first_k, last_k)).alias("chunk"),
        F.col("ep").alias("bound"),
        (F.col("profit_upto") - F.col("profit")).alias("profit_below"),
        before.alias("n_below"),
    )
    following = bounds.select(
        (F.col("chunk") - 1).alias("chunk"),
        F.col("bound").alias("high"),
        F.col("profit_below").alias("profit_high"),
        F.col("n_below").alias("n_high"),
    )
    return bounds.join(following, "chunk").select(
        "chunk",
        F.col("bound").alias("low"),
        "high",
        (F.col("n_high") - F.col("n_below")).alias("bets"),
        rounded(F.col("profit_high") - F.col("profit_below")).alias("profit"),
    )


def chunk_totals(chunks: DataFrame) -> DataFrame:
    return chunks.agg(
        F.sum("bets").alias("bets"),
        rounded(F.sum("profit")).alias("profit"),
        rounded(scalar.ratio(F.sum("profit"), F.sum("bets"))).alias("profit_per_bet"),
    )


def best_threshold(scored: DataFrame, bands: list[tuple[float, float]] = PROFIT_BANDS) -> DataFrame:
    """Per band of potential profit: the probability cut with the highest profit.

    Cuts are 0, .01, ... .99 and a row counts above a cut; ties keep the lowest.
    """
    x = F.col("potential")
    band = F.lit(None).cast("int")
    for i, (low, high) in enumerate(bands):
        band = F.when((x > low) & (x < high), F.lit(i)).otherwise(band)
    cell = F.least(grid_below(F.col("prob"), 100, strict=True) - 1, F.lit(99)).cast("long")
    cells = (
        profits(scored)
        .withColumn("band", band)
        .where(F.col("band").isNotNull())
        .groupBy("band", cell.alias("cell"))
        .agg((_won_cents() - F.count("*") * BID_CENTS).alias("profit"))
    )
    spark = scored.sparkSession
    edges = spark.createDataFrame(
        [(i, float(low), float(high)) for i, (low, high) in enumerate(bands)], "band int, low double, high double"
    )
    grid = edges.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(99)).cast("array<long>")))
    sums = _suffix_totals(
        grid.join(cells, ["band", "cell"], "left").na.fill(0, ["profit"]), ["low", "high"], "cell", ["profit"]
    )
    best = Window.partitionBy("low", "high").orderBy(F.desc("profit"), "cell")
    return (
        sums.withColumn("place", F.row_number().over(best))
        .where(F.col("place") == 1)
        .select("low", "high", (F.col("cell") / F.lit(100.0)).alias("p"), scalar.exact_ratio(F.col("profit"), F.lit(100)).alias("profit"))
    )


def roc_points(scored: DataFrame) -> DataFrame:
    """False and true positive rate at every distinct probability, from the top."""
    won = F.col("is_winner").cast("long")
    points = scored.groupBy("prob").agg(F.sum(won).alias("pos"), F.sum(1 - won).alias("neg"))
    points = written(points, "points")
    down, blocks = double_blocks(points.withColumn("below", -F.col("prob")), F.col("below"), "below")
    totals = running(down, [], blocks, ["below"], {"tp": F.col("pos"), "fp": F.col("neg")})
    all_pos = points.select(F.sum("pos")).scalar()
    all_neg = points.select(F.sum("neg")).scalar()
    return totals.select(
        F.col("prob").alias("thresh"),
        scalar.ratio(F.col("fp"), all_neg).alias("fpr"),
        scalar.ratio(F.col("tp"), all_pos).alias("tpr"),
        "pos",
        "neg",
        "tp",
        "fp",
    )


def roc_auc(scored: DataFrame) -> DataFrame:
    """Area under the curve: each step adds a trapezoid."""
    area = F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2.0))
    return roc_points(scored).agg(
        rounded(scalar.ratio(F.sum(area), F.max("tp").cast("double") * F.max("fp"))).alias("auc")
    )


def ev_confusion(scored: DataFrame) -> DataFrame:
    """Positive expected value against positive actual profit."""
    up, bet, no_bet = F.col("actual") > 0, F.col("ep") > 0, F.col("ep") < 0
    down = F.col("actual") < 0

    def count(cond: Column) -> Column:
        return F.sum(cond.cast("int"))

    return expected(scored).agg(
        F.count("*").alias("n"),
        count(bet).alias("bets"),
        count(up & bet).alias("won_bets"),
        count(up & no_bet).alias("missed"),
        count(down & bet).alias("lost_bets"),
        count(down & no_bet).alias("avoided"),
    )


def bet_totals(scored: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Winners, expected and actual profit of the bets, per key."""
    return (
        expected(scored)
        .where(F.col("ep") > 0)
        .groupBy(*[c.alias(n) for n, c in keys.items()])
        .agg(
            F.sum(F.col("is_winner").cast("int")).alias("winners"),
            F.count("*").alias("bets"),
            rounded(F.sum("ep")).alias("ep"),
            rounded(F.sum("actual")).alias("actual"),
        )
    )


def predicted_rates(scored: DataFrame, keys: list[str], cut: float = 0.6) -> DataFrame:
    """Group rates with a yes/no prediction at a probability cut."""
    return (
        scored.withColumn("predicted", F.col("prob") > cut)
        .groupBy(*keys, "predicted")
        .agg(F.count("*").alias("n"), rounded(F.avg(F.col("is_winner").cast("int"))).alias("win_rate"))
    )


def live_check(batch: DataFrame, live: DataFrame) -> DataFrame:
    """Live-stored expected value against the one from the batch row.

    The live side holds both scenarios; the batch row says which one happened.
    Bids without a batch row are skipped.
    """
    gain = F.col("cashvalue") - F.col("fee") - F.col("bid") / F.lit(100.0)
    chosen = F.when(F.col("is_bidomatic"), F.col("bom_proba")).otherwise(F.col("manual_proba"))
    return live.join(batch, ["auctionid", "bid"]).select(
        "auctionid",
        "bid",
        (gain * F.col("prob") - F.lit(BID_COST)).alias("batch_ev"),
        (gain * chosen - F.lit(BID_COST)).alias("live_ev"),
        F.when(F.col("is_winner"), gain).otherwise(F.lit(-BID_COST)).alias("actual"),
    )


def column_diff(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Every cell in which two versions of a row differ, one line per cell."""
    pairs = left.select(*keys, *[F.col(c).cast("string").alias(f"l_{c}") for c in columns]).join(
        right.select(*keys, *[F.col(c).cast("string").alias(f"r_{c}") for c in columns]), keys
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"l_{c}").alias("left"), F.col(f"r_{c}").alias("right"))
            for c in columns
        ]
    )
    return pairs.select(*keys, F.inline(cells)).where(~F.col("left").eqNullSafe(F.col("right")))


def live_expected(features: DataFrame) -> DataFrame:
    """Expected value of the next bid, placed by the bidomatic or by hand."""
    potential = scalar.potential_profit(F.col("cashvalue"), F.col("fee"), F.col("bid"))
    return features.withColumn("potential_profit", potential).withColumns(
        {
            "bom_ev": scalar.expected_value(F.col("bom_proba"), F.col("potential_profit")),
            "manual_ev": scalar.expected_value(F.col("manual_proba"), F.col("potential_profit")),
        }
    )
