"""The win model: preparation, fitting, calibration, importances."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from gavel.catalog.tables import MIDWAY, Tables
from gavel.model import win_model as wm
from gavel.operators import evaluation as ev
from gavel.operators import exploration as x
from gavel.operators.bid_features import has_long
from gavel.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from gavel.session import written
from gavel.streaming.live import scenarios

KEY = ["auctionid", "bid"]
TREES, DEPTH = 20, 6
FLAGS = [c for c in CATEGORICAL_FEATURES if c[-1].isdigit()]
USER_FEATURES = [
    "avg_debut", "avg_cashvalue", "avg_perc_to_bin", "g_avg_bid", "g_bom_bid_avg", "g_bom_streak_avg", "profit_avg",
]


def modelled(t: Tables):
    """Feature rows to model, written once so that fitting does not rebuild them."""
    if has_long(t.bids):
        return written(wm.model_rows(written(t.full, "auction_full")), "model_rows")
    return written(wm.model_rows(t.full, together=True), "model_rows")


def fitted(rows, categories=None, ratio: float = 0.5):
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=17)
    return wm.WinModel(forest, sampling_ratio=ratio).fit(rows, categories)


def split_by_time(t: Tables):
    """All rows to model, the earlier auctions' to fit on and the later ones' to score."""
    rows = modelled(t)
    split = wm.time_split(rows, MIDWAY, "2024-02-01")
    return rows, *[split.where(F.col("split") == part).drop("split") for part in ("train", "test")]


def scores(t: Tables):
    """Calibrated probabilities of a forest trained on the earlier auctions."""
    rows, earlier, later = split_by_time(t)
    return fitted(earlier, rows).score(later).select(*KEY, "prob", "predicted")


def scored_rows(t: Tables):
    """Per later auction its rows with a score, and how many are probabilities."""
    return scores(t).groupBy("auctionid").agg(
        F.count("*").alias("n"), F.count_if(F.col("prob").between(0, 1)).alias("n_probabilities")
    )


def encoded(t: Tables):
    """The nearest opponent's type one-hot encoded, first category dropped."""
    plain = written(t.plain.select("auctionid", "bid", "cardvalue", "auctiontime", *FLAGS), "plain")
    rows = wm.impute(wm.model_features(plain), [], ["is_bidomatic0"])
    index, hot, _ = wm.encoder_stages(["is_bidomatic0"], [])
    out = Pipeline(stages=[index, hot]).fit(rows).transform(rows)
    codes = vector_to_array("is_bidomatic0_hot")
    # Codes run in descending order of the category.
    return out.select(*KEY, codes[0].cast("int").alias("type_true"), codes[1].cast("int").alias("type_none"))


def assembled(t: Tables):
    rows = wm.impute(wm.model_features(modelled(t)))
    out = Pipeline(stages=wm.encoder_stages()).fit(rows).transform(rows)
    return out.select(*KEY, vector_to_array("features").alias("features"))


def undersampled(t: Tables):
    return wm.undersample(t.scored, "is_winner", 0.5, KEY).select(*KEY, "is_winner")


def undersample_size(t: Tables):
    """How many of each outcome the exact undersampling keeps."""
    return wm.undersample(t.scored, "is_winner", 0.5, KEY).groupBy("is_winner").agg(F.count("*").alias("n"))


def calibrated(t: Tables):
    """Pseudo-probabilities calibrated with the rates of the table."""
    won = F.col("is_winner").cast("int")
    t_rate = t.scored.select(F.avg(won)).scalar()
    kept = t.scored.select(F.sum(won) / (F.sum(won) / F.lit(0.5) + F.sum(won))).scalar()
    return t.scored.select(*KEY, x.rounded(wm.calibrate(F.col("prob"), t_rate, kept)).alias("prob"))


def scenario_scores(t: Tables):
    rows, earlier, later = split_by_time(t)
    scored = fitted(earlier, rows).score(scenarios(later))
    return scored.groupBy(*KEY).agg(
        F.max(F.when(F.col("is_bidomatic"), F.col("prob"))).alias("bom_proba"),
        F.max(F.when(~F.col("is_bidomatic"), F.col("prob"))).alias("manual_proba"),
    )


def importances(t: Tables):
    rows, earlier, _ = split_by_time(t)
    return wm.feature_importances(fitted(earlier, rows), rows)


def permuted(t: Tables):
    """Importances on auctions that the model has not seen."""
    rows, earlier, later = split_by_time(t)
    return wm.permutation_importance(fitted(earlier, rows), later)


def shuffled_sums(t: Tables):
    """A shuffled column keeps its values: counts per value, before the model."""
    return wm.shuffled_column(t.scored.select(*KEY, "cashvalue"), "cashvalue", KEY, 7).groupBy("cashvalue").agg(
        F.count("*").alias("n"), F.count_distinct("auctionid", "bid").alias("rows")
    )


def user_clusters(t: Tables):
    profile = x.user_profile(t.transform).na.fill(0)
    rows = VectorAssembler(inputCols=USER_FEATURES, outputCol="features").transform(profile)
    model = KMeans(k=5, seed=17, featuresCol="features", predictionCol="cluster").fit(rows)
    return model.transform(rows).select("username", "win_perc", "cluster", *USER_FEATURES)


def cluster_means(t: Tables):
    return x.group_means(user_clusters(t), ["cluster"], ["win_perc", *USER_FEATURES])


def profit_regression(t: Tables):
    rows, earlier, later = [wm.impute(wm.model_features(ev.profits(part))) for part in split_by_time(t)]
    encoder = Pipeline(stages=wm.encoder_stages()).fit(rows)
    forest = RandomForestRegressor(numTrees=TREES, maxDepth=DEPTH, seed=17, labelCol="actual")
    return forest.fit(encoder.transform(earlier)).transform(encoder.transform(later)).select(*KEY, "actual", "prediction")


def feed_forward(t: Tables):
    """Two hidden layers of 30 (sigmoid units; the output layer is softmax)."""
    label = F.col("is_winner").cast("double")
    rows, earlier, later = [wm.impute(wm.model_features(part)).withColumn("label", label) for part in split_by_time(t)]
    encoder = Pipeline(stages=wm.encoder_stages()).fit(rows)
    sample = wm.undersample(earlier, "is_winner", 0.5, KEY)
    width = len(wm.feature_names(encoder, rows))
    net = MultilayerPerceptronClassifier(layers=[width, 30, 30, 2], maxIter=30, seed=17)
    model = net.fit(encoder.transform(sample).select("features", "label"))
    return model.transform(encoder.transform(later)).select(*KEY, vector_to_array("probability")[1].alias("prob"))


def model_saved(t: Tables):
    """Scores of a model that was saved and loaded, next to the original's: both score a row where it is read."""
    (rows, earlier, later), path = split_by_time(t), t.folder("model")
    model = fitted(earlier, rows)
    model.save(path)
    again = wm.WinModel.load(t.spark, path)
    loaded = again.score(later).withColumnRenamed("prob", "loaded").drop("predicted")
    return model.score(loaded).select(*KEY, "loaded", F.col("prob").alias("fitted"))


QUERIES = {
    "m01_impute_numbers": lambda t: wm.impute(wm.model_features(t.full), categorical=[]).select(
        "auctionid", F.col("bid").cast("int").alias("bid"), *[x.rounded(F.col(c)).alias(f"x_{c}") for c in NUMERIC_FEATURES]
    ),
    "m02_impute_categories": lambda t: wm.impute(
        wm.model_features(t.plain.withColumn("cardtype", F.when(F.col("limited_allowed"), F.col("cardtype")))), numeric=[]
    ).select(*KEY, *CATEGORICAL_FEATURES),
    "m03_one_hot": encoded,
    "m04_assembled": assembled,
    "m05_undersample": undersampled,
    "m05_undersample_size": undersample_size,
    "m06_forest_scores": scores,
    "m06_scored_rows": scored_rows,
    "m07_calibrated": calibrated,
    "m08_scenario_scores": scenario_scores,
    "m09_feature_importances": importances,
    "m10_permutation_importance": permuted,
    "m10_shuffled_column": shuffled_sums,
    "m11_user_clusters": user_clusters,
    "m11_cluster_means": cluster_means,
    "m12_profit_regression": profit_regression,
    "m13_feed_forward": feed_forward,
    "m14_random_split": lambda t: wm.random_split(t.scored.select(*KEY), KEY),
    "m15_time_split": lambda t: wm.time_split(t.auctions, MIDWAY, "2024-01-20").select("qauctionid", "split"),
    "s08_model_saved": model_saved,
}
