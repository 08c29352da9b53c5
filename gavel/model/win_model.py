"""The win-probability model as a Spark ML pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gavel.functions import scalar
from gavel.operators.blocks import running
from gavel.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from gavel.session import written

# What missing features become.
MISSING_NUMBER, MISSING_TEXT = -1.0, "unknown"
# A 60-bit hash is refined 16 bits at a time.
HASH_LEVELS = (44, 28)


def model_rows(full: DataFrame, since: str | None = None, together: bool = False) -> DataFrame:
    """Rows to model: recent auctions in which somebody used the bidomatic.

    `together` says that an auction's rows already lie in one task, as those of
    `auction_full` do without long auctions: they are marked there, and the wide
    rows are neither computed twice nor joined.
    """
    if together:
        used = F.max("is_bidomatic").over(Window.partitionBy("auctionid"))
        full = full.withColumn("_used", used).where("_used").drop("_used")
    rows = full if since is None else full.where(F.col("auctiontime") >= F.lit(since).cast("timestamp_ntz"))
    if together:
        return rows
    ids = full.where("is_bidomatic").select("auctionid").distinct()
    return rows.join(ids, "auctionid", "left_semi")


def model_features(df: DataFrame) -> DataFrame:
    """Derived inputs: fee, hour, Sunday flag, and opponent flags as text."""
    ts = F.col("auctiontime")
    flags = [c for c in CATEGORICAL_FEATURES if c[-1].isdigit()]
    return df.withColumns(
        {
            "fee": scalar.fee(F.col("cardvalue")),
            "time_of_day": scalar.time_of_day(ts),
            "is_weekend": scalar.is_weekend(ts),
            **{c: scalar.flag_text(F.col(c)) for c in flags},
        }
    )


def impute(df: DataFrame, numeric: list[str] | None = None, categorical: list[str] | None = None) -> DataFrame:
    """Missing numbers become -1 and missing categories 'unknown'."""
    numeric = NUMERIC_FEATURES if numeric is None else numeric
    categorical = CATEGORICAL_FEATURES if categorical is None else categorical
    types = dict(df.dtypes)
    text = {
        c: F.coalesce(
            F.initcap(F.col(c).cast("string")) if types[c] == "boolean" else F.col(c), F.lit(MISSING_TEXT)
        )
        for c in categorical
    }
    return df.withColumns(
        {**{c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING_NUMBER)) for c in numeric}, **text}
    )


def time_split(df: DataFrame, train_until: str, test_until: str) -> DataFrame:
    """Label rows train, test or holdout by auction end time."""
    ts = F.col("auctiontime")
    at = [F.lit(c).cast("timestamp_ntz") for c in (train_until, test_until)]
    return df.withColumn("split", F.when(ts <= at[0], "train").when(ts <= at[1], "test").otherwise("holdout"))


def random_order(keys: list[str], seed: int) -> Column:
    """A reproducible pseudo-random number per row key: the first 60 bits of an MD5 digest, which any engine can make."""
    return F.conv(F.substring(F.md5(F.concat_ws(",", *keys, F.lit(seed))), 1, 15), 16, 10).cast("long")


def _bucket(h: Column, level: int) -> Column:
    """Top bits of the hash, in hash order: about 2**16 even ranges within a range of the level above."""
    return F.shiftright(h, HASH_LEVELS[level])


def _cut(counts: DataFrame, wanted: Column) -> DataFrame:
    """range, keep: the range in which the first `wanted` rows end, and how many of its rows are among them."""
    upto = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    falls = counts.withColumns({"upto": upto, "wanted": wanted}).where(
        (F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted"))
    )
    return falls.select("range", (F.col("wanted") - F.col("upto") + F.col("n")).alias("keep"))


def undersample(df: DataFrame, label: str, ratio: float, keys: list[str], seed: int = 17) -> DataFrame:
    """All positives, and exactly positives/ratio random negatives.

    Negatives are ordered by a hash. Counts per hash range (at most 2**16) show
    in which range the cut falls. Its keys are set aside and counted again by
    finer ranges, and ranking the finest, about one in 2**32 of the negatives,
    gives the last key to keep. The rows themselves are then filtered where
    they are, without a shuffle.
    """
    h = random_order(keys, seed)
    negative = ~F.col(label)
    counts = written(
        df.groupBy(F.when(negative, _bucket(h, 0)).alias("range")).agg(F.count("*").alias("n")), "counts"
    )
    wanted = F.coalesce(counts.where(F.col("range").isNull()).select(F.floor(F.max("n") / F.lit(float(ratio)))).scalar(), F.lit(0))
    cut = written(_cut(counts.where(F.col("range").isNotNull()), wanted), "cut")
    place = F.struct(h.alias("h"), *keys)
    falls = written(df.where(negative & (_bucket(h, 0) == cut.select("range").scalar())).select(place.alias("place")), "falls")
    for level in range(1, len(HASH_LEVELS)):
        finer = _bucket(F.col("place.h"), level)
        counted = falls.groupBy(finer.alias("range")).agg(F.count("*").alias("n"))
        cut = written(_cut(counted, cut.select("keep").scalar()), "cut")
        falls = falls.where(finer == cut.select("range").scalar())
    last = (
        falls.withColumn("rank", F.row_number().over(Window.orderBy("place")))
        .where(F.col("rank") == cut.select("keep").scalar())
        .select("place")
    )
    last = written(last, "last")
    negatives = counts.where(F.col("range").isNotNull()).select(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    all_kept = (wanted > 0) & (wanted >= negatives)
    return df.where(~negative | F.coalesce(place <= last.select("place").scalar(), all_kept))


def sample_losers(df: DataFrame, label: str, fraction: float, keys: list[str], seed: int = 17) -> DataFrame:
    """All winners and about `fraction` of the losers, the same ones every run."""
    share = F.pmod(random_order(keys, seed), F.lit(1000000)) / F.lit(1000000.0)
    return df.where(F.col(label)).unionByName(df.where(~F.col(label) & (share < fraction)))


def random_split(df: DataFrame, keys: list[str], train: float = 0.75, seed: int = 0) -> DataFrame:
    """Label rows train or test at random, reproducibly and without a shuffle."""
    share = F.pmod(random_order(keys, seed), F.lit(1000000)) / F.lit(1000000.0)
    return df.withColumn("split", F.when(share < train, "train").otherwise("test"))


def calibrate(prob: Column, true_rate: Column | float, sampled_rate: Column | float) -> Column:
    """Probability on the full data from one learnt on the undersampled data."""
    t = true_rate if isinstance(true_rate, Column) else F.lit(float(true_rate))
    s = sampled_rate if isinstance(sampled_rate, Column) else F.lit(float(sampled_rate))
    yes = prob * t / s
    no = (F.lit(1.0) - prob) * (F.lit(1.0) - t) / (F.lit(1.0) - s)
    return yes / (yes + no)


def encoder_stages(categorical: list[str] | None = None, numeric: list[str] | None = None) -> list:
    """Index, one-hot (the alphabetically first category dropped) and assemble."""
    categorical = CATEGORICAL_FEATURES if categorical is None else categorical
    numeric = NUMERIC_FEATURES if numeric is None else numeric
    index = StringIndexer(
        inputCols=categorical,
        outputCols=[f"{c}_idx" for c in categorical],
        stringOrderType="alphabetDesc",
        handleInvalid="error",
    )
    hot = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in categorical],
        outputCols=[f"{c}_hot" for c in categorical],
        dropLast=True,
    )
    assemble = VectorAssembler(inputCols=numeric + [f"{c}_hot" for c in categorical], outputCol="features")
    return [index, hot, assemble]


def one_hot_columns(df: DataFrame, col: str, categories: list[str]) -> DataFrame:
    """One 0/1 column per category but the alphabetically first."""
    return df.select(
        "*", *[(F.col(col) == c).cast("int").alias(f"{col}_{c}") for c in sorted(categories)[1:]]
    )


class WinModel:
    """Undersample, fit, and score with calibrated probabilities."""

    KEYS = ["auctionid", "bid"]

    def __init__(self, estimator=None, sampling_ratio: float = 1.0, seed: int = 17, label: str = "is_winner"):
        self.estimator = estimator or RandomForestClassifier(numTrees=200, maxDepth=10, seed=seed)
        self.sampling_ratio, self.seed, self.label = sampling_ratio, seed, label
        self.model: PipelineModel | None = None
        self.true_rate = self.sampled_rate = None

    def fit(self, df: DataFrame, categories: DataFrame | None = None) -> "WinModel":
        """Fit on `df`; a category seen neither there nor in `categories` is an
        error when scoring."""
        rows = impute(model_features(df))
        # Two counts come back to the driver; no rows do.
        n, won = rows.agg(F.count("*"), F.sum(F.col(self.label).cast("long"))).first()
        self.true_rate = won / n
        self.sampled_rate = won / (won / self.sampling_ratio + won)
        sampled = undersample(rows, self.label, self.sampling_ratio, self.KEYS, self.seed)
        sampled = sampled.withColumn("label", F.col(self.label).cast("double"))
        # Categories come from the rows before undersampling, which may leave
        # out a rare one.
        seen = rows if categories is None else impute(model_features(categories))
        fitted = Pipeline(stages=encoder_stages()).fit(seen)
        features = fitted.transform(sampled).select("features", "label")
        estimator = self.estimator.copy({self.estimator.featuresCol: "features", self.estimator.labelCol: "label"})
        self.model = PipelineModel(stages=[*fitted.stages, estimator.fit(features)])
        return self

    def score(self, df: DataFrame, calibrated: bool = True) -> DataFrame:
        """`df` plus `prob`, the chance that the bid wins."""
        scored = self.model.transform(impute(model_features(df.select("*", F.struct("*").alias("_row")))))
        raw = vector_to_array("probability")[1]
        prob = calibrate(raw, self.true_rate, self.sampled_rate) if calibrated else raw
        return scored.select("_row.*", prob.alias("prob"), F.col("prediction").cast("boolean").alias("predicted"))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.getActiveSession()
        rates = [(self.true_rate, self.sampled_rate, self.sampling_ratio, self.seed, self.label)]
        spark.createDataFrame(rates, "true_rate double, sampled_rate double, ratio double, seed int, label string").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{path}/rates")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "WinModel":
        rates = spark.read.parquet(f"{path}/rates").first()
        out = cls(sampling_ratio=rates.ratio, seed=rates.seed, label=rates.label)
        out.true_rate, out.sampled_rate = rates.true_rate, rates.sampled_rate
        out.model = PipelineModel.load(f"{path}/pipeline")
        return out


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the assembled features, from the column's metadata."""
    attrs = model.transform(impute(model_features(df.limit(1)))).schema["features"].metadata["ml_attr"]["attrs"]
    flat = [a for kind in attrs.values() for a in kind]
    return [a["name"].replace("_hot_", "_") for a in sorted(flat, key=lambda a: a["idx"])]


def feature_group(name: Column) -> Column:
    """History, opponent or other, by the feature's name."""
    last = F.substring(name, -1, 1)
    return (
        F.when(name.startswith("prev") & (name != "prevusers"), "history")
        .when(last.isin("0", "1", "2", "3") | name.endswith("_True"), "opponent")
        .otherwise("other")
    )


def feature_importances(fitted: WinModel, df: DataFrame) -> DataFrame:
    """Importance per feature with its group, highest first."""
    names = feature_names(fitted.model, df)
    values = fitted.model.stages[-1].featureImportances.toArray()
    spark = df.sparkSession
    out = spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")
    return out.withColumn("group", feature_group(F.col("feature"))).orderBy(F.desc("importance"), "feature")


def _ranked(rows: DataFrame, keys: list[str], salt: int, name: str) -> DataFrame:
    """`rows` with their place in a pseudo-random order: a running count in hash ranges."""
    blocks = {f"_h{level}": _bucket(F.col("_h"), level) for level in range(len(HASH_LEVELS))}
    hashed = rows.withColumn("_h", random_order(keys, salt)).withColumns(blocks)
    return running(hashed, [], list(blocks), ["_h", *keys], {name: F.lit(1)}).drop("_h", *blocks)


def shuffled_column(df: DataFrame, col: str, keys: list[str], seed: int) -> DataFrame:
    """`df` with one column permuted.

    Rows are ranked by two different hashes; row i of the one order takes the
    value of row i of the other.
    """
    values = _ranked(df.select(*keys, F.col(col).alias("_v")), keys, seed + 1, "_at").select("_at", "_v")
    rest = _ranked(df, keys, seed, "_at").drop(col)
    return rest.join(values, "_at").withColumnRenamed("_v", col).select(*df.columns)


def feature_slots(encoder: PipelineModel, cols: list[str]) -> dict[str, tuple[int, int]]:
    """Where each feature lies in the assembled vector: its first slot and how many it has."""
    _, hot, assemble = encoder.stages
    sizes = {c: int(n) - 1 for c, n in zip(hot.getOutputCols(), hot.categorySizes)}
    places, at = {}, 0
    for c in assemble.getInputCols():
        places[c.removesuffix("_hot")] = (at, sizes.get(c, 1))
        at += sizes.get(c, 1)
    return {c: places[c] for c in cols}


def permutation_importance(fitted: WinModel, df: DataFrame, cols: list[str] | None = None, seed: int = 7) -> DataFrame:
    """Loss of accuracy when one feature is shuffled, for each feature (all of the model by default).

    Rows are ranked by two hashes once and written, encoded and scored; row i of
    the one order meets row i of the other, and is scored once a feature, with
    that feature's slots of the encoded row taken from the other row. Where
    these are equal the score stays what it is, so only rows that change are
    scored again.
    """
    cols = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES] if cols is None else cols
    keys = fitted.KEYS
    ranked = _ranked(_ranked(df, keys, seed, "_at"), keys, seed + 1, "_from")
    encoder, forest = PipelineModel(stages=fitted.model.stages[:-1]), fitted.model.stages[-1]
    hit = (F.col("prediction").cast("boolean") == F.col(fitted.label)).cast("long")
    scored = forest.transform(encoder.transform(impute(model_features(ranked))))
    rows = written(
        scored.select("_at", "_from", fitted.label, vector_to_array("features").alias("_x"), hit.alias("_hit")), "ranked"
    )
    slots = feature_slots(encoder, cols)
    part = lambda x, start, size: F.slice(x, start + 1, size)
    changed = [
        F.when(part(F.col("_x"), F.lit(at), F.lit(n)) != part(F.col("_y"), F.lit(at), F.lit(n)), F.struct(F.lit(c).alias("feature"), F.lit(at).alias("at"), F.lit(n).alias("n")))
        for c, (at, n) in slots.items()
    ]
    other = rows.select(F.col("_from").alias("_at"), F.col("_x").alias("_y"))
    each = rows.join(other, "_at").withColumn("_c", F.explode(F.array_compact(F.array(*changed))))
    end = F.col("_c.at") + F.col("_c.n")
    mixed = F.concat(
        part("_x", F.lit(0), F.col("_c.at")), part("_y", F.col("_c.at"), F.col("_c.n")), part("_x", end, F.size("_x") - end)
    )
    again = forest.transform(
        each.select(F.col("_c.feature").alias("feature"), fitted.label, "_hit", array_to_vector(mixed).alias("features"))
    )
    gained = again.groupBy("feature").agg(F.sum(hit - F.col("_hit")).alias("gained"))
    base = rows.agg(F.sum("_hit").alias("hits"), F.count("*").alias("n")).where("n > 0")
    names = base.select("*", F.explode(F.array(*[F.lit(c) for c in cols])).alias("feature"))
    accuracy = F.col("hits") / F.col("n")
    shuffled = (F.col("hits") + F.coalesce("gained", F.lit(0))) / F.col("n")
    return names.join(gained, "feature", "left").select(
        "feature", accuracy.alias("accuracy"), shuffled.alias("shuffled"), (accuracy - shuffled).alias("importance")
    )
