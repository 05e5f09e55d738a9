"""Risk and value models on Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import scalars as S
from . import model_columns

# ------------------------------------------------------------------- features


def _assembler(columns: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error")


def _spread(df: DataFrame, vector: str, columns: list[str], digits: int | None) -> DataFrame:
    arr = vector_to_array(vector)
    out = [arr[i] for i in range(len(columns))]
    return df.select(
        *[c for c in df.columns if c not in (vector, "features", *columns)],
        *[(F.round(x, digits) if digits is not None else x).alias(c) for x, c in zip(out, columns)],
    )


def standardise(df: DataFrame, columns: list[str], digits: int | None = None) -> DataFrame:
    """Columns with mean 0 and sample standard deviation 1."""
    p = Pipeline(stages=[_assembler(columns), StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)])
    return _spread(p.fit(df).transform(df), "scaled", columns, digits)


def minmax(df: DataFrame, columns: list[str], digits: int | None = None) -> DataFrame:
    """Columns mapped to [0, 1]."""
    p = Pipeline(stages=[_assembler(columns), MinMaxScaler(inputCol="features", outputCol="scaled")])
    return _spread(p.fit(df).transform(df), "scaled", columns, digits)


ENT_FEATURES = (
    "work_type cur_insured_persons man woman ent_employee_age death_num disability_num report_num avg_aging_risk "
    "ent_potential_scale ent_city all_compensation pre_all_compensation charged_premium"
).split()


def risk_features(wide: DataFrame) -> DataFrame:
    """The 14 enterprise features from wide labels; missing labels are 0.

    ``work_type`` is the index (1 to 5) of the work level with the largest share
    of the enterprise size, the first one on ties.
    """
    def num(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in wide.columns else F.lit(0.0)

    size = num("ent_scale")
    shares = F.array(*[F.when(size > 0, num(f"worktype_{i}_count") / F.nullif(size, F.lit(0.0)) * 100).otherwise(0.0) for i in range(1, 6)])
    rest = [c for c in ENT_FEATURES if c not in ("work_type", "man", "woman")]
    return wide.select(
        "ent_id",
        F.array_position(shares, F.array_max(shares)).cast("double").alias("work_type"),
        num("men_share").alias("man"),
        num("women_share").alias("woman"),
        *[num("ent_city_grade" if c == "ent_city" else c).alias(c) for c in rest],
    ).select("ent_id", *ENT_FEATURES)


PERSON_FEATURES = "money early_res user_craft_level age city_level sex insure_to_month".split()

# City tiers.
CITY_TIERS = {"一线城市": 1, "二线城市": 2, "三线城市": 3, "四线城市": 4}


def person_features(profile: DataFrame, payout: DataFrame, craft: DataFrame, rides: DataFrame) -> DataFrame:
    """The seven person features; persons without a profile are left out.

    ``profile``: cert, gender, age, grade, insure_to_month. ``payout``: cert,
    prepay_total, finalpay_total. ``craft``: cert, user_craft_level.
    ``rides``: cert, early_night.
    """
    final = F.coalesce("finalpay_total", F.lit(0))
    money = F.when(final == 0, F.coalesce("prepay_total", F.lit(0))).otherwise(final)
    tier = F.lit(0)
    for name, n in CITY_TIERS.items():
        tier = F.when(F.col("grade") == name, n).otherwise(tier)
    early = F.when(F.col("early_night") == codes.EARLY_RISER, 1).when(F.col("early_night") == codes.NIGHT_OWL, 2).otherwise(0)
    sex = F.when(F.col("gender") == codes.FEMALE, 0).when(F.col("gender") == codes.MALE, 1).otherwise(3)
    return (
        profile.join(payout, "cert", "left")
        .join(craft, "cert", "left")
        .join(rides, "cert", "left")
        .select(
            "cert",
            money.cast("double").alias("money"),
            early.cast("double").alias("early_res"),
            F.coalesce("user_craft_level", F.lit(0)).cast("double").alias("user_craft_level"),
            F.col("age").cast("double").alias("age"),
            tier.cast("double").alias("city_level"),
            sex.cast("double").alias("sex"),
            F.coalesce("insure_to_month", F.lit(0)).cast("double").alias("insure_to_month"),
        )
    )


RIDER_FEATURES = "age province_code rides habit".split()


def rider_features(behaviour: DataFrame, cards: DataFrame) -> DataFrame:
    """Age, province code, ride count and early/late flag of a rider."""
    return behaviour.join(cards.select("insured_cert_no", "age", "province_code"), "insured_cert_no").select(
        "insured_cert_no",
        F.col("age").cast("double").alias("age"),
        F.coalesce(F.col("province_code").try_cast("double"), F.lit(0.0)).alias("province_code"),
        F.col("user_insure_product_num").cast("double").alias("rides"),
        F.when(F.col("early_night") == "null", 0.0).otherwise(1.0).alias("habit"),
    )


# --------------------------------------------------------------------- models


def train_tree(df: DataFrame, columns: list[str], label: str, depth: int = 4, bins: int = 16, impurity: str = "entropy", scale: bool = True, seed: int = 7) -> PipelineModel:
    """Decision tree on standardised features."""
    stages = [_assembler(columns)]
    source = "features"
    if scale:
        stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True))
        source = "scaled"
    stages.append(
        DecisionTreeClassifier(featuresCol=source, labelCol=label, maxDepth=depth, maxBins=bins, impurity=impurity, seed=seed)
    )
    return Pipeline(stages=stages).fit(df)


def train_kmeans(df: DataFrame, columns: list[str], k: int = 7, iterations: int = 50, scaler: str = "minmax", seed: int = 7) -> PipelineModel:
    s = (
        MinMaxScaler(inputCol="features", outputCol="scaled")
        if scaler == "minmax"
        else StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    )
    km = KMeans(featuresCol="scaled", predictionCol="prediction", k=k, maxIter=iterations, seed=seed)
    return Pipeline(stages=[_assembler(columns), s, km]).fit(df)


def split(df: DataFrame, train: float = 0.8, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    a, b = df.randomSplit([train, 1 - train], seed)
    return a, b


def score(model: PipelineModel, df: DataFrame, keep: list[str], alias: str = "prediction") -> DataFrame:
    return model.transform(df).select(*keep, F.col("prediction").cast("int").alias(alias))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def centres(model: PipelineModel, columns: list[str]) -> DataFrame:
    """Cluster centres as rows, in the scaled space."""
    rows = [(n, *[float(x) for x in c]) for n, c in enumerate(model.stages[-1].clusterCenters())]  # one per cluster
    return SparkSession.active().createDataFrame(rows, "cluster int, " + ", ".join(f"{c} double" for c in columns))


def cluster_sizes(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("members"))


def cluster_report(model: PipelineModel, df: DataFrame, columns: list[str]) -> DataFrame:
    """Per cluster its members, the sum of squared distances of their scaled features to the centre, and the centre."""
    near = model_columns.nearest(model.stages[-1], features := model_columns.scaled(model.stages[1], [F.col(c).cast("double") for c in columns]))
    rows = df.select(near.alias("cluster"), *[f.alias(c) for f, c in zip(features, columns)])
    middle = centres(model, [f"centre_{c}" for c in columns])
    gap = sum((F.col(c) - F.col(f"centre_{c}")) * (F.col(c) - F.col(f"centre_{c}")) for c in columns)
    return rows.join(F.broadcast(middle), "cluster").groupBy("cluster", *[f"centre_{c}" for c in columns]).agg(F.count("*").alias("members"), F.sum(gap).alias("cost"))  # one row per cluster


def rmsle(scored: DataFrame, label: str) -> float:
    """Root mean squared difference of log(1 + value)."""
    d = F.log1p(F.col("prediction")) - F.log1p(F.col(label))
    return scored.agg(F.sqrt(F.avg(d * d)).alias("x")).first()["x"]


def tree_sweep(df: DataFrame, columns: list[str], label: str, depths=(1, 2, 3, 4, 5, 10, 20), bins=(2, 4, 8, 16, 32, 64, 100)) -> DataFrame:
    """Test RMSLE by depth (32 bins) and by bins (depth 10)."""
    train, test = split(df)
    rows = [("depth", d, rmsle(train_tree(train, columns, label, depth=d, bins=32).transform(test), label)) for d in depths]
    rows += [("bins", b, rmsle(train_tree(train, columns, label, depth=10, bins=b).transform(test), label)) for b in bins]
    return df.sparkSession.createDataFrame(rows, "parameter string, value int, rmsle double")


def kmeans_sweep(df: DataFrame, columns: list[str], ks=(1, 3, 5, 7, 9)) -> DataFrame:
    """Within-cluster cost by number of clusters; one cluster is the spread around the mean."""
    scaled = minmax(df.select(*columns), columns)
    rows = []
    for k in ks:
        if k == 1:
            cost = scaled.agg(sum(F.var_pop(c) * F.count(c) for c in columns).alias("x")).first()["x"]
        else:
            cost = train_kmeans(df, columns, k=k).stages[-1].summary.trainingCost
        rows.append((k, float(cost)))
    return df.sparkSession.createDataFrame(rows, "k int, cost double")


def metrics(scored: DataFrame, label: str) -> DataFrame:
    """Mean squared error and share of wrong predictions."""
    m = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="mse").evaluate(scored)
    acc = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy").evaluate(scored)
    return scored.sparkSession.createDataFrame([("mse", float(m)), ("test_error", float(1 - acc))], "metric string, value double")


# -------------------------------------------------------------------- reviews

# Review conclusions by score band.
REVIEW = ("从宽审核", "正常审核", "审慎审核", "严格审核")
BATCH_REVIEW = ("从宽审核", "正常审核", "审慎审核", "建议拒绝")


def band(score: Column, names=REVIEW) -> Column:
    """(0,25], (25,50], (50,75], (75,100] -> conclusion; anything else has none."""
    return (
        F.when((score > 0) & (score <= 25), names[0])
        .when((score > 25) & (score <= 50), names[1])
        .when((score > 50) & (score <= 75), names[2])
        .when((score > 75) & (score <= 100), names[3])
    )


def three_way(c: Column, low, mid, high) -> Column:
    return F.when(c == low, 0).when(c == mid, 50).when(c == high, 100)


def review_conclusion(rows: DataFrame) -> DataFrame:
    """Equal-weight conclusion from report, person, value and risk; rows with an unknown part are dropped.

    ``rows``: ent_id, cert_no, report (0..2), person (0..2), value, risk (1..3).
    """
    value = F.when(F.col("value") > 40, 0).when(F.col("value") > 20, 50).when(F.col("value") <= 20, 100)
    parts = [three_way(F.col("report"), 0, 1, 2), three_way(F.col("person"), 0, 1, 2), value, three_way(F.col("risk"), 1, 2, 3)]
    s = sum(p * 0.25 for p in parts)
    return rows.withColumn("score", s).where(F.col("score").isNotNull()).select(
        "ent_id", "cert_no", "score", F.coalesce(band(F.col("score"), BATCH_REVIEW), F.lit("()")).alias("model_conclusion")
    )


def review_compare(model: DataFrame, old: DataFrame) -> DataFrame:
    """New conclusions beside the old system's, one old conclusion per person."""
    prior = old.where(F.col("conclusion").isNotNull()).groupBy("cert_no").agg(F.min("conclusion").alias("conclusion"))
    return model.join(prior, "cert_no").withColumn("agrees", (F.col("model_conclusion") == F.col("conclusion")).cast("int"))


def enterprise_scores(features: DataFrame, slope: DataFrame, model: PipelineModel) -> DataFrame:
    """Daily value score and risk class of an enterprise. The score is rounded once, from six places, which hold it exactly."""
    scored = features.join(slope.select("ent_id", "premium_all", "three_slope"), "ent_id").withColumn("prediction", model_columns.prediction(model))
    value = S.value_score("cur_insured_persons", "premium_all", "three_slope")
    return scored.select("ent_id", F.round(value.cast("decimal(18,6)"), 2).cast("double").alias("enter_value"), F.col("prediction").cast("int").alias("risk_value"))
