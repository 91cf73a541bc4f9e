"""Model families, exact stratified splits, leaderboards, clustering and churn scoring.

Everything stays distributed: splits and metrics are DataFrame plans, fits are MLlib
estimators or the forest and boosting of this package, and what reaches the driver is
metric rows and one row per class or cluster.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle import config as C
from ladle.config import Config
from ladle.functions import scalars as S
from ladle.functions.dealing import parts_of
from ladle.functions.ranking import hashed_rank_in_class
from ladle.operators import boosting, forest
from ladle.operators.customers import churn_labels, risk_bands, segment_rule

FIRST_FEATURES = ["qty", "revenue", "margin", "rating", "wastage", "promo_dep"]
SECOND_FEATURES = ["qty", "revenue", "margin", "rating", "repeat", "wastage", "promo_dep", "trend"]
CHURN_FEATURES = ["frequency", "monetary", "categories", "promo_share", "avg_order_value"]
CLUSTER_FEATURES = ["recency", "frequency", "monetary", "categories", "promo_share"]
#: Customers of one partition of the clustering, beyond the configured number of partitions.
CLUSTER_ROWS = 100_000


@contextmanager
def cached(df: DataFrame, keys: list[str], cfg: Config = Config(), parts: int = 0):
    """Persist a training table for the iterations of a fit.

    Bagging and cluster starts depend on partitions and row order, so the table is dealt
    by its keys into a configured number of partitions (``parts`` if that is more) and
    sorted inside them: a fit gives the same model however its input was partitioned.
    """
    kept = df.repartition(max(cfg.fit_partitions, parts), *keys).sortWithinPartitions(*keys).persist()
    try:
        yield kept
    finally:
        kept.unpersist()


# -- splits -----------------------------------------------------------------
def stratified_split(df: DataFrame, label: str, keys: list[str], parts: dict[str, int], seed: int) -> DataFrame:
    """Add ``split``: exact shares per class (``parts`` in percent), reproducible by seed."""
    if sum(parts.values()) != 100:
        raise ValueError("the parts of a split must add up to 100 percent")
    ranked = hashed_rank_in_class(df, label, keys, seed, "__rank", "__size")
    names = list(parts)
    choice, upto = None, 0
    for name in names[:-1]:
        upto += parts[name]
        hit = F.col("__rank") * 100 <= F.col("__size") * upto
        choice = F.when(hit, name) if choice is None else choice.when(hit, name)
    split = F.lit(names[-1]) if choice is None else choice.otherwise(names[-1])
    return ranked.withColumn("split", split).drop("__rank", "__size")


def random_split(df: DataFrame, keys: list[str], train_pct: int, seed: int) -> DataFrame:
    """Random split by a seeded key hash; unlike ``randomSplit`` it survives repartitioning."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(100))
    return df.withColumn("split", F.when(bucket < train_pct, "train").otherwise("test"))


# -- metrics ----------------------------------------------------------------
def class_scores(predictions: DataFrame, truth: str, guess: str) -> DataFrame:
    """True positives, support and F1 per class, from one count per (truth, guess) pair."""
    pairs = predictions.groupBy(truth, guess).agg(F.count("*").alias("n"))
    both = pairs.select(F.explode(F.array(
        F.struct(F.col(truth).alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("guessed"),
                 F.when(F.col(truth) == F.col(guess), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col(guess).alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("guessed"),
                 F.lit(0).cast("long").alias("hits")))).alias("r")).select("r.*")
    sums = both.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hits")])
    f1 = S.ratio(F.col("hits") * 2, F.col("support") + F.col("guessed"))
    return sums.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def scoreboard_row(predictions: DataFrame, truth: str, guess: str) -> DataFrame:
    """Accuracy, macro F1 (mean over classes) and weighted F1 in one row."""
    return class_scores(predictions, truth, guess).agg(
        S.ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        S.ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"))


# -- classification ---------------------------------------------------------
def first_family(cfg: Config = Config()) -> dict[str, object]:
    """Random forest, decision tree and multinomial logistic regression."""
    return {
        "Random Forest": RandomForestClassifier(numTrees=120, maxDepth=8, seed=cfg.seed),
        "Decision Tree": DecisionTreeClassifier(maxDepth=8, seed=cfg.seed),
        "Logistic Regression": LogisticRegression(maxIter=100, regParam=0.02),
    }


@dataclass
class Trained:
    """Outcome of one family: leaderboard rows, confusion counts on the test rows, the chosen model and its name.

    The second family has predictions of all cells (item_id, location_id, predicted) instead of an MLlib model.
    """

    board: list[dict]
    confusion: list[dict]
    model: PipelineModel | None
    name: str
    train_rows: int
    test_rows: int
    features: list[str]
    seconds: float = 0.0
    predictions: DataFrame | None = None

    def confusion_counts(self, like: DataFrame) -> DataFrame:
        return like.sparkSession.createDataFrame(self.confusion, "model string, truth string, guess string, n long")

    def leaderboard(self, like: DataFrame) -> DataFrame:
        return like.sparkSession.createDataFrame(
            self.board, "model string, accuracy double, macro_f1 double, weighted_f1 double, selected boolean")


def feature_stages(samples: DataFrame, train: DataFrame, features: list[str], label: str = "local_class") -> PipelineModel:
    """Label index, fitted on all rows so no class is unseen; feature vector and scaling, fitted on the training rows."""
    index = StringIndexer(inputCol=label, outputCol="label", handleInvalid="error", stringOrderType="alphabetAsc").fit(samples)
    scale = Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]).fit(train)
    return PipelineModel(stages=[index, *scale.stages])


def train_family(samples: DataFrame, candidates: dict[str, object] | Callable[[int], dict[str, object]],
                 features: list[str], cfg: Config = Config(), label: str = "local_class") -> Trained:
    """Fit every candidate on the stratified 70 %, compare on the rest, choose by macro F1.

    ``candidates`` may be a function of the number of training rows.
    """
    keys = ["item_id", "location_id"]
    numeric = samples.withColumns({f: F.col(f).cast("double") for f in features})
    split = stratified_split(numeric, label, keys, {"train": 70, "test": 30}, cfg.seed)
    prepare = feature_stages(numeric, split.filter("split = 'train'"), features, label)
    with cached(prepare.transform(split).select(*keys, "split", "label", "features"), keys, cfg) as ready:
        sizes = {r["split"]: r["n"] for r in ready.groupBy("split").agg(F.count("*").alias("n")).collect()}
        train, test = ready.filter("split = 'train'"), ready.filter("split = 'test'")
        if callable(candidates):
            candidates = candidates(sizes.get("train", 0))
        labels = prepare.stages[0].labels
        board, fitted = Board(labels), {}
        for name, estimator in candidates.items():
            fitted[name] = estimator.fit(train)
            board.add(name, fitted[name].transform(test))
        best = board.chosen()
        decode = IndexToString(inputCol="prediction", outputCol="predicted", labels=labels)
        model = PipelineModel(stages=[*prepare.stages, fitted[best], decode])
        return Trained(board.rows, board.confusion, model, best, sizes.get("train", 0), sizes.get("test", 0), features)


class Board:
    """Leaderboard rows and confusion counts of models, from their predictions of the test rows."""

    def __init__(self, labels: list[str]):
        self.labels, self.rows, self.confusion = labels, [], []

    def add(self, name: str, predictions: DataFrame) -> None:
        """predictions: label and prediction as class numbers."""
        score = scoreboard_row(predictions, "label", "prediction").first().asDict()
        self.rows.append({"model": name, **{k: round(v or 0.0, 3) for k, v in score.items()}})
        for r in predictions.groupBy("label", "prediction").agg(F.count("*").alias("n")).collect():  # classes squared
            self.confusion.append({"model": name, "truth": self.labels[int(r["label"])], "guess": self.labels[int(r["prediction"])], "n": r["n"]})

    def chosen(self) -> str:
        best = max(self.rows, key=lambda row: row["macro_f1"])["model"]
        for row in self.rows:
            row["selected"] = row["model"] == best
        return best


def train_second_family(samples: DataFrame, store: Callable[[str, DataFrame], DataFrame], cfg: Config = Config(),
                        label: str = "local_class", trees: int = 350) -> Trained:
    """Boosting, extra-trees and a weakly regularised logistic regression, compared on the stratified 30 %.

    Missing features count as 0. The inverse regularisation strength 0.5 becomes ``regParam = 1 / (0.5 * rows)`` of the
    training rows. ``store(name, df)`` writes a table and reads it back.
    """
    keys, features = ["item_id", "location_id"], SECOND_FEATURES
    split = stratified_split(samples, label, keys, {"train": 70, "test": 30}, cfg.seed)
    labels = sorted(r[0] for r in samples.select(label).distinct().collect())  # one row per class
    # by SQL text: labels and features are few
    numbered = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(label)) - 1
    ready = store("second_features", split.select(
        *keys, "split", F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]).alias("features"),
        numbered.cast("int").alias("label")))
    train, test = ready.filter("split = 'train'"), ready.filter("split = 'test'")
    sizes = {r["split"]: r["n"] for r in ready.groupBy("split").agg(F.count("*").alias("n")).collect()}
    k = max(len(labels), 1)

    def boosted() -> DataFrame:
        model = boosting.fit(train, len(features), k, store, cfg.boosting_rounds, rate=0.15, depth=3)
        return boosting.predict(model, ready, keys)

    def extra_trees() -> DataFrame:
        grown = forest.grow(train, len(features), k, store, trees, max_depth=cfg.full_tree_depth, seed=cfg.seed)
        store("second_nodes", grown.nodes())
        return forest.predict(grown, ready, keys, store)

    def logistic() -> DataFrame:
        vectors = ready.select(*keys, "split", "label", array_to_vector("features").alias("raw_features"))
        scale = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True).fit(vectors.filter("split = 'train'"))
        with cached(scale.transform(vectors), keys, cfg) as scaled:
            fitted = LogisticRegression(maxIter=cfg.logistic_iterations, regParam=1.0 / (0.5 * max(sizes.get("train", 0), 1))).fit(
                scaled.filter("split = 'train'"))
            return store("second_logistic", fitted.transform(scaled).select(*keys, F.col("prediction").cast("int").alias("prediction")))

    board, predicted = Board(labels), {}
    for name, predict in (("Gradient Boosting", boosted), ("Extra Trees", extra_trees), ("Logistic Regression", logistic)):
        predicted[name] = store("second_" + name.split()[0].lower(), predict().select(*keys, "prediction"))
        board.add(name, test.join(predicted[name], keys).select("label", "prediction"))
    best = board.chosen()
    names = F.array(*[F.lit(v) for v in labels])
    chosen = predicted[best].select(*keys, F.get(names, F.col("prediction")).alias("predicted"))
    return Trained(board.rows, board.confusion, None, best, sizes.get("train", 0), sizes.get("test", 0), features, predictions=chosen)


def score_cells(samples: DataFrame, model: PipelineModel, features: list[str], label: str = "local_class") -> DataFrame:
    """Predict every cell; labels are decoded and the result stays distributed."""
    numeric = samples.withColumns({f: F.col(f).cast("double") for f in features})
    return model.transform(numeric).select("item_id", "location_id", "name", label, "predicted")


def compare_predictions(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both families side by side. A cell the first family missed uses the rule label."""
    a = first.select("item_id", "location_id", F.col("predicted").alias("__first"))
    joined = second.join(a, ["item_id", "location_id"], "left")
    return joined.select(
        "item_id", "name", "location_id",
        F.coalesce("__first", "local_class").alias("spark_model"), F.col("predicted").alias("python_model"),
    ).withColumn("agree", F.col("spark_model") == F.col("python_model"))


def agreement(comparison: DataFrame) -> DataFrame:
    return comparison.agg(
        F.bround(F.avg(F.col("agree").cast("int")) * 100, 0).cast("int").alias("agreement_pct"),
        F.count_if("agree").alias("matches"), F.count_if(~F.col("agree")).alias("disagreements"),
        F.count("*").alias("samples"))


def comparison_view(comparison: DataFrame, locations: DataFrame, rows: int = 40) -> DataFrame:
    """Disagreements first, a fixed-length table with outlet names."""
    top = comparison.orderBy("agree", "item_id", "location_id").limit(rows)
    names = locations.select("location_id", F.col("name").alias("location"))
    return top.join(names, "location_id", "left").orderBy("agree", "item_id", "location_id")


# -- clustering -------------------------------------------------------------
def cluster_customers(customers: DataFrame, k: int = 6, restarts: int = 10, seed: int = Config.seed) -> DataFrame:
    """K-means on the standardised features; the cheapest of several seeded runs wins.

    A run gets a projection of the cached table: it then keeps its vectors itself as objects, where it would read each one
    anew from the columns of a table that is cached as it is, in each of its passes.
    """
    numeric = customers.withColumns({f"__{f}": F.col(f).cast("double") for f in CLUSTER_FEATURES})
    prepare = Pipeline(stages=[
        VectorAssembler(inputCols=[f"__{f}" for f in CLUSTER_FEATURES], outputCol="__raw"),
        StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True)]).fit(numeric)
    ready = prepare.transform(numeric).select(*customers.columns, "features")
    with cached(ready.select("customer_id", "features"), ["customer_id"], parts=parts_of(customers, CLUSTER_ROWS)) as data:
        runs = [KMeans(k=k, seed=seed + i).fit(data.select("features")) for i in range(restarts)]
        best = min(runs, key=lambda run: run.summary.trainingCost)
    return best.transform(ready).withColumnRenamed("prediction", "cluster").drop("features")


def cluster_profiles(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(
        F.avg("recency").alias("recency"), F.avg("frequency").alias("frequency"),
        F.avg(F.col("monetary").cast("double")).alias("monetary"), F.avg("promo_share").alias("promo"),
        F.count("*").alias("customers"))


def unique_names(named: list[tuple[int, str]]) -> dict[int, str]:
    """Give each cluster its own name, richest first; a taken name moves on to a free one."""
    taken: dict[int, str] = {}
    for cluster, name in named:
        if name in taken.values():
            name = next((s for s in C.SEGMENTS if s not in taken.values()), name)
        taken[cluster] = name
    return taken


def named_clusters(profiles: DataFrame) -> DataFrame:
    """``cluster -> segment``: rules on the profile rows, then de-duplication of at most k names."""
    means = profiles.agg(F.avg("recency").alias("mr"), F.avg("frequency").alias("mf"), F.avg("promo").alias("mp"),
                         F.max("monetary").alias("top"))
    df = S.as_columns(profiles, means)
    rule = segment_rule(
        F.col("recency"), F.col("frequency"), F.col("monetary"), F.col("promo"),
        {"recency": F.col("mr"), "frequency": F.col("mf"), "promo": F.col("mp")}, F.col("monetary") == F.col("top"))
    rows = df.select("cluster", rule.alias("name"), "monetary").orderBy(F.desc("monetary"), "cluster").collect()
    pairs = list(unique_names([(r["cluster"], r["name"]) for r in rows]).items())
    return profiles.sparkSession.createDataFrame(pairs, "cluster int, segment string")


def segment_customers(customers: DataFrame, k: int = 6, restarts: int = 10, seed: int = Config.seed) -> DataFrame:
    """Customers with their cluster and its name."""
    clustered = cluster_customers(customers, k, restarts, seed)
    return clustered.join(named_clusters(cluster_profiles(clustered)), "cluster", "left")


# -- churn ------------------------------------------------------------------
@dataclass
class ChurnModel:
    model: PipelineModel
    accuracy: float
    auc: float
    recency_cut: float


def train_churn(customers: DataFrame, cfg: Config = Config()) -> ChurnModel:
    """Logistic regression on behaviour without recency, checked on a stratified 30 %."""
    labelled = churn_labels(customers, cfg).withColumns(
        {f"__{f}": F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in CHURN_FEATURES})
    with cached(stratified_split(
            labelled, "churned", ["customer_id"], {"train": 70, "test": 30}, cfg.seed), ["customer_id"], cfg) as split:
        prepare = Pipeline(stages=[
            VectorAssembler(inputCols=[f"__{f}" for f in CHURN_FEATURES], outputCol="__raw"),
            StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True)]).fit(split)
        train = prepare.transform(split.filter("split = 'train'"))
        # unit inverse strength on the training rows
        rows = train.count()
        fitted = LogisticRegression(
            labelCol="churned", maxIter=cfg.logistic_iterations, regParam=1.0 / max(rows, 1)).fit(train)
        scored = fitted.transform(prepare.transform(split.filter("split = 'test'")))
        auc = BinaryClassificationEvaluator(labelCol="churned", metricName="areaUnderROC").evaluate(scored)
        accuracy, cut = scored.agg(
            F.avg((F.col("prediction") == F.col("churned")).cast("int")), F.max("recency_cut")).first()
        return ChurnModel(PipelineModel(stages=[*prepare.stages, fitted]), accuracy, auc, cut)


def score_churn(customers: DataFrame, churn: ChurnModel, cfg: Config = Config()) -> DataFrame:
    numeric = customers.withColumns(
        {f"__{f}": F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in CHURN_FEATURES})
    scored = churn.model.transform(numeric).withColumn("churn_prob", vector_to_array("probability")[1])
    return risk_bands(scored.select(*customers.columns, "churn_prob"), cfg)


def churn_metrics(scored: DataFrame, churn: ChurnModel) -> DataFrame:
    bands = scored.agg(*[F.count_if(F.col("risk_band") == b).alias(f"{b.lower()}_risk") for b in ("High", "Medium", "Low")],
                       F.count("*").alias("customers"))
    return bands.withColumns({
        "model": F.lit("Logistic Regression"), "accuracy": F.lit(round(churn.accuracy, 3)),
        "auc": F.lit(round(churn.auc, 3)),
        "churn_rule": F.lit(f"recency > {int(churn.recency_cut)} days (70th pct)")})


# -- artefacts --------------------------------------------------------------
def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def metrics_document(trained: Trained, like: DataFrame, engine: str, runtime_sec: float) -> DataFrame:
    """Leaderboard, choice, features, sample count and runtime as one nested row."""
    board = trained.leaderboard(like)
    packed = board.agg(F.collect_list(F.struct(*board.columns)).alias("leaderboard"))
    return packed.select(
        F.lit(engine).alias("engine"), "leaderboard", F.lit(trained.name).alias("selected"),
        F.array(*[F.lit(f) for f in trained.features]).alias("features"),
        F.lit(trained.train_rows + trained.test_rows).alias("n_samples"), F.lit(float(runtime_sec)).alias("runtime_sec"))
