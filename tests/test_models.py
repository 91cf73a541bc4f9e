import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.operators import ml


def test_split_is_exact_disjoint_and_repeatable(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("c"))
    parts = {"train": 70, "val": 15, "test": 15}
    split = ml.stratified_split(df, "c", ["id"], parts, 1)
    sizes = {(r.c, r.split): r["count"] for r in split.groupBy("c", "split").count().collect()}
    assert sizes == {("rare", "train"): 70, ("rare", "val"): 15, ("rare", "test"): 15,
                     ("common", "train"): 630, ("common", "val"): 135, ("common", "test"): 135}
    again = ml.stratified_split(df.repartition(9), "c", ["id"], parts, 1)
    assert {(r.id, r.split) for r in split.collect()} == {(r.id, r.split) for r in again.collect()}
    other = ml.stratified_split(df, "c", ["id"], parts, 2)
    assert split.join(other.select("id", F.col("split").alias("o")), "id").filter("split <> o").count() > 0


def test_split_parts_must_cover_everything(spark):
    with pytest.raises(ValueError):
        ml.stratified_split(spark.range(3), "id", ["id"], {"train": 70, "test": 20}, 1)


def test_macro_and_weighted_f1(spark):
    rng = np.random.default_rng(4)
    truth = rng.choice(["a", "b", "c"], 300, p=[0.8, 0.15, 0.05])
    guess = np.where(rng.random(300) < 0.7, truth, rng.choice(["a", "b", "d"], 300))
    df = spark.createDataFrame([(str(t), str(g)) for t, g in zip(truth, guess)], "t string, g string")
    got = ml.scoreboard_row(df, "t", "g").first()
    f1, weight = {}, {}
    for k in set(truth) | set(guess):
        hit = ((truth == k) & (guess == k)).sum()
        f1[k] = 2 * hit / ((truth == k).sum() + (guess == k).sum())
        weight[k] = (truth == k).mean()
    assert got.accuracy == pytest.approx((truth == guess).mean())
    assert got.macro_f1 == pytest.approx(np.mean(list(f1.values())))
    assert got.weighted_f1 == pytest.approx(sum(f1[k] * weight[k] for k in f1))


def test_cluster_names_are_unique():
    named = ml.unique_names([(3, "High-Value Loyal"), (1, "Frequent"), (0, "Frequent"), (2, "At-Risk"), (4, "At-Risk")])
    assert named == {3: "High-Value Loyal", 1: "Frequent", 0: "Promotion-Driven", 2: "At-Risk", 4: "Occasional"}


def test_missing_prediction_falls_back_to_the_rule(spark):
    first = spark.createDataFrame([("a", 1, "X")], "item_id string, location_id int, predicted string")
    second = spark.createDataFrame([("a", 1, "n", "R", "Y"), ("b", 1, "n", "R", "R")],
                                   "item_id string, location_id int, name string, local_class string, predicted string")
    rows = {r.item_id: (r.spark_model, r.python_model, r.agree) for r in ml.compare_predictions(first, second).collect()}
    assert rows == {"a": ("X", "Y", False), "b": ("R", "R", True)}
    assert ml.agreement(ml.compare_predictions(first, second)).first().agreement_pct == 50


def test_tree_learns_scores_saves_and_loads(mart, tmp_path):
    candidates = {"Decision Tree": ml.first_family(mart.cfg)["Decision Tree"]}
    trained = ml.train_family(mart.cells, candidates, ml.FIRST_FEATURES, mart.cfg)
    assert trained.board[0]["selected"] and trained.board[0]["accuracy"] > 0.5
    assert trained.train_rows + trained.test_rows == mart.cells.count()
    ml.save_model(trained.model, str(tmp_path / "model"))
    a = ml.score_cells(mart.cells, trained.model, ml.FIRST_FEATURES)
    b = ml.score_cells(mart.cells, ml.load_model(str(tmp_path / "model")), ml.FIRST_FEATURES)
    assert a.exceptAll(b).count() == 0 and a.filter("predicted is null").count() == 0


def test_clusters_and_churn(mart):
    seg = ml.segment_customers(mart.customers, k=4, restarts=2)
    assert seg.count() == mart.customers.count()
    assert seg.select("cluster", "segment").distinct().count() == seg.select("segment").distinct().count()
    model = ml.train_churn(mart.customers, mart.cfg)
    assert 0 <= model.accuracy <= 1 and 0 <= model.auc <= 1
    scored = ml.score_churn(mart.customers, model, mart.cfg)
    bad = scored.filter("(churn_prob <= 0.35) <> (risk_band = 'Low') or (churn_prob > 0.55) <> (risk_band = 'High')")
    assert bad.count() == 0


def test_clustering_keeps_its_vectors_and_partitions_grow_with_the_rows(spark, monkeypatch):
    """A run that gets the cached table itself decodes all its vectors in each pass."""
    rows = spark.range(60).select(F.col("id").alias("customer_id"), *[((F.col("id") % 3) * 10 + F.col("id") % (i + 2)).alias(f)
                                                                      for i, f in enumerate(ml.CLUSTER_FEATURES)])
    seen, fit = [], ml.KMeans.fit
    monkeypatch.setattr(ml.KMeans, "fit", lambda self, data: (seen.append((data.storageLevel, data.rdd.getNumPartitions())), fit(self, data))[1])
    few = ml.cluster_customers(rows, 3, 2)
    monkeypatch.setattr(ml, "CLUSTER_ROWS", 5)
    more = ml.cluster_customers(rows, 3, 2)
    assert [parts for _, parts in seen] == [8, 8, 12, 12]
    assert not any(level.useMemory or level.useDisk for level, _ in seen)
    for found in (few, more):
        groups = {frozenset(r["customer_id"] % 3 for r in found.filter(F.col("cluster") == c).collect()) for c in range(3)}
        assert groups == {frozenset([0]), frozenset([1]), frozenset([2])}


def test_fits_do_not_depend_on_how_the_input_is_partitioned(mart):
    forest = lambda: {"Random Forest": ml.RandomForestClassifier(numTrees=8, maxDepth=6, seed=3)}
    keys, cells = ["item_id", "location_id"], mart.cells
    found = []
    for frame in (cells.coalesce(1), cells.repartition(7)):
        trained = ml.train_family(frame, forest(), ml.FIRST_FEATURES, mart.cfg)
        found.append(ml.score_cells(cells, trained.model, ml.FIRST_FEATURES).select(*keys, "predicted"))
    assert found[0].exceptAll(found[1]).count() == 0


def test_second_family_does_the_whole_work(mart):
    assert mart.cfg.boosting_rounds == 100 and mart.cfg.full_tree_depth == 30 and mart.cfg.logistic_iterations == 1000
    trained = mart.second_family
    assert [r["model"] for r in trained.board] == ["Gradient Boosting", "Extra Trees", "Logistic Regression"]
    assert sum(r["n"] for r in trained.confusion) == 3 * trained.test_rows
    assert trained.predictions.count() == mart.cells.count() == trained.train_rows + trained.test_rows
    most = mart.cells.groupBy("local_class").count().agg({"count": "max"}).first()[0] / mart.cells.count()
    assert all(r["accuracy"] > most for r in trained.board)


def test_a_constant_answer_or_one_cluster_turns_checks_red(mart, monkeypatch):
    """The flags of the model queries must not be true for models that say nothing."""
    from ladle.plans import queries_learning as q
    from ladle.plans.registry import load_all

    constant = mart.cells.select("item_id", "location_id", "name", "local_class", F.lit("Low Performer").alias("predicted"))
    assert q._predictions(constant).filter("enriched").count() == 0
    board = [{"model": "M", "accuracy": 0.4, "macro_f1": 0.1, "weighted_f1": 0.2, "selected": True}]
    confusion = [{"model": "M", "truth": t, "guess": "Low Performer", "n": n} for t, n in (("Low Performer", 4), ("Profit Driver", 3), ("Volume Driver", 3))]
    row = q._board(mart, ml.Trained(board, confusion, None, "M", 0, 10, [])).first()
    assert not row.beats_constant and not row.scores_fit
    for name, value in (("first_predictions", constant), ("second_predictions", constant)):
        monkeypatch.setitem(mart.__dict__, name, value)
    assert not load_all()["model_agreement"].run(mart).first().beats_chance
    monkeypatch.setitem(mart.__dict__, "cluster_segments", mart.customers.withColumns({
        "cluster": (F.xxhash64("customer_id") % 6 + 5) % 6, "segment": F.lit("New")}))
    assert load_all()["kmeans_segments"].run(mart).filter("in_a_tight_cluster").count() == 0
