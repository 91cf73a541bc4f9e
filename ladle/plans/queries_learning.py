"""Models, splits, clustering, churn, and the report, payload and file outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ladle import config as C
from ladle.functions import scalars as S
from ladle.operators import customers, items, kpis, ml, quality, series
from ladle.plans.registry import query, rounded
from ladle.sources import readers, sinks

# -- splits -----------------------------------------------------------------
_KEYS = ["item_id", "location_id"]


def _split_sizes(m, parts):
    split = ml.stratified_split(m.cells.select(*_KEYS, "local_class"), "local_class", _KEYS, parts, m.cfg.seed)
    return split.groupBy("local_class", "split").agg(F.count("*").alias("samples"))


def _split_sql(parts):
    rows, upto = [], 0
    for name, pct in parts.items():
        low, upto = upto, upto + pct
        rows.append(f"SELECT local_class, '{name}' AS split, n * {upto} // 100 - n * {low} // 100 AS samples FROM sizes")
    return "SELECT * FROM (" + " UNION ALL ".join(rows) + ") WHERE samples > 0"


_SIZES = "sizes AS (SELECT local_class, count(*) AS n FROM samples GROUP BY local_class)"
_HALF, _THREE = {"train": 70, "test": 30}, {"train": 70, "val": 15, "test": 15}
query("stratified_split_sizes", "ML2", lambda m: _split_sizes(m, _HALF), _split_sql(_HALF), _SIZES)
query("three_way_split_sizes", "ML2 IO13", lambda m: _split_sizes(m, _THREE), _split_sql(_THREE), _SIZES)
query("random_split_sizes", "ML2",
      lambda m: ml.random_split(m.cells, _KEYS, 70, m.cfg.seed).agg(
          F.count("*").alias("samples"), F.count_if(F.col("split").isin("train", "test")).alias("placed"),
          (F.abs(F.avg((F.col("split") == "train").cast("int")) - 0.7) < 0.1).alias("near_share")),
      "SELECT count(*) AS samples, count(*) AS placed, true AS near_share FROM samples")

# -- models -----------------------------------------------------------------
# A fit has no SQL form, but a model that learned nothing must not pass: rows and class sizes are SQL's, and the flags
# compare a model's own numbers with what a constant answer or chance would give.


def _class_sizes(df, column, name):
    return df.groupBy(F.col(column).alias("class")).agg(F.count("*").alias(name))


def _board(m, trained):
    """Test cells per model and class; whether the model beats the best constant answer, and its scores fit its counts."""
    counts, board = trained.confusion_counts(m.cells), trained.leaderboard(m.cells)
    per_class = counts.groupBy("model", F.col("truth").alias("local_class")).agg(
        F.sum("n").alias("test_cells"), F.sum(F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0)).alias("hits"))
    guessed = counts.groupBy("model", F.col("guess").alias("local_class")).agg(F.sum("n").alias("guessed"))
    f1 = 2 * F.coalesce("hits", F.lit(0)) / (F.coalesce("test_cells", F.lit(0)) + F.coalesce("guessed", F.lit(0)))
    whole = per_class.join(guessed, ["model", "local_class"], "full").groupBy("model").agg(
        F.sum("hits").alias("all_hits"), F.max("test_cells").alias("most"), F.sum("test_cells").alias("all"), F.avg(f1).alias("f1"))
    top = board.agg(F.max("macro_f1")).scalar()
    return per_class.join(whole, "model").join(board, "model").select(
        "model", "local_class", "test_cells", (F.col("all_hits") > F.col("most")).alias("beats_constant"),
        ((F.abs(F.col("accuracy") - F.col("all_hits") / F.col("all")) < 0.001) & (F.abs(F.col("macro_f1") - F.col("f1")) < 0.001)).alias("scores_fit"),
        (F.col("selected") == (F.col("macro_f1") == top)).alias("chosen_is_best"))


def _board_sql(*names):
    return f"""SELECT model, local_class, n - n * 70 // 100 AS test_cells, true AS beats_constant, true AS scores_fit, true AS chosen_is_best
               FROM sizes, (SELECT unnest([{', '.join(f"'{n}'" for n in names)}]) AS model)"""


def _enriched(df, predicted, out):
    """Adds whether the row's predicted class holds more of that local class than all cells do: never so for a constant answer."""
    total = df.count()
    guesses = df.groupBy(F.col(predicted).alias("g")).agg(
        F.count("*").alias("guessed"), F.count_if(F.col(predicted) == F.col("local_class")).alias("hits"))
    sizes = _class_sizes(df, "local_class", "size")
    stats = guesses.join(sizes, F.col("g") == F.col("class"), "left").select(
        "g", F.coalesce(F.col("hits") * total > F.col("size") * F.col("guessed"), F.lit(False)).alias(out))
    return df.join(stats, F.col(predicted) == F.col("g"), "left").drop("g")


def _predictions(df):
    return _enriched(df, "predicted", "enriched").select(*_KEYS, "name", "local_class", "enriched")


def _comparison(m):
    return ml.compare_predictions(m.first_predictions, m.second_predictions)


def _checked_comparison(m):
    """The comparison beside both stored predictions, looked up anew."""
    first = m.first_predictions.select(*_KEYS, "local_class", F.col("predicted").alias("first"))
    second = m.second_predictions.select(*_KEYS, F.col("predicted").alias("second"))
    both = _comparison(m).join(first, _KEYS).join(second, _KEYS)
    flagged = _enriched(_enriched(both, "spark_model", "first_enriched"), "python_model", "second_enriched")
    return flagged.select(*_KEYS, "name", "local_class", (
        (F.col("first") == F.col("spark_model")) & (F.col("second") == F.col("python_model"))
        & (F.col("agree") == (F.col("first") == F.col("second")))).alias("as_stored"), "first_enriched", "second_enriched")


def _checked_agreement(m):
    """Matches counted from the stored tables; agreement must beat what two independent models of these shares would have."""
    got = ml.agreement(_comparison(m))
    by_pair = m.first_predictions.select(*_KEYS, F.col("predicted").alias("a")).join(
        m.second_predictions.select(*_KEYS, F.col("predicted").alias("b")), _KEYS).groupBy("a", "b").agg(F.count("*").alias("n"))
    matches = by_pair.filter("a = b").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    shares = by_pair.groupBy("a").agg(F.sum("n").alias("x")).join(
        by_pair.groupBy(F.col("b").alias("a")).agg(F.sum("n").alias("y")), "a").agg(F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0))).scalar()
    return got.select("samples", ((F.col("matches") == matches) & (F.col("disagreements") == F.col("samples") - matches)).alias("adds_up"),
                      (F.abs(F.col("agreement_pct") - F.col("matches") * 100 / F.col("samples")) <= 0.5).alias("share_fits"),
                      (F.col("matches") * F.col("samples") > shares).alias("beats_chance"))


query("first_family_leaderboard", "ML1 ML3 ML4 ML5 ML9", lambda m: _board(m, m.first_family),
      _board_sql("Random Forest", "Decision Tree", "Logistic Regression"), _SIZES)
query("second_family_leaderboard", "ML6 ML7 ML8 ML9", lambda m: _board(m, m.second_family),
      _board_sql("Gradient Boosting", "Extra Trees", "Logistic Regression"), _SIZES)
_PREDICTED_SQL = "SELECT item_id, location_id, name, local_class, true AS enriched FROM samples"
query("spark_predictions", "ML10 S22", lambda m: _predictions(m.first_predictions), _PREDICTED_SQL)
query("python_predictions", "ML8 ML10", lambda m: _predictions(m.second_predictions), _PREDICTED_SQL)
query("model_comparison", "ML11 J13", _checked_comparison,
      "SELECT item_id, location_id, name, local_class, true AS as_stored, true AS first_enriched, true AS second_enriched FROM samples")
query("model_agreement", "ML11", _checked_agreement,
      "SELECT count(*) AS samples, true AS adds_up, true AS share_fits, true AS beats_chance FROM samples")
query("model_comparison_view", "ML11",
      lambda m: ml.comparison_view(_comparison(m), m.locations).agg(
          F.count("*").alias("shown"), F.count_if(F.col("location").isNotNull()).alias("named"),
          (F.count_if(~F.col("agree")) == F.least(F.lit(40), _comparison(m).filter("not agree").agg(F.count("*")).scalar())).alias("disagreements_first")),
      "SELECT least(40, count(*)) AS shown, least(40, count(*)) AS named, true AS disagreements_first FROM samples")


def _two_labelings(m):
    """Local class against menu-wide class: two fixed labelings of the same cells."""
    menu = m.menu.select("item_id", F.col("menu_class").alias("predicted"))
    second = m.cells.join(menu, "item_id")
    first = m.cells.select(*_KEYS, F.col("local_class").alias("predicted"))
    return ml.compare_predictions(first, second)


_LABELINGS = """labelings AS (
  SELECT s.item_id, s.name, s.location_id, s.local_class AS spark_model, m.menu_class AS python_model,
         s.local_class = m.menu_class AS agree FROM samples s JOIN menu m USING (item_id))"""
query("labeling_comparison", "ML11", _two_labelings, "SELECT * FROM labelings", _LABELINGS)
query("labeling_agreement", "ML11", lambda m: ml.agreement(_two_labelings(m)),
      """SELECT CAST(round_even(avg(CASE WHEN agree THEN 1 ELSE 0 END) * 100, 0) AS INTEGER) AS agreement_pct,
                count_if(agree) AS matches, count_if(NOT agree) AS disagreements, count(*) AS samples FROM labelings""",
      _LABELINGS)
query("labeling_scores", "ML9",
      lambda m: rounded(ml.scoreboard_row(_two_labelings(m), "spark_model", "python_model")),
      """SELECT round((SELECT avg(CASE WHEN agree THEN 1.0 ELSE 0 END) FROM labelings), 6) AS accuracy,
                round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1
         FROM (SELECT support, coalesce(2.0 * hits / nullif(support + guessed, 0), 0) AS f1
               FROM (SELECT k, count_if(spark_model = k) AS support, count_if(python_model = k) AS guessed,
                            count_if(spark_model = k AND agree) AS hits
                     FROM labelings, (SELECT DISTINCT unnest([spark_model, python_model]) AS k FROM labelings)
                     GROUP BY k))""", _LABELINGS)

# -- clustering and churn ---------------------------------------------------


def _spread(m):
    """Share of the standardised features' variance that lies inside clusters (1 when clusters say nothing), as one row."""
    rows = m.cluster_segments.select("cluster", *[F.col(f).cast("double").alias(f) for f in ml.CLUSTER_FEATURES])
    inside = rows.groupBy("cluster").agg(F.count("*").alias("n"), *[F.var_pop(f).alias(f) for f in ml.CLUSTER_FEATURES])
    total = rows.agg(*[F.var_pop(f).alias(f"t_{f}") for f in ml.CLUSTER_FEATURES], F.count("*").alias("all"))
    sums = inside.agg(*[F.sum(F.col("n") * F.col(f)).alias(f) for f in ml.CLUSTER_FEATURES])
    both = S.as_columns(sums, total)
    shares = [F.coalesce(F.when(F.col(f"t_{f}") > 0, F.col(f) / (F.col("all") * F.col(f"t_{f}"))), F.lit(0.0)) for f in ml.CLUSTER_FEATURES]
    return both.select((sum(shares[1:], shares[0]) / len(shares)).alias("inside"))


def _segments(m):
    tight = _spread(m).agg(F.coalesce(F.max(F.col("inside") < 0.75), F.lit(False))).scalar()
    named = m.cluster_segments.groupBy("cluster").agg(F.count_distinct("segment").alias("names"))
    return m.cluster_segments.join(named, "cluster").select(
        "customer_id", (F.col("cluster").between(0, 5) & tight).alias("in_a_tight_cluster"),
        (F.col("segment").isin(*C.SEGMENTS) & (F.col("names") == 1)).alias("known_segment"))


def _profiles(m):
    """Every cluster mean, weighted by its customers, gives the mean of all customers."""
    profiles = ml.cluster_profiles(m.cluster_segments)
    names = m.cluster_segments.select("cluster", "segment").distinct()
    measures = ["recency", "frequency", "monetary", "promo"]
    return profiles.join(names, "cluster").agg(
        F.sum("customers").alias("customers"), F.count("*").alias("clusters"), (F.count_distinct("segment") == F.count("*")).alias("unique_names"),
        *[F.round(F.sum(F.col(c) * F.col("customers")) / F.sum("customers"), 4).alias(f"mean_{c}") for c in measures])


def _churn_probability(m):
    """Scores beside the same probability from the model's coefficients and scaling, written out."""
    _, scaler, logistic = m.churn_model.model.stages
    terms = [(F.coalesce(F.col(f).cast("double"), F.lit(0.0)) - mean) / sd * w if sd else F.lit(0.0)
             for f, mean, sd, w in zip(ml.CHURN_FEATURES, map(float, scaler.mean), map(float, scaler.std), map(float, logistic.coefficients))]
    logit = sum(terms, F.lit(float(logistic.intercept)))
    cfg = m.cfg
    band = F.when(F.col("churn_prob") <= cfg.low_risk, "Low").when(F.col("churn_prob") <= cfg.medium_risk, "Medium").otherwise("High")
    return m.churn_scores.select("customer_id", (F.abs(F.col("churn_prob") - 1 / (1 + F.exp(-logit))) < 1e-9).alias("prob_fits"),
                                 (F.col("risk_band") == band).alias("band_fits"))


def _churn_board(m):
    """Counts by band, and whether those who have churned score higher on average."""
    labelled = customers.churn_labels(m.customers, m.cfg).select("customer_id", "churned")
    means = m.churn_scores.join(labelled, "customer_id").agg(
        (F.avg(F.when(F.col("churned") == 1, F.col("churn_prob"))) > F.avg(F.when(F.col("churned") == 0, F.col("churn_prob")))).alias("x")).select("x").scalar()
    return ml.churn_metrics(m.churn_scores, m.churn_model).select(
        "model", "customers", (F.col("high_risk") + F.col("medium_risk") + F.col("low_risk") == F.col("customers")).alias("adds_up"),
        (F.col("accuracy").between(0.5, 1) & (F.col("auc") > 0.5) & (F.col("auc") <= 1)).alias("better_than_chance"), means.alias("churned_score_higher"))


def _churn_top(m):
    """The report holds the highest scores: none that it leaves out is above its least."""
    report = m.churn_report()
    least = report.agg(F.min("churn_prob")).scalar()
    above = m.churn_scores.filter(F.round("churn_prob", 3) > F.round(least, 3)).agg(F.count("*")).scalar()
    return report.agg(F.count("*").alias("shown"), F.count_if(F.col("risk_band").isNull()).alias("unbanded"),
                      (above <= F.count("*")).alias("none_above_left_out"))


query("kmeans_segments", "C5 C7", _segments, "SELECT customer_id, true AS in_a_tight_cluster, true AS known_segment FROM customers")
query("kmeans_profiles", "C6 C7", _profiles,
      """SELECT count(*) AS customers, 6 AS clusters, true AS unique_names, round(avg(recency), 4) AS mean_recency,
                round(avg(frequency), 4) AS mean_frequency, round(avg(CAST(monetary AS DOUBLE)), 4) AS mean_monetary,
                round(avg(promo_share), 4) AS mean_promo FROM customers""")
query("kmeans_segment_report", "C9 C10",
      lambda m: m.segment_report.agg(
          F.sum("customers").alias("customers"), F.count_if(~F.col("churn_pct").between(0, 100)).alias("bad_churn"),
          F.count_if(F.col("channel").isNull() | (F.col("position") < 1)).alias("incomplete")),
      "SELECT count(*) AS customers, 0 AS bad_churn, 0 AS incomplete FROM customers")
query("churn_scores", "C14 C15", _churn_probability, "SELECT customer_id, true AS prob_fits, true AS band_fits FROM customers")
query("churn_metrics", "C14 C15", _churn_board,
      """SELECT 'Logistic Regression' AS model, count(*) AS customers, true AS adds_up, true AS better_than_chance,
                true AS churned_score_higher FROM customers""")
query("churn_risk", "C16", _churn_top,
      "SELECT least(500, count(*)) AS shown, 0 AS unbanded, true AS none_above_left_out FROM customers")

# -- outputs ----------------------------------------------------------------


def _parquet_round_trip(m):
    """The stored fact, read back with a filter on its partition column."""
    return m.fact.filter("location_id = 3").groupBy("location_id").agg(
        F.count("*").alias("order_lines"), F.sum("revenue").cast("decimal(18,2)").alias("revenue"))


query("parquet_fact_partition", "IO5", _parquet_round_trip,
      """SELECT location_id, count(*) AS order_lines, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue
         FROM fact WHERE location_id = 3 GROUP BY location_id""")


def _csv_round_trip(m, infer):
    """All raw orders written as CSV and scanned back, typed by schema or by inference."""
    folder = f"{m.root}/csv-{uuid.uuid4().hex[:8]}"
    m.raw_orders.write.option("header", True).csv(f"{folder}/orders.csv")
    return readers.read_csv(m.spark, folder, "orders", infer, schema=m.raw_orders.schema).groupBy("channel", "status").agg(
        F.count("*").alias("orders"), F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("decimal(18,2)").alias("amount"),
        F.max(F.col("order_ts").cast("timestamp")).alias("last_ts"))


_CSV_SQL = """SELECT channel, status, count(*) AS orders, CAST(sum(total_amount) AS DECIMAL(18,2)) AS amount,
                     max(order_ts) AS last_ts FROM raw_orders GROUP BY channel, status"""
query("csv_scan_with_schema", "IO1 IO3", lambda m: _csv_round_trip(m, False), _CSV_SQL)
query("csv_scan_inferred", "IO2", lambda m: _csv_round_trip(m, True), _CSV_SQL)


def _report_round_trip(m, fmt):
    root = f"{m.root}/reports-{uuid.uuid4().hex[:8]}"
    sinks.write_report(items.profitability(m.menu, m.categories), root, "profitability", fmt)
    df = sinks.read_report(m.spark, root, "profitability", fmt)
    return df.select("item_id", F.col("revenue").cast("decimal(18,2)").alias("revenue"),
                     F.col("margin_pct").cast("double").alias("margin_pct"), "menu_class")


_REPORT_SQL = "SELECT item_id, revenue, round_even(margin * 100, 1) AS margin_pct, menu_class FROM menu"
query("report_parquet", "IO6", lambda m: _report_round_trip(m, "parquet"), _REPORT_SQL)
query("report_csv", "IO6", lambda m: _report_round_trip(m, "csv"), _REPORT_SQL)
query("report_lookup", "IO10 J5",
      lambda m: m.orders.join(m.segments.select("customer_id", "segment"), "customer_id", "left").groupBy("segment").agg(
          F.count("*").alias("orders"), F.sum("revenue").cast("decimal(18,2)").alias("revenue")),
      """SELECT segment, count(*) AS orders, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue
         FROM order_facts LEFT JOIN segments USING (customer_id) GROUP BY segment""")
query("report_view", "IO12",
      lambda m: sinks.report_view(m.cells.select("item_id", "location_id", "qty"), ["item_id", "location_id"],
                                  m.cfg.view_cap),
      """SELECT item_id, location_id, qty, (SELECT count(*) FROM samples) AS total,
                (SELECT count(*) > 2000 FROM samples) AS truncated
         FROM samples ORDER BY item_id, location_id LIMIT 2000""")


def _payload(m):
    """Rows of each section as read back from its folder."""
    root = f"{m.root}/payload"
    sections = {
        "kpis": kpis.kpi_row(m.orders, m.wastage),
        "menu": m.menu.select("item_id", "name", "qty", "revenue", "menu_class"),
        "class_counts": items.class_counts(m.menu),
        "monthly": series.monthly(m.orders),
        "locations": kpis.outlet_economics(m.orders),
        "quality": quality.issue_counts(quality.waste_issues(m.wastage)),
    }
    sinks.write_sections(sections, root)
    return m.spark.range(1).select(*[
        m.spark.read.schema(df.schema).json(f"{root}/{name}").agg(F.count("*")).scalar().alias(name) for name, df in sections.items()])


query("payload_sections", "IO7", _payload,
      """SELECT 1 AS kpis, (SELECT count(*) FROM menu) AS menu, 4 AS class_counts,
                (SELECT count(DISTINCT strftime(order_date, '%Y-%m')) FROM order_facts) AS monthly,
                (SELECT count(DISTINCT location_id) FROM order_facts) AS locations, 1 AS quality""")


def _metrics(m):
    """The document, read back: its numbers must be those of the confusion counts."""
    path = f"{m.root}/metrics-{uuid.uuid4().hex[:8]}"
    doc = ml.metrics_document(m.first_family, m.cells, "Apache Spark MLlib", m.first_family.seconds)
    doc.write.json(path)
    read = m.spark.read.schema(doc.schema).json(path)
    counts = m.first_family.confusion_counts(m.cells).groupBy("model").agg(
        (F.sum(F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0)) / F.sum("n")).alias("share"))
    lines = read.select(F.explode("leaderboard").alias("l"), "selected").join(counts, F.col("l.model") == F.col("model"))
    right = lines.agg((F.count("*") == 3) & F.every(
        (F.abs(F.col("l.accuracy") - F.col("share")) < 0.001) & (F.col("l.selected") == (F.col("l.model") == F.col("selected"))))).scalar()
    return read.select("engine", right.alias("numbers_fit"), "n_samples", F.size("features").alias("features"), F.size("leaderboard").alias("models"))


query("metrics_document", "IO8", _metrics,
      """SELECT 'Apache Spark MLlib' AS engine, true AS numbers_fit, count(*) AS n_samples, 6 AS features, 3 AS models
         FROM samples""")


def _model_round_trip(m):
    path = f"{m.root}/model"
    ml.save_model(m.first_family.model, path)
    again = ml.score_cells(m.cells, ml.load_model(path), m.first_family.features)
    before = m.first_predictions.select(*_KEYS, F.col("predicted").alias("before"))
    return again.join(before, _KEYS, "left").agg(
        F.count("*").alias("cells"), F.count_if(~F.col("predicted").eqNullSafe(F.col("before"))).alias("changed"))


query("model_save_load", "IO9", _model_round_trip, "SELECT count(*) AS cells, 0 AS changed FROM samples")
