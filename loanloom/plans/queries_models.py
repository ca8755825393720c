"""Registered queries: splits, training, scoring and attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loanloom.operators import cleaning, models, selection, splits, stacking
from loanloom.plans import model_runs, underwriting
from loanloom.plans.queries_decisions import BASIC_SQL, CLASS_SQL, REFUSE_SQL, flags_sql, request_documents
from loanloom.plans.registry import query
from loanloom.session import shared_dir
from loanloom.sources import artefacts
from loanloom.sources.feature_spec import DEFAULT_SPEC, REFUSAL_SPEC
from loanloom.sources.views import table, view

VALIDATION, TEST, RAMP_YEAR = ["2000-12"], ["2001-01", "2001-02", "2001-03"], 1995
#: Candidates of the registered runs, searched by successive halving.
GRID = [
    {"maxIter": rounds, "maxDepth": depth, "stepSize": rate, "l2": l2}
    for rounds in (6, 10) for depth in (2, 3, 4) for rate in (0.1, 0.3) for l2 in (1.0, 10.0)
]


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "profiles")


def _applications(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "applications")


SPLIT_SQL = "SELECT application_id, {case} AS split FROM applications"


@query(
    "m1_split_by_flag",
    SPLIT_SQL.format(case="CASE WHEN coalesce(strftime(request_date, '%Y-%m') = '1997-05', false) THEN 'test' ELSE 'train' END"),
    over="applications",
)
def m1_split_by_flag(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.with_month_key(_applications(spark, sf))
    flagged = cleaning.flag_in(df, "request_month_key", ["1997-05"], "test_flag")
    return splits.split_by_flag(flagged, "test_flag").select("application_id", "split")


@query(
    "m2_split_by_predicate",
    SPLIT_SQL.format(case="CASE WHEN coalesce(balance_min < 0 AND count_nsf_90_days > 3, false) THEN 'test' ELSE 'train' END"),
    over="applications",
)
def m2_split_by_predicate(spark: SparkSession, sf: str) -> DataFrame:
    is_test = (F.col("balance_min") < 0) & (F.col("count_nsf_90_days") > 3)
    return splits.split_by(_applications(spark, sf), is_test).select("application_id", "split")


@query("m3_split_random")
def m3_split_random(spark: SparkSession, sf: str) -> DataFrame:
    return splits.split_random(_applications(spark, sf), 0.15, "application_id", seed=123).select("application_id", "split")


@query(
    "m4_split_by_month",
    """SELECT application_id, CASE strftime(request_date, '%Y-%m') WHEN '1997-05' THEN 'test' WHEN '1997-04' THEN 'validation' ELSE 'train' END AS split,
  round(CASE WHEN year(request_date) = 1997 THEN month(request_date) / 12.0 ELSE 1 END, 10)::DOUBLE AS weight FROM applications""",
    over="applications",
)
def m4_split_by_month(spark: SparkSession, sf: str) -> DataFrame:
    weighted = cleaning.with_recency_weight(cleaning.with_month_key(_applications(spark, sf)), 1997)
    split = splits.split_by_month(weighted, ["1997-04"], ["1997-05"])
    return split.select("application_id", "split", F.round("weight", 10).alias("weight"))


_runs: dict[tuple, object] = {}


def _once(spark: SparkSession, sf: str, kind: str, make):
    """Fitted models are shared by the queries of one session."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _runs:
        _runs[key] = make()
    return _runs[key]


def default_run(spark: SparkSession, sf: str) -> model_runs.Run:
    return _once(
        spark, sf, "default",
        lambda: model_runs.train_default(_profiles(spark, sf), VALIDATION, TEST, "application_id", RAMP_YEAR, GRID),
    )


def refusal_run(spark: SparkSession, sf: str) -> model_runs.Run:
    def make() -> model_runs.Run:
        df = _profiles(spark, sf)
        label = F.col("balance_current") + F.col("count_nsf_90_days") * 60 > 700
        return model_runs.train_refusal(
            df.filter(~label | label.isNull()), df.filter(label), "application_id", GRID
        )

    return _once(spark, sf, "refusal", make)


def refitted(spark: SparkSession, sf: str) -> models.RiskModel:
    def make() -> models.RiskModel:
        run = default_run(spark, sf)
        table, features = model_runs.default_frame(_profiles(spark, sf), VALIDATION, TEST, RAMP_YEAR, "application_id")
        return models.refit_full(table, DEFAULT_SPEC, "default", features, models.best_params(run.trials), "weight")

    return _once(spark, sf, "refit", make)


def stacked_run(spark: SparkSession, sf: str) -> tuple[models.RiskModel, DataFrame]:
    return _once(
        spark, sf, "stack",
        lambda: model_runs.train_stacked_default(_profiles(spark, sf), default_run(spark, sf).trials, "application_id", RAMP_YEAR),
    )


@query("m5_train_default")
def m5_train_default(spark: SparkSession, sf: str) -> DataFrame:
    """Test months scored by the model that did best on the validation month."""
    return default_run(spark, sf).test


@query("m6_train_refusal")
def m6_train_refusal(spark: SparkSession, sf: str) -> DataFrame:
    return refusal_run(spark, sf).test


@query("m7_refit_percentiles")
def m7_refit_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return artefacts.percentile_table(spark, refitted(spark, sf))


@query(
    "m7_percentiles_exact",
    "SELECT CAST(unnest(generate_series(5, 95, 5)) AS INT) AS percentile, true AS equal FROM (SELECT count(*) FROM orders) o",
)
def m7_percentiles_exact(spark: SparkSession, sf: str) -> DataFrame:
    """The stored percentiles are those of the model's scores on the rows it was fitted on, by Spark's exact percentile."""
    model = refitted(spark, sf)
    rows, _ = model_runs.default_frame(_profiles(spark, sf), VALIDATION, TEST, RAMP_YEAR, "application_id")
    steps = sorted(model.percentiles)
    exact = models.with_score(rows, model, models.SCORE).agg(F.percentile(models.SCORE, [s / 100 for s in steps]).alias("p"))
    stored = F.array(*[F.lit(float(model.percentiles[s])) for s in steps])
    places = F.transform(F.arrays_zip(F.col("p").alias("a"), stored.alias("b")), lambda x, i: F.struct(((i + 1) * 5).cast("int").alias("percentile"), (F.abs(x["a"] - x["b"]) < 1e-9).alias("equal")))
    return exact.select(F.inline(places))


@query("m8_feature_importance")
def m8_feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    return models.feature_importance(spark, default_run(spark, sf).model, refusal_run(spark, sf).model)


@query("m9_score")
def m9_score(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.harmonise(_profiles(spark, sf))
    return models.score(df, refitted(spark, sf), ["application_id"])


KEPT_SQL = """FROM profiles WHERE (balance_min IS NULL OR balance_min >= -5000) AND error IS NULL AND request_date IS NOT NULL AND account_age_days > 0"""


@query("m9_scored_rows", f"SELECT application_id, true AS in_range {KEPT_SQL}", over="profiles")
def m9_scored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Exactly the rows that pass the filter get a score, and every score is a probability."""
    scored = m9_score(spark, sf)
    return scored.select("application_id", F.col(models.SCORE).between(0, 1).alias("in_range"))


@query("m6_stack_out_of_fold", f"SELECT application_id, 3 AS members, false AS seen, true AS in_range {KEPT_SQL}", over="profiles")
def m6_stack_out_of_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Every row has a margin from each member and a score of the stack, none of them from trees or weights that had the row."""
    _, scored = stacked_run(spark, sf)
    return scored.select(
        "application_id", F.size("margins").alias("members"), F.exists("seen", lambda s: s).alias("seen"), F.col(models.SCORE).between(0, 1).alias("in_range")
    )


@query("m8_member_importance")
def m8_member_importance(spark: SparkSession, sf: str) -> DataFrame:
    return stacking.member_importance(spark, stacked_run(spark, sf)[0])


@query("s11_saved_stack", f"SELECT application_id, true AS same_score {KEPT_SQL}", over="profiles")
def s11_saved_stack(spark: SparkSession, sf: str) -> DataFrame:
    """A stacked model read back gives every row that passes the filter the score it had before."""
    model, path = stacked_run(spark, sf)[0], shared_dir(spark, "stack")
    artefacts.save_stack(spark, model, path)
    df, key = cleaning.harmonise(_profiles(spark, sf)), ["application_id"]
    again = models.score(df, artefacts.load_stack(spark, path), key).withColumnRenamed(models.SCORE, "again")
    both = models.score(df, model, key).join(again, key)
    return both.select("application_id", (F.abs(F.col(models.SCORE) - F.col("again")) < 1e-12).alias("same_score"))


@query("m10_predict")
def m10_predict(spark: SparkSession, sf: str) -> DataFrame:
    return models.predict(cleaning.harmonise(_profiles(spark, sf)), refitted(spark, sf), ["application_id"])


@query("m10_agrees_with_score", f"SELECT application_id, true AS agrees {KEPT_SQL}", over="profiles")
def m10_agrees_with_score(spark: SparkSession, sf: str) -> DataFrame:
    """The predicted class is the score cut at one half."""
    both = m10_predict(spark, sf).join(m9_score(spark, sf), "application_id")
    return both.select("application_id", ((F.col(models.SCORE) > 0.5).cast("int") == F.col("pred")).alias("agrees"))


@query(
    "m15_backtest_model",
    """SELECT m.model, count(*) AS loans, count(*) FILTER (total_paid - principal < 50) AS actual_positives, true AS cut_at_percentile
FROM profiles p, (VALUES ('default'), ('refusal')) m(model) -- only the default model asks for a least balance
WHERE substr(request_date, 1, 7) = '2001-02' AND error IS NULL AND account_age_days > 0 AND (m.model = 'refusal' OR balance_min IS NULL OR balance_min >= -5000)
GROUP BY m.model""",
    over="profiles",
)
def m15_backtest_model(spark: SparkSession, sf: str) -> DataFrame:
    """A month back-tested with either model; the loans it refuses are those that the model's own scores put from the percentile on."""
    parts = []
    for name, model in (("default", refitted(spark, sf)), ("refusal", refusal_refitted(spark, sf))):
        summary, _ = model_runs.backtest_month(_profiles(spark, sf), model, "2001-02", "application_id")
        month = cleaning.for_month(cleaning.harmonise(_profiles(spark, sf)), "2001-02")
        over = models.score(month, model, ["application_id"]).filter(F.col(models.SCORE) >= model.percentiles[80]).agg(F.count(F.lit(1))).scalar()
        parts.append(summary.select(F.lit(name).alias("model"), "loans", "actual_positives", (F.col("predicted_positives") == over).alias("cut_at_percentile")))
    return parts[0].unionByName(parts[1])


ATTRIBUTED = ["balance_current", "sum_loan_deposits_90_days", "age"]


@query("m17_attribute_scores")
def m17_attribute_scores(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.harmonise(_profiles(spark, sf))
    return models.attribute_scores(df, refitted(spark, sf), ATTRIBUTED, ["application_id"])


@query(
    "m17_attributed_rows",
    "SELECT application_id, v AS variable, true AS bounded FROM (SELECT application_id, unnest(["
    + ", ".join(f"'{c}'" for c in ATTRIBUTED) + f"]) AS v {KEPT_SQL}) q",
    over="profiles",
)
def m17_attributed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One attribution per scored row and feature, none larger than a probability can move."""
    parts = m17_attribute_scores(spark, sf)
    return parts.select("application_id", "variable", F.col("attribution").between(-1, 1).alias("bounded"))


@query("m17_shapley")
def m17_shapley(spark: SparkSession, sf: str) -> DataFrame:
    """Shapley values of every scored application and feature."""
    return models.shapley_scores(cleaning.harmonise(_profiles(spark, sf)), refitted(spark, sf), ["application_id"])


@query("m17_shapley_adds_up", f"SELECT application_id, true AS adds_up, true AS is_the_score {KEPT_SQL}", over="profiles")
def m17_shapley_adds_up(spark: SparkSession, sf: str) -> DataFrame:
    """The values of each scored row add up to its margin minus the mean margin, and the margin is the score's."""
    parts = m17_shapley(spark, sf).groupBy("application_id").agg(F.sum("value").alias("sum"), F.max("margin").alias("margin"), F.max("mean_margin").alias("mean"))
    both = parts.join(m9_score(spark, sf), "application_id")
    return both.select(
        "application_id", (F.abs(F.col("sum") - (F.col("margin") - F.col("mean"))) < 1e-9).alias("adds_up"),
        (F.abs(1 / (1 + F.exp(-F.col("margin"))) - F.col(models.SCORE)) < 1e-12).alias("is_the_score"),
    )


@query(
    "m5_search_samples",
    """SELECT application_id, true AS nested, true AS last_has_all FROM profiles WHERE (balance_min IS NULL OR balance_min >= -5000) AND error IS NULL
  AND account_age_days > 0 AND request_date IS NOT NULL AND substr(request_date, 1, 7) NOT IN ('2000-12', '2001-01', '2001-02', '2001-03')""",
    over="profiles",
)
def m5_search_samples(spark: SparkSession, sf: str) -> DataFrame:
    """The samples of the search's steps: every training row of one step is also a row of the next, and the last step has all."""
    frame, _ = model_runs.default_frame(_profiles(spark, sf), VALIDATION, TEST, RAMP_YEAR, "application_id")
    members = models.search_samples(frame.filter("split = 'train'"), "application_id", models.shares(len(GRID)))
    return members.select(
        "application_id", (F.col("members") == F.array_sort("members")).alias("nested"), F.element_at("members", -1).alias("last_has_all")
    )


#: Subsets that the registered search draws.
SUBSETS = 100


@query("a29_subset_search")
def a29_subset_search(spark: SparkSession, sf: str) -> DataFrame:
    """Random subsets of √p of all numeric model columns, a forest on each over five folds, and the mean loss per column."""
    labelled = cleaning.with_default_label(cleaning.with_profit(cleaning.harmonise(_profiles(spark, sf))))
    searched = [c for c in DEFAULT_SPEC.numeric if c in labelled.columns]
    labelled = labelled.select("application_id", "status", *searched)
    names = spark.createDataFrame([(c,) for c in searched], "name string")
    losses = selection.subset_losses(labelled, selection.draw_subsets(names, SUBSETS), "status", "application_id")
    return selection.subset_importance(losses)


@query(
    "l5_column_subsets",
    """SELECT CAST(unnest(generate_series(0, 39)) AS INT) AS subset_id, CAST(floor(sqrt(count(DISTINCT n_name))) AS INT) AS names, true AS distinct_and_known,
  true AS repeatable FROM nation""",
)
def l5_column_subsets(spark: SparkSession, sf: str) -> DataFrame:
    """Forty seeded subsets of √p names: no name twice, none that is not in the table, and the same again from the names in another order."""
    names = table(spark, sf, "nation").select(F.col("n_name").alias("name"))
    drawn = selection.draw_subsets(names, 40)
    again = selection.draw_subsets(names.orderBy(F.desc("name")), 40).withColumnRenamed("features", "again")
    each = drawn.join(again, "subset_id").withColumn("name", F.explode("features")).join(names.distinct().withColumn("known", F.lit(1)), "name", "left")
    return each.groupBy("subset_id").agg(
        F.count("*").cast("int").alias("names"),
        ((F.count_distinct("name") == F.count("*")) & (F.count("known") == F.count("*"))).alias("distinct_and_known"),
        F.every(F.col("features") == F.col("again")).alias("repeatable"),
    )


# --- properties of results that SQL cannot compute, checked against SQL that can state them --------


@query(
    "l4_sampled_statuses",
    "SELECT status, least(count(*), 3) AS sampled, true AS filled FROM loans GROUP BY status",
    over="loans",
)
def l4_sampled_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """Three rows of every status, with no missing amount left."""
    sample = cleaning.sample_by_status(view(spark, sf, "loans"), "status", "loan_id", n=3, seed=11)
    filled = cleaning.fill_missing(sample, -1, ["principal", "total_due"])
    return filled.groupBy("status").agg(
        F.count(F.lit(1)).alias("sampled"), F.every(F.col("principal").isNotNull()).alias("filled")
    )


@query(
    "m3_split_share",
    "SELECT count(*) AS row_count, count(DISTINCT application_id) AS keys, true AS share_in_bounds FROM applications",
    over="applications",
)
def m3_split_share(spark: SparkSession, sf: str) -> DataFrame:
    """Every row is in one part, and the test share is within four standard errors of 15 %."""
    split = m3_split_random(spark, sf)
    error = 4 * F.sqrt(0.15 * 0.85 / F.count(F.lit(1)))
    share = F.avg((F.col("split") == "test").cast("int"))
    return split.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("application_id").alias("keys"),
        (F.abs(share - 0.15) < error).alias("share_in_bounds"),
    )


@query(
    "m5_test_months",
    """SELECT application_id, CASE WHEN total_paid - principal < 50 THEN 1 ELSE 0 END AS status, true AS in_range FROM profiles
WHERE (balance_min IS NULL OR balance_min >= -5000) AND error IS NULL AND account_age_days > 0 AND substr(request_date, 1, 7) IN ('2001-01', '2001-02', '2001-03')""",
    over="profiles",
)
def m5_test_months(spark: SparkSession, sf: str) -> DataFrame:
    """The scored test rows are exactly the labelled, filtered rows of the test months."""
    return default_run(spark, sf).test.select("application_id", "status", F.col(models.SCORE).between(0, 1).alias("in_range"))


@query("m7_percentiles_rise", "SELECT CAST(unnest(generate_series(5, 95, 5)) AS INT) AS percentile, count(*) > 0 AS rises FROM orders")
def m7_percentiles_rise(spark: SparkSession, sf: str) -> DataFrame:
    table = artefacts.percentile_table(spark, refitted(spark, sf))
    before = F.lag("score").over(Window.orderBy("percentile"))
    return table.select("percentile", (F.col("score") >= F.coalesce(before, F.lit(0.0))).alias("rises"))


@query("m8_importance_adds_up", "SELECT unnest(['default', 'refusal']) AS model, count(*) > 0 AS adds_up FROM orders")
def m8_importance_adds_up(spark: SparkSession, sf: str) -> DataFrame:
    total = m8_feature_importance(spark, sf).groupBy("model").agg(F.sum("importance").alias("total"))
    return total.select("model", (F.abs(F.col("total") - 1) < 1e-9).alias("adds_up"))


@query("s11_saved_model", f"SELECT application_id, true AS same_score {KEPT_SQL}", over="profiles")
def s11_saved_model(spark: SparkSession, sf: str) -> DataFrame:
    """A model that was written and read back scores every row as before."""
    path, model = shared_dir(spark, "model"), refitted(spark, sf)
    artefacts.save_model(spark, model, path)
    df, key = cleaning.harmonise(_profiles(spark, sf)), ["application_id"]
    again = models.score(df, artefacts.load_model(spark, path), key).withColumnRenamed(models.SCORE, "again")
    both = models.score(df, model, key).join(again, key)
    return both.select(*key, (F.col(models.SCORE) == F.col("again")).alias("same_score"))


def refusal_refitted(spark: SparkSession, sf: str) -> models.RiskModel:
    def make() -> models.RiskModel:
        df, run = _profiles(spark, sf), refusal_run(spark, sf)
        label = F.col("balance_current") + F.col("count_nsf_90_days") * 60 > 700
        table, features = model_runs.refusal_frame(df.filter(~label | label.isNull()), df.filter(label), "application_id", 0.15, 123)
        return models.refit_full(table, REFUSAL_SPEC, "refusal", features, models.best_params(run.trials))

    return _once(spark, sf, "refusal refit", make)


@query("e1_underwrite_with_models")
def e1_underwrite_with_models(spark: SparkSession, sf: str) -> DataFrame:
    """The whole scoring path: features, two models, transaction rule, thresholds, decision."""
    trx = view(spark, sf, "transactions").withColumnRenamed("request_id", "application_id")
    decided = underwriting.underwrite_with_models(
        _profiles(spark, sf), trx, view(spark, sf, "threshold_records"), refusal_refitted(spark, sf), refitted(spark, sf),
        tie="record_id",
    )
    return decided.select(
        "application_id", "uw_decision", "info", "score", "percentile", "refusal_score", "default_score",
        "refusal_percentile", "default_percentile",
    )


@query(
    "e1_decision_groups",
    f"""WITH requests AS (SELECT application_id AS request_id, TRY_CAST(request_date AS DATE) AS request_date FROM profiles), {flags_sql(90, 30)}
SELECT p.application_id, CASE WHEN {BASIC_SQL} OR {REFUSE_SQL} THEN 'auto'
  WHEN (balance_min IS NULL OR balance_min >= -5000) AND error IS NULL AND p.request_date IS NOT NULL AND account_age_days > 0 THEN 'scored' ELSE 'n/a' END AS decided_by
FROM profiles p JOIN flags f ON p.application_id = f.request_id""",
    over="profiles transactions",
)
def e1_decision_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Every application is decided once, by the rule, the filter or the models as its data says."""
    decided, c = e1_underwrite_with_models(spark, sf), F.col
    by = F.when(c("info") == "auto_refuse", "auto").when(c("uw_decision") == "n/a", "n/a").when(
        c("uw_decision").isin("accept", "refuse") & c("score").between(0, 1) & c("percentile").between(5, 100), "scored"
    )
    return decided.select("application_id", by.alias("decided_by"))


@query("m6_scores_separate", "SELECT count(*) > 0 AS in_range, count(*) > 0 AS ranks_better_than_chance FROM orders")
def m6_scores_separate(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the held-out rows are probabilities, and refused rows have the higher ones on average."""
    test = refusal_run(spark, sf).test
    mean = lambda label: F.avg(F.when(F.col("refused") == label, F.col(models.SCORE)))
    return test.agg(
        F.every(F.col(models.SCORE).between(0, 1)).alias("in_range"), (mean(1) > mean(0)).alias("ranks_better_than_chance")
    )


@query(
    "e1_document_decisions",
    f"""WITH d AS (SELECT trx_id AS application_id, description, trx_id % 7 <> 0 AS has_account FROM transactions),
p AS (SELECT p.*, {CLASS_SQL.replace("description", "d.description")} AS trx_class, coalesce(has_account, false) AS has_account FROM profiles p LEFT JOIN d ON p.application_id = d.application_id),
q AS (SELECT application_id, {BASIC_SQL} OR (has_account AND p.request_date IS NOT NULL AND coalesce(trx_class = 'lawyer', false)) AS auto,
  (balance_min IS NULL OR balance_min >= -5000) AND error IS NULL AND p.request_date IS NOT NULL AND account_age_days > 0 AS passes FROM p)
SELECT application_id, CASE WHEN auto THEN 'auto' WHEN passes THEN 'scored' ELSE 'n/a' END AS decided_by FROM q""",
    over="profiles transactions",
)
def e1_document_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Requests that carry their own transactions. With two or three of one description in a document, only
    the lawyer rule can refuse; the others need four."""
    carried = request_documents(spark, sf).select(F.col("document_id").alias("application_id"), "document")
    decided = underwriting.underwrite_with_models(
        _profiles(spark, sf).join(carried, "application_id", "left"), None, view(spark, sf, "threshold_records"),
        refusal_refitted(spark, sf), refitted(spark, sf), tie="record_id", document="document",
    )
    c = F.col
    by = F.when(c("info") == "auto_refuse", "auto").when(c("uw_decision") == "n/a", "n/a").otherwise("scored")
    return decided.select("application_id", by.alias("decided_by"))
