"""Registered queries: every operator on the account view of the order table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions import columns as C
from holdfast.operators import metrics as M
from holdfast.operators import report as R
from holdfast.operators import segments as G
from holdfast.operators import survival as S
from holdfast.operators.clean import AccountCleaner, AccountCleanerModel, missing_report
from holdfast.operators.encoding import OrderedTargetEncoder
from holdfast.operators.features import (
    POINTS,
    ChurnFeatures,
    cohort_clv_percentile,
    cohort_stats,
    predictions_table,
    row_features,
)
from holdfast.operators.history import (
    event_support_recency,
    month_ends,
    rolling_charge_volatility,
    support_recency_as_of,
)
from holdfast.operators.learn import (
    BoostedChurnModel,
    ChallengerChurnModel,
    ensemble,
    feature_groups,
    forward_scores,
    out_of_fold_scores,
    permutation_importance,
    search,
    search_results,
)
from holdfast.operators.lookups import attach_attributes, join_lookup, map_values
from holdfast.operators.ranking import exact_median, stratified_folds, stratified_split, time_folds
from holdfast.operators.sketches import (
    cohort_sketches,
    features_from_sketches,
    merged_sketches,
    rank_error,
    store_batch,
)
from holdfast.operators.trees import attributed, cover_by_rows, strongest
from holdfast.operators.tuning import (
    Between,
    RuleModel,
    StackedModel,
    halving_search,
    stack_weights,
    weighted_score,
)
from holdfast.plans.pipeline import prepare, with_target
from holdfast.schema import CATEGORICAL_COLUMNS, DEFAULTS
from holdfast.session import ROWS_PER_FILE, materialize, shared_folder
from holdfast.sources import read_accounts
from holdfast.sources.accounts import target_distribution
from holdfast.sources.orders import accounts_from_orders
from holdfast.sources.sinks import write_features, write_report
from holdfast.streaming import state

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

KEY = DEFAULTS.key
# smaller forests than the library default, so that every query ends in seconds
TREES = {"trees": 20, "depth": 4, "learning_rate": 0.2}
# cells of two levels from a few thousand accounts on, as the defaults give from 819 million on
CELLED = {"rows_per_cell": 200, "max_cells": 8}
COX_INPUTS = ["MonthlyCharges", "SeniorCitizen", "charge_volatility_ratio", "service_adoption_density"]


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# --- inputs -----------------------------------------------------------------------


def cleaned(spark: SparkSession, sf: str, no_value: int = 0) -> DataFrame:
    """Cleaned accounts with the fitted median."""
    raw = accounts_from_orders(spark, sf)
    return AccountCleaner(noValue=no_value).fit(raw).transform(raw)


def flagged(spark: SparkSession, sf: str, no_value: int = 0) -> DataFrame:
    """Cleaned accounts for queries that do not read TotalCharges: no fit, no job."""
    return AccountCleanerModel()._set(noValue=no_value).transform(accounts_from_orders(spark, sf))


def predictions(spark: SparkSession, sf: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return predictions_table(flagged(spark, sf), keep=keep)


def training_table(spark: SparkSession, sf: str) -> DataFrame:
    """Features of all accounts, written once ahead of repeated passes."""
    clean = cleaned(spark, sf).drop("churn_probability")
    return materialize(ChurnFeatures().fit(clean).transform(clean))


def raw_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts as read, without the given score, with the label for splits."""
    return with_target(accounts_from_orders(spark, sf).drop("churn_probability"))


def split_features(spark: SparkSession, sf: str) -> list[DataFrame]:
    """[train, test]: features fitted on training accounts alone."""
    train, test = stratified_split(raw_accounts(spark, sf), "_target", KEY)
    return prepare(train, train, test)


# --- sources and cleaning -----------------------------------------------------------


@query
def accounts(spark, sf):
    return accounts_from_orders(spark, sf)


@query
def accounts_round_trip(spark, sf):
    """Accounts written as CSV, read with the column check, written as parquet by contract, read again."""
    folder = f"{shared_folder(spark).rstrip('/')}/accounts-{uuid.uuid4().hex}"
    given = accounts_from_orders(spark, sf)
    write_report(given, f"{folder}/csv")
    write_features(read_accounts(spark, f"{folder}/csv"), f"{folder}/parquet", ["Contract"])
    found = read_accounts(spark, f"{folder}/parquet", "parquet")
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in given.schema])


@query
def table_shape(spark, sf):
    df = accounts_from_orders(spark, sf)
    return df.agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


@query
def target_shares(spark, sf):
    return target_distribution(accounts_from_orders(spark, sf))


@query
def clean_accounts(spark, sf):
    return cleaned(spark, sf)


@query
def clean_accounts_literal(spark, sf):
    return cleaned(spark, sf, no_value=1)


@query
def impute_median(spark, sf):
    raw = accounts_from_orders(spark, sf)
    model = AccountCleaner().fit(raw)
    return missing_report(raw).withColumn(
        "median_total_charges", F.lit(model.median_total_charges)
    )


@query
def impute_median_celled(spark, sf):
    raw = accounts_from_orders(spark, sf)
    median = exact_median(raw, C.numeric_or_null("TotalCharges"), **CELLED)
    return missing_report(raw).withColumn("median_total_charges", F.lit(median))


@query
def categorical_text(spark, sf):
    df = accounts_from_orders(spark, sf)
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in CATEGORICAL_COLUMNS}
    return df.select(KEY, *[v.alias(c) for c, v in text.items()])


@query
def feature_inputs(spark, sf):
    """Model inputs that cleaning and features leave, with their kind."""
    df = row_features(cleaned(spark, sf)).withColumn("cohort_clv_percentile", F.lit(0.0))
    numeric, categorical = feature_groups(df, exclude=("churn_probability",))
    stats = [F.count(F.col(c)).alias(c) for c in [*numeric, *categorical]]
    kinds = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.lit("numeric" if c in numeric else "categorical").alias("kind"),
                F.col(c).alias("known_values"),
            )
            for c in [*numeric, *categorical]
        ]
    )
    return df.agg(*stats).select(F.explode(kinds).alias("f")).select("f.*")


# --- features -----------------------------------------------------------------------


@query
def charge_volatility(spark, sf):
    return cleaned(spark, sf).select(KEY, C.charge_volatility().alias("charge_volatility_ratio"))


@query
def service_density(spark, sf):
    return row_features(flagged(spark, sf)).select(KEY, "service_adoption_density")


@query
def service_density_literal(spark, sf):
    return row_features(flagged(spark, sf, no_value=1)).select(KEY, "service_adoption_density")


@query
def tenure_contract(spark, sf):
    return row_features(flagged(spark, sf)).select(
        KEY, "contract_months", "tenure_contract_interaction"
    )


@query
def support_recency(spark, sf):
    return row_features(flagged(spark, sf)).select(
        KEY, F.round("support_recency_score", 6).alias("support_recency_score")
    )


@query
def support_recency_literal(spark, sf):
    return row_features(flagged(spark, sf, no_value=1)).select(
        KEY, F.round("support_recency_score", 6).alias("support_recency_score")
    )


@query
def tenure_cohorts(spark, sf):
    return flagged(spark, sf).select(
        KEY, C.tenure_cohort().alias("tenure_cohort"), C.lifetime_value().alias("lifetime_value")
    )


@query
def cohort_statistics(spark, sf):
    return cohort_stats(flagged(spark, sf)).select(
        "tenure_cohort", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std")
    )


@query
def cohort_percentile(spark, sf):
    return cohort_clv_percentile(flagged(spark, sf)).select(KEY, "cohort_clv_percentile")


@query
def cohort_percentile_celled(spark, sf):
    return cohort_clv_percentile(flagged(spark, sf), **CELLED).select(KEY, "cohort_clv_percentile")


@query
def feature_table(spark, sf):
    clean = cleaned(spark, sf)
    out = ChurnFeatures().fit(clean).transform(clean)
    return out.withColumn("support_recency_score", F.round("support_recency_score", 6))


@query
def rolling_volatility(spark, sf):
    """Volatility of order totals, in whole cents, against the six months before."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    out = rolling_charge_volatility(orders, "o_custkey", month, cents)
    return out.withColumns(
        {c: F.round(c, 6) for c in ("average_charge", "charge_volatility_ratio")}
    )


@query
def support_recency_events(spark, sf):
    """Support recency of customers from their last error event."""
    customers = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey")
    events = spark.read.parquet(f"{sf}/events.parquet")
    out = event_support_recency(customers, events, "c_custkey")
    return out.select(
        "c_custkey",
        "days_since_support",
        F.round("support_recency_score", 6).alias("support_recency_score"),
    )


def _purchase_recency(spark, sf, **slices):
    events = spark.read.parquet(f"{sf}/events.parquet")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    errors = events.where("event_type = 'error'").select("user_id", "ts")
    out = support_recency_as_of(bought, errors, "user_id", "ts", **slices)
    return out.withColumn("support_recency_score", F.round("support_recency_score", 6))


@query
def support_recency_as_of_purchase(spark, sf):
    """Support recency of users as known at each of their purchases."""
    return _purchase_recency(spark, sf)


@query
def support_recency_as_of_purchase_celled(spark, sf):
    return _purchase_recency(spark, sf, rows_per_slice=50, max_slices=16)


@query
def contact_recency_monthly(spark, sf):
    """Recency of urgent orders at every month end from a customer's first order to the newest one."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    newest = orders.agg(F.max("o_orderdate")).first()[0]
    accounts = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    months = month_ends(accounts, "o_custkey", "first", F.lit(newest))
    urgent = orders.where("o_orderpriority = '1-URGENT'").select(
        "o_custkey", F.col("o_orderdate").alias("month_end")
    )
    return support_recency_as_of(months, urgent, "o_custkey", "month_end").select(
        "o_custkey",
        F.col("month_end").cast("date").alias("month_end"),
        F.col("last_contact").cast("date").alias("last_contact"),
        "days_since_support",
        F.round("support_recency_score", 6).alias("support_recency_score"),
    )


@query
def cohort_percentile_fitted(spark, sf):
    """Percentiles from sketches stored per batch, a payment method each, held against exact ones."""
    df = flagged(spark, sf)
    folder = f"{shared_folder(spark).rstrip('/')}/sketches-{uuid.uuid4().hex}"
    methods = [r[0] for r in df.select("PaymentMethod").distinct().collect()]  # four at most
    for i, method in enumerate(sorted(methods)):
        store_batch(cohort_sketches(df.where(F.col("PaymentMethod") == method)), folder, str(i))
    sketches = materialize(merged_sketches(spark, folder))
    model = features_from_sketches(sketches)
    fitted = model.transform(cleaned(spark, sf)).select(KEY, F.col("cohort_clv_percentile").alias("_fitted"))
    place = F.struct(C.tenure_cohort().alias("cohort"), C.lifetime_value().alias("value"))
    exact = cohort_clv_percentile(df).select(KEY, "cohort_clv_percentile", place.alias("_place"))
    ties = df.groupBy(place.alias("_place")).agg(F.count("*").alias("_ties"))
    sizes = sketches.select(F.col("cohort").alias("_cohort"), "accounts")
    both = (
        join_lookup(exact, ties, "_place", KEY)
        .join(fitted, KEY)
        .join(F.broadcast(sizes), F.col("_place.cohort") == F.col("_cohort"), "left")
    )
    # any share from that of smaller values to that of equal ones is right for a tied value
    below = F.col("cohort_clv_percentile") - (F.col("_ties") + 1) / (2 * F.col("accounts"))
    upto = F.col("cohort_clv_percentile") + (F.col("_ties") - 1) / (2 * F.col("accounts"))
    # one rank of 100 may miss the error, twice the error hardly ever
    error = 2 * rank_error() + 1 / POINTS
    return both.select(
        KEY,
        "cohort_clv_percentile",
        F.col("accounts").alias("cohort_accounts"),
        F.col("_fitted").between(below - error, upto + error).alias("within_error"),
    )


# --- streams ----------------------------------------------------------------------------


def _streamed(spark, sf, changes, schema: str, keys: list[str]) -> DataFrame:
    """Events arrive in two parts, older ones first; the second run goes on from the first one's state."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    seconds = F.unix_micros("ts") / 1e6
    first, last = events.agg(F.min(seconds), F.max(seconds)).first()
    older = F.coalesce(seconds < ((first or 0) + (last or 0)) / 2, F.lit(True))
    for part in (older, ~older):
        events.where(part).write.mode("append").parquet(f"{folder}/events")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/events")
        state.keep_current(changes(stream), f"{folder}/state")
    return state.current(spark, f"{folder}/state", schema, keys)


@query
def stream_daily_kpis(spark, sf):
    """Events and their value per day and kind, kept up to date by a stream."""
    schema = "day date, kind string, events long, value_cents long"
    return _streamed(spark, sf, state.daily_kpis, schema, ["day", "kind"])


@query
def stream_last_contacts(spark, sf):
    """Last support event of each account, kept up to date by a stream."""
    schema = "account long, last_contact timestamp, contacts long"
    return _streamed(spark, sf, state.last_contacts, schema, ["account"])


# --- predictions and risk lists -------------------------------------------------------


@query
def predictions_list(spark, sf):
    return predictions(spark, sf)


@query
def customer_lookup(spark, sf):
    """Attributes looked up by key for scores kept apart from them."""
    base = accounts_from_orders(spark, sf)
    scores = base.select(KEY, "churn_probability")
    return attach_attributes(scores, base, ["Contract", "MonthlyCharges", "tenure"])


@query
def mapped_contract(spark, sf):
    """Contract lengths from a mapping table."""
    mapping = spark.createDataFrame(
        [("Month-to-month", 1), ("One year", 12), ("Two year", 24)], "name string, months int"
    )
    df = accounts_from_orders(spark, sf).select(KEY, "Contract")
    return map_values(df, "Contract", mapping, "name", "months", "contract_months", 1)


@query
def high_risk_customers(spark, sf):
    return R.get_high_risk_customers(predictions(spark, sf))


@query
def high_risk_top50(spark, sf):
    return R.get_high_risk_customers(predictions(spark, sf), top=50)


@query
def high_risk_top5(spark, sf):
    return R.get_high_risk_customers(predictions(spark, sf), top=5).select(
        KEY, "churn_probability", "revenue_at_risk"
    )


@query
def risk_tiers(spark, sf):
    return R.risk_tiers(predictions(spark, sf)).select(KEY, "churn_probability", "risk_tier")


@query
def revenue_band(spark, sf):
    out = R.revenue_gauge(R.revenue_summary(predictions(spark, sf)))
    return out.withColumns(
        {"revenue_at_risk": F.round("revenue_at_risk", 2), "delta": F.round("delta", 2)}
    )


@query
def revenue_fallback(spark, sf):
    return R.revenue_summary(flagged(spark, sf))


@query
def kpi_summary(spark, sf):
    scored = predictions(spark, sf, keep=("Churn",))
    out = R.kpi_row(scored, M.ChurnEvaluator().evaluate(scored))
    return out.select(
        F.round("revenue_at_risk", 2).alias("revenue_at_risk"),
        "high_risk_accounts",
        F.round("recall", 9).alias("recall"),
        F.round("auc_roc", 9).alias("auc_roc"),
    )


# --- evaluation -----------------------------------------------------------------------


@query
def business_cost(spark, sf):
    return M.business_cost_matrix(M.with_prediction(flagged(spark, sf)))


@query
def fbeta(spark, sf):
    """F2 per contract from precision and recall of the flagged accounts."""
    scored = M.with_prediction(flagged(spark, sf))
    hit = F.count_if((F.col("predicted") == 1) & (F.col("Churn") == 1))
    sums = scored.groupBy("Contract").agg(
        C.safe_ratio(hit, F.count_if(F.col("predicted") == 1)).alias("precision"),
        C.safe_ratio(hit, F.count_if(F.col("Churn") == 1)).alias("recall"),
    )
    return sums.withColumn("f2_score", C.fbeta_score("precision", "recall"))


@query
def churn_rate_by_contract(spark, sf):
    return M.churn_rate(flagged(spark, sf), by=["Contract"])


def _evaluated(spark, sf, **cells):
    out = M.ChurnEvaluator().evaluate(flagged(spark, sf), **cells)
    return out.withColumns(
        {c: F.round(c, 9) for c in ("auc_roc", "auc_pr", "f2_score", "precision", "recall")}
    )


@query
def evaluate_at_threshold(spark, sf):
    return _evaluated(spark, sf)


@query
def evaluate_at_threshold_celled(spark, sf):
    return _evaluated(spark, sf, **CELLED)


@query
def threshold_curve(spark, sf):
    out = M.normalized_cost(M.ChurnEvaluator().get_threshold_curve(flagged(spark, sf)))
    return out.withColumns(
        {c: F.round(c, 9) for c in ("precision", "recall", "f2_score", "normalized_cost")}
    )


@query
def best_threshold(spark, sf):
    out = M.best_threshold(M.threshold_curve(flagged(spark, sf)))
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f2_score")})


@query
def lift_curve(spark, sf):
    out = M.ChurnEvaluator().get_lift_curve(flagged(spark, sf))
    return out.withColumns({c: F.round(c, 9) for c in ("churn_rate", "lift", "cumulative_gain")})


@query
def lift_curve_celled(spark, sf):
    out = M.lift_curve(flagged(spark, sf), **CELLED)
    return out.withColumns({c: F.round(c, 9) for c in ("churn_rate", "lift", "cumulative_gain")})


@query
def roc_auc(spark, sf):
    return M.roc_auc(flagged(spark, sf)).select(F.round("auc_roc", 9).alias("auc_roc"))


@query
def average_precision(spark, sf):
    return M.average_precision(flagged(spark, sf)).select(F.round("auc_pr", 9).alias("auc_pr"))


@query
def average_precision_trapezoid(spark, sf):
    return M.average_precision(flagged(spark, sf), trapezoid=True).select(
        F.round("auc_pr", 9).alias("auc_pr")
    )


@query
def revenue_weighted_fbeta(spark, sf):
    out = M.revenue_weighted_fbeta(predictions(spark, sf, keep=("Churn",)))
    money = {c: F.round(c, 2) for c in ("tp_value", "fp_value", "fn_value")}
    shares = {c: F.round(c, 9) for c in ("weighted_precision", "weighted_recall", "weighted_fbeta")}
    return out.withColumns({**money, **shares})


# --- segments -------------------------------------------------------------------------


@query
def score_distribution(spark, sf):
    out = G.score_distribution(flagged(spark, sf))
    return out.withColumn("mean_score", F.round("mean_score", 9))


@query
def score_distribution_celled(spark, sf):
    out = G.score_distribution(flagged(spark, sf), **CELLED)
    return out.withColumn("mean_score", F.round("mean_score", 9))


@query
def score_histogram(spark, sf):
    return G.score_histogram(flagged(spark, sf))


def _density(spark, sf, **cells):
    out = G.score_density(flagged(spark, sf), **cells)
    return out.withColumns({"density": F.round("density", 6), "bandwidth": F.round("bandwidth", 9)})


@query
def score_density(spark, sf):
    """Density of the scores per contract, on a grid that holds the given scores."""
    return _density(spark, sf)


@query
def score_density_celled(spark, sf):
    return _density(spark, sf, **CELLED)


@query
def contract_types(spark, sf):
    return G.group_values(accounts_from_orders(spark, sf))


@query
def segment_lift(spark, sf):
    out = G.segment_lift(row_features(cleaned(spark, sf)))
    rates = ("churn_rate", "rest_churn_rate", "base_churn_rate", "lift")
    return out.withColumns({c: F.round(c, 9) for c in rates})


@query
def segment_lift_literal(spark, sf):
    out = G.segment_lift(row_features(cleaned(spark, sf, no_value=1)))
    rates = ("churn_rate", "rest_churn_rate", "base_churn_rate", "lift")
    return out.withColumns({c: F.round(c, 9) for c in rates})


@query
def mutual_information(spark, sf):
    df = row_features(flagged(spark, sf))
    features = {
        "Contract": F.col("Contract"),
        "InternetService": F.col("InternetService"),
        "PaymentMethod": F.col("PaymentMethod"),
        "gender": F.col("gender"),
        "tenure": F.col("tenure"),
        "tenure_cohort": C.tenure_cohort(),
        "services_used": F.round(F.col("service_adoption_density") * 8).cast("int"),
        "monthly_charges_tens": F.floor(F.col("MonthlyCharges") / 10).cast("int"),
    }
    return G.mutual_information(df, features).select(
        "feature", F.round("mutual_information", 9).alias("mutual_information")
    )


# --- splits ---------------------------------------------------------------------------


@query
def stratified_split_members(spark, sf):
    df = flagged(spark, sf).select(KEY, "Churn")
    train, test = stratified_split(df, "Churn", KEY)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query
def stratified_split_counts(spark, sf):
    members = stratified_split_members(spark, sf)
    return members.groupBy("part", "Churn").agg(F.count("*").alias("accounts"))


@query
def fold_members(spark, sf):
    return stratified_folds(flagged(spark, sf).select(KEY, "Churn"), "Churn", KEY)


@query
def fold_counts(spark, sf):
    return fold_members(spark, sf).groupBy("fold", "Churn").agg(F.count("*").alias("accounts"))


def _time_fold_counts(spark, sf, **cells):
    df = time_folds(flagged(spark, sf).select(KEY, "tenure"), "tenure", **cells)
    return df.groupBy("fold").agg(
        F.count("*").alias("accounts"),
        F.min("tenure").alias("first_month"),
        F.max("tenure").alias("last_month"),
    )


@query
def time_fold_counts(spark, sf):
    return _time_fold_counts(spark, sf)


@query
def time_fold_counts_celled(spark, sf):
    return _time_fold_counts(spark, sf, **CELLED)


# --- survival -------------------------------------------------------------------------


@query
def kaplan_meier(spark, sf):
    out = S.kaplan_meier(flagged(spark, sf))
    return out.withColumn("survival_probability", F.round("survival_probability", 9))


@query
def monthly_hazard(spark, sf):
    out = S.monthly_hazard(flagged(spark, sf))
    return out.withColumns(
        {c: F.round(c, 9) for c in ("hazard", "previous_hazard", "next_hazard")}
    )


def _concordance(spark, sf, **cells):
    return _concordance_row(S.concordance(flagged(spark, sf), "churn_probability", **cells))


def _concordance_row(out):
    return out.select(
        *[F.col(c).cast("long").alias(c) for c in out.columns[:3]],
        F.round("concordance_index", 9).alias("concordance_index"),
    )


@query
def hazard_cliffs(spark, sf):
    """Months in which the churn hazard of a contract jumps."""
    out = S.hazard_cliffs(flagged(spark, sf))
    return out.withColumns(
        {c: F.round(c, 6) for c in ("hazard", "z_cliff", "p_cliff", "z_shift", "p_shift")}
    )


@query
def concordance(spark, sf):
    return _concordance(spark, sf)


@query
def concordance_celled(spark, sf):
    return _concordance(spark, sf, **CELLED)


def _cox(spark, sf):
    # written once: the fit and the scores read these columns many times
    used = [KEY, "tenure", "Contract", "Churn", *COX_INPUTS]
    rows = materialize(row_features(cleaned(spark, sf)).select(*used), 10 * ROWS_PER_FILE)
    return rows, S.CoxSurvival(covariates=COX_INPUTS).fit(rows)


@query
def cox_hazard_ratios(spark, sf):
    return _cox(spark, sf)[1].get_hazard_ratios(spark)


@query
def cox_horizon(spark, sf):
    rows, model = _cox(spark, sf)
    return model.predict_churn_probability_at(rows, 12).select(KEY, "tenure", "churn_probability_at")


@query
def cox_horizon_given_tenure(spark, sf):
    rows, model = _cox(spark, sf)
    out = model.predict_churn_probability_at(rows, 12, given_tenure=True)
    return out.select(KEY, "tenure", "churn_probability_at")


@query
def cox_concordance(spark, sf):
    rows, model = _cox(spark, sf)
    return model.concordance_index(rows)


def _cox_flag(spark, sf):
    """Cox fit on one flag, whose steps SQL can follow."""
    rows = flagged(spark, sf)
    return rows, S.CoxSurvival(covariates=["SeniorCitizen"], categories=()).fit(rows)


@query
def cox_flag_ratio(spark, sf):
    return _ratio_row(_cox_flag(spark, sf)[1], spark)


def _ratio_row(model, spark):
    out = model.get_hazard_ratios(spark)
    return out.select("covariate", *[F.round(c, 6).alias(c) for c in out.columns if c not in ("covariate", "p")])


def _cox_paid_months(spark, sf, **cells):
    """Cox fit on one flag over charges paid in months, durations of which hardly two are equal."""
    paid = F.try_divide(F.col("TotalCharges"), F.col("MonthlyCharges"))
    rows = materialize(cleaned(spark, sf).select(KEY, "SeniorCitizen", "Churn", paid.alias("paid_months")))
    cox = S.CoxSurvival(durationCol="paid_months", covariates=["SeniorCitizen"], categories=(), **cells)
    return rows, cox.fit(rows)


@query
def cox_paid_months_ratio(spark, sf):
    return _ratio_row(_cox_paid_months(spark, sf)[1], spark)


@query
def cox_paid_months_ratio_celled(spark, sf):
    cells = {"rowsPerCell": CELLED["rows_per_cell"], "maxCells": 32}
    return _ratio_row(_cox_paid_months(spark, sf, **cells)[1], spark)


@query
def cox_paid_months_horizon(spark, sf):
    """Probability of churn within 12 months, from the start and from the months paid on."""
    rows, model = _cox_paid_months(spark, sf)
    out = model.predict_churn_probability_at(rows, 12, output="from_start")
    out = model.predict_churn_probability_at(out, 12, given_tenure=True, output="from_now")
    return out.select(KEY, *[F.round(c, 6).alias(c) for c in ("from_start", "from_now")])


@query
def cox_flag_horizon(spark, sf):
    """Probability of churn within 12 months, from the start and from the present tenure on."""
    rows, model = _cox_flag(spark, sf)
    out = model.predict_churn_probability_at(rows, 12, output="from_start")
    out = model.predict_churn_probability_at(out, 12, given_tenure=True, output="from_tenure")
    return out.select(KEY, "tenure", *[F.round(c, 6).alias(c) for c in ("from_start", "from_tenure")])


@query
def cox_flag_concordance(spark, sf):
    rows, model = _cox_flag(spark, sf)
    return _concordance_row(model.concordance_index(rows))


@query
def aft_scores(spark, sf):
    rows = row_features(flagged(spark, sf))
    model = S.fit_aft(rows, COX_INPUTS[:2] + COX_INPUTS[3:])
    names = [*COX_INPUTS[:2], *COX_INPUTS[3:]]
    return spark.createDataFrame(
        [("(intercept)", float(model.intercept)), ("(scale)", float(model.scale))]
        + [(n, float(v)) for n, v in zip(names, model.coefficients)],
        "term string, value double",
    )


# --- learning -------------------------------------------------------------------------

ENCODED = ["Contract", "PaymentMethod", "InternetService"]


def _ordered_codes(spark, sf, **cells):
    rows = flagged(spark, sf).select(KEY, "Churn", *ENCODED)
    encoder = OrderedTargetEncoder(
        inputCols=ENCODED, outputCols=[f"{c}_code" for c in ENCODED], permutations=3, **cells
    )
    out = encoder.encode_training(rows)
    return out.select(KEY, *[F.round(f"{c}_code", 9).alias(f"{c}_code") for c in ENCODED])


@query
def ordered_codes(spark, sf):
    """Categories coded by the labels of the accounts before, in three hashed orders."""
    return _ordered_codes(spark, sf)


@query
def ordered_codes_celled(spark, sf):
    return _ordered_codes(spark, sf, rowsPerCell=CELLED["rows_per_cell"])


@query
def scoring_codes(spark, sf):
    """Held-out accounts' categories, coded by the labels of all training accounts."""
    rows = flagged(spark, sf).select(KEY, "Churn", *ENCODED)
    train, test = stratified_split(rows, "Churn", KEY)
    encoder = OrderedTargetEncoder(inputCols=ENCODED, outputCols=[f"{c}_code" for c in ENCODED])
    out = encoder.fit(train).transform(test)
    return out.select(KEY, *[F.round(f"{c}_code", 9).alias(f"{c}_code") for c in ENCODED])


def _held_out(spark, sf, model):
    train, test = split_features(spark, sf)
    return model.fit(train).predict_proba(test)


def _checks(scored, *keep):
    """What must hold for any scores: which rows they are of, their range, flags, and a rank above chance."""
    scored = materialize(scored.select(KEY, "Churn", *keep, "churn_probability", "predicted"))
    p = F.col("churn_probability")
    return scored.select(
        KEY,
        "Churn",
        *keep,
        F.coalesce(p.between(0, 1), F.lit(False)).alias("in_range"),
        F.coalesce(F.col("predicted") == (p >= DEFAULTS.threshold).cast("int"), F.lit(False)).alias("flag_agrees"),
        F.lit(M.roc_auc(scored).first()["auc_roc"] > 0.5).alias("above_chance"),
    )


@query
def gbt_scores(spark, sf):
    return predictions_table(_held_out(spark, sf, BoostedChurnModel(**TREES)), keep=("predicted", "Churn"))


@query
def gbt_checks(spark, sf):
    return _checks(_held_out(spark, sf, BoostedChurnModel(**TREES)))


@query
def challenger_scores(spark, sf):
    return predictions_table(_held_out(spark, sf, ChallengerChurnModel(**TREES)), keep=("predicted", "Churn"))


@query
def challenger_checks(spark, sf):
    return _checks(_held_out(spark, sf, ChallengerChurnModel(**TREES)))


@query
def model_comparison(spark, sf):
    """Both classifiers evaluated on the same held-out accounts."""
    train, test = split_features(spark, sf)
    out = None
    for name, model in (("boosted", BoostedChurnModel(**TREES)), ("challenger", ChallengerChurnModel(**TREES))):
        scored = model.fit(train).predict_proba(test).select("Churn", "churn_probability")
        row = M.ChurnEvaluator().evaluate(materialize(scored))  # scored once, measured in several passes
        row = row.select(F.lit(name).alias("model"), *row.columns)
        out = row if out is None else out.unionByName(row)
    return out


STUMP_INPUTS = ["SeniorCitizen", "Partner", "Dependents", "PaperlessBilling", "TechSupport", "monthly", "new"]


def _stumps(spark, sf):
    """[train, test] of yes-or-no features and boosted trees of one split each, which SQL can follow."""
    rows = flagged(spark, sf).withColumns(
        {
            "monthly": (F.col("Contract") == "Month-to-month").cast("int"),
            "new": (F.col("tenure") < 12).cast("int"),
        }
    )
    train, test = [materialize(p) for p in stratified_split(rows.select(KEY, "Churn", *STUMP_INPUTS), "Churn", KEY)]
    made = BoostedChurnModel(trees=3, depth=1, learning_rate=0.5, subsample=1.0, feature_subset="all", min_child_rows=1)
    return test, made.fit(train)


@query
def stump_scores(spark, sf):
    """Held-out scores of three boosted stumps."""
    test, model = _stumps(spark, sf)
    return model.predict_proba(test).select(KEY, F.round("churn_probability", 6).alias("churn_probability"), "predicted")


@query
def stump_gains(spark, sf):
    """Raw gain by feature of three boosted stumps."""
    found = _stumps(spark, sf)[1].get_feature_importance()
    return found.select("feature", F.round("importance_gain", 4).alias("importance_gain"), "splits")


@query
def stump_effects(spark, sf):
    """What each feature adds to a held-out account's margin, for three boosted stumps."""
    test, model = _stumps(spark, sf)
    out = model.explain(test)
    return out.select(
        KEY,
        F.round("base_value", 6).alias("base_value"),
        F.round("margin", 6).alias("margin"),
        *[F.round(F.col("effects")[c], 6).alias(c) for c in STUMP_INPUTS],
    )


# trees of given splits: (tree, node, left, right, feature, threshold)
FIXED_SPLITS = [
    (0, 0, 1, 2, "tenure", 11),
    (0, 1, 3, 4, "contract_months", 6),
    (0, 2, 5, 6, "MonthlyCharges", 70),
    *[(0, n, None, None, None, None) for n in (3, 4, 5, 6)],
    (1, 0, 1, 2, "contract_months", 6),
    (1, 1, 3, 4, "tenure", 24),
    (1, 2, 7, 8, "SeniorCitizen", 0),
    (1, 3, 5, 6, "tenure", 5),
    *[(1, n, None, None, None, None) for n in (4, 5, 6, 7, 8)],
]
FIXED_INPUTS = ["tenure", "contract_months", "MonthlyCharges", "SeniorCitizen"]


@query
def tree_effects(spark, sf):
    """Per account, what each feature adds to the mean churn rate of two trees of given splits."""
    rows = row_features(flagged(spark, sf)).select(KEY, "Churn", *FIXED_INPUTS)
    nodes = cover_by_rows(FIXED_SPLITS, rows, "Churn")
    values = F.array(*[F.col(c).cast("double") for c in FIXED_INPUTS])
    out = attributed(rows, nodes, values, FIXED_INPUTS)
    return out.select(
        KEY,
        F.round("base_value", 9).alias("base_value"),
        *[F.round(F.col("effects")[c], 9).alias(f"effect_{c}") for c in FIXED_INPUTS],
    )


@query
def account_reasons(spark, sf):
    """Held-out accounts with the three features that raise their score most."""
    train, test = split_features(spark, sf)
    out = BoostedChurnModel(**TREES).fit(train).explain(test)
    return out.select(KEY, "margin", F.posexplode(strongest("effects")).alias("rank", "r")).select(
        KEY, F.round("margin", 9).alias("margin"), (F.col("rank") + 1).alias("rank"), "r.feature", F.round("r.effect", 9).alias("effect")
    )


@query
def importance(spark, sf):
    model = BoostedChurnModel(**TREES).fit(training_table(spark, sf))
    return R.top_features(model.get_feature_importance(spark))


def _out_of_fold(spark, sf):
    table = stratified_folds(raw_accounts(spark, sf), "_target", KEY)
    make = lambda: BoostedChurnModel(**{**TREES, "trees": 5}, exclude=("fold",))
    return out_of_fold_scores(table, make, fold="fold", prepare=prepare)


@query
def out_of_fold(spark, sf):
    return _out_of_fold(spark, sf).select(KEY, "Churn", "fold", "churn_probability")


@query
def out_of_fold_checks(spark, sf):
    return _checks(_out_of_fold(spark, sf), "fold")


def _forward(spark, sf):
    table = time_folds(raw_accounts(spark, sf), "tenure", 3)
    make = lambda: BoostedChurnModel(**{**TREES, "trees": 5}, exclude=("fold",))
    return forward_scores(table, make, "fold", 3, prepare=prepare)


@query
def forward_fold_scores(spark, sf):
    return _forward(spark, sf).select(KEY, "Churn", "fold", "churn_probability")


@query
def forward_fold_checks(spark, sf):
    return _checks(_forward(spark, sf), "fold")


@query
def ensemble_scores(spark, sf):
    """Both classifiers and the 12-month Cox probability, averaged."""
    train, test = split_features(spark, sf)
    scored = BoostedChurnModel(**TREES).fit(train).predict_proba(test)
    scored = scored.withColumnRenamed("churn_probability", "boosted").drop("predicted")
    rival = ChallengerChurnModel(**TREES, exclude=("boosted",)).fit(train)
    scored = rival.predict_proba(scored)
    scored = scored.withColumnRenamed("churn_probability", "challenger")
    cox = S.CoxSurvival(covariates=COX_INPUTS).fit(train)
    scored = cox.predict_churn_probability_at(scored, 12, output="survival")
    out = ensemble(scored, {"boosted": 2.0, "challenger": 1.0, "survival": 1.0})
    return out.select(KEY, "boosted", "challenger", "survival", "churn_probability")


@query
def permutation_loss(spark, sf):
    train, test = split_features(spark, sf)
    model = BoostedChurnModel(**TREES).fit(train)
    features = ["Contract", "tenure", "MonthlyCharges", ("MonthlyCharges", "Contract")]
    return permutation_importance(test, model, features)


@query
def tuning(spark, sf):
    table = training_table(spark, sf)
    model = BoostedChurnModel(**{**TREES, "trees": 3})
    found = search(table, model, {"maxDepth": [2, 4], "stepSize": [0.1, 0.3]})
    return search_results(found, spark)


@query
def tuning_halving(spark, sf):
    """Nine combinations on nested samples, a third of them kept from rung to rung."""
    found = halving_search(
        training_table(spark, sf),
        lambda **p: BoostedChurnModel(trees=3, **p),
        {"depth": [2, 3, 4], "learning_rate": Between(0.05, 0.5, log=True), "min_child_rows": Between(5, 40)},
        trials=9,
        seconds=3600,
        rungs=3,
    )
    return found.trials


RULES = [0.05 * k for k in range(2, 20)]


@query
def rule_halving(spark, sf):
    """Cuts of the given score on nested samples of hashed keys, a third kept from rung to rung."""
    rows = flagged(spark, sf).select(KEY, "Churn", F.col("churn_probability").alias("given"))
    found = halving_search(
        rows, lambda cut: RuleModel("given", cut), {"cut": RULES}, trials=len(RULES), seconds=3600, rungs=3
    )
    return found.trials.select("trial", "rung", F.round("f2_score", 9).alias("f2_score"), "status")


# scores that need no fit: the given one, one of tenure, and one that says little
STACKED = {"given": "churn_probability", "young": "1D / (tenure + 1D)", "dear": "MonthlyCharges / 100D"}


def _stacked_weights(spark, sf, names):
    rows = flagged(spark, sf).select(KEY, "Churn", *[F.expr(STACKED[n]).alias(n) for n in names])
    return rows, stack_weights(rows, names)


@query
def stacked_weights(spark, sf):
    """Non-negative weights of three scores."""
    weights = _stacked_weights(spark, sf, ["given", "young", "dear"])[1]
    out = spark.createDataFrame(list(weights.items()), "score string, weight double")
    return out.withColumn("weight", F.round("weight", 6))


@query
def stacked_scores(spark, sf):
    """Accounts by the learned sum of two scores."""
    rows, weights = _stacked_weights(spark, sf, ["given", "young"])
    return rows.select(KEY, F.round(weighted_score(weights), 6).alias("churn_probability"))


@query
def learned_ensemble(spark, sf):
    """Held-out accounts by both classifiers and the Cox model, weighted by out-of-fold scores."""
    raw = materialize(raw_accounts(spark, sf), ROWS_PER_FILE)
    train, test = stratified_split(raw, "_target", KEY)
    small = {**TREES, "trees": 5}
    makers = {
        "boosted": lambda: BoostedChurnModel(**small),
        "challenger": lambda: ChallengerChurnModel(**small, exclude=("boosted",)),
        "survival": lambda: S.CoxChurnScore(COX_INPUTS),
    }
    model = StackedModel(makers, folds=2).fit(train, prepare=prepare, fold_label="_target")
    out = model.predict_proba(prepare(train, test)[0])
    return out.select(KEY, "Churn", *makers, "churn_probability", "predicted")
