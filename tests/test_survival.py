import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators import survival as S
from holdfast.operators.risk_sets import efron_sums

SMALL = {"rows_per_cell": 10, "max_cells": 16}


@pytest.fixture(scope="module")
def frame():
    """Accounts whose months to churn shorten with the charge and lengthen with the contract."""
    draw = np.random.default_rng(2024)
    n = 240
    stay = np.arange(n) % 3  # 0 leaves soonest
    charge = 30 + 15 * draw.gamma(2.0, 1.0, n)
    months = draw.exponential(12 * (1 + stay) * np.exp(-(charge - 60) / 120))
    seen = draw.integers(6, 60, n)  # months of observation
    tenure = np.maximum(1, np.ceil(np.minimum(months, seen))).astype(int)
    return pd.DataFrame(
        {
            "tenure": tenure,
            "Churn": (months <= seen).astype(int),
            "MonthlyCharges": charge.round(2),
            "TotalCharges": (charge * tenure * draw.normal(1, 0.1, n)).round(2),
            "SeniorCitizen": (draw.random(n) < 0.2).astype(int),
            "Contract": np.array(["Month-to-month", "One year", "Two year"])[stay],
            "charge_volatility_ratio": draw.beta(1.5, 6, n),
            "service_adoption_density": draw.integers(0, 9, n) / 8,
            "tenure_contract_interaction": tenure * np.array([1, 12, 24])[stay],
            "support_recency_score": draw.exponential(0.1, n),
            "cohort_clv_percentile": (draw.permutation(n) + 1) / n,
        }
    )


@pytest.fixture(scope="module")
def data(spark, frame):
    return spark.createDataFrame(frame).repartition(4).cache()


@pytest.fixture(scope="module")
def model(data):
    return S.CoxSurvival().fit(data)


def design(model, frame):
    columns = [frame[c].to_numpy(float) for c in model.getOrDefault("covariates")]
    for c, v in zip(model.getOrDefault("codedColumns"), model.getOrDefault("codedLevels")):
        columns.append((frame[c] == v).to_numpy(float))
    return np.column_stack(columns)


def efron_loglik(x, t, e, beta):
    """Log partial likelihood straight from its definition."""
    eta = x @ beta
    out = 0.0
    for month in np.unique(t[e == 1]):
        dead = (t == month) & (e == 1)
        risk, own = np.exp(eta[t >= month]).sum(), np.exp(eta[dead]).sum()
        d = dead.sum()
        out += eta[dead].sum() - sum(math.log(risk - i / d * own) for i in range(d))
    return out


def test_cox_is_the_maximum(model, frame):
    x = design(model, frame)
    x = x - x.mean(axis=0)
    scale = x.std(axis=0)
    x = x / scale
    t, e = frame["tenure"].to_numpy(), frame["Churn"].to_numpy()
    beta = np.array(model.getOrDefault("coefficients")) * scale
    best = efron_loglik(x, t, e, beta)
    assert best == pytest.approx(model.getOrDefault("logLikelihood"), abs=1e-8)
    h = 1e-4
    for j in range(len(beta)):
        step = np.eye(len(beta))[j] * h
        up, down = efron_loglik(x, t, e, beta + step), efron_loglik(x, t, e, beta - step)
        assert abs(up - down) / (2 * h) < 1e-4  # flat
        se = model.getOrDefault("standardErrors")[j] * scale[j]
        assert se**2 >= 1 / -((up - 2 * best + down) / h**2) * 0.99  # at least the one-variable bound


def test_hazard_ratios(model, spark):
    rows = model.get_hazard_ratios(spark).toPandas()
    assert len(rows) == 10  # eight numeric columns, two contract levels
    assert {"hazard_ratio", "p"} <= set(rows.columns)
    np.testing.assert_allclose(rows["hazard_ratio"], np.exp(rows["coef"]))
    assert rows["p"].between(0, 1).all()


def brute_concordance(t, e, risk):
    good = tied = pairs = 0
    for i in np.flatnonzero(e):
        for j in range(len(t)):
            if t[j] > t[i] or (t[j] == t[i] and not e[j]):
                pairs += 1
                good += risk[i] > risk[j]
                tied += risk[i] == risk[j]
    return pairs, int(good), int(tied)


@pytest.mark.parametrize("cells", [{}, SMALL])
def test_concordance_matches_pairs(spark, frame, cells):
    part = frame.copy()
    part["risk"] = part["charge_volatility_ratio"].round(1)
    part.loc[:70, "risk"] = 0.5  # a third of the rows share one score
    part.loc[:5, "tenure"] = 0
    got = S.concordance(spark.createDataFrame(part), "risk", **cells).first()
    want = brute_concordance(part["tenure"].to_numpy(), part["Churn"].to_numpy(), part["risk"].to_numpy())
    assert tuple(got)[:3] == want
    assert got["concordance_index"] == (want[1] + want[2] / 2) / want[0]


@pytest.mark.parametrize("cells", [{}, SMALL])
def test_concordance_takes_durations_as_given(spark, cells):
    rng = np.random.default_rng(5)
    t = np.concatenate((rng.normal(size=60).round(1), [3.2, 3.9, 7.5, -1.0, 1e12, 1e12, math.inf]))
    e, risk = rng.integers(0, 2, len(t)), rng.integers(0, 9, len(t)) / 8
    rows = list(zip(t.tolist(), e.tolist(), risk.tolist())) + [(math.nan, 1, 0.5), (None, 1, 0.5)]
    df = spark.createDataFrame(rows, "tenure double, Churn int, risk double")
    assert tuple(S.concordance(df, "risk", **cells).first())[:3] == brute_concordance(t, e, risk)


def test_cox_keeps_parts_of_months(spark, frame):
    halves = frame.assign(tenure=frame["tenure"] / 2)
    fit = S.CoxSurvival(covariates=["MonthlyCharges"], categories=[]).fit
    whole, half = fit(spark.createDataFrame(frame)), fit(spark.createDataFrame(halves))
    assert half.getOrDefault("coefficients") == pytest.approx(whole.getOrDefault("coefficients"))
    assert half.cumulative_hazard_at(6) == pytest.approx(whole.cumulative_hazard_at(12))
    ask = [F.col("tenure"), F.lit(None).cast("double")]
    got = spark.createDataFrame(halves).select(*[half._hazard_column(c).alias(f"h{i}") for i, c in enumerate(ask)]).toPandas()
    assert got["h0"].to_numpy() == pytest.approx([half.cumulative_hazard_at(v) for v in halves["tenure"]])
    assert got["h1"].isna().all()


def test_model_concordance(model, data):
    assert 0.5 <= model.concordance_index(data).first()["concordance_index"] <= 1


def test_no_pairs(spark):
    df = spark.createDataFrame([(1, 0, 0.5)], "tenure int, Churn int, risk double")
    assert tuple(S.concordance(df, "risk").first()) == (0, 0, 0, None)


def test_kaplan_meier_matches_products(model, data, frame):
    got = model.get_kaplan_meier_data(data).toPandas()
    assert got["survival_probability"].between(0, 1).all()
    for contract, part in frame.groupby("Contract"):
        curve = got[got["contract_type"] == contract].set_index("timeline")["survival_probability"]
        assert curve.loc[0] == 1.0
        s = 1.0
        for month in sorted(part["tenure"].unique()):
            s *= 1 - part.loc[part["tenure"] == month, "Churn"].sum() / (part["tenure"] >= month).sum()
            assert curve.loc[month] == pytest.approx(s, abs=1e-12)


def test_curve_that_ends(spark):
    rows = [(1, 1, "x"), (2, 1, "x"), (0, 1, "y"), (0, 1, "y"), (3, 0, "z")]
    df = spark.createDataFrame(rows, "tenure int, Churn int, Contract string")
    got = {(r["contract_type"], r["timeline"]): r["survival_probability"] for r in S.kaplan_meier(df).collect()}
    assert got == {("x", 0): 1.0, ("x", 1): 0.5, ("x", 2): 0.0, ("y", 0): 0.0, ("z", 0): 1.0, ("z", 3): 1.0}


def test_horizon(model, data, frame):
    twelve = model.predict_churn_probability_at(data, 12).toPandas()["churn_probability_at"]
    assert len(twelve) == len(frame) and twelve.between(0, 1).all()
    later = model.predict_churn_probability_at(data, 48).toPandas()["churn_probability_at"]
    assert (later >= twelve).all()
    given = model.predict_churn_probability_at(data, 12, given_tenure=True).toPandas()["churn_probability_at"]
    assert given.between(0, 1).all()
    # Breslow baseline straight from its definition
    x = design(model, frame)
    risk = np.exp((x - np.array(model.getOrDefault("means"))) @ np.array(model.getOrDefault("coefficients")))
    t, e = frame["tenure"].to_numpy(), frame["Churn"].to_numpy()
    hazard = sum(((t == m) & (e == 1)).sum() / risk[t >= m].sum() for m in range(1, 13))
    assert model.cumulative_hazard_at(12) == pytest.approx(hazard)


def test_collinear_covariates(spark, frame):
    part = frame.assign(twice=frame["MonthlyCharges"] * 2, constant=1.0)
    df = spark.createDataFrame(part)
    model = S.CoxSurvival(covariates=["MonthlyCharges", "twice", "constant"], categories=[]).fit(df)
    coef = dict(zip(model.getOrDefault("names"), model.getOrDefault("coefficients")))
    alone = S.CoxSurvival(covariates=["MonthlyCharges"], categories=[]).fit(df)
    assert coef["constant"] == 0.0
    total = coef["MonthlyCharges"] + 2 * coef["twice"]
    assert total == pytest.approx(alone.getOrDefault("coefficients")[0], rel=1e-4)


def test_tenure_zero_and_missing_rows_are_left_out(spark, data, frame):
    extra = pd.DataFrame([{**frame.iloc[0], "tenure": 0}, {**frame.iloc[1], "MonthlyCharges": None}])
    more = data.unionByName(spark.createDataFrame(extra, data.schema))
    a = S.CoxSurvival(covariates=["MonthlyCharges"], categories=[]).fit(more)
    b = S.CoxSurvival(covariates=["MonthlyCharges"], categories=[]).fit(data)
    assert a.getOrDefault("coefficients") == pytest.approx(b.getOrDefault("coefficients"))


def test_round_trip(model, data, tmp_path):
    path = str(tmp_path / "cox")
    model.write().overwrite().save(path)
    again = S.CoxSurvivalModel.load(path)
    a = model.transform(data).agg({"log_risk": "sum"}).first()[0]
    assert again.transform(data).agg({"log_risk": "sum"}).first()[0] == pytest.approx(a)


@pytest.mark.parametrize("share", [1e-4, 0.3, 0.999, 1.0])
def test_tie_sums_for_many_events(share):
    d = 200_000
    total, dying = 3.7e5, 3.7e5 * share
    f = total - np.arange(d) / d * dying
    got = [v[0] for v in efron_sums(total, dying, d)]
    np.testing.assert_allclose(got, [(1 / f).sum(), (1 / f**2).sum(), np.log(f).sum()], rtol=1e-11)


@pytest.mark.parametrize("d", [1, 2, 31, 32, 33, 34, 64, 1000])
@pytest.mark.parametrize("share", [1e-6, 0.5, 1.0])
def test_tie_sums_for_any_number_of_events(d, share):
    total, dying = 50.0, 50.0 * share
    f = total - np.arange(d) / d * dying
    got = [v[0] for v in efron_sums(total, dying, d)]
    np.testing.assert_allclose(got, [(1 / f).sum(), (1 / f**2).sum(), np.log(f).sum()], rtol=1e-12)


def continuous(frame, ties=0.3):
    """Durations of which hardly two are equal, but for a share of rows at one of them."""
    rng = np.random.default_rng(3)
    out = frame.assign(tenure=frame["tenure"] + rng.random(len(frame)).round(6))
    out.loc[rng.random(len(frame)) < ties, "tenure"] = 17.25
    return out


@pytest.mark.parametrize("cells", [{}, {"rowsPerCell": 10, "maxCells": 16}, {"rowsPerCell": 3, "maxCells": 40}])
def test_cox_of_continuous_durations(spark, frame, cells):
    part = continuous(frame)
    df = spark.createDataFrame(part).repartition(5)
    model = S.CoxSurvival(covariates=["MonthlyCharges", "SeniorCitizen"], categories=["Contract"], **cells).fit(df)
    x = design(model, part)
    mean = x.mean(axis=0)
    t, e = part["tenure"].to_numpy(), part["Churn"].to_numpy()
    beta = np.array(model.getOrDefault("coefficients"))
    best = efron_loglik(x - mean, t, e, beta)
    assert best == pytest.approx(model.getOrDefault("logLikelihood"), abs=1e-8)
    for j, se in enumerate(model.getOrDefault("standardErrors")):
        step = np.eye(len(beta))[j] * se * 1e-3
        up, down = efron_loglik(x - mean, t, e, beta + step), efron_loglik(x - mean, t, e, beta - step)
        assert abs(up - down) / 2e-3 < 1e-5  # flat, in standard errors
    # Breslow baseline from its definition, at asked times and from each tenure on
    risk = np.exp((x - np.array(model.getOrDefault("means"))) @ beta)
    steps = {m: ((t == m) & (e == 1)).sum() / risk[t >= m].sum() for m in np.unique(t[e == 1])}

    def upto(months):
        return sum(s for m, s in steps.items() if m <= months)

    for months in (0.5, 12, 17.25, 1000):
        assert model.cumulative_hazard_at(months) == pytest.approx(upto(months))
    got = model.predict_churn_probability_at(df, 6, given_tenure=True).toPandas().sort_values("TotalCharges")
    want = 1 - np.exp(-np.array([upto(v + 6) - upto(v) for v in t]) * risk)
    np.testing.assert_allclose(got["churn_probability_at"], want[part["TotalCharges"].argsort()], atol=1e-9)
    assert len(got) == len(part)


def test_cox_baseline_table_moves_with_the_model(spark, frame, tmp_path):
    df = spark.createDataFrame(continuous(frame))
    model = S.CoxSurvival(covariates=["MonthlyCharges"], categories=[], maxCells=20, rowsPerCell=20).fit(df)
    model.save_baseline(str(tmp_path / "baseline")).write().overwrite().save(str(tmp_path / "cox"))
    again = S.CoxSurvivalModel.load(str(tmp_path / "cox"))
    assert str(tmp_path) in again.getOrDefault("baselineTable")
    assert again.cumulative_hazard_at(12) == pytest.approx(model.cumulative_hazard_at(12))
    assert again.baseline().count() == len({v for v, e in zip(continuous(frame)["tenure"], frame["Churn"]) if e})


def test_cox_stops_where_steps_are_far_below_an_error(spark, frame):
    df = spark.createDataFrame(frame)
    make = lambda tol: S.CoxSurvival(covariates=["MonthlyCharges"], categories=[], tol=tol).fit(df)
    a, b = make(1e-9), make(1e-15)
    assert a.getOrDefault("coefficients") == pytest.approx(b.getOrDefault("coefficients"), rel=1e-13)


def test_aft(spark, data):
    fitted = S.fit_aft(data, ["MonthlyCharges", "SeniorCitizen"])
    assert fitted.scale > 0


def test_hazard_neighbours(spark, data):
    rows = S.monthly_hazard(data).toPandas()
    assert rows["hazard"].between(0, 1).all()
    assert set(rows.loc[rows["renewal_month"], "timeline"]) <= {12, 24, 36}


def _life(spark, hazards, rng=None, start=20_000):
    """Accounts that churn at the given monthly hazards, as expected or by draws."""
    rows, left = [], start
    for month, h in enumerate(hazards, 1):
        gone = round(left * h) if rng is None else int(rng.binomial(left, h))
        rows += [("m", month, 1, gone)] if gone else []
        rows.append(("m", month, 0, 5))
        left -= gone + 5
    rows.append(("m", len(hazards), 0, left))  # still there at the end
    df = spark.createDataFrame(rows, "Contract string, tenure int, Churn int, n int")
    return df.select("Contract", "tenure", "Churn", F.explode(F.sequence(F.lit(1), "n")).alias("_")).drop("_")


def test_cliffs_found(spark):
    hazards = [0.05 if m in (12, 24, 36) else 0.01 for m in range(1, 49)]
    got = S.hazard_cliffs(_life(spark, hazards)).toPandas()
    assert sorted(got.loc[got["cliff"], "timeline"]) == [12, 24, 36]
    assert not got["shift"].any()


def test_no_cliffs_in_a_flat_table(spark):
    got = S.hazard_cliffs(_life(spark, [0.01] * 48)).toPandas()
    assert not got["cliff"].any() and not got["shift"].any()
    rng = np.random.default_rng(1)
    for _ in range(3):
        got = S.hazard_cliffs(_life(spark, [0.01] * 40, rng)).toPandas()
        assert not got["cliff"].any() and not got["shift"].any()


def test_shift_found(spark):
    hazards = [0.03 if m < 13 else 0.01 for m in range(1, 41)]
    got = S.hazard_cliffs(_life(spark, hazards)).toPandas()
    assert list(got.loc[got["shift"], "timeline"]) == [13] and not got["cliff"].any()
    assert got.loc[got["shift"], "z_shift"].iloc[0] < 0


def test_normal_tail(spark):
    z = [-3.0, -1.0, 0.0, 0.5, 1.96, 3.0, 6.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in z], "z double").select(S._normal_tail(F.col("z"))).collect()]
    assert got == pytest.approx([math.erfc(x / math.sqrt(2)) / 2 for x in z], abs=7.5e-8)


def test_cox_query_derives_its_columns_once(spark, frame, monkeypatch):
    from holdfast.plans import queries as Q

    read = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda v: read.add(1) or v, "double")("charge")
    more = {"customerID": [f"k{i}" for i in range(len(frame))], "charge": frame["MonthlyCharges"].astype(float)}
    table = spark.createDataFrame(frame.drop(columns="MonthlyCharges").assign(**more))
    few = {c: F.lit(0) for c in ("SeniorCitizen",) if c not in table.columns}
    few |= {"TotalCharges": F.col("tenure") * 50.0} if "TotalCharges" not in table.columns else {}
    monkeypatch.setattr(Q, "cleaned", lambda *_: table.withColumns(few).withColumn("MonthlyCharges", counted))
    rows, model = Q._cox(spark, "")
    model.concordance_index(rows).collect()
    assert model.predict_churn_probability_at(rows, 12).count() == len(frame)
    assert read.value == len(frame)
