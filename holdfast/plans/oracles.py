"""Plain ANSI SQL for the registered queries, for checking them on another engine.

Each text states the rule directly (whole-table windows, pairwise joins), without
the cells and cuts the Spark side uses to stay distributed.
"""

from __future__ import annotations

from holdfast.schema import CATEGORICAL_COLUMNS, FLAG_COLUMNS, SERVICE_COLUMNS
from holdfast.sources.orders import ACCOUNT_VIEW_SQL

_PLAIN = ["customerID", "gender", "SeniorCitizen", "tenure", "InternetService", "Contract",
          "PaymentMethod", "MonthlyCharges", "churn_probability"]


def _clean(no_value: int) -> str:
    flags = ",\n  ".join(
        f"CAST(CASE WHEN {c} = 'Yes' THEN 1 WHEN {c} = 'No' THEN {no_value} ELSE 0 END AS INTEGER) AS {c}"
        for c in FLAG_COLUMNS
    )
    return f"""accounts AS ({ACCOUNT_VIEW_SQL}),
numbered AS (SELECT *, TRY_CAST(trim(TotalCharges) AS DOUBLE) AS amount FROM accounts),
middle AS (SELECT median(amount) AS median_amount FROM numbered),
clean AS (
SELECT {", ".join(_PLAIN)},
  {flags},
  COALESCE(amount, median_amount) AS TotalCharges,
  CAST(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS INTEGER) AS Churn
FROM numbered, middle)"""


_SERVICES = " + ".join(SERVICE_COLUMNS)
_COHORT = """CASE WHEN tenure BETWEEN 0 AND 12 THEN '0-12m' WHEN tenure BETWEEN 13 AND 24 THEN '13-24m'
  WHEN tenure BETWEEN 25 AND 36 THEN '25-36m' WHEN tenure BETWEEN 37 AND 48 THEN '37-48m'
  WHEN tenure BETWEEN 49 AND 72 THEN '49-72m' END"""
_MONTHS = "CASE Contract WHEN 'One year' THEN 12 WHEN 'Two year' THEN 24 ELSE 1 END"
_TIES = """CASE WHEN cohort IS NOT NULL AND clv IS NOT NULL THEN
  (rank() OVER (PARTITION BY cohort ORDER BY clv NULLS LAST)
   + (count(*) OVER (PARTITION BY cohort, clv) - 1) / CAST(2 AS DOUBLE))
  / count(clv) OVER (PARTITION BY cohort) END"""


def _features(no_value: int) -> str:
    return f"""{_clean(no_value)},
ratios AS (
SELECT *,
  abs(MonthlyCharges - CASE WHEN tenure > 0 THEN TotalCharges / tenure ELSE MonthlyCharges END)
    / (MonthlyCharges + CAST(1e-9 AS DOUBLE)) AS ratio,
  CAST({_MONTHS} AS INTEGER) AS contract_months,
  {_COHORT} AS cohort,
  MonthlyCharges * tenure AS clv
FROM clean),
features AS (
SELECT * EXCLUDE (ratio, cohort, clv),
  CASE WHEN ratio < 0 THEN CAST(0 AS DOUBLE) WHEN ratio > 1 THEN CAST(1 AS DOUBLE) ELSE ratio END
    AS charge_volatility_ratio,
  ({_SERVICES}) / CAST(8 AS DOUBLE) AS service_adoption_density,
  CAST(tenure * contract_months AS INTEGER) AS tenure_contract_interaction,
  round(CAST(CASE WHEN TechSupport = 0 AND Contract = 'Month-to-month' THEN 1 ELSE 0 END AS DOUBLE)
    / (1 + ln(CAST(1 + tenure AS DOUBLE))), 6) AS support_recency_score,
  {_TIES} AS cohort_clv_percentile
FROM ratios)"""


_PREDICTIONS = f"""{_clean(0)},
predictions AS (
SELECT customerID, Contract, MonthlyCharges, tenure, churn_probability,
  MonthlyCharges * (tenure + 6) AS estimated_clv,
  churn_probability * (MonthlyCharges * (tenure + 6)) AS revenue_at_risk, Churn
FROM clean)"""
_PREDICTION_COLUMNS = (
    "customerID, Contract, MonthlyCharges, tenure, churn_probability, estimated_clv, revenue_at_risk"
)

# per distinct score: positives and negatives at it and below it, and in all
_CURVE = f"""{_clean(0)},
scores AS (
SELECT churn_probability AS score, CAST(sum(Churn) AS BIGINT) AS pos, CAST(sum(1 - Churn) AS BIGINT) AS neg
FROM clean GROUP BY 1),
curve AS (
SELECT score, pos, neg,
  CAST(sum(pos) OVER (ORDER BY score) - pos AS DOUBLE) AS pos_below,
  CAST(sum(neg) OVER (ORDER BY score) - neg AS DOUBLE) AS neg_below,
  CAST(sum(pos) OVER () AS DOUBLE) AS pos_total,
  CAST(sum(neg) OVER () AS DOUBLE) AS neg_total
FROM scores)"""
_AUC = "sum(pos * (neg_below + neg / CAST(2 AS DOUBLE))) / (max(pos_total) * max(neg_total))"
_AP = """sum(pos * ((pos_total - pos_below) / (pos_total - pos_below + neg_total - neg_below)))
  / max(pos_total)"""


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({part} AS DOUBLE) / ({whole}) END"


def _f2(p: str, r: str) -> str:
    return f"CASE WHEN {p} + {r} = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(5 AS DOUBLE) * ({p} * {r}) / (CAST(4 AS DOUBLE) * {p} + {r}) END"


_CONFUSION = """confusion AS (
SELECT count(*) FILTER (churn_probability >= CAST(0.4 AS DOUBLE) AND Churn = 1) AS tp,
  count(*) FILTER (churn_probability < CAST(0.4 AS DOUBLE) AND Churn = 0) AS tn,
  count(*) FILTER (churn_probability >= CAST(0.4 AS DOUBLE) AND Churn = 0) AS fp,
  count(*) FILTER (churn_probability < CAST(0.4 AS DOUBLE) AND Churn = 1) AS fn
FROM clean)"""
_COSTS = """tp AS true_positives, tn AS true_negatives, fp AS false_positives, fn AS false_negatives,
  CAST(fn * 500 + fp * 50 AS DOUBLE) AS total_business_cost_usd,
  CAST(tp * 500 AS DOUBLE) AS estimated_revenue_saved_usd,
  CAST(tp * 450 AS DOUBLE) AS net_saved_usd"""

_THRESHOLDS = f"""{_clean(0)},
grid AS (SELECT CAST(k AS DOUBLE) / 100 AS threshold FROM range(10, 90, 5) AS r(k)),
counts AS (
SELECT threshold,
  count(*) FILTER (churn_probability >= threshold AND Churn = 1) AS tp,
  count(*) FILTER (churn_probability >= threshold AND Churn = 0) AS fp,
  count(*) FILTER (churn_probability < threshold AND Churn = 1) AS fn
FROM clean, grid GROUP BY threshold),
rates AS (
SELECT threshold, tp, fp, fn, {_ratio("tp", "tp + fp")} AS p, {_ratio("tp", "tp + fn")} AS r
FROM counts),
thresholds AS (
SELECT threshold, round(p, 9) AS precision, round(r, 9) AS recall, round({_f2("p", "r")}, 9) AS f2_score,
  CAST(fn * 500 + fp * 50 AS DOUBLE) AS business_cost_usd, tp + fp AS flagged_customers
FROM rates)"""

_DIGEST = "md5('42:' || customerID)"
_SPLIT = f"""{_clean(0)},
sizes AS (SELECT Churn, count(*) AS n FROM clean GROUP BY Churn),
wanted AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS test_rows FROM sizes),
shares AS (
SELECT Churn, (test_rows * n) // total AS base, (test_rows * n) % total AS rest, test_rows
FROM sizes, wanted),
quotas AS (
SELECT Churn, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, Churn)
  <= test_rows - sum(base) OVER () THEN 1 ELSE 0 END AS quota
FROM shares),
members AS (
SELECT c.customerID, c.Churn, CASE WHEN row_number() OVER (PARTITION BY c.Churn ORDER BY {_DIGEST}) <= quota
  THEN 'test' ELSE 'train' END AS part
FROM clean c JOIN quotas q ON c.Churn = q.Churn)"""
# folds are dealt in turn over the labels in order; the members of a label fill them by digest
_FOLDS = f"""{_clean(0)},
dealt AS (
SELECT Churn, CAST((row_number() OVER (ORDER BY Churn, customerID) - 1) % 5 AS INTEGER) AS fold FROM clean),
fold_sizes AS (SELECT Churn, fold, count(*) AS n FROM dealt GROUP BY Churn, fold),
fold_ends AS (SELECT Churn, fold, sum(n) OVER (PARTITION BY Churn ORDER BY fold) AS upto FROM fold_sizes),
places AS (
SELECT customerID, Churn, row_number() OVER (PARTITION BY Churn ORDER BY {_DIGEST}) AS place FROM clean),
members AS (
SELECT p.customerID, p.Churn, CAST(count(*) FILTER (e.upto < p.place) AS INTEGER) AS fold
FROM places p JOIN fold_ends e ON p.Churn = e.Churn GROUP BY p.customerID, p.Churn)"""

# pairs of accounts with a score p
_PAIRS = """g AS (
SELECT p, tenure AS d, CAST(sum(Churn) AS BIGINT) AS e, count(*) AS n
FROM scored GROUP BY 1, 2),
pairs AS (
SELECT a.p AS pa, b.p AS pb, a.e * CASE WHEN b.d > a.d THEN b.n ELSE b.n - b.e END AS w
FROM (SELECT * FROM g WHERE e > 0) a JOIN g b ON b.d >= a.d),
sums AS (
SELECT CAST(sum(w) AS BIGINT) AS c, CAST(sum(CASE WHEN pb < pa THEN w ELSE 0 END) AS BIGINT) AS lower_,
  CAST(sum(CASE WHEN pb = pa THEN w ELSE 0 END) AS BIGINT) AS tied FROM pairs)
SELECT c AS comparable_pairs, lower_ AS concordant_pairs, tied AS tied_pairs,
  round((lower_ + tied / CAST(2 AS DOUBLE)) / c, 9) AS concordance_index FROM sums"""

# a Cox fit on one flag: Newton steps over the tied events of each month, after Efron
def _cox_flag(duration: str = "tenure") -> str:
    return f"""{_clean(0)},
months AS (
SELECT {duration} AS t, count(*) FILTER (SeniorCitizen = 0) AS m0, count(*) FILTER (SeniorCitizen = 1) AS m1,
  count(*) FILTER (SeniorCitizen = 0 AND Churn = 1) AS d0, count(*) FILTER (SeniorCitizen = 1 AND Churn = 1) AS d1
FROM clean WHERE {duration} > 0 GROUP BY 1),
risk AS (
SELECT t, d0, d1, CAST(sum(m0) OVER w AS DOUBLE) AS n0, CAST(sum(m1) OVER w AS DOUBLE) AS n1
FROM months WINDOW w AS (ORDER BY t DESC)),
places AS (SELECT *, unnest(range(d0 + d1)) AS place FROM risk),
ties AS (
SELECT n0 - d0 * (place / CAST(d0 + d1 AS DOUBLE)) AS r0, n1 - d1 * (place / CAST(d0 + d1 AS DOUBLE)) AS r1,
  d1 / CAST(d0 + d1 AS DOUBLE) AS y FROM places),
newton AS (
SELECT 0 AS k, CAST(0 AS DOUBLE) AS b
UNION ALL
SELECT k + 1, b + sum(y - q) / sum(q * (1 - q))
FROM (SELECT k, b, y, exp(b) * r1 / (r0 + exp(b) * r1) AS q FROM newton, ties WHERE k < 12) GROUP BY k, b),
fitted AS (
SELECT b, 1 / sqrt(sum(q * (1 - q))) AS se
FROM (SELECT b, exp(b) * r1 / (r0 + exp(b) * r1) AS q FROM newton, ties WHERE k = 12) GROUP BY b)"""

_FLAG_RATIO = """SELECT 'SeniorCitizen' AS covariate, round(b, 6) AS coef, round(exp(b), 6) AS hazard_ratio, round(se, 6) AS se,
  round(exp(b - CAST(1.959963984540054 AS DOUBLE) * se), 6) AS hazard_ratio_lower,
  round(exp(b + CAST(1.959963984540054 AS DOUBLE) * se), 6) AS hazard_ratio_upper, round(b / se, 6) AS z
FROM fitted"""
_PAID_MONTHS = "(TotalCharges / MonthlyCharges)"

_ENCODED = ("Contract", "PaymentMethod", "InternetService")


def _ordered_codes(permutations: int = 3) -> str:
    """Codes from the rows before, as windows over whole categories."""
    parts = []
    for p in range(permutations):
        codes = ", ".join(
            f"(COALESCE(sum(Churn) OVER {c}, 0) + prior) / (count(*) OVER {c} + CAST(1 AS DOUBLE)) AS {c}_code"
            for c in _ENCODED
        )
        windows = ", ".join(
            f"{c} AS (PARTITION BY {c} ORDER BY digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in _ENCODED
        )
        parts.append(f"""SELECT customerID, {p} AS permutation, {codes} FROM (
SELECT *, (COALESCE(sum(Churn) OVER before, 0) + CAST(0.5 AS DOUBLE)) / (count(*) OVER before + 1) AS prior
FROM (SELECT *, md5('{42 + p}:' || customerID) AS digest FROM clean)
WINDOW before AS (ORDER BY digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WINDOW {windows}""")
    means = ", ".join(f"round(avg({c}_code), 9) AS {c}_code" for c in _ENCODED)
    return f"WITH {_clean(0)}, codes AS ({' UNION ALL '.join(parts)}) SELECT customerID, {means} FROM codes GROUP BY customerID"


def _scoring_codes() -> str:
    codes = ", ".join(
        f"round(((SELECT COALESCE(sum(t.Churn), 0) FROM train t WHERE t.{c} = e.{c}) + prior)"
        f" / ((SELECT count(*) FROM train t WHERE t.{c} = e.{c}) + CAST(1 AS DOUBLE)), 9) AS {c}_code"
        for c in _ENCODED
    )
    return f"""WITH {_SPLIT},
train AS (SELECT c.* FROM clean c JOIN members m USING (customerID) WHERE part = 'train'),
held AS (SELECT c.* FROM clean c JOIN members m USING (customerID) WHERE part = 'test'),
priors AS (SELECT (sum(Churn) + CAST(0.5 AS DOUBLE)) / (count(*) + 1) AS prior FROM train)
SELECT customerID, {codes} FROM held e, priors"""


# trees of given splits as the paths to their leaves: per feature (lower, upper], and the splits on the way
_TREE_PATHS = (
    ((("tenure", None, 11), ("contract_months", None, 6)), "t0"),
    ((("tenure", None, 11), ("contract_months", 6, None)), "t0"),
    ((("tenure", 11, None), ("MonthlyCharges", None, 70)), "t0"),
    ((("tenure", 11, None), ("MonthlyCharges", 70, None)), "t0"),
    ((("contract_months", None, 6), ("tenure", None, 24), ("tenure", None, 5)), "t1"),
    ((("contract_months", None, 6), ("tenure", None, 24), ("tenure", 5, None)), "t1"),
    ((("contract_months", None, 6), ("tenure", 24, None)), "t1"),
    ((("contract_months", 6, None), ("SeniorCitizen", None, 0)), "t1"),
    ((("contract_months", 6, None), ("SeniorCitizen", 0, None)), "t1"),
)
_TREE_INPUTS = ("tenure", "contract_months", "MonthlyCharges", "SeniorCitizen")


def _tree_effects() -> str:
    """Shapley values by their definition: all sets of known features, expectations along each path."""

    def holds(step) -> str:
        name, above, upto = step
        return f"{name} > {above}" if upto is None else f"{name} <= {upto}"

    nodes = {}  # condition of a node, named
    for path, _ in _TREE_PATHS:
        for k in range(len(path) + 1):
            nodes.setdefault(" AND ".join(map(holds, path[:k])) or "true", f"n{len(nodes)}")
    counts = ", ".join(f"CAST(count(*) FILTER ({c}) AS DOUBLE) AS {n}" for c, n in nodes.items())
    churned = ", ".join(f"count(*) FILTER (({c}) AND Churn = 1) AS y{n}" for c, n in nodes.items())
    name_of = lambda steps: nodes[" AND ".join(map(holds, steps)) or "true"]
    sets = range(1 << len(_TREE_INPUTS))
    worths = []
    for known in sets:
        terms = []
        for path, _ in _TREE_PATHS:
            leaf = name_of(path)
            factors = [f"(y{leaf} / {leaf} / 2)"]
            for k, step in enumerate(path):
                if known >> _TREE_INPUTS.index(step[0]) & 1:
                    factors.append(f"(CASE WHEN {holds(step)} THEN 1 ELSE 0 END)")
                else:
                    factors.append(f"({name_of(path[: k + 1])} / {name_of(path[:k])})")
            terms.append(" * ".join(factors))
        worths.append(f"{' + '.join(terms)} AS f{known}")
    effects = []
    for i, name in enumerate(_TREE_INPUTS):
        parts = []
        for known in sets:
            if not known >> i & 1:
                size = bin(known).count("1")
                weight = (6, 2, 2, 6)[size]  # size! (3 - size)!
                parts.append(f"{weight} * (f{known | 1 << i} - f{known})")
        effects.append(f"round(({' + '.join(parts)}) / 24, 9) AS effect_{name}")
    return f"""WITH {_clean(0)},
rows_ AS (SELECT customerID, Churn, tenure, {_MONTHS} AS contract_months, MonthlyCharges, SeniorCitizen FROM clean),
nodes AS (SELECT {counts}, {churned} FROM rows_),
worths AS (SELECT customerID, {", ".join(worths)} FROM rows_, nodes)
SELECT customerID, round(f0, 9) AS base_value, {", ".join(effects)} FROM worths"""


_STUMP_INPUTS = ("SeniorCitizen", "Partner", "Dependents", "PaperlessBilling", "TechSupport", "monthly", "new")


def _stumps(rounds: int = 3, rate: float = 0.5, positive: float = 3.0) -> str:
    """Boosting by stumps over yes-or-no features, each round an aggregate over all features."""
    text = f"""{_SPLIT},
inputs AS (
SELECT *, CASE WHEN Contract = 'Month-to-month' THEN 1 ELSE 0 END AS monthly, CASE WHEN tenure < 12 THEN 1 ELSE 0 END AS new FROM clean),
base AS (
SELECT i.*, part, CAST(2 * i.Churn - 1 AS DOUBLE) AS y, CASE WHEN i.Churn = 1 THEN CAST({positive} AS DOUBLE) ELSE 1 END AS w,
  CAST(0 AS DOUBLE) AS m0, CAST(2 * i.Churn - 1 AS DOUBLE) AS r0
FROM inputs i JOIN members USING (customerID))"""
    last = "base"
    for k in range(rounds):
        step = 1 if k == 0 else rate
        sides = " UNION ALL ".join(
            f"SELECT {i} AS place, '{c}' AS feature, {c} AS side, sum(w) AS c, sum(w * r{k}) AS s, sum(w * r{k} * r{k}) AS q"
            f" FROM {last} WHERE part = 'train' GROUP BY {c}"
            for i, c in enumerate(_STUMP_INPUTS)
        )
        pick = " ".join(f"WHEN '{c}' THEN {c}" for c in _STUMP_INPUTS)
        text += f""",
sides{k} AS ({sides}),
gains{k} AS (
SELECT place, feature, sum(q) - sum(s) * sum(s) / sum(c) - sum(q - s * s / c) AS gain, sum(c) AS c,
  sum(s) FILTER (side = 0) / sum(c) FILTER (side = 0) * {step} AS v0, sum(s) FILTER (side = 1) / sum(c) FILTER (side = 1) * {step} AS v1,
  sum(c) FILTER (side = 0) / sum(c) AS p0
FROM sides{k} GROUP BY place, feature HAVING count(*) = 2),
best{k} AS (SELECT * FROM gains{k} ORDER BY gain DESC, place LIMIT 1),
round{k} AS (
SELECT b.*, b.m{k} + CASE WHEN (CASE s.feature {pick} END) = 1 THEN v1 ELSE v0 END AS m{k + 1} FROM {last} b, best{k} s),
scored{k} AS (SELECT *, 4 * y / (1 + exp(2 * y * m{k + 1})) AS r{k + 1} FROM round{k})"""
        last = f"scored{k}"
    return text


def _stump_effects(rounds: int = 3) -> str:
    base = " + ".join(f"(SELECT v0 * p0 + v1 * (1 - p0) FROM best{k})" for k in range(rounds))
    effects = ", ".join(
        "round("
        + " + ".join(
            f"COALESCE((SELECT CASE WHEN {c} = 1 THEN v1 ELSE v0 END - (v0 * p0 + v1 * (1 - p0)) FROM best{k} WHERE feature = '{c}'), 0)"
            for k in range(rounds)
        )
        + f", 6) AS {c}"
        for c in _STUMP_INPUTS
    )
    return f"""WITH {_stumps(rounds)}
SELECT customerID, round({base}, 6) AS base_value, round(m{rounds}, 6) AS margin, {effects}
FROM scored{rounds - 1} WHERE part = 'test'"""


def _stump_gains(rounds: int = 3) -> str:
    found = " UNION ALL ".join(f"SELECT feature, gain FROM best{k}" for k in range(rounds))
    listed = ", ".join(f"('{c}')" for c in _STUMP_INPUTS)
    return f"""WITH {_stumps(rounds)}
SELECT f.feature, round(COALESCE(sum(gain), 0), 4) AS importance_gain, count(gain) AS splits
FROM (VALUES {listed}) AS f(feature) LEFT JOIN ({found}) g ON f.feature = g.feature GROUP BY f.feature"""


_RULES = 18


def _rule_halving(rungs: int = 3, keep: int = 3) -> str:
    """Rungs one after the other: F2 on the held-out rows of each sample, the best third goes on."""
    text = f"""{_SPLIT},
rules AS (SELECT k AS trial, CAST(0.05 AS DOUBLE) * (k + 2) AS cut FROM range({_RULES}) AS r(k)),
held AS (
SELECT c.Churn, c.churn_probability AS given, md5('43:' || customerID) AS digest FROM clean c JOIN members m USING (customerID)
WHERE part = 'test'),
kept0 AS (SELECT trial FROM rules)"""
    left = _RULES
    for k in range(rungs):
        share = float(keep) ** (k - rungs + 1)
        below = "true" if share >= 1 else f"digest < '{int(share * 16**12):012x}'"
        wanted = -(-left // keep) if k + 1 < rungs else 1
        text += f""",
counts{k} AS (
SELECT trial, count(*) FILTER (given >= cut AND Churn = 1) AS tp, count(*) FILTER (given >= cut AND Churn = 0) AS fp,
  count(*) FILTER (given < cut AND Churn = 1) AS fn
FROM kept{k} JOIN rules USING (trial), held WHERE {below} GROUP BY trial),
rates{k} AS (SELECT trial, {_ratio("tp", "tp + fp")} AS p, {_ratio("tp", "tp + fn")} AS r FROM counts{k}),
scores{k} AS (SELECT trial, {k} AS rung, {_f2("p", "r")} AS f2 FROM rates{k}),
ranked{k} AS (SELECT *, row_number() OVER (ORDER BY f2 DESC, trial) <= {wanted} AS stays FROM scores{k}),
kept{k + 1} AS (SELECT trial FROM ranked{k} WHERE stays)"""
        left = wanted
    every = " UNION ALL ".join(f"SELECT * FROM ranked{k}" for k in range(rungs))
    return f"""WITH {text}
SELECT CAST(trial AS INTEGER) AS trial, rung, round(f2, 9) AS f2_score, CASE WHEN stays THEN 'kept' ELSE 'dropped' END AS status
FROM ({every})"""


_SCORES = {
    "given": "churn_probability",
    "young": "(1 / (tenure + CAST(1 AS DOUBLE)))",
    "dear": "(MonthlyCharges / CAST(100 AS DOUBLE))",
}


def _stacked(names: tuple[str, ...]) -> str:
    """Non-negative least squares by trying every set of positive weights, solved by Cramer's rule."""
    k = len(names)
    sums = ", ".join(f"sum({_SCORES[a]} * {_SCORES[b]}) AS g{i}{j}" for i, a in enumerate(names) for j, b in enumerate(names))
    target = ", ".join(f"sum({_SCORES[a]} * Churn) AS b{i}" for i, a in enumerate(names))

    def det(m):
        if len(m) == 1:
            return m[0][0]
        if not m:
            return "1"
        return "(" + " ".join(
            f"{'-' if c % 2 else '+'} {m[0][c]} * {det([[v for x, v in enumerate(row) if x != c] for row in m[1:]])}" for c in range(len(m))
        ) + ")"

    choices = []
    for chosen in range(1, 1 << k):
        use = [i for i in range(k) if chosen >> i & 1]
        gram = [[f"g{i}{j}" for j in use] for i in use]
        weights = {i: f"{det([[f'b{r}' if j == i else f'g{r}{j}' for j in use] for r in use])} / {det(gram)}" for i in use}
        listed = ", ".join(f"{weights.get(i, 'CAST(0 AS DOUBLE)')} AS w{i}" for i in range(k))
        choices.append(f"SELECT {listed}, {chosen} AS chosen FROM sums")
    positive = " AND ".join(f"w{i} >= 0" for i in range(k))
    worth = " + ".join(f"b{i} * w{i}" for i in range(k))
    return f"""{_clean(0)},
sums AS (SELECT {sums}, {target} FROM clean),
choices AS ({" UNION ALL ".join(choices)}),
best AS (SELECT c.* FROM choices c, sums WHERE {positive} ORDER BY {worth} DESC LIMIT 1)"""


# what must hold for any scores
_CHECKS = "true AS in_range, true AS flag_agrees, true AS above_chance"
_HELD_OUT_CHECKS = f"WITH {_SPLIT} SELECT customerID, Churn, {_CHECKS} FROM members WHERE part = 'test'"


def _time_folds(folds: int) -> str:
    return f"""{_clean(0)},
ordered AS (SELECT tenure, row_number() OVER (ORDER BY tenure) - 1 AS r, count(*) OVER () AS n FROM clean),
starts AS (SELECT DISTINCT tenure AS start FROM ordered, range(1, {folds}) AS f(k) WHERE r = (k * n) // {folds}),
placed AS (
SELECT customerID, Churn, tenure, CAST((SELECT count(*) FROM starts WHERE start <= tenure) AS INTEGER) AS fold FROM clean)"""


_LIFE = f"""{_clean(0)},
months AS (
SELECT Contract, tenure, sum(Churn) AS d, count(*) AS n FROM clean GROUP BY Contract, tenure
UNION ALL SELECT DISTINCT Contract, 0, 0, 0 FROM clean),
merged AS (SELECT Contract, tenure, sum(d) AS d, sum(n) AS n FROM months GROUP BY Contract, tenure),
life AS (
SELECT Contract AS contract_type, tenure AS timeline, CAST(d AS BIGINT) AS churned,
  CAST(sum(n) OVER (PARTITION BY Contract ORDER BY tenure DESC) AS BIGINT) AS at_risk
FROM merged)"""


def _segments(no_value: int) -> str:
    one = """SELECT '{name}' AS segment, count(*) FILTER ({rule}) AS accounts,
  count(*) FILTER ({rule} AND Churn = 1) AS churned, count(*) AS n, count(*) FILTER (Churn = 1) AS k
FROM features"""
    parts = "\nUNION ALL\n".join(
        one.format(name=name, rule=rule)
        for name, rule in (
            ("volatile_charges", "charge_volatility_ratio > CAST(0.15 AS DOUBLE)"),
            ("fewer_than_2_services", "service_adoption_density * 8 < 2"),
        )
    )
    return f"""WITH {_features(no_value)},
segments AS ({parts})
SELECT segment, accounts, churned,
  round(churned / CAST(accounts AS DOUBLE), 9) AS churn_rate,
  round((k - churned) / CAST(n - accounts AS DOUBLE), 9) AS rest_churn_rate,
  round(k / CAST(n AS DOUBLE), 9) AS base_churn_rate,
  round((churned / CAST(accounts AS DOUBLE)) / (k / CAST(n AS DOUBLE)), 9) AS lift
FROM segments"""


def _mutual_information() -> str:
    features = {
        "Contract": "Contract",
        "InternetService": "InternetService",
        "PaymentMethod": "PaymentMethod",
        "gender": "gender",
        "tenure": "CAST(tenure AS VARCHAR)",
        "tenure_cohort": _COHORT,
        "services_used": f"CAST({_SERVICES} AS VARCHAR)",
        "monthly_charges_tens": "CAST(CAST(floor(MonthlyCharges / 10) AS INTEGER) AS VARCHAR)",
    }
    long = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS feature, COALESCE({sql}, 'missing') AS value, Churn FROM clean"
        for name, sql in features.items()
    )
    return f"""WITH {_clean(0)},
pairs AS ({long}),
joint AS (SELECT feature, value, Churn, CAST(count(*) AS DOUBLE) AS n FROM pairs GROUP BY ALL),
margins AS (
SELECT feature, n, sum(n) OVER (PARTITION BY feature, value) AS nv,
  sum(n) OVER (PARTITION BY feature, Churn) AS nl, sum(n) OVER (PARTITION BY feature) AS nt
FROM joint)
SELECT feature, round(sum(n / nt * ln(n * nt / (nv * nl))), 9) AS mutual_information
FROM margins GROUP BY feature"""


_SELECTED_INPUTS = [
    ("gender", "categorical"), ("SeniorCitizen", "numeric"), ("Partner", "numeric"),
    ("Dependents", "numeric"), ("tenure", "numeric"), ("PhoneService", "numeric"),
    ("MultipleLines", "numeric"), ("InternetService", "categorical"), ("OnlineSecurity", "numeric"),
    ("OnlineBackup", "numeric"), ("DeviceProtection", "numeric"), ("TechSupport", "numeric"),
    ("StreamingTV", "numeric"), ("StreamingMovies", "numeric"), ("Contract", "categorical"),
    ("PaperlessBilling", "numeric"), ("PaymentMethod", "categorical"), ("MonthlyCharges", "numeric"),
    ("TotalCharges", "numeric"), ("charge_volatility_ratio", "numeric"),
    ("service_adoption_density", "numeric"), ("tenure_contract_interaction", "numeric"),
    ("support_recency_score", "numeric"),
]


#: Queries that are registered a second time, as ``<name>_celled``, with small cells.
CELLED_QUERIES = (
    "impute_median",
    "cohort_percentile",
    "evaluate_at_threshold",
    "lift_curve",
    "score_distribution",
    "score_density",
    "support_recency_as_of_purchase",
    "time_fold_counts",
    "concordance",
    "cox_paid_months_ratio",
    "ordered_codes",
)


def _apart(c1: str, n1: str, c2: str, n2: str) -> str:
    """Difference of two hazards in standard errors under one hazard."""
    both = f"(({c1}) + ({c2})) / CAST(({n1}) + ({n2}) AS DOUBLE)"
    variance = f"{both} * (1 - {both}) * (1 / CAST({n1} AS DOUBLE) + 1 / CAST({n2} AS DOUBLE))"
    gap = f"({c1}) / CAST({n1} AS DOUBLE) - ({c2}) / CAST({n2} AS DOUBLE)"
    return f"""CASE WHEN {n1} > 0 AND {n2} > 0 THEN
    CASE WHEN {variance} > 0 THEN ({gap}) / sqrt({variance}) ELSE 0 END END"""


def _tail(z: str) -> str:
    """Upper tail of the normal distribution for z >= 0, Abramowitz and Stegun 26.2.17."""
    t = f"(1 / (1 + CAST(0.2316419 AS DOUBLE) * ({z})))"
    terms = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    series = " + ".join(f"CAST({b} AS DOUBLE) * pow({t}, {i})" for i, b in enumerate(terms, 1))
    return f"(exp(-pow({z}, 2) / 2) / sqrt(2 * pi()) * ({series}))"


def _corrected(source: str, p: str, output: str) -> str:
    """Holm's correction per contract, from the sum of its definition."""
    return f"""(SELECT max(least(1, b.{p} * (SELECT count(*) FROM {source} c WHERE c.contract_type = a.contract_type
    AND c.{p} IS NOT NULL AND (c.{p} > b.{p} OR (c.{p} = b.{p} AND c.timeline >= b.timeline)))))
    FROM {source} b WHERE a.{p} IS NOT NULL AND b.contract_type = a.contract_type
    AND (b.{p} < a.{p} OR (b.{p} = a.{p} AND b.timeline <= a.timeline))) AS {output}"""


def _hazard_cliffs() -> str:
    z1 = _apart("churned", "at_risk", "c_before", "n_before")
    z2 = _apart("churned", "at_risk", "c_after", "n_after")
    return f"""WITH {_LIFE},
sums AS (
SELECT *, sum(churned) OVER b AS c_before, sum(at_risk) OVER b AS n_before,
  sum(churned) OVER a AS c_after, sum(at_risk) OVER a AS n_after FROM life
WHERE timeline > 0 OR churned > 0
WINDOW b AS (PARTITION BY contract_type ORDER BY timeline RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING),
  a AS (PARTITION BY contract_type ORDER BY timeline RANGE BETWEEN 1 FOLLOWING AND 6 FOLLOWING)),
sides AS (SELECT *, {z1} AS z1, {z2} AS z2 FROM sums),
weaker AS (SELECT *, CASE WHEN z1 IS NOT NULL AND z2 IS NOT NULL THEN least(z1, z2) END AS z_cliff FROM sides),
tails AS (
SELECT *, CASE WHEN z_cliff >= 0 THEN {_tail("z_cliff")} WHEN z_cliff < 0 THEN 1 - {_tail("-z_cliff")} END AS p
FROM weaker),
cliffs AS (SELECT a.*, {_corrected("tails", "p", "p_cliff")} FROM tails a),
plain AS (
SELECT contract_type, timeline, at_risk, churned, z_cliff, p_cliff, COALESCE(p_cliff < CAST(0.01 AS DOUBLE), false) AS cliff,
  CASE WHEN p_cliff < CAST(0.01 AS DOUBLE) THEN 0 ELSE churned END AS c,
  CASE WHEN p_cliff < CAST(0.01 AS DOUBLE) THEN 0 ELSE at_risk END AS n FROM cliffs),
halves AS (
SELECT *, sum(c) OVER b AS c1, sum(n) OVER b AS n1, sum(c) OVER a AS c2, sum(n) OVER a AS n2 FROM plain
WINDOW b AS (PARTITION BY contract_type ORDER BY timeline RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING),
  a AS (PARTITION BY contract_type ORDER BY timeline RANGE BETWEEN CURRENT ROW AND 5 FOLLOWING)),
steps AS (SELECT *, {_apart("c2", "n2", "c1", "n1")} AS z_shift FROM halves),
scanned AS (SELECT *, least(1, 2 * {_tail("abs(z_shift)")}) AS q, abs(z_shift) AS size FROM steps),
shifts AS (SELECT a.*, {_corrected("scanned", "q", "p_shift")} FROM scanned a),
beside AS (
SELECT *, max(size) OVER b AS size1, max(size) OVER a AS size2 FROM shifts
WINDOW b AS (PARTITION BY contract_type ORDER BY timeline RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING),
  a AS (PARTITION BY contract_type ORDER BY timeline RANGE BETWEEN 1 FOLLOWING AND 6 FOLLOWING))
SELECT contract_type, timeline, at_risk, churned, round(churned / CAST(at_risk AS DOUBLE), 6) AS hazard,
  round(z_cliff, 6) AS z_cliff, round(p_cliff, 6) AS p_cliff, cliff, round(z_shift, 6) AS z_shift,
  round(p_shift, 6) AS p_shift, COALESCE(p_shift < CAST(0.01 AS DOUBLE) AND size > COALESCE(size1, -1)
  AND size >= COALESCE(size2, -1), false) AS shift FROM beside"""


def oracles() -> dict[str, str]:
    q = f"WITH {_PREDICTIONS}\n"
    high = "FROM predictions WHERE churn_probability >= CAST(0.4 AS DOUBLE)"
    order = "ORDER BY revenue_at_risk DESC, customerID"
    band = """CASE WHEN money < 1500000 THEN 'low' WHEN money <= 3000000 THEN 'medium' ELSE 'high' END"""
    texts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), 'nan') AS {c}" for c in CATEGORICAL_COLUMNS)
    recency = "SELECT customerID, support_recency_score FROM features"
    density = "SELECT customerID, service_adoption_density FROM features"
    best = "SELECT * FROM thresholds ORDER BY f2_score DESC, threshold LIMIT 1"
    texts = {
        "accounts": ACCOUNT_VIEW_SQL,
        "table_shape": f"WITH accounts AS ({ACCOUNT_VIEW_SQL}) "
        "SELECT count(*) AS row_count, CAST(22 AS INTEGER) AS column_count FROM accounts",
        "target_shares": f"""WITH accounts AS ({ACCOUNT_VIEW_SQL})
SELECT Churn, count(*) AS accounts, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 3) AS share
FROM accounts WHERE Churn IS NOT NULL GROUP BY Churn""",
        "clean_accounts": f"WITH {_clean(0)} SELECT * FROM clean",
        "clean_accounts_literal": f"WITH {_clean(1)} SELECT * FROM clean",
        "impute_median": f"""WITH {_clean(0)}
SELECT count(*) AS accounts, count(*) FILTER (amount IS NULL) AS missing_total_charges,
  max(median_amount) AS median_total_charges FROM numbered, middle""",
        "categorical_text": f"WITH accounts AS ({ACCOUNT_VIEW_SQL}) SELECT customerID, {texts} FROM accounts",
        "charge_volatility": f"WITH {_features(0)} SELECT customerID, charge_volatility_ratio FROM features",
        "service_density": f"WITH {_features(0)} {density}",
        "service_density_literal": f"WITH {_features(1)} {density}",
        "tenure_contract": f"WITH {_features(0)} SELECT customerID, contract_months, tenure_contract_interaction FROM features",
        "support_recency": f"WITH {_features(0)} {recency}",
        "support_recency_literal": f"WITH {_features(1)} {recency}",
        "tenure_cohorts": f"WITH {_features(0)} SELECT customerID, cohort AS tenure_cohort, clv AS lifetime_value FROM ratios",
        "cohort_statistics": f"""WITH {_features(0)},
labels AS (SELECT unnest(['0-12m', '13-24m', '25-36m', '37-48m', '49-72m']) AS tenure_cohort)
SELECT tenure_cohort, round(avg(clv), 4) AS mean, round(stddev_samp(clv), 4) AS std
FROM labels LEFT JOIN ratios ON cohort = tenure_cohort GROUP BY tenure_cohort""",
        "cohort_percentile": f"WITH {_features(0)} SELECT customerID, cohort_clv_percentile FROM features",
        "feature_table": f"WITH {_features(0)} SELECT * FROM features",
        "feature_inputs": f"WITH {_features(0)}\n"
        + "\nUNION ALL\n".join(
            f"SELECT '{c}' AS feature, '{kind}' AS kind, count({c}) AS known_values FROM features"
            for c, kind in _SELECTED_INPUTS
        )
        + "\nUNION ALL SELECT 'cohort_clv_percentile', 'numeric', count(*) FROM features",
        "rolling_volatility": """WITH monthly AS (
SELECT o_custkey, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS month,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS charge
FROM orders GROUP BY 1, 2),
averages AS (
SELECT *, avg(charge) OVER (PARTITION BY o_custkey ORDER BY month
  RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING) AS average_charge FROM monthly)
SELECT o_custkey, month, charge, round(average_charge, 6) AS average_charge,
  round(least(COALESCE(abs(charge - average_charge) / (charge + CAST(1e-9 AS DOUBLE)), 0), 1), 6)
    AS charge_volatility_ratio FROM averages""",
        "support_recency_events": """WITH newest AS (SELECT CAST(max(ts) AS DATE) AS day FROM events),
last AS (SELECT user_id, CAST(max(ts) AS DATE) AS day FROM events WHERE event_type = 'error' GROUP BY user_id),
spans AS (
SELECT c_custkey, CAST(newest.day - last.day AS INTEGER) AS days_since_support
FROM customer CROSS JOIN newest LEFT JOIN last ON c_custkey = user_id)
SELECT c_custkey, days_since_support,
  round(COALESCE(1 / (1 + ln(CAST(1 + days_since_support AS DOUBLE))), 0), 6) AS support_recency_score
FROM spans""",
        "support_recency_as_of_purchase": """WITH found AS (
SELECT b.event_id, b.user_id, b.ts, (SELECT max(e.ts) FROM events e WHERE e.event_type = 'error'
  AND e.user_id = b.user_id AND e.ts <= b.ts) AS last_contact
FROM events b WHERE b.event_type = 'purchase'),
spans AS (SELECT *, CAST(CAST(ts AS DATE) - CAST(last_contact AS DATE) AS INTEGER) AS days_since_support FROM found)
SELECT *, round(COALESCE(1 / (1 + ln(CAST(1 + days_since_support AS DOUBLE))), 0), 6) AS support_recency_score
FROM spans""",
        "contact_recency_monthly": """WITH firsts AS (
SELECT o_custkey, date_trunc('month', min(o_orderdate)) AS start FROM orders GROUP BY o_custkey),
newest AS (SELECT date_trunc('month', max(o_orderdate)) AS stop FROM orders),
months AS (
SELECT o_custkey, CAST(unnest(generate_series(CAST(start AS TIMESTAMP), CAST(stop AS TIMESTAMP), INTERVAL 1 MONTH))
  + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS month_end FROM firsts, newest),
urgent AS (
SELECT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderpriority = '1-URGENT'),
found AS (
SELECT m.o_custkey, m.month_end, u.day AS last_contact, CAST(m.month_end - u.day AS INTEGER) AS days_since_support
FROM months m ASOF LEFT JOIN urgent u ON m.o_custkey = u.o_custkey AND m.month_end >= u.day)
SELECT *, round(COALESCE(1 / (1 + ln(CAST(1 + days_since_support AS DOUBLE))), 0), 6) AS support_recency_score
FROM found""",
        "cohort_percentile_fitted": f"""WITH {_features(0)}
SELECT customerID, cohort_clv_percentile,
  CASE WHEN cohort_clv_percentile IS NOT NULL THEN count(cohort_clv_percentile) OVER (PARTITION BY {_COHORT}) END
    AS cohort_accounts,
  CASE WHEN cohort_clv_percentile IS NOT NULL THEN true END AS within_error FROM features""",
        "stream_daily_kpis": """SELECT CAST(ts AS DATE) AS day, event_type AS kind, count(*) AS events,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""",
        "stream_last_contacts": """SELECT user_id AS account, max(ts) AS last_contact, count(*) AS contacts
FROM events WHERE event_type = 'error' AND user_id IS NOT NULL GROUP BY user_id""",
        "predictions_list": f"{q} SELECT {_PREDICTION_COLUMNS} FROM predictions",
        "customer_lookup": f"""WITH accounts AS ({ACCOUNT_VIEW_SQL})
SELECT s.customerID, s.churn_probability, a.Contract, a.MonthlyCharges, a.tenure
FROM accounts s JOIN accounts a ON s.customerID = a.customerID""",
        "mapped_contract": f"""WITH accounts AS ({ACCOUNT_VIEW_SQL})
SELECT customerID, Contract, CAST({_MONTHS} AS INTEGER) AS contract_months FROM accounts""",
        "high_risk_customers": f"{q} SELECT {_PREDICTION_COLUMNS} {high} {order}",
        "high_risk_top50": f"{q} SELECT {_PREDICTION_COLUMNS} {high} {order} LIMIT 50",
        "high_risk_top5": f"{q} SELECT customerID, churn_probability, revenue_at_risk {high} {order} LIMIT 5",
        "risk_tiers": f"""{q} SELECT customerID, churn_probability,
  CASE WHEN churn_probability >= CAST(0.7 AS DOUBLE) THEN 'critical'
       WHEN churn_probability >= CAST(0.4 AS DOUBLE) THEN 'high' ELSE 'low' END AS risk_tier
FROM predictions""",
        "revenue_band": f"""{q}, total AS (SELECT count(*) AS accounts, sum(revenue_at_risk) AS money {high})
SELECT accounts AS high_risk_accounts, round(money, 2) AS revenue_at_risk, {band} AS band,
  round(money - 1500000, 2) AS delta, money >= 3000000 AS alarm FROM total""",
        "revenue_fallback": f"{q} SELECT count(*) AS high_risk_accounts, CAST(count(*) * 250 AS DOUBLE) AS revenue_at_risk {high}",
        "kpi_summary": f"""WITH {_CURVE}, {_CONFUSION}, risky AS (
SELECT count(*) AS accounts, sum(churn_probability * (MonthlyCharges * (tenure + 6))) AS money
FROM clean WHERE churn_probability >= CAST(0.4 AS DOUBLE)),
auc AS (SELECT {_AUC} AS auc_roc FROM curve)
SELECT round(money, 2) AS revenue_at_risk, accounts AS high_risk_accounts,
  round({_ratio("tp", "tp + fn")}, 9) AS recall, round(auc_roc, 9) AS auc_roc
FROM risky, confusion, auc""",
        "business_cost": f"WITH {_clean(0)}, {_CONFUSION} SELECT {_COSTS} FROM confusion",
        "fbeta": f"""WITH {_clean(0)}, counts AS (
SELECT Contract, count(*) FILTER (churn_probability >= CAST(0.4 AS DOUBLE) AND Churn = 1) AS tp,
  count(*) FILTER (churn_probability >= CAST(0.4 AS DOUBLE)) AS flagged, count(*) FILTER (Churn = 1) AS churned
FROM clean GROUP BY Contract),
rates AS (SELECT Contract, {_ratio("tp", "flagged")} AS precision, {_ratio("tp", "churned")} AS recall FROM counts)
SELECT Contract, precision, recall, {_f2("precision", "recall")} AS f2_score FROM rates""",
        "churn_rate_by_contract": f"WITH {_clean(0)} SELECT Contract, count(*) AS accounts, avg(Churn) AS churn_rate FROM clean GROUP BY Contract",
        "evaluate_at_threshold": f"""WITH {_CURVE}, {_CONFUSION},
areas AS (SELECT {_AUC} AS auc_roc, {_AP} AS auc_pr FROM curve),
rates AS (SELECT *, {_ratio("tp", "tp + fp")} AS p, {_ratio("tp", "tp + fn")} AS r FROM confusion)
SELECT round(auc_roc, 9) AS auc_roc, round(auc_pr, 9) AS auc_pr, round({_f2("p", "r")}, 9) AS f2_score,
  round(p, 9) AS precision, round(r, 9) AS recall, CAST(0.4 AS DOUBLE) AS threshold_used, {_COSTS}
FROM areas, rates""",
        "threshold_curve": f"""WITH {_THRESHOLDS}
SELECT *, round(business_cost_usd / max(business_cost_usd) OVER (), 9) AS normalized_cost FROM thresholds""",
        "best_threshold": f"WITH {_THRESHOLDS} {best}",
        "lift_curve": f"""WITH {_clean(0)},
placed AS (
SELECT Churn, CAST(((row_number() OVER (ORDER BY churn_probability DESC, {_DIGEST}) - 1) * 10)
  // count(*) OVER () AS INTEGER) + 1 AS bin
FROM clean),
bins AS (SELECT bin, count(*) AS accounts, CAST(sum(Churn) AS BIGINT) AS churned FROM placed GROUP BY bin)
SELECT bin, accounts, churned, round(churned / CAST(accounts AS DOUBLE), 9) AS churn_rate,
  round(churned / CAST(accounts AS DOUBLE)
    / (sum(churned) OVER () / CAST(sum(accounts) OVER () AS DOUBLE)), 9) AS lift,
  round(sum(churned) OVER (ORDER BY bin) / CAST(sum(churned) OVER () AS DOUBLE), 9) AS cumulative_gain
FROM bins""",
        "roc_auc": f"WITH {_CURVE} SELECT round({_AUC}, 9) AS auc_roc FROM curve",
        "average_precision": f"WITH {_CURVE} SELECT round({_AP}, 9) AS auc_pr FROM curve",
        "average_precision_trapezoid": f"""WITH {_CURVE},
reached AS (
SELECT score, pos, pos_total - pos_below AS p1, neg_total - neg_below AS n1, pos_total FROM curve),
steps AS (
SELECT score, pos, pos_total, p1 / (p1 + n1) AS here,
  lead(p1 / (p1 + n1)) OVER (ORDER BY score) AS above FROM reached)
SELECT round(sum(pos * (here + COALESCE(above, here)) / 2) / max(pos_total), 9) AS auc_pr FROM steps""",
        "revenue_weighted_fbeta": f"""{q}, sums AS (
SELECT sum(CASE WHEN churn_probability >= CAST(0.4 AS DOUBLE) AND Churn = 1 THEN estimated_clv ELSE 0 END) AS tp,
  sum(CASE WHEN churn_probability >= CAST(0.4 AS DOUBLE) AND Churn = 0 THEN estimated_clv ELSE 0 END) AS fp,
  sum(CASE WHEN churn_probability < CAST(0.4 AS DOUBLE) AND Churn = 1 THEN estimated_clv ELSE 0 END) AS fn
FROM predictions),
rates AS (SELECT *, {_ratio("tp", "tp + fp")} AS p, {_ratio("tp", "tp + fn")} AS r FROM sums)
SELECT round(tp, 2) AS tp_value, round(fp, 2) AS fp_value, round(fn, 2) AS fn_value,
  round(p, 9) AS weighted_precision, round(r, 9) AS weighted_recall, round({_f2("p", "r")}, 9) AS weighted_fbeta
FROM rates""",
        "score_distribution": f"""WITH {_clean(0)}
SELECT Contract, count(*) AS accounts, min(churn_probability) AS min_score, max(churn_probability) AS max_score,
  round(avg(churn_probability), 9) AS mean_score, quantile_cont(churn_probability, 0.25) AS q1,
  quantile_cont(churn_probability, 0.5) AS median_score, quantile_cont(churn_probability, 0.75) AS q3
FROM clean GROUP BY Contract""",
        "score_histogram": f"""WITH {_clean(0)},
bins AS (SELECT Contract, CAST(least(floor(churn_probability * 20), 19) AS INTEGER) AS bin FROM clean)
SELECT Contract, bin, count(*) AS accounts, bin / CAST(20 AS DOUBLE) AS bin_start FROM bins GROUP BY Contract, bin""",
        "score_density": f"""WITH {_clean(0)},
shapes AS (
SELECT Contract, count(*) AS accounts, stddev_samp(churn_probability) AS s,
  quantile_cont(churn_probability, 0.75) - quantile_cont(churn_probability, 0.25) AS iqr
FROM clean GROUP BY Contract),
widths AS (
SELECT Contract, accounts, CAST(1.059 AS DOUBLE) * CASE WHEN iqr > 0 THEN least(s, iqr / CAST(1.349 AS DOUBLE)) ELSE s END
  * pow(CAST(accounts AS DOUBLE), CAST(-0.2 AS DOUBLE)) AS h FROM shapes),
scores AS (SELECT Contract, churn_probability AS p, count(*) AS n FROM clean GROUP BY 1, 2),
grid AS (SELECT CAST(k AS DOUBLE) / 100 AS score FROM range(0, 101) AS r(k))
SELECT Contract, score, accounts, round(h, 9) AS bandwidth,
  round(sum(n * exp(-pow((score - p) / h, 2) / 2)) / sqrt(2 * pi()) / (accounts * h), 6) AS density
FROM scores JOIN widths USING (Contract), grid GROUP BY Contract, score, accounts, h""",
        "contract_types": f"WITH accounts AS ({ACCOUNT_VIEW_SQL}) SELECT DISTINCT Contract FROM accounts",
        "segment_lift": _segments(0),
        "segment_lift_literal": _segments(1),
        "mutual_information": _mutual_information(),
        "stratified_split_members": f"WITH {_SPLIT} SELECT customerID, Churn, part FROM members",
        "stratified_split_counts": f"WITH {_SPLIT} SELECT part, Churn, count(*) AS accounts FROM members GROUP BY part, Churn",
        "fold_members": f"WITH {_FOLDS} SELECT customerID, Churn, fold FROM members",
        "fold_counts": f"WITH {_FOLDS} SELECT fold, Churn, count(*) AS accounts FROM members GROUP BY fold, Churn",
        "tree_effects": _tree_effects(),
        "stump_scores": f"""WITH {_stumps()}
SELECT customerID, round(1 / (1 + exp(-2 * m3)), 6) AS churn_probability,
  CASE WHEN 1 / (1 + exp(-2 * m3)) >= CAST(0.4 AS DOUBLE) THEN 1 ELSE 0 END AS predicted FROM scored2 WHERE part = 'test'""",
        "stump_effects": _stump_effects(),
        "stump_gains": _stump_gains(),
        "rule_halving": _rule_halving(),
        "stacked_weights": f"""WITH {_stacked(("given", "young", "dear"))}
SELECT 'given' AS score, round(w0, 6) AS weight FROM best UNION ALL SELECT 'young', round(w1, 6) FROM best
UNION ALL SELECT 'dear', round(w2, 6) FROM best""",
        "stacked_scores": f"""WITH {_stacked(("given", "young"))}
SELECT customerID, round(least(greatest({_SCORES["given"]} * w0 + {_SCORES["young"]} * w1, 0), 1), 6) AS churn_probability
FROM clean, best""",
        "ordered_codes": _ordered_codes(),
        "scoring_codes": _scoring_codes(),
        "gbt_checks": _HELD_OUT_CHECKS,
        "challenger_checks": _HELD_OUT_CHECKS,
        "out_of_fold_checks": f"WITH {_FOLDS} SELECT customerID, Churn, fold, {_CHECKS} FROM members",
        "forward_fold_checks": f"WITH {_time_folds(3)} SELECT customerID, Churn, fold, {_CHECKS} FROM placed WHERE fold > 0",
        "time_fold_counts": f"""WITH {_time_folds(5)}
SELECT fold, count(*) AS accounts, min(tenure) AS first_month, max(tenure) AS last_month FROM placed GROUP BY fold""",
        "kaplan_meier": f"""WITH {_LIFE},
steps AS (
SELECT *, CASE WHEN churned < at_risk THEN ln(1 - churned / CAST(at_risk AS DOUBLE)) ELSE 0 END AS step,
  CASE WHEN churned >= at_risk THEN 1 ELSE 0 END AS gone FROM life)
SELECT timeline, contract_type, at_risk, churned,
  round(CASE WHEN max(gone) OVER w = 1 THEN 0 ELSE exp(sum(step) OVER w) END, 9) AS survival_probability
FROM steps WINDOW w AS (PARTITION BY contract_type ORDER BY timeline)""",
        "monthly_hazard": f"""WITH {_LIFE},
hazards AS (SELECT *, churned / CAST(at_risk AS DOUBLE) AS hazard FROM life),
beside AS (
SELECT *, lag(hazard) OVER w AS previous_hazard, lead(hazard) OVER w AS next_hazard
FROM hazards WINDOW w AS (PARTITION BY contract_type ORDER BY timeline))
SELECT contract_type, timeline, at_risk, churned, round(hazard, 9) AS hazard,
  round(previous_hazard, 9) AS previous_hazard, round(next_hazard, 9) AS next_hazard,
  timeline IN (12, 24, 36) AS renewal_month,
  COALESCE(hazard > previous_hazard AND hazard > next_hazard, false) AS spike
FROM beside""",
        "hazard_cliffs": _hazard_cliffs(),
        "concordance": f"WITH {_clean(0)}, scored AS (SELECT *, churn_probability AS p FROM clean), {_PAIRS}",
        "cox_flag_ratio": f"WITH RECURSIVE {_cox_flag()} {_FLAG_RATIO}",
        "cox_paid_months_ratio": f"WITH RECURSIVE {_cox_flag(_PAID_MONTHS)} {_FLAG_RATIO}",
        "cox_paid_months_horizon": f"""WITH RECURSIVE {_cox_flag(_PAID_MONTHS)},
steps AS (
SELECT t, sum((d0 + d1) / (n0 + exp(b) * n1)) OVER (ORDER BY t) AS upto FROM risk, fitted),
asked AS (SELECT customerID, SeniorCitizen, {_PAID_MONTHS} AS paid FROM clean),
ends AS (SELECT *, paid + 12 AS later FROM asked),
first_year AS (SELECT COALESCE(max(upto), 0) AS h FROM steps WHERE t <= 12),
now AS (SELECT e.*, COALESCE(s.upto, 0) AS h0 FROM ends e ASOF LEFT JOIN steps s ON e.paid >= s.t),
next AS (SELECT n.*, COALESCE(s.upto, 0) AS h1 FROM now n ASOF LEFT JOIN steps s ON n.later >= s.t)
SELECT customerID, round(1 - exp(-first_year.h * exp(b * SeniorCitizen)), 6) AS from_start,
  round(1 - exp(-(h1 - h0) * exp(b * SeniorCitizen)), 6) AS from_now
FROM next, first_year, fitted""",
        "cox_flag_horizon": f"""WITH RECURSIVE {_cox_flag()},
steps AS (SELECT t, (d0 + d1) / (n0 + exp(b) * n1) AS step FROM risk, fitted),
tenures AS (SELECT DISTINCT tenure FROM clean),
hazards AS (
SELECT tenure, COALESCE((SELECT sum(step) FROM steps WHERE t <= 12), 0) AS first_year,
  COALESCE((SELECT sum(step) FROM steps WHERE t > tenure AND t <= tenure + 12), 0) AS next_year FROM tenures)
SELECT customerID, tenure, round(1 - exp(-first_year * exp(b * SeniorCitizen)), 6) AS from_start,
  round(1 - exp(-next_year * exp(b * SeniorCitizen)), 6) AS from_tenure
FROM clean JOIN hazards USING (tenure), fitted""",
        "cox_flag_concordance": f"""WITH RECURSIVE {_cox_flag()},
scored AS (SELECT clean.*, b * SeniorCitizen AS p FROM clean, fitted), {_PAIRS}""",
    }
    # other plans for the same results
    for name in CELLED_QUERIES:
        texts[f"{name}_celled"] = texts[name]
    return {**texts, "accounts_round_trip": texts["accounts"]}
