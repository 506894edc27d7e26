import hashlib

import pytest
from pyspark.sql import functions as F

from holdfast.operators import learn as L
from holdfast.operators.encoding import OrderedTargetEncoder, OrderedTargetModel

COLUMNS = "customerID string, Churn int, a string, b string"


def rows(n=300):
    # one level of b holds nearly all rows; a missing level, a missing label, a repeated key
    out = [(f"k{i}", (i * 7) % 5 // 3, "xyz"[i % 3] if i % 11 else None, "most" if i % 20 else "few") for i in range(n)]
    return out + [("no label", None, "x", "most"), ("k5", 1, "y", "most"), ("k5", 0, "y", "most")]


def brute(data, column, permutations, weight, seed=42):
    """Code of each row, by going through all rows before it."""
    out = []
    for key, _, *levels in data:
        mine, codes = levels[column], []
        for p in range(permutations):
            digest = lambda k: hashlib.md5(f"{seed + p}:{k}".encode()).hexdigest()
            before = [r for r in data if r[1] is not None and digest(r[0]) < digest(key)]
            prior = (sum(r[1] for r in before) + 0.5) / (len(before) + 1)
            alike = [r[1] for r in before if r[2 + column] == mine]
            codes.append((sum(alike) + weight * prior) / (len(alike) + weight))
        out.append((key, sum(codes) / permutations))
    return sorted(out)


@pytest.mark.parametrize("cell", [1000, 25, 3])
def test_codes_come_from_rows_before(spark, cell):
    data = rows()
    df = spark.createDataFrame(data, COLUMNS).repartition(4)
    encoder = OrderedTargetEncoder(inputCols=["a", "b"], outputCols=["ca", "cb"], permutations=2, priorWeight=2.0, rowsPerCell=cell)
    got = encoder.encode_training(df)
    assert got.columns == ["customerID", "Churn", "a", "b", "ca", "cb"]
    found = got.collect()
    for column, name in enumerate(("ca", "cb")):
        mine = sorted((r["customerID"], r[name]) for r in found)
        want = brute(data, column, 2, 2.0)
        assert [k for k, _ in mine] == [k for k, _ in want]
        assert [c for _, c in mine] == pytest.approx([c for _, c in want], abs=1e-12)


def test_tasks_grow_with_rows_and_not_with_cells(spark, monkeypatch):
    df = spark.createDataFrame(rows(), COLUMNS)
    asked, plain = [], type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, n, *c: asked.append(n) or plain(self, n, *c))
    encoder = OrderedTargetEncoder(inputCols=["a"], outputCols=["ca"], permutations=1, rowsPerCell=3)
    assert encoder.encode_training(df).count() == 303
    monkeypatch.setattr("holdfast.operators.encoding._TASK_ROWS", 100)
    assert encoder.encode_training(df).count() == 303
    assert asked == [1, 4]


def test_no_row_sees_its_own_label(spark):
    data = rows(120)
    encoder = OrderedTargetEncoder(inputCols=["a", "b"], outputCols=["ca", "cb"], rowsPerCell=30)
    code = lambda d: {r["customerID"]: (r["ca"], r["cb"]) for r in encoder.encode_training(spark.createDataFrame(d, COLUMNS)).collect()}
    plain = code(data)
    for at in (0, 17, 64):
        changed = [(k, 1 - y if i == at else y, a, b) for i, (k, y, a, b) in enumerate(data)]
        assert code(changed)[data[at][0]] == plain[data[at][0]]


def test_scoring_statistics(spark, tmp_path, monkeypatch):
    data = rows()
    df = spark.createDataFrame(data, COLUMNS)
    encoder = OrderedTargetEncoder(inputCols=["a"], outputCols=["ca"])
    model = encoder.fit(df)
    known = [(y, a) for _, y, a, _ in data if y is not None]
    prior = (sum(y for y, _ in known) + 0.5) / (len(known) + 1)
    want = {a: (sum(y for y, v in known if v == a) + prior) / (sum(v == a for _, v in known) + 1) for _, a in known}
    want["new"] = prior
    ask = spark.createDataFrame([("1", "x"), ("2", None), ("3", "new")], "customerID string, a string")
    for limit in (100_000, 0):  # levels broadcast, and joined by key
        monkeypatch.setattr("holdfast.operators.encoding._BROADCAST_LEVELS", limit)
        assert {r["a"]: r["ca"] for r in model.transform(ask).collect()} == pytest.approx({k: want[k] for k in ("x", None, "new")})
    model.keep_levels(str(tmp_path / "levels")).write().overwrite().save(str(tmp_path / "model"))
    again = OrderedTargetModel.load(str(tmp_path / "model"))
    assert {r["a"]: r["ca"] for r in again.transform(ask).collect()} == pytest.approx({k: want[k] for k in ("x", None, "new")})


def test_empty_training_table(spark):
    none = spark.createDataFrame([], COLUMNS)
    encoder = OrderedTargetEncoder(inputCols=["a"], outputCols=["ca"])
    assert encoder.encode_training(none).count() == 0
    ask = spark.createDataFrame([("1", "x")], "customerID string, a string")
    assert encoder.fit(none).transform(ask).first()["ca"] == 0.5


def test_challenger_is_saved_with_its_levels(spark, tmp_path):
    df = spark.createDataFrame(rows(), COLUMNS).where("Churn IS NOT NULL").selectExpr("customerID", "Churn", "a AS Contract", "length(customerID) AS tenure")
    model = L.ChallengerChurnModel(trees=3, depth=2).fit(df)
    model.save(str(tmp_path / "m"))
    again = L.ChallengerChurnModel().load(str(tmp_path / "m"))
    p = lambda m: sorted(tuple(r) for r in m.predict_proba(df).select("customerID", F.round("churn_probability", 9)).collect())
    assert p(model) == p(again)
