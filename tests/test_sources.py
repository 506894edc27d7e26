import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from holdfast.schema import ACCOUNT_COLUMNS
from holdfast.sources import (
    MissingColumnsError,
    accounts_from_orders,
    frame_shape,
    read_accounts,
    target_distribution,
    validate_schema,
    write_features,
    write_report,
)


@pytest.fixture(scope="module")
def csv_path(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "accounts")
    writer = accounts_from_orders(spark, sf).write.option("header", True)
    writer.option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(path)
    return path


def test_csv_with_extra_column(spark, sf, csv_path):
    df = read_accounts(spark, csv_path)
    assert df.columns == [*ACCOUNT_COLUMNS, "churn_probability"]
    assert dict(df.dtypes)["TotalCharges"] == "string" and dict(df.dtypes)["tenure"] == "int"
    want = accounts_from_orders(spark, sf).select(ACCOUNT_COLUMNS)
    got = df.select(ACCOUNT_COLUMNS)
    assert frame_shape(got) == (1500, 21)
    # blank charges survive as text
    assert got.where(F.trim("TotalCharges") == "").count() == want.where("TotalCharges = ' '").count()


def test_reordered_columns(spark, sf, tmp_path):
    path = str(tmp_path / "r")
    back = accounts_from_orders(spark, sf).select(*reversed(ACCOUNT_COLUMNS))
    back.write.option("header", True).csv(path)
    assert read_accounts(spark, path).where("tenure > 72").count() == 135


def test_nan_is_missing(spark, sf, tmp_path):
    path = str(tmp_path / "nan")
    accounts_from_orders(spark, sf).withColumn("MonthlyCharges", F.lit(float("nan"))).write.parquet(path)
    assert read_accounts(spark, path, "parquet").where("MonthlyCharges IS NULL").count() == 1500


def test_missing_path_is_named(spark):
    with pytest.raises(AnalysisException, match="no-such-accounts"):
        read_accounts(spark, "/tmp/no-such-accounts.csv")


def test_missing_columns(spark, csv_path):
    df = read_accounts(spark, csv_path)
    with pytest.raises(MissingColumnsError) as error:
        validate_schema(df.drop("Churn", "tenure"))
    assert error.value.missing == {"Churn", "tenure"}


def test_parquet_source_and_sink(spark, sf, tmp_path):
    path = str(tmp_path / "features")
    df = accounts_from_orders(spark, sf)
    write_features(df, path, ["Contract"])
    again = read_accounts(spark, path, "parquet")
    assert again.count() == 1500
    plan = again.where("Contract = 'One year'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Contract" in plan


def test_report_keeps_its_order(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(spark.range(1000), path, [F.desc("id")])
    files = sorted(p for p in (tmp_path / "report").iterdir() if p.suffix == ".csv")
    ids = [int(x) for f in files for x in f.read_text().split() if x != "id"]
    assert ids == list(range(999, -1, -1))


def test_report_text_round_trip(spark, tmp_path):
    path = str(tmp_path / "text")
    texts = [' padded ', 'a "quoted", word', "plain"]
    write_report(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, i int"), path, ["i"])
    lines = "".join(f.read_text() for f in sorted((tmp_path / "text").glob("*.csv")))
    import csv
    import io

    assert [r[0] for r in csv.reader(io.StringIO(lines)) if r[0] != "t"] == texts


def test_target_distribution(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("No",), (None,)], "Churn string")
    got = {r["Churn"]: r["share"] for r in target_distribution(df).collect()}
    assert got == {"Yes": 0.333, "No": 0.667}
