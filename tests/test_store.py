from pyspark.sql import functions as F

from panelcast.sources import store


def snap(spark, refresh, value):
    return spark.createDataFrame(
        [("2021Q1", "S", value, value, "M", None, None, None, None, "Jan'21", refresh, "S")],
        store.SNAPSHOT_SCHEMA)


def test_append_is_idempotent_per_refresh(spark, scratch):
    path = f"{scratch}/snap"
    assert store.read_snapshots(spark, path).count() == 0          # missing -> empty
    store.append_snapshot(snap(spark, "2021Q1", 1.0), path)
    store.append_snapshot(snap(spark, "2021Q2", 2.0), path)
    store.append_snapshot(snap(spark, "2021Q2", 3.0), path)        # rerun replaces
    rows = sorted((r.refresh_date, r.rev) for r in store.read_snapshots(spark, path).collect())
    assert rows == [("2021Q1", 1.0), ("2021Q2", 3.0)]
    assert [r.rev for r in store.latest_snapshot(spark, path).collect()] == [3.0]
    assert [r.rev for r in store.earliest_snapshot(spark, path).collect()] == [1.0]
    assert store.history_before(spark, path, "2021Q2").count() == 1


def test_rerun_with_fewer_models_leaves_none_behind(spark, scratch):
    path = f"{scratch}/snap"
    both = snap(spark, "2021Q1", 1.0).unionByName(snap(spark, "2021Q1", 5.0).withColumn("model", F.lit("N")))
    store.append_snapshot(both, path)
    store.append_snapshot(snap(spark, "2021Q1", 2.0), path)
    assert [(r.model, r.rev) for r in store.read_snapshots(spark, path).collect()] == [("M", 2.0)]


def test_history_comes_from_before_the_origin(spark, scratch):
    path = f"{scratch}/snap"
    for refresh, value in (("2021Q2", 2.0), ("2021Q3", 3.0), ("2022Q1", 9.0)):
        store.append_snapshot(snap(spark, refresh, value), path)
    assert [r.rev for r in store.history_before(spark, path, "2021Q4").collect()] == [3.0]
    assert store.history_before(spark, path, "2021Q2").count() == 0


def test_table_modes_and_csv(spark, scratch):
    df = spark.createDataFrame([("B1", "N/A", 1.0)], "basin string, division string, v double")
    store.write_table(df, f"{scratch}/t", "fail")
    store.write_table(df, f"{scratch}/t", "append")
    assert spark.read.parquet(f"{scratch}/t").count() == 2
    store.write_table(df, f"{scratch}/t", "replace")
    assert spark.read.parquet(f"{scratch}/t").count() == 1
    try:
        store.write_table(df, f"{scratch}/t", "fail")
        raise AssertionError("fail mode must refuse an existing table")
    except Exception as e:  # AnalysisException
        assert "already exists" in str(e).lower() or "exist" in str(e).lower()
    store.export_csv(df.unionByName(df.withColumn("basin", df.basin.substr(1, 1))),
                     f"{scratch}/csv", sort_by=["basin", "division"])
    back = spark.read.option("header", True).csv(f"{scratch}/csv").collect()
    assert {r.division for r in back} == {"N/A"}


def test_coefficients_round_trip(spark, scratch):
    coefs = spark.createDataFrame([("2021Q1", "S", [1.0, 2.0])],
                                  "origin string, series string, beta array<double>")
    store.save_coefficients(coefs, f"{scratch}/coef", "ADDITIVE", "rev")
    got = store.load_coefficients(spark, f"{scratch}/coef", "ADDITIVE", "rev", "2021Q1")
    assert got.first().beta == [1.0, 2.0]
    assert store.load_coefficients(spark, f"{scratch}/coef", "ADDITIVE", "cm").count() == 0
    assert store.load_coefficients(spark, f"{scratch}/none", "X", "rev").count() == 0
