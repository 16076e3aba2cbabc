"""Hand-worked fixtures (FIXTURES.md section 3) as small DataFrames."""

WEIGHTED = [  # year_month, basin, division, weighted_fcst
    ("2021-01", "B1", "D1", 100.0), ("2021-02", "B1", "D1", 50.0),
    ("2021-01", "ELIM", "D1", -30.0), ("2021-01", "B1", "N/A", 575.0),
    ("2021-04", "B1", "D1", None), ("2021-01", None, "D1", 999.0),
]
RIG = [  # year_month, basin, environment, rig_count, rig_total, scenario
    ("2021-01", "B1", "LAND", 10, 10, "EXCL"), ("2021-02", "B1", "LAND", 20, 20, "EXCL"),
    ("2021-01", "B1", "LAND", 30, 30, "ALL"), ("2021-01", "ELIM", "LAND", 5, 5, "ALL"),
    ("2021-04", "B1", "LAND", 7, 7, "EXCL"), ("2021-04", "B1", "LAND", 9, 9, "ALL"),
]
ACTUALS = [  # year_month, basin, division, total, scenario
    ("2021-01", "B1", "D1", 40.0, "CM"), ("2021-01", "B1", "D1", 100.0, "REV"),
    ("2021-04", "B1", "D1", 0.0, "CM"), ("2021-04", "B1", "D1", 50.0, "REV"),
    ("2021-01", "BRZ", "OTH", 5.0, "REV"), ("2021-01", "ELIM", "D1", -10.0, "REV"),
]


def frames(spark):
    w = spark.createDataFrame(WEIGHTED, "year_month string, basin string, division string, "
                                        "weighted_fcst double")
    r = spark.createDataFrame(RIG, "year_month string, basin string, environment string, "
                                   "rig_count bigint, rig_total bigint, scenario string")
    a = spark.createDataFrame(ACTUALS, "year_month string, basin string, division string, "
                                       "total double, scenario string")
    return w, r, a


PANEL_SCHEMA = ("quarter string, series string, weighted_fcst double, rig_ex_china double, "
                "rig_all double, cm double, rev double")


def two_series_panel(spark):
    """Two series x six quarters; series B misses 2021Q3 (row-based lags)."""
    rows = []
    quarters = ["2021Q1", "2021Q2", "2021Q3", "2021Q4", "2022Q1", "2022Q2"]
    for i, q in enumerate(quarters):
        rows.append((q, "A-D1", 10.0 + i, 100.0 + i, 200.0 + i, 5.0 + i, 50.0 + i))
        if q != "2021Q3":
            rows.append((q, "B-N/A", 20.0 + i, 300.0 + i, 400.0 + i,
                         None if q == "2021Q2" else 7.0 + i, 70.0 + i))
    panel = spark.createDataFrame(rows, PANEL_SCHEMA)
    oil = spark.createDataFrame([(q, 60.0 + i, 55.0 + i) for i, q in enumerate(quarters)],
                                "quarter string, brent double, wti double")
    return panel, oil
