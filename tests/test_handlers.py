"""Handlers get whole slices, many of them from one frame of Spark's."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from stationflow.operators import incremental


@pytest.fixture
def small_frames(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("many", [False, True])
def test_slices_are_whole(spark, small_frames, many):
    rng = np.random.default_rng(1)
    rows = [(f"s{i % 4}" if i % 9 else None, "ab"[i % 2], (pd.Timestamp("2024-01-01") + pd.Timedelta(hours=int(h))).to_pydatetime(), float(i)) for i, h in enumerate(rng.integers(0, 480, 120))]
    m = spark.createDataFrame(rows, "station_code string, type_name string, ts timestamp, value double")

    def each(r: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"station_code": [r.station_code.iloc[0]], "type_name": [r.type_name.iloc[0]], "rows": [len(r)], "total": [r["value"].sum()]})

    def all_(r: pd.DataFrame) -> pd.DataFrame:
        return r.groupby(["station_code", "type_name", "_slice"], dropna=False).agg(rows=("ts", "size"), total=("value", "sum")).reset_index().drop(columns="_slice")

    out = incremental.follow_type(m, all_ if many else each, "station_code string, type_name string, rows long, total double", many=many)
    want = m.groupBy("station_code", "type_name", F.floor(F.unix_seconds("ts") / 432000)).agg(F.count("ts").alias("rows"), F.sum("value").alias("total"))
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.select("station_code", "type_name", "rows", "total").collect()))
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()
