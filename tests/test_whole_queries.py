"""Queries that do their whole job."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from stationflow.plans import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


def test_ratios_of_all_stations(spark):
    assert {r.k for r in QUERIES["lane_ratio_stats"](spark, SF).select((F.col("station") % 3).cast("int").alias("k")).distinct().collect()} == {0, 1, 2}


def test_every_event_is_resampled(spark):
    e = pd.read_parquet(f"{SF}/events.parquet")
    e = e[e.event_type == "view"].groupby("ts", as_index=False)["value"].mean().sort_values("ts")
    step = 300
    at = pd.date_range(e.ts.min().floor("300s"), e.ts.max(), freq=f"{step}s").astype(e.ts.dtype)
    want = pd.merge_asof(pd.DataFrame({"ts": at}), e, on="ts", direction="nearest")
    got = QUERIES["resample_nearest"](spark, SF).where("station_code = 'view'").orderBy("ts").toPandas()
    assert len(got) == len(want) and np.allclose(got["value"], want["value"], atol=1e-6)
