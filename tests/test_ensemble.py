"""An ensemble's predictions from one reading of the rows."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from stationflow.operators import forecast


def test_all_models_at_once(spark):
    rng = np.random.default_rng(3)
    f = pd.DataFrame({"station_code": np.where(np.arange(300) % 2, "a", "b"), "ts": pd.date_range("2024-01-01", periods=300, freq="h"), "lag_1": rng.random(300), "x": rng.random(300)})
    f["value"] = 3 * f["x"] + rng.random(300)
    rows = spark.createDataFrame(f)
    models = forecast.fit_ensemble(rows, ["lag_1", "x"], 3, (), iterations=2)
    out = forecast.ensemble_direct(models, rows, (1,))
    single = [forecast.forecast_direct(m, rows, (1,)) for m in models]
    want = single[0].unionByName(single[1]).unionByName(single[2])
    tidy = lambda df: sorted(tuple(r) for r in df.select("station_code", F.unix_seconds("ts"), F.round("value", 9)).collect())
    assert tidy(out) == tidy(want) and len(models) == 3
    assert len({id(m.stages[0]) for m in models}) == 1
