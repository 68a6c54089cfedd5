"""Models of many lots are solved together."""

import numpy as np
import pandas as pd
from stationflow.operators import forecast


def test_lots_of_a_frame_at_once(spark):
    rng = np.random.default_rng(2)
    lots = [f"l{i}" for i in range(7)]
    f = pd.DataFrame([(c, float(a), float(b), i + 2.0 * a - i * b) for i, c in enumerate(lots) for a, b in rng.integers(0, 9, (11, 2))], columns=["station_code", "a", "b", "value"])
    out = forecast.fit_lots(spark.createDataFrame(f).repartition(3), ["a", "b"], ridge=0.0, calendar=False)
    got = {r.station_code: r for r in out.collect()}
    assert sorted(got) == lots
    for i, c in enumerate(lots):
        assert np.allclose(got[c].weights, [i, 2, -i], atol=1e-6) and got[c].deviation < 1e-4
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()
