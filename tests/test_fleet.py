"""Tables of vehicle classes meet the traffic where it is."""

from stationflow.operators import emissions


def test_no_shuffle_by_category(spark):
    rows = spark.range(1000).selectExpr("IF(id >= 0, 'A', 'B') AS Category", "IF(id >= 0, 'M', 'N') AS Location", "CAST(NULL AS DOUBLE) AS RoadSlope", "1.0D AS Transits")
    fleet = spark.createDataFrame([("A", "p", 1, 0.25), ("A", "d", 2, 0.75)], "Category string, Fuel string, ID_Euro int, PercvsADT double")
    curves = spark.createDataFrame([("M", "A", "p", 1, None, 2.0), ("M", "A", "d", 2, None, 3.0)], "Location string, Category string, Fuel string, ID_Euro int, RoadSlope double, Alpha double")
    out = emissions.with_coefficients(emissions.with_fleet(rows, fleet), curves)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert {(r.Fuel, r.Transits, r.Alpha, r["count"]) for r in out.groupBy("Fuel", "Transits", "Alpha").count().collect()} == {("p", 0.25, 2.0, 1000), ("d", 0.75, 3.0, 1000)}
