"""Validation of traffic and of observations: history statistics, z-scores, runs of zeros, stuck sensors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lane_direction, station_km
from ..sources import held
from .grids import gap_s, seconds
from .moments import average, combined, deviation, moments
from .scans import least_of_run, runs, within


def eligible_traffic_stations(stations: DataFrame) -> DataFrame:
    """P10: traffic stations with a positive km, of sensor type induction_loop or camera, not of origin FAMAS-traffic."""
    kind = F.get_json_object("metadata", "$.sensor_type")
    return stations.withColumn("km", station_km(F.col("metadata"))).where((F.col("km") > 0) & kind.isin("induction_loop", "camera") & (F.coalesce("origin", F.lit("")) != "FAMAS-traffic"))


def day_type(df: DataFrame, holidays: DataFrame, day: str = "date") -> DataFrame:
    """Festivo on weekends and holidays (date, a calendar: broadcast, so that rows aren't shuffled to their date), else Feriale."""
    h = F.broadcast(holidays.select(F.col("date").alias("_h")).distinct())
    off = F.col("_h").isNotNull() | (F.weekday(day) >= 5)
    return df.join(h, df[day] == h["_h"], "left").withColumn("day_type", F.when(off, "Festivo").otherwise("Feriale")).drop("_h")


def nearest_by_km(stations: DataFrame, n: int, probes: DataFrame | None = None, by: Sequence[str] = (), order: str = "station_code", itself: bool = False) -> DataFrame:
    """For each probe the n stations nearest by km (itself left out unless asked for), equals by order, with their rank.

    Per group (by) both sides are put in one sequence by km: the n nearest are among the n before and the n after a
    probe, so frames of that width take the place of a self-join.
    """
    a = stations.select(*by, F.col(order).alias("code"), "km", F.lit(False).alias("probe"))
    b = (probes if probes is not None else stations).select(*by, F.col(order).alias("code"), "km", F.lit(True).alias("probe"))
    both = a.unionByName(b)
    w = Window.partitionBy(*by).orderBy("km", "code", "probe")
    # a probe's own station may be among the neighbours, and so may other probes: twice the width has n stations for sure
    width = n + 1
    ranked = both.withColumn("station_no", F.sum(F.when(F.col("probe"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    places = ranked.where("NOT probe").select(*by, F.col("code").alias("near_code"), F.col("km").alias("near_km"), F.col("station_no"))
    reach = ranked.where("probe").select(*by, "code", "km", F.explode(F.sequence(F.col("station_no") - width, F.col("station_no") + width + 1)).alias("station_no"))
    near = reach.join(places, [*by, "station_no"])
    near = (near if itself else near.where("near_code <> code")).withColumn("distance", F.abs(F.col("near_km") - F.col("km")))
    rank = F.row_number().over(Window.partitionBy(*by, "code").orderBy("distance", "near_code"))
    return near.withColumn("rank", rank).where(F.col("rank") <= n).select(*by, F.col("code").alias(order), "near_code", "distance", "rank")


DAY = ("month", "day_type")  # days are compared with history of their month and type


def lane_days(history: DataFrame) -> DataFrame:
    """History (station, lane, date, day_type, total_traffic) as one row for each lane and date: v (sum), rows, n (rows with a value), month."""
    days = history.groupBy("station", "lane", "date", "day_type").agg(F.sum("total_traffic").alias("v"), F.count(F.lit(1)).alias("rows"), F.count("total_traffic").alias("n"))
    return days.withColumn("month", F.month("date"))


def lane_history(history: DataFrame, wanted: DataFrame, n: int, least: int = 10, places: DataFrame | None = None) -> DataFrame:
    """Daily values of the lanes that each wanted station, direction, month and day type is compared with, and whether they are borrowed.

    history: station, lane, date, day_type, total_traffic; wanted: station, km, direction, month, day_type; places:
    station, km of all stations that may lend their history (those wanted by default). The rows of a station are
    counted within the month and day type, over all of its lanes. With fewer than `least` of them, the values are means
    over the 2 n nearest places with history of that month and day type, itself too if it has any; without km there are
    none. Lanes are 1 and 2 of the one direction, 3 and 4 of the other.
    """
    days = lane_days(history)
    rows = days.groupBy("station", *DAY).agg(F.sum("rows").alias("rows"))
    wanted = wanted.join(rows, ["station", *DAY], "left")
    key = ["station", "direction", *DAY]
    own = _lanes(days).join(wanted.where(F.col("rows") >= least).select(*key), key).select(*key, "date", "lane", "v", "n")
    far = _lent(days, rows, wanted.where(F.coalesce("rows", F.lit(0)) < least), n, wanted if places is None else places)
    # what a station is compared with comes together once, and is grouped there by lane, by date and as a whole
    both = own.withColumn("borrowed", F.lit(False)).unionByName(far.withColumn("borrowed", F.lit(True))).repartition("station", *DAY)
    each = both.groupBy(*key, "borrowed", "date", "lane").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).withColumn("mean_v", F.try_divide("v", "n"))
    return each.select(*key, "date", "lane", F.when(F.col("borrowed"), F.col("mean_v")).otherwise(F.col("v")).alias("v"), "mean_v", "borrowed")


def _lanes(days: DataFrame) -> DataFrame:
    return days.where(F.col("lane").cast("int").between(1, 4)).withColumn("direction", lane_direction(F.col("lane")))


def _lent(days: DataFrame, rows: DataFrame, short: DataFrame, n: int, places: DataFrame) -> DataFrame:
    """The lane days (date, lane, v, n) of the 2 n nearest places with any, for each station with too little history (short)."""
    key = ["station", "direction", *DAY]
    short = short.where("km IS NOT NULL").select(*key, "km")
    known = rows.select("station", *DAY).join(places.where("km IS NOT NULL").select("station", "km").distinct(), "station").select("station", "km", *DAY)
    near = nearest_by_km(known, 2 * n, short.select("station", "km", *DAY).distinct(), by=DAY, order="station", itself=True).select(*DAY, "station", F.col("near_code").alias("near"))
    # days are lent to both directions at once, so that they aren't shuffled again to be told apart
    asked = near.join(short.groupBy("station", *DAY).agg(F.collect_set("direction").alias("directions")), ["station", *DAY])
    far = _lanes(days).withColumnRenamed("station", "near").join(asked, ["near", *DAY])
    return far.where(F.array_contains("directions", F.col("direction"))).select(*key, "date", "lane", "v", "n")


def borrowed(days: DataFrame, rows: DataFrame, short: DataFrame, n: int, places: DataFrame) -> DataFrame:
    """Daily lane values (v, mean_v) of stations with too little history (short): means over the rows of the 2 n nearest places with any."""
    far = _lent(days, rows, short, n, places).repartition("station", *DAY)
    return far.groupBy("station", "direction", *DAY, "date", "lane").agg(F.try_divide(F.sum("v"), F.sum("n")).alias("v")).withColumn("mean_v", F.col("v"))


def history_stats(lanes: DataFrame) -> DataFrame:
    """Mean and sample deviation of the daily totals of lane_history()."""
    key = ["station", "direction", *DAY, "borrowed"]
    total = lanes.groupBy(*key, "date").agg(F.sum("v").alias("total"))
    return total.groupBy(*key).agg(F.avg("total").alias("mean"), F.stddev_samp("total").alias("std"), F.count(F.lit(1)).alias("days"))


def neighbour_stats(daily: DataFrame, places: DataFrame, n: int) -> DataFrame:
    """Mean and population deviation of the daily totals of the first 2 n stations by distance in each direction, less the station itself.

    daily: station, direction, date, total_traffic. Neighbours are the stations with a place (station, km) that have
    traffic in the direction on the date, so that a day's figures don't depend on other days.
    """
    by = ["direction", "date"]
    there = daily.join(places.where("km IS NOT NULL").select("station", "km").distinct(), "station")
    near = nearest_by_km(there.select("station", "km", *by), max(2 * n - 1, 1), by=by, order="station").select(*by, "station", F.col("near_code").alias("near"))
    values = daily.select(*by, F.col("station").alias("near"), F.col("total_traffic").alias("v"))
    return near.join(values, [*by, "near"]).groupBy("station", *by).agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def lane_ratio_stats(lanes: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Mean and sample deviation of the ratio of a direction's two lanes on the days of lane_history(); directions
    with one lane have no row, and those where a ratio has no divisor have none either. Lanes are numbers below 64."""
    key = ["station", "direction", *by]
    day = lanes.withColumn("bit", F.expr("shiftleft(1L, CAST(lane AS INT))")).groupBy(*key, "date")
    wide = day.agg(F.min("lane").alias("lo"), F.max("lane").alias("hi"), F.bit_or("bit").alias("seen"), F.min_by("mean_v", "lane").alias("a"), F.max_by("mean_v", "lane").alias("b"))
    # with two lanes in all, the higher one of a day with both is the second; a day may have the second alone
    each = wide.withColumns({"r": F.when(F.col("lo") < F.col("hi"), F.try_divide("a", "b")), "zero": F.when(F.col("b") == 0, F.col("hi"))}).groupBy(*key)
    out = each.agg(F.avg("r").alias("mean"), F.stddev_samp("r").alias("std"), F.max("hi").alias("second"), F.max("zero").alias("zero"), F.bit_or("seen").alias("seen"))
    return out.where((F.bit_count("seen") == 2) & ~F.coalesce(F.col("zero") == F.col("second"), F.lit(False))).drop("second", "zero", "seen")


def direction_stats(daily: DataFrame) -> DataFrame:
    """Mean and population deviation of the daily totals of each direction and date."""
    return daily.groupBy("direction", "date").agg(F.avg("total_traffic").alias("mean"), F.stddev_pop("total_traffic").alias("std"))


def zscore(value: Column, mean: Column, std: Column, known: Column | None = None) -> Column:
    """Unknown (NULL) where the deviation is 0 or missing; with known, a missing one gives NaN wherever known holds."""
    z = F.try_divide(value - mean, std)
    return z if known is None else F.when(known & (mean.isNull() | std.isNull()), F.lit(float("nan"))).otherwise(z)


def zflag(z: Column, low: float | None, high: float | None) -> Column:
    """Whether z is within the bounds (None: open); unknown z stay NULL, NaN is false."""
    inside = F.lit(True)
    if low is not None:
        inside = inside & (z >= low)
    if high is not None:
        inside = inside & (z <= high)
    return F.when(z.isNull(), F.lit(None).cast("boolean")).otherwise(~F.isnan(z) & inside)


def layer3(series: DataFrame, key: Sequence[str] = ("station", "direction")) -> DataFrame:
    """is_valid of each row of time, value: no fall of 99 % or more from 50 or more, and in no run of four zeros."""
    w = Window.partitionBy(*key).orderBy("time")
    before = F.lag("value").over(w)
    change = F.try_divide(F.col("value") - before, before) * 100
    fell = F.coalesce((change <= -99) & (before >= 50), F.lit(False))
    zeros = F.lit(False)
    for a, b in ((-3, 0), (-2, 1), (-1, 2), (0, 3)):
        f = w.rowsBetween(a, b)
        zeros = zeros | F.coalesce((F.count("value").over(f) == 4) & (F.sum("value").over(f) == 0), F.lit(False))
    return series.withColumn("is_valid", ~(fell | zeros))


def overall_validity(layer_1: Column, layer_1_1: Column, layer_3: Column) -> Column:
    """1, 0, or 999 if unknown: layer 1 or else layer 1.1 has to hold, and layer 3 decides where none of them failed."""
    first = F.when(layer_1, 1).when(~layer_1, F.when(layer_1_1, 1).otherwise(0)).otherwise(999)
    return F.when(first == 0, 0).otherwise(F.when(layer_3, 1).when(~layer_3, 0).otherwise(first))


# Bounds of the z-scores and neighbours of each layer.
LIMITS = {"layer1": (-2.5, None, 3), "layer1_1": (-2.0, None, 2), "layer2": (-5.0, 5.0, 4)}


def common_dates(history: DataFrame, traffic: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dates that both have, and a report of those that one lacks (date, missing_in)."""
    a, b = history.select("date").distinct(), traffic.select("date").distinct()
    report = a.join(b, "date", "left_anti").withColumn("missing_in", F.lit("traffic")).unionByName(b.join(a, "date", "left_anti").withColumn("missing_in", F.lit("history")))
    return a.join(b, "date"), report


class History:
    """What validation knows of the past: days (lane_days() of history) and the moments of its totals and lane ratios.

    moments: for each station, direction, month and day type total_n/mean/m2 of the daily totals, ratio_n/mean/m2 of the
    ratio of the direction's two lanes, and how many days have each lane (first, second) or a ratio without a divisor
    (bad). counts: the rows of each station, month and day type, over all lanes.

    Each of the three is a table in the shared folder (held()), so that what follows reads it and doesn't compute the
    history's past again within the same tasks.
    """

    KEY = ("station", "direction", *DAY)

    def __init__(self, days: DataFrame, moments_: DataFrame, counts: DataFrame):
        self.days, self.moments, self.counts = days, moments_, counts

    @classmethod
    def of(cls, history: DataFrame, holidays: DataFrame) -> History:
        """From all of history (station, lane, date, total_traffic)."""
        days = held(lane_days(day_type(history, holidays)), "lane-days")
        moments_, counts = cls._summed(days)
        return cls(days, held(moments_, "moments"), held(counts, "counts"))

    @classmethod
    def _summed(cls, days: DataFrame) -> tuple[DataFrame, DataFrame]:
        first = F.col("lane").cast("int").isin(1, 3)
        mean = F.try_divide("v", "n")
        each = _lanes(days).groupBy(*cls.KEY, "date").agg(F.sum("v").alias("total"), F.max(F.when(first, mean)).alias("a"), F.max(F.when(~first, mean)).alias("b"), F.max(first).alias("has_a"), F.max(~first).alias("has_b"))
        each = each.withColumn("ratio", F.try_divide("a", "b"))
        counted = [F.count(F.lit(1)).alias("days"), F.count_if("has_a").alias("first"), F.count_if("has_b").alias("second"), F.count_if(F.col("b") == 0).alias("bad")]
        return each.groupBy(*cls.KEY).agg(*moments("total", "total"), *moments("ratio", "ratio"), *counted), days.groupBy("station", *DAY).agg(F.sum("rows").alias("rows"))

    def updated(self, history: DataFrame, holidays: DataFrame) -> History:
        """With more history. A station's date that was there already is replaced, so that a day can be sent again.

        Only the days of the new history, and those that they replace, are read; all other days stay in the moments.
        """
        new = held(lane_days(day_type(history, holidays)), "new-days")
        sent = new.select("station", "date").distinct()
        gone = held(self.days.join(sent, ["station", "date"], "left_semi"), "gone-days")
        now = [self.moments, self.counts]
        for days, sign in ((gone, -1), (new, 1)):
            m, c = (held(t, name) for t, name in zip(self._summed(days), ("moments", "counts")))
            now = [combined(now[0], m, self.KEY, ("total", "ratio"), ("days", "first", "second", "bad"), sign), combined(now[1], c, ("station", *DAY), (), ("rows",), sign)]
        now = [held(t, name) for t, name in zip(now, ("moments", "counts"))]
        return History(held(self.days.join(sent, ["station", "date"], "left_anti").unionByName(new), "lane-days"), *now)

    def compared(self, wanted: DataFrame, places: DataFrame, n: int, least: int) -> DataFrame:
        """A19, A21 of wanted (station, km, direction, month, day_type): m1, s1 of totals, m2, s2 of ratios, two (whether there are ratios), skipped.

        Stations with at least `least` rows of the month and type read their moments alone; of the days, only those
        are read that others borrow.
        """
        wanted = wanted.join(self.counts, ["station", *DAY], "left").withColumn("enough", F.coalesce(F.col("rows") >= least, F.lit(False)))
        far = borrowed(self.days, self.counts, wanted.where("NOT enough"), n, places)
        lent, _ = self._summed(far.withColumns({"n": F.when(F.col("v").isNotNull(), 1), "rows": F.lit(1)}))
        known = wanted.where("enough").select(*self.KEY).join(self.moments, list(self.KEY)).unionByName(lent)
        two = (F.col("first") > 0) & (F.col("second") > 0) & (F.col("bad") == 0)
        stats = known.select(*self.KEY, average("total").alias("m1"), deviation("total").alias("s1"), F.when(two, average("ratio")).alias("m2"), F.when(two, deviation("ratio")).alias("s2"), F.when(two, True).alias("two"))
        return wanted.select(*self.KEY, (F.col("km").isNull() & ~F.col("enough")).alias("skipped")).join(stats, list(self.KEY), "left")


def traffic_layers(traffic: DataFrame, history: History, places: DataFrame, holidays: DataFrame, limits: dict = LIMITS, least: int = 10) -> DataFrame:
    """layer_1, layer_1_1 and layer_2 (true, false or unknown) of each station, direction and date of traffic that history has too.

    traffic: station, lane, direction, date, value; places: station, km of all stations. Layers 1 and 2 compare with
    history of the day's month and type, layer 1.1 with near stations of the same day. A mean or deviation that can't
    be told fails; a deviation of 0 is unknown, and so are the first two layers of a station with little history and no
    km.
    """
    traffic = traffic.join(common_dates(history.days, traffic)[0], "date")
    daily = day_type(traffic.groupBy("station", "direction", "date").agg(F.sum("value").alias("total_traffic")), holidays).withColumn("month", F.month("date"))
    places, day = places.select("station", "km"), ["station", "direction", "date"]
    wanted = daily.select(*History.KEY).distinct().join(places, "station", "left")
    stats = history.compared(wanted, places, limits["layer1"][2], least)
    near = neighbour_stats(daily, places, limits["layer1_1"][2]).select(*day, F.col("mean").alias("m11"), F.col("std").alias("s11"))
    lane = traffic.groupBy(*day, "lane").agg(F.sum("value").alias("v"))
    ratio = lane.groupBy(*day).agg(F.try_divide(F.min_by("v", "lane"), F.max_by("v", "lane")).alias("r"), F.count(F.lit(1)).alias("n")).select(*day, F.when(F.col("n") == 2, F.col("r")).alias("ratio"))
    both = daily.join(stats, list(History.KEY)).join(near, day, "left").join(ratio, day, "left")
    v, on = F.col("total_traffic").cast("double"), ~F.col("skipped")
    flag = lambda layer, z: F.when(on, zflag(z, *limits[layer][:2]))
    return both.select(
        *day,
        flag("layer1", zscore(v, F.col("m1"), F.col("s1"), F.lit(True))).alias("layer_1"),
        flag("layer1_1", zscore(v, F.col("m11"), F.col("s11"))).alias("layer_1_1"),
        flag("layer2", zscore(F.col("ratio"), F.col("m2"), F.col("s2"), F.col("two") & F.col("ratio").isNotNull())).alias("layer_2"),
    )


def validate_traffic(traffic: DataFrame, history: DataFrame | History, places: DataFrame, holidays: DataFrame, limits: dict = LIMITS, history_shift_days: int = 1, least: int = 10) -> DataFrame:
    """Time, station, lane, value, the flag of each layer and is_valid of traffic rows (station, lane, time, value).

    Only dates that history has too are validated. history: station, lane, date (stamped history_shift_days after the
    day it is of), total_traffic; or a History, whose dates are those of the days themselves. places: station, km of
    all stations. layer_2 is reported and doesn't decide.
    """
    traffic = traffic.withColumns({"direction": lane_direction(F.col("lane")), "date": F.to_date("time")})
    if not isinstance(history, History):
        # days are compared with history of their month, so that of other months needn't be looked at
        months = F.broadcast(traffic.select(F.month("date").alias("_month")).distinct())  # twelve rows at most
        history = history.withColumn("date", F.date_sub("date", history_shift_days))
        history = History.of(history.join(months, F.month("date") == F.col("_month"), "left_semi"), holidays)
    layers = traffic_layers(traffic, history, places, holidays, limits, least)
    three = layer3(traffic.groupBy("station", "direction", "time").agg(F.sum("value").alias("value")), ["station", "direction"]).select("station", "direction", "time", F.col("is_valid").alias("layer_3"))
    out = traffic.join(layers, ["station", "direction", "date"]).join(three, ["station", "direction", "time"], "left")
    return out.select("time", "station", "lane", "value", "layer_1", "layer_1_1", "layer_2", "layer_3", overall_validity(F.col("layer_1"), F.col("layer_1_1"), F.col("layer_3")).alias("is_valid"))


def null_stuck(m: DataFrame, least: int = 6, first_hour: int = 6, key: Sequence[str] = ("station_code",), value: str = "value", bucket_s: int | None = None) -> DataFrame:
    """Runs of at least `least` equal values that reach past 05:59 become NULL, from least - 1 rows before the first such row to the end."""
    out = runs(m, key, value, bucket_s)
    out = least_of_run(out, key, F.when((F.hour("ts") >= first_hour) & (F.col("_at") >= least), F.col("_at")), "_hit", bucket_s)
    return out.withColumn(value, F.when(F.col("_hit").isNotNull() & (F.col("_at") > F.col("_hit") - least), F.lit(None)).otherwise(F.col(value))).drop("_run", "_bucket", "_len", "_at", "_hit")


def fill_stuck(m: DataFrame, least: int = 12, per_hour: int = 1, key: Sequence[str] = ("station_code",), value: str = "value", bucket_s: int | None = None) -> DataFrame:
    """Values of runs of at least `least` equal ones become those of a week before (if above 0), else of a day before, else NULL.

    Donors are the values as they came: rows that were themselves replaced don't chain.
    """
    day = 24 * per_hour
    lags = {"_week": lambda w: F.lag(value, 7 * day).over(w), "_day": lambda w: F.lag(value, day).over(w)}
    out = within(runs(m, key, value, bucket_s).drop("_bucket"), key, 7 * day, lags, bucket_s=bucket_s)
    donor = F.when(F.col("_week") > 0, F.col("_week")).when(F.col("_day") > 0, F.col("_day"))
    return out.withColumn(value, F.when((F.col("_len") >= least) & F.col(value).isNotNull(), donor).otherwise(F.col(value))).drop("_run", "_len", "_at", "_week", "_day")


def qc_observation(df: DataFrame, start: Column, key: Sequence[str] = ("station_code",), max_gap_min: int = 240, max_age_h: int = 48) -> DataFrame:
    """Observation rows (ts, at, td, ws, sc, st, sst, pi) that can be used.

    Rows with a missing value, repeated times, those before the last gap of over max_gap_min, and those over max_age_h
    before start are dropped; surface and air temperature, wind outside of their ranges make their valid flags false,
    sub-surface temperature holds its last good value, and dew point is held below air temperature.
    """
    names = ["at", "td", "ws", "st", "sst"]
    w = Window.partitionBy(*key).orderBy("ts")
    good = df
    for c in names:
        good = good.where(F.col(c).isNotNull() & ~F.isnan(c))
    good = good.dropDuplicates([*key, "ts"]).where(F.col("ts") >= start - F.make_dt_interval(hours=F.lit(max_age_h)))
    gap = F.when(gap_s("ts", F.lag("ts").over(w)) > max_gap_min * 60, F.col("ts"))
    good = good.withColumn("_gap", gap).withColumn("_gap", F.max("_gap").over(Window.partitionBy(*key))).where("_gap IS NULL OR ts >= _gap").drop("_gap")
    sst = F.last(F.when(F.col("sst").between(-40, 80), F.col("sst")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return good.withColumns({"st_valid": F.col("st").between(-40, 80), "at_valid": F.col("at").between(-60, 50), "ws_valid": F.col("ws").between(0, 90), "td": F.least("td", "at"), "sst": sst})


def qc_forecast(df: DataFrame, observations: DataFrame, key: Sequence[str] = ("station_code",)) -> DataFrame:
    """A report for each station: counts of what is wrong with its forecast rows (ts, at, td, ra, sn, ws, ap, cc), and whether it can be used."""
    w = Window.partitionBy(*key).orderBy("ts")
    names = ["at", "td", "ra", "sn", "ws", "ap", "cc"]
    hole = F.lit(False)
    for c in names:
        hole = hole | F.col(c).isNull()
    rows = df.withColumns({"_hole": hole, "_cloud": F.coalesce(~F.col("cc").between(0, 8), F.lit(False)), "_fall": F.coalesce((F.col("ra") < F.lag("ra").over(w)) | (F.col("sn") < F.lag("sn").over(w)), F.lit(False)), "_step": F.coalesce(gap_s("ts", F.lag("ts").over(w)) != 3600, F.lit(False))})
    each = rows.groupBy(*key).agg(F.count_if("_hole").alias("missing"), F.count_if("_cloud").alias("clouds"), F.count_if("_fall").alias("falling"), F.count_if("_step").alias("spacing"), F.count(F.lit(1)).alias("rows"), F.min("ts").alias("lo"))
    seen = observations.groupBy(*key).agg(F.max("ts").alias("last_obs"), F.min("ts").alias("first_obs"))
    out = each.join(seen, list(key), "left").withColumn("overlaps", F.coalesce(F.col("last_obs") >= F.col("lo"), F.lit(False)))
    return out.withColumn("usable", F.expr("missing = 0 AND clouds = 0 AND falling = 0 AND spacing = 0 AND rows >= 2 AND overlaps")).drop("lo", "last_obs", "first_obs")


def accept_observation(df: DataFrame, key: Sequence[str] = ("station_code",), reference_precedence: bool = False) -> DataFrame:
    """For each station whether its rows (ts, st, sst; NULL is missing) can start a forecast, and which of the four checks hold.

    Rows with both temperatures exist; each has another surface value within 4 hours; two rows have surface values; one
    of the first two has. reference_precedence: the last check then passes for any two rows.
    """
    w = Window.partitionBy(*key).orderBy(seconds("ts"))
    around = F.count("st").over(w.rangeBetween(-14400, 14400)) - F.count("st").over(w.rangeBetween(0, 0))
    rows = df.withColumns({"_n": F.row_number().over(Window.partitionBy(*key).orderBy("ts")), "_near": around, "_both": F.col("st").isNotNull() & F.col("sst").isNotNull()})
    early = (F.col("_n") <= 2) & F.col("st").isNotNull()
    if reference_precedence:
        early = early | (F.col("_n") == 2)
    out = rows.groupBy(*key).agg((F.count_if("_both") > 0).alias("has_both"), (F.count_if(F.col("_both") & (F.col("_near") == 0)) == 0).alias("has_company"), (F.count("st") >= 2).alias("has_two"), (F.count_if(early) > 0).alias("has_early"))
    return out.withColumn("accepted", F.expr("has_both AND has_company AND has_two AND has_early"))
