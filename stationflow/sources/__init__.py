"""Readers and writers of measurements, dimensions and documents."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MEASUREMENTS


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's spark.checkpoint.dir, or the context's checkpoint folder.

    Where both are unset, a session of one machine (master local) gets a folder of its own; on a cluster there is none
    that all could read, which is an error.
    """
    if base := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="spark-stationflow-")
    return _LOCAL[app]


def read_measurements(spark: SparkSession, path: str, types: Sequence[str] | None = None, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Measurement history in Parquet; types and times are pushed down to the scan."""
    m = spark.read.schema(MEASUREMENTS).parquet(path)
    if types is not None:
        m = m.where(F.col("type_name").isin(list(types)))
    if since is not None:
        m = m.where(F.col("ts") >= since)
    return m if until is None else m.where(F.col("ts") < until)


def read_measurements_jdbc(spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: dict[str, str] | None = None) -> DataFrame:
    """The same from a database, one partition for each predicate."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties or {})


def read_station_csv(spark: SparkSession, glob: str) -> DataFrame:
    """station_code, name, ts and occ of files `NN__code__name.csv` without header."""
    rows = spark.read.schema("ts timestamp, occ int").csv(glob).withColumn("_f", F.input_file_name())
    part = lambda i: F.url_decode(F.regexp_extract("_f", r"([^/]*?)__([^/]*?)__([^/]*)\.csv$", i))
    return rows.select(part(2).alias("station_code"), part(3).alias("name"), "ts", "occ")


def read_dim_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S3: a dimension with a header."""
    return spark.read.option("header", True).schema(schema).csv(path)


def with_year(df: DataFrame, pattern: str = r"(\d{4})\.csv$") -> DataFrame:
    """The year in the name of the file that each row is from."""
    return df.withColumn("year", F.regexp_extract(F.input_file_name(), pattern, 1).cast("int"))


def latest_year_file(df_with_year: DataFrame, year: int, first: int = 2018) -> DataFrame:
    """Rows of the newest year not after year; fails if that would be before first."""
    if year < first:
        raise ValueError(f"there is no file before {first}")
    newest = df_with_year.where(F.col("year").between(first, year)).agg(F.max("year").alias("year"))
    checked = newest.select(F.coalesce("year", F.raise_error(F.lit("there is no file for the year")).cast("int")).alias("year"))
    return df_with_year.join(F.broadcast(checked), "year")  # one row


PREDICTION = "`forecast-time` timestamp, at double, td double, ra double, sn double, ws double, ap double, cc double"
MEASURE = "`observation-time` timestamp, at double, td double, pi double, ws double, sc double, st double, sst double"


def read_prediction_xml(spark: SparkSession, path: str, row_tag: str = "prediction", schema: str = PREDICTION) -> DataFrame:
    """One row for each element row_tag (`prediction`, or `measure` with MEASURE)."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


TREE = "map<string, struct<stations: map<string, struct<sdatatypes: map<string, struct<tmeasurements: array<struct<mvalidtime: string, mvalue: double, mperiod: int>>>>>>>>"


def flatten_tree_json(df: DataFrame, column: str = "json") -> DataFrame:
    """station_type, station_code, type_name, ts, value and period of each measurement in a tree of JSON."""
    types = df.select(F.explode(F.from_json(column, TREE)).alias("station_type", "t"))
    stations = types.select("station_type", F.explode("t.stations").alias("station_code", "s"))
    names = stations.select("station_type", "station_code", F.explode("s.sdatatypes").alias("type_name", "d"))
    rows = names.select("station_type", "station_code", "type_name", F.explode("d.tmeasurements").alias("m"))
    return rows.select("station_type", "station_code", "type_name", F.to_timestamp(F.col("m.mvalidtime"), "yyyy-MM-dd HH:mm:ss.SSSZ").alias("ts"), F.col("m.mvalue").alias("value"), F.col("m.mperiod").alias("period"))


def to_datamap(m: DataFrame, provenance: str) -> DataFrame:
    """station_code and datamap, a JSON of type to records in order of time, with the provenance; one row for each station."""
    record = F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), "value", "period")
    types = m.groupBy("station_code", "type_name").agg(F.array_sort(F.collect_list(record)).alias("data"))
    each = types.groupBy("station_code").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type_name", "data")))).alias("branch"))
    return each.select("station_code", F.to_json(F.struct(F.lit(provenance).alias("provenance"), "branch")).alias("datamap"))


def write_batched(df: DataFrame, path: str, n: int, format: str = "parquet") -> None:
    """Files of at most n rows."""
    df.write.option("maxRecordsPerFile", n).format(format).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header."""
    df.write.option("header", True).csv(path)


def write_by_month(df: DataFrame, path: str, ts: str = "ts") -> None:
    """Parquet in folders by year and month."""
    df.withColumns({"year": F.year(ts), "month": F.month(ts)}).write.partitionBy("year", "month").parquet(path)


def held(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, and there for all executors; let go of by forget()."""
    path = f"{shared_dir(df.sparkSession)}/stationflow-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._stationflow_path = path
    return table


def forget(table: DataFrame) -> None:
    """Deletes a table of held() that nothing reads again."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._stationflow_path)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
