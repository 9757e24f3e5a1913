"""Writers: tables, GeoJSON, JSON, idempotent appends, builds that skip what is there, publishing by rename."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """With a header. single: one file, for results of a few rows."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def point_geometry(x: Column, y: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates"))


def line_geometry(*points: tuple[Column, Column], kind: str = "LineString") -> Column:
    """LineString or MultiPoint."""
    return F.struct(F.lit(kind).alias("type"), F.array(*[F.array(x, y) for x, y in points]).alias("coordinates"))


def ring_geometry(ring: Column) -> Column:
    closed = F.concat(ring, F.slice(ring, 1, F.lit(1)))
    return F.struct(F.lit("Polygon").alias("type"), F.array(F.transform(closed, lambda p: F.array(p["x"], p["y"]))).alias("coordinates"))


def features(df: DataFrame, geometry: Column, properties: list[str]) -> DataFrame:
    """value: a GeoJSON feature a row."""
    props = F.struct(*properties) if properties else F.create_map().cast("map<string,string>")
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), props.alias("properties"))).alias("value"))


def write_geojson(df: DataFrame, path: str, geometry: Column, properties: list[str]) -> None:
    """Newline-delimited features, which any number of tasks can write; read_geojson(lines=True) reads them."""
    features(df, geometry, properties).write.mode("overwrite").text(path)


def write_feature_collection(df: DataFrame, path: str, geometry: Column, properties: list[str]) -> None:
    """One file with one FeatureCollection, for layers that other programs read. A task streams the features into it, so its size is bounded by
    the disk and not by memory."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = lambda values: pa.RecordBatch.from_arrays([pa.array(values, type=pa.string())], ["value"])
        first = True
        yield line(['{"type": "FeatureCollection", "features": ['])
        for batch in batches:
            values = [x if first and i == 0 else "," + x for i, x in enumerate(batch.column(0).to_pylist())]
            first = first and not values
            yield line(values)
        yield line(["]}"])

    features(df, geometry, properties).coalesce(1).mapInArrow(joined, "value string").write.mode("overwrite").text(path)


def pair_features(pairs: DataFrame, kind: str = "LineString") -> DataFrame:
    """Lines, or pairs of points, from treated to control pixels."""
    ends = [(F.col("k_lng"), F.col("k_lat")), (F.col("s_lng"), F.col("s_lat"))]
    return features(pairs, line_geometry(*ends, kind=kind), [])


def new_rows(incoming: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Rows of incoming whose key is not present, one a key: of several the least row stays."""
    others = [c for c in incoming.columns if c != key]
    one = incoming.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")).select(key, "_row.*") if others else incoming.distinct()
    return one.select(*incoming.columns).join(present.select(key).distinct(), key, "left_anti")


def append_new(incoming: DataFrame, path: str, key: str) -> None:
    """Appends to a Parquet table the rows whose key it lacks; running it again appends nothing."""
    spark = incoming.sparkSession
    present = spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], incoming.select(key).schema)
    new_rows(incoming, present, key).write.mode("append").parquet(path)


def _execute(spark: SparkSession, url: str, statements: list[str], options: dict[str, str]) -> None:
    """All statements in one transaction, by the driver."""
    jvm = spark.sparkContext._jvm
    if "driver" in options:
        jvm.java.lang.Class.forName(options["driver"])
    properties = jvm.java.util.Properties()
    for k, v in options.items():
        properties.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for s in statements:
            statement.execute(s)
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def append_jdbc(incoming: DataFrame, url: str, table: str, key: str, **options: str) -> None:
    """Appends to a table of a database the rows whose key it lacks, all of them or none.

    Tasks write to a staging table that this run alone has; then one transaction moves its rows over, once more without keys that came in meanwhile. A task
    that fails, or is run twice, leaves the target as it was; running it again appends nothing."""
    spark = incoming.sparkSession
    quote = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    staging, k = f"staging_{uuid.uuid4().hex[:16]}", quote(key)
    present = spark.read.format("jdbc").options(url=url, query=f"SELECT DISTINCT {k} FROM {table}", **options).load()
    columns = ", ".join(quote(c) for c in incoming.columns)
    try:
        new_rows(incoming, present, key).write.format("jdbc").options(url=url, dbtable=staging, **options).mode("errorifexists").save()
        _execute(spark, url, [f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} s WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE t.{k} = s.{k})"], options)
    finally:
        with contextlib.suppress(Exception):  # there is none if the first task failed
            _execute(spark, url, [f"DROP TABLE {staging}"], options)


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def build_if_missing(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> bool:
    """Writes make() to path unless a finished table is there. Says whether it did."""
    if exists(spark, f"{path}/_SUCCESS"):
        return False
    publish(make(), path)
    return True


def publish(df: DataFrame, path: str) -> None:
    """Writes beside and renames. The table before is moved aside and deleted only when the new one stands in its place; if that fails it is
    moved back, so a failure loses nothing. Between the two renames a reader finds no table, never half of one."""
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    df.write.parquet(beside)
    source, fs = _path(spark, beside)
    target, _ = _path(spark, path)
    aside, _ = _path(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(source, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"could not publish {path}")
    if had:
        fs.delete(aside, True)


def missing_targets(wanted: DataFrame, present: DataFrame, key: str = "name") -> DataFrame:
    """Targets that still have to be built."""
    return wanted.join(present.select(key).distinct(), key, "left_anti")
