"""Readers: tables by extension, GeoJSON, JSON documents, file names, tiles by glob, JDBC, granules."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import tile_corner, tile_name_year
from . import geotiff


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet or CSV with a header, by extension; any other is an error."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "parquet":
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if kind == "csv":
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    raise ValueError(f"neither CSV nor Parquet: {path}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, columns: list[str] | None = None, sep: str = ",", quote: str = '"') -> DataFrame:
    df = spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", quote).csv(path)
    return df.select(*columns) if columns else df


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One document a file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_geojson(spark: SparkSession, path: str, properties: T.StructType | str, lines: bool = False) -> DataFrame:
    """properties, geometry_type, polygon_id, ring and holes, a row an outer ring of a Polygon or MultiPolygon with its inner rings. Files hold a
    FeatureCollection each, or with lines a feature a line, which any number of tasks read.

    Coordinates are parsed as text, since their depth differs by type."""
    props = properties.simpleString() if isinstance(properties, T.StructType) else f"struct<{properties}>"
    feature = f"properties {props}, geometry struct<type: string, coordinates: string>"
    if lines:
        raw = spark.read.schema(feature).json(path).select(F.sha2(F.to_json(F.struct("properties", "geometry")), 256).alias("feature"), F.struct("properties", "geometry").alias("f"))
    else:
        raw = spark.read.schema(f"features array<struct<{feature.replace(' ', ': ', 1).replace(', geometry ', ', geometry: ')}>>").option("multiLine", True).json(path).select(F.posexplode("features").alias("feature", "f"))
    one = raw.select("feature", "f.properties.*", F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("text"))
    parts = F.when(F.col("geometry_type") == "MultiPolygon", F.from_json("text", "array<array<array<array<double>>>>")).otherwise(F.array(F.from_json("text", "array<array<array<double>>>")))
    rings = one.withColumn("parts", parts).select("*", F.posexplode("parts").alias("part", "rings")).drop("text", "parts")
    point = lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))
    opened = lambda r: F.when((F.size(r) > 1) & (F.get(r, 0) == F.get(r, F.size(r) - 1)), F.slice(r, 1, F.size(r) - 1)).otherwise(r)
    ring = lambda r: opened(F.transform(r, point))
    holes = F.when(F.size("rings") > 1, F.transform(F.slice("rings", 2, F.size("rings") - 1), ring)).otherwise(F.array())
    return rings.withColumn("ring", ring(F.get(F.col("rings"), 0))).withColumn("holes", holes).withColumn("polygon_id", F.concat_ws("-", "feature", "part")).drop("rings")


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Adds file, tile_lat, tile_lng and tile_year from the names of the files that rows come from."""
    path = F.col("_metadata.file_path")
    return df.withColumns(file_metadata(path) | {"file": F.substring_index(path, "/", -1)})


def file_metadata(path: Column) -> dict[str, Column]:
    lat, lng = tile_corner(path)
    return {"tile_lat": lat, "tile_lng": lng, "tile_year": tile_name_year(path)}


def read_tiles(spark: SparkSession, folder: str, glob: str = "*.parquet", schema: str = "x int, y int, value double") -> DataFrame:
    """Pixel tiles of a folder whose names match; the glob prunes files before they are listed for the scan."""
    return with_file_metadata(spark.read.schema(schema).option("pathGlobFilter", glob).parquet(folder))


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], split: str | None = None, bounds: tuple[int, int] = (0, 0), parts: int = 16, **options: str) -> DataFrame:
    """A table's columns; with a split column, in parts by ranges of it."""
    more = {"partitionColumn": split, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(parts)} if split else {}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **more, **options).load().select(*columns)


def read_geotiff(spark: SparkSession, path: str, glob: str = "*.tif") -> DataFrame:
    """tile, x, y, lng, lat, value of GeoTIFF files in any store that Spark reads: a file is one binary value, parsed strip by strip in its task.
    The "geotiff" data source reads parts of large local files."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from geotiff.strips_of(io.BytesIO(content.as_buffer()), name.rsplit("/", 1)[-1])

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "content").mapInArrow(parse, geotiff.SCHEMA)


GRANULE = "granule string, beam string, shot_number long, lat double, lng double, absolute_time double, agbd double, l4_quality_flag int, degrade_flag int"


def read_granules(spark: SparkSession, folder: str, glob: str = "*.h5") -> DataFrame:
    """Shots of HDF5 granules, a beam at a time; a beam that lacks an array is skipped. Needs h5py on the executors."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import h5py  # not everywhere installed

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with h5py.File(io.BytesIO(content)) as h:
                    for beam in (b for b in h if b.startswith("BEAM")):
                        try:
                            g = h[beam]
                            yield pd.DataFrame({"granule": path.rsplit("/", 1)[-1], "beam": g.attrs["description"], "shot_number": g["shot_number"][:], "lat": g["lat_lowestmode"][:], "lng": g["lon_lowestmode"][:], "absolute_time": g["delta_time"][:], "agbd": g["agbd"][:], "l4_quality_flag": g["l4_quality_flag"][:], "degrade_flag": g["degrade_flag"][:]})
                        except KeyError:
                            continue

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", "content").mapInPandas(parse, GRANULE)


def tile_grid(spark: SparkSession, north: int = 30, south: int = -20, west: int = -110, east: int = 170, step: int = 10) -> DataFrame:
    """lat, lng of all tiles of a global product, from north to south and west to east, ends included."""
    lats = spark.range(1).select(F.explode(F.sequence(F.lit(north), F.lit(south), F.lit(-step))).alias("lat"))
    return lats.select("lat", F.explode(F.sequence(F.lit(west), F.lit(east), F.lit(step))).alias("lng"))
