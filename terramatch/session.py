"""Sessions, and sending this package to the executors."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def session(name: str = "terramatch", **settings: str) -> SparkSession:
    """A session with adaptive execution, skew joins and UTC; settings (dots as double underscores) override."""
    conf = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    conf |= {k.replace("__", "."): v for k, v in settings.items()}
    return SparkSession.builder.appName(name).config(map=conf).getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package's source to the executors, once an application, so that their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        file = Path(tempfile.mkdtemp(prefix="terramatch-code-")) / "terramatch_code.zip"
        with zipfile.ZipFile(file, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(file))
        _shipped.add(app)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset, as in tests, a new one that is then set. On a cluster
    an unset one is an error: a folder of one machine would not be seen by the others."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: tables between steps need a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="terramatch-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/terramatch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """df, written as a Parquet table in the shared folder and read back: lineage is cut, and a lost executor costs a reread. With partitions,
    for tables of a few rows, rows are made in as many tasks as ever and only then gathered."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    (df.repartition(partitions) if partitions else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, columns: list[str], buckets: int) -> DataFrame:
    """df, written as a table in the shared folder that is bucketed by columns: joins on just these columns shuffle the other side alone, however many
    there are."""
    spark, path, table = df.sparkSession, new_path(df.sparkSession, name), f"terramatch_{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, *columns).write.format("parquet").bucketBy(buckets, columns).option("path", path).saveAsTable(table)
    return spark.table(table)


def release(spark: SparkSession) -> None:
    """Deletes the durable tables of this application. Frames that were made from them can't be read afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/terramatch/{spark.sparkContext.applicationId}")
    for t in spark.catalog.listTables():
        if t.name.startswith("terramatch_"):
            spark.sql(f"DROP TABLE IF EXISTS `{t.name}`")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
