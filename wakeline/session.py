"""Session defaults and the shared folder used for checkpoints and tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


#: Where the tables of :func:`stored` lie.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def local_session(cores: str | int = "*", **conf: str) -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own settings."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("wakeline")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one named by ``spark.checkpoint.dir``. Where that is unset a
    temporary folder is accepted for a local master only, since on a cluster a
    machine-local folder is lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="wakeline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write once below the shared folder and read back.

    For results several branches need. The table outlives lost executors, ends
    the lineage, and gives the optimiser a known size to choose joins by.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def remove(*tables: DataFrame | None) -> None:
    """Delete tables of :func:`stored` that nothing will read again."""
    for table in tables:
        path = _PATHS.pop(table, None) if table is not None else None
        if path:
            jvm, context = table.sparkSession._jvm, table.sparkSession.sparkContext._jsc
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context.hadoopConfiguration()).delete(place, True)
