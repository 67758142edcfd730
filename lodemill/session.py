"""Sessions, table access and lineage cuts."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", conf.pop("shuffle", "8"))
        .config("spark.driver.memory", conf.pop("memory", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One corpus table; columns are pruned by the caller's projection."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Only a session on this machine may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="lodemill-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder once and go on from there; survives lost executors."""
    spark = df.sparkSession
    jsc = spark.sparkContext._jsc.sc()
    if not jsc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def keep(df: DataFrame, at: str) -> DataFrame:
    """Write df as a table at this place of the shared folder and go on from there; drop() ends it.

    For loops that join what they made before: cut() keeps the planner's estimate of the size, for a join the product
    of both sides', so that a loop's estimates grow to numbers of millions of digits. Of a table the files count.
    """
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def drop(spark: SparkSession, at: str) -> None:
    """Delete a table that keep() wrote, or a folder of them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(at)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def tokenizer_dir() -> str:
    """Where public vocabulary files lie; LODEMILL_TOKENIZERS overrides."""
    return os.environ.get("LODEMILL_TOKENIZERS", "/opt/tokenizers")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once a session."""
    context = spark.sparkContext
    if getattr(context, "_lodemill_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="lodemill-"), "lodemill"), "zip", os.path.dirname(here), os.path.basename(here))
    context.addPyFile(made)
    context._lodemill_shipped = True
