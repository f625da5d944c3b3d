"""Shared helpers: tables, the shared scratch folder, and word rules."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

#: A word is a maximal run of characters other than these six (space, tab, LF, VT, FF, CR).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers once per context, wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    here = pathlib.Path(__file__).parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="spark-")) / "llm_operators.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(here.glob("*.py")):
            z.write(p, f"{here.name}/{p.name}")
    sc.addPyFile(str(archive))
    sc._llm_shipped = True


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the folder that the cluster names in spark.checkpoint.dir.

    Where that is unset a local session (tests) gets a temporary folder, once; on a cluster it raises.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        root = sc.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared scratch folder and reads it back, which cuts its lineage."""
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that `written` made and that no later step reads."""
    for t in tables:
        if path := getattr(t, "_scratch_path", None):
            fs, at = pyarrow.fs.FileSystem.from_uri(path)
            fs.delete_dir(at)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    while name.lower() in map(str.lower, df.columns):
        name = f"_{name}"
    return name


def with_row(docs: DataFrame, name: str) -> DataFrame:
    """docs, written, with a number (long) that tells its rows apart."""
    return written(docs.sparkSession, docs.withColumn(name, F.monotonically_increasing_id()), "rows")
