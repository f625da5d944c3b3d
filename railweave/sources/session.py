"""What plans need of a session: this package on the workers, and the shared scratch folder."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_railweave_shipped", False):
        return
    here = pathlib.Path(__file__).parents[1]
    archive = pathlib.Path(tempfile.mkdtemp(prefix="spark-")) / "railweave.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, f"{here.name}/{p.relative_to(here)}")
    sc.addPyFile(str(archive))
    sc._railweave_shipped = True


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; where that is unset a local session gets a temporary folder, and a cluster raises."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        root = sc.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared scratch folder, which cuts its lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
