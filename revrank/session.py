"""Session set-up and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "revrank", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on.

    On a cluster leave ``master`` unset and let ``spark-submit`` decide; the
    shared folder for checkpoints is expected in ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; make a scratch one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="revrank-checkpoint-")
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` below the checkpoint folder and continue from the written table.

    Unlike a plain checkpoint the table has known statistics, so Spark can judge
    its size in later joins, and readers scan only the columns they need.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
