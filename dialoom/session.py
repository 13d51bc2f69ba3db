"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings that the operators rely on or profit from; a cluster's own settings win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "dialoom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS; keyword arguments are further settings with `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate files that all executors share.

    It is the session's `spark.checkpoint.dir`. Where neither that setting nor a folder of the
    context is there, a local master gets a temporary one; on a cluster that is an error, as no other
    machine could read it.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not (context.master or "").startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="dialoom-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """`df` written to the `shared_folder`, so that lost executors cost no recomputation of it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)
