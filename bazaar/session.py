"""SparkSession helpers.

Library code never sets cluster sizing; it only reads what the session holds.
``local_session`` is for tests and the bench on one machine.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings that matter for every job in this package.  AQE is on so that the
# engine coalesces small shuffles, splits skewed join partitions, and turns a
# sort-merge join into a broadcast join when a side turns out to be small at
# runtime (the size check that guards every non-fixed-size broadcast).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "bazaar") -> SparkSession:
    """Session for tests / bench on one host (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BAZAAR_DRIVER_MEMORY", "16g"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when nothing is configured and the session runs on one machine (tests,
    local bench) do we create a fresh scratch folder; a cluster must name one.
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    scratch = tempfile.mkdtemp(prefix="bazaar-ckpt-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


@contextmanager
def frees_shuffles(spark: SparkSession):
    """What is written or checkpointed inside removes the shuffle files that led to it, which nothing else reads, as soon as
    it is there (Spark 4.1; else they stay until the driver happens to collect its garbage)."""
    before = spark.conf.get(FREES_SHUFFLES, None)
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREES_SHUFFLES)
        else:
            spark.conf.set(FREES_SHUFFLES, before)


def cut(df):
    """The same rows behind a reliable checkpoint in the shared folder: computed once, whoever reads them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, schema=None, **options):
    """Lineage cut as a written Parquet table in the shared folder: columnar, so narrower than a checkpoint, and its size
    is known to the planner.  With ``schema`` the columns are read back as its types, which keep the same data; ``options``
    are the writer's."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/table-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the session's checkpoint dir for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
