"""Session helpers: recommended settings and the checkpoint folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are tuned for; all can be overridden by the cluster.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot subject's join partition even when that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python line of every column expression is slow for wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | str = "*", app: str = "cohortine", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
    }
    for key, value in {**RECOMMENDED, **defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is only made for a local master, where driver and
    executors share one machine; elsewhere a missing setting is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None
    )
    if context.getCheckpointDir() is not None:
        return
    if configured:
        context.setCheckpointDir(configured)
    elif re.match(r"local(\[|$)", context.master):  # one machine, as in tests
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortine-checkpoint-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir must name a folder shared by all executors"
        )


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but the copy is columnar, so later
    passes read only the columns they need. It survives lost executors. The copy is
    deleted by :func:`release`, at the latest when the driver's Python ends.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    copy = spark.read.schema(df.schema).parquet(path)
    _TABLES[path] = spark
    copy._materialised_at = path
    return copy


#: Folders written by :func:`materialise` that still exist, with their session.
_TABLES: dict[str, SparkSession] = {}


def release(*copies: DataFrame) -> None:
    """Delete tables written by :func:`materialise` that nothing reads any more."""
    for copy in copies:
        path = getattr(copy, "_materialised_at", None)
        if path in _TABLES:
            _delete(_TABLES.pop(path), path)


def release_all(spark: SparkSession) -> None:
    """Delete every table this session has materialised; their readers must be done."""
    for path in [path for path, owner in _TABLES.items() if owner is spark]:
        _delete(_TABLES.pop(path), path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Delete at the end what was materialised inside; results must be written by then.

    Materialised tables that the block appends to the list it gets are kept.
    """
    before, kept = set(_TABLES), []
    try:
        yield kept
    finally:
        spared = before | {getattr(copy, "_materialised_at", None) for copy in kept}
        for path in [p for p, owner in _TABLES.items() if owner is spark and p not in spared]:
            _delete(_TABLES.pop(path), path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _release_at_exit() -> None:
    for path, spark in list(_TABLES.items()):
        if spark.sparkContext._jsc is not None:  # a stopped session cannot delete
            release_all(spark)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread the rows of an input that has fewer splits than there are cores.

    Worth it before heavy work per row on an input of a few files. A large input
    already has more splits than cores and stays as it is. ``keys`` should
    identify a row, so that the parts come out even.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
