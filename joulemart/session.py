"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime choices the plans rely on. Partition counts and memory stay with
# the cluster: adaptive execution coalesces small shuffles and splits hot ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # HotSpot never compiles methods above this size; wide staging projections
    # come close, and are better split into small functions than interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Texts go to Python by bytes: 10,000 of them are a batch of tens of MB, which
    # a task holds twice in the JVM while its buffer grows, and once in Python.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def build_session(app_name: str = "joulemart", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: str | None = None


def work_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    That is the folder named by ``spark.checkpoint.dir``. Only a local-mode
    session without the setting falls back to a temporary folder, one a process.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="joulemart-")
    return _local_root


#: Of the defaults, those that a plan over certificates needs in whatever session it runs.
PLAN_SETTINGS = ("spark.sql.codegen.hugeMethodLimit",)
#: Those that a plan needs that sends whole texts to Python.
TEXT_SETTINGS = ("spark.sql.execution.arrow.maxBytesPerBatch",)


def settle(spark: SparkSession, keys: tuple[str, ...] = PLAN_SETTINGS) -> None:
    """Give a session that the caller built the settings that wide plans, or others, rely on; those that are set stay.

    Without the limit a wide projection is one method too large to be compiled, and costs some three times the time a row.
    """
    for key in keys:
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, DEFAULTS[key])


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors of a session, once, so that its functions can run there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="joulemart-code-"), "joulemart.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path below the shared work folder."""
    return os.path.join(work_root(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df from a table in the work folder: computed once, whatever is lost later."""
    folder = new_work_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


#: More rows than this are never sent to every task.
BROADCAST_ROWS = 500_000


def sent_if_few(df: DataFrame, most: int) -> DataFrame:
    """df, to be sent to every task in a join if it has at most so many rows."""
    few = most <= BROADCAST_ROWS and df.limit(most + 1).count() <= most
    return F.broadcast(df) if few else df
