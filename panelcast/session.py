"""Session helpers: a local session for tests/bench and lineage cutting.

On a cluster the session comes from the caller; nothing here overrides its
settings except where a value is unset (:func:`set_defaults`, command line only).
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings a run of this library expects; on a cluster they are only
# suggested defaults (the cluster's own values win, see ``set_defaults``).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "panelcast") -> SparkSession:
    """Local session as used by the tests and the bench (UI off)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def set_defaults(builder: SparkSession.Builder) -> SparkSession:
    """A session from ``builder`` with the defaults set where the cluster sets nothing."""
    spark = builder.getOrCreate()
    given = dict(spark.sparkContext.getConf().getAll())
    for k, v in DEFAULTS.items():
        if k not in given:
            spark.conf.set(k, v)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``panelcast`` importable in the Python workers, as ``--py-files`` would.

    Functions that run on executors are pickled by reference to this package. The package is zipped once per
    application and added with ``addPyFile``; Spark serves the file to every
    executor itself. Harmless where the package is installed already.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = Path(__file__).resolve().parent
    out = tempfile.mkdtemp(prefix="panelcast-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "panelcast"), "zip",
                                  root_dir=str(pkg.parent), base_dir=pkg.name)
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, taking it from the session.

    Uses the directory already set on the context or ``spark.checkpoint.dir``.
    Only a ``local[...]`` session without either (the tests) gets a folder of its
    own, deleted when the process ends; a cluster session without one, and that
    includes ``local-cluster``, is an error, because a machine-local folder would
    not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if re.match(r"local(\[|$)", sc.master):
        path = tempfile.mkdtemp(prefix="panelcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share "
                       "before running a multi-branch plan")


_APPS: set[str] = set()


def scratch_dir(spark: SparkSession) -> str:
    """Folder of this application's intermediates under the checkpoint folder; it is deleted
    when the driver process ends (a block of :func:`scratch_run` deletes its own earlier)."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/panelcast/{spark.sparkContext.applicationId}"
    if path not in _APPS:
        _APPS.add(path)
        atexit.register(_delete_quietly, spark, path)  # runs before Spark's own exit handler
    return path


def _delete_quietly(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be stopped already
        _delete(spark, path)


_RUN: contextvars.ContextVar[str | None] = contextvars.ContextVar("panelcast_run", default=None)


def _delete(spark: SparkSession, path: str) -> None:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


@contextlib.contextmanager
def scratch_run(spark: SparkSession):
    """Tables written by :func:`cut_lineage` inside the block are deleted at its end;
    nothing lazy that reads them may leave it."""
    path = f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        _delete(spark, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a much-reused intermediate as a Parquet table in the
    shared checkpoint folder and continue from that table.

    The table survives the loss of any executor, later plans start from a plain
    Parquet scan with real size statistics (so the planner's broadcast size check
    sees the true size), and no lineage or inferred constraints of the producing
    plan are carried along. ``Dataset.checkpoint`` would also cut the
    lineage, but it re-derives the constraints of the whole producing plan,
    which explodes for 40-column frames filtered on every column.
    """
    spark = df.sparkSession
    path = f"{_RUN.get() or scratch_dir(spark)}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
