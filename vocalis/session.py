"""Session construction and shared-storage scratch locations.

Jobs never pick a machine-local temporary folder on their own: intermediate
tables and streaming checkpoints live under the folder the cluster names in
``spark.checkpoint.dir`` (shared storage, survives executor loss).  Only when
that setting is missing in local mode (tests) do we fall back to a fresh
``mkdtemp`` folder, and we record it in the session so later calls agree; on a
cluster a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch that goes into a Python stage.
BATCH_BYTES = 16 * 1024 * 1024


def get_session(master: str | None = None, app: str = "vocalis",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings every job here relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # audio rows are large (bytes in, ~32 KB of features per second out):
        # cap Arrow batches by bytes, keep the row cap for small-row stages
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        _BATCH_KEY: str(BATCH_BYTES),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    defaults.update(conf)
    for k, v in defaults.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; in local mode one is made when it is unset."""
    base = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"{_CHECKPOINT_KEY} must name a folder that the driver and all executors of {master} share")
        base = tempfile.mkdtemp(prefix="vocalis-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, base)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(base)
    except Exception:  # noqa: BLE001 - no SparkContext on Connect sessions
        pass
    return base


def cap_batches(spark: SparkSession) -> None:
    """Cap Arrow batches by bytes in a session that ``get_session`` did not build and that names no cap of its own."""
    if spark.conf.get(_BATCH_KEY, None) is None:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    path = f"{base}{sep}{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


_SHIPPED_KEY = "spark.vocalis.pyfiles"


def ship_package(spark: SparkSession) -> None:
    """Make ``vocalis`` importable in every Python worker (once per session).

    Arrow jobs pickle functions by reference to this package, so executors
    need it on their path whatever the driver's working directory is.  The
    package is zipped and handed to ``addPyFile``, which serves it to all
    executors, including ones added or replaced later.
    """
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions ship code with addArtifacts instead
        return
    if spark.conf.get(_SHIPPED_KEY, "0") == "1":
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = ensure_checkpoint_dir(spark)
    folder = base if "://" not in base or base.startswith("file:") else tempfile.mkdtemp(prefix="vocalis-py-")
    folder = folder[len("file:"):] if folder.startswith("file:") else folder
    target = os.path.join(folder, f"vocalis-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    spark.conf.set(_SHIPPED_KEY, "1")
