"""Session helpers: local sessions for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "corpusflow") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CORPUSFLOW_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)
    ship_package(spark)
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder (a full URI) for lineage cuts and written tables: the cluster's
    ``spark.checkpoint.dir``. Only when it is unset on a local master (tests) a fresh
    local folder is created and registered."""
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext handle (e.g. Spark Connect)
        sc = None
    d = sc.getCheckpointDir() if sc is not None else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            master = sc.master if sc is not None else spark.conf.get("spark.master", "")
            if not master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            d = tempfile.mkdtemp(prefix="corpusflow-ckpt-", dir="/tmp")
            spark.conf.set("spark.checkpoint.dir", d)
        if sc is not None:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
    return d


def scratch(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the work folder for one job's written tables."""
    import uuid

    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusflow`` importable in the Python workers (``mapInPandas`` and UDFs
    unpickle functions by module name): zip the installed package once per driver and
    hand it to ``SparkContext.addPyFile``, which distributes it to every executor."""
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext handle: the package must come with the environment
        return
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="corpusflow-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
