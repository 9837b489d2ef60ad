"""Spark session settings and shared-storage helpers.

On a cluster the session is created by the platform; ``configure`` only fills
in settings that are still unset. Lineage is cut with reliable checkpoints in
the folder named by ``spark.checkpoint.dir``; a private folder is chosen only
when the session has none (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library relies on; applied only where unset.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "kiln", extra: dict | None = None) -> SparkSession:
    """Local session for tests, bench and examples (UI off, AQE on)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config(SPREAD_PARTITIONS, str(max(2, shuffle_partitions)))
         .config("spark.driver.memory", os.environ.get("KILN_DRIVER_MEMORY", "4g")))
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply library defaults to an existing session where they are unset."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a private one if unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that setting
    wins. Only a session without one (local mode, tests) gets a temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="kiln-ckpt-")
    sc.setCheckpointDir(path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application.

    Batch functions are pickled by reference, so workers must be able to import
    the package also when the driver was started from another folder.
    """
    sc = spark.sparkContext
    if getattr(sc, "_kiln_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="kiln-zip-"), "kiln_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._kiln_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Defaults, checkpoint folder and worker package: what every registered query needs."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts lineage like ``materialize`` in a compressed, column-prunable form.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: writes to the shared checkpoint folder, survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Name of the setting for ``spread``.
SPREAD_PARTITIONS = "spark.kiln.spread.partitions"


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Repartition before CPU-heavy per-row work such as regex tokenising, when the session asks for it.

    A few megabytes of text in one Parquet row group would otherwise run in one task, so local sessions
    set ``spark.kiln.spread.partitions``. On a cluster it stays unset: large tables come in many splits
    (``spark.sql.files.maxPartitionBytes``), and nothing is shuffled here.
    """
    n = int(df.sparkSession.conf.get(SPREAD_PARTITIONS, "0"))
    if n <= 0:
        return df
    return df.repartition(n, key) if key else df.repartition(n)
