"""Session helpers: the few settings every plan in this package relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans depend on for correct results (not for speed).
REQUIRED_CONF = {
    # all epoch/render expressions assume UTC wall-clock
    "spark.sql.session.timeZone": "UTC",
    # JSON answers with duplicate keys: last one wins, as in Python's json
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings for scale: runtime re-planning, skew splitting, partition coalescing.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the plans need; safe to call repeatedly."""
    for k, v in {**REQUIRED_CONF, **SCALE_CONF}.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (user scorers run
    there), once per SparkContext: zip it and ``addPyFile`` it.

    On a cluster the package is normally deployed with ``--py-files``
    (``spark.submit.pyFiles``); then nothing is done.  Otherwise the zip is
    built next to the driver process and Spark serves it to the executors.
    """
    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    if "vetline" in (sc.getConf().get("spark.submit.pyFiles") or ""):
        _SHIPPED.add(id(sc))
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="vetline-pyfiles-"), "vetline.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(id(sc))


def build(master: str = "local[8]", app: str = "vetline", shuffle_partitions: int = 8,
          extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs (UI off, small shuffle width)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # checkpoints (ranking) are removed once their DataFrame is garbage collected
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**REQUIRED_CONF, **SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    when neither is set and the master is local (tests, local runs) a private
    folder is created and set; on a cluster a machine-local folder is not
    shared by the executors, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(checkpoints and written intermediate tables go there)")
        d = tempfile.mkdtemp(prefix="vetline-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for written tables."""
    root = checkpoint_root(spark)
    return os.path.join(root, "vetline", f"{name}-{uuid.uuid4().hex[:12]}")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores (a small file of one row
    group), dealt over the cores before costly work on each row; a scan of
    more splits is left as it is, so nothing large is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
