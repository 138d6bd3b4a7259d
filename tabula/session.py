"""Session and shared-folder helpers.

The library never picks a machine-local folder on a cluster: intermediate
tables and checkpoints go under ``spark.checkpoint.dir`` as named by the
cluster.  Only ``build_session`` (tests, bench) names a folder of its own, for
a local master and where the configuration has none.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tabula") -> SparkSession:
    """Session used by tests and bench.  Cluster jobs pass their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        # Wide curated tables (50-70 columns of decode expressions) produce
        # generated methods above HotSpot's 8 KB JIT limit; let the JIT
        # compile them instead of interpreting them.
        # many distinct wide stages per run: keep their compiled classes
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
    )
    active = SparkSession.getActiveSession()
    if active is None and master.startswith("local") and not SparkConf().contains(CHECKPOINT_CONF):
        builder = builder.config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="tabula-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


# Runtime SQL settings the curation flows rely on for speed:
# key -> (Spark's own default, ours).  Wide projections (50-70 decode
# expressions in one stage) otherwise generate methods too big for the JIT;
# smaller split methods keep them compiled (measured: 11 s -> 3 s for the
# work-registry flow at sf0.1).
RUNTIME_DEFAULTS = {"spark.sql.codegen.methodSplitThreshold": ("1024", "256")}


def tune(spark: SparkSession) -> None:
    """Apply ``RUNTIME_DEFAULTS`` where the session still has Spark's default."""
    for key, (spark_default, ours) in RUNTIME_DEFAULTS.items():
        if spark.conf.get(key, spark_default) == spark_default:
            spark.conf.set(key, ours)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and staged tables, as the
    session names it.  ``build_session`` names one for local runs; any other
    session must, since only the cluster knows what its executors share."""
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None)
    sc = _context(spark)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf_dir:
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
    if sc is not None and not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a remote session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions have no SparkContext
        return None


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one staged table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system Spark would use for it, so
    that readers outside the JVM open the same files on every machine."""
    if "://" in path:
        return path
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    scheme, rest = full.split(":", 1)
    return f"{scheme}://{rest}" if not rest.startswith("//") else full


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library staged."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Make ``tabula`` importable in the Python workers.  The package is zipped
    once per SparkContext and handed to ``addPyFile``; the driver serves the
    file to executors, so its own place needs not be shared."""
    import os
    import zipfile

    sc = _context(spark)
    if sc is None or getattr(sc, "_tabula_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tabula-pkg-")), "tabula.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    sc._tabula_shipped = True
