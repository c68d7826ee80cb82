"""Session helpers.

Library code never builds its own session; it takes the caller's.  These
helpers exist for tests, ``bench.py`` and the examples, and for the one
setting every job needs: a shared checkpoint directory.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings used for local runs.  On a cluster the deployment decides; nothing
# here overrides a value that is already set on the session.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pagemill") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pagemill`` importable in the Python workers that run its
    UDFs: zip the package once per application and ``addPyFile`` it (what
    ``--py-files`` does at submit time)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, zpath = tempfile.mkstemp(prefix="pagemill-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory of this session.

    On a cluster ``spark.checkpoint.dir`` names a shared file system and is
    used as is; there it must be set.  In a local session (tests) a scratch
    directory is created and registered when it is unset.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not configured and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    if not configured:
        configured = tempfile.mkdtemp(prefix="pagemill-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{os.urandom(6).hex()}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh table in the shared folder and reread."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
