"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around (AQE re-plans joins at runtime,
# splits skewed partitions and coalesces small ones).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "geoqa", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster pass ``master=None`` and let spark-submit decide; tests use
    ``local[*]`` with few shuffle partitions.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``geoqa`` importable by the Python workers (pandas stages
    unpickle functions defined in it): zip the package once per Spark
    context and hand it to ``addPyFile``, which distributes it to every
    executor.  Needed whenever the workers do not start from the repo."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="geoqa-pkg-"), "geoqa.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the session names.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage and is
    only read here.  Only when it is unset *and* the master is local (tests,
    laptops) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; iterative operators need a shared "
                           "checkpoint folder on a cluster")
    d = tempfile.mkdtemp(prefix="geoqa-ckpt-", dir=os.environ.get("GEOQA_SCRATCH", "/tmp"))
    sc.setCheckpointDir(d)
    return d
