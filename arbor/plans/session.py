"""Session settings and the shared folder used to cut lineage.

The library never picks a machine-local folder on a cluster: the folder for
materialised iteration rounds comes from the session's ``spark.checkpoint.dir``
as it is given there. Only a ``local[...]`` session with no such setting gets a
private temporary folder, which is what tests and the bench do.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the operators are written against. AQE re-plans joins at runtime
# (broadcast when a side turns out small, split skewed partitions), and the
# skew-join split stays on even when it adds a shuffle.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str = "arbor", cpus: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A ``local[cpus]`` session for tests and the bench (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


_PRIVATE: dict[str, str] = {}


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder exactly as ``spark.checkpoint.dir`` names it, the same after a restart; None if unset.

    ``SparkContext.getCheckpointDir()`` ends in a fresh id per application, so it is
    only used where a program set it itself and left the setting empty.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    return found.rstrip("/") if found else None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for materialised rounds, read from the session."""
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; make a private one only for an unset local session."""
    found = configured_checkpoint_dir(spark) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: iterative hierarchy operators write each round to a "
            "shared folder; set spark.checkpoint.dir to a location every executor can read"
        )
    app = spark.sparkContext.applicationId
    if app not in _PRIVATE:
        _PRIVATE[app] = tempfile.mkdtemp(prefix="arbor-ckpt-")
        spark.sparkContext.setCheckpointDir(_PRIVATE[app])
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def prepare_session(spark: SparkSession) -> SparkSession:
    """Check what the operators rely on, for a session that the caller made.

    Hot keys are split by adaptive execution, so it must be on: a session that
    turned it off is refused. The skew-join settings are switched on where they
    are not, and the checkpoint folder must be set on a cluster.
    """
    if spark.conf.get("spark.sql.adaptive.enabled", "true") != "true":
        raise RuntimeError("spark.sql.adaptive.enabled is off; the joins on hot keys need it")
    for key in ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        if spark.conf.get(key, "false") != "true":
            spark.conf.set(key, "true")
    ensure_checkpoint_dir(spark)
    return spark
