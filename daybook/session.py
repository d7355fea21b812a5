"""Session helpers for tests and the bench (a cluster job brings its own session)."""

from __future__ import annotations

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "daybook", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it in the session config. Only when it is unset is
    ``fallback`` installed, or, on a local master (tests), a fresh folder under
    the system temp dir; a cluster without the setting is an error, because a
    machine-local folder would not survive the loss of that machine.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if target is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        import tempfile

        target = tempfile.mkdtemp(prefix="daybook-ckpt-")
    spark.sparkContext.setCheckpointDir(target)
    return spark.sparkContext.getCheckpointDir() or target
