"""Session settings the pipeline relies on.

Cluster sessions are created by the platform; ``ensure_session_conf`` only
sets what the semantics depend on (UTC session zone, ANSI casts, exact names) and never
overrides storage locations that the cluster already names.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Semantics: timestamps are timezone-free, bad casts abort (as the SQL engine
# of the original pipeline does), column names of CSV headers are compared
# with their case.
SEMANTIC_CONF = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

def build_local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                        app_name: str = "ordermart") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SEMANTIC_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_conf(spark)
    return spark


def ensure_session_conf(spark: SparkSession) -> None:
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share: ``spark.checkpoint.dir`` of the session.

    Only a single-machine master (``local``, ``local[n]``) may run without the
    setting; it then gets a temporary folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ordermart-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")
