"""Session factory: the settings the operators are planned for, in one place."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

#: Adaptive execution re-plans joins and splits skewed partitions at run time; UTC keeps
#: timestamps comparable with watermarks stored as ISO strings.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks, with a folder for intermediate tables that goes with the process; on a cluster
    use the session the cluster gives."""
    if "spark.checkpoint.dir" not in conf:
        folder = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        conf = {**conf, "spark.checkpoint.dir": f"file://{folder}"}
    builder = SparkSession.builder.master(f"local[{cores}]").appName("millrace")
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": memory} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
