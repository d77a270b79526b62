"""Session settings the library expects."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings that results depend on: bucket edges are UTC instants.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

# The JVM does not optimize methods above 8000 bytes of bytecode. Below this limit Spark
# fuses operators into one method; above it, it splits the expressions, which runs faster.
CODEGEN = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Worth setting on a cluster; none of them changes a result.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def require(spark: SparkSession) -> SparkSession:
    """Pin what results and generated code rely on, on a session somebody else built."""
    for key, value in {**REQUIRED, **CODEGEN}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "fluxwell", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = require(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder every executor can reach: under spark.checkpoint.dir, which a cluster has to set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix="fluxwell-")
    stamp = spark.sql("SELECT uuid() AS u").first()["u"]
    return f"{root.rstrip('/')}/fluxwell-{stamp}"
