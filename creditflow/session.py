"""Session defaults for tests and bench; on a cluster the submitter's settings win."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


#: What the flow needs of any session. The JVM never compiles a method of more bytecode than the
#: first: generated code beyond that runs several times faster operator by operator than as one
#: interpreted method. The second sizes tasks behind a shuffle: merges deal raw rows, which
#: become whole stage rows once they are scored and are sorted then.
FLOW_DEFAULTS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def flow_defaults(spark: SparkSession) -> None:
    """Set what the flow needs and the submitter left open."""
    for key, value in FLOW_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def local_session(app: str = "creditflow", cores: str | int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the checks rely on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        # Plans here are built from many small columns; do not record a call site for each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for key, value in FLOW_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster, or a scratch folder where none is set.

    Only a local master may fall back to a scratch folder of this machine, one per session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    made = spark.conf.get("spark.creditflow.scratch", None)
    if not made:
        made = tempfile.mkdtemp(prefix="creditflow-")
        spark.conf.set("spark.creditflow.scratch", made)
    return made
