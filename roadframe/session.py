"""Session helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written against. ANSI stays on (Spark 4
# default): every lossy conversion in the library uses try_* functions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "roadframe", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the library defaults.

    On a cluster the session normally exists already (spark-submit); then
    nothing is changed except what ``extra`` asks for.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in (extra or {}).items():
            active.conf.set(k, v)
        return active
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session (the setting, or a folder set with
    ``setCheckpointDir``). Only a local session, whose driver and tasks share
    one machine, gets a folder of its own when none is set; on a cluster a
    machine-local folder would differ on every machine, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    d = d or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="roadframe-checkpoints-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/roadframe-{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a staged table of ``scratch_path`` that nothing reads any more."""
    if not path.startswith(f"{checkpoint_dir(spark).rstrip('/')}/roadframe-"):
        raise ValueError(f"not a staged table: {path}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (shared storage) — survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


#: Largest method that the JVM compiles, in bytes of its code; longer ones are interpreted.
JIT_LIMIT = "8000"


def limit_generated_code(spark: SparkSession) -> None:
    """Have Spark generate no method that the JVM will not compile, unless the session sets a limit of its own.

    A stage whose one method would be longer runs operator by operator, in short methods. Wide projections
    (the user table, its one-hot columns) pass the limit, and interpreting them took most of their time.
    """
    conf = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(conf, None) in (None, "65535"):
        spark.conf.set(conf, JIT_LIMIT)


def share_partitions(spark: SparkSession) -> None:
    """Let joins on several keys use rows that lie together by one of them, and let shuffle files go when the job that made them ends.

    By default a join on (vehicle, accident) shuffles rows again that lie together by accident, and shuffle files
    stay until the driver collects its garbage. A session's own settings stay.
    """
    for conf, default, wanted in (("spark.sql.requireAllClusterKeysForCoPartition", "true", "false"),
                                  ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false", "true")):
        if spark.conf.get(conf, default) == default:
            spark.conf.set(conf, wanted)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
