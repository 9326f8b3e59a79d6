"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None, app: str = "spendscope", partitions: int | None = None, **conf: object
) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` adds or overrides.

    Keyword names use ``__`` for the dots of Spark's own keys. ``partitions`` is the shuffle
    width before adaptive execution merges small partitions: about one for every 200 MB of the
    largest shuffle.
    """
    builder = (
        SparkSession.builder.appName(app)
        # Gaps and hours must not move with the machine's zone.
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Recording the Python line of every column expression slows down building long plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


_local_root: str | None = None
_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    Only a session inside one process may fall back to a temporary folder of this machine.
    """
    global _local_root
    master = spark.sparkContext.master
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root and root.startswith("file:") and not master.startswith("local"):
        raise ValueError(f"executors do not share {root}; set spark.checkpoint.dir to a folder that they do")
    if not root:
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _local_root = _local_root or tempfile.mkdtemp(prefix="spendscope-")
        root = _local_root
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back; this runs a job.

    Later queries start from the table instead of repeating the work, lost executors cost
    nothing, and the planner knows the size: it broadcasts the table in a join only when
    that is below ``spark.sql.autoBroadcastJoinThreshold``. ``options`` go to the writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_mark() -> int:
    """How many scratch tables there are; what is written later can be dropped from here on."""
    return len(_written)


def drop_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the scratch tables that this process has written since ``scratch_mark()``, but for the last ``keep``.

    Results that still read them must have been written or read before.
    """
    until = max(since, len(_written) - keep)
    for path in _written[since:until]:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    del _written[since:until]
