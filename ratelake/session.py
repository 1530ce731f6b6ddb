"""Session helpers: a local session for tests/bench and the shared scratch root.

On a cluster the session is built by the platform; we only *read*
``spark.checkpoint.dir`` from it. A local default is set only where the
setting is absent (tests, bench).
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName("ratelake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no context
        return None


def shared_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one; otherwise (local
    tests) creates a private folder and registers it as the checkpoint dir.
    """
    sc = _context(spark)
    conf = spark.conf.get(CHECKPOINT_CONF, None) or (sc.getCheckpointDir() if sc else None)
    if not conf:
        master = sc.master if sc else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a shared folder: scratch tables and lineage cuts "
                "must live where every executor can read them"
            )
        conf = tempfile.mkdtemp(prefix="ratelake-")
        if sc:
            sc.setCheckpointDir(conf)
        else:
            spark.conf.set(CHECKPOINT_CONF, conf)
    return conf.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists (Hadoop FS through the JVM, or a read probe)."""
    sc = _context(spark)
    if sc is not None:
        jvm = sc._jvm
        hp = jvm.org.apache.hadoop.fs.Path(path)
        return hp.getFileSystem(sc._jsc.hadoopConfiguration()).exists(hp)
    try:
        spark.read.format("binaryFile").load(path).limit(0).collect()
        return True
    except Exception:  # noqa: BLE001
        return False


def _file_system(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, at, at.getFileSystem(conf)


def make_folder(spark: SparkSession, path: str) -> None:
    _, _, at, fs = _file_system(spark, path)
    fs.mkdirs(at)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a few bytes under ``path`` so that readers see the old or the new text, never a part."""
    jvm, conf, at, fs = _file_system(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), conf).rename(fs.makeQualified(aside), fs.makeQualified(at), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The first 4 KB of a small file; None if there is none."""
    jvm, _, at, fs = _file_system(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readNBytes(4096)).decode()
    finally:
        stream.close()


def remove_path(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> None:
    """Delete a folder, or what is in it but for the names in ``keep``."""
    _, _, at, fs = _file_system(spark, path)
    if not keep:
        fs.delete(at, True)
        return
    for status in fs.listStatus(at):
        if status.getPath().getName() not in keep:
            fs.delete(status.getPath(), True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name under the shared root (Spark's writers create it)."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df, label: str):
    """Write ``df`` once as Parquet under the shared root and read it back.

    A written table cuts the lineage (executor loss no longer replays the
    upstream plan) and, unlike an eager ``checkpoint()`` of an uncached
    DataFrame, computes the input only once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def written_once(df, label: str):
    """``materialize`` for the length of a block: the table goes when the block ends."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        remove_path(spark, path)


#: Most shuffle partitions ``cluster_settings`` asks for: beyond it, map outputs
#: (one index entry per map task and partition) cost more than larger partitions.
MAX_SHUFFLE_PARTITIONS = 20_000


def cluster_settings(shuffle_bytes: int, executor_cores: int, executors: int) -> dict[str, str]:
    """Spark settings this design relies on, sized for a run's largest shuffle.

    * AQE re-plans at runtime: coalesces small shuffle partitions, splits skewed
      join partitions and turns a join into a broadcast only after measuring
      the smaller side.
    * Shuffle partitions follow the bytes that are *shuffled* (after partial
      aggregation a rollup of 100 TB shuffles a few rows per month), ~128 MB
      each, at least two waves of tasks, at most ``MAX_SHUFFLE_PARTITIONS``.
    * Scan splits of 256 MB keep task counts manageable on 100 TB inputs.
    """
    target = 128 * 1024 * 1024
    slots = max(1, executor_cores * executors)
    partitions = min(MAX_SHUFFLE_PARTITIONS, max(2 * slots, -(-shuffle_bytes // target)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
    }
