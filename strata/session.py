"""Session factory and shared-storage helpers.

Operators never create sessions; only entry points and tests call
:func:`build_session`.  Everything that must survive the loss of an
executor (checkpoints, staging tables, streaming state) goes below the
folder named by ``spark.checkpoint.dir``, which on a cluster points at
shared storage.  Only when that setting is absent (local runs, tests) do we
create a local folder and register it.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Shuffle partition size aimed at: big enough to amortise task overhead,
# small enough to sort and aggregate in executor memory without heavy spill.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024

# What a task of a stage driver gets at most: bytes of a shuffle, and of a scan.
TASK_SHUFFLE_BYTES = 8 * 1024 * 1024
TASK_SCAN_BYTES = 32 * 1024 * 1024
PARQUET_CODEC = "spark.sql.parquet.compression.codec"

# Settings that matter for the plans built in this package.  Shuffle width:
# start wide (see ``shuffle_partitions_for``), let AQE coalescing shrink small
# stages and split skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings that a session needs for tables of a format that is not built in.
TABLE_FORMATS = {
    "delta": {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    },
}


def table_format_conf(table_format: str, packages: str | None = None, extensions: str = "") -> dict[str, str]:
    """Extension and catalog settings of a table format.

    ``packages`` names the connector (Maven coordinates) where the launcher
    does not bring it; ``extensions`` are further ones that the session loads,
    named after the format's own.
    """
    if table_format not in TABLE_FORMATS:
        raise ValueError(f"table_format must be one of {sorted(TABLE_FORMATS)}")
    conf = dict(TABLE_FORMATS[table_format])
    named = [e for e in extensions.split(",") if e and e != conf["spark.sql.extensions"]]
    conf["spark.sql.extensions"] = ",".join([conf["spark.sql.extensions"], *named])
    return conf | ({"spark.jars.packages": packages} if packages else {})


def session_conf(
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    shuffle_bytes: int | None = None,
    table_format: str | None = None,
    packages: str | None = None,
) -> dict[str, str]:
    """All settings of :func:`build_session`, for a launcher or a test; later ones win."""
    conf = dict(DEFAULT_CONF)
    if shuffle_bytes is not None:
        conf |= sizing_conf(shuffle_bytes)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf |= extra_conf or {}
    if table_format is not None:
        conf |= table_format_conf(table_format, packages, conf.get("spark.sql.extensions", ""))
    return conf


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Initial shuffle width for a job whose largest shuffle moves ``shuffle_bytes``.

    AQE can merge small partitions after a stage ran but cannot split large
    ones (apart from skewed join partitions), so the initial width has to fit
    the largest shuffle: 100 TB at 256 MiB per partition is about 400k.
    """
    return max(1, -(-int(shuffle_bytes) // int(target_bytes)))


def sizing_conf(shuffle_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Shuffle settings for an expected largest-shuffle volume."""
    n = str(shuffle_partitions_for(shuffle_bytes, target_bytes))
    return {
        "spark.sql.shuffle.partitions": n,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": n,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(target_bytes)),
        "spark.sql.files.maxPartitionBytes": str(min(int(target_bytes), 256 * 1024 * 1024)),
    }


def build_session(
    app_name: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    shuffle_bytes: int | None = None,
    table_format: str | None = None,
    packages: str | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the package defaults.

    ``master`` is only set when given, so on a cluster the launcher decides.
    ``shuffle_bytes`` (the expected size of the largest shuffle) sizes the
    initial shuffle width; without it the launcher's or Spark's setting stays.
    ``table_format="delta"`` adds the format's extension and catalog, for a
    ``LayerStore(..., fmt="delta")``; a running session cannot take them up.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in session_conf(shuffle_partitions, extra_conf, shuffle_bytes, table_format, packages).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def own_session(spark: SparkSession) -> SparkSession:
    """A new session with the same settings: what is set there leaves the caller's session alone."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    folder = ensure_checkpoint_dir(spark)
    if not session.conf.get(CHECKPOINT_CONF, None):  # set for the caller's session only
        session.conf.set(CHECKPOINT_CONF, folder)
    return session


@contextmanager
def in_own_session(df: DataFrame) -> Iterator[tuple[SparkSession, DataFrame]]:
    """``df`` in a session of its own with the same settings.

    What is set there changes for this frame only: other jobs of the caller's
    session, and other frames handled so at the same time, keep theirs.
    """
    spark = df.sparkSession
    session, view = own_session(spark), f"strata_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        yield session, session.table(f"{spark.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)


def _bytes(spark: SparkSession, key: str) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))


def sized_session(
    spark: SparkSession, input_bytes: int, shuffle_bytes: int = TASK_SHUFFLE_BYTES, scan_bytes: int = TASK_SCAN_BYTES
) -> SparkSession:
    """:func:`own_session` for a stage over ``input_bytes`` of stored tables.

    AQE merges small shuffle partitions up to its advisory size, which counts
    compressed bytes; a task that joins and aggregates them holds twenty times
    as much.  Here a task gets at most ``shuffle_bytes`` of a shuffle and about
    ``scan_bytes`` of a scan, and shuffles are wide enough for the input, so a
    larger input means more tasks, not larger ones.  Settings that are finer
    already stay.  What is stored takes less room where no codec was chosen.

    Before it runs, a plan only knows the compressed bytes of files, of which
    the rows in a broadcast hash table take up to fifty times as much.  So the
    threshold is low then, and higher for the sizes that AQE has measured.
    """
    session = own_session(spark)
    static, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    if not spark.conf.get(measured, None):  # unset, it follows the other
        session.conf.set(measured, spark.conf.get(static))
    limits = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": shuffle_bytes,
        "spark.sql.files.maxPartitionBytes": scan_bytes,
        static: shuffle_bytes // 16,
        measured: shuffle_bytes // 2,
    }
    for key, most in limits.items():
        if not session.conf.get(key).startswith("-"):  # a negative threshold: no broadcast at all
            session.conf.set(key, str(min(_bytes(session, key), most)))
    initial, width = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffle_partitions_for(input_bytes, shuffle_bytes)
    for key in ("spark.sql.shuffle.partitions", *([initial] if spark.conf.get(initial, None) else [])):
        session.conf.set(key, str(max(int(spark.conf.get(key)), width)))
    if spark.conf.get(PARQUET_CODEC) == "snappy":
        session.conf.set(PARQUET_CODEC, "zstd")
    return session


def _conf_get(spark: SparkSession, key: str) -> str | None:
    value = spark.conf.get(key, None)
    if value:
        return value
    try:
        return spark.sparkContext.getConf().get(key, None)
    except Exception:  # Spark Connect has no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    Where ``spark.checkpoint.dir`` is unset, a single-process session
    (``local[...]``) gets a temporary folder that goes with the process; any
    other master raises, as its executors could not see the driver's folder.
    """
    path = _conf_get(spark, CHECKPOINT_CONF)
    if not path:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors of {master} share")
        path = tempfile.mkdtemp(prefix="strata-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set(CHECKPOINT_CONF, path)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)
    except Exception:
        pass
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, deleted when the session's JVM ends.

    Frames read from it are lazy, so it cannot go earlier.
    """
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{folder}/data"
