"""Session helpers: shared staging folder, written intermediate tables, scan spreading."""

import os
import shutil
import tempfile
import uuid
import weakref
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: What a write has shuffled is deleted once it is done; without it such files stay until the driver collects its garbage.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_dirs = {}
_written = {}
_paths = weakref.WeakKeyDictionary()
_shipped = set()


def build_session(app="tagloom", cores="8", memory="12g", **conf):
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark):
    """The folder every executor can reach: the cluster's setting; only local sessions may go without."""
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if configured:
        return configured
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError(f"set {_SETTING} to a folder that the driver and all executors share")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tagloom-")
        spark.sparkContext.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]


def staged_path(spark, name):
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_staged(spark):
    """Delete what this application has staged so far; results that still read it must be done."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


def _delete(spark, path):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard(spark, *staged):
    """Delete staged tables, or staged paths, that no result reads any more."""
    for one in staged:
        path = one if isinstance(one, str) else _paths.pop(one)
        _delete(spark, path)
        _written[spark.sparkContext.applicationId].remove(path)


@contextmanager
def _meanwhile(spark, name, value):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def freed(spark):
    """Meanwhile what a write has moved goes as soon as it is written, as nothing reads it again."""
    return _meanwhile(spark, _FREED, "true")


def stage(df: DataFrame, name="stage", by=()) -> DataFrame:
    """Write `df` once to the shared folder and read it back; a reader that filters on `by` reads only what it asks for.

    Cuts the lineage and pins values that a recomputation could change, such as partition
    numbers. The table outlives lost executors. `discard` deletes it.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    with freed(spark):
        df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def settle(spark, make, name="stage") -> DataFrame:
    """Stage what `make` gives; all other tables that were staged for it, and nothing else reads, go."""
    written = _written.setdefault(spark.sparkContext.applicationId, [])
    before = set(written)
    table = stage(make(), name)
    discard(spark, *[path for path in written if path not in before and path != _paths[table]])
    return table


def joins_in_place(spark):
    """Meanwhile tables that are dealt alike by some of their join keys are joined where they lie, without being moved.

    What is run meanwhile counts, not what is planned: stage the result.
    """
    return _meanwhile(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


class Generations:
    """A table that is rewritten again and again: each version is written whole before the one before it goes."""

    def __init__(self, name):
        self.name = name
        self.path = None

    def advance(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        path = staged_path(spark, self.name)
        with freed(spark):
            df.write.parquet(path)
        if self.path:
            discard(spark, self.path)
        self.path = path
        return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys) -> DataFrame:
    """Repartition a scan that has fewer splits than the cluster has slots; else leave it alone."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots, *keys)


def ship_package(spark):
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tagloom-code-"), "tagloom")
    root, name = os.path.split(home)
    context.addPyFile(shutil.make_archive(target, "zip", root_dir=root, base_dir=name))
    _shipped.add(context.applicationId)
