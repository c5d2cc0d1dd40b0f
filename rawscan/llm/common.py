"""What the operators share: intermediate tables in the shared folder, hot keys, and names that nobody has taken."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawscan.storage import file_system, shared_dir

#: Keys that are dealt out by salt. The list is broadcast; its length never depends on the data.
HOT_KEYS = 1000
#: Into how many parts a hot key is dealt.
SALTS = 64
#: Spark's default for the bytes of a batch between the JVM and Python, and what own jobs use in its place: a worker holds
#: a batch several times over, and an executor has as many workers as cores.
_BATCH, _DEFAULT, _BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "16m"
#: A driver's garbage is collected this many seconds after the last time at the earliest.
SETTLE_S = 3.0
#: The JVM's bean of diagnostic commands, and its command that trims the native heap.
_COMMANDS, _TRIM = "com.sun.management:type=DiagnosticCommand", "systemTrimNativeHeap"
_settled = [0.0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many _ behind it as it takes to be none of df's columns, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bounds the batches between the JVM and Python for the jobs inside, unless the session sets them itself."""
    default = spark.conf.get(_BATCH, _DEFAULT) == _DEFAULT
    if default:
        spark.conf.set(_BATCH, _BYTES)
    try:
        yield
    finally:
        if default:
            spark.conf.unset(_BATCH)


def settle(spark: SparkSession) -> None:
    """Has the driver's JVM collect its garbage after a step, and hand the native memory that is free back to the system. By itself it lets
    its heap grow to the limit first, with the plans and tasks of steps that are over, and the shuffle files and broadcasts that
    these hold stay as long; and what its compilers, decompressors and buffers have freed stays with the C library's allocator."""
    if time.monotonic() - _settled[0] >= SETTLE_S:
        gc.collect()  # Python's references to the JVM's objects
        _detach(spark)
        spark.sparkContext._jvm.System.gc()
        _trim(spark)
        _settled[0] = time.monotonic()


def _detach(spark: SparkSession) -> None:
    """Tells the JVM which of its objects Python has let go of; py4j's own thread does so up to a second later."""
    pending = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    while pending:
        try:
            task = pending.pop()
        except IndexError:  # that thread was faster
            return
        if not isinstance(task, tuple):  # the sign for that thread to end
            pending.appendleft(task)
            return
        client, target = task
        client.garbage_collect_object(target, False)


def _trim(spark: SparkSession) -> None:
    """malloc_trim in the driver's JVM, where it has a command for that (on Linux with glibc, from Java 17.0.9 on)."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    beans, name = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), jvm.javax.management.ObjectName(_COMMANDS)
    called = {m.getName(): m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() in ("isRegistered", "getMBeanInfo", "invoke")}

    def call(method: str, *given):  # by the interface, as the server's own class isn't open to reflection
        args = gateway.new_array(jvm.java.lang.Object, len(given))
        for i, x in enumerate(given):
            args[i] = x
        return called[method].invoke(beans, args)

    if call("isRegistered", name) and any(x.getName() == _TRIM for x in call("getMBeanInfo", name).getOperations()):
        call("invoke", name, _TRIM, None, None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: its lineage ends there, and lost executors cost nothing."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The table and its path. It goes with the application, or before by dropped()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, at = file_system(spark, path)
    fs.deleteOnExit(at)
    with small_batches(spark):
        df.write.parquet(path)
    settle(spark)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Deletes tables of stored_at that nothing reads any more."""
    for path in paths:
        fs, at = file_system(spark, path)
        fs.delete(at, True)


def hot_keys(keyed: DataFrame, key: str) -> DataFrame:
    """The HOT_KEYS most frequent values of key that occur more than once; any other has at most 1/HOT_KEYS of the rows."""
    return (
        keyed.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .orderBy(F.desc("_n"), key)
        .limit(HOT_KEYS)
        .select(key)
    )


def salted(keyed: DataFrame, hot: DataFrame, key: str, by: Column) -> DataFrame:
    """keyed with _salt: for hot keys dealt by the column `by` over SALTS values, else -1."""
    flagged = keyed.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    return flagged.withColumn("_salt", F.when(F.col("_hot"), F.pmod(by, F.lit(SALTS)).cast("int")).otherwise(-1)).drop("_hot")


def replicated(keyed: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """The other side of a join with salted(): one row for each salt of a hot key."""
    flagged = keyed.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(-1)))
    return flagged.withColumn("_salt", F.explode(salts)).drop("_hot")
