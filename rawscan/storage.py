"""Objects: their paths, what pins them, and listings, through Hadoop file systems."""

from __future__ import annotations

import re
import tempfile
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawscan.errors import RawScanError

#: Session setting: a folder whose sub-folders are the buckets. Unset, s3:// means S3A.
ROOT = "rawscan.store.root"


def parse_uri(uri: str) -> tuple[str, str]:
    """Bucket and key of s3://bucket/key or s3a://bucket/key."""
    m = re.fullmatch(r"s3a?://([^/]+)/(.+)", uri, re.S)
    if not m:
        raise RawScanError(f"Invalid S3 URI: {uri}")
    return m[1], m[2]


def located(spark: SparkSession, path: str) -> str:
    """The path that Spark's readers open; only s3 URIs are mapped, other schemes and plain paths stay."""
    if not re.match(r"s3a?://", path):
        if "://" in path and not re.match(r"(file|hdfs|viewfs|abfss?|gs|wasbs?)://", path):
            raise RawScanError(f"Invalid S3 URI: {path}")
        return path
    bucket, key = parse_uri(path)
    root = spark.conf.get(ROOT, None)
    return f"{root.rstrip('/')}/{bucket}/{key}" if root else f"s3a://{bucket}/{key}"


def file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Unset, a local one in local mode, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RawScanError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='rawscan-shared-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def head(spark: SparkSession, path: str, n: int) -> bytes:
    """The first n bytes of an object."""
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(b for b in (stream.read() for _ in range(n)) if b >= 0)
    finally:
        stream.close()


@dataclass(frozen=True)
class Pin:
    """The object as it was when its schema was decided; etag and version where the file system tells them."""

    path: str
    size: int
    modified_ms: int
    etag: str | None = None
    version: str | None = None


def _told(status, name: str) -> str | None:
    """What a status has to say beyond Hadoop's common fields; file systems without it have no such method in the JVM."""
    try:
        return getattr(status, name)()
    except Py4JError:
        return None


def pinned(spark: SparkSession, path: str) -> Pin:
    target = located(spark, path)
    fs, at = file_system(spark, target)
    if not fs.exists(at):
        raise RawScanError(f"Object not found: {path}")
    status = fs.getFileStatus(at)
    if status.isDirectory():
        raise RawScanError(f"PATH must name one object: {path}")
    return Pin(str(status.getPath().toString()), int(status.getLen()), int(status.getModificationTime()), _told(status, "getEtag"), _told(status, "getVersionId"))


def verify(spark: SparkSession, pin: Pin) -> None:
    """Fails where the object isn't any more what was pinned: for a caller that has read it to the end."""
    if pinned(spark, pin.path) != pin:
        raise RawScanError(f"Object changed during the query: {pin.path}")


def unchanged(scan: DataFrame, pin: Pin) -> DataFrame:
    """scan, failing on the first row if the file that it lists is not as it was pinned.

    This covers the time from the pin to the scan's own listing. Changes after that are the file system's to notice: S3A
    compares etags while it reads (see config); for others a caller can verify() the pin when it has its results.
    """
    same = (F.col("_metadata.file_size") == pin.size) & (F.unix_millis("_metadata.file_modification_time") == pin.modified_ms)
    return scan.where(F.when(same, True).otherwise(F.raise_error(F.lit(f"Object changed during the query: {pin.path}")).cast("boolean")))


def objects(spark: SparkSession, bucket: str, prefix: str, recursive: bool):
    """(key, size, modified ms, etag) of each object and (key/, None, None, None) of each prefix, in the order of keys.

    The listing goes through the bucket's Hadoop file system, which follows the store's pages. It is never sorted in
    more than a folder at a time.
    """
    base = located(spark, f"s3://{bucket}/x")[:-2]
    fs, top = file_system(spark, base)
    if not fs.exists(top):
        raise RawScanError(f"Bucket not found: {bucket}")
    root = fs.getFileStatus(top).getPath().toString().rstrip("/") + "/"

    def walk(folder: str):
        _, at = file_system(spark, root + folder)
        if not fs.exists(at) or not fs.getFileStatus(at).isDirectory():
            return
        found = []
        for status in fs.listStatus(at):
            key = status.getPath().toString()[len(root):] + ("/" if status.isDirectory() else "")
            found.append((key, status))
        for key, status in sorted(found, key=lambda x: x[0]):
            if not key.startswith(prefix) and not (status.isDirectory() and prefix.startswith(key)):
                continue
            if status.isDirectory():
                if recursive or not key.startswith(prefix):
                    yield from walk(key)
                else:
                    yield key, None, None, None
            else:
                yield key, int(status.getLen()), int(status.getModificationTime()), _told(status, "getEtag")

    yield from walk(prefix.rpartition("/")[0] + "/" if "/" in prefix else "")


def buckets(spark: SparkSession):
    """(name, created ms or None) of each bucket under the store's root, in the order of names."""
    root = spark.conf.get(ROOT, None)
    if not root:
        raise RawScanError(f"Buckets are listed under {ROOT}, which is not set")
    fs, at = file_system(spark, root)
    found = [(s.getPath().getName(), int(s.getModificationTime())) for s in fs.listStatus(at) if s.isDirectory()]
    return sorted(found)
