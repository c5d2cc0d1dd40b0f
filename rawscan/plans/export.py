"""Tables of the test data as raw objects: what the registered queries load."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from rawscan import storage


def store(spark: SparkSession, sf_dir: str) -> str:
    """The object store of a data folder, set as the session's: in the shared folder, under a name that follows from the
    sizes and dates of the folder's files, so that changed tables are exported anew."""
    fs, at = storage.file_system(spark, sf_dir)
    files = sorted(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}" for f in fs.listStatus(at))
    name = hashlib.sha256("\n".join([sf_dir.rstrip("/"), *files]).encode()).hexdigest()[:12]
    root = f"{storage.shared_dir(spark)}/rawscan-{name}"
    spark.conf.set(storage.ROOT, root)
    return root


def exported(spark: SparkSession, sf_dir: str, bucket: str, key: str, rows) -> str:
    """s3://bucket/key, made by rows() -> DataFrame of one text column (or bytes) unless it exists."""
    target = f"{store(spark, sf_dir)}/{bucket}/{key}"
    fs, at = storage.file_system(spark, target)
    if not fs.exists(at):
        made = rows()
        fs.mkdirs(at.getParent())
        if isinstance(made, bytes):
            _written(fs, storage.file_system(spark, target)[1], made)
        else:
            _one_file(spark, fs, made, at)
    return f"s3://{bucket}/{key}"


def _written(fs, at, raw: bytes) -> None:
    out = fs.create(at, True)
    out.write(bytearray(raw))
    out.close()


def _one_file(spark: SparkSession, fs, rows: DataFrame, at) -> None:
    folder = f"{at.getParent().getParent().toString()}/_export-{uuid.uuid4().hex}"
    rows.coalesce(1).write.text(folder)
    _, made = storage.file_system(spark, folder)
    part = next(s.getPath() for s in fs.listStatus(made) if s.getPath().getName().startswith("part-"))
    fs.rename(part, at)
    fs.delete(made, True)
