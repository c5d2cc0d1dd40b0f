"""Buckets and objects as relations."""

from __future__ import annotations

from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawscan import args, config, storage
from rawscan.shipping import ship
from rawscan.sources import store_listing

#: Rows of a page of a listing.
PAGE = 1024


def _paged(spark: SparkSession, rows, schema: str) -> DataFrame:
    """The rows as a DataFrame, page by page, so that the driver holds Arrow pages and not objects."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_schema(_parse_datatype_string(schema))
    pages = []
    while page := list(islice(rows, PAGE)):
        pages.append(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*page, strict=True), kind, strict=True)], schema=kind))
    return spark.createDataFrame(pa.Table.from_batches(pages, kind))


def _over_http(spark: SparkSession, **options: str) -> DataFrame | None:
    """The listing as pages over HTTP, where the session's buckets are those of a store that config.STORES knows."""
    store = config.STORES.get(spark.sparkContext.applicationId)
    if store is None or spark.conf.get(storage.ROOT, None):
        return None
    ship(spark)
    spark.dataSource.register(store_listing.ListingSource)
    return spark.read.format(store_listing.NAME).options(**store.listing(), **options).load()


def list_objects(
    spark: SparkSession, bucket: str, prefix: str = "", recursive_listing: str | bool = "true", include_prefixes: str | bool = "false"
) -> DataFrame:
    """path, bucket, key, name, parent, size, last_modified, etag, type of the bucket's objects whose keys begin with prefix.

    Without recursive_listing keys end at the next / after the prefix; the prefixes that this makes are rows of type
    `prefix`, without size, date and etag, where include_prefixes asks for them.

    A store that was set by StoreConfig.apply is listed while rows are read, a page at a time by one task, so that LIMIT
    stops the listing; other file systems are listed folder by folder when this is called.
    """
    name, start = args.bucket(bucket), args.prefix(prefix)
    deep, shown = args.optional_boolean("RECURSIVE_LISTING", recursive_listing, True), args.optional_boolean("INCLUDE_PREFIXES", include_prefixes, False)
    rows = _over_http(spark, bucket=name, prefix=start, recursive=str(deep).lower(), prefixes=str(shown).lower())
    if rows is None:
        found = storage.objects(spark, name, start, deep)
        rows = _paged(spark, ((name, k, s, m, e, k.endswith("/")) for k, s, m, e in found if shown or not k.endswith("/")), store_listing.OBJECTS)
    bare = F.regexp_replace("key", "/$", "")
    return rows.select(
        F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key").alias("path"),
        "bucket",
        "key",
        F.regexp_extract(bare, "[^/]*$", 0).alias("name"),
        F.regexp_extract(bare, "^(?:.*/)?", 0).alias("parent"),
        "size",
        F.timestamp_millis("modified").alias("last_modified"),
        "etag",
        F.when(F.col("prefix"), "prefix").otherwise("object").alias("type"),
    )


def list_buckets(spark: SparkSession) -> DataFrame:
    """path, bucket, creation_date of each bucket."""
    rows = _over_http(spark)
    if rows is None:
        rows = _paged(spark, iter(storage.buckets(spark)), store_listing.BUCKETS)
    return rows.select(
        F.concat(F.lit("s3://"), "bucket").alias("path"), "bucket", F.timestamp_millis("created").alias("creation_date")
    )
