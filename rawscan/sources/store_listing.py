"""Listings of a store over HTTP, page by page, as a Python data source: rows are made while they are read."""

from __future__ import annotations

import hashlib
import hmac
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote, urlsplit
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader

from rawscan.errors import RawScanError

NAME = "rawscan_listing"
#: Keys that are asked for at a time, and how often a page is asked for when the store is busy or out of reach.
PAGE, TRIES = 1000, 4
OBJECTS = "bucket string, key string, size bigint, modified bigint, etag string, prefix boolean"
BUCKETS = "bucket string, created bigint"
_SCHEMAS = {
    OBJECTS: pa.schema([("bucket", pa.string()), ("key", pa.string()), ("size", pa.int64()), ("modified", pa.int64()), ("etag", pa.string()), ("prefix", pa.bool_())]),
    BUCKETS: pa.schema([("bucket", pa.string()), ("created", pa.int64())]),
}


def signed(method: str, url: str, region: str, access: str, secret: str, now: datetime) -> dict[str, str]:
    """Headers of a request without body, signed by version 4 of the signing process of S3."""
    parts, stamp = urlsplit(url), now.strftime("%Y%m%dT%H%M%SZ")
    scope = f"{stamp[:8]}/{region}/s3/aws4_request"
    empty = hashlib.sha256(b"").hexdigest()
    headers = {"host": parts.netloc, "x-amz-content-sha256": empty, "x-amz-date": stamp}
    names = ";".join(sorted(headers))
    listed = "".join(f"{k}:{headers[k]}\n" for k in sorted(headers))
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    asked = "\n".join([method, parts.path or "/", query, listed, names, empty])
    to_sign = "\n".join(["AWS4-HMAC-SHA256", stamp, scope, hashlib.sha256(asked.encode()).hexdigest()])
    key = f"AWS4{secret}".encode()
    for part in (*scope.split("/"), to_sign):
        key = hmac.new(key, part.encode(), hashlib.sha256).digest()
    return headers | {"authorization": f"AWS4-HMAC-SHA256 Credential={access}/{scope}, SignedHeaders={names}, Signature={key.hex()}"}


class Store:
    """What a listing needs of a store: plain texts, so that it can travel in a data source's options."""

    def __init__(self, options: dict[str, str]):
        self.endpoint = options["endpoint"].rstrip("/")
        self.region, self.access, self.secret = options.get("region", "us-east-1"), options.get("access", ""), options.get("secret", "")
        self.path_style, self.timeout = options.get("pathstyle", "true") == "true", float(options.get("timeout", "300"))

    def url(self, bucket: str, query: dict[str, str]) -> str:
        base = self.endpoint
        if bucket and self.path_style:
            base += f"/{quote(bucket)}"
        elif bucket:
            scheme, host = base.split("://", 1)
            base = f"{scheme}://{bucket}.{host}"
        pairs = "&".join(f"{quote(k, safe='')}={quote(v, safe='')}" for k, v in sorted(query.items()))
        return f"{base}/" + (f"?{pairs}" if pairs else "")

    def page(self, bucket: str, query: dict[str, str]) -> ElementTree.Element:
        """The root of the answer; refusals fail at once, a busy or silent store is asked again."""
        url = self.url(bucket, query)
        for attempt in range(TRIES):
            headers = signed("GET", url, self.region, self.access, self.secret, datetime.now(UTC)) if self.access else {}
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=self.timeout) as answer:
                    return ElementTree.fromstring(answer.read())
            except urllib.error.HTTPError as e:
                if e.code == 404:
                    raise RawScanError(f"Bucket not found: {bucket}") from e
                if e.code < 500 or attempt == TRIES - 1:
                    raise RawScanError(f"The store refused the listing: {e.code}") from e
            except OSError as e:
                if attempt == TRIES - 1:
                    raise RawScanError(f"The store can't be reached: {e}") from e
            time.sleep(0.2 * 2**attempt)
        raise AssertionError


def _text(node: ElementTree.Element, name: str) -> str | None:
    return next((x.text or "" for x in node if x.tag.rpartition("}")[2] == name), None)


def _all(node: ElementTree.Element, name: str) -> list[ElementTree.Element]:
    return [x for x in node.iter() if x.tag.rpartition("}")[2] == name]


def _millis(text: str | None) -> int | None:
    return None if not text else round(datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp() * 1000)


def object_pages(store: Store, bucket: str, prefix: str, recursive: bool, with_prefixes: bool) -> Iterator[list[tuple]]:
    """A list of rows of OBJECTS for each page of the store, whose order is that of the keys."""
    query = {"list-type": "2", "prefix": prefix, "max-keys": str(PAGE)} | ({} if recursive else {"delimiter": "/"})
    token = None
    while True:
        root = store.page(bucket, query | ({"continuation-token": token} if token else {}))
        rows = [
            (bucket, _text(x, "Key"), int(_text(x, "Size") or 0), _millis(_text(x, "LastModified")), (_text(x, "ETag") or "").strip('"') or None, False)
            for x in _all(root, "Contents")
        ]
        if with_prefixes:
            rows += [(bucket, _text(x, "Prefix"), None, None, None, True) for x in _all(root, "CommonPrefixes")]
        yield sorted(rows, key=lambda r: r[1].encode())
        token = _text(root, "NextContinuationToken")
        if _text(root, "IsTruncated") != "true" or not token:
            return


def bucket_pages(store: Store) -> Iterator[list[tuple]]:
    """A list of rows of BUCKETS for each page of the store."""
    token = None
    while True:
        root = store.page("", {"continuation-token": token} if token else {})
        yield [(_text(x, "Name"), _millis(_text(x, "CreationDate"))) for x in _all(root, "Bucket")]
        token = _text(root, "ContinuationToken")
        if not token:
            return


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def read(self, partition):
        o = self.options
        store, kind = Store(o), OBJECTS if "bucket" in o else BUCKETS
        pages = object_pages(store, o["bucket"], o["prefix"], o["recursive"] == "true", o["prefixes"] == "true") if kind == OBJECTS else bucket_pages(store)
        for page in pages:
            if page:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*page, strict=True), _SCHEMAS[kind], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMAS[kind])


class ListingSource(DataSource):
    """Objects of a bucket, or the buckets. A task follows the store's pages and hands each on before it asks for the
    next one, so that a LIMIT ends the listing."""

    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return OBJECTS if "bucket" in self.options else BUCKETS

    def reader(self, schema):
        return _Reader(dict(self.options))
