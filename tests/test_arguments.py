"""Arguments and connector properties."""

import pytest

from rawscan import args, config
from rawscan.config import StoreConfig
from rawscan.errors import RawScanError
from rawscan.storage import parse_uri


@pytest.mark.parametrize("given, name", [(None, "UTF-8"), ("", "UTF-8"), (" latin1 ", "ISO-8859-1"), ("Utf-16Be", "UTF-16BE"), ("UTF-16", "UTF-16"), ("windows-1250", "cp1250"), ("ASCII", "ascii")])
def test_charset_names(given, name):
    assert args.charset(given) == name


@pytest.mark.parametrize("given", ["klingon", "hex", 5])
def test_charsets_that_are_none(given):
    with pytest.raises(RawScanError):
        args.charset(given)


def test_object_addresses():
    assert parse_uri("s3://quay/2024/05/log.gz") == ("quay", "2024/05/log.gz") and parse_uri("s3a://q/a b") == ("q", "a b")
    for bad in ("ftp://quay/log", "s3://", "s3://quay", "s3://quay/", "quay/log"):
        with pytest.raises(RawScanError):
            parse_uri(bad)


@pytest.mark.parametrize("given, found", [("x\\r\\ny", "x\r\ny"), ("\\t", "\t"), ("\\\\n", "\\n"), ("\\q", "q"), ("y\\", "y\\"), ("::", "::")])
def test_record_separators(given, found):
    assert args.line_break(given) == found


@pytest.mark.parametrize("given, default, found", [(-1, None, None), (None, 7, 7), (-1, 9 << 20, 9 << 20), (5, 7, 5 << 20), (2047, None, 2047 << 20)])
def test_split_sizes(given, default, found):
    assert args.split_size_bytes(given, default) == found


@pytest.mark.parametrize("given", [0, -3, 4096, "5", False])
def test_split_sizes_that_are_none(given):
    with pytest.raises(RawScanError):
        args.split_size_bytes(given)


@pytest.mark.parametrize("given, found", [("True ", True), (" FALSE", False), (" ", None), (None, None), (False, False)])
def test_yes_and_no(given, found):
    assert args.optional_boolean("OPEN", given, None) is found


@pytest.mark.parametrize("call", [
    lambda: args.require_path(None), lambda: args.require_path(" "), lambda: args.require_path(9), lambda: args.optional_boolean("OPEN", "1", False),
    lambda: args.delimiter("::"), lambda: args.delimiter(""), lambda: args.sample_rows(0), lambda: args.sample_rows(1 << 31), lambda: args.line_break(""),
    lambda: args.row_element("  "), lambda: args.bucket(""), lambda: args.bucket("s3://q"), lambda: args.prefix("/q"), lambda: args.prefix("s3://q/r"),
])
def test_arguments_that_fail(call):
    with pytest.raises(RawScanError):
        call()


def test_store_properties():
    plain = StoreConfig.of({})
    assert (plain.region, plain.max_connections, plain.acquisition_timeout_s, plain.default_split_size_mb) == ("us-east-1", 5, 300, 32)
    own = StoreConfig.of({"s3.endpoint": "https://quay:9443", "s3.access-key": "u", "s3.secret-key": "v", "s3.path-style-access": "False", "s3.interceptor-class": "org.quay.Trace", "s3.max-connections-per-worker": "12"})
    found = own.hadoop()
    assert found["fs.s3a.endpoint"] == "https://quay:9443" and found["fs.s3a.secret.key"] == "v" and found["fs.s3a.connection.maximum"] == "12"
    assert found["fs.s3a.path.style.access"] == "false" and "Simple" in found["fs.s3a.aws.credentials.provider"] and found["fs.s3a.audit.execution.interceptors"] == "org.quay.Trace"
    assert own.listing()["pathStyle"] == "false" and own.listing()["access"] == "u"
    anonymous = StoreConfig.of({"s3.auth-mode": "anonymous", "s3.access-key": "u", "s3.secret-key": "v"})
    assert "Anonymous" in anonymous.hadoop()["fs.s3a.aws.credentials.provider"] and anonymous.listing()["access"] == ""


def test_store_properties_reach_the_application(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        StoreConfig.of({"s3.region": "eu-quay-1", "s3.default-split-size-mb": "3"}).apply(spark)
        assert spark.sparkContext._jsc.hadoopConfiguration().get("fs.s3a.endpoint.region") == "eu-quay-1"
        assert config.split_bytes(spark, -1) == 3 << 20 and config.split_bytes(spark, 8) == 8 << 20
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before and not config.STORES
    finally:
        spark.conf.unset(config.DEFAULT_SPLIT)
    assert config.split_bytes(spark, -1) is None


@pytest.mark.parametrize("properties", [{"s3.secret-key": "v"}, {"s3.auth-mode": "guess"}, {"s3.auth-mode": "static"}, {"s3.endpoint": "quay"}, {"s3.path-style-access": "maybe"}, {"s3.default-split-size-mb": "-4"}, {"s3.default-split-size-mb": "2048"}, {"s3.max-connections-per-worker": "many"}, {"s3.connection-acquisition-timeout-s": "0"}])
def test_store_properties_that_fail(properties):
    with pytest.raises(RawScanError):
        StoreConfig.of(properties)
