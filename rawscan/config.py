"""Connector properties and what they are called in a Hadoop configuration."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import urlparse

from rawscan import args
from rawscan.errors import RawScanError

#: Session setting: megabytes of a split where a loader's split_size_mb is -1. Unset, the session's own scan settings count.
DEFAULT_SPLIT = "rawscan.split.default-mb"
#: The store of an application that listings go to by HTTP; its keys are never put into a session's settings.
STORES: dict[str, StoreConfig] = {}
# Credential providers of the three ways to sign in.
_PROVIDERS = {
    "default": None,
    "static": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
    "anonymous": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider",
}


def _positive(properties, key, default, most=None):
    text = str(properties.get(key, default)).strip()
    if not text.lstrip("-").isdigit() or int(text) <= 0:
        raise RawScanError(f"{key} must be a positive integer")
    if most is not None and int(text) > most:
        raise RawScanError(f"{key} must be at most {most}")
    return int(text)


@dataclass(frozen=True)
class StoreConfig:
    """s3.* properties, checked. hadoop() gives the settings of the S3A file system."""

    region: str = "us-east-1"
    endpoint: str | None = None
    access_key: str | None = None
    secret_key: str | None = None
    auth_mode: str = "default"
    path_style_access: bool = True
    interceptor_class: str | None = None
    default_split_size_mb: int = 32
    max_connections: int = 5
    acquisition_timeout_s: int = 300

    @classmethod
    def of(cls, properties: dict[str, str]) -> StoreConfig:
        get = lambda key: (str(properties[key]).strip() or None) if properties.get(key) is not None else None
        access, secret = get("s3.access-key"), get("s3.secret-key")
        if (access is None) != (secret is None):
            raise RawScanError("s3.access-key and s3.secret-key must be set together")
        mode = (get("s3.auth-mode") or "default").lower()
        if mode not in _PROVIDERS:
            raise RawScanError("s3.auth-mode must be default, static or anonymous")
        if mode == "static" and access is None:
            raise RawScanError("s3.auth-mode static needs s3.access-key and s3.secret-key")
        style = (get("s3.path-style-access") or "true").lower()
        if style not in ("true", "false"):
            raise RawScanError("s3.path-style-access must be true or false")
        endpoint = get("s3.endpoint")
        if endpoint is not None and not (urlparse(endpoint).scheme and urlparse(endpoint).netloc):
            raise RawScanError("s3.endpoint must be a URI")
        return cls(
            get("s3.region") or "us-east-1",
            endpoint,
            access,
            secret,
            mode,
            style == "true",
            get("s3.interceptor-class"),
            _positive(properties, "s3.default-split-size-mb", 32, 2047),
            _positive(properties, "s3.max-connections-per-worker", 5),
            _positive(properties, "s3.connection-acquisition-timeout-s", 300),
        )

    def hadoop(self) -> dict[str, str]:
        provider = _PROVIDERS["static" if self.access_key and self.auth_mode == "default" else self.auth_mode]
        found = {
            "fs.s3a.endpoint.region": self.region,
            "fs.s3a.endpoint": self.endpoint,
            "fs.s3a.access.key": self.access_key,
            "fs.s3a.secret.key": self.secret_key,
            "fs.s3a.aws.credentials.provider": provider,
            "fs.s3a.path.style.access": str(self.path_style_access).lower(),
            "fs.s3a.connection.maximum": str(self.max_connections),
            "fs.s3a.connection.acquisition.timeout": f"{self.acquisition_timeout_s}s",
            "fs.s3a.audit.execution.interceptors": self.interceptor_class,
            "fs.s3a.change.detection.source": "etag",
            "fs.s3a.change.detection.mode": "server",
        }
        return {k: v for k, v in found.items() if v is not None}

    def listing(self) -> dict[str, str]:
        """The options of a listing over HTTP."""
        signs = self.access_key and self.auth_mode != "anonymous"
        return {
            "endpoint": self.endpoint or f"https://s3.{self.region}.amazonaws.com",
            "region": self.region,
            "access": self.access_key if signs else "",
            "secret": self.secret_key if signs else "",
            "pathStyle": str(self.path_style_access).lower(),
            "timeout": str(self.acquisition_timeout_s),
        }

    def apply(self, spark) -> None:
        """Puts the settings into the application's Hadoop configuration, and the loaders' default split size and store into the session."""
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for k, v in self.hadoop().items():
            hadoop.set(k, v)
        spark.conf.set(DEFAULT_SPLIT, str(self.default_split_size_mb))
        if self.endpoint or self.access_key or self.auth_mode == "anonymous":  # else the default chain signs, which is S3A's
            STORES[spark.sparkContext.applicationId] = self


def split_bytes(spark, value) -> int | None:
    """Bytes of a loader's splits: its own argument, else the connector's default, else None."""
    default = spark.conf.get(DEFAULT_SPLIT, None)
    return args.split_size_bytes(value, int(default) << 20 if default else None)
