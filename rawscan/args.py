"""Validation of loader arguments."""

from __future__ import annotations

from rawscan.errors import RawScanError

_MEGABYTE = 1 << 20
_MOST_BYTES = (1 << 31) - 1
# Charsets that Spark decodes itself, by lower-case name. UTF-16 goes by the object's byte order mark.
CHARSETS = {
    "utf-8": "UTF-8", "utf8": "UTF-8", "iso-8859-1": "ISO-8859-1", "latin1": "ISO-8859-1", "latin-1": "ISO-8859-1",
    "utf-16le": "UTF-16LE", "utf-16be": "UTF-16BE", "utf-16": "UTF-16", "utf16": "UTF-16",
}


def require_string(name: str, value) -> str:
    if value is None:
        raise RawScanError(f"Argument {name} is required")
    if not isinstance(value, str):
        raise RawScanError(f"Argument {name} must be a string")
    return value


def require_path(value) -> str:
    if not require_string("PATH", value).strip():
        raise RawScanError("PATH cannot be blank")
    return value


def optional_boolean(name: str, value, default: bool) -> bool:
    """Booleans come as bool or as the text true or false in any case; blank means the default."""
    if value is None:
        return default
    if isinstance(value, bool):
        return value
    text = require_string(name, value).strip().lower()
    if not text:
        return default
    if text not in ("true", "false"):
        raise RawScanError(f"Argument {name} must be true or false")
    return text == "true"


def split_size_bytes(value, default: int | None = None) -> int | None:
    """Bytes of a split; the default where -1 or nothing is given. None leaves the choice to the session."""
    if value is None or value == -1:
        return default
    if isinstance(value, bool) or not isinstance(value, int):
        raise RawScanError("Argument SPLIT_SIZE_MB must be an integer")
    if value <= 0:
        raise RawScanError("SPLIT_SIZE_MB must be positive")
    if value * _MEGABYTE > _MOST_BYTES:
        raise RawScanError("SPLIT_SIZE_MB is too large")
    return value * _MEGABYTE


def charset(value) -> str:
    """The canonical name of a charset, or Python's name of one that CHARSETS doesn't have; blank means UTF-8."""
    if value is None or not require_string("ENCODING", value).strip():
        return "UTF-8"
    name = value.strip()
    if name.lower() in CHARSETS:
        return CHARSETS[name.lower()]
    import codecs

    try:
        found = codecs.lookup(name)
    except LookupError:
        raise RawScanError(f"Unsupported encoding: {name}") from None
    if not found._is_text_encoding:
        raise RawScanError(f"Unsupported encoding: {name}")
    return found.name


def sample_rows(value) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or not 1 <= value < 1 << 31:
        raise RawScanError("SCHEMA_SAMPLE_ROWS must be between 1 and 2147483647")
    return value


def delimiter(value) -> str:
    if len(require_string("DELIMITER", value)) != 1:
        raise RawScanError("DELIMITER must be exactly one character")
    return value


def line_break(value) -> str:
    """The record separator with \\n, \\r, \\t and \\\\ decoded; other escapes are the character, a last backslash stays."""
    known, out, i = {"n": "\n", "r": "\r", "t": "\t", "\\": "\\"}, [], 0
    text = require_string("LINE_BREAK", value)
    while i < len(text):
        if text[i] == "\\" and i + 1 < len(text):
            out.append(known.get(text[i + 1], text[i + 1]))
            i += 2
        else:
            out.append(text[i])
            i += 1
    if not out:
        raise RawScanError("LINE_BREAK cannot be empty")
    return "".join(out)


def row_element(value) -> str:
    if not require_string("ROW_ELEMENT", value).strip():
        raise RawScanError("ROW_ELEMENT cannot be empty")
    return value.strip()


def bucket(value) -> str:
    name = require_string("BUCKET", value).strip()
    if not name:
        raise RawScanError("BUCKET cannot be blank")
    if "://" in name:
        raise RawScanError("BUCKET must be a name, not a URI")
    return name


def prefix(value) -> str:
    text = "" if value is None else require_string("PREFIX", value)
    if text.startswith("s3://"):
        raise RawScanError("PREFIX must be a key prefix, not a URI")
    if text.startswith("/"):
        raise RawScanError("PREFIX must not begin with /")
    return text
