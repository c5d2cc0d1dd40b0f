"""Lines of new objects as a stream: the same records as txt_load, object after object as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawscan import args
from rawscan.errors import RawScanError
from rawscan.sources.text import decoded, separator
from rawscan.storage import located


def txt_stream(spark: SparkSession, folder: str, line_break: str = "\\n", encoding: str = "UTF-8", files_per_trigger: int = 1000) -> DataFrame:
    """line and path of each record of the objects in a folder; Structured Streaming keeps track of what was read."""
    charset = args.charset(encoding)
    sep = separator(args.line_break(line_break), charset)
    if sep is None:
        raise RawScanError("This separator can't be read as a stream in this encoding")
    scan = spark.readStream.option("lineSep", sep).option("maxFilesPerTrigger", files_per_trigger).text(located(spark, args.require_path(folder)))
    return scan.select(decoded(F.col("value"), charset).alias("line"), F.col("_metadata.file_path").alias("path"))
