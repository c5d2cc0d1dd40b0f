"""The six relations over raw objects."""

from rawscan.sources.delimited import csv_load
from rawscan.sources.json_lines import json_load
from rawscan.sources.listing import list_buckets, list_objects
from rawscan.sources.text import txt_load
from rawscan.sources.xml_rows import xml_load

__all__ = ["csv_load", "json_load", "list_buckets", "list_objects", "txt_load", "xml_load"]
