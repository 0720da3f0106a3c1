"""File and record-set sources.

* ``read_email_files``: one row per file, the whole file as one string;
* ``read_email_index``: one path per line, direction/address from the file name;
* ``read_poi_names``: '(y) Last, First' lines;
* ``poi_address_frame``: the fixed address list as a small broadcastable frame;
* ``records_to_frame`` / ``frame_to_records``: keyed record sets (id -> map of
  feature -> value) to a typed wide frame and back.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: A domain that another address follows without a separator: only a second
#: '@' shows that an entry holds two addresses; single addresses stay whole.
FUSED = r"(@[^@\s,;]*?\.(?:com|net|org|edu|gov|mil))(?=[^@\s,;.][^@\s,;]*@)"


def read_email_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, value): whole files, never split into lines."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value"))


def read_email_index(spark: SparkSession, path: str) -> DataFrame:
    """(direction, address, path, n_parts): one mail path per line; direction
    and address come from the file name 'from_<address>[.txt]' /
    'to_<address>[.txt]' -- or, for a Spark-written partitioned folder, from
    the partition directory 'name=from_<address>[.txt]'."""
    df = spark.read.text(path)
    fname = F.col("_metadata.file_name")
    parent = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2), "^[^=]*=", "")
    name = F.when(fname.rlike("^(from|to)_"), fname).otherwise(F.url_decode(parent))
    return parse_email_index(df.select(name.alias("name"), "value"))


def parse_email_index(lines: DataFrame) -> DataFrame:
    """(direction, address, path, n_parts) of lines (name of their file, value)."""
    pattern = "^(from|to)_(.+?)(\\.txt)?$"
    return (lines.select(F.regexp_extract("name", pattern, 1).alias("direction"),
                         F.regexp_extract("name", pattern, 2).alias("address"),
                         F.trim(F.col("value")).alias("path"))
            .filter(F.col("path") != "")
            .withColumn("n_parts", F.size(F.split(F.regexp_replace("path", "\\.$", ""), "/"))))


def parse_poi_names(lines: DataFrame, value: str = "value") -> DataFrame:
    """(flag, last, first) from '(y) Last, First' lines; other lines dropped."""
    pattern = "^\\((y|n)\\) ([^,]+), (.+)$"
    v = F.trim(F.col(value))
    return (lines.select(F.regexp_extract(v, pattern, 1).alias("flag"),
                         F.regexp_extract(v, pattern, 2).alias("last"),
                         F.regexp_extract(v, pattern, 3).alias("first"))
            .filter(F.col("flag") != ""))


def read_poi_names(spark: SparkSession, path: str) -> DataFrame:
    return parse_poi_names(spark.read.text(path))


def poi_address_frame(spark: SparkSession, addresses: Sequence[str]) -> DataFrame:
    """Lookup list as a one-column frame (size fixed by the list, so it may
    be broadcast).  Entries are trimmed and de-quoted; an entry holding two
    addresses fused without separator is split into both."""
    rows = []
    for a in addresses:
        a = a.strip().strip("'\"")
        parts = [p for p in re.sub(FUSED, r"\1 ", a.replace(",", " ").replace(";", " ")).split() if "@" in p]
        rows += [(p,) for p in (parts or [a])]
    return spark.createDataFrame(rows, "address string").distinct()


def normalize_addresses(df: DataFrame, column: str = "address") -> DataFrame:
    """Address list cleaning as a DataFrame operation: trim, drop quotes, and
    split entries that hold several addresses (e.g. two fused without a
    separator) into one row each; distinct."""
    text = F.regexp_replace(F.trim(F.col(column)), "[\'\"]", "")
    apart = F.split(F.regexp_replace(text, FUSED, "$1 "), "[\\s,;]+")
    found = F.filter(apart, lambda a: F.contains(a, F.lit("@")))
    return (df.select(F.explode(F.when(F.size(found) > 0, found).otherwise(F.array(text))).alias("address"))
            .filter(F.col("address") != "").distinct())


def records_to_frame(records: DataFrame, features: Sequence[str], key: str = "id",
                     values: str = "values", types: dict | None = None) -> DataFrame:
    """Keyed records ``(key, MAP<feature, text>)`` -> wide frame with one
    column per requested feature (missing key -> null), cast per ``types``."""
    types = types or {}
    cols = []
    for f in features:
        c = F.element_at(F.col(values), F.lit(f))
        cols.append((c.try_cast(types[f]) if f in types else c).alias(f))
    return records.select(F.col(key), *cols)


def frame_to_records(df: DataFrame, key: str = "id", values: str = "values") -> DataFrame:
    """Wide frame -> ``(key, MAP<feature, text>)`` (nulls kept as 'NaN')."""
    feats = [c for c in df.columns if c != key]
    return df.select(F.col(key), F.map_from_arrays(
        F.array(*[F.lit(c) for c in feats]),
        F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("NaN")) for c in feats])).alias(values))


MAP_TYPE = T.MapType(T.StringType(), T.StringType())
