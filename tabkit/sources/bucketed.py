"""Tables laid out by their key, so that joins on it move no rows.

A bucketed table is written once, hashed to a number of buckets and sorted by the key inside them. Two tables of one key,
key types and bucket number meet bucket by bucket: their join, and any grouping by the key, need no exchange.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions.expr import q

BUCKET_BYTES = 256 * 1024 * 1024


def bucket_count(total_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of about ``bucket_bytes`` each, as a power of two, so that tables of different sizes still fit together."""
    return 2 ** max(0, math.ceil(math.log2(max(1, total_bytes) / bucket_bytes)))


def write_bucketed(df: DataFrame, name: str, key: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as table ``name``, bucketed and sorted by ``key``, and read it back. ``path`` is a shared folder (else the warehouse).

    One shuffle on the key comes first, so that each bucket is one file; a table with many rows of one key has one long bucket,
    so the layout is for row keys.
    """
    if not re.fullmatch(r"\w+(\.\w+)?", name):
        raise ValueError(f"not a table name: {name!r}")
    spark = df.sparkSession
    first, *rest = key
    writer = df.repartition(buckets, *[q(k) for k in key]).write.format("parquet").mode("overwrite").bucketBy(buckets, first, *rest).sortBy(first, *rest)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def layout(spark: SparkSession, name: str) -> tuple[int, tuple[str, ...]]:
    """Number of buckets (0: none) and the bucket columns of a table."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    columns = rows.get("Bucket Columns", "[]").strip("[]")
    return int(rows.get("Num Buckets", 0)), tuple(c.strip().strip("`") for c in columns.split(",") if c.strip())


def join_bucketed(spark: SparkSession, tables: Mapping[str, Sequence[str] | None], key: Sequence[str], how: str = "left") -> DataFrame:
    """Join tables by their row key: of the first all columns, of the others those named (all but the key if None).

    Tables whose layouts differ from the first one's are refused, since they would be shuffled. A merge join is asked for: it holds no
    bucket in memory. Null keys match nothing, as in any join.
    """
    names = list(tables)
    wanted = layout(spark, names[0])
    if wanted[1] != tuple(key):
        raise ValueError(f"{names[0]} is bucketed by {list(wanted[1])}, not by {list(key)}")
    for n in names[1:]:
        if layout(spark, n) != wanted:
            raise ValueError(f"{n} is laid out as {layout(spark, n)}, {names[0]} as {wanted}")

    def part(n: str) -> DataFrame:
        df = spark.table(n)
        cols = tables[n] if tables[n] is not None else [c for c in df.columns if c not in key]
        return df.select(*[q(k) for k in key], *[q(c) for c in cols])

    return reduce(lambda a, b: a.join(b.hint("merge"), list(key), how), [part(n) for n in names])


def correct_bucketed(spark: SparkSession, name: str, corrections: DataFrame, key: Sequence[str], column: str, value: str) -> DataFrame:
    """The table with ``column`` replaced where ``corrections`` (one row a key, bucketed alike or small) has its key; a null correction sets null."""
    fix = corrections.select(*[q(k) for k in key], q(value).alias("_new"), F.lit(True).alias("_given"))
    df = spark.table(name)
    done = df.join(fix, list(key), "left")
    return done.select(*[F.when(q("_given"), q("_new")).otherwise(q(c)).alias(c) if c == column else q(c) for c in df.columns])
