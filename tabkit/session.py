"""Session-level helpers: cutting lineage safely and joining small tables by checked size."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from threading import Lock
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITING: WeakKeyDictionary[SparkSession, list] = WeakKeyDictionary()
_LOCK = Lock()
#: Row and byte counts that were observed while a table was settled.
_SEEN: WeakKeyDictionary[DataFrame, dict] = WeakKeyDictionary()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, for sessions started where it is not installed."""
    here = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="tabkit-ship-")) / "tabkit.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(target))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a temporary one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tabkit-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _value_bytes(name: str, kind: T.DataType, depth: int = 0) -> str:
    """SQL for the approximate size of a value, with what arrays, maps and structs hold."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return f"coalesce(octet_length({name}), 0) + 16L"
    if isinstance(kind, T.StructType):
        parts = [_value_bytes(f"{name}.`{f.name.replace('`', '``')}`", f.dataType, depth) for f in kind]
        return "(" + " + ".join(["8L", *parts]) + ")"
    if isinstance(kind, T.MapType):
        return f"({_value_bytes(f'map_keys({name})', T.ArrayType(kind.keyType), depth)} + {_value_bytes(f'map_values({name})', T.ArrayType(kind.valueType), depth)})"
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            x = f"x{depth}"
            return f"coalesce(aggregate({name}, 16L, (a{depth}, {x}) -> a{depth} + {_value_bytes(x, kind.elementType, depth + 1)}), 16L)"
        return f"coalesce(size({name}), 0) * 8L + 16L"
    return "8L"


def _row_bytes(schema: T.StructType) -> str:
    """SQL for the approximate size of a row."""
    return " + ".join(["16L", *[_value_bytes("`" + f.name.replace("`", "``") + "`", f.dataType) for f in schema]])


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage, so that later jobs neither recompute nor diverge.

    The row and byte counts are observed on the way. The plan's own size estimate stays that of ``df``; a loop that
    joins what it settled before multiplies estimates without end, so loops take ``store``.
    """
    checkpoint_dir(df.sparkSession)
    seen = Observation()
    done = df.observe(seen, F.expr(f"sum({_row_bytes(df.schema)}) AS bytes"), F.expr("count(1) AS rows"))
    done = done.checkpoint(eager=True)
    _SEEN[done] = seen.get
    return done


def sized_like(df: DataFrame, settled: DataFrame) -> DataFrame:
    """Let a projection or filter of a settled table be known by that table's size."""
    if settled in _SEEN:
        _SEEN[df] = _SEEN[settled]
    return df


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go as soon as it ends; the session's own setting is back once no thread is inside."""
    with _LOCK:
        held = _WRITING.setdefault(spark, [0, None])
        if not held[0]:
            held[1] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        held[0] += 1
    try:
        yield
    finally:
        with _LOCK:
            held[0] -= 1
            if not held[0]:
                if held[1] is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, held[1])


def store(df: DataFrame) -> DataFrame:
    """Write a large table once, as columns, into the shared folder and read it back.

    Like ``settle`` for tables read several times by few of their columns. The shuffle files of the write are let go of.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the folders of stored tables that nothing will read again."""
    for table in tables:
        sc = table.sparkSession.sparkContext
        folders = {m[0] for f in table.inputFiles() if (m := re.match(r".*/stored-[0-9a-f]{32}(?=/)", f))}
        for folder in folders:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table is below the broadcast limit: as observed while settling, else measured now."""
    seen = _SEEN.get(df)
    size = seen["bytes"] if seen else df.agg(F.expr(f"sum({_row_bytes(df.schema)})")).first()[0]
    return (size or 0) <= max_bytes


def sized_join(
    left: DataFrame, right: DataFrame, on, how: str = "left", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join a settled ``right``: broadcast when its measured size allows, else a shuffle join.

    The shuffle join leaves hot keys to AQE's skew splitting, which is valid here because the
    right side holds each key once.
    """
    if fits_broadcast(right, max_bytes):
        right = F.broadcast(right)
    return left.join(right, on, how)
