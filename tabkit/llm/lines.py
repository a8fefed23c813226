"""Line dedup by repeated three-line windows. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.llm.rows import packed, unpacked

WINDOW = 3


def _windows(lines: str, size: int) -> Column:
    """``pos`` and two hashes of every run of ``size`` lines; runs of blank lines only are left out."""
    def window(i):
        own = [F.get(F.col(lines), i + k) for k in range(size)]
        return F.struct(
            i.alias("pos"), F.xxhash64(*own).alias("h1"), F.xxhash64(F.lit("second"), *own[::-1]).alias("h2"),
            (F.trim(F.concat(*own)) != "").alias("worded"),
        )

    last = F.size(F.col(lines)) - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(starts, window), lambda w: w["worded"])


def merged_intervals(starts: str, size: int) -> Column:
    """Sorted window starts to disjoint covered intervals ``[begin, end)``."""
    p = F.col(starts)
    begins = F.filter(p, lambda x, i: (i == 0) | (x > F.coalesce(F.get(p, F.greatest(i - 1, F.lit(0))), x) + size))
    ends = F.filter(p, lambda x, i: F.coalesce(F.get(p, i + 1) > x + size, F.lit(True)))
    return F.arrays_zip(begins.alias("begin"), F.transform(ends, lambda x: x + size).alias("end"))


def repeated_windows(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``id, digest, starts``: for each document that has any, the sorted positions of windows that occurred before.

    The first occurrence is the one of the smallest id (null before all), then text digest, then position.
    """
    lines = documents.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.split(F.col(text_col), "\n").alias("lines")
    )
    windows = lines.select("id", "digest", F.explode(_windows("lines", size)).alias("w")).select("id", "digest", "w.pos", "w.h1", "w.h2")
    place = F.struct("id", "digest", "pos")
    repeated = (
        windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2", "first")
    )
    later = windows.join(repeated, ["h1", "h2"]).filter(place != F.col("first"))
    return later.groupBy("id", "digest").agg(F.sort_array(F.collect_set("pos")).alias("starts"))


def dedup_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``documents`` without later occurrences of any three consecutive lines, plus ``n_lines`` and ``n_removed``.

    Lines are split at ``\\n``. Every window of ``size`` lines is hashed (128 bits); where a window occurs again, in the
    same or another document, the lines of all occurrences but the first are covered, and covered lines go. Windows
    of blank lines only do not count, and documents of fewer than ``size`` lines stay as they are. Each removed line
    has an earlier equal line that stays. Null text stays null, with no lines; an empty text has one empty line.
    Rows of one id and text are the same document: none is a repetition of the other and all lose the same lines.
    Columns of ``documents`` named like a result are replaced; a text that loses every line becomes empty.
    """
    covered = repeated_windows(documents, id_col, text_col, size).select("id", "digest", merged_intervals("starts", size).alias("cover"))
    rows, text = packed(documents), F.col("doc")[text_col]
    same = F.col("id").eqNullSafe(F.col("doc")[id_col]) & (F.col("digest") == F.xxhash64(text))
    joined = rows.join(covered, same, "left").select("doc", "cover", F.split(text, "\n").alias("lines"))
    cover, lines = F.col("cover"), F.col("lines")
    begins = F.concat(F.array(F.lit(0)), cover["end"])
    gaps = F.transform(begins, lambda b, i: F.slice(lines, b + 1, F.coalesce(F.get(cover["begin"], i), F.size(lines)) - b))
    kept = F.array_join(F.flatten(gaps), "\n")
    removed = F.aggregate(cover, F.lit(0).cast("long"), lambda a, c: a + c["end"] - c["begin"])
    return unpacked(joined, documents.columns, {
        text_col: F.when(cover.isNull(), text).otherwise(kept),
        "n_lines": F.when(lines.isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_removed": F.coalesce(removed, F.lit(0)).cast("long"),
    })
