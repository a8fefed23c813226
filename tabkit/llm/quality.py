"""Quality rules with thresholds from mergeable quantile sketches. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.llm.rows import packed, unpacked
from tabkit.session import settle, sized_join, store

WINDOW_WORDS = 8
#: White space that parts words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\t\n\x0b\x0c\r"
#: Bins below 2 ** PRECISION hold one value; above, each power of two has 2 ** (PRECISION - 1) bins.
PRECISION = 6
#: metric: (least width of the middle half, whether low values are bad too)
METRICS = {"word_length": (100, True), "symbols": (60, False), "dup_lines": (100, False), "repeats": (100, False)}
FENCE = 4
SCORED = ["word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _repeat_words(windows: str, words: str) -> Column:
    """Words inside a window that the text holds more than once, from the array of its window hashes."""
    w = F.col(windows)
    ordered = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(None)).otherwise(ordered)


def text_measures(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """``documents`` plus ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``."""
    text = F.col("doc")[text_col]
    words = F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")
    stage = packed(documents).withColumn("_words", F.coalesce(words, F.array().cast("array<string>")))
    n = F.size("_words")
    spots = F.when(n >= WINDOW_WORDS, F.sequence(F.lit(1), n - WINDOW_WORDS + 1)).otherwise(F.array().cast("array<int>"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS + " ", "")) > 0)
    stage = stage.withColumns({
        "_windows": F.transform(spots, lambda i: F.xxhash64(F.slice("_words", i, WINDOW_WORDS))),
        "_worded": F.coalesce(lines, F.array().cast("array<string>")),
    })
    stage = stage.withColumn("_ordered", _repeat_words("_windows", "_words"))
    ordered = F.col("_ordered")
    again = F.filter(ordered, lambda x, j: (
        (j > 0) & (F.get(ordered, F.greatest(j - 1, F.lit(0)))["h"] == x["h"])) | F.coalesce(F.get(ordered, j + 1)["h"] == x["h"], F.lit(False)))
    stage = stage.withColumn("_again", F.sort_array(F.transform(again, lambda x: x["i"])))
    spot = F.col("_again")
    covered = F.aggregate(
        F.transform(spot, lambda x, j: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get(spot, j + 1) - x, F.lit(WINDOW_WORDS)))),
        F.lit(0), lambda a, x: a + x,
    )
    return unpacked(stage, documents.columns, {
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long"),
        "n_lines": F.size("_worded").cast("long"),
        "n_dup_lines": (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("long"),
        # the partition id (always true) keeps filters on a measure above this projection: pushed below, they would
        # put the arrays' expressions inside the functions that run over the arrays
        "n_repeat_words": F.when(F.spark_partition_id() >= 0, F.coalesce(covered, F.lit(0))).cast("long"),
    })


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def scores() -> dict[str, Column]:
    """Whole-number scores: hundredths of characters a word, and shares in thousandths."""
    return {
        "word_length": F.expr("100 * word_chars div greatest(n_words, 1)"),
        "symbols": F.expr("1000 * n_symbols div greatest(n_words, 1)"),
        "dup_lines": F.expr("1000 * n_dup_lines div greatest(n_lines, 1)"),
        "repeats": F.expr("1000 * n_repeat_words div greatest(n_words, 1)"),
    }


def bin_floor(value: Column) -> Column:
    """The smallest value of the sketch's bin: all but the leading bits are cleared."""
    drop = F.greatest(F.length(F.bin(value)) - PRECISION, F.lit(0))
    step = F.pow(F.lit(2), drop).cast("long")
    return (F.floor(value / step) * step).cast("long")


def sketch(scored: DataFrame, group: list[str]) -> DataFrame:
    """Counts per group, metric and bin. Sketches of parts are merged by adding counts, as the shuffle does."""
    long = scored.select(*group, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), bin_floor(F.col(m)).alias("bin")) for m in METRICS
    ])).alias("s"))
    return long.groupBy(*group, "s.metric", "s.bin").agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketches: DataFrame, group: list[str], at: dict[str, int]) -> DataFrame:
    """For each group and metric the bin at which ``at`` percent of the rows are reached."""
    over = Window.partitionBy(*group, "metric")
    run = sketches.withColumns({"_sum": F.sum("n").over(over.orderBy("bin")), "_all": F.sum("n").over(over)})
    return run.groupBy(*group, "metric").agg(*[
        F.min(F.when(100 * F.col("_sum") >= p * F.col("_all"), F.col("bin"))).alias(name) for name, p in at.items()
    ])


def thresholds(sketches: DataFrame, group: list[str]) -> DataFrame:
    """One row per group with ``low_`` and ``high_`` of every metric.

    The fence lies ``FENCE`` times the width of the middle half outside of it; that width counts as the metric's least one
    where a group hardly varies.
    """
    q = quantiles(sketches, group, {"q1": 25, "q3": 75})
    least = F.create_map(*[x for m, (w, _) in METRICS.items() for x in (F.lit(m), F.lit(w))])
    width = FENCE * F.greatest(F.col("q3") - F.col("q1"), least[F.col("metric")])
    fences = q.select(*group, "metric", (F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))
    return fences.groupBy(*group).agg(*[
        F.max(F.when(F.col("metric") == m, F.col(side))).alias(f"{side}_{m}") for m in METRICS for side in ("low", "high")
    ])


def judge_quality(documents: DataFrame, text_col: str = "text", group: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``documents`` plus the measures, ``base_failed`` and ``kept``.

    A document is kept if it does not fail the base rules and each score lies within the fences of its language and
    source. The sketches cover the documents that pass the base rules; they have a bounded number of bins per
    group, so the joined table grows with the groups, not with the documents, and a hot group is summed before it is shuffled.

    Null and empty texts have no words and fail the base rules. Nulls in a group column form a group of their own.
    Repeated rows are judged alike; an empty table gives no rows. Columns of ``documents`` named like a result are replaced.
    """
    measured = text_measures(documents, text_col).withColumn("base_failed", base_failed())
    return _judged(measured, list(group))


def quality_table(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Like ``judge_quality`` for the id and group columns only: the measures are taken once and kept as a narrow table."""
    narrow = documents.select(id_col, *group, F.col(text_col).alias("_text"))
    measured = text_measures(narrow, "_text").withColumn("base_failed", base_failed()).drop("_text")
    return _judged(store(measured), list(group))


def _judged(measured: DataFrame, group: list[str]) -> DataFrame:
    keys = [f"g{i}" for i in range(len(group))]
    rows = packed(measured)
    doc = F.col("doc")
    scored = rows.select(
        "doc", *[doc[g].alias(k) for k, g in zip(keys, group)], *[doc[c].alias(c) for c in ("n_words", "base_failed", *SCORED)])
    scored = scored.select("doc", "base_failed", *keys, *[c.alias(m) for m, c in scores().items()])
    fences = thresholds(sketch(scored.filter(~F.col("base_failed")).select(*keys, *METRICS), keys), keys)
    right = settle(fences.select(*[F.col(k).alias(f"{k}r") for k in keys], *[c for c in fences.columns if c not in keys]))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}r"))
    joined = sized_join(scored, right, same, "left")
    inside = F.lit(True)
    for m, (_, low) in METRICS.items():
        inside = inside & (F.col(m) <= F.col(f"high_{m}"))
        if low:
            inside = inside & (F.col(m) >= F.col(f"low_{m}"))
    return unpacked(joined, measured.columns, {"kept": ~F.col("base_failed") & F.coalesce(inside, F.lit(False))})
