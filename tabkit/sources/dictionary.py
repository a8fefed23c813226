"""Sectioned text dictionaries of a table's variables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.session import settle, sized_join

# Names in the dictionary that differ from the table's, and the text a colon line
# must not hold to start a section.
RENAMED = {"Bedroom": "BedroomAbvGr", "Kitchen": "KitchenAbvGr"}
NOT_A_HEADER = "one-half"


def text_lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Rows ``(key, pos, line)`` of a text column."""
    return texts.select(q(key), F.posexplode(F.split(q(text), "\n")).alias("pos", "line"))


def sections(lines: DataFrame, key: str, is_header: Column, carry: Column) -> DataFrame:
    """Carry each section's header value down its lines, within one text.

    Working memory is one text: the window is partitioned by its key.
    """
    above = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.withColumn("is_header", is_header).withColumn(
        "section", F.last(F.when(q("is_header"), carry), ignorenulls=True).over(above)
    )


def parse_dictionary(texts: DataFrame, key: str = "path", text: str = "value", renamed: Mapping[str, str] = RENAMED) -> DataFrame:
    """``(var, description, code, label)`` of every section; a section without values has null code."""
    lines = text_lines(texts, key, text).withColumn("line", F.regexp_replace("line", "\r", ""))
    blank = F.trim(F.regexp_replace("line", "[\t\n]", "")) == ""
    lines = lines.filter(~blank)
    header = F.contains(q("line"), F.lit(":")) & ~F.contains(q("line"), F.lit(NOT_A_HEADER))
    marked = sections(lines, key, header, F.regexp_replace("line", "\t", "")).filter("section is not null")
    parts = F.split(q("section"), ":", 2)
    code = F.nullif(F.regexp_extract(F.trim(F.split(q("line"), "\t")[0]), r"^(\S*)", 1), F.lit(""))
    label = F.trim(F.get(F.split(q("line"), "\t"), F.lit(1)))
    values = marked.filter("not is_header").select(q(key), "section", "pos", code.alias("code"), label.alias("label"))
    heads = marked.filter("is_header").select(q(key), "section").distinct()
    found = heads.join(values, [key, "section"], "left").filter("pos is null or code is not null")
    name = F.trim(parts[0])
    return found.select(
        F.coalesce(F.create_map(*[F.lit(x) for kv in renamed.items() for x in kv])[name], name).alias("var"),
        F.trim(parts[1]).alias("description"), "code", "label",
    )


def read_dictionary(spark: SparkSession, path: str, renamed: Mapping[str, str] = RENAMED) -> DataFrame:
    """Parse any number of dictionary files."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return parse_dictionary(files, renamed=renamed)


def describe_columns(df: DataFrame, dictionary: DataFrame | None, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, description, values MAP)`` of the columns the dictionary knows."""
    if dictionary is None:
        raise ValueError("no dictionary given")
    wanted = list(cols) if cols is not None else df.columns
    known = dictionary.filter(q("var").isin(wanted))
    # a variable has as many entries as it has documented levels
    return known.groupBy(q("var").alias("column")).agg(
        F.first("description").alias("description"),
        F.map_from_entries(F.collect_list(F.when(q("code").isNotNull(), F.struct("code", "label")))).alias("values"),
    )


def undocumented_levels(counts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Value counts ``(column, value, n)`` whose value the dictionary does not list, for listed columns."""
    listed = settle(dictionary.filter("code is not null").select(q("var").alias("column"), q("code").alias("value")).distinct())
    known = settle(listed.select("column").distinct())
    inside = sized_join(counts, known, "column", "left_semi")
    return sized_join(inside, listed, ["column", "value"], "left_anti")
