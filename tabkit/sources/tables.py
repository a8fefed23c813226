"""CSV and parquet tables: split files, typed CSV, named sets of tables, prediction files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.expr import no_nan, q

# Column type names of a typed CSV file and the types they stand for.
TYPE_NAMES = {
    "object": "string", "category": "string", "int64": "bigint", "float64": "double", "bool": "boolean",
}
TYPE_NAMES |= {"float32": "float", "int16": "smallint", "int8": "tinyint", "date": "date", "datetime64": "timestamp", "datetime64_naive": "timestamp_ntz"}
NAME_OF_TYPE = {
    "string": "object", "bigint": "int64", "int": "int64", "double": "float64", "boolean": "bool", "float": "float32",
    "smallint": "int16", "tinyint": "int8", "date": "date", "timestamp": "datetime64", "timestamp_ntz": "datetime64_naive",
}
#: Quoted fields may hold line breaks, doubled quotes, backslashes and edge blanks.
AS_IS = {
    "multiLine": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _name_of(column: str, kind: str) -> str:
    """A decimal keeps its own name; other types without a name are refused."""
    if kind.startswith("decimal("):
        return kind
    if kind not in NAME_OF_TYPE:
        raise TypeError(f"a typed CSV cannot hold column {column} of type {kind}")
    return NAME_OF_TYPE[kind]


def _type_of(name: str) -> str:
    return name if name.startswith("decimal(") else TYPE_NAMES[name]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header; ``NA``, ``NaN`` and empty fields are null, the text ``None`` stays."""
    df = (
        spark.read.schema(schema).option("header", True).option("nullValue", "NA")
        .option("emptyValue", "").option("enforceSchema", False).options(**AS_IS).csv(path)
    )
    def clean(f: T.StructField):
        if isinstance(f.dataType, T.StringType):
            return F.nullif(q(f.name), F.lit("")).alias(f.name)
        return no_nan(q(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else q(f.name)

    return df.select(*[clean(f) for f in df.schema])


def stack_splits(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Row append with a ``split`` column; columns missing in one part are null there."""
    out = None
    for name, df in parts.items():
        tagged = df.select(F.lit(name).alias("split"), *[q(c) for c in df.columns])
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def read_splits(
    spark: SparkSession, paths: Mapping[str, str], schema: T.StructType | Mapping[str, T.StructType]
) -> DataFrame:
    """Read one CSV per split and stack them; schemas may differ by columns absent from one split."""
    def of(name: str):
        return schema[name] if isinstance(schema, Mapping) else schema

    return stack_splits({name: read_csv(spark, path, of(name)) for name, path in paths.items()})


def write_typed_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write CSV part files with a header and, beside the data, the type names as a one-row CSV."""
    names = [(c, _name_of(c, t)) for c, t in df.dtypes]
    types = df.sparkSession.createDataFrame(
        [tuple(t for _, t in names)], ", ".join(f"`{c}` string" for c, _ in names)
    )
    types.coalesce(1).write.mode(mode).option("header", True).csv(f"{path}/types")
    df.write.mode(mode).option("header", True).option("nullValue", "NA").option("lineSep", "\n").options(
        **{k: v for k, v in AS_IS.items() if k != "multiLine"}).csv(f"{path}/data")


def read_typed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read what ``write_typed_csv`` wrote, with its types."""
    types = spark.read.option("header", True).csv(f"{path}/types")
    row = types.first()
    schema = T.StructType([
        T.StructField(c, T._parse_datatype_string(_type_of(row[c]))) for c in types.columns
    ])
    return read_csv(spark, f"{path}/data", schema)


def read_typed_file(spark: SparkSession, path: str) -> DataFrame:
    """Read a CSV whose first data row names the column types."""
    text = spark.read.option("header", True).option("nullValue", "NA").csv(path)
    types = text.first()
    # the type row is told apart by holding a type name in every column
    is_types = F.lit(True)
    for c in text.columns:
        if types[c] in TYPE_NAMES:
            is_types = is_types & (q(c) == types[c])
    rows = text.filter(~F.coalesce(is_types, F.lit(False)))
    return rows.select(*[q(c).cast(TYPE_NAMES.get(types[c], "string")).alias(c) for c in text.columns])


def load_tables(spark: SparkSession, folder: str, names: Sequence[str], fmt: str = "parquet", view: bool = True) -> dict[str, DataFrame]:
    """Named tables of a folder, each also a temporary view; a suffix is dropped from the name."""
    out = {}
    for name in names:
        stem = name.split(".")[0]
        path = f"{folder}/{name}" if "." in name else f"{folder}/{name}.parquet" if fmt == "parquet" else f"{folder}/{name}"
        df = spark.read.parquet(path) if fmt == "parquet" else read_typed_csv(spark, path)
        if view:
            df.createOrReplaceTempView(stem)
        out[stem] = df
    return out


def save_tables(tables: Mapping[str, DataFrame], folder: str, partition_by: Sequence[str] = (), mode: str = "error") -> None:
    """Write each table under its name; nothing happens for an empty collection."""
    for name, df in tables.items():
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{folder}/{name}.parquet")


def write_predictions(
    preds: DataFrame, folder: str, key: str = "id", names: tuple[str, str] = ("Id", "SalePrice"), mode: str = "error"
) -> None:
    """CSV of back-transformed predictions, one directory per dataset and model."""
    (
        preds.select("dataset", "model", q(key).alias(names[0]), F.exp("p").alias(names[1]))
        .write.mode(mode).partitionBy("dataset", "model").option("header", True).csv(folder)
    )
