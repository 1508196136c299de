"""Typed readers, literal tables, generators, and the model store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet scan with its declared schema, so no inference job runs."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}.parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    date_format: str = "dd-MM-yyyy",
    null_value: str = "",
) -> DataFrame:
    """Header CSV with a declared schema. Dates are day first; cells that do not parse become null.

    Blanks around strings are kept, as cleaning them is a step of its own (`clean.trim_strings`).
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("dateFormat", date_format)
        .option("nullValue", null_value)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
        .transform(nan_to_null)
    )


def write_csv(df: DataFrame, path: str, date_format: str = "dd-MM-yyyy") -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("dateFormat", date_format)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN in a float column becomes null."""
    floats = {name for name, kind in df.dtypes if kind in ("double", "float")}
    return df.select(
        *[
            F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c)
            if c in floats
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def from_columns(spark: SparkSession, columns: Mapping[str, Sequence], schema: str) -> DataFrame:
    """Small literal table given column by column."""
    rows = list(zip(*columns.values(), strict=True))
    return spark.createDataFrame(rows, schema).transform(nan_to_null)


def from_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """Small literal table given row by row."""
    return spark.createDataFrame(list(rows), schema).transform(nan_to_null)


def integer_range(spark: SparkSession, start: int, stop: int, step: int = 1) -> DataFrame:
    """Half-open integer range as column `id`."""
    return spark.range(start, stop, step)


def keyed_random_int(key: Column, low: int, high: int, salt: str = "") -> Column:
    """Integer in [low, high] derived from a key, so a row draws the same value under any
    partitioning and after a task is retried."""
    digest = F.substring(F.md5(F.concat(key.cast("string"), F.lit(salt))), 1, 8)
    return (F.lit(low) + F.conv(digest, 16, 10).cast("bigint") % (high - low + 1)).cast("bigint")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
