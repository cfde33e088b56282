"""Typed scans with sentinel handling.

The raw order-item file is read with a fixed schema (no inference); every
cell equal to one of the NA sentinels becomes null.  The sentinel rule applies
to every string and date column, as in the original reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: NA sentinels of the cleaning reader and of the EDA reader
NA_VALUES = ("not_reported", "1994-12-31")
EDA_NA_VALUES = ("not_reported", "?", "1994-12-31")

# fixed values: cells that a table reader takes as missing by default
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                  "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

DATE_COLUMNS = ("order_date", "delivery_date", "user_dob", "user_reg_date")

RAW_SCHEMA = T.StructType([
    T.StructField("order_item_id", T.StringType(), False),
    T.StructField("order_date", T.StringType(), True),
    T.StructField("delivery_date", T.StringType(), True),
    T.StructField("item_id", T.StringType(), True),
    T.StructField("item_size", T.StringType(), True),
    T.StructField("item_color", T.StringType(), True),
    T.StructField("brand_id", T.StringType(), True),
    T.StructField("item_price", T.DoubleType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("user_title", T.StringType(), True),
    T.StructField("user_dob", T.StringType(), True),
    T.StructField("user_state", T.StringType(), True),
    T.StructField("user_reg_date", T.StringType(), True),
    T.StructField("return", T.IntegerType(), True),
])


def apply_sentinels(df: DataFrame, na_values=NA_VALUES) -> DataFrame:
    """A value equal to any sentinel becomes null (string and date columns)."""
    na = list(na_values)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            cols.append(F.when(c.isin(na), F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            as_text = F.date_format(c, "yyyy-MM-dd")
            cols.append(F.when(as_text.isin(na), F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def parse_dates(df: DataFrame, columns=DATE_COLUMNS) -> DataFrame:
    """Text dates -> DATE; unparseable text (e.g. ``?``) becomes null."""
    out = df
    for c in columns:
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            out = out.withColumn(c, F.try_to_date(F.col(c), "yyyy-MM-dd"))
    return out


def read_order_items_csv(spark: SparkSession, path: str, na_values=NA_VALUES,
                         schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """S1 (+S2, S3 with ``EDA_NA_VALUES``): typed CSV scan of a raw order-item file.

    Columns are taken by their name in the header, in whatever order the file has them, read as
    text and cast; ids stay text.  A cell that is a default missing token, a sentinel, or no value
    of its type is null.  The label column may be absent (the unlabelled file); it is then added as
    a null integer so both files share one schema.
    """
    text = spark.read.option("header", True).option("nullValue", "").csv(path)
    missing = [*MISSING_TOKENS, *na_values]
    cols = []
    for f in schema.fields:
        if f.name not in text.columns:
            continue
        c = F.col(f"`{f.name}`")
        c = F.when(~F.trim(c).isin(missing), c)
        cols.append((c if isinstance(f.dataType, T.StringType) else F.trim(c).try_cast(f.dataType)).alias(f.name))
    df = parse_dates(text.select(*cols))
    if "return" not in df.columns:
        df = df.withColumn("return", F.lit(None).cast("int"))
    return df


def write_order_items_csv(df: DataFrame, path: str) -> None:
    """S6-style CSV sink with header (used for round trips and predictions)."""
    df.write.mode("overwrite").option("header", True).csv(path)
