"""File readers with explicit schemas.

Every reader takes a path chosen by the caller (no downloads) and an explicit
``StructType``; only the wide reader derives its measure columns from the header, because
its date headers are not known in advance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Explicit schemas of the feeds the reference reads (columns it uses; FIXTURES.md §1).
ENTITY_DIM = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("iso3code", T.StringType()),
    T.StructField("iso2code", T.StringType()),
    T.StructField("who_region", T.StringType()),
    T.StructField("pop_2020yr", T.LongType()),
    T.StructField("Continent_Name", T.StringType()),
])
LONG_DAILY = T.StructType([
    T.StructField("Date_reported", T.StringType()),
    T.StructField("Country_code", T.StringType()),
    T.StructField("Country", T.StringType()),
    T.StructField("WHO_region", T.StringType()),
    T.StructField("New_cases", T.LongType()),
    T.StructField("Cumulative_cases", T.LongType()),
    T.StructField("New_deaths", T.LongType()),
    T.StructField("Cumulative_deaths", T.LongType()),
])
POLICY = T.StructType([
    T.StructField("CountryName", T.StringType()),
    T.StructField("CountryCode", T.StringType()),
    T.StructField("Jurisdiction", T.StringType()),
    T.StructField("Date", T.IntegerType()),
    T.StructField("StringencyIndex", T.DoubleType()),
])
HOSPITAL = T.StructType([
    T.StructField("iso_code", T.StringType()),
    T.StructField("indicator", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("value", T.DoubleType()),
])


def checked_cast(text, kind: T.DataType, name: str):
    """A text column as ``kind``; an empty text is null, a text that does not parse is an
    error.  Whole numbers may be written with a fraction of zeros (``12.0``)."""
    value = F.when(F.trim(text) != "", text)
    parsed = value.try_cast(kind)
    if isinstance(kind, T.IntegralType):
        number = value.try_cast("double")
        parsed = F.coalesce(parsed, F.when(number == F.floor(number), number).try_cast(kind))
    wrong = F.raise_error(F.concat(F.lit(f"column {name} cannot hold "), value))
    return F.when(value.isNotNull() & parsed.isNull(), wrong).otherwise(parsed)


def _read_text(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """All columns as text, by position; a row with other than ``names`` columns is an error."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST")
    return reader.option("enforceSchema", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, na_strings: tuple[str, ...] = ("",)) -> DataFrame:
    """CSV with a header and an explicit schema.

    ``na_strings`` are read as null.  By default only the empty field is null: the text
    ``NA`` is a real code (Namibia) and is kept (N10).  Pass ``("", "NA")`` for the reader
    that treats both as missing (S2).  A value that does not fit its column is an error.
    """
    df = _read_text(spark, path, [f.name for f in schema.fields])
    extra = [s for s in na_strings if s != ""]
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if extra:
            c = F.when(~c.isin(extra), c)
        cols.append((c if isinstance(f.dataType, T.StringType) else checked_cast(c, f.dataType, f.name)).alias(f.name))
    return df.select(*cols)


def read_wide_csv(
    spark: SparkSession,
    path: str,
    n_ids: int = 4,
    id_types: tuple = (T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()),
    value_type: T.DataType = T.LongType(),
) -> DataFrame:
    """Wide CSV (S4): headers kept verbatim, the first ``n_ids`` columns are identifiers,
    every later header is a date label.  The header is read once (one small job) to learn
    the date columns; a value that does not fit ``value_type`` is an error."""
    header = spark.read.option("header", True).csv(path).limit(0).columns
    df = _read_text(spark, path, header)
    kinds = [id_types[i] if i < len(id_types) else T.StringType() for i in range(n_ids)] + [value_type] * (len(header) - n_ids)
    return df.select(
        *(
            (F.col(f"`{h}`") if isinstance(k, T.StringType) else checked_cast(F.col(f"`{h}`"), k, h)).alias(h)
            for h, k in zip(header, kinds, strict=True)
        )
    )


def first_column_as(df: DataFrame, name: str) -> DataFrame:
    """Address the first column by position."""
    return df.withColumnRenamed(df.columns[0], name)


def lower_names(df: DataFrame) -> DataFrame:
    """``rename_all(tolower)``."""
    return df.toDF(*[c.lower() for c in df.columns])


def dated_path(template: str, day_text: str) -> str:
    """Date-templated file name (S6); ``day_text`` from ``functions.dates.local_day_text``
    or from the caller's run date, never from the wall clock inside a query."""
    return template % day_text
