"""Readers with explicit schemas, and report sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructType

# Schemas of the two source tables as exchanged in CSV (the columns used here).
APPLICATION_SCHEMA = (
    "SK_ID_CURR bigint, TARGET int, AMT_CREDIT double, AMT_INCOME_TOTAL double, AMT_ANNUITY double, "
    "AMT_GOODS_PRICE double, CNT_FAM_MEMBERS double, NAME_CONTRACT_TYPE string, CODE_GENDER string, "
    "NAME_FAMILY_STATUS string, NAME_EDUCATION_TYPE string, OCCUPATION_TYPE string, FLAG_OWN_REALTY string, "
    "FLAG_OWN_CAR string, DAYS_BIRTH bigint, DAYS_EMPLOYED bigint, EXT_SOURCE_1 double, EXT_SOURCE_2 double, "
    "EXT_SOURCE_3 double, AMT_REQ_CREDIT_BUREAU_YEAR double, DEF_30_CNT_SOCIAL_CIRCLE double, "
    "REGION_RATING_CLIENT_W_CITY int"
)
INSTALMENT_SCHEMA = (
    "SK_ID_CURR bigint, NUM_INSTALMENT_NUMBER int, DAYS_INSTALMENT int, DAYS_ENTRY_PAYMENT bigint, "
    "AMT_INSTALMENT double, AMT_PAYMENT double"
)


#: Spellings of a missing value in CSV fields (fixed values).
MISSING = ("", "NA", "NaN", "nan", "NULL", "null", "None")


def _parsed(name: str, kind: DataType) -> Column:
    """A text field as ``kind``; a field that is neither missing nor of that kind raises."""
    text = F.trim(F.col(name))
    absent = F.col(name).isNull() | text.isin(*MISSING)
    if isinstance(kind, StringType):
        return F.when(~absent, F.col(name))
    value = text.try_cast(kind)
    if isinstance(kind, IntegralType):  # whole numbers may be written with a fraction, like -1180.0
        number = text.try_cast("double")
        value = F.coalesce(value, F.when(number == F.floor(number), number.try_cast(kind)))
    said = F.concat(F.lit(f"column {name} can't be read as {kind.simpleString()}: "), F.col(name))
    return F.when(~absent, F.coalesce(value, F.raise_error(said).cast(kind)))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Not-a-number is a missing value, as files written by pandas have it."""
    kinds = {c for c, kind in df.dtypes if kind in ("double", "float")}
    return df.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) if c in kinds else F.col(c) for c in df.columns))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    usecols: Sequence[str] | None = None,
    nrows: int | None = None,
) -> DataFrame:
    """CSV with a header; columns are found by name, in any order.

    Columns that the schema names get its types, checked field by field; columns beyond it are kept
    with inferred types; columns that the file lacks are absent. Missing values and NaN are null. A
    missing path raises AnalysisException.
    """
    known = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = {f.name: f.dataType for f in known.fields}
    df = spark.read.option("header", True).csv(path)
    wanted = list(df.columns if usecols is None else usecols)
    more = [c for c in wanted if c not in kinds]
    if more:  # one more pass over the file, for these columns' types
        guess = spark.read.option("header", True).option("inferSchema", True).option("nullValue", "NaN").csv(path).schema
        kinds |= {c: guess[c].dataType for c in more}
    df = nan_to_null(df.select(*(_parsed(c, kinds[c]).alias(c) for c in wanted)))
    return df if nrows is None else df.limit(nrows)


def load_applications(
    spark: SparkSession, path: str, nrows: int | None = None, schema: str | StructType = APPLICATION_SCHEMA
) -> DataFrame:
    return read_csv(spark, path, schema, nrows=nrows)


def load_installments(
    spark: SparkSession,
    path: str,
    usecols: Sequence[str] | None = None,
    nrows: int | None = None,
    schema: str | StructType = INSTALMENT_SCHEMA,
) -> DataFrame:
    return read_csv(spark, path, schema, usecols, nrows)


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write and read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def csv_sample(df: DataFrame, path: str, n: int = 1000, key: str = "SK_ID_CURR") -> None:
    """The first n rows by key as CSV, for a quick look."""
    write_csv(df.orderBy(key).limit(n), path)


def write_json(df: DataFrame, path: str) -> None:
    """Nested report, one JSON object per row."""
    df.write.mode("overwrite").json(path)
