"""Loan tables derived from the star-schema test data (see FIXTURES.md, section 3).

An application is an order joined to its customer and nation; its instalments
are the order's lines. Column pruning removes whatever a query does not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Day offsets are counted from this date.
ANCHOR_DATE = "2001-12-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bureau_score(multiplier: int, modulus: int) -> str:
    risk = "7e0*((o_orderkey*57)%991)/991"
    return f"({risk}+3e0*((o_orderkey*{multiplier})%{modulus})/{modulus})/1e1"


def _null_when(condition: str, value: str) -> str:
    return f"case when {condition} then null else {value} end"


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per application, keyed by SK_ID_CURR."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    fields = {
        "SK_ID_CURR": "o_orderkey",
        "TARGET": "case when (o_orderkey*57)%991+(o_orderkey*13)%600<300 then 1 else 0 end",
        "AMT_CREDIT": "o_totalprice",
        "AMT_INCOME_TOTAL": "(c_acctbal+1e3)*2e1",
        "AMT_ANNUITY": _null_when("o_orderkey%97=0", "o_totalprice/(6+o_orderkey%55)"),
        "AMT_GOODS_PRICE": _null_when("o_orderkey%89=0", "o_totalprice*(7e-1+5e-2*(o_orderkey%10))"),
        "CNT_FAM_MEMBERS": _null_when("o_orderkey%211=0", "cast(1+o_custkey%5 as double)"),
        "NAME_CONTRACT_TYPE": "case when o_orderpriority='5-LOW' then 'Revolving loans' else 'Cash loans' end",
        "CODE_GENDER": "case when o_orderkey%400=0 then 'XNA' when o_custkey%3=0 then 'M' else 'F' end",
        "NAME_FAMILY_STATUS": "case when o_orderkey%701=0 then 'Unknown' "
        "when o_custkey%4=0 then 'Single / not married' else 'Married' end",
        "NAME_EDUCATION_TYPE": "c_mktsegment",
        "OCCUPATION_TYPE": _null_when("o_custkey%3=1", "c_mktsegment"),
        "FLAG_OWN_REALTY": "case when o_custkey%10<7 then 'Y' else 'N' end",
        "FLAG_OWN_CAR": "case when o_custkey%5<2 then 'Y' else 'N' end",
        "DAYS_BIRTH": "-(6600+(o_custkey*7919)%20000)",
        "DAYS_EMPLOYED": "case when o_custkey%6=0 then 365243 else -((o_custkey*104729)%9000) end",
        "EXT_SOURCE_1": _null_when("o_orderkey%2=0", _bureau_score(31, 997)),
        "EXT_SOURCE_2": _null_when("o_orderkey%499=0", _bureau_score(71, 977)),
        "EXT_SOURCE_3": _null_when("o_orderkey%5=0", _bureau_score(83, 983)),
        "AMT_REQ_CREDIT_BUREAU_YEAR": _null_when("o_orderkey%7=0", "cast(o_custkey%4 as double)"),
        "DEF_30_CNT_SOCIAL_CIRCLE": _null_when("o_orderkey%301=0", "cast(o_custkey%3 as double)"),
        "REGION_RATING_CLIENT_W_CITY": "1+n_regionkey%3",
    }
    return joined.selectExpr(*(f"{text} as {name}" for name, text in fields.items()))


def instalment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every instalment row, without the check that its application exists.

    Client-level aggregates start here and are restricted afterwards by
    ``known_clients``: the key filter commutes with a group-by on that key, so
    raw rows shuffle only as partial aggregates.
    """
    day = f"datediff(to_date(l_shipdate), date '{ANCHOR_DATE}')"
    fields = {
        "SK_ID_CURR": "l_orderkey",
        "NUM_INSTALMENT_NUMBER": "l_linenumber",
        "DAYS_INSTALMENT": day,
        "DAYS_ENTRY_PAYMENT": _null_when("l_partkey%53=0", f"{day}+(l_partkey%21)-12"),
        "AMT_INSTALMENT": "l_extendedprice",
        "AMT_PAYMENT": "case when l_partkey%53=0 then null "
        "when l_returnflag='R' then l_extendedprice*(1e0-l_discount) else l_extendedprice end",
    }
    lines = table(spark, sf_dir, "lineitem")
    return lines.selectExpr(*(f"{text} as {name}" for name, text in fields.items()))


def _client_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey as SK_ID_CURR")


def known_clients(aggregated: DataFrame, sf_dir: str) -> DataFrame:
    """Client-level rows whose application exists.

    Order keys are unique, so an inner join filters. It is preferred to a semi
    join here because the optimizer moves a semi join below the aggregate,
    where it would shuffle every raw payment row.
    """
    return aggregated.join(_client_keys(aggregated.sparkSession, sf_dir), "SK_ID_CURR")


def instalments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instalment rows of existing applications."""
    return instalment_lines(spark, sf_dir).join(_client_keys(spark, sf_dir), "SK_ID_CURR", "left_semi")
