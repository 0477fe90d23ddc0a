"""Cleaning, features, encodings, sources: literal cases and null semantics."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from lendlens.operators import clean, encode, features, profile, segments
from lendlens.sources import tables as io


def test_simple_ratios(spark):
    money = spark.createDataFrame([(1000, 5000), (2000, 4000), (1, 0)], "AMT_ANNUITY int, AMT_INCOME_TOTAL int")
    assert [r["DEBT_TO_INCOME_RATIO"] for r in features.calculate_dti(money).collect()] == [0.2, 0.5, None]
    days = spark.createDataFrame([(-1000, -10000), (-2000, -8000)], "DAYS_EMPLOYED int, DAYS_BIRTH int")
    found = features.calculate_employment_ratio(days).collect()
    assert [r["EMPLOYMENT_TO_AGE_RATIO"] for r in found] == [0.1, 0.25]


@pytest.fixture(scope="module")
def payments(spark):
    rows = [
        (1, 1, -10, -5, 100.0, 90.0),
        (1, 2, -200, None, 100.0, None),
        (1, 3, -300, -310, None, 50.0),
        (2, 1, -400, -400, 0.0, 10.0),
    ]
    kind = (
        "SK_ID_CURR bigint, NUM_INSTALMENT_NUMBER int, DAYS_INSTALMENT int, DAYS_ENTRY_PAYMENT bigint, "
        "AMT_INSTALMENT double, AMT_PAYMENT double"
    )
    return spark.createDataFrame(rows, kind)


def test_payment_scalars_keep_nulls(payments):
    rows = {r["NUM_INSTALMENT_NUMBER"]: r for r in features.repayment_scalars(payments.where("SK_ID_CURR = 1")).collect()}
    assert (rows[1]["DPD"], rows[1]["IS_LATE"], rows[1]["PAYMENT_DEFICIT"], rows[1]["IS_UNDERPAID"]) == (5, 1, 10.0, 1)
    assert rows[2]["DPD"] is None and rows[2]["IS_LATE"] == 0 and rows[2]["PAYMENT_RATIO"] is None
    assert rows[3]["DPD"] == 0 and rows[3]["DAYS_EARLY"] == 10 and rows[3]["PAYMENT_RATIO"] == 1.0
    padded = features.instalment_scalars(payments.where("AMT_INSTALMENT = 0")).first()
    assert padded["PAYMENT_RATIO"] == pytest.approx(1e6)


def test_client_aggregates(payments):
    row = features.instalment_features(payments).where("SK_ID_CURR = 1").first()
    assert row["INST_AVG_DPD"] == 2.5 and row["INST_PCT_LATE"] == pytest.approx(1 / 3)
    assert row["INST_REC180_AVG_DPD"] == 5.0 and row["INST_DPD_VELOCITY"] == pytest.approx(2.0, rel=1e-4)
    quiet = features.instalment_features(payments).where("SK_ID_CURR = 2").first()
    assert quiet["INST_REC180_AVG_DPD"] == 0.0
    cleaned = clean.clean_instalments(payments).orderBy("SK_ID_CURR", "NUM_INSTALMENT_NUMBER").collect()
    assert [r["IS_MISSED_PAYMENT"] for r in cleaned] == [0, 1, 0, 0]
    assert cleaned[1]["DAYS_ENTRY_PAYMENT"] == -200 and cleaned[1]["AMT_PAYMENT"] == 0.0


def test_one_pass_features_equal_both_sets(payments):
    cleaned = clean.clean_instalments(payments)
    both = features.instalment_features(cleaned).join(features.metadata_inst_features(cleaned), "SK_ID_CURR")
    once = features.client_features(cleaned).select(*both.columns)
    assert sorted(once.collect()) == sorted(both.collect())


def test_row_scores_skip_nulls(spark):
    kind = "EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double, DAYS_BIRTH int, DEBT_TO_INCOME_RATIO double"
    row = features.ext_score_features(spark.createDataFrame([(0.2, None, 0.4, -3652, 0.5)], kind)).first()
    assert row["EXT_SOURCE_MEAN"] == pytest.approx(0.3) and row["EXT_SOURCE_MIN"] == 0.2
    assert row["EXT_SOURCE_PRODUCT"] is None and row["EXT_SOURCE_WEIGHTED"] is None
    absent = features.ext_score_features(spark.createDataFrame([(-3652, 0.5)], "DAYS_BIRTH int, DEBT_TO_INCOME_RATIO double"))
    assert absent.first()["EXT_SOURCE_MEAN"] == 0.5


def test_bands_keep_empty_buckets(spark):
    df = spark.createDataFrame([(1, 250000.0), (0, 249999.0), (1, -1.0)], "TARGET int, AMT_CREDIT double")
    rows = segments.segment_credit_band(df).collect()
    assert [r["Total"] for r in rows] == [1, 1, 0, 0, 0]
    assert rows[2]["Default_Rate"] is None and rows[2]["Default_Count"] == 0


def test_cleaning_acts_on_present_columns(spark):
    df = spark.createDataFrame(
        [(1, 365243, "XNA", None), (2, -730, "F", "a"), (3, -10, "F", "a"), (4, None, "M", "b")],
        "SK_ID_CURR bigint, DAYS_EMPLOYED bigint, CODE_GENDER string, OCCUPATION_TYPE string",
    )
    out = clean.rare_code_to_mode(clean.clean_employment(df), clean.column_modes(df, ["CODE_GENDER"]))
    rows = {r["SK_ID_CURR"]: r for r in clean.explicit_missing(out).collect()}
    assert rows[1]["DAYS_EMPLOYED"] is None and rows[1]["DAYS_EMPLOYED_ANOM"] == 1 and rows[1]["YEARS_EMPLOYED"] == 0.0
    assert rows[1]["CODE_GENDER"] == "F" and rows[1]["OCCUPATION_TYPE"] == "Unknown_Missing"
    assert rows[4]["DAYS_EMPLOYED_ANOM"] == 0 and rows[2]["YEARS_EMPLOYED"] == pytest.approx(730 / 365.25)
    imputed = {r["SK_ID_CURR"]: r for r in clean.generic_impute(df).collect()}
    assert imputed[1]["OCCUPATION_TYPE"] == "a" and imputed[4]["DAYS_EMPLOYED"] == -10.0


def test_mode_takes_smallest_on_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert clean.column_modes(df, ["c"]) == {"c": "a"}


def test_narrowing_bounds_are_strict(spark):
    df = spark.createDataFrame([(126, 127, -32768, 1.5), (0, 0, 0, 2.5)], "a bigint, b bigint, c bigint, d double")
    chosen = {r["column"]: r["chosen_type"] for r in profile.numeric_narrowing(df).collect()}
    assert chosen == {"a": "tinyint", "b": "smallint", "c": "int", "d": "float"}
    assert dict(profile.narrow_types(df).dtypes) == chosen


def test_profile_of_empty_table(spark):
    empty = spark.createDataFrame([], "TARGET int, x double")
    assert profile.missing_summary(empty).count() == 0
    assert profile.target_distribution(empty).first()["default_rate_pct"] is None
    assert profile.score_histogram(empty, "x", 5).agg(F.sum("n")).first()[0] == 0


def test_encodings(spark):
    df = spark.createDataFrame([("b", "7"), ("a", "x"), (None, None), ("z", "1")], "c string, num string")
    known = df.where("c <> 'z'")
    dictionary = encode.learn_dictionary(known, ["c"])
    rows = encode.encode_categoricals(df, dictionary, ["num"]).collect()
    assert [(r["c"], r["num"]) for r in rows] == [(1, 7.0), (0, 0.0), (0, 0.0), (0, 1.0)]
    with pytest.raises(PySparkException):
        encode.encode_strict(df, dictionary).collect()
    hot = encode.one_hot(known, ["c"], keep=["num"]).collect()
    assert [r["c_b"] for r in hot] == [1, 0]
    with pytest.raises(ValueError, match="levels"):
        encode.distinct_levels(df, ["c"], max_levels=2)
    assert encode.readable_name("AMT_CREDIT") == "Total Loan Amount"
    assert encode.readable_name("SOME_RAW_NAME") == "Some Raw Name"


def test_dictionary_of_a_million_levels(spark):
    """Codes follow the levels' order; one level holds a third of the rows, and nulls another part."""
    value = "if(id % 3 = 0, 'hot', if(id % 7 = 1, null, concat('v', lpad(cast(id as string), 8, '0'))))"
    rows = spark.range(2_000_000).selectExpr("id", f"{value} as c", "cast(id % 5 as string) as d")
    found = encode.learn_dictionary(rows, ["c", "d"])
    levels = found.where("name = 'c'").count()
    assert levels > 1_000_000 and found.where("name = 'c' and level = 'hot' and code = 0").count() == 1
    coded = encode.encode_categoricals(rows, found)
    assert coded.columns == ["id", "c", "d"] and coded.count() == 2_000_000
    ends = coded.where("id % 3 <> 0 and id % 7 <> 1").agg(F.min("c"), F.max("c"), F.count_distinct("c")).first()
    assert tuple(ends) == (1, levels - 1, levels - 1)
    late = coded.where("id = 1999997").first()
    assert late["c"] == levels - 1 and late["d"] == 2
    assert coded.where("(id % 3 = 0 or id % 7 = 1) and c <> 0").count() == 0


def test_csv_reader(spark, tmp_path):
    df = spark.createDataFrame([(2, -5, None, 10.0), (1, -7, 3.5, None)], "SK_ID_CURR bigint, D int, A double, B double")
    io.csv_sample(df, str(tmp_path / "s"), n=1)
    back = io.read_csv(spark, str(tmp_path / "s"), df.schema)
    assert [tuple(r) for r in back.collect()] == [(1, -7, 3.5, None)]
    assert io.read_csv(spark, str(tmp_path / "s"), df.schema, usecols=["A"], nrows=5).columns == ["A"]
    with pytest.raises(AnalysisException):
        io.load_applications(spark, str(tmp_path / "absent"))


def test_csv_columns_are_found_by_name_and_checked(spark, tmp_path):
    text = "EXTRA,TARGET,SK_ID_CURR,DAYS_EMPLOYED,AMT_CREDIT,WORD\n7,1,100001,-1180.0,NaN,x\n8,0,100002,,2.5,NaN\n"
    (tmp_path / "a.csv").write_text(text)
    back = io.read_csv(spark, str(tmp_path / "a.csv"), "SK_ID_CURR bigint, TARGET int, DAYS_EMPLOYED int, AMT_CREDIT double, GONE int")
    assert back.columns == ["EXTRA", "TARGET", "SK_ID_CURR", "DAYS_EMPLOYED", "AMT_CREDIT", "WORD"]
    assert dict(back.dtypes)["EXTRA"] == "int"
    assert [tuple(r) for r in back.collect()] == [(7, 1, 100001, -1180, None, "x"), (8, 0, 100002, None, 2.5, None)]
    (tmp_path / "b.csv").write_text("SK_ID_CURR,TARGET\n1,maybe\n")
    with pytest.raises(Exception, match="TARGET can't be read"):
        io.read_csv(spark, str(tmp_path / "b.csv"), "SK_ID_CURR bigint, TARGET int").collect()
