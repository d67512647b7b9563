import pytest

from featloom.plans import credit
from featloom.plans.credit_roles import credit_tables
from featloom.sources.tables import (
    fill_template,
    first_rows,
    read_csv,
    save_features,
    submission_path,
    write_csv,
    write_out_of_fold,
    write_test_scores,
    write_train_with_prediction,
)

SF = "/root/testdata/sf0.001"


def test_csv_missing_spellings(spark, tmp_path, in_order):
    path = tmp_path / "t.csv"
    path.write_text('k,x,c\n1,1.5,XNA\n2,NA,\n3,nan,"a, b"\n4,#N/A,null\n5,oops,None\n')
    df = read_csv(spark, str(path), "k bigint, x double, c string")
    assert in_order(df, "k") == [(1, 1.5, "XNA"), (2, None, None), (3, None, "a, b"), (4, None, None), (5, None, None)]


def test_csv_header_must_match(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("k,other\n1,2\n")
    with pytest.raises(Exception):
        read_csv(spark, str(path), "k bigint, x double").collect()


def test_first_rows(spark):
    df = spark.range(50).selectExpr("49 - id k")
    assert [r["k"] for r in first_rows(df, ["k"], 3).collect()] == [0, 1, 2]
    assert first_rows(df, ["k"], None).count() == 50


def test_sinks_round_trip(spark, tmp_path, in_order):
    scores = spark.createDataFrame([(1, 0, 0.25), (2, 1, 0.75)], "k bigint, y int, score double")
    write_out_of_fold(scores, str(tmp_path / "oof"), "k", "y", "score")
    oof = read_csv(spark, str(tmp_path / "oof"), "k bigint, TARGET int, Prediction double")
    assert in_order(oof, "k") == [(1, 0, 0.25), (2, 1, 0.75)]
    write_test_scores(scores, str(tmp_path / "test"), "k", "score")
    assert in_order(read_csv(spark, str(tmp_path / "test"), "k bigint, TARGET double"), "k") == [(1, 0.25), (2, 0.75)]
    write_train_with_prediction(scores.drop("score"), scores, str(tmp_path / "all"), "k", "score")
    assert in_order(spark.read.parquet(str(tmp_path / "all")), "k") == [(1, 0, 0.25), (2, 1, 0.75)]
    assert in_order(save_features(scores, str(tmp_path / "features")), "k") == in_order(scores, "k")


def test_template_is_joined_by_key(spark, in_order):
    template = spark.createDataFrame([(3, 0.5), (1, 0.5), (9, 0.5)], "k bigint, TARGET double")
    scores = spark.createDataFrame([(1, 0.123456), (3, 0.9)], "k bigint, s double")
    assert in_order(fill_template(template, scores, "k", "s", 3), "k") == [(1, 0.123), (3, 0.9), (9, None)]
    assert submission_path("out", 0.7912345) == "out/submission_0.79123.csv"


def test_feature_sets_from_csv_files_equal_those_from_tables(spark, tmp_path):
    """All tables written as CSV and read back give the same rollups."""
    tables = credit_tables(spark, SF)
    read = {}
    for name in ("bureau", "bureau_balance"):
        write_csv(tables[name], str(tmp_path / name))
        read[name] = read_csv(spark, str(tmp_path / name), tables[name].schema)
    direct = credit.bureau(tables["bureau"], tables["bureau_balance"])
    again = credit.bureau(read["bureau"], read["bureau_balance"])
    columns = ["SK_ID_CURR", "BURO_COUNT", "ACTIVE_DAYS_CREDIT_MAX", "CLOSED_When_closed_MIN", "BURO_CREDIT_TYPE_NaN_MEAN", "BURO_First_status_0_MEAN"]
    assert direct.columns == again.columns
    assert direct.select(columns).exceptAll(again.select(columns)).count() == 0


def test_debug_rows_limit_every_table(spark):
    tables = {n: df.limit(60) for n, df in credit_tables(spark, SF).items()}
    small = credit.second_features(tables, rows=20)
    assert 0 < small.count() <= 40
