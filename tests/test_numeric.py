import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tessera import harmonic_mean, max_value, max_value_sorted, normalize_by_max, parse_numbers
from tests.conftest import SF_SMALL


def nums(spark, xs):
    return spark.createDataFrame([(float(x),) for x in xs], "x DOUBLE")


def test_one_to_ten(spark):
    df = nums(spark, range(1, 11))
    assert max_value(df, "x").first()[0] == 10.0
    assert max_value_sorted(df, "x").first()[0] == 10.0
    normed = sorted(r[0] for r in normalize_by_max(df, "x").collect())
    assert normed == pytest.approx([i / 10 for i in range(1, 11)])
    assert harmonic_mean(df, "x").first()[0] == pytest.approx(2520 / 7381, abs=1e-12)


def test_zero_gives_zero_mean(spark):
    assert harmonic_mean(nums(spark, [0.0, 1.0]), "x").first()[0] == 0.0
    assert harmonic_mean(nums(spark, [-0.0, 2.0]), "x").first()[0] == 0.0


def test_all_zero_raises(spark):
    with pytest.raises((PySparkException, Py4JJavaError), match="maximum is 0"):
        harmonic_mean(nums(spark, [0.0, 0.0]), "x").collect()
    with pytest.raises((PySparkException, Py4JJavaError), match="maximum is 0"):
        normalize_by_max(nums(spark, [0.0]), "x").collect()


def test_no_rows_gives_null(spark):
    empty = nums(spark, [])
    assert harmonic_mean(empty, "x").first()[0] is None
    assert max_value(empty, "x").first()[0] is None
    assert max_value_sorted(empty, "x").first()[0] is None


def test_nan_wins_the_maximum(spark):
    df = nums(spark, [1.0, float("nan"), 3.0])
    assert str(max_value(df, "x").first()[0]) == "nan"
    assert str(max_value_sorted(df, "x").first()[0]) == "nan"


def test_two_maxima_agree_on_lineitem(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    assert max_value(li, "l_quantity").first()[0] == max_value_sorted(li, "l_quantity").first()[0]


def test_parse_numbers_whitespace(spark):
    df = spark.createDataFrame([("1.0  2.5\t3\n",), ("  ",)], "value STRING")
    assert [r.x for r in parse_numbers(df).orderBy("pos").collect()] == [1.0, 2.5, 3.0]


def test_parse_numbers_malformed_fails(spark):
    df = spark.createDataFrame([("1.0 abc",)], "value STRING")
    with pytest.raises(PySparkException):
        parse_numbers(df).collect()


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize(
    "values, mean",
    [([0.0, 1.0, NAN], NAN), ([1.0, 2.0, INF], NAN), ([1e-300, 1e-310], 2 / (1 + 1e-300 / 1e-310)), ([-INF, 1.0], 2.0), ([5e-324, 1.0], 0.0)],
)
def test_harmonic_mean_in_java_doubles(spark, values, mean):
    got = harmonic_mean(nums(spark, values), "x").first()[0]
    assert got == pytest.approx(mean, rel=1e-9, nan_ok=True)


def test_harmonic_mean_has_no_join(spark):
    plan = harmonic_mean(nums(spark, [1, 2]), "x")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "partial_sum" in plan


def test_numbers_are_separated_as_by_a_scanner(spark):
    df = spark.createDataFrame([("1\u20032\u20283\x1c4\x0b5",)], "value STRING")
    assert [r.x for r in parse_numbers(df).orderBy("pos").collect()] == [1.0, 2.0, 3.0, 4.0, 5.0]
    with pytest.raises(PySparkException):  # a no-break space does not separate
        parse_numbers(spark.createDataFrame([("1\u00a02",)], "value STRING")).collect()


def test_malformed_number_fails_without_ansi_too(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([("1.0 abc",)], "value STRING")
        with pytest.raises(PySparkException):
            parse_numbers(df).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
