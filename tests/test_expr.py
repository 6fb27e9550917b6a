import math

import pytest
from pyspark.sql import functions as F

from relaylens.functions import expr as X


def value(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


@pytest.mark.parametrize("version, want", [("7.6.2", True), ("7.6.1", False), ("7.7.0", True), (None, False), ("7.a.2", False), ("7.6", False), ("7.6.2.1", True), ("762", True)])
def test_versions(spark, version, want):
    assert value(spark, X.version_at_least(F.lit(version), (7, 6, 2))) is want


def test_clamp_keeps_null(spark):
    assert value(spark, X.clamp_int(F.lit(None).cast("long"))) is None
    assert value(spark, X.clamp_int(F.lit(-(2**40)))) == -(2**31 - 1)


def test_python_text(spark):
    assert value(spark, X.python_text(F.lit(True), "boolean")) == "True"
    assert value(spark, X.python_text(F.lit(None).cast("string"), "string")) == "None"


def test_joined_skips_null_and_empty(spark):
    assert value(spark, X.joined("/", F.lit("a"), F.lit(None), F.lit(""), F.lit("b"))) == "a/b"


def test_span_text_rounds_half_to_even(spark):
    assert value(spark, X.span_text(F.lit(2.5), F.lit(3.5), F.lit(None).cast("double"))) == "2 / 4 / None"


def test_similar_period_of_a_thursday(spark):
    assert value(spark, X.similar_period(F.lit(1704362400000), ("hour", "weekday"))) == "10_3"


@pytest.mark.parametrize("z", [0.0, 1e-9, 0.5, 1.96, 2.8, 2.83, -3.0, 6.0, 12.0, 40.0])
def test_two_sided_p(spark, z):
    assert value(spark, X.two_sided_p(F.lit(z))) == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-13)
