import pytest
from pyspark.sql import functions as F

from relaylens.operators import anonymize, query


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(1, "a", True, 5.0), (2, None, False, None), (3, "b", None, 1.0)], "id long, name string, ok boolean, x double")


def ids(df):
    return [r.id for r in df.collect()]


def test_rule_needs_all_parts_and_starts_at_the_beginning(rows):
    assert ids(anonymize.hide(rows, [[("name", "a"), ("ok", "True")]])) == [2, 3]
    assert ids(anonymize.hide(rows, [[("name", "None")]])) == [1, 3]
    assert ids(anonymize.hide(rows, [[("missing", ".*")]])) == [1, 2, 3]


def test_substitutions_see_earlier_results(rows):
    out = anonymize.substitute(rows, [([("name", "a")], {"name": "z"}), ([("name", "z")], {"x": 0})])
    assert [(r.name, r.x) for r in out.orderBy("id").collect()] == [("z", 0.0), (None, None), ("b", 1.0)]


def test_masks(spark):
    df = spark.createDataFrame([("client", 1, 2), ("producer", 1, 2)], "side string, total int, own int")
    assert sorted(map(tuple, anonymize.mask_sides(df, ["total"], ["own"]).collect())) == [("client", 1, None), ("producer", None, 2)]


def test_null_constraint_and_order(rows):
    k = query.Constraint
    assert ids(query.run_query(rows, query.QuerySpec(constraints=[k("name", "=", "None")]))) == [2]
    assert ids(query.run_query(rows, query.QuerySpec(constraints=[k("name", "!=", "None")], order=[("id", "desc")]))) == [3, 1]
    assert ids(query.run_query(rows, query.QuerySpec(order=[("x", "asc")]))) == [3, 1, 2]
    assert ids(query.run_query(rows, query.QuerySpec(order=[("x", "desc")], limit=1, offset=1))) == [1]


@pytest.mark.parametrize("spec", [
    query.QuerySpec(columns=["nope"]), query.QuerySpec(constraints=[query.Constraint("name", "<", "a")]), query.QuerySpec(constraints=[query.Constraint("x", "=", "q")]), query.QuerySpec(order=[("id", "up")]),
])
def test_bad_queries(rows, spec):
    with pytest.raises(query.QueryError):
        query.run_query(rows, spec)


def test_parse():
    spec = query.QuerySpec.parse('["a"]', '[{"column": "a", "operator": "=", "value": 1}]', '[{"column": "a", "order": "asc"}]', 5)
    assert spec.constraints == [query.Constraint("a", "=", 1)] and spec.order == [("a", "asc")]
    for bad in ("{", '{"a": 1}', '[{"column": "a"}]'):
        with pytest.raises(query.QueryError):
            query.QuerySpec.parse("[]", bad)


def test_pushed_to_parquet(spark, tmp_path, rows):
    rows.write.parquet(str(tmp_path / "t"))
    df = query.run_query(spark.read.parquet(str(tmp_path / "t")), query.QuerySpec(columns=["id"], constraints=[query.Constraint("x", ">", 2)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,2.0)" in plan and "name" not in plan.split("ReadSchema")[1]


def test_row_range():
    assert query.row_range(10, 20) == "21-30"


def test_incident_filter(spark):
    df = spark.createDataFrame([(0.5004,), (0.51,)], "v double")
    assert df.where(query.incident_filter("v", "double", "=", 0.5)).count() == 1
    assert df.where(F.col("v") > 0).count() == 2
