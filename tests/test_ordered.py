"""Split windows must equal plain windows, also when one group holds most of the rows and ranges are tiny."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leaguelake.operators.ordered import OrderedRows, global_row_number, row_number_per


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        team = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None, *map(str, range(60))])
        day = None if rng.random() < 0.02 else rng.randint(1, 9)
        data.append((team, day, rng.choice([None, *range(5)]), rng.random(), i))
    schema = "team string, day int, goals int, score double, id long"
    return spark.createDataFrame(data, schema).repartition(4).cache()


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert sorted(map(repr, left.select(columns).collect())) == sorted(map(repr, right.select(columns).collect()))


ORDERS = [["day", "id"], ["-day", "-score", "id"], ["-day", "team", "-id"]]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("groups", [[], ["team"]])
def test_numbers(rows, order, groups):
    plain = OrderedRows(rows, order, groups, ranges=1).number("rn", from_end="back").result()
    split = OrderedRows(rows, order, groups, ranges=40)
    assert split.base.filter("_range > 0").count() > 500
    same(plain, split.number("rn", from_end="back").result())


@pytest.mark.parametrize("order", ORDERS)
def test_running_and_rolling(rows, order):
    def everything(o):
        return (
            o.running(s=("sum", "goals"), n=("count", "goals"), low=("min", "goals"), high=("max", "goals"), seen=("last", "goals"))
            .rolling(5, avg5=F.avg("goals"), n5=F.count("goals"), form=F.collect_list("goals"))
            .previous(before="id")
            .result()
        )

    plain = everything(OrderedRows(rows, order, ["team"], ranges=1))
    for ranges in (5, 300):
        same(plain, everything(OrderedRows(rows, order, ["team"], ranges=ranges)))


def test_descending_text_is_only_a_tie_break(rows):
    plain = rows.withColumn(
        "rn", F.row_number().over(W.orderBy(F.col("day"), F.col("team").desc_nulls_last(), "id")).cast("long")
    )
    same(plain, global_row_number(rows, ["day", "-team", "id"], "rn", ranges=10))


def test_number_per_group(rows):
    plain = rows.withColumn("rn", F.row_number().over(W.partitionBy("day").orderBy("id")).cast("long"))
    same(plain, row_number_per(rows, ["day"], ["id"], "rn", ranges=30))


def test_plan_is_lazy_and_parallel(spark, rows):
    """Nothing runs while the plan is built; no row of the data goes through a single partition."""
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    out = OrderedRows(rows, ["day", "id"], ["team"]).number("rn").running(s=("sum", "goals")).result()
    whole = global_row_number(rows, ["-day", "id"], "rn")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    assert out.count() == whole.count() == rows.count()
    for df in (out, whole):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_empty_small_and_equal_groups(spark, rows):
    for some in (rows.limit(0), rows.limit(1), rows.filter("team = 'hot'"), rows.filter("id < 7")):
        for groups in ([], ["team"]):
            plain = some.withColumn("rn", F.row_number().over(W.partitionBy(*groups).orderBy("id")).cast("long"))
            same(plain, row_number_per(some, groups, ["id"], "rn", ranges=16))


@pytest.mark.parametrize("order", [["-text", "-flag", "-id"], ["-amount", "id"], ["-text", "id"]])
def test_descending_kinds(spark, order):
    texts = ["", "a", "A", "ab", "abc", "b", "é", "日", None, "\x00", "a\x00"]
    data = [(texts[i % 11], [True, False, None][i % 3], None if i % 13 == 0 else i % 17 / 4 - 2, i) for i in range(900)]
    df = spark.createDataFrame(data, "text string, flag boolean, amount decimal(9,2), id long".replace("decimal(9,2)", "double"))
    df = df.withColumn("amount", F.col("amount").cast("decimal(9,2)"))
    plain = OrderedRows(df, order, (), ranges=1).number("rn").result()
    same(plain, OrderedRows(df, order, (), ranges=25).number("rn").result())


def test_a_column_of_the_same_name_is_replaced(rows):
    small = rows.filter("id < 200")
    plain = small.withColumn("id", F.row_number().over(W.orderBy("id")).cast("long"))
    same(plain, global_row_number(small, ["id"], "id", ranges=5))


@pytest.mark.parametrize("groups", [[], ["team"]])
def test_a_row_looks_for_its_range_once(rows, groups):
    partials = OrderedRows(rows, ["day", "id"], groups, ranges=40)._per_range("count(1) AS _n")
    plan = partials._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("filter(") == 2  # among chunks, and inside one
