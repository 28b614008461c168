import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tillstar.operators import aggregates, keys, rows as ops
from tillstar.operators.keys import with_keys, with_scan_position
from tillstar.operators.lookup import lookup_scd2
from tillstar.operators.pairs import name_pairs


def test_keys_are_dense_ordered_and_offset(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(7)
    keyed = with_keys(df, "k", ["v"], start=11, partitions=5)
    got = sorted(keyed.collect(), key=lambda r: r["k"])
    assert [r["k"] for r in got] == list(range(11, 5011))
    assert [r["v"] for r in got] == sorted(r["v"] for r in got)


def test_keys_of_many_copies_spread_over_partitions(spark, ctx):
    path = ctx.scratch("copies")
    spark.range(4000).select(F.lit("same").alias("v")).repartition(4).write.parquet(path)
    placed = with_scan_position(spark.read.parquet(path))
    keyed = with_keys(placed, "k", ["v", "_scan_position"], partitions=4)
    assert [r["k"] for r in keyed.orderBy("k").collect()] == list(range(1, 4001))
    spread = placed.repartitionByRange(4, "v", "_scan_position").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 4 and max(r["count"] for r in spread) < 2000


def test_keys_of_nothing(spark):
    assert with_keys(spark.range(0).toDF("v"), "k", ["v"]).count() == 0


def test_keep_latest_takes_the_newest_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 3, "c"), (2, 1, "d")], "k int, t int, v string")
    assert rows(ops.keep_latest(df, ["k"], [F.col("t").desc(), F.col("v")])) == [(1, 5, "a"), (2, 1, "d")]


def test_keep_latest_trims_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = ops.keep_latest(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_dedupe_passes_rows_without_key_through(spark):
    t1, t2 = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    df = spark.createDataFrame(
        [("a", 1, t1, 1, "h1"), ("a", 2, t2, 2, "h2"), (None, 3, t1, 1, "h3"), (None, 3, t1, 1, "h3")],
        "id string, v int, load_timestamp timestamp_ntz, load_id bigint, row_hash string",
    )
    assert [r[1] for r in rows(ops.dedupe_staged(df, "id"), "id", "v")] == [2, 3, 3]
    assert rows(ops.latest_load(df, "id"), "id", "v") == [("a", 2)]


def test_anti_selection_keeps_rows_when_existing_keys_hold_null(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    seen = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(ops.not_yet_in(df, seen, ["k"])) == [("b",)]
    assert rows(ops.already_in(df, seen, ["k"])) == [("a",)]


def test_upsert_and_insert_missing(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(ops.upsert(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(ops.insert_missing(old, new, ["k"])) == [(1, "a"), (2, "b"), (3, "C")]


def test_differs_treats_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, "a", "a"), (4, "a", "b")], "i int, x string, y string")
    assert rows(df.filter(ops.differs([(F.col("x"), F.col("y"))])), "i") == [(2,), (4,)]


@pytest.mark.parametrize("inclusive, expected", [(False, ["v2"]), (True, ["v1", "v2"])])
def test_change_day_matches_one_version_unless_inclusive(spark, inclusive, expected):
    d = dt.date
    dim = spark.createDataFrame(
        [("c", "v1", d(2000, 1, 1), d(2001, 1, 1)), ("c", "v2", d(2001, 1, 1), d(9999, 12, 31))],
        "id string, version string, valid_from date, valid_to date",
    )
    sales = spark.createDataFrame([("c", d(2001, 1, 1))], "id string, day date")
    assert [v for (v,) in rows(lookup_scd2(sales, dim, "id", "day", "version", inclusive=inclusive), "version")] == expected


def test_sales_before_the_first_version_are_dropped_or_kept_with_null(spark):
    d = dt.date
    dim = spark.createDataFrame([("c", 1, d(2000, 1, 1), d(9999, 12, 31))], "id string, k int, valid_from date, valid_to date")
    sales = spark.createDataFrame([("c", d(1999, 1, 1)), ("x", d(2001, 1, 1))], "id string, day date")
    assert lookup_scd2(sales, dim, "id", "day", "k").count() == 0
    assert rows(lookup_scd2(sales, dim, "id", "day", "k", how="left"), "id", "k") == [("c", None), ("x", None)]


def test_several_distinct_counts_with_null_groups(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "b"), (1, 2, None), (1, 3, "c")], "g int, x int, y string")
    out = aggregates.group_with_distincts(df, ["g"], {"n": F.count(F.lit(1))}, {"dx": "x", "dy": "y"})
    assert rows(out, "g", "n", "dx", "dy") == [(1, 2, 2, 1), (None, 2, 1, 2)]
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan ") == 1  # one pass on tagged values


def brute_pairs(facts, names, minimum):
    baskets = defaultdict(list)
    for txn, key, net in facts:
        baskets[txn].append((key, net))
    seen, count, total = defaultdict(set), defaultdict(int), defaultdict(int)
    for txn, lines in baskets.items():
        for k1, s1 in lines:
            for k2, s2 in lines:
                if k1 < k2:
                    pair = (names[k1], names[k2])
                    seen[pair].add(txn)
                    count[pair] += 1
                    total[pair] += s1 + s2
    return sorted((*p, len(t), count[p], total[p]) for p, t in seen.items() if len(t) >= minimum)


@pytest.mark.parametrize("slice_size", [1000, 3])
def test_pairs_match_brute_force_with_a_hot_basket(spark, slice_size):
    rng = random.Random(5)
    names = {k: f"n{k % 9}" for k in range(40)}
    facts = [(f"t{rng.randrange(30)}", rng.randrange(40), rng.randrange(100)) for _ in range(300)]
    facts += [("hot", rng.randrange(40), rng.randrange(100)) for _ in range(150)]
    fact = spark.createDataFrame(facts, "transaction_id string, product_key bigint, net bigint").select(
        "transaction_id", "product_key", F.col("net").cast("decimal(12,2)").alias("net_amount")
    )
    product = spark.createDataFrame(list(names.items()), "product_key bigint, product_name string")
    got = rows(name_pairs(fact, product, 5, slice_size), "product_1", "product_2", "times_bought_together", "line_pairs", "value")
    assert [(a, b, n, m, int(v)) for a, b, n, m, v in got] == brute_pairs(facts, names, 5)


def test_share_uses_the_total_of_all_groups(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], T.StructType.fromDDL("g string, v int"))
    assert rows(aggregates.share_of_total(df, "v", "p"), "g", "p") == [("a", 25.0), ("b", 75.0)]


def test_pairs_that_cannot_reach_the_support_are_not_formed(spark):
    """A thousand pairs bought once and one pair bought often: only what shares the bucket of the latter is formed."""
    from tillstar.operators import pairs

    single = spark.range(2000).selectExpr("concat('t', id div 2) as transaction_id", "id as product_key", "id as name_id")
    often = spark.range(20).selectExpr("concat('o', id div 2) as transaction_id", "5000 + id % 2 as product_key", "5000 + id % 2 as name_id")
    # each name of a single pair is on many lines of its own, so that names alone rule nothing out
    alone = spark.range(20000).selectExpr("concat('a', id) as transaction_id", "id % 2000 as product_key", "id % 2000 as name_id")
    lines = single.union(often).union(alone).selectExpr("*", "1L as n", "cast(1 as decimal(28,2)) as s")
    for slice_size in (1, 1000):
        formed = pairs.likely_pairs(lines, 10, slice_size)
        assert formed.filter("a = 5000 and b = 5001").count() == 10
        assert formed.count() < 20
        assert pairs.likely_pairs(lines, 1, slice_size).count() == 1010
        assert pairs.likely_pairs(lines, 10, slice_size, buckets=1).count() == 1010


def test_several_distinct_counts_read_the_table_once(spark, tmp_path):
    spark.range(500).selectExpr("id % 3 as g", "id % 7 as x", "id % 11 as y", "id as z").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = aggregates.group_with_distincts(df, ["g"], {"n": F.count(F.lit(1))}, {"dx": "x", "dy": "y", "dg": "g"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial" in plan
    assert rows(out) == [(g, len(range(g, 500, 3)), 7, 11, 1) for g in range(3)]


def test_only_copies_are_ranked_and_the_latest_stay(spark, monkeypatch):
    df = spark.createDataFrame(
        [("a", 1, 1, "h1"), ("a", 2, 2, "h2"), ("b", 3, 1, "h4"), ("b", 4, 1, "h3"), ("b", 4, 1, "h3"), ("c", 5, 1, "h5"),
         (None, 6, 1, "h6"), (None, 6, 1, "h6")], "id string, v int, load_id bigint, row_hash string")
    expected = rows(ops.latest_load(df, "id"), "id", "v")
    assert rows(ops.latest_of_copies(df, "id"), "id", "v") == expected == [("a", 2), ("b", 4), ("c", 5)]
    monkeypatch.setattr(ops, "MOST_REPEATED", 1)
    assert rows(ops.latest_of_copies(df, "id"), "id", "v") == expected
    once = ops.latest_of_copies(df.filter("id = 'c' or id is null"), "id")
    assert rows(once, "id", "v") == [("c", 5)]
    assert "Window" not in once._jdf.queryExecution().executedPlan().toString()


def test_ranges_follow_the_rows_and_keys_stay_the_same(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(3)
    assert keys.ranges_for(spark, 5000) is None
    expected = rows(with_keys(df, "k", ["v"], store_first=True), "k", "v")
    monkeypatch.setattr(keys, "RANGE_ROWS", 100)
    assert keys.ranges_for(spark, 5000) == 50 and keys.ranges_for(spark, 5001) == 51
    keyed = with_keys(df, "k", ["v"], store_first=True)
    assert rows(keyed, "k", "v") == expected
    sizes = [r["count"] for r in df.repartitionByRange(keys.ranges_for(spark, 5000), "v").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 400
