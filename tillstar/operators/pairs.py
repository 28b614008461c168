"""Product pairs bought in the same transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.operators.keys import stored_once
from tillstar.operators.lookup import own_exchange

# Distinct products of a basket that are paired in one row; larger baskets are paired in slices of it.
SLICE = 1000
# Buckets that pairs are counted in before they are formed. Those that can reach the support are broadcast:
# a number each, so no more than so many.
PAIR_BUCKETS = 1 << 20


def basket_lines(fact: DataFrame, product: DataFrame) -> DataFrame:
    """Lines summed per (transaction, product), with the smallest key of the product's name as ``name_id``."""
    summed = fact.groupBy("transaction_id", "product_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("net_amount").cast("decimal(28,2)").alias("s")
    )
    return summed.join(_named(product).select("product_key", "name_id"), "product_key")


def _named(product: DataFrame) -> DataFrame:
    first = product.groupBy("product_name").agg(F.min("product_key").alias("name_id"))
    return product.select("product_key", "product_name").join(
        first.withColumnRenamed("product_name", "_name"), F.col("product_name").eqNullSafe(F.col("_name"))).drop("_name")


def _pair(x: Column, y: Column, wide: bool) -> Column:
    """A pair of basket items; the one with the smaller product key comes first."""
    fields = [x["name_id"].alias("a"), y["name_id"].alias("b")]
    if wide:
        worth = (y["n"] * x["s"] + x["n"] * y["s"]).cast("decimal(38,2)")
        fields += [(x["n"] * y["n"]).alias("line_pairs"), worth.alias("value")]
    return F.struct(*fields)


def _all_pairs(lines: DataFrame, big: DataFrame, slice_size: int, wide: bool) -> DataFrame:
    """Rows ``transaction_id, slice, a, b`` (and ``line_pairs, value``) for each pair of products of a basket.

    A basket of ``slice_size`` products at most is one row with an array of its items, paired in place. A larger one is sliced
    by the second product's name: slices go to different tasks, and since a name lies in one slice,
    a name pair of a transaction is still formed in one place.
    """
    item = F.struct("product_key", "name_id", *(["n", "s"] if wide else []))
    items = lines.join(big, "transaction_id", "left_anti").groupBy("transaction_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    pairs = F.flatten(F.transform("items", lambda x, i: F.transform(
        F.slice("items", i + 2, F.size("items")), lambda y: _pair(x, y, wide))))
    small = items.filter(F.size("items") > 1).select("transaction_id", F.lit(0).alias("slice"), F.inline(pairs))

    parts = F.ceil(F.col("products") / F.lit(float(slice_size))).cast("int")
    sliced = lines.join(big.withColumn("transaction_id", own_exchange("transaction_id")), "transaction_id").withColumn("slices", parts)
    columns = ["product_key", "name_id", *(["n", "s"] if wide else [])]
    left = sliced.select(
        "transaction_id", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.struct(*columns).alias("x"))
    right = sliced.select(
        "transaction_id", F.pmod(F.xxhash64("name_id"), F.col("slices").cast("bigint")).cast("int").alias("slice"),
        F.struct(*columns).alias("y"))
    joined = left.join(right, ["transaction_id", "slice"]).filter("x.product_key < y.product_key")
    large = joined.select("transaction_id", "slice", _pair(F.col("x"), F.col("y"), wide).alias("p")).select("transaction_id", "slice", "p.*")
    return small.unionByName(large)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("a", "b"), F.lit(buckets).cast("bigint")).alias("bucket")


def likely_pairs(lines: DataFrame, min_transactions: int, slice_size: int = SLICE, buckets: int = PAIR_BUCKETS) -> DataFrame:
    """Pairs of products of a basket, without those whose names cannot share ``min_transactions`` transactions.

    Exact reductions only: a name on fewer lines (summed per transaction and product) than that is dropped, which empties a huge
    basket of one-off products; then pairs are counted in hash buckets, from product keys alone, and a pair whose whole
    bucket counts fewer is not formed. Buckets that remain are at most ``buckets`` numbers and are broadcast.
    """
    frequent = lines.groupBy("name_id").agg(F.count(F.lit(1)).alias("lines")).filter(F.col("lines") >= min_transactions)
    # an own exchange on the small side: a hot product name can be split
    kept = lines.join(frequent.select(own_exchange("name_id").alias("name_id")), "name_id")
    big = lines.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("products")).filter(F.col("products") > slice_size)
    counted = _all_pairs(kept, big, slice_size, wide=False).groupBy(_bucket(buckets)).agg(F.count(F.lit(1)).alias("pairs"))
    reach = counted.filter(F.col("pairs") >= min_transactions).select("bucket")
    wide = _all_pairs(kept, big, slice_size, wide=True).withColumn("bucket", _bucket(buckets))
    return wide.join(F.broadcast(reach), "bucket", "left_semi").drop("bucket")


def name_pairs(fact: DataFrame, product: DataFrame, min_transactions: int, slice_size: int = SLICE) -> DataFrame:
    """Per ordered pair of product names: shared transactions, line pairs and their value.

    Lines pair up within a transaction when the first product key is the smaller one. They are summed per (transaction, product)
    first and stored; n1 and n2 lines with sums s1 and s2 make n1*n2 line pairs worth n2*s1 + n1*s2, so
    copies of a line never multiply rows. Names are told apart by number until the pairs that count are known.
    """
    lines = stored_once(basket_lines(fact, product), "baskets")
    per_transaction = (
        likely_pairs(lines, min_transactions, slice_size)
        # still partitioned by transaction, or transaction and slice
        .groupBy("transaction_id", "slice", "a", "b")
        .agg(F.sum("line_pairs").alias("line_pairs"), F.sum("value").alias("value"))
    )
    names = _named(product).filter("product_key = name_id").select("name_id", "product_name")
    found = (
        per_transaction.groupBy("a", "b")
        .agg(
            F.count(F.lit(1)).alias("times_bought_together"),
            F.sum("line_pairs").alias("line_pairs"),
            F.sum("value").alias("value"),
        )
        .filter(F.col("times_bought_together") >= min_transactions)
    )
    return (
        found.join(names.select(F.col("name_id").alias("a"), F.col("product_name").alias("product_1")), "a")
        .join(names.select(F.col("name_id").alias("b"), F.col("product_name").alias("product_2")), "b")
        .select("product_1", "product_2", "times_bought_together", "line_pairs", "value")
    )
