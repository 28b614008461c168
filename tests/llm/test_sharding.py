"""Shards hold every row once, in gapless slots, and differ by a row at most."""

import collections
import zlib

from tillstar.llm import queries, sharding

SMALL = "/root/testdata/sf0.001"


def check(rows, shards):
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1


def test_query(spark):
    got = queries.op9_sharding(spark, SMALL).collect()
    want = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    digest = [(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in want]
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(digest)
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    check(got, 16)


def test_copies_nulls_long_texts_and_clashing_names(spark):
    rows = [(i, f"text {i}", "x", 5) for i in range(200)] + [(7, "same", None, 1)] * 150
    rows += [(None, None, None, None)] * 40 + [(1000, "", "", 0), (1001, "long " * 200_000, "z", 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, bucket string, slot int")
    got = sharding.two_pass_shuffle(df, shards=7, bucket_bytes=2000)
    assert sorted(got.columns) == ["bucket", "doc_id", "shard", "slot", "text"]
    got = got.collect()
    check(got, 7)
    assert collections.Counter((r.doc_id, r.text, r.bucket) for r in got) == collections.Counter(r[:3] for r in rows)
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.slot, r.shard)) if r.doc_id is not None]
    assert order != sorted(order)


def test_written_shards_keep_slot_order(spark, ctx):
    df = spark.createDataFrame([(i, str(i)) for i in range(100)], "doc_id bigint, text string")
    path = ctx.scratch("shards")
    sharding.write_shards(sharding.two_pass_shuffle(df, shards=4), path)
    back = spark.read.parquet(path).collect()
    assert sorted(r.doc_id for r in back) == list(range(100))
    check(back, 4)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert sharding.two_pass_shuffle(df).collect() == []
