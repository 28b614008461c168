import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillstar import schemas
from tillstar.sources import files, profile

NOW = dt.datetime(2024, 5, 6, 7, 8, 9)


def write(folder, name, *lines):
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    return path


HEADER = ",".join(schemas.SOURCE["stg_campaign_responses"].names)


def test_latest_file_by_time(spark, tmp_path):
    folder = str(tmp_path)
    old = write(folder, "products_2.csv", "x")
    write(folder, "products_1.csv", "x")
    write(folder, "other.csv", "x")
    os.utime(old, (time.time() - 5000,) * 2)
    assert files.latest_file(spark, folder, "products_*.csv").endswith("/products_1.csv")


def test_no_file_gives_none_and_the_load_fails_with_a_log_entry(spark, tmp_path, store):
    assert files.latest_file(spark, str(tmp_path), "products_*.csv") is None
    with pytest.raises(FileNotFoundError):
        files.load_source(store, "stg_products", str(tmp_path), now=NOW)
    assert rows(store.read("stg_audit_log"), "table_name", "rows_loaded", "load_status") == [("stg_products", 0, "FAILED")]


def test_load_counts_rejected_rows_and_hashes_source_columns(spark, tmp_path, store):
    write(str(tmp_path), "campaign_responses_1.csv", HEADER,
          "r1,m1,c1,2024-01-02,opened,0.00", "r2,m1,c1,not-a-date,opened,0.00", "r3,m1,c2,2024-01-03,converted,12.50")
    assert files.load_source(store, "stg_campaign_responses", str(tmp_path), now=NOW) == 2
    assert files.load_source(store, "stg_campaign_responses", str(tmp_path), now=NOW + dt.timedelta(days=1)) == 2
    loaded = store.read("stg_campaign_responses")
    assert loaded.schema.names == schemas.STAGING["stg_campaign_responses"].names
    assert loaded.count() == 4 and loaded.select("row_hash").distinct().count() == 2
    assert rows(loaded.select("load_id").distinct()) == [(20240506070809,), (20240507070809,)]
    log = store.read("stg_audit_log")
    assert rows(log, "rows_loaded", "rows_rejected", "load_status", "source_file") == [(2, 1, "SUCCESS", "campaign_responses_1.csv")] * 2


def test_table_versions(spark, store):
    assert not store.exists("t")
    with pytest.raises(FileNotFoundError):
        store.read("t")
    assert store.append(spark.range(3).toDF("x"), "t") == 3
    assert store.append(spark.range(2).toDF("x"), "t") == 2
    assert store.count("t") == 5
    assert store.replace(store.read("t").distinct(), "t") == 3
    assert rows(store.read("t")) == [(0,), (1,), (2,)] and store.version("t") == 2
    assert store.has_column("t", "x") and not store.has_column("t", "y")


def test_failed_rebuild_leaves_the_table(spark, store):
    store.replace(spark.range(3).toDF("x"), "t")
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("x"))
    with pytest.raises(Exception):
        store.replace(broken, "t")
    assert store.count("t") == 3
    assert store.replace(spark.range(1).toDF("x"), "t") == 1 and store.count("t") == 1


def test_profile_of_nulls_ties_and_types(spark):
    df = spark.createDataFrame(
        [("b", 1, True), ("a", 3, None), ("a", None, None), ("b", 3, False), (None, 3, True)], "s string, n int, f boolean"
    )
    got = {r["column_name"]: r for r in profile.profile(df, "t", NOW.date()).collect()}
    assert (got["s"]["null_count"], got["s"]["null_percentage"], got["s"]["distinct_count"], got["s"]["most_frequent_value"]) == (1, 20.0, 2, "a")
    assert (got["n"]["min_value"], got["n"]["max_value"], got["n"]["avg_value"], got["n"]["most_frequent_value"]) == ("1", "3", 2.5, "3")
    assert got["f"]["distinct_count"] == 2
    near = {r["column_name"]: r["distinct_count"] for r in profile.profile(df, "t", NOW.date(), approximate=True).collect()}
    assert near == {"s": 2, "n": 2, "f": 2}


def test_profile_of_an_empty_table(spark):
    got = profile.profile(spark.createDataFrame([], "s string"), "t", NOW.date()).first()
    assert (got["total_rows"], got["null_count"], got["distinct_count"], got["null_percentage"]) == (0, 0, 0, 0.0)


def test_csv_is_read_by_name_with_quotes_and_line_breaks(spark, ctx):
    from tillstar import schemas
    from tillstar.sources import files

    names = schemas.SOURCE["stg_products"].names
    order = ["product_category", *[n for n in names if n != "product_category"]]  # header in another order

    def line(**given):
        values = {n: "" for n in names} | given
        return ",".join('"' + v.replace('"', '""') + '"' if any(c in v for c in '",\n') else v for v in (values[n] for n in order))

    text = "\n".join([
        ",".join(order),
        line(product_id="1", product_name='12" vinyl, red', product_category="Music", unit_cost="1.50"),
        line(product_id="2", product_name="two\nlines", product_category="Toys", unit_cost=""),
        line(product_id="3", product_name="bad", product_category="Toys", unit_cost="dear"),
        line(product_id="4", product_name="short", product_category="Toys") .rsplit(",", 2)[0],
    ]) + "\n"
    folder = ctx.scratch("csv (a)")  # a name with signs of regular expressions
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/products_1.csv")
    out = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(path)
    out.write(bytearray(text.encode()))
    out.close()
    found = files.latest_file(spark, folder, "products_*.csv")
    assert found and found.endswith("products_1.csv")
    got = {r["product_name"]: r for r in files.read_source(spark, "stg_products", found).cache().collect()}
    good = {n: r for n, r in got.items() if r[files.CORRUPT] is None}
    assert set(good) == {'12" vinyl, red', "two\nlines"} and len(got) == 4
    assert good['12" vinyl, red']["product_category"] == "Music" and good["two\nlines"]["unit_cost"] is None


def test_uncommitted_batches_are_not_read(spark, store):
    store.append(spark.range(3).toDF("x"), "t")
    store.append(spark.range(10, 12).toDF("x"), "t")
    spark.range(90, 95).toDF("x").write.parquet(f"{store.path('t')}/load_batch=bbroken")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{store.path('t')}/load_batch=bbroken/_SUCCESS")
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, False)
    assert sorted(rows(store.read("t"))) == [(0,), (1,), (2,), (10,), (11,)] and store.columns("t") == ["x"]
    assert len(store.batches("t")) == 2


def test_profile_keeps_the_digits_of_doubles(spark):
    import datetime as dt

    from tillstar.sources.profile import profile

    df = spark.createDataFrame([(0.00001,), (0.00003,)], "x double")
    (r,) = profile(df, "t", dt.date(2001, 1, 1)).collect()
    assert abs(r["avg_value"] - 0.00002) < 1e-12


def _awkward_csv(rng, rows):
    """Records with quotes, doubled quotes, commas, line breaks, carriage returns and quotes within plain fields."""
    def field():
        kind = rng.randrange(7)
        text = "".join(rng.choice('ab ,"\nxyé') for _ in range(rng.randrange(9)))
        if kind == 0:
            return ""
        if kind == 1:
            return '"' + text.replace('"', '""') + '"'
        if kind == 2:
            return '"' + ("line\n" * rng.randrange(6)) + '"'
        if kind == 3:
            return rng.choice('abc') + rng.choice(['12" vinyl', 'x"y"z', "plain"])
        if kind == 4:
            return '"""' + text.replace('"', '""') + '"""'
        return rng.choice(["one", "two words", "3.5"])
    return ["c1,c2,c3", *[",".join(field() for _ in range(3)) for _ in range(rows)]]


def test_records_of_many_splits_are_those_of_one_reader(spark, tmp_path):
    import random

    from tillstar.sources.records import breaks_in_quotes, records

    rng, before = random.Random(4), spark.conf.get("spark.sql.files.maxPartitionBytes")
    options = {"quote": '"', "escape": '"'}
    try:
        for trial, split in enumerate((64, 200, 1000, 10_000_000)):
            path = tmp_path / f"t{trial}.csv"
            path.write_text("\n".join(_awkward_csv(rng, 400)) + "\n", newline="")
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            plain = spark.read.options(header=True, multiLine=True, **options).csv(str(path))
            want = [tuple(r) for r in plain.collect()]
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            got = records(spark, str(path))
            if split < 1000:
                assert got.select("file").rdd.getNumPartitions() > 1 and spark.read.text(str(path)).rdd.getNumPartitions() > 4
            parsed = got.select("number", F.from_csv("record", "c1 string, c2 string, c3 string", options).alias("r")).orderBy("number")
            have = [tuple(r.r) for r in parsed.collect()]
            assert have[0] == ("c1", "c2", "c3") and have[1:] == want
            assert [r.number for r in parsed.collect()] == sorted({r.number for r in parsed.collect()})
            assert breaks_in_quotes(spark, str(path))
        plain_file = tmp_path / "plain.csv"
        plain_file.write_text('a,b\n1,"x, y"\n2,12" vinyl\n"3","say ""hi"""\n', newline="")
        assert not breaks_in_quotes(spark, str(plain_file))
        assert [r.record for r in records(spark, str(plain_file)).orderBy("number").collect()] == plain_file.read_text().splitlines()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_file_with_line_breaks_is_read_by_several_tasks(spark, tmp_path):
    names = schemas.SOURCE["stg_campaign_responses"].names
    body = "".join(f'r{i},m1,"c\n{i}",2024-01-02,opened,{i}.50\r\n' for i in range(3000))
    path = tmp_path / "campaign_responses_9.csv"
    path.write_text(",".join(names) + "\r\n" + body + "bad,row\r\n", newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        df = files.read_source(spark, "stg_campaign_responses", str(path)).cache()
        assert df.count() == 3001 and df.filter(files.CORRUPT + " is not null").count() == 1
        one = df.filter("response_id = 'r77'").first()
        assert (one["customer_id"], str(one["conversion_value"])) == ("c\n77", "77.50")
        df.unpersist()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sketches_are_near_merge_and_need_one_scan(spark):
    import math

    df = spark.range(200_000).selectExpr(
        "cast(id as int) as k", "cast(id % 977 as decimal(9,2)) as m", "case when id % 3 = 0 then 'often' else concat('v', id) end as s",
        "case when id % 4 > 0 then date_add(date'2001-01-01', cast(id % 500 as int)) end as d", "id % 2 = 0 as f")
    whole = profile.sketches(df)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan
    parts = profile.sketches(df.filter("k % 2 = 0")).unionByName(profile.sketches(df.filter("k % 2 = 1")))
    exact = {r["column_name"]: r for r in profile.profile(df, "t", NOW.date()).collect()}
    for found in (whole, profile.merged(parts)):
        near = {r["column_name"]: r for r in profile.estimated(found, "t", NOW.date()).collect()}
        assert near.keys() == exact.keys()
        for name, want in exact.items():
            for same in ("total_rows", "null_count", "null_percentage", "min_value", "max_value", "avg_value", "data_type"):
                assert near[name][same] == want[same], (name, same)
            error = 4 * 0.8 / math.sqrt(2**profile.LG_K)
            assert abs(near[name]["distinct_count"] - want["distinct_count"]) <= max(1, error * want["distinct_count"])
        assert near["s"]["most_frequent_value"] == "often" and near["f"]["most_frequent_value"] == "false"
        got = {r["column_name"]: r["quantiles"] for r in profile.quantiles(found, [0.1, 0.5, 0.9]).collect()}
        assert set(got) == {"k", "m"}
        for rank, value in zip((0.1, 0.5, 0.9), got["k"]):
            assert abs(value / 200_000 - rank) <= 1.7 / profile.K * 3


def test_profiles_are_kept_by_table_and_day(spark, store):
    store.replace(spark.sql("select 1 as a, 'x' as b union all select 2, null"), "t")
    day = NOW.date()
    assert profile.store_profile(store, "t", day) == 2
    assert profile.store_profile(store, "t", day + dt.timedelta(days=1), approximate=True) == 2
    store.append(spark.sql("select 7 as a, 'x' as b"), "t")
    assert profile.store_profile(store, "t", day) == 2
    got = rows(store.read(profile.PROFILE), "profile_date", "column_name", "total_rows", "max_value", "avg_value", "most_frequent_value")
    assert got == sorted([(day, "a", 3, "7", 3.33, "1"), (day, "b", 3, "x", None, "x"),
                          (day + dt.timedelta(days=1), "a", 2, "2", 1.5, "1"), (day + dt.timedelta(days=1), "b", 2, "x", None, "x")], key=repr)
    assert store.read(profile.PROFILE).select("profile_id").distinct().count() == 4
