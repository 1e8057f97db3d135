import random

from pyspark.sql import functions as F

from quarryline.operators import scale


def _skewed(spark, n=3000):
    """A third of the rows share one key; one key is null."""
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None]), i, rng.randint(1, 9)) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "key string, id long, size long"), rows


def test_running_sum_equals_a_plain_loop(spark):
    df, rows = _skewed(spark)
    found = scale.running_sum(df.repartition(7), ["key"], [F.col("id")], F.col("size"), "before")
    expected, totals = {}, {}
    for key, id_, size in sorted(rows, key=lambda r: r[1]):
        expected[id_] = totals.get(key, 0)
        totals[key] = totals.get(key, 0) + size
    assert {r["id"]: r["before"] for r in found.collect()} == expected


def test_number_rows_is_the_same_with_and_without_a_bound(spark):
    df, _ = _skewed(spark)
    order = [F.desc("size"), F.col("id")]
    wide = scale.number_rows(df, ["key"], order, "n")
    plain = scale.number_rows(df, ["key"], order, "n", rows_per_key=3000)
    assert sorted(map(tuple, wide.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_number_rows_splits_a_hot_key_over_tasks(spark):
    df = spark.range(20000).select(F.lit("one").alias("key"), "id")
    numbered = scale.number_rows(df, ["key"], [F.col("id")], "n")
    assert numbered.where("n <> id + 1").isEmpty()


def test_first_per_key_ignores_input_order(spark):
    df, rows = _skewed(spark)
    best = {}
    for key, id_, size in rows:
        best[key] = min(best.get(key, (10, 0)), (size, id_))
    for parts in (1, 5):
        found = scale.first_per_key(df.repartition(parts), ["key"], [F.col("size"), F.col("id")])
        assert {r["key"]: (r["size"], r["id"]) for r in found.collect()} == best


def test_top_k_beyond_the_group_limit(spark):
    df, _ = _skewed(spark)
    order = [F.desc("size"), F.col("id")]
    plain = scale.top_k(df, ["key"], order, 5, spread="id")
    assert "WindowGroupLimit" in plain._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "4")
    try:
        spread = scale.top_k(df, ["key"], order, 5, spread="id", buckets=3)
        assert "_salt" in spread._jdf.queryExecution().analyzed().toString()
        assert sorted(map(str, plain.collect())) == sorted(map(str, spread.collect()))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_small_join_beyond_the_bound_gives_the_same_rows(spark):
    df, _ = _skewed(spark)
    small = spark.createDataFrame([("hot", 1), ("a", 2), ("a", 3), ("z", 4)], "key string, x int")
    for how in ("inner", "left", "left_semi"):
        broadcast = scale.small_join(df, small, ["key"], how)
        salted = scale.small_join(df, small, ["key"], how, spread="id", limit=0, buckets=4)
        assert "BroadcastHashJoin" in broadcast._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, broadcast.collect())) == sorted(map(str, salted.collect()))


def test_measure_counts_text_and_arrays(spark):
    df = spark.createDataFrame([("abc", [1.0, 2.0]), (None, None)], "t string, v array<double>")
    rows, size = scale.measure(df)
    assert rows == 2 and 32 + 3 + 16 <= size <= 32 + 3 + 32
    nested = spark.createDataFrame([(["x" * 10_000], {"k": "y" * 10_000})], "a array<string>, m map<string,string>")
    assert scale.measure(nested)[1] > 20_000
