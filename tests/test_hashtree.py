"""Hash trees: descent finds every difference and reads little."""

from pyspark.sql import functions as F

from vintora.operators import hashtree


def test_one_row_of_a_million(spark, tmp_path):
    n = 1_000_000
    old = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 977).alias("v"), F.lit("x").alias("w"))
    new = old.withColumn("v", F.when(F.col("k") == 654_321, F.lit(None)).otherwise(F.col("v")))
    depth = hashtree.depth_for(n)
    assert depth == 2 and hashtree.depth_for(4096) == 0 and hashtree.depth_for(10**9) == 5
    for rows, name in ((old, "a"), (new, "b")):
        hashtree.write(rows, f"{tmp_path}/{name}", ["k"], ["v", "w"], depth)
    trees = [spark.read.parquet(f"{tmp_path}/{x}/tree") for x in "ab"]
    assert sorted((r.level, r["n"]) for r in trees[0].groupBy("level").agg(F.sum("n").alias("n")).collect()) == [(k, n) for k in range(3)]
    open_ = hashtree.differing_leaves(*trees, depth)
    assert open_.count() == 1
    read = hashtree.rows_of(spark, f"{tmp_path}/a", open_, depth)
    assert 0 < read.count() < n / 100
    assert "PartitionFilters: [isnotnull(_folder" in read._jdf.queryExecution().toString()
    got = hashtree.differing_written(spark, f"{tmp_path}/a", f"{tmp_path}/b", ["k"], ["v", "w"]).collect()
    assert [(r.k, r.difference) for r in got] == [(654_321, "differs")]


def test_every_kind_of_difference(spark, tmp_path):
    schema = "k long, l string, v double, w string"
    old = [(k, str(k % 3), float(k), None if k % 5 else "f") for k in range(300)] + [(None, "n", 1.0, None), (None, None, 2.0, "t"), (7, None, 1.0, None), (500, "e", None, "1"), (501, "e", 1.0, None)]
    new = [r for r in old if r[0] not in (3, 500)] + [(999, "a", 1.0, None), (500, "e", 1.0, None)]
    new = [(r[0], r[1], -r[2], r[3]) if r[:2] in ((10, "1"), (None, "n")) else r for r in new]
    want = {(3, "0", "left_only"), (999, "a", "right_only"), (500, "e", "differs"), (10, "1", "differs"), (None, "n", "differs")}
    a, b = (spark.createDataFrame(x, schema) for x in (old, new))
    for depth in (None, 0, 1, 3):
        got = hashtree.differing_rows(a, b, ["k", "l"], ["v", "w"], depth).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    none = a.where("false")
    assert hashtree.differing_rows(none, a, ["k", "l"], ["v", "w"]).count() == len(old)
    assert hashtree.differing_rows(none, none, ["k", "l"], ["v", "w"]).count() == 0
    for rows, name in ((none, "a"), (a, "b")):
        hashtree.write(rows, f"{tmp_path}/{name}", ["k", "l"], ["v", "w"], 1)
    assert hashtree.differing_written(spark, f"{tmp_path}/b", f"{tmp_path}/b", ["k", "l"], ["v", "w"]).count() == 0
