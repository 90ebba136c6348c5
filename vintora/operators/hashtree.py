"""Two versions of a table compared by a tree of hashes: only rows below differing hashes are joined.

A leaf holds the rows whose key's hash begins with the same bits; how many bits follows from the number of rows, so a leaf
holds about LEAF_ROWS of them at any size. Every node has the count and the exclusive sum of the row hashes below it. Null
differs from any value, also in keys; a row that stands twice shows by the counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintora.plans.scratch import stored

#: Rows of a leaf, about; each level has 16 times the nodes of the one above.
LEAF_ROWS, BITS = 4096, 4
#: Bits of a key's hash by which stored rows are dealt to folders, at most.
FOLDER_BITS = 8


def depth_for(rows: int) -> int:
    """Levels below the root that bring a leaf down to LEAF_ROWS."""
    depth = 0
    while rows > LEAF_ROWS << (BITS * depth) and depth < 12:
        depth += 1
    return depth


def _hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))  # nulls alone leave a hash as it is


def leaf(key: Sequence[str], depth: int) -> Column:
    return F.shiftrightunsigned(_hash(key), 64 - BITS * depth) if depth else F.lit(0).cast("long")


def hash_tree(rows: DataFrame, key: Sequence[str], values: Sequence[str], depth: int) -> DataFrame:
    """level, node, n, h of every node that has rows: rows are aggregated to leaves, leaves to all levels at once."""
    leaves = rows.groupBy(leaf(key, depth).alias("leaf")).agg(F.count("*").alias("n"), F.bit_xor(_hash([*key, *values])).alias("h"))
    each = leaves.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    return each.groupBy("level", F.expr(f"shiftright(leaf, {BITS} * ({depth} - level))").alias("node")).agg(F.sum("n").alias("n"), F.bit_xor("h").alias("h"))


def differing_leaves(left: DataFrame, right: DataFrame, depth: int) -> DataFrame:
    """leaf of the leaves that differ; a level's nodes are looked at only below nodes that differ. Both trees have this depth."""
    open_ = None
    for level in range(depth + 1):
        sides = [tree.where(F.col("level") == level).select("node", F.struct("n", "h").alias(tag)) for tree, tag in ((left, "_l"), (right, "_r"))]
        if open_ is not None:
            above = open_.select(F.col("node").alias("_up"))
            sides = [s.withColumn("_up", F.shiftright("node", BITS)).join(above, "_up", "left_semi").drop("_up") for s in sides]
        open_ = sides[0].join(sides[1], "node", "full_outer").where("NOT (_l <=> _r)").select("node")
    return open_.select(F.col("node").alias("leaf"))


def _compared(a: DataFrame, b: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    side = lambda df, tag: df.select(*(F.col(c).alias(f"{tag}{c}") for c in key), F.struct(*values).alias(tag), F.lit(True).alias(f"{tag}_in"))
    same = F.lit(True)
    for c in key:
        same &= F.col(f"_a{c}").eqNullSafe(F.col(f"_b{c}"))
    both = side(a, "_a").join(side(b, "_b"), same, "full_outer")
    kind = F.when(F.col("_b_in").isNull(), "left_only").when(F.col("_a_in").isNull(), "right_only").when(~F.col("_a").eqNullSafe(F.col("_b")), "differs")
    name = lambda c: F.when(F.col("_a_in").isNull(), F.col(f"_b{c}")).otherwise(F.col(f"_a{c}")).alias(c)
    return both.select(*map(name, key), kind.alias("difference")).where("difference IS NOT NULL")


def differing_rows(a: DataFrame, b: DataFrame, key: Sequence[str], values: Sequence[str], depth: int | None = None) -> DataFrame:
    """key, difference (left_only, right_only, differs). Trees are stored; then only rows of differing leaves are shuffled."""
    depth = depth_for(a.count()) if depth is None else depth
    trees = [stored(hash_tree(rows, key, values, depth), "hash-tree") for rows in (a, b)]
    open_ = differing_leaves(*trees, depth)
    below = [rows.withColumn("_leaf", leaf(key, depth)).join(open_.withColumnRenamed("leaf", "_leaf"), "_leaf", "left_semi").drop("_leaf") for rows in (a, b)]
    return _compared(*below, key, values)


def write(rows: DataFrame, path: str, key: Sequence[str], values: Sequence[str], depth: int) -> None:
    """Rows by leaf, in folders of the first bits, with their tree beside them."""
    folder = F.shiftright("_leaf", max(0, BITS * depth - FOLDER_BITS))
    dealt = rows.select(*key, *values, leaf(key, depth).alias("_leaf")).withColumn("_folder", folder.cast("int"))
    dealt.repartitionByRange("_leaf").sortWithinPartitions("_leaf").write.partitionBy("_folder").parquet(f"{path}/rows")
    dealt.limit(0).write.parquet(f"{path}/columns")  # an empty table has no folders that tell them
    hash_tree(_written(rows.sparkSession, path), key, values, depth).write.parquet(f"{path}/tree")


def _written(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/rows")


def rows_of(spark: SparkSession, path: str, open_: DataFrame, depth: int) -> DataFrame:
    """The written rows of some leaves; other folders aren't opened."""
    folders = open_.select(F.shiftright("leaf", max(0, BITS * depth - FOLDER_BITS)).cast("int").alias("f")).distinct()
    wanted = [r.f for r in folders.collect()]  # 2**FOLDER_BITS at most
    rows = _written(spark, path).where(F.col("_folder").isin(wanted) if wanted else F.lit(False))
    return rows.join(open_.withColumnRenamed("leaf", "_leaf"), "_leaf", "left_semi")


def differing_written(spark: SparkSession, a: str, b: str, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """differing_rows of two written tables: trees are read, and rows of differing leaves. Their depths must be equal."""
    trees = [spark.read.parquet(f"{path}/tree") for path in (a, b)]
    depths = {tree.agg(F.max("level")).first()[0] for tree in trees} - {None}  # an empty table has no nodes
    if len(depths) > 1:
        raise ValueError(f"trees of different depths: {sorted(depths)}")
    depth = depths.pop() if depths else 0
    open_ = stored(differing_leaves(*trees, depth), "open-leaves")
    return _compared(*(rows_of(spark, path, open_, depth) for path in (a, b)), key, values)
