"""Exact deduplication by an extendible-hash index on shared files.

A text's key is its 64-bit hash once A-Z are lower-cased. The directory starts as one bucket and doubles, a leading
bit of the hash at a time, as long as a bucket holds more bytes than a page; only overfull buckets split, so sparse
neighbours stay together under several directory entries. A bucket that no doubling makes small enough, as it holds
one text over and over, gets overflow pages among which its rows are dealt one by one. So every page has about the
same size whatever the data, and pages are numbered in the order of their keys.

Each page has an owner task. It sorts its rows by hash, chains the texts that share one, and compares their bytes:
hashes only say where to look. Chains of overflow pages are then joined by one head for each page and text, again by
their bytes. The entries (page, hash, place in the chain, row) are written to the shared folder.

Everything is built-in functions; whole texts are shuffled once and sorted by page, and nothing but sums gets to the
driver. Odd input: null counts as the empty text, which is a text like any other; of equal texts the row with the
largest doc_id stays, rows without an id only where no other has one; of rows that repeat id and text one stays;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.llm._io import discard, stored, text_of

#: Bytes of a page, of which a row takes ROW_BYTES besides its text.
PAGE_BYTES, ROW_BYTES = 16 << 20, 256
#: With more pages than about this many, pages get larger instead.
MOST_PAGES = 1 << 16
#: Leading bits of the hash by which bytes are counted: the directory never has more than 2**LEAF_BITS entries.
LEAF_BITS = 20
#: Doublings beyond those that even hashes need.
MORE_DEPTH = 3


def lowered(text: Column) -> Column:
    """Text with A-Z, and no other letters, in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (lower-cased), hash."""
    return docs.select("doc_id", lowered(text_of()).alias("text")).withColumn("hash", F.xxhash64("text"))


def leading(bits: int) -> Column:
    return F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("long")


def directory(leaves: DataFrame, depth: int, page_bytes: float) -> DataFrame:
    """slot (the first `depth` bits of a hash), first_page, pages: where rows of that slot go.

    leaves: leaf (the first LEAF_BITS bits), bytes. A bucket is a prefix that fits a page, or can't be made longer, below
    one that doesn't fit.
    """
    slots = leaves.groupBy(F.shiftrightunsigned("leaf", LEAF_BITS - depth).alias("slot")).agg(F.sum("bytes").alias("bytes"))
    tree = slots.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    tree = tree.groupBy("depth", F.expr(f"shiftrightunsigned(slot, {depth} - depth)").alias("prefix")).agg(F.sum("bytes").alias("bytes"))
    overfull = tree.where(F.col("bytes") > page_bytes).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    below = tree.withColumn("parent", F.shiftrightunsigned("prefix", 1)).join(overfull, ["depth", "parent"], "left_semi")
    buckets = below.unionByName(tree.where("depth = 0").withColumn("parent", F.lit(0).cast("long")))
    buckets = buckets.where((F.col("bytes") <= page_bytes) | (F.col("depth") == depth))
    start = F.expr(f"shiftleft(prefix, {depth} - depth)")
    pages = buckets.select(start.alias("slot"), F.expr(f"shiftleft(1L, {depth} - depth)").alias("slots"), F.ceil(F.col("bytes") / page_bytes).cast("int").alias("pages"))
    # a row for each bucket: at most 2**LEAF_BITS, about twice the number of pages
    pages = pages.withColumn("first_page", (F.sum("pages").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))))
    return pages.select(F.explode(F.expr("sequence(slot, slot + slots - 1)")).alias("slot"), F.coalesce("first_page", F.lit(0)).cast("int").alias("first_page"), "pages")


def placed(rows: DataFrame) -> tuple[DataFrame, int]:
    """rows (of keyed) with page and pages (of their bucket), and the number of pages. The directory is stored."""
    weight = F.octet_length("text").cast("long") + ROW_BYTES
    leaves = stored(rows.groupBy(leading(LEAF_BITS).alias("leaf")).agg(F.sum(weight).alias("bytes")), "leaves")
    total = leaves.agg(F.sum("bytes")).first()[0] or 0
    page_bytes = max(PAGE_BYTES, total / MOST_PAGES)
    depth = min(LEAF_BITS, math.ceil(math.log2(max(1, total / page_bytes))) + MORE_DEPTH)
    index = stored(directory(leaves, depth, page_bytes), "directory")
    discard(leaves)
    count = index.agg(F.max(F.col("first_page") + F.col("pages"))).first()[0] or 1
    # bounded: 2**LEAF_BITS rows of three numbers at most
    dealt = rows.withColumn("slot", leading(depth)).join(F.broadcast(index), "slot")
    deal = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.col("pages")).cast("int")
    return dealt.select("doc_id", "text", "hash", (F.col("first_page") + deal).alias("page"), "pages"), count


def entries(docs: DataFrame) -> DataFrame:
    """The index: page, pages, hash, chain (place of the text among those of its hash on the page), place (of the row among
    those of its text there, largest id first), doc_id, keep_id, group_size, text_sha256; head is the text itself on the first
    row of a text on an overflow page. keep_id and group_size speak of the page alone."""
    rows, pages = placed(keyed(docs))
    same = Window.partitionBy("hash", "page", "text").orderBy(F.col("doc_id").desc_nulls_last())
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = rows.repartitionById(pages, "page").select(
        "page", "pages", "hash", "doc_id", "text",
        F.row_number().over(same).alias("place"),
        F.max("doc_id").over(whole).alias("keep_id"),
        F.count("*").over(whole).alias("group_size"),
        F.dense_rank().over(Window.partitionBy("hash", "page").orderBy("text")).alias("chain"),
    )
    head = F.when((F.col("place") == 1) & (F.col("pages") > 1), F.col("text"))
    return stored(found.select(*found.columns[:4], "place", "keep_id", "group_size", "chain", F.sha2("text", 256).alias("text_sha256"), head.alias("head")), "entries")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of docs."""
    index = entries(docs)
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    alone = index.where("pages = 1").withColumn("kept", F.col("place") == 1)
    # texts of overflow pages: a head for each page and text, compared by bytes
    heads = index.where("head IS NOT NULL").select("page", "hash", "chain", "head", "keep_id", "group_size")
    best = F.max(F.struct("keep_id", "page"))
    groups = heads.groupBy("hash", "head").agg(best.alias("best"), F.sum("group_size").alias("group_size"))
    known = heads.select("page", "hash", "chain", "head").join(groups, ["hash", "head"]).select("page", "hash", "chain", F.col("best.keep_id").alias("keep_id"), F.col("best.page").alias("home"), "group_size")
    spread = index.where("pages > 1").drop("keep_id", "group_size").join(known, ["page", "hash", "chain"])
    spread = spread.withColumn("kept", (F.col("place") == 1) & (F.col("page") == F.col("home")))
    return alone.select(*out).unionByName(spread.select(*out))
