"""N-gram Jaccard join by prefix filtering under several global token orders.

A document is the set of its distinct word 5-grams. Two sets with a similarity of 0.8 or more share a token
among the first n - ceil(0.8 n) + 1 of each, whatever global order of tokens is used. The first order puts seldom
hashed 5-grams first; the others are pseudo-random orders, independent of it and of each other. The first order's
prefixes are joined by token; a candidate pair must also share prefix tokens under every other order, which is found
out from the prefixes alone; only what all filters leave has its sets joined in and counted in full.

Texts are read once: sets are stored by name and read again from there. Groups of copies never give all their pairs.
Equal sets are one node from the start. Nodes that share prefix tokens are first compared with one leader; what still
lies in different components is then paired through the seldom tokens (at most SELDOM nodes hold one, so pairs stay
in proportion), and through the frequent ones block by block: two blocks of nodes meet in a task, which tells only
which components they connect. Blocks meet only where the tokens that their nodes may still share leave room for a link
(see _meetings). So components are exact, though not every link inside one is looked at.

Sets and tokens are known by 64-bit hashes. Words are what stands between spaces and the ASCII controls 9-13;
A-Z count as a-z. Odd input: a text of 1 to 4 words is one shingle; null, empty or blank texts have none and
are linked with nothing; repeated rows are copies of each other; a null doc_id is kept and never a component's
name, unless there is no other; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintora.llm import tables
from vintora.llm._io import discard, small_batches, stored, trim
from vintora.llm.bpe import by_bytes
from vintora.llm.components import components

WORDS = 5
ORDERS = 3
#: Tokens that more nodes hold are joined block by block, not pair by pair.
SELDOM = 12
#: Nodes in a block.
BLOCK_NODES = 512
#: Nodes of large clusters are dealt into size classes that differ by this factor.
CLASS = 1.05
#: Ways in which the rows of one key are dealt where a table of that key is joined to them.
SPREAD = 64
#: Bits of the table of hashed 5-gram frequencies that gives the orders.
TABLE_BITS = 22
#: Most bits of the filter of nodes whose sets are wanted.
FILTER_BITS = 27
BATCH_BYTES = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2**64, and their inverses."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, b in enumerate((_BASE, inverse)):
            p = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)]))
            _POWERS[k : k + 1] = [p]
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of the texts, one after the other, and the number of words of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    b = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    word = np.concatenate([[False], _IS_WORD[b], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    power, inverse = _powers(len(b) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[b] * power[: len(b)])])
    hashes = _mix((sums[end] - sums[start]) * inverse[start])
    ends = np.cumsum([len(r) + 1 for r in raw])
    return hashes, np.diff(np.concatenate([[0], np.searchsorted(start, ends)]))


def shingles(texts: list[str]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    step = np.uint64(0xD6E8FEB86659FD93)
    for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
        h, counts = word_hashes(texts[a:b])
        run = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
        for j in range(WORDS):
            run = run * step + h[j : j + len(run)]
        run = _mix(run)
        at = 0
        for n in counts.tolist():
            if n >= WORDS:
                yield np.unique(run[at : at + n - WORDS + 1])
            elif n:
                short = np.uint64(n)
                with np.errstate(over="ignore"):
                    for x in h[at : at + n]:
                        short = short * step + x
                yield _mix(np.array([short], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
            at += n


def _signature(s: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    x = np.array([_mix(s * np.uint64(0xA24BAED4963EE407)).sum(dtype=np.uint64)]) + np.array([len(s)], np.uint64) * _M2
    return int(_mix(x).view(np.int64)[0])


def prefix_size(n: int) -> int:
    """Tokens of n of which a set of similarity 0.8 or more must share one, if they are the first in a global order."""
    return n - (4 * n + 4) // 5 + 1


#: The same in SQL.
PREFIX_SIZE = "(n - floor((4 * n + 4) / 5) + 1)"


def in_order(tokens: np.ndarray, ranks: np.ndarray, order: int, with_last: bool = False):
    """The first prefix_size tokens of a sorted set under an order; with_last adds the place of the last in the order.

    Order 0 goes by the rank of a token's frequency, ties by hash; any other by a hash of its own.
    """
    key = _mix(tokens + np.uint64(order) * np.uint64(0x632BE59BD9B4E019))
    if not order:
        key = (ranks[(tokens >> np.uint64(64 - TABLE_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (key >> np.uint64(8))
    first = np.argsort(key, kind="stable")[: prefix_size(len(tokens))]
    return (tokens[first], int(key[first[-1]] >> np.uint64(1))) if with_last else tokens[first]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return ["" if t is None else t for t in batch.column("text").to_pylist()]


def spread_join(rows: DataFrame, facts: DataFrame, key: str, by: Column, how: str = "inner") -> DataFrame:
    """rows joined with facts (one row for each key), the rows of a key dealt over SPREAD tasks by the column `by`.

    A fact is copied only to the deals in which its key occurs.
    """
    dealt = rows.withColumn("_deal", F.pmod(F.xxhash64(by), F.lit(SPREAD)).cast("int"))
    copies = dealt.select(key, "_deal").distinct().join(facts, key)
    return dealt.join(copies, [key, "_deal"], how).drop("_deal")


def describe(docs: DataFrame) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(doc_id, text_hash, n, node) of every document, (node, tokens) of every set, and the frequency rank of each slot.

    A task gives each set once, so a set has a row for each task that saw it.
    """
    names_out = ["doc_id", "text_hash", "n", "node", "tokens", "block", "part", "counts"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        table, seen = np.zeros(1 << TABLE_BITS, np.uint32), set()
        for batch in batches:
            n, names, sets = [], [], []
            for s in shingles(_texts(batch)):
                n.append(len(s))
                names.append(_signature(s))
                sets.append(None)
                if len(s) and names[-1] not in seen:  # copies count once in a task
                    seen.add(names[-1])
                    sets[-1] = s.astype("<u8").tobytes()
                    np.add.at(table, (s >> np.uint64(64 - TABLE_BITS)).astype(np.int64), np.uint32(1))
            nothing = pa.nulls(len(n), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int32()), pa.array(names, pa.int64()), pa.array(sets, pa.binary()), nothing, nothing, pa.nulls(len(n), pa.binary())], names=names_out)
        for k, part, counts in tables.blocks(table, part):
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.nulls(1, pa.int32()), none, pa.nulls(1, pa.binary()), pa.array([k], pa.int32()), pa.array([part], pa.int32()), pa.array([counts])], names=names_out)
        del table
        trim()

    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), "text").mapInArrow(look, "doc_id long, text_hash long, n int, node long, tokens binary, block int, part int, counts binary")
    rows = stored(rows, "described")
    rank = lambda counts: np.minimum(4 * np.log2(1 + counts.astype(float)), 255).astype(np.uint8)
    ranks = tables.summed(rows.where("block IS NOT NULL"), 1 << TABLE_BITS, rank, np.uint8)
    trim()
    sets = rows.where("tokens IS NOT NULL").select("node", "tokens")
    sets._stored_at = rows._stored_at
    return rows.where("block IS NULL").select("doc_id", "text_hash", "n", "node"), sets, ranks


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for held in batch.column("tokens"):
        yield np.frombuffer(held.as_buffer(), "<u8")


def prefix_rows(sets: DataFrame, ranks) -> DataFrame:
    """(token, node, n, last): the prefix of each set under the first order, and where it ends."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, held = [np.zeros(0, np.uint64)], []
            for s in _sets(batch):
                prefix, last = in_order(s, ranks.value, 0, with_last=True)
                tokens.append(prefix)
                held.append((len(s), last))
            each = [len(t) for t in tokens[1:]]
            sizes, ends = (np.repeat(np.array(x, np.int64), each) for x in (zip(*held) if held else ((), ())))
            names = np.repeat(batch.column("node").to_numpy(), each)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(names), pa.array(sizes.astype(np.int32)), pa.array(ends)], names=["token", "node", "n", "last"])
        trim()

    return sets.mapInArrow(look, "token long, node long, n int, last long")


def shared(rows: DataFrame) -> DataFrame:
    """rows with `leader`, leader_n and leader_last, where two nodes hold the token; the leader is the token's least node.

    Rows come sorted by token and node; a task keeps one row and one leader at a time.
    """
    columns = ["token", "node", "n", "last"]
    names = [*columns, "leader", "leader_n", "leader_last"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row: it is kept back until the next one is seen
        before, leader = None, (0, 0, 0)
        for batch in batches:
            x = [batch.column(k).to_numpy() for k in columns]
            if held is not None:
                x = [np.concatenate([[h], a]) for h, a in zip(held, x)]
            if not len(x[0]):
                continue
            new = np.concatenate([[True], (x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1])])
            x = [a[new] for a in x]
            t = x[0]
            held = [a[-1] for a in x]
            first = np.concatenate([[before is None or t[0] != before], t[1:] != t[:-1]])
            at = np.maximum.accumulate(np.where(first, np.arange(len(t)), -1))
            lead = [np.where(at >= 0, a[np.maximum(at, 0)], old).astype(a.dtype) for a, old in zip(x[1:], leader)]
            keep = (~first | np.concatenate([~first[1:], [False]]))[:-1]
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(a[:-1][keep]) for a in (*x, *lead)], names=names)
            if len(t) > 1:
                before, leader = t[-2], tuple(a[-2] for a in lead)
        if held is not None and before is not None and held[0] == before:
            yield pa.RecordBatch.from_arrays([pa.array(np.array([a], np.int32 if k in (2, 5) else np.int64)) for k, a in enumerate((*held, *leader))], names=names)

    return rows.repartition("token").sortWithinPartitions("token", "node").mapInArrow(look, "token long, node long, n int, last long, leader long, leader_n int, leader_last long")


def _filter_bits(nodes: DataFrame) -> np.ndarray:
    """A bit for each node's hash, eight to a byte, the lowest first; the size follows the number of nodes up to 2**FILTER_BITS."""
    bits = min(FILTER_BITS, max(12, (16 * nodes.count()).bit_length()))
    place = F.pmod(F.col("node"), F.lit(1 << bits))
    words = nodes.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(node, {1 << bits}) & 63 as int))")).alias("held")).toArrow()  # 2**(FILTER_BITS - 6) rows at most
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["word"].to_numpy()] = words["held"].to_numpy()
    return out.view(np.uint8)


def sets_of(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, tokens binary) of the given nodes, and of a few others that the filter lets through."""
    wanted = sets.sparkSession.sparkContext.broadcast(_filter_bits(nodes))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = wanted.value
        for batch in batches:
            place = batch.column("node").to_numpy() % (8 * len(held))
            yield batch.filter(pa.array((held[place >> 3] >> (place & 7).astype(np.uint8) & 1) > 0))
        trim()

    return sets.mapInArrow(look, "node long, tokens binary").dropDuplicates(["node"])


def prefixes_of(sets: DataFrame, ranks, orders: int = ORDERS) -> DataFrame:
    """(node, p1, p2, ...): the prefix of each set under every order but the first, tokens cut to 32 bits.

    Equal tokens stay equal, so no pair that shares one is lost.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [*_sets(batch)]
            lists = [pa.array([in_order(s, ranks.value, k).astype(np.uint32).view(np.int32) for s in held], pa.list_(pa.int32())) for k in range(1, orders)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *lists], names=["node", *(f"p{k}" for k in range(1, orders))])

    return sets.mapInArrow(look, ", ".join(["node long", *(f"p{k} array<int>" for k in range(1, orders))]))


def _with_sides(pairs: DataFrame, facts: DataFrame, columns: list[str]) -> DataFrame:
    """pairs (u, v) with the columns of both nodes, u_... and v_...; many pairs may have one v, a leader."""
    one = lambda side: facts.select(F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns))
    return spread_join(pairs.join(one("u"), "u"), one("v"), "v", F.col("u"))


def verified(pairs: DataFrame, sets: DataFrame, ranks, orders: int = ORDERS) -> DataFrame:
    """The pairs (u, v) that share prefix tokens under every other order and have 100 |A & B| >= 80 |A | B|.

    The filters are intersected on prefixes; only the pairs that are left get their sets.
    """
    others = [f"p{k}" for k in range(1, orders)]
    if others:
        both = _with_sides(pairs, prefixes_of(sets, ranks, orders), others)
        pairs = both.where(" AND ".join(f"arrays_overlap(u_{p}, v_{p})" for p in others)).select("u", "v")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b in zip(batch.column("u_tokens"), batch.column("v_tokens")):
                a, b = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
                both = len(np.intersect1d(a, b, assume_unique=True))
                out.append(100 * both >= 80 * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(out, pa.bool_()))

    return _with_sides(pairs, sets, ["tokens"]).select("u", "v", "u_tokens", "v_tokens").mapInArrow(look, "u long, v long")


def _may_link(common, n, m, last, other_last):
    """Whether two sets of n and m tokens that share `common` prefix tokens can have an overlap of 4 (n + m) / 9.

    Common tokens beyond these lie behind the prefix of the set whose prefix ends first. Works on columns and arrays.
    """
    rest = lambda k: (4 * k + 4 - (4 * k + 4) % 5) / 5 - 1  # noqa: E731  k - prefix_size(k)
    if isinstance(common, np.ndarray):
        behind = np.where(last <= other_last, rest(n), rest(m))
    else:
        behind = F.when(last <= other_last, rest(n)).otherwise(rest(m))
    return 9 * (common + behind) >= 4 * (n + m)


def _postings(sets: list[np.ndarray], tokens: list[np.ndarray]) -> np.ndarray:
    """How many tokens each of `sets` shares with each of `tokens`."""
    flat = np.concatenate([np.zeros(0, np.uint64), *tokens])
    order = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])[order]
    flat = flat[order]
    out = np.zeros((len(sets), len(tokens)), np.int32)
    for k, s in enumerate(sets):
        lo, hi = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
        n = hi - lo
        if n.any():
            ends = np.cumsum(n)
            out[k] = np.bincount(owner[np.repeat(lo - (ends - n), n) + np.arange(ends[-1])], minlength=len(tokens))
    return out


def _meetings(nodes: DataFrame) -> DataFrame:
    """nodes (cluster, node, n, ...) once for each pair of blocks in which they meet: meeting, and side 0 or 1.

    What two nodes may share, once their seldom tokens are done with, is the frequent tokens of their prefixes and what
    lies behind the prefix of the one that ends first. So a node takes, as the one that ends first, only partners up to a
    size of 9/4 x - n, x being its frequent prefix tokens and all tokens behind; letters of one form that differ in more
    than a ninth of their tokens take none of their own size and never meet. A small cluster is one block. In a large
    one, takers (side 0, by class and largest class taken) meet the blocks (side 1) of each class they take.
    """
    left = F.size("tokens") + F.col("n") - F.expr(PREFIX_SIZE)
    takes = F.least(F.floor(F.lit(9) * left / 4) - F.col("n"), F.floor(F.col("n") * 5 / F.lit(4)))
    of = lambda c: F.floor(F.log(c.cast("double")) / F.log(F.lit(CLASS)) + 1e-9).cast("int")
    nodes = nodes.withColumns({"takes": takes.cast("long"), "c": of(F.col("n"))})
    nodes = nodes.withColumns({"top": F.when(F.col("takes") * 5 >= F.col("n") * 4, of(F.col("takes"))), "low": of(F.ceil(F.col("n") * 4 / F.lit(5)))})
    size = nodes.groupBy("cluster").agg(F.count("*").alias("size"))
    nodes = spread_join(nodes, size, "cluster", F.col("node"))
    small = nodes.where(F.col("size") <= BLOCK_NODES)
    kept = ["node", "n", "last", "component", "tokens"]
    alone = small.select(*kept, F.xxhash64(F.lit("alone"), "cluster").alias("meeting"), F.lit(0).alias("side"))

    large = nodes.where(F.col("size") > BLOCK_NODES)
    blocks = F.ceil(F.count("*") / F.lit(BLOCK_NODES)).cast("int")
    takers = large.where("top IS NOT NULL").groupBy("cluster", "c", "low", "top").agg(blocks.alias("takers"))
    taken = large.groupBy("cluster", F.col("c").alias("d")).agg(blocks.alias("blocks"))
    # a row for each taker group and class it takes: some dozens for each cluster of many nodes
    met = takers.withColumn("d", F.explode(F.sequence("low", "top"))).join(taken, ["cluster", "d"])
    name = lambda i, j: F.xxhash64("cluster", "c", "low", "top", i, "d", j)
    own = lambda n: F.pmod(F.xxhash64("node", F.lit("deal")), n).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    gather = lambda keys, *more: met.groupBy(*keys).agg(F.collect_list(F.struct(*more)).alias("met"))

    def dealt(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
        key = F.xxhash64(*keys).alias("_key")
        return spread_join(rows.withColumn("_key", key), facts.select(key, "met"), "_key", F.col("node"))

    first = dealt(large.where("top IS NOT NULL").select("cluster", "c", "low", "top", *kept), gather(["cluster", "c", "low", "top"], "d", "takers", "blocks"), ["cluster", "c", "low", "top"])
    first = first.select("cluster", "c", "low", "top", *kept, F.explode("met").alias("m")).select("*", "m.*").withColumns({"i": own(F.col("takers"))}).withColumn("j", upto(F.col("blocks")))
    second = dealt(large.select("cluster", F.col("c").alias("d"), *kept), gather(["cluster", "d"], "c", "low", "top", "takers", "blocks"), ["cluster", "d"])
    second = second.select("cluster", "d", *kept, F.explode("met").alias("m")).select("*", "m.*").withColumns({"j": own(F.col("blocks"))}).withColumn("i", upto(F.col("takers")))
    both = [rows.select(*kept, name("i", "j").alias("meeting"), F.lit(side).alias("side")) for side, rows in ((0, first), (1, second))]
    return alone.unionByName(both[0]).unionByName(both[1])


def _sides(group: pa.Table):
    """Records of the two sides of a meeting; a small cluster, with side 0 alone, stands on both."""
    rows = group.to_pylist()
    left, right = [r for r in rows if r["side"] == 0], [r for r in rows if r["side"] == 1]
    return (left, right, False) if right else (left, left, True)


def _matrix(left, right, alone: bool, tokens: str):
    """(common, may-link mask) of two sides by their token lists; no node meets its own component."""
    one = lambda rows, k: np.array([r[k] for r in rows])
    held = lambda r: np.frombuffer(r[tokens], "<u8") if isinstance(r[tokens], bytes) else np.array(r[tokens], np.int64).view(np.uint64)
    common = _postings([*map(held, left)], [*map(held, right)])
    n, m = one(left, "n")[:, None].astype(float), one(right, "n")[None, :].astype(float)
    apart = one(left, "component")[:, None] != one(right, "component")[None, :]
    fits = 5 * np.minimum(n, m) >= 4 * np.maximum(n, m)
    return common, apart & fits, n, m


def _survivors(group: pa.Table) -> pa.Table:
    """Nodes of a meeting that the first order's prefixes leave a partner in it."""
    left, right, alone = _sides(group)
    common, ok, n, m = _matrix(left, right, alone, "tokens")
    lasts = np.array([r["last"] for r in left])[:, None], np.array([r["last"] for r in right])[None, :]
    ok &= (common > 0) & _may_link(common.astype(float), n, m, *lasts)
    kept = [r for r, k in zip(left, ok.any(1)) if k] + ([] if alone else [r for r, k in zip(right, ok.any(0)) if k])
    if alone:
        kept = [r for r, k in zip(left, ok.any(1) | ok.any(0)) if k]
    return pa.table({"meeting": pa.array([r["meeting"] for r in kept], pa.int64()), "side": pa.array([r["side"] for r in kept], pa.int32()), "node": pa.array([r["node"] for r in kept], pa.int64()), "n": pa.array([r["n"] for r in kept], pa.int32()), "component": pa.array([r["component"] for r in kept], pa.int64())})


def _block_links(group: pa.Table, ranks: np.ndarray) -> pa.Table:
    """Links of a meeting, one for each two components that it joins."""
    left, right, alone = _sides(group)
    out: list[tuple[int, int]] = []
    both, ok, n, m = _matrix(left, right, alone, "a")
    for k in range(1, ORDERS):
        prefixes = [[in_order(np.frombuffer(r["a"], "<u8"), ranks, k) for r in side] for side in (left, right)]
        ok &= _postings(*prefixes) > 0
    ok &= 100 * both >= 80 * (n + m - both)
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = c = parent[parent[c]]
        return c

    for i, j in zip(*np.nonzero(ok)):
        a, b = root(left[i]["component"]), root(right[j]["component"])
        if a != b:
            parent[a] = b
            out.append((left[i]["node"], right[j]["node"]))
    return pa.table({"u": pa.array([x for x, _ in out], pa.int64()), "v": pa.array([x for _, x in out], pa.int64())})


def links(sets: DataFrame, ranks) -> DataFrame:
    """(node, component) of the nodes linked with another."""
    rows = stored(shared(prefix_rows(sets, ranks)), "shared")
    fits = "5 * least(u_n, v_n) >= 4 * greatest(u_n, v_n)"
    may = lambda common: _may_link(common, F.col("u_n"), F.col("v_n"), F.col("u_last"), F.col("v_last"))

    def checked(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs.select("u", "v"), "pairs")
        wanted = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
        found = stored(verified(pairs, sets_of(sets, wanted), ranks), "links")
        discard(pairs)
        return found

    # each node with the leader it shares most prefix tokens with
    facts = ("n", "last", "leader_n", "leader_last")
    count = rows.where("leader <> node").groupBy("node", "leader").agg(F.count("*").alias("common"), *(F.first(c).alias(c) for c in facts))
    best = count.groupBy("node").agg(F.max(F.struct("common", (-F.col("leader")).alias("l"), *facts)).alias("b"))
    best = best.select(F.col("node").alias("u"), (-F.col("b.l")).alias("v"), "b.common", *(F.col(f"b.{c}").alias(d) for c, d in zip(facts, ("u_n", "u_last", "v_n", "v_last"))))
    first = checked(best.where(fits).where(may(F.col("common"))))
    found = components(first)

    # tokens that still hold nodes of several components
    held = rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = held.groupBy("token").agg(F.min("component").alias("c"), F.max("component").alias("d"), F.count("*").alias("holders")).where("c < d").select("token", "holders")
    held = stored(held.select("token", "node", "n", "last", "leader", "component").join(mixed, "token"), "mixed")
    often = held.where(F.col("holders") > SELDOM)

    # through seldom tokens, pair by pair; tokens they might share among the frequent ones count as shared
    more = often.groupBy("node").agg(F.count("*").alias("often"))
    seldom = held.where(F.col("holders") <= SELDOM).join(more, "node", "left").withColumn("often", F.coalesce("often", F.lit(0)))
    side = lambda name: seldom.select("token", F.col("node").alias(name), *(F.col(x).alias(f"{name}_{x}") for x in ("n", "last", "component", "often")))
    pairs = side("u").join(side("v"), "token").where("u < v AND u_component <> v_component").where(fits)
    pairs = pairs.groupBy("u", "v", "u_n", "v_n", "u_last", "v_last", "u_often", "v_often").agg(F.count("*").alias("common"))
    second = checked(pairs.where(may(F.col("common") + F.least("u_often", "v_often"))))

    # through frequent tokens, block by block
    clusters = components(often.select(F.col("node").alias("u"), F.col("leader").alias("v"))).withColumnRenamed("component", "cluster")
    nodes = stored(often.groupBy("node", "n", "last", "component").agg(F.collect_list("token").alias("tokens")).join(clusters, "node"), "often")
    left_over = stored(_meetings(nodes).groupBy("meeting").applyInArrow(_survivors, "meeting long, side int, node long, n int, component long"), "meetings")
    own = sets_of(sets, left_over.select("node").distinct()).withColumnRenamed("tokens", "a")
    third = stored(left_over.join(own, "node").groupBy("meeting").applyInArrow(lambda g: _block_links(g, ranks.value), "u long, v long"), "links")
    out = components(first.unionByName(second).unionByName(third))
    discard(rows, held, nodes, left_over, first, second, third)
    return out


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), n, component (a name; null without words): one row for each row of docs."""
    described, sets, table = describe(docs)
    found = links(sets, docs.sparkSession.sparkContext.broadcast(table))
    named = spread_join(described.where("n > 0"), found, "node", F.col("doc_id"), "left")
    return described.where("n = 0").select("doc_id", "text_hash", "n", F.lit(None).cast("long").alias("component")).unionByName(named.select("doc_id", "text_hash", "n", F.coalesce("component", "node").alias("component")))


def join_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of docs."""
    rows = stored(groups(docs), "groups")
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = spread_join(rows.where("component IS NOT NULL"), least, "component", F.col("doc_id"))
    alone = rows.where("component IS NULL").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone, allowMissingColumns=True).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
