"""Importance resampling towards a target distribution, over hashed runs of words.

Features are all runs of 1 to 3 consecutive words, joined by a space. A feature's bucket is its CRC-32 modulo the
number of buckets, and no feature is ever put together as a string: one scan over a document's words keeps a ring of
running zlib states, those of the runs that began at the last n words. The next word, with a space before it, extends
each state; after every word the ring holds the checksums of all runs that end there.

The scan writes each document's buckets to the shared folder and adds up its task's counts. Bucket counts of all
documents and of the target give a gain to each bucket; a document's weight is the sum of its features' gains. Gumbel
noise from a hash of its id makes the highest scores a draw without replacement in proportion to the weights. Scores
are ranked by ranges, each numbered on its own and shifted by the sizes of those before.

Words are runs of ASCII digits and letters and of everything beyond ASCII, A-Z as a-z. Odd input: null and empty texts
have no words, no features and weight 0; documents under LEAST_WORDS words are never drawn; rows that repeat an id
draw the same noise; a null id hashes like an empty one and goes last among ties; other columns are ignored; without
target texts the target is level; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm import tables
from vintora.llm._io import discard, numbered, small_batches, stored, trim

BUCKETS, LONGEST, SEED = 10_000, 3, 42
#: Documents with fewer words are not drawn; the share that is drawn, in hundredths.
LEAST_WORDS, HUNDREDTHS = 20, 5

_WORD = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
SCANNED = "doc_id long, n_words long, n_features long, buckets binary, block int, part int, counts binary"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


def ring_of_crcs(words: list[bytes], longest: int = LONGEST) -> array:
    """CRC-32 of every run of 1 to `longest` words: of those that end at the first word, at the second, and so on."""
    out, ring, older = array("I"), [], longest - 1
    for w in words:
        longer = b" " + w
        ring = [crc32(w), *[crc32(longer, state) for state in ring[:older]]]
        out.extend(ring)
    return out


def scan(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """Rows of SCANNED: each document's features as 4-byte or, up to 65,536 buckets, 2-byte numbers; then each task's counts."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    names = [c.split()[0] for c in SCANNED.split(", ")]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        totals, part = np.zeros(buckets, np.uint64), TaskContext.get().partitionId()
        for batch in batches:
            n_words, n_features, held = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                found = (np.frombuffer(ring_of_crcs(words, longest), np.uint32) % np.uint32(buckets)).astype(kind)
                totals += np.bincount(found, minlength=buckets).astype(np.uint64)
                n_words.append(len(words))
                n_features.append(len(found))
                held.append(found.tobytes())
            none = pa.nulls(len(held), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(held, pa.binary()), none, none, pa.nulls(len(held), pa.binary())], names=names)
        for block, part, counts in tables.blocks(totals, part):
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.nulls(1, pa.binary()), pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([counts])], names=names)
        trim()

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(look, SCANNED)


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of each bucket, counts raised by one, in doubles."""
    n, total, wanted = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (total + n) / ((float(s) + 1) * (wanted + n)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row of docs; target: text."""
    wanted = stored(scan(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets, longest).where("block IS NOT NULL"), "target")
    rows = stored(scan(docs, buckets, longest), "scanned", compression="zstd")
    gains = gains_of(*(tables.summed(x.where("block IS NOT NULL"), buckets) for x in (rows, wanted)))
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    gains = docs.sparkSession.sparkContext.broadcast(gains)  # one number for each bucket

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            weights = [int(gains.value[np.frombuffer(b.as_buffer(), kind)].sum()) for b in batch.column("buckets")]
            scores = [w + noise(i, seed) for i, w in zip(ids, weights)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(weights, pa.int64()), pa.array(scores, pa.int64())], names=["doc_id", "n_words", "n_features", "weight", "score"])
        trim()

    held = rows.where("block IS NULL").select("doc_id", "n_words", "n_features", "buckets")
    out = stored(held.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long, score long"), "weights")
    discard(rows, wanted)
    return out


def resample(docs: DataFrame, target: DataFrame, hundredths: int = HUNDREDTHS, least_words: int = LEAST_WORDS, **how) -> DataFrame:
    """doc_id, n_features, weight, score, rank (from 1 for those drawn, else null): one row for each row of docs."""
    rows = scored(docs, target, **how)
    fit = rows.where(F.col("n_words") >= least_words)
    drawn = fit.count() * hundredths // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features")]
    ranked = numbered(fit, order, "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
