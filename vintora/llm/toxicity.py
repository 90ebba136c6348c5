"""Toxicity: a character n-gram linear classifier over features scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams of the lower-cased text, hashed into 2**BITS bins. Counts per class
cover every labelled training row; the linear weights (logistic loss over the scaled features) are fitted on a
bounded sample of training documents: at most SAMPLE of each class, the first by a hash of doc_id, with one text each,
and no more than SAMPLE_FEATURES features of each class (one document more may pass that bound). The least log-count
ratio a feature needs and the penalty are chosen by two folds inside the training rows, each tested with ratios counted
on the other.

Odd input: a null or empty text has no features and gets the score of the prior; rows with a null label or
doc_id don't train; where labels of one document differ, the toxic one counts; of several texts of one doc_id the
one with the least hash is sampled; without training rows of both classes every score is 0. doc_id, lang, source
and labels are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.llm._io import discard, small_batches, stored, trim
from vintora.llm.bpe import by_bytes

SIZES = (3, 4, 5)
BITS = 18
#: Documents of each class, and their features, on which the linear weights are fitted.
SAMPLE, SAMPLE_FEATURES = 2500, 2_000_000
#: Settings tried by folds: features whose class rates differ by a smaller log ratio have no weight; penalty.
SETTINGS = ((0.4, 1.0), (0.8, 1.0), (1.2, 1.0), (0.8, 10.0))
#: Steps of a fit, and of one that only tries settings.
STEPS, TRIAL_STEPS = 300, 80
#: Features that a step of a fit holds at a time.
RUN = 1 << 18
#: Labels are broadcast up to this many rows; beyond, the join shuffles.
BROADCAST_ROWS = 2_000_000
BATCH_CHARS = 1 << 20


def _ngrams(texts: list[str]) -> Iterator[np.ndarray]:
    """The distinct feature bins of each text."""
    last = np.zeros(1 << BITS, np.int32)
    for a, b in by_bytes([len(t) for t in texts], BATCH_CHARS):
        padded = [f" {t.lower()} " if t else "" for t in texts[a:b]]
        ends = np.cumsum([len(t) for t in padded])
        c = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
        # h: hash of the n characters that begin at each place
        h, bins = c.copy(), {}
        for n in range(2, max(SIZES) + 1):
            h = h[:-1] * np.uint32(0x01000193) + c[n - 1 :] if len(h) > 1 else h[:0]
            if n in SIZES:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
                bins[n] = (mixed >> np.uint32(32 - BITS)).astype(np.int32)
        for start, end in zip((ends - [len(t) for t in padded]).tolist(), ends.tolist()):
            ids = np.concatenate([bins[n][start : max(start, end - n + 1)] for n in SIZES])
            order = np.arange(len(ids), dtype=np.int32)
            last[ids] = order
            yield ids[last[ids] == order]


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def is_held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _fold(doc_id) -> F.Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("fold")), F.lit(2)).cast("int")


def _training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, doc_id, toxic and fold of the labelled rows outside the held-out fold."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    small = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.select("doc_id", "text").join(F.broadcast(known) if small else known, "doc_id").withColumn("fold", _fold(F.col("doc_id")))


def _class_counts(rows: DataFrame) -> np.ndarray:
    """By fold and class, the rows that hold each feature; in the last place, all rows."""
    size = 1 << BITS
    names = ["bin", *(f"n{k}" for k in range(4))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((4, size + 1), np.int64)
        for batch in batches:
            for y, f, ids in zip(batch.column("toxic").to_pylist(), batch.column("fold").to_pylist(), _ngrams(_texts(batch))):
                n[2 * f + y, ids] += 1
                n[2 * f + y, size] += 1
        at = np.flatnonzero(n.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(c[at]) for c in n)], names=names)
        trim()

    got = rows.mapInArrow(count, "bin int, n0 long, n1 long, n2 long, n3 long").groupBy("bin").agg(*(F.sum(c).alias(c) for c in names[1:])).toArrow()  # at most 2**BITS + 1 rows
    n = np.zeros((4, size + 1))
    for k, c in enumerate(names[1:]):
        n[k, got["bin"].to_numpy()] = got[c].to_numpy()
    return n.reshape(2, 2, size + 1)


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """Log ratio of each feature's rate in toxic and clean rows; counts as of _class_counts, for one set of rows."""
    return np.log((counts[1, :-1] + 1) / (counts[1, -1] + 2)) - np.log((counts[0, :-1] + 1) / (counts[0, -1] + 2))


def _sample(rows: DataFrame, useful: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(class, fold, useful features) of the sampled documents."""
    docs = rows.groupBy("doc_id", "toxic").agg(F.min(F.xxhash64("text")).alias("text_hash"))
    picked = None
    for y in (0, 1):
        ids = docs.where(F.col("toxic") == y).select("doc_id", "text_hash").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        picked = ids if picked is None else picked.union(ids)

    held = rows.sparkSession.sparkContext.broadcast(useful)  # 2**BITS flags

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x[held.value[x]].astype("<i4").tobytes() for x in _ngrams(_texts(batch))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "toxic", "fold")), pa.array(found, pa.binary())], names=["doc_id", "toxic", "fold", "bins"])

    chosen = rows.withColumn("text_hash", F.xxhash64("text")).join(F.broadcast(picked), ["doc_id", "text_hash"]).dropDuplicates(["doc_id"])
    kind = dict(rows.dtypes)["doc_id"]
    found = stored(chosen.select("doc_id", "toxic", "fold", "text").mapInArrow(features, f"doc_id {kind}, toxic int, fold int, bins binary"), "features")
    before = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)  # SAMPLE rows of each class
    sized = found.select("doc_id", "toxic", F.coalesce(F.sum(F.octet_length("bins") / 4).over(before), F.lit(0)).alias("before"))
    got = found.join(F.broadcast(sized.where(F.col("before") < SAMPLE_FEATURES).select("doc_id")), "doc_id").orderBy("doc_id").select("toxic", "fold", "bins").toArrow()
    out = [(y.as_py(), f.as_py(), np.frombuffer(b.as_buffer(), "<i4")) for y, f, b in zip(got["toxic"], got["fold"], got["bins"])]
    discard(found)
    return out


class Linear:
    """Logistic loss over features scaled by their ratios; fitted by Adam over all rows at once.

    A step goes through the rows in runs of about RUN features, so that what numpy makes of them by the way stays small.
    """

    def __init__(self, rows: list[tuple[int, int, np.ndarray]], ratio: np.ndarray, least: float, l2: float, steps: int):
        keep = np.abs(ratio) >= least
        y = np.array([r[0] for r in rows], np.float32)
        sizes = np.array([np.count_nonzero(keep[r[2]]) for r in rows], np.int64)
        seen = np.zeros(1 << BITS, bool)
        for r in rows:
            seen[r[2]] = True
        seen &= keep
        used = np.flatnonzero(seen)
        place, ends = np.cumsum(seen, dtype=np.int32) - 1, np.cumsum(sizes)
        bins = np.empty(sizes.sum(), np.int32)
        for r, n, end in zip(rows, sizes, ends):
            bins[end - n : end] = place[r[2][keep[r[2]]]]
        x = ratio[used].astype(np.float32)
        cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(RUN, bins.size, RUN)), [len(rows)]]))
        runs = [(a, b, ends[a] - sizes[a], ends[b - 1]) for a, b in zip(cuts, cuts[1:])]
        share = y.mean() if len(y) else 0.5
        w, bias = np.zeros(len(used)), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        m = v = np.zeros(len(used) + 1)
        for t in range(1, steps + 1):
            scaled, total, slope = x * w.astype(np.float32), 0.0, np.zeros(len(used))
            for a, b, start, end in runs:
                held, owner = bins[start:end], np.repeat(np.arange(b - a), sizes[a:b])
                z = np.bincount(owner, scaled[held], b - a) + bias
                error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[a:b]) / max(1, len(y))
                slope += np.bincount(held, x[held] * np.repeat(error.astype(np.float32), sizes[a:b]), len(used))
                total += error.sum()
            grad = np.append(slope + l2 * w / max(1, len(y)), total)
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            move = 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
            w, bias = w - move[:-1], bias - move[-1]
        self.weights = np.zeros(1 << BITS, np.float32)
        self.weights[used] = ratio[used] * w
        self.bias, self.share = bias, share

    def loss(self, rows: list[tuple[int, int, np.ndarray]]) -> float:
        """Mean logistic loss over other rows."""
        z = np.array([float(self.weights[b].sum(dtype=np.float64)) for _, _, b in rows]) + self.bias
        return float(np.mean(np.logaddexp(0, np.where(np.array([r[0] for r in rows]) > 0, -z, z))))


def choose(sample: list[tuple[int, int, np.ndarray]], counts: np.ndarray) -> tuple[float, float]:
    """The setting of the least loss over two folds; each fold's model and ratios come from the other. First of ties."""
    parts = [[r for r in sample if r[1] == f] for f in (0, 1)]
    if any(counts[f, y, -1] < 1 for f in (0, 1) for y in (0, 1)) or not all(parts):
        return SETTINGS[1]
    losses = []
    for least, l2 in SETTINGS:
        trials = [Linear(parts[f], log_ratio(counts[f]), least, l2, TRIAL_STEPS).loss(parts[1 - f]) for f in (0, 1)]
        losses.append(sum(trials))
    return SETTINGS[int(np.argmin(losses))]


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float] | None:
    """Weight of each feature and the bias; None where a class has no training rows."""
    small_batches(docs.sparkSession)
    rows = _training(docs, labels)
    counts = _class_counts(rows)
    totals = counts.sum(0)
    if totals[:, -1].min() < 1:
        return None
    least = min(s[0] for s in SETTINGS)
    ratio = log_ratio(totals)
    useful = np.logical_or.reduce([np.abs(r) >= least for r in (ratio, *map(log_ratio, counts))])
    sample = _sample(rows, useful)
    model = Linear(sample, ratio, *choose(sample, counts), STEPS)
    weights, bias, share = model.weights, model.bias, model.share
    del model, sample, useful
    trim()  # the driver's Python gives the sample's memory back
    shift = np.log(totals[1, -1] / totals[0, -1]) - (np.log(share / (1 - share)) if 0 < share < 1 else 0.0)
    return weights, float(bias + shift)


def score(docs: DataFrame, model: tuple[np.ndarray, float] | None, text: str = "text", to: str = "score") -> DataFrame:
    """docs with the toxicity score of each whole text; a column of that name is replaced."""
    if model is None:
        return docs.withColumn(to, F.lit(0.0))
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS floats

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, bias = held.value
        for batch in batches:
            z = np.array([float(weights[ids].sum(dtype=np.float64)) for ids in _ngrams(["" if t is None else t for t in batch.to_pylist()])])
            yield pa.array(1 / (1 + np.exp(-np.clip(z + bias, -60, 60))))
        trim()

    return docs.withColumn(to, scored(F.col(text)))
