"""Cross-entropy difference of matched bigram models.

The target model counts the documents of a chosen kind, the background model all documents, each of its counts
scaled by one factor so that both models rest on the same number of tokens. Both have one vocabulary, one order and
one smoothing, so a document's score, its mean loss per token under the target model minus that under the
background model, compares the texts alone: the lower, the closer to the target. After each word the probabilities of
the vocabulary's words sum to 1.

Words and bigrams are told apart by 64-bit hashes, and each has its own count: what is gathered grows with the
corpus. Documents are cut into chunks. A chunk asks each bucket of the hashes for those it holds, once however
often they occur in it, and adds its own counts; a bucket sums over all chunks and answers each. So no task
holds more than a bucket or a chunk, and a word of every document is one row per chunk.

Counts cover every document. Odd input: null, empty or blank texts have no tokens and score 0; repeated rows are
counted and scored one by one; without target documents the target model is level and the background unscaled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm._io import small_batches, stored, trim
from vintora.llm.bpe import by_bytes
from vintora.llm.jaccard import word_hashes

#: Unigrams are smoothed by one over a vocabulary of 2**WORD_BITS words, or of all distinct ones if they are more.
WORD_BITS = 18
#: Weight of the unigram model in a bigram's probability, in tokens.
PRIOR = 8.0
#: Target ids are broadcast up to this many; beyond, the join shuffles.
BROADCAST_ROWS = 2_000_000
BATCH_BYTES = 1 << 20
#: A chunk ends with the document that brings it to so many tokens or documents.
CHUNK_TOKENS, CHUNK_DOCS = 1 << 20, 1 << 17
#: Hashes asked of a bucket by all chunks together, about.
BUCKET = 1 << 21

CHUNK = "chunk long, ids array<long>, sizes array<long>, roles array<int>, n_all long, n_target long, n_words long, words binary, codes binary"
ASKED = "kind int, bucket long, chunk long, keys binary, counts binary"
ANSWER = "kind int, bucket long, chunk long, fresh long, counts binary"
LOSSES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
#: What a document does, as bits: it counts, it counts for the target, it is scored.
COUNTED, TARGET, SCORED = 1, 2, 4


def _chained(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words before each word (0 before a text) and of the pairs; counts are words of each text."""
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)[counts > 0]
    last = np.concatenate([np.zeros(1, np.uint64), h[:-1]]) if len(h) else h
    last[first] = 0
    return last, (last * np.uint64(0x9E3779B97F4A7C15) + h) * np.uint64(0xD6E8FEB86659FD93)


def slots(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes of the words, of the preceding words, of the pairs) of each text; what precedes a text is 0."""
    for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
        h, counts = word_hashes(texts[a:b])
        last, pair = _chained(h, counts)
        ends = np.cumsum(counts)
        for s, e in zip((ends - counts).tolist(), ends.tolist()):
            yield h[s:e], last[s:e], pair[s:e]


def _planes(x: np.ndarray) -> bytes:
    """Numbers of 64 bits as their lowest bytes, then the next: bytes that are 0 lie together."""
    return np.ascontiguousarray(x).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _whole(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def _keys(b: bytes) -> np.ndarray:
    """Sorted hashes from the planes of their differences; Spark's own compression takes the zeros out."""
    return np.cumsum(_whole(b), dtype=np.uint64)


def _pack(counts: np.ndarray) -> bytes:
    return zlib.compress(_planes(counts.reshape(-1)), 1)


def _counts(blob: bytes) -> np.ndarray:
    """Counts for the target (row 0) and for all (row 1)."""
    return _whole(zlib.decompress(blob)).astype(np.int64).reshape(2, -1)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[k]) for x, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of documents (columns of CHUNK): distinct words, and each token as the place of its word."""
    from pyspark import TaskContext

    made, ids, roles, hashes, sizes, n = 0, [], [], [], [], 0

    def chunk() -> pa.RecordBatch:
        words, codes = np.unique(np.concatenate(hashes), return_inverse=True)
        size, role = np.concatenate(sizes), np.array(roles)
        counted, target = (int(size[role & bit > 0].sum()) for bit in (COUNTED, TARGET))
        at = (TaskContext.get().partitionId() << 32) + made
        return _batch([(at, ids, size.tolist(), roles, counted, target, len(words), words.astype("<u8").tobytes(), zlib.compress(codes.astype("<i4").tobytes(), 1))], CHUNK)

    for batch in batches:
        texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
        own, role = batch.column("doc_id").to_pylist(), batch.column("role").to_pylist()
        for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
            h, counts = word_hashes(texts[a:b])
            ids += own[a:b]
            roles += role[a:b]
            hashes.append(h)
            sizes.append(counts)
            n += len(h)
            if n >= CHUNK_TOKENS or len(ids) >= CHUNK_DOCS:
                yield chunk()
                made, ids, roles, hashes, sizes, n = made + 1, [], [], [], [], 0
    if ids:
        yield chunk()
    trim()


def _opened(words: bytes, codes: bytes, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of words, preceding words and pairs of a chunk: the distinct hashes in order, and the place of each token's."""
    h = np.frombuffer(words, "<u8")
    code = np.frombuffer(zlib.decompress(codes), "<i4")
    last, pair = _chained(h[code], np.array(sizes, np.int64))
    return [(h, code), np.unique(last, return_inverse=True), np.unique(pair, return_inverse=True)]


def _asking(buckets: list[int]):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                role = np.repeat(np.array(row["roles"], np.int64), row["sizes"])
                bits = [role & TARGET > 0, role & COUNTED > 0]
                for kind, (keys, at) in enumerate(_opened(row["words"], row["codes"], row["sizes"])):
                    n = np.stack([np.bincount(at[b], minlength=len(keys)) for b in bits])
                    where = ((keys >> np.uint64(32)) * np.uint64(buckets[kind]) >> np.uint64(32)).astype(np.int64)  # in order, as the keys are
                    edge = [0, *(np.flatnonzero(np.diff(where)) + 1).tolist(), len(keys)]
                    rows = [(kind, int(where[a]), row["chunk"], _planes(np.diff(keys[a:b], prepend=np.uint64(0))), _pack(n[:, a:b])) for a, b in zip(edge, edge[1:]) if b > a]
                    if rows:
                        yield _batch(rows, ASKED)
        trim()

    return ask


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over all chunks, for each chunk in its own order; rows come bucket by bucket."""
    now, held = None, []

    def answers() -> Iterator[pa.RecordBatch]:
        keys = [_keys(k) for _, k, _ in held]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.zeros((2, len(distinct)), np.int64)
        ends = np.cumsum([len(k) for k in keys])
        for (_, _, n), k, end in zip(held, keys, ends):  # a chunk has a key once
            sums[:, at[end - len(k) : end]] += _counts(n)
        fresh = int(np.count_nonzero(sums[1]))
        yield _batch([(*now, chunk, 0 if j else fresh, _pack(sums[:, at[end - len(k) : end]])) for j, ((chunk, _, _), k, end) in enumerate(zip(held, keys, ends))], ANSWER)

    for batch in batches:
        for row in batch.to_pylist():
            if (key := (row["kind"], row["bucket"])) != now:
                if held:
                    yield from answers()
                now, held = key, []
            held.append((row["chunk"], row["keys"], row["counts"]))
    if held:
        yield from answers()
    trim()


def probability(pair: np.ndarray, last: np.ndarray, word: np.ndarray, totals: np.ndarray, vocabulary: int) -> np.ndarray:
    """Probability of words by their counts after the word before, that word's and their own; row 1 is the background's."""
    scale = np.array([1.0, totals[0] / totals[1] if totals.min() > 0 else 1.0])[:, None]
    single = (scale * word + 1) / (scale * totals[:, None] + vocabulary)
    return (scale * pair + PRIOR * single) / (scale * last + PRIOR)


def _looking(totals: np.ndarray, vocabulary: int):
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Losses of a chunk's documents; its own row comes first, then the answers by kind and bucket."""
        head, found = None, ([], [], [])

        def losses() -> Iterator[pa.RecordBatch]:
            parts = _opened(head["words"], head["codes"], head["sizes"])
            word, last, pair = (np.concatenate(f, axis=1)[:, at] if f else np.zeros((2, 0)) for f, (_, at) in zip(found, parts))
            p = probability(pair, last, word, totals, vocabulary)
            size = np.array(head["sizes"], np.int64)
            some = size > 0
            mean = np.zeros((2, len(size)))
            if some.any():
                mean[:, some] = -np.add.reduceat(np.log(p), (np.cumsum(size) - size)[some], axis=1) / size[some]
            target, background = mean
            scored = np.array(head["roles"]) & SCORED > 0
            out = [pa.array(head["ids"], pa.int64()), *map(pa.array, (size, target, background, target - background))]
            yield pa.RecordBatch.from_arrays(out, names=[f.split(" ")[0] for f in LOSSES.split(", ")]).filter(pa.array(scored))

        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] < 0:
                    if head:
                        yield from losses()
                    head, found = row, ([], [], [])
                else:
                    found[row["kind"]].append(_counts(row["counts"]))
        if head:
            yield from losses()
        trim()

    return look


def score(docs: DataFrame, target_ids: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (mean per token, in nats), score: one row for each row of docs.

    The models count corpus, docs themselves unless given; target documents are those with doc_id in target_ids.
    """
    small_batches(docs.sparkSession)
    chosen = target_ids.where("doc_id IS NOT NULL").select("doc_id").distinct().withColumn("target", F.lit(TARGET))
    small = chosen.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    own = F.col("doc_id").cast("long").alias("doc_id")
    counted = (docs if corpus is None else corpus).select("doc_id", "text").join(F.broadcast(chosen) if small else chosen, "doc_id", "left")
    rows = counted.select(own, "text", (F.coalesce("target", F.lit(0)) + COUNTED + (SCORED if corpus is None else 0)).alias("role"))
    if corpus is not None:
        rows = rows.unionByName(docs.select(own, "text", F.lit(SCORED).alias("role")))

    chunks = stored(rows.mapInArrow(_cut, CHUNK), "lm-chunks")
    n = chunks.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_target", "n_all", "n_words")), F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()
    buckets = [max(1, -(-k // BUCKET)) for k in (n[2], n[2], n[3])]
    asked = chunks.select("chunk", "sizes", "roles", "words", "codes").mapInArrow(_asking(buckets), ASKED)
    answers = stored(asked.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(_answer, ANSWER), "lm-answers")
    distinct = answers.where("kind = 0").agg(F.coalesce(F.sum("fresh"), F.lit(0))).first()[0]
    heads = chunks.withColumns({"kind": F.lit(-1), "bucket": F.lit(0).cast("long")}).select("chunk", "kind", "bucket", "ids", "sizes", "roles", "words", "codes")
    both = heads.unionByName(answers.select("chunk", "kind", "bucket", "counts"), allowMissingColumns=True)
    look = _looking(np.array([n[0], n[1]], float), max(1 << WORD_BITS, distinct))
    return both.repartition("chunk").sortWithinPartitions("chunk", "kind", "bucket").mapInArrow(look, LOSSES)
