"""Phrase collocations: counts of word pairs and triples, and how much more often they stand together than apart.

Texts are cut into chunks, whose words are coded by a vocabulary of the chunk. The dictionary numbers the words that
occur LEAST times or more in their language; a phrase can't be more frequent than its words, so all other words break
pieces. A chunk asks the dictionary for the numbers of its distinct words, whatever the dictionary's size: a word is
one row for each chunk that holds it, and nothing is broadcast.

Pairs and triples of numbers are packed into fixed-width keys of 12 bytes: eight, the first two numbers, stand in one
long, the third in another column. A chunk counts its keys before they travel. Keys are dealt to ranges whose limits
follow from the frequencies of the words: the share of the words below the first one, and within it of those below the
second. So ranges are even without a sample, also for a word that is a large part of a text. Within a range Spark's
radix sort orders the long, and run lengths are added up as they stream by.

Scores are exact: products are decimals of 38 digits, which is enough for counts up to 10**15. Odd input: a null
language is `und`; null, empty and blank texts have no words; repeated rows count each; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.llm._io import discard, numbered, small_batches, stored, trim

#: Least count of a candidate; a longer candidate with this share of its count (in hundredths) replaces a part of it.
LEAST, ABSORBED = 10, 50
#: Phrases returned for a language.
TOP = 2000
#: A chunk ends with the document that brings it to so many bytes of text.
CHUNK_BYTES = 16 << 20
#: Keys sorted by a task, about.
RANGE_KEYS = 4 << 20
#: Ways in which a language is dealt before its phrases are ranked together.
DEALS = 64

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(0x2E if c in _BREAKS else 0x20 if c == 0x09 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
CHUNK = "chunk long, lang string, n_words long, width int, codes binary, words array<string>, counts array<long>"


def tokens_of(text: bytes) -> list[bytes]:
    """Words of a text, and `.` where a piece ends."""
    return text.translate(_TABLE).replace(b".", b" . ").split()


class _Vocabulary(dict):
    """Codes in the order of appearance; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def chunked(docs: DataFrame) -> DataFrame:
    """Rows of CHUNK: the coded texts of one language in a chunk, and its distinct words with their counts."""
    names = [c.split()[0] for c in CHUNK.split(", ")]

    def closed(chunk: int, lang: str, vocabulary: _Vocabulary, codes: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate(codes)
        width = 2 if len(vocabulary) <= 1 << 16 else 4
        counts = np.bincount(flat, minlength=len(vocabulary))[1:]
        words = pa.array([*vocabulary][1:], pa.binary()).cast(pa.string())
        lists = [pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), x) for x in (words, pa.array(counts, pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([lang], pa.string()), pa.array([int(counts.sum())], pa.int64()), pa.array([width], pa.int32()), pa.array([flat.astype(f"<u{width}").tobytes()], pa.binary()), *lists], names=names)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, held, size = TaskContext.get().partitionId() << 32, {}, 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                raw = text.as_py()
                vocabulary, codes = held.setdefault(lang, (_Vocabulary(), []))
                found = tokens_of(raw)
                codes.append(np.fromiter(map(vocabulary.__getitem__, found), np.uint32, len(found)))
                codes.append(np.zeros(1, np.uint32))
                size += len(raw)
                if size >= CHUNK_BYTES:
                    for k, (name, parts) in enumerate(held.items()):
                        yield closed(chunk + k, name, *parts)
                    chunk, held, size = chunk + len(held), {}, 0
        for k, (name, parts) in enumerate(held.items()):
            yield closed(chunk + k, name, *parts)
        del held
        trim()

    small_batches(docs.sparkSession)
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(look, CHUNK)


def dictionary(chunks: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, word, f, id (from 1 in the order of lang and word), low and share (of all frequent words, those before and its own)."""
    said = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", "w.words", "w.counts")
    frequent = stored(said.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f")).where(F.col("f") >= least), "frequent")
    total = frequent.agg(F.sum("f")).first()[0] or 1
    rows = numbered(frequent, [F.col("lang"), F.col("word")], "id", running="f")
    out = stored(rows.select("lang", "word", "f", "id", ((F.col("f_to") - F.col("f")) / F.lit(float(total))).alias("low"), (F.col("f") / F.lit(float(total))).alias("share")), "dictionary")
    discard(frequent)
    return out


def _runs(columns: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of numbers below size, in order, and how often each stands there."""
    bits = max(1, int(size).bit_length())
    if bits * len(columns) <= 64:
        key = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            key = (key << np.uint64(bits)) | c.astype(np.uint64)
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        key, n = key[first], np.diff(np.append(first, len(key)))
        low = np.uint64((1 << bits) - 1)
        return [((key >> np.uint64(bits * k)) & low).astype(np.int64) for k in range(len(columns) - 1, -1, -1)], n
    order = np.lexsort(columns[::-1])
    columns = [c[order].astype(np.int64) for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.diff(np.append(first, len(order)))


def keys_of(chunks: DataFrame, words: DataFrame, ranges: int) -> DataFrame:
    """part (of `ranges`), high (first id << 32 | second), low (third id, 0 for a pair), n: the counts of each chunk."""
    asked = chunks.select("chunk", "lang", F.posexplode("words").alias("code", "word")).join(words, ["lang", "word"])
    answers = asked.groupBy("chunk").agg(F.collect_list(F.struct("code", "id", "low", "share")).alias("found"))
    told = chunks.select("chunk", "width", "codes").join(answers, "chunk")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, codes, found in zip(batch.column("width").to_pylist(), batch.column("codes"), batch.column("found")):
                codes = np.frombuffer(codes.as_buffer(), f"<u{width}")
                code, ids, low, share = (found.values.field(c).to_numpy() for c in ("code", "id", "low", "share"))
                order = np.argsort(ids)
                ids, low, share = ids[order], low[order], share[order]
                rank = np.zeros(max(int(codes.max(initial=0)), int(code.max(initial=0)) + 1) + 1, np.int32)
                rank[code[order] + 1] = np.arange(1, len(ids) + 1)  # codes count from 1, places in the list from 0
                seq = rank[codes]
                both = (seq[:-1] > 0) & (seq[1:] > 0)
                for n in (2, 3):
                    at = np.flatnonzero(both if n == 2 else both[:-1] & both[1:])
                    runs, count = _runs([seq[at + k] for k in range(n)], len(ids) + 1)
                    if not len(count):
                        continue
                    a, b = runs[0] - 1, runs[1] - 1
                    part = np.minimum((low[a] + share[a] * low[b]) * ranges, ranges - 1).astype(np.int32)
                    high = (ids[a] << 32) | ids[b]
                    third = ids[runs[2] - 1] if n == 3 else np.zeros(len(count), np.int64)
                    for s in range(0, len(count), 1 << 16):
                        cut = slice(s, s + (1 << 16))
                        yield pa.RecordBatch.from_arrays([pa.array(x[cut]) for x in (part, high, third, count.astype(np.int64))], names=["part", "high", "low", "n"])
                del codes, seq, both
        trim()

    return told.mapInArrow(look, "part int, high long, low long, n long")


def run_lengths(batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(high, low, n) of batches sorted by high, each key once. Only the keys of one `high` are held back."""

    def added(parts):
        high, low, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((low, high))
        high, low, n = high[order], low[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
        return high[first], low[first], np.add.reduceat(n, first)

    held, size, waiting = [], 0, 0  # parts, keys once added up, rows since
    for batch in batches:
        if not len(batch[0]):
            continue
        held.append(batch)
        waiting += len(batch[0])
        if batch[0][-1] == held[0][0][-1] and waiting <= size:
            continue
        done = added(held)
        cut = int(np.searchsorted(done[0], done[0][-1]))
        if cut:
            yield tuple(x[:cut] for x in done)
        held = [tuple(x[cut:] for x in done)]
        size, waiting = len(held[0][0]), 0
    if held:
        yield added(held)


def counted(keys: DataFrame, ranges: int, least: int = LEAST) -> DataFrame:
    """high, low, f of the keys with a count of `least` or more."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for high, low, n in run_lengths(tuple(b.column(c).to_numpy() for c in ("high", "low", "n")) for b in batches):
            keep = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (high, low, n)], names=["high", "low", "f"])

    ranged = keys.repartitionById(ranges, "part").select("high", "low", "n").sortWithinPartitions("high")
    return ranged.mapInArrow(look, "high long, low long, f long")


def _score(a: str, left: str, right: str) -> Column:
    wide = lambda c: f"cast({c} as decimal(38,0))"
    return F.expr(f"(1000000 * {wide(a)} * {wide(a)}) div ({wide(left)} * {wide(right)})")


def scored(grams: DataFrame, words: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of all candidates that no longer one replaces. grams: high, low, f; words: the dictionary."""
    of = lambda k: words.select(F.col("id").alias(f"i{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"), *([F.col("lang")] if k == 1 else []))
    pairs = grams.where("low = 0").select(F.col("high").alias("pair"), F.col("f").alias("a"))
    triples = grams.where("low > 0").select(F.col("high").alias("pair"), F.expr("shiftleft(high, 32) | low").alias("next"), F.col("low").alias("i3"), F.col("f").alias("a"))
    ends = lambda rows: rows.withColumns({"i1": F.shiftright("pair", 32), "i2": F.expr("pair & 4294967295")})

    longer = triples.select("pair", "a").unionByName(triples.select(F.col("next").alias("pair"), "a")).groupBy("pair").agg(F.max("a").alias("longer"))
    two = pairs.join(longer, "pair", "left").where(F.expr(f"longer IS NULL OR 100 * longer < {ABSORBED} * a"))
    two = ends(two).join(of(1), "i1").join(of(2), "i2")
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"))

    part = lambda name, to: pairs.select(F.col("pair").alias(name), F.col("a").alias(to))
    three = ends(triples).join(part("pair", "f12"), "pair").join(part("next", "f23"), "next").join(of(1), "i1").join(of(2).drop("f2"), "i2").join(of(3), "i3")
    three = three.withColumns({"early": _score("a", "f1", "f23"), "late": _score("a", "f12", "f3")})
    best = lambda x, y: F.when(F.col("early") <= F.col("late"), F.col(x)).otherwise(F.col(y))
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", best("f1", "f12").alias("l"), best("f23", "f3").alias("r"), F.least("early", "late").alias("score"))
    return two.unionByName(three)


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the best `top` phrases of each language."""
    chunks = stored(chunked(docs), "chunks", compression="zstd")
    totals = chunks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    words = dictionary(chunks)
    ranges = max(1, -(-2 * (chunks.agg(F.sum("n_words")).first()[0] or 0) // RANGE_KEYS))
    grams = stored(counted(keys_of(chunks, words, ranges), ranges), "grams")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = scored(grams, words).withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(DEALS)))
    some = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    out = stored(best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "phrases")
    discard(chunks, words, grams)
    return out
