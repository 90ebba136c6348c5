"""Token-id files: documents as one long id sequence, compressed shard by shard with a Re-Pair grammar.

A shard blob is self-contained little-endian binary: a header of seven uint32 (magic, base, rules, symbols, tokens,
bits of a symbol, bits of a length), then numbers packed to these bits: left and right symbol of each rule, expansion
length of each rule, the compressed sequence. A symbol under `base` is a token id; base + k is rule k. Expansion
lengths make any token range readable without expanding what stands before it; a shard's row lists its documents and
their lengths, so `lookup` reads single documents.

Odd input: a null text counts as empty, so a document always holds at least its end id; a null doc_id sorts
first; repeated rows are documents of their own, in the order of their texts' hashes; no documents give no shards.
Columns beyond doc_id and text aren't stored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.llm import _io
from vintora.llm.bpe import by_bytes, byte_alphabet, ids_of

MAGIC = 0x52504332
#: Tokens after which a shard is closed.
SHARD_TOKENS = 1 << 20
#: A pair is replaced while it can be replaced so often in its shard. Three symbols less pay for a rule: two symbols and
#: a length.
LEAST = 3
#: Words remembered by a worker before its memory is cleared.
MEMO = 800_000
BATCH_BYTES = 1 << 22


def _packed(x: np.ndarray, bits: int) -> bytes:
    """Numbers as planes of their whole bytes, then of the bits left."""
    whole = bits // 8
    planes = [((x >> 8 * k) & 255).astype(np.uint8).tobytes() for k in range(whole)]
    return b"".join([*planes, *(np.packbits((x >> k) & 1 > 0).tobytes() for k in range(8 * whole, bits))])


def _unpacked(blob: bytes, at: int, n: int, bits: int) -> tuple[np.ndarray, int]:
    """n numbers that begin at a byte, and where they end."""
    out = np.zeros(n, np.uint32)
    for k in range(bits // 8):
        out |= np.frombuffer(blob, np.uint8, n, at).astype(np.uint32) << np.uint32(8 * k)
        at += n
    for k in range(8 * (bits // 8), bits):
        out |= np.unpackbits(np.frombuffer(blob, np.uint8, -(-n // 8), at), count=n).astype(np.uint32) << np.uint32(k)
        at += -(-n // 8)
    return out, at


def _frequent(seq: np.ndarray, after: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the places `at`, those whose pair stands at `least` of them: (places, number of the pair, pairs, counts)."""
    a, b = seq[at], seq[after[at]]
    if len(at) > 1 << 14:  # most places go by counting hashed pairs, which never counts too few
        slots = 1 << 18
        mixed = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B))
        slot = (mixed ^ (mixed >> np.uint32(13))) & np.uint32(slots - 1)
        often = np.bincount(slot, minlength=slots)[slot] >= least
        at, a, b = at[often], a[often], b[often]
    key = (a.astype(np.uint64) << np.uint64(32)) | b
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(key)))
    pair = np.empty(len(at), np.int64)
    pair[order] = np.repeat(np.arange(len(first)), counts)
    keep = counts[pair] >= least
    return at[keep], pair[keep], key[first], counts


def compress(ids: np.ndarray, base: int, least: int = LEAST) -> bytes:
    """A shard blob.

    Each round replaces, wherever frequent pairs overlap, the one that is locally the most frequent, and every second
    of equally frequent ones that overlap in a row; rounds go on until no pair can be replaced `least` times. Symbols
    stay where they are and are linked. A round looks only at places whose pair may still be frequent: those of frequent
    pairs that were not replaced, and those next to new symbols, where alone new pairs arise.
    """
    n = len(ids)
    seq, alive, made = ids.astype(np.uint32), np.ones(n + 1, bool), base
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    lefts, rights, sizes = [], [], []
    size = np.ones(base, np.int64)
    at = np.arange(max(0, n - 1), dtype=np.int32)
    held, names = np.full(1, np.iinfo(np.uint64).max, np.uint64), np.zeros(1, np.uint32)  # pairs that have a rule, in order
    while len(at):
        at, pair, pairs, counts = _frequent(seq, after, at, least)
        if not len(at):
            break
        count = counts[pair]
        touch = after[at[:-1]] == at[1:]
        row = np.arange(len(at))
        begin = np.maximum.accumulate(np.where(np.concatenate([[True], ~touch | (count[1:] != count[:-1])]), row, 0))
        loses = np.concatenate([[False], touch & (count[:-1] > count[1:])]) | np.concatenate([touch & (count[1:] > count[:-1]), [False]])
        taken = ((row - begin) % 2 == 0) & ~loses
        used = np.bincount(pair[taken], minlength=len(counts))
        spot = np.minimum(np.searchsorted(held, pairs), len(held) - 1)
        known = held[spot] == pairs  # what overlapped a more frequent pair when its rule was made
        enough = (used >= least) | known & (used > 0)
        if not enough.any():
            break
        good = np.flatnonzero(enough & ~known)
        left, right = (pairs[good] >> np.uint64(32)).astype(np.uint32), (pairs[good] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        lefts.append(left)
        rights.append(right)
        sizes.append(size[left] + size[right])
        size = np.concatenate([size, sizes[-1]])
        rule = np.where(known, names[spot], 0).astype(np.uint32)
        rule[good] = made + np.arange(len(good))
        at_ = np.searchsorted(held, pairs[good])
        held, names = np.insert(held, at_, pairs[good]), np.insert(names, at_, rule[good])
        made += len(good)
        taken &= enough[pair]
        here = at[taken]
        gone = after[here]
        seq[here], alive[gone] = rule[pair[taken]], False
        next_ = after[here] = after[gone]
        inside = next_ < n
        before[next_[inside]] = here[inside]
        look = np.zeros(n, bool)
        look[at] = look[here] = True
        behind = before[here]
        look[behind[behind >= 0]] = True
        at = np.flatnonzero(look & alive[:n]).astype(np.int32)
        at = at[after[at] < n]
    one = lambda x: np.concatenate([np.zeros(0, np.uint32), *x]).astype(np.uint32)
    left, right, length, left_over = one(lefts), one(rights), one(sizes), seq[alive[:n]]
    bits, length_bits = max(1, int(made - 1).bit_length()), int(length.max(initial=0)).bit_length()
    head = np.array([MAGIC, base, len(left), len(left_over), n, bits, length_bits], "<u4").tobytes()
    return b"".join([head, *(_packed(x, b) for x, b in ((left, bits), (right, bits), (length, length_bits), (left_over, bits)))])


def _parts(blob: bytes):
    magic, base, rules, symbols, tokens, bits, length_bits = np.frombuffer(blob, "<u4", 7).tolist() if len(blob) >= 28 else [0] * 7
    if magic != MAGIC:
        raise ValueError("not a shard blob")
    at, out = 28, []
    for n, b in ((rules, bits), (rules, bits), (rules, length_bits), (symbols, bits)):
        x, at = _unpacked(blob, at, n, b)
        out.append(x)
    if at != len(blob):
        raise ValueError("not a shard blob")
    left, right, size, seq = out
    return base, left, right, size.astype(np.int64), seq, tokens


def _expand(symbols: np.ndarray, base: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The token ids behind symbols, one grammar level at a time."""
    out = symbols.astype(np.uint32)
    while len(rules := np.flatnonzero(out >= base)):
        at = np.repeat(np.arange(len(out)), np.where(out >= base, 2, 1))
        k = out[rules] - base
        spot = rules + np.arange(len(rules))
        out = out[at]
        out[spot], out[spot + 1] = left[k], right[k]
    return out


def expand(blob: bytes) -> np.ndarray:
    """All token ids of a shard."""
    base, left, right, size, seq, _ = _parts(blob)
    if not len(left):
        return seq.astype(np.uint32)
    # every rule is expanded once, those of few levels first; the sequence then gathers from the expansions
    used = np.unique(seq[seq >= base])
    flat = np.concatenate([np.arange(base, dtype=np.uint32), _expand(used, base, left, right)])
    length = np.ones(base + len(left), np.int64)
    first = np.arange(base + len(left), dtype=np.int64)
    length[base:] = size
    first[used] = base + np.cumsum(length[used]) - length[used]
    n = length[seq]
    ends = np.cumsum(n)
    return flat[np.repeat(first[seq] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


def expand_range(blob: bytes, start: int, count: int) -> np.ndarray:
    """Token ids start .. start + count of a shard: only the symbols that cover the range are expanded."""
    base, left, right, size, seq, tokens = _parts(blob)
    count = max(0, min(count, tokens - start))
    n = np.where(seq >= base, size[np.maximum(seq.astype(np.int64) - base, 0)] if len(size) else 1, 1)
    ends = np.cumsum(n)
    a = int(np.searchsorted(ends, start, "right"))
    b = int(np.searchsorted(ends, start + count, "left")) + 1
    skip = start - (int(ends[a - 1]) if a else 0)
    return _expand(seq[a:b], base, left, right)[skip : skip + count]


#: Characters on which the library's normalising and splitting is plain lower-casing and the pattern below.
_PLAIN = re.compile("[^\x00-ɏ]")
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: A full stop or comma that stands in a run of other signs; elsewhere a word always ends before it.
_RUN = re.compile(r"[^ \n\ta-zÀ-ɏ0-9][.,]")


class WordEncoder:
    """Ids of whole texts by a tokenizers file with word-end BPE, whose splitting never joins text across spaces.

    Texts are cut at the space character and at line feeds. Each distinct piece is split into words once, and
    encoded once; pieces with characters beyond the plain ones go to the library whole.
    """

    def __init__(self, path: str, end_id: int = 1):
        import os

        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.base = self.model.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.bare = Tokenizer(BPE(vocab=spec["model"]["vocab"], merges=merges, end_of_word_suffix=spec["model"]["end_of_word_suffix"]))
        self.special = re.compile("|".join(re.escape(a["content"]) for a in spec["added_tokens"]) or "(?!)")
        self.to_chars = dict(enumerate(byte_alphabet()))
        self.end_id = end_id
        self.forget()

    def forget(self) -> None:
        # piece 0 is the end of a document
        self.index: dict[str | None, int] = {None: 0}
        self.flat = np.array([self.end_id], np.uint32)
        self.first = np.zeros(1, np.int32)
        self.length = np.ones(1, np.int32)

    def apart(self, text: str) -> str:
        """A text whose parts between spaces have the ids of the whole text, one after the other."""
        if not (text.isascii() or not _PLAIN.search(text)) or "<" in text and self.special.search(text):
            return text.replace("\n", " ")
        text = text.lower()
        if not _RUN.search(text):
            text = text.replace(".", " .").replace(",", " ,")
        return text.replace("\n", " ")

    def learn(self, pieces: list[str]) -> None:
        hard = [p for p in pieces if not p.isascii() and _PLAIN.search(p) or "<" in p and self.special.search(p)]
        if hard:
            skip = set(hard)
            pieces = [p for p in pieces if p not in skip]
        # all words of the plain pieces in a row; most pieces are one word
        words: list[str] = []
        counts: list[int] = []
        for p in pieces:
            if p.isalpha() and p.islower():
                words.append(p)
                counts.append(1)
            else:
                found = _SPLIT.findall(p.lower())
                words += found
                counts.append(len(found))
        shown = [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.to_chars) for w in words]
        ids, sizes = ids_of(self.bare, shown)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        length = np.diff(ends[np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])])
        if hard:
            more, sizes = ids_of(self.model, hard)
            ids = np.concatenate([ids, more])
            length = np.concatenate([length, sizes])
        n = len(self.index)
        self.index.update(zip(chain(pieces, hard), range(n, n + len(length))))
        self.first = np.concatenate([self.first, (len(self.flat) + np.cumsum(length) - length).astype(np.int32)])
        self.length = np.concatenate([self.length, length.astype(np.int32)])
        self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts one after the other, each followed by the end id, and the number for each text."""
        if len(self.index) > MEMO:
            self.forget()
        split = pc.split_pattern(pa.array([self.apart(t) for t in texts], pa.string()), " ")
        pieces = split.flatten().dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()  # far quicker than to_pylist
        known = list(map(self.index.get, distinct))
        if missing := [k for k, n in enumerate(known) if n is None]:
            new = [distinct[k] for k in missing]
            self.learn(new)
            for k, n in zip(missing, map(self.index.__getitem__, new)):
                known[k] = n
        counts = split.value_lengths().to_numpy().astype(np.int64)
        which = np.insert(np.array(known, np.int32)[pieces.indices.to_numpy()], np.cumsum(counts), 0)
        length = self.length[which]
        ends = np.cumsum(length, dtype=np.int32)  # a batch of texts is far smaller
        shift = self.first[which] - (ends - length)
        ids = self.flat[np.repeat(shift, length) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts + 1)])]
        return ids, np.diff(at)


_OPEN: dict[tuple[str, int], WordEncoder] = {}
_io.KEPT.append(_OPEN)


def _encoder(path: str, end_id: int) -> WordEncoder:
    if (path, end_id) not in _OPEN:
        _OPEN[path, end_id] = WordEncoder(path, end_id)
    return _OPEN[path, end_id]


SHARDS = "part int, shard int, n_docs long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, blob binary"


def write_shards(docs: DataFrame, path: str, vocab: str, end_id: int = 1, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the documents' ids, each followed by end_id, as shards in ascending doc_id order.

    A range exchange orders the documents over partitions, rows of one id by their texts' hashes and places, so no id
    is one task's; each task packs its own into shards of about shard_tokens tokens (a longer document makes a larger
    shard).
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder, shard = TaskContext.get().partitionId(), _encoder(vocab, end_id), 0
        held: list[np.ndarray] = []
        ids: list = []
        sizes: list[int] = []

        def closed() -> pa.RecordBatch:
            nonlocal shard
            seq = np.concatenate(held)
            rows = {"part": part, "shard": shard, "n_docs": len(ids), "n_tokens": len(seq), "doc_ids": list(ids), "doc_tokens": list(sizes), "blob": compress(seq, encoder.base)}
            shard += 1
            held.clear(), ids.clear(), sizes.clear()
            return pa.RecordBatch.from_pylist([rows], schema)

        schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("blob", pa.binary())])
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
                flat, n = encoder.encode(texts[a:b])
                cut = 0
                for k, (size, end) in enumerate(zip(n.tolist(), np.cumsum(n).tolist())):
                    ids.append(names[a + k])
                    sizes.append(size)
                    if sum(map(len, held)) + end - cut >= shard_tokens:
                        held.append(flat[cut:end])
                        cut = end
                        yield closed()
                if cut < len(flat):
                    held.append(flat[cut:])
        if ids:
            yield closed()

    _io.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"))
    order = ("doc_id", "text_hash", "row")
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(pack, SHARDS).write.parquet(path)


def read_documents(shards: DataFrame) -> DataFrame:
    """One row for each stored document: doc_id, start (tokens before it), n_tokens and its ids' crc32.

    Shards are decoded where they lie; offsets are running sums, first over parts, then within each part.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                seq = expand(row["blob"]).astype("<u4")
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - np.array(row["doc_tokens"])
                sums = [zlib.crc32(seq[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(sums)
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()), pa.array(row["doc_tokens"], pa.int64()), pa.array(sums, pa.int64())], names=["part", "shard", "doc_id", "local", "n_tokens", "ids_crc32"])

    sizes = shards.select("part", "shard", "n_tokens")
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    parts = parts.select("part", before(Window.orderBy("part")).alias("part_start"))
    within = sizes.select("part", "shard", before(Window.partitionBy("part").orderBy("shard")).alias("shard_start"))
    base = within.join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("base"))
    rows = shards.mapInArrow(unpack, "part int, shard int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return rows.join(base, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def lookup(shards: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, token_ids: the stored documents with an id in ids (doc_id), a row for each; null ids name none.

    The documents' places are found without reading a blob; a shard's blob is then read once, and of it only the
    symbols that cover a wanted document are expanded.
    """
    wanted = ids.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    places = shards.select("part", "shard", F.posexplode("doc_ids").alias("place", "doc_id")).join(wanted, "doc_id")
    asked = places.groupBy("part", "shard").agg(F.collect_list("place").alias("asked"))  # documents of one shard

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size = np.array(row["doc_tokens"], np.int64)
                start = np.cumsum(size) - size
                found = [expand_range(row["blob"], int(start[k]), int(size[k])).astype(np.int32) for k in row["asked"]]
                yield pa.RecordBatch.from_arrays([pa.array([row["doc_ids"][k] for k in row["asked"]], pa.int64()), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "token_ids"])

    _io.small_batches(shards.sparkSession)
    columns = ["blob", "doc_ids", "doc_tokens", "asked"]
    return shards.join(asked, ["part", "shard"]).select(*columns).mapInArrow(read, "doc_id long, token_ids array<int>")


def round_trip(docs: DataFrame, vocab: str, end_id: int = 1) -> DataFrame:
    """Write the shards to the shared folder and read the documents back from them."""
    import uuid

    spark = docs.sparkSession
    path = f"{_io.shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    write_shards(docs, path, vocab, end_id)
    return read_documents(spark.read.parquet(path))
