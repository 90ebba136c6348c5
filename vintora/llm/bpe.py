"""Byte-level BPE: encoding by forced-boundary splitting, decoding, and token counts.

A byte pair that occurs inside no vocabulary token can never be merged over, so every such pair in a
pretoken is a certain cut. The fragments between cuts are encoded independently (and remembered), then
concatenated. Rules for odd input: a null text counts as empty and gives no tokens; special-token strings
inside a text are recognised as the tokenizers library does by default; repeated rows are encoded alike.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintora.llm._io import KEPT, small_batches, trim

#: Fragments and pretokens remembered by a worker before its memory is cleared.
MEMO = 150_000
#: Pieces that the library encodes at a time.
SLICE = 1000
#: Bytes of text taken at a time.
BATCH_BYTES = 1 << 20
#: Texts longer than this are split for counting, where a cut is safe.
PIECE_BYTES = 1 << 16

#: Characters for which the pattern below splits exactly as the library does; other texts use the library's splitter.
_PLAIN = re.compile("[^\x00-ɏ]")
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in kept}
    for n, b in enumerate(b for b in range(256) if b not in chars):
        chars[b] = chr(256 + n)
    return [chars[b] for b in range(256)]


def ids_of(model, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the pieces, one after the other, and the number for each piece.

    The library's results are far larger than their ids, and lists keep the garbage collector busy: a slice's stand at a time.
    """
    flat, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for a in range(0, len(pieces), SLICE):
        ids = [e.ids for e in model.encode_batch_fast(pieces[a : a + SLICE], add_special_tokens=False)]
        sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(sizes[-1].sum())))
    return np.concatenate(flat), np.concatenate(sizes)


class ByteBpe:
    """Encoder and decoder for one byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer, pre_tokenizers
        from tokenizers.models import BPE

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each thread would keep memory of its own
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=spec["pre_tokenizer"]["add_prefix_space"])
        self.bare = Tokenizer(BPE(vocab=vocab, merges=merges))  # no splitting of its own: a fragment is one piece
        alphabet = byte_alphabet()
        self.to_chars = {b: c for b, c in enumerate(alphabet)}
        back = {c: b for b, c in enumerate(alphabet)}
        size = max([*vocab.values(), *(a["id"] for a in spec["added_tokens"])]) + 1
        tokens: list[bytes] = [b""] * size
        inside = np.zeros((256, 256), bool)
        for token, i in vocab.items():
            tokens[i] = b = bytes(back[c] for c in token if c in back)
            for x, y in zip(b, b[1:]):
                inside[x, y] = True
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for content, i in self.special.items():
            tokens[i] = content.encode()
        #: forced[x, y]: no token holds byte x followed by byte y.
        self.forced = ~inside
        self.find_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.token_length = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)])
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.last: tuple[pa.Array, pa.Array] | None = None
        self.fragments: dict[bytes, bytes] = {}  # their ids, four bytes each
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def pretokens(self, text: str) -> list[str]:
        if not _PLAIN.search(text):
            return _SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[str]:
        """Pretokens of a text, with special-token strings as pieces of their own."""
        if not self.find_special or not self.find_special.search(text):
            return self.pretokens(text)
        out: list[str] = []
        at = 0
        for m in self.find_special.finditer(text):
            out += self.pretokens(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self.pretokens(text[at:])

    def cut(self, pieces: list[bytes]) -> list[list[bytes]]:
        """Each piece split at the forced boundaries inside it."""
        b = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        at = np.zeros(len(b) + 1, bool)
        at[1:-1] = self.forced[b[:-1], b[1:]]
        at[0] = at[-1] = True
        at[ends] = True
        cuts, raw, out, k = np.flatnonzero(at).tolist(), b.tobytes(), [], 0
        for end in ends.tolist():
            parts = []
            while cuts[k] < end:
                parts.append(raw[cuts[k] : cuts[k + 1]])
                k += 1
            out.append(parts)
        return out

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that aren't remembered yet."""
        ids = [np.int32(self.special[p]).tobytes() if p in self.special else None for p in pieces]
        plain = [p for p, i in zip(pieces, ids) if i is None]
        split = iter(self.cut([p.encode() for p in plain])) if plain else iter(())
        parts = [None if i is not None else next(split) for i in ids]
        new = list({f for fs in parts if fs for f in fs if f not in self.fragments})
        shown = [f.decode("latin-1").translate(self.to_chars) for f in new]
        flat, sizes = ids_of(self.bare, shown)
        raw, ends = flat.tobytes(), (4 * np.cumsum(sizes)).tolist()
        self.fragments.update((f, raw[a:b]) for f, a, b in zip(new, [0, *ends], ends))
        known = self.fragments
        found = [i if fs is None else (known[fs[0]] if len(fs) == 1 else b"".join(known[f] for f in fs)) for i, fs in zip(ids, parts)]
        n = len(self.index)
        self.index.update((p, n + k) for k, p in enumerate(pieces))
        length = np.array([len(i) // 4 for i in found], np.int64)
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(found), np.int32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and the offsets of each text in them."""
        if len(self.index) > MEMO:
            self.forget()
        split = [self.pieces(t) for t in texts]
        index = self.index
        new = list({p for s in split for p in s if p not in index})
        if new:
            self.learn(new)
            index = self.index
        counts = np.array([len(s) for s in split], np.int64)
        which = np.fromiter((index[p] for s in split for p in s), np.int64, int(counts.sum()))
        length = self.length[which]
        ends = np.cumsum(length)
        ids = self.flat[np.repeat(self.first[which] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of several id sequences; bytes that are no UTF-8 become replacement characters."""
        length = self.token_length[ids]
        ends = np.cumsum(length)
        raw = self.token_bytes[np.repeat(self.token_start[ids] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        at = np.concatenate([[0], ends])[offsets].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]


_OPEN: dict[str, ByteBpe] = {}
KEPT.append(_OPEN)


def opened(path: str) -> ByteBpe:
    """One encoder for each worker process and vocabulary."""
    if path not in _OPEN:
        _OPEN[path] = ByteBpe(path)
        trim(kept=True)
    return _OPEN[path]


def by_bytes(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `most` bytes each; a longer row stands alone."""
    start = held = 0
    for k, n in enumerate(sizes):
        if k > start and held + n > most:
            yield start, k
            start, held = k, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def encode(text: Column, path: str) -> Column:
    """array<int>: the token ids of a text column."""

    # one batch in, one out: such functions chain, so a text is encoded and decoded by one worker
    @F.arrow_udf("array<int>")
    def ids_of(batch: pa.Array) -> pa.Array:
        bpe = opened(path)
        if bpe.last and bpe.last[0].equals(batch):  # ids and their decoding in one plan ask for a batch twice
            return bpe.last[1]
        texts = ["" if t is None else t for t in batch.to_pylist()]
        ids, ends, n = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
        for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
            found, offsets = bpe.encode(texts[a:b])
            ids.append(found)
            ends.append(offsets[1:] + n)
            n += len(found)
        bpe.last = batch, pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
        return bpe.last[1]

    return ids_of(text)


def decode(ids: Column, path: str) -> Column:
    """string: the text of an array<int> column of token ids; null gives an empty text."""

    @F.arrow_udf("string")
    def text_of(batch: pa.Array) -> pa.Array:
        bpe = opened(path)
        flat = batch.fill_null([]).flatten().to_numpy(zero_copy_only=False)
        sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        out: list[str] = []
        for a, b in by_bytes((sizes * 4).tolist(), BATCH_BYTES):
            out += bpe.decode(flat[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
        return pa.array(out, pa.string())

    return text_of(ids)


def encode_documents(docs: DataFrame, path: str, text: str = "text", to: str = "token_ids") -> DataFrame:
    """docs with a column of token ids; a column of that name is replaced."""
    small_batches(docs.sparkSession)
    return docs.withColumn(to, encode(F.col(text), path))


def decode_documents(docs: DataFrame, path: str, ids: str = "token_ids", to: str = "decoded") -> DataFrame:
    """docs with a column of decoded text; a column of that name is replaced."""
    small_batches(docs.sparkSession)
    return docs.withColumn(to, decode(F.col(ids), path))


#: Between a letter, one space and a letter a new pretoken begins at the space whatever stands around it.
_SAFE = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def safe_pieces(text: str, most: int = PIECE_BYTES) -> list[str]:
    """A text in pieces of about `most` characters whose token counts add up to the whole text's."""
    if len(text) <= most:
        return [text]
    out, at = [], 0
    while len(text) - at > most and (m := _SAFE.search(text, at + most)):
        out.append(text[at : m.start()])
        at = m.start()
    return [*out, text[at:]]


_COUNTERS: dict = {}
KEPT.append(_COUNTERS)


def _counter(path: str):
    """A function from texts to token counts, and whether texts may be split at safe boundaries."""
    if path not in _COUNTERS:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _COUNTERS[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], False
        else:
            import json
            import os

            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            known = json.loads(model.to_str())
            pre = known["pre_tokenizer"] or {}
            byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not known["normalizer"]
            _COUNTERS[path] = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)], byte_level
    return _COUNTERS[path]


def token_count(text: Column, path: str) -> Column:
    """long: the number of tokens of a text column.

    Only lengths leave the worker. Batches hold about BATCH_BYTES; texts over PIECE_BYTES are split at safe
    boundaries where the file's own pre-tokenizer is the byte-level one: other models see whole texts.
    """

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count, split = _counter(path)
        for batch in batches:
            pieces: list[str] = []
            owner: list[int] = []
            for k, t in enumerate(batch.to_pylist()):
                found = safe_pieces(t) if t and split else [t] if t else []
                pieces += found
                owner += [k] * len(found)
            n = np.zeros(len(batch), np.int64)
            for a, b in by_bytes([len(p.encode("utf-8", "surrogatepass")) for p in pieces], BATCH_BYTES):
                np.add.at(n, owner[a:b], count(pieces[a:b]))
            yield pa.array(n)

    return lengths(text)


def count_documents(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit (more tokens than `limit`); columns of these names are replaced."""
    small_batches(docs.sparkSession)
    return docs.withColumns({
        "n_bytes": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long"),
        "n_tokens": token_count(F.col(text), path),
    }).withColumn("over_limit", F.col("n_tokens") > limit)
