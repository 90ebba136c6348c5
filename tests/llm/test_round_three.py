"""Collocations, exact deduplication and resampling against brute force, on rows of awkward kinds."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vintora.llm import collocations, exact, resample
from vintora.llm.queries import QUERIES

LOW = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})
DOCS = "doc_id long, text string, lang string, hash string, page int, n long, kept string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "clash", 1, 2, "x", 3) for i, t, lang in rows], DOCS)


def phrases_of(rows, top=2000):
    said, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                said.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in said.items():
        candidates, absorbed = {}, set()
        for p, a in f.items():
            if len(p) > 1 and a >= 10:
                candidates[p] = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                for q in ((p[:2], p[1:]) if len(p) == 3 else ()):
                    if 100 * a >= 50 * f[q]:
                        absorbed.add(q)
        ranked = sorted((-s, -f[p], " ".join(p).encode(), p, k) for p, (s, k) in candidates.items() if p not in absorbed)
        out += [(lang, r + 1, b.decode(), -a, f[p[:k]], f[p[k:]], n[lang], -s) for r, (s, a, b, p, k) in enumerate(ranked[:top])]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def some_texts(seed, n=400):
    rnd = random.Random(seed)
    words = ["a", "A", "b", "é", "É", "\x01x", "new", "york", "İ", "c-d", "(e)", "'", "z\x1fz", "你好"]
    text = lambda: "".join(rnd.choice(words) + rnd.choice(["  ", " ", " ", " ", "\t", ". ", "\n", "\r", "\x0b", "!?"]) for _ in range(rnd.randint(0, 60)))
    rows = [(rnd.choice([None, k]), rnd.choice([None, "", text(), text(), text(), text(), "New York City " * rnd.randint(0, 30)]), rnd.choice([None, "und", "en", "de"])) for k in range(n)]
    return rows + rows[:30] + [(n, "x y " * 50_000, "en")]


def test_phrases_equal_brute_force(spark):
    rows = some_texts(1)
    want = phrases_of(rows)
    assert len(want) > 50 and {r[0] for r in want} == {"und", "en", "de"}
    assert found(collocations.collocations(frame(spark, rows).repartition(5))) == want


def test_phrases_of_small_chunks_ranges_and_limits(spark, monkeypatch):
    """Many chunks for a task, many ranges, and a limit that ties reach."""
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(collocations, "RANGE_KEYS", 5000)
    rows = some_texts(2)
    assert found(collocations.collocations(frame(spark, rows).repartition(3), top=7)) == phrases_of(rows, 7)


def test_op11(spark, small):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert found(QUERIES["op11_collocations"](spark, small)) == phrases_of(rows)


def test_large_vocabularies_take_the_other_way():
    rnd = np.random.default_rng(3)
    columns = [rnd.integers(0, 5, 1000) for _ in range(3)]
    for a, b in zip(collocations._runs(columns, 5)[0], collocations._runs(columns, 1 << 30)[0]):
        assert a.tolist() == b.tolist()
    assert collocations._runs(columns, 5)[1].tolist() == collocations._runs(columns, 1 << 30)[1].tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(1, 9)), max_size=80), st.integers(1, 9))
def test_run_lengths(rows, step):
    rows.sort(key=lambda r: r[0])
    batches = (tuple(np.array([r[k] for r in rows[i : i + step]], np.int64) for k in range(3)) for i in range(0, len(rows), step))
    want = Counter()
    for h, low, n in rows:
        want[h, low] += n
    got = [x for part in collocations.run_lengths(batches) for x in zip(*(a.tolist() for a in part))]
    assert [x[:2] for x in got] == sorted(want) and {x[:2]: x[2] for x in got} == dict(want)


def copies_of(rows):
    """(doc_id, keep_id, group_size, kept, sha) of every row, sorted; of rows that repeat id and text one is kept."""
    groups = {}
    for i, t, _ in rows:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        first = True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and first, sha))
            first = first and i != keep
    return sorted(out, key=repr)


def deduplicated(df):
    return sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in df.collect()), key=repr)


def many_copies(seed, n=1500):
    rnd = random.Random(seed)
    texts = [None, "", "A", "a", "É", "é", "ſ", "K", "same text here", "SAME text here", "x" * 30_000] + [f"text {k}" for k in range(200)]
    rows = [(rnd.choice([None, k, k, k, k, 5]), rnd.choice(texts), "en") for k in range(n)]
    return rows + [(10_000 + k, "The hot text", "en") for k in range(n)] + [(None, "the hot text", "en")] * 50


def test_exact_duplicates_equal_brute_force(spark):
    rows = many_copies(1)
    assert deduplicated(exact.exact_duplicates(frame(spark, rows).repartition(4))) == copies_of(rows)


def test_buckets_split_and_overflow(spark, monkeypatch):
    """Small pages: the directory doubles, and the hot text gets overflow pages."""
    monkeypatch.setattr(exact, "PAGE_BYTES", 20_000)
    rows = many_copies(2)
    docs = frame(spark, rows).repartition(4)
    placed, pages = exact.placed(exact.keyed(docs))
    weights = {r.page: r[1] for r in placed.groupBy("page").agg({"text": "count"}).collect()}
    kinds = {r.pages for r in placed.select("pages").distinct().collect()}
    assert pages > 30 and 1 in kinds and max(kinds) > 15 and max(weights.values()) < 200
    assert deduplicated(exact.exact_duplicates(docs)) == copies_of(rows)


def test_texts_of_one_hash_are_told_apart_by_their_bytes(spark, monkeypatch):
    from pyspark.sql import functions as F

    keyed = exact.keyed
    monkeypatch.setattr(exact, "keyed", lambda docs: keyed(docs).withColumn("hash", F.col("hash") % 2))
    for page in (1 << 20, 20_000):  # as one page, and in overflow pages
        monkeypatch.setattr(exact, "PAGE_BYTES", page)
        rows = many_copies(3, 400)
        assert deduplicated(exact.exact_duplicates(frame(spark, rows).repartition(4))) == copies_of(rows)


def test_op12(spark, small):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert deduplicated(QUERIES["op12_exact_dedup"](spark, small)) == copies_of(rows)


def buckets_of(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    return len(w), [crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def drawn(rows, target):
    held = [(i, *buckets_of(t)) for i, t in rows]
    s, t = Counter(b for h in held for b in h[2]), Counter(b for x in target for b in buckets_of(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in range(10000)]
    out = []
    for i, words, b in held:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in b)
        out.append((i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    fit = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    drawn = 5 * len(fit) // 100
    return sorted([(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(fit)] + [(*r[:4], None) for r in out if r[4] < 20], key=repr)


def ranked(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()), key=repr)


def test_op13(spark, small, texts):
    target = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = ranked(QUERIES["op13_resample"](spark, small))
    assert got == drawn(list(texts.items()), target)
    assert sum(r[4] is not None for r in got) > 3


def test_resampling_of_odd_rows(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, k, 3]), rnd.choice([None, "", "one two", "A-b É K ſ " * rnd.randint(5, 40), " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(15, 40)))])) for k in range(600)]
    rows += rows[:50] + [(9000, "hot words " * 60_000)]
    docs = frame(spark, [(i, t, None) for i, t in rows]).repartition(4)
    for target in (["a b c d e a b", None], []):
        items = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id long")
        assert ranked(resample.resample(docs, items)) == drawn(rows, target)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab Z9-é\t.", max_size=60), st.integers(1, 5))
def test_the_ring_gives_every_run(text, longest):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOW))
    got = resample.ring_of_crcs(resample.words_of(text.encode()), longest)
    assert Counter(got) == Counter(crc32(" ".join(w[i : i + k]).encode()) for k in range(1, longest + 1) for i in range(len(w) - k + 1))


def test_workers_drop_what_another_operator_kept():
    from vintora.llm import _io, bpe
    from vintora.llm.queries import vocabulary

    path = vocabulary("byte_bpe_50k.json")
    first = bpe.opened(path).encode(["a text of words"])[0].tolist()
    assert path in bpe._OPEN and any(held is bpe._OPEN for held in _io.KEPT)
    _io.trim(kept=True)
    assert path in bpe._OPEN
    _io.trim()
    assert not bpe._OPEN and bpe.opened(path).encode(["a text of words"])[0].tolist() == first
