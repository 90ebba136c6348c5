"""Each registered query against a brute-force version over the small tables, and over empty ones."""

import re
import zlib

import numpy as np
import pytest

from tests.llm.conftest import sha
from vintora.llm.queries import QUERIES, vocabulary

LOW = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def rows(spark, name, folder, key="doc_id"):
    return {r[key]: r for r in QUERIES[name](spark, folder).collect()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, void, name):
    assert QUERIES[name](spark, void).count() == 0


def jaccard_truth(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_op1(spark, small, texts):
    got = {i: (r.n_shingles, r.component_id) for i, r in rows(spark, "op1_jaccard_join", small).items()}
    assert got == jaccard_truth(texts)
    assert got[10_006][1] == got[10_008][1] == 10_006  # the near copy
    assert got[10_000] == (0, 10_000) and got[10_001] == (0, 10_001)


def test_op2(spark, small, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    got = rows(spark, "op2_bpe_round_trip", small)
    assert len(got) == len(texts)
    for i, t in texts.items():
        ids = model.encode(t or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids, skip_special_tokens=False)))


def plain_words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower()) if w]


def overlap_truth(doc, item):
    """Overlap of two texts by the masks, or None: every place against every place."""
    from vintora.llm import decontaminate as d

    a, b = plain_words(doc), plain_words(item)
    n, m = len(a), len(b)
    if not m:
        return None
    if m < d.SHORT:
        return m if a == b else None
    if m < d.SPAN:
        k = m - -(-8 * m // 10) + 1
        cuts = [m * j // k for j in range(k + 1)]
        seeds = [tuple(range(x, y)) for x, y in zip(cuts, cuts[1:])]
    else:
        seeds = [tuple(q + j for j in mask) for mask in d.MASKS for q in range(m - d.SPAN + 1)]
    lanes = set()
    for lane in range(-m + 1, n):
        if any(all(0 <= lane + j < n and a[lane + j] == b[j] for j in s) and (m < d.SPAN or lane + s[0] + d.SPAN <= n) for s in seeds):
            lanes.add(lane)
    best = None
    for lane in lanes:
        same = [a[lane + j] == b[j] for j in range(m) if 0 <= lane + j < n]
        now = top = 0
        for x in same:
            now = max(0, now + (1 if x else -2))
            top = max(top, now)
        whole = min(d.LEAST, m)
        share = any(10 * sum(same[x:y]) >= 8 * (y - x) for x in range(len(same)) for y in range(x + whole, len(same) + 1))
        if top >= min(d.LEAST, -(-8 * m // 10)) or share:
            best = max(best or 0, top)
    return best


def test_op3(spark, small, texts):
    """Every document against every item, place by place."""
    got = {i: (r.item_ids, r.overlap) for i, r in rows(spark, "op3_decontaminate", small).items()}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    grams = {}
    for k, (_, t) in enumerate(bench):
        w = plain_words(t)
        for j in range(max(1, len(w) - 1)):
            grams.setdefault(tuple(w[j : j + 2]), set()).add(k)
    want = {}
    for i, t in texts.items():
        w = plain_words(t)
        near = set().union(*(grams.get(tuple(w[j : j + 2]), set()) for j in range(max(1, len(w) - 1))))  # any seed holds two words in a row
        hits = {bench[k][0]: o for k in near if (o := overlap_truth(t, bench[k][1])) is not None}
        if hits:
            want[i] = (",".join(map(str, sorted(x for x in hits if x is not None))), max(hits.values()))
    assert {10_012, 10_013} <= set(want)
    assert got == want


def test_op4(spark, small, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got, start = rows(spark, "op4_token_shards", small), 0
    for i in sorted(texts):
        ids = [*model.encode(texts[i] or "", add_special_tokens=False).ids, 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op5(spark, small):
    data = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = QUERIES["op5_nearest"](spark, small).collect()
    hits = total = 0
    for q, v in data:
        if q % 20:
            continue
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        truth = sorted((-float(x @ v), i) for i, x in data if i != q)[:20]
        assert [r[0] for r in mine] == list(range(1, len(truth) + 1))
        assert all(a[2] >= b[2] for a, b in zip(mine, mine[1:]))
        hits, total = hits + len({r[1] for r in mine} & {t[1] for t in truth}), total + len(truth)
    assert hits >= 0.9 * total


PATTERNS = [(re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12), (re.compile("AKIA[A-Z0-9]+"), 0, 18), (re.compile("[0-9a-f]+"), 0, 16)]


def markov_spans(model, text, base):
    """Spans that the method adds, run by run."""
    import math

    from vintora.llm import secrets as s

    k, out = len(s.ALPHABET) + 1, []
    least = 1 + math.ceil(s.LEVEL / max(model))
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text):
        run = m[0]
        if len(run) < least:
            continue
        ratios = [round(model[s.ALPHABET.index(a) * k + s.ALPHABET.index(b)], 6) for a, b in zip(run, run[1:])]
        if sum(ratios) >= s.LEVEL and sum(ratios) >= s.THRESHOLD * len(ratios) and not any(b <= m.start() and m.end() <= e for b, _, e in base):
            out.append((m.start(), 3, m.end()))
    return out


def test_op6(spark, small, texts):
    from vintora.llm import secrets

    model = secrets.train(secrets.labelled_samples(spark.read.parquet(f"{small}/documents.parquet")))
    got = rows(spark, "op6_secrets", small)
    names = ("assign", "access", "hex", "markov")
    shown = lambda spans: ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans))
    for i, t in texts.items():
        found = sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(PATTERNS) for m in p.finditer(t or "") if len(m[g]) >= n)
        assert ([got[i].n_assign, got[i].n_access, got[i].n_hex], got[i].base_sha256) == ([sum(x[1] == k for x in found) for k in range(3)], sha(shown(found)))
        assert got[i].spans == shown(found + markov_spans(model, t or "", found)), i
    assert "markov" in got[10_016].spans and got[10_015].n_assign == 0


def test_op7(spark, small, texts):
    got = rows(spark, "op7_licenses", small)
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    for i, t in texts.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
        places = [(k, label) for p, label in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        want = (len(w), len(places), min(places)[0] if places else None, max(places)[0] if places else None, ",".join(sorted({x for _, x in places})))
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) == want
        assert 0 <= got[i].score <= 1 and {x for _, x in places} <= set(got[i].labels.split(","))


def test_op8(spark, small, texts):
    """Losses against counts by hashed slots kept in plain dictionaries."""
    from collections import Counter

    from vintora.llm import lm_score

    got = rows(spark, "op8_lm_score", small)
    good = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").where("quality = 1").collect()}
    held = {i: [x.tolist() for x in next(iter(lm_score.slots([t or ""])))] for i, t in texts.items()}
    counts = []
    for chosen in (good, set(texts)):
        some = [h for i, h in held.items() if i in chosen]
        counts.append([Counter(s for h in some for s in h[k]) for k in range(3)])
    for i, (word, last, pair) in held.items():
        losses = []
        for w, c, p in counts:
            f = sum(counts[0][0].values()) / sum(w.values())  # both models rest on as many tokens
            total = f * sum(w.values()) + 2**lm_score.WORD_BITS
            losses.append(-np.mean([np.log((f * p[z] + lm_score.PRIOR * (f * w[x] + 1) / total) / (f * c[y] + lm_score.PRIOR)) for x, y, z in zip(word, last, pair)]) if word else 0.0)
        assert got[i].n_tokens == len(word)
        assert abs(got[i].score - (losses[0] - losses[1])) < 1e-4


def test_op9(spark, small, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    got = rows(spark, "op9_token_counts", small)
    for i, t in texts.items():
        n = len(model.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 512)


def test_op10(spark, small, texts):
    got = rows(spark, "op10_toxicity", small)
    for i in texts:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.5)


def toxic_bins(text):
    """Feature bins of a text, n-gram by n-gram."""
    from vintora.llm import toxicity

    if not text:
        return set()
    c, out, mask = [ord(x) for x in f" {text.lower()} "], set(), 0xFFFFFFFF
    for n in toxicity.SIZES:
        for k in range(len(c) - n + 1):
            h = c[k]
            for x in c[k + 1 : k + n]:
                h = (h * 0x01000193 + x) & mask
            out.add((((h ^ (h >> 15)) * (0x85EBCA6B + 2 * n)) & mask) >> (32 - toxicity.BITS))
    return out


def test_op10_scores_follow_the_model(spark, small, texts):
    """Class counts and scores against those from n-grams one by one; nothing but the text counts."""
    from pyspark.sql import functions as F

    from vintora.llm import toxicity

    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    counts = toxicity._class_counts(toxicity._training(docs, labels)).sum(0)
    marks = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5}
    plain = np.zeros_like(counts)
    for i, y in marks.items():
        if i in texts:
            plain[y, list(toxic_bins(texts[i]))] += 1
            plain[y, -1] += 1
    assert (plain == counts).all() and counts[:, -1].min() > 0
    ratio = toxicity.log_ratio(counts)
    assert abs(ratio[5] - np.log((counts[1, 5] + 1) / (counts[1, -1] + 2) / ((counts[0, 5] + 1) / (counts[0, -1] + 2)))) < 1e-9
    weights, bias = toxicity.fit(docs, labels)
    got = rows(spark, "op10_toxicity", small)
    for i, t in texts.items():
        z = float(weights[sorted(toxic_bins(t))].sum(dtype=np.float64)) + bias
        assert abs(got[i].score - 1 / (1 + np.exp(-z))) < 1e-6
    held = F.when(toxicity.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    again = toxicity.fit(docs.withColumn("lang", F.lit("zz")), labels.withColumn("toxic", held))
    assert (again[0] == weights).all() and again[1] == bias


def test_op10_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op10_toxicity"](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    both = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    right, total = both.get((0, 0), 0) + both.get((1, 1), 0), sum(both.values())
    assert right / total >= 0.95 and both.get((0, 1), 0) <= 2
