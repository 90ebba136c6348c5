"""Parts of the operators that the queries don't show."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vintora.llm import bpe, components, jaccard, licenses, neighbours, secrets, tokenfile
from vintora.llm.queries import vocabulary


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBpe(vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


def test_encoding_equals_the_library(coder, library):
    rnd = random.Random(1)
    parts = ["'s", "!'s", "  ", "\t", "\n", "<|endoftext|>", "<|endof", "é", "你好", "🙂", "a", " the", "12", "\x1c", " ", "'", "ll", "İ", "́", "՘"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    ids, at = coder.encode(texts)
    for k, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[k] : at[k + 1]].tolist() == e.ids
    assert coder.decode(ids, at) == texts


def test_forced_boundaries_are_never_inside_a_token(coder):
    for a, b in zip(coder.token_start[:5000], coder.token_start[1:5001]):
        t = coder.token_bytes[a:b]
        assert not coder.forced[t[:-1], t[1:]].any()


@settings(max_examples=50, deadline=None)
@given(text=st.text(alphabet="ab ,.\n1é", max_size=400), most=st.integers(5, 50))
def test_safe_pieces_keep_the_token_count(library, text, most):
    pieces = bpe.safe_pieces(text, most)
    assert "".join(pieces) == text
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    assert sum(map(count, pieces)) == count(text)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=400), st.integers(0, 400), st.integers(0, 60))
def test_shards_round_trip(ids, start, count):
    blob = tokenfile.compress(np.array(ids, np.uint32), 10, least=2 + count % 2)
    assert tokenfile.expand(blob).tolist() == ids
    start = min(start, len(ids))
    assert tokenfile.expand_range(blob, start, count).tolist() == ids[start : start + count]


def test_no_pair_is_left_that_pays(spark):
    """Of real ids: no pair stands at LEAST places that don't overlap, and the blob is smaller than 16-bit ids."""
    from collections import Counter

    model = tokenfile.WordEncoder(vocabulary("word_bpe_49k.json"))
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(400).collect()]
    ids, _ = model.encode(texts)
    blob = tokenfile.compress(ids, model.base)
    assert (tokenfile.expand(blob) == ids).all() and len(blob) < 2 * len(ids)
    base, left, right, size, seq, tokens = tokenfile._parts(blob)
    counts, last = Counter(), {}
    for k, pair in enumerate(zip(seq.tolist(), seq[1:].tolist())):
        if last.get(pair, -2) < k - 1:
            counts[pair] += 1
            last[pair] = k
    left_over = [n for n in counts.values() if n >= 2 * tokenfile.LEAST]
    assert not left_over  # beyond that, only pairs that overlap more frequent ones may stay
    assert len(set(zip(left.tolist(), right.tolist()))) >= 0.99 * len(left)


def test_long_runs_take_few_rounds():
    ids = np.zeros(100_000, np.uint32)
    blob = tokenfile.compress(ids, 5)
    assert len(blob) < 400 and (tokenfile.expand(blob) == ids).all()


def test_documents_are_looked_up(spark, tmp_path):
    model = tokenfile.WordEncoder(vocabulary("word_bpe_49k.json"))
    texts = [(k % 300, f"document {k} says {k * k} and more of the same") for k in range(320)] + [(None, "no id"), (None, None), (7, "document 7 again"), (400, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("blob", F.lit("clash"))
    path = str(tmp_path / "shards")
    tokenfile.write_shards(docs, path, vocabulary("word_bpe_49k.json"), shard_tokens=200)
    shards = spark.read.parquet(path)
    wanted = spark.createDataFrame([(3,), (7,), (7,), (299,), (400,), (999,), (None,)], "doc_id int")
    got = sorted((r.doc_id, r.token_ids) for r in tokenfile.lookup(shards, wanted).collect())
    want = sorted((i, [*model.model.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in texts if i in (3, 7, 299, 400))
    assert got == want and shards.count() > 5
    rows = tokenfile.read_documents(shards).collect()
    assert len(rows) == len(texts) and sum(r.doc_id is None for r in rows) == 2


def test_word_encoder_equals_the_library():
    rnd = random.Random(2)
    model = tokenfile.WordEncoder(vocabulary("word_bpe_49k.json"))
    parts = ["'s", "!'s", "  ", "\t", "\n", "<|endoftext|>", "é", "é", "你好", "🙂", "a", "THE", " the", "12", "\x1c", " ", "İ", "ΑΣ", "\r", ".", ",", "...", "the,", "a."]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    ids, n = model.encode(texts)
    at = np.concatenate([[0], np.cumsum(n)])
    for k, e in enumerate(model.model.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[k] : at[k + 1]].tolist() == [*e.ids, 1]


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(0, 200)]
    star = [(1000, k) for k in range(1001, 1300)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame([*chain, *star, (5000, 5001)], "u long, v long")).collect()}
    assert all(got[k] == 0 for k in range(201)) and all(got[k] == 1000 for k in range(1000, 1300)) and got[5001] == 5000


def test_prefixes_under_any_order_meet():
    rnd = np.random.default_rng(3)
    ranks = rnd.integers(0, 5, 1 << jaccard.TABLE_BITS).astype(np.uint8)
    for _ in range(200):
        a = np.unique(rnd.integers(0, 1 << 63, 60).astype(np.uint64))
        b = np.unique(np.concatenate([a[rnd.permutation(len(a))[: int(0.9 * len(a))]], rnd.integers(0, 1 << 63, 2).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            for k in range(jaccard.ORDERS):
                assert len(np.intersect1d(jaccard.in_order(a, ranks, k), jaccard.in_order(b, ranks, k)))


def test_large_groups_of_near_copies(spark):
    """Groups beyond the seldom bound take the block path; the components stay exact."""
    from tests.llm.test_queries import jaccard_truth

    rnd = random.Random(7)
    texts = {}
    for g in range(3):
        base = [f"g{g}w{k}" for k in range(170)]
        for c in range(60):
            own = [*base]
            for _ in range(rnd.randint(0, 4)):
                own[rnd.randrange(170)] = f"x{rnd.random()}"
            texts[1000 * g + c] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_documents(docs).collect()}
    assert got == jaccard_truth(texts)


@pytest.mark.parametrize("own", [3, 12, 14, 18])
def test_form_letters(spark, own):
    """Letters of one form, in numbers beyond a block: those that share too little never meet, the others are exact."""
    texts = {k: " ".join([f"t{j}" for j in range(90)] + [f"{f'q{k // 2}' if own == 18 and k % 4 < 2 else f'o{k}'}x{j}" for j in range(own)] + (["end"] if k % 2 else [])) for k in range(1300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.join_documents(docs).collect()}
    sets = {k: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for k, w in ((k, t.split()) for k, t in texts.items())}
    similar = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    if similar(1, 3):
        assert set(got.values()) == {0}
    else:
        pairs = {k: k - 1 for k in texts if k % 2 and similar(k - 1, k)}
        assert got == {k: pairs.get(k, k) for k in texts}
        assert (len(pairs) > 0) == (own == 18)


def test_random_families_of_copies(spark):
    """Families whose members keep 0.7 to 0.95 of a stem, beyond a block and of several sizes, against brute force."""
    from tests.llm.test_queries import jaccard_truth

    rnd = random.Random(23)
    texts = {}
    for family in range(4):
        stem = [f"f{family}w{k}" for k in range(rnd.choice((60, 90, 140)))]
        for c in range(170):
            cut = rnd.randint(0, len(stem) // 5)
            own = [f"p{rnd.randrange(6)}" for _ in range(rnd.randint(0, 12))]
            texts[len(texts)] = " ".join([*stem[cut:], *own] if c % 2 else [*own, *stem[: len(stem) - cut]])
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, token string").repartition(3)
    before, jaccard.BLOCK_NODES = jaccard.BLOCK_NODES, 50
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_documents(docs).collect()}
    finally:
        jaccard.BLOCK_NODES = before
    assert got == jaccard_truth(texts)


def test_repeated_and_nameless_rows(spark):
    """Repeated rows of one id, null ids and columns with the operators' own names, through each operator on documents."""
    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(1, text), (1, text), (1, "another text of this id"), (None, text), (None, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("n", "node", "words", "at", "hash", "item", "score", "tokens", "token_ids", "decoded", "base_spans", "secret_spans", "role", "chunk", "toxic", "fold", "row_id", "n_tokens", "n_bytes", "lanes", "m", "part", "row")})
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (None, 1, 1), (2, 0, None)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    bench = spark.createDataFrame([(None, text), (5, text), (5, text)], "item_id long, text string").withColumns({"item": F.lit(1), "words": F.lit("clash")})
    from vintora.llm import decontaminate, lm_score, toxicity

    assert sorted((r.doc_id is None, r.component_id) for r in jaccard.join_documents(docs).collect() if r.n_shingles == 9) == [(False, 1), (False, 1), (True, 1)]
    found = {r.doc_id: (r.n_items, r.item_ids, r.overlap) for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == {1: (2, "5,null", 13), None: (2, "5,null", 13)}
    assert lm_score.score(docs, labels.where("quality = 1")).count() == 6
    assert toxicity.score(docs, toxicity.fit(docs, labels)).count() == 6
    assert bpe.count_documents(docs.select("doc_id", "text"), vocabulary("byte_bpe_50k.json")).count() == 6
    assert secrets.find(docs, secrets.train(secrets.labelled_samples(docs))).count() == 6
    assert licenses.scan(docs, licenses.template_positions(spark)).count() == 6
    assert bpe.decode_documents(bpe.encode_documents(docs, vocabulary("byte_bpe_50k.json")), vocabulary("byte_bpe_50k.json")).where("decoded = coalesce(text, '')").count() == 6


def test_a_long_item_is_found_whole(spark):
    from vintora.llm import decontaminate

    rnd = random.Random(3)
    item = [f"w{rnd.randrange(3000)}" for _ in range(20_000)]
    docs = [(1, "before " + " ".join(item) + " after"), (2, " ".join(item[700:760])), (3, "Yes, it is."), (4, "no yes it is"), (5, "p1 X p3 p4 p5 p6 Y p8 p9 p10"), (6, "p1 X p3 p4 Z p6 Y p8 p9 p10"), (7, "a " * 3000)]
    bench = [(10, " ".join(item)), (11, "yes it is"), (12, " ".join(f"p{k}" for k in range(1, 11))), (13, "a " * 200), (14, ""), (15, None)]
    got = {(r.doc_id, r.item_id): r.overlap for r in decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert got == {(1, 10): 20_000, (2, 10): 60, (3, 11): 3, (5, 12): 5, (7, 13): 200}


def test_many_seeds_are_shuffled(spark):
    """Beyond the bounds of broadcasts the joins shuffle, with the same result."""
    from vintora.llm import decontaminate

    rnd = random.Random(8)
    items = [(k, " ".join(f"w{rnd.randrange(400)}" for _ in range(30))) for k in range(40)]
    docs = spark.createDataFrame([(k, " ".join(f"w{rnd.randrange(400)}" for _ in range(20)) + " " + items[k % 40][1]) for k in range(120)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    first = sorted(map(tuple, decontaminate.overlaps(docs, bench).collect()))
    seeds, size = decontaminate.BROADCAST_SEEDS, decontaminate.BROADCAST_BYTES
    decontaminate.BROADCAST_SEEDS = decontaminate.BROADCAST_BYTES = 0
    try:
        second = decontaminate.overlaps(docs, bench)
        assert sorted(map(tuple, second.collect())) == first and len(first) >= 120
    finally:
        decontaminate.BROADCAST_SEEDS, decontaminate.BROADCAST_BYTES = seeds, size


def test_secret_spans_that_overlap_stay(spark):
    model = secrets.train(secrets.default_samples(spark))
    rows = [(0, "key 9Xk2Lm0123456789abcdef0aQw7Zr7Lk2Xw9Vb4Nn6Ts1Yd3 end"), (1, "short q8Zr7Lk2Xw9Vb4Nn6T end")]
    out = {r.doc_id: r.text for r in secrets.redact(secrets.find(spark.createDataFrame(rows, "doc_id int, text string"), model)).collect()}
    assert out == {0: "key [SECRET] end", 1: "short [SECRET] end"}


def test_secret_models(spark):
    model = secrets.train(secrets.labelled_samples(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))
    rows = [(0, "value 9f8Kq2LmZx7TbR4wYc1Vn6Hd end"), (1, "the configurationManagerFactory and authentication_service_provider are names"), (2, "thanedbleinghethorntionedshathwhere incomprehensibilities"), (3, "-" * 60 + " " + "=" * 30 + "x" * 5000)]
    found = {r.doc_id: r.s for r in secrets.find(spark.createDataFrame(rows, "doc_id int, text string"), model).select("doc_id", secrets.shown("secret_spans").alias("s")).collect()}
    assert found[0].startswith("markov:6:") and found[1] == found[2] == found[3] == ""
    level = secrets.train(spark.createDataFrame([("abc", 1)], "text string, label int"))
    assert set(level) == {0.0}


def test_planted_secrets_are_found_and_ordinary_words_are_not(spark):
    """Recall by kind and length, false alarms over whole documents and over identifiers of words the samples lack."""
    import string

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model, rnd = secrets.train(secrets.labelled_samples(docs)), random.Random(3)
    kinds = {"mixed": string.ascii_letters + string.digits + "+/", "lower": string.ascii_lowercase, "digits": string.ascii_lowercase + string.digits}
    rows = [(k, n, "".join(rnd.choice(a) for _ in range(n))) for k, a in kinds.items() for n in (12, 16, 24, 32) for _ in range(300)]
    added = F.size(F.filter("secret_spans", lambda x: x["kind"] == 3)) > 0
    found = secrets.find(spark.createDataFrame(rows, "k string, n int, text string"), model)
    recall = {(r.k, r.n): r.share for r in found.groupBy("k", "n").agg(F.avg(added.cast("int")).alias("share")).collect()}
    assert all(x >= (0.5, 0.75, 0.9, 0.95)[(12, 16, 24, 32).index(n)] for (_, n), x in recall.items()), recall
    words = ["getElementsByClassName", "AbstractSingletonProxyFactoryBean", "unbelievable_circumstances", "Donaudampfschiffahrtsgesellschaft", "the/path/to/some_file-name", "2024-11-05", "================", "internationalization"]
    assert secrets.find(spark.createDataFrame([(w,) for w in words], "text string"), model).where(added).count() == 0
    assert secrets.find(docs, model).where(added).count() <= 5  # of 10,000 documents


def test_redaction(spark):
    rows = [("a token = 'abcdefabcdefabcdef12' b",), (None,), ("",), ("clean",)]
    out = secrets.redact(secrets.find(spark.createDataFrame(rows, "text string"), [0.0] * (len(secrets.ALPHABET) + 1) ** 2)).collect()
    assert [r.text for r in out] == ["a [SECRET]' b", None, "", "clean"]


def test_license_templates_survive_edits(spark):
    text = "Permission is hereby freely granted, free of charge, to any person obtaining one copy of this software and associated documentation files"
    got = licenses.scan(spark.createDataFrame([(1, text), (2, "nothing of that kind"), (1, text)], "doc_id int, text string"), licenses.template_positions(spark)).collect()
    assert len(got) == 3 and [r.labels for r in sorted(got, key=lambda r: r.doc_id)] == ["mit", "mit", ""]


def test_neighbours_leave_bad_vectors_out(spark):
    rnd = np.random.default_rng(1)
    good = [(k, [float(x) for x in rnd.standard_normal(8)]) for k in range(40)]
    bad = [(100, None), (101, [0.0] * 8), (102, [float("nan")] * 8), (103, [1.0, None] * 4), (104, []), (105, [float("inf")] + [0.0] * 7), (106, [1.0] * 3), (None, [1.0] * 8)]
    rows = spark.createDataFrame([*good, *bad, good[3]], "vec_id long, embedding array<double>")
    got = neighbours.search(rows, rows.where("vec_id % 20 = 0"), 60).collect()
    assert {r.query_id for r in got} == {0, 20}
    assert {r.vec_id for r in got} <= set(range(40))
    assert len([r for r in got if r.query_id == 0]) == 40  # 39 others, one of them twice


def test_finite_vectors_of_any_size_take_part(spark):
    rows = [(0, [1.0, 0.5]), (1, [1e-170, 0.0]), (2, [1e200, 0.0]), (3, [-1e200, 1e-300]), (4, [5e-324, 0.0]), (5, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"dimension": F.lit("clash"), "block": F.lit(1), "vector": F.lit(None).cast("string")})
    got = {(r.query_id, r.vec_id): (r["rank"], r.score) for r in neighbours.search(df, df.where("vec_id < 2"), 20).collect()}
    assert [got[0, k] for k in (2, 1, 4, 3)] == [(1, 1e200), (2, 1e-170), (3, 5e-324), (4, -1e200)]
    assert {v for q, v in got if q == 1} == {0, 2, 3, 4}


def test_recall_over_blocks_that_set_nothing(spark):
    """Clustered and plain vectors of other sizes than the settings were chosen on, in several blocks."""
    rnd = np.random.default_rng(9)
    centres = rnd.standard_normal((40, 24))
    data = np.concatenate([centres[rnd.integers(0, 40, 3000)] + 0.3 * rnd.standard_normal((3000, 24)), rnd.standard_normal((2000, 24)) * rnd.uniform(0.2, 3, (2000, 1))])
    before, neighbours.BLOCK = neighbours.BLOCK, 1100
    try:
        df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(data)], "vec_id long, embedding array<double>").repartition(4)
        got = neighbours.search(df, df.where("vec_id % 50 = 0"), 20).collect()
    finally:
        neighbours.BLOCK = before
    hits = 0
    for q in range(0, 5000, 50):
        score = data @ data[q]
        score[q] = -np.inf
        truth = set(np.argsort(-score)[:20].tolist())
        mine = [r for r in got if r.query_id == q]
        assert sorted(r["rank"] for r in mine) == list(range(1, 21))
        hits += len({r.vec_id for r in mine} & truth)
    assert hits >= 0.9 * 20 * 100


def test_equal_vectors_have_equal_scores(spark):
    """Copies of one vector lie among others; their scores are one number, and ties go to the smaller ids."""
    rnd = np.random.default_rng(4)
    same = [float(x) for x in rnd.standard_normal(33)]
    rows = [(k, same if k % 3 else [0.1 * float(x) for x in rnd.standard_normal(33)]) for k in range(200)] + [(0, same)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r.rank, r.vec_id, r.score) for r in neighbours.search(df, spark.createDataFrame([(0, same)], "vec_id long, embedding array<double>"), 20).collect())
    assert [r[1] for r in got] == [k for k in range(1, 60) if k % 3][:20] and len({r[2] for r in got}) == 1


def test_counts_beyond_32_bits(spark):
    """Blocks of many tasks add up without a ceiling."""
    from vintora.llm import tables

    part = np.zeros(tables.BLOCK + 5, np.int64)
    part[3], part[tables.BLOCK + 4] = 3_000_000_000, 7
    rows = spark.createDataFrame([(k, p, bytearray(c)) for p in range(3) for k, p, c in tables.blocks(part, p)], tables.SCHEMA)
    total = tables.summed(rows, len(part))
    assert int(total[3]) == 9_000_000_000 and int(total[-1]) == 21 and len(total) == len(part) and np.count_nonzero(total) == 2


def test_lm_scores_count_real_words(spark):
    """More distinct words and bigrams than any fixed table holds: losses equal those from counts of the words."""
    from collections import Counter

    from vintora.llm import lm_score

    rnd = random.Random(11)
    common = [f"c{k}" for k in range(50)]
    texts = {i: " ".join(rnd.choice(common) if k % 4 == 0 else f"w{rnd.randrange(2_000_000)}" for k in range(300)) for i in range(1500)}
    texts |= {5000: None, 5001: "", 5002: texts[3], 5003: "once"}
    good = {i for i in texts if i % 3 == 0}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    chosen = spark.createDataFrame([(i,) for i in good], "doc_id long")
    held = {i: (t or "").split() for i, t in texts.items()}
    models = []
    for ids in (good, set(texts)):
        words, before, pairs = (Counter(x for i in ids for x in f(held[i])) for f in (list, lambda w: [None, *w[:-1]] if w else [], lambda w: list(zip([None, *w], w))))
        models.append((words, before, pairs))
    size = max(2**lm_score.WORD_BITS, len(models[1][0]))
    assert size > 2**lm_score.WORD_BITS

    tokens = sum(models[0][0].values())

    def loss(model, w):
        words, before, pairs = model
        f = tokens / sum(words.values())  # the background rests on as many tokens as the target
        total = f * sum(words.values()) + size
        return -np.mean([np.log((f * pairs[a, b] + lm_score.PRIOR * (f * words[b] + 1) / total) / (f * before[a] + lm_score.PRIOR)) for a, b in zip([None, *w], w)]) if w else 0.0

    truth = {i: [loss(m, held[i]) for m in models] for i in list(texts)[::25] + [5000, 5001, 5002, 5003]}
    got = {r.doc_id: r for r in lm_score.score(docs, chosen).collect()}
    assert set(got) == set(texts)
    for i, (target, background) in truth.items():
        assert got[i].n_tokens == len(held[i])
        assert abs(got[i].target_loss - target) < 1e-9 and abs(got[i].background_loss - background) < 1e-9
        assert abs(got[i].score - (target - background)) < 1e-9
    apart = {r.doc_id: r.score for r in lm_score.score(docs.where("doc_id < 40 OR doc_id >= 5000"), chosen, docs).collect()}
    assert set(apart) == {i for i in texts if i < 40 or i >= 5000}
    assert all(abs(apart[i] - got[i].score) < 1e-12 for i in apart)


def test_lm_probabilities_sum_to_one():
    """After any word, over the whole vocabulary, in both models."""
    from vintora.llm import lm_score

    rnd = np.random.default_rng(5)
    pairs = rnd.poisson(0.4, (2, 30, 30)) + np.array([0, 1])[:, None, None]  # of target and background
    word = pairs.sum(1)
    totals = word.sum(1).astype(float)
    for a in range(30):
        p = lm_score.probability(pairs[:, a], np.repeat(pairs[:, a].sum(1)[:, None], 30, 1), word, totals, 30)
        assert np.allclose(p.sum(1), 1) and (p > 0).all()


def test_substituted_items_are_found(spark):
    """Whole items of which at least 0.8 of the words are left, planted in other words; nothing else is found."""
    from vintora.llm import decontaminate

    rnd = random.Random(13)
    items, docs, planted = [], [], {}
    for size in range(15, 25):
        for c in range(8):
            item = [f"i{len(items)}x{k}" for k in range(size)]
            items.append((len(items), " ".join(item)))
            for n in range(1, 5):
                own = [*item]
                for k in rnd.sample(range(size), n):
                    own[k] = f"s{rnd.random()}".replace(".", "")
                if 10 * (size - n) >= 8 * size:
                    equal = [a == b for a, b in zip(own, item)]
                    seeded = any(all(equal[k + j] for j in m) for m in decontaminate.MASKS for k in range(size - decontaminate.SPAN + 1))
                    planted[len(docs)] = (items[-1][0], n, seeded)
                    docs.append((len(docs), " ".join([f"f{k}" for k in range(40)] + own + [f"g{k}" for k in range(40)])))
    poor = [w if k % 3 else f"z{k}" for k, w in enumerate(items[-1][1].split())]
    docs.append((9999, " ".join(poor)))
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    truth = {(d, i) for d, (i, _, _) in planted.items()}
    assert got <= truth
    assert {(d, i) for d, (i, _, seeded) in planted.items() if seeded} <= got  # verification throws none away
    recall = {n: np.mean([(d, i) in got for d, (i, m, _) in planted.items() if m == n]) for n in range(1, 5)}
    print("recall by substitutions", recall)
    assert recall[1] == 1 and recall[2] >= 0.95 and recall[3] >= 0.8
