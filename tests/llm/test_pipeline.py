"""The pipeline's stages against decisions worked out apart from them."""

import tracemalloc

import numpy as np

import corpus_pipeline
from tests.llm.test_queries import PATTERNS, jaccard_truth, overlap_truth, toxic_bins
from vintora.llm import toxicity
from vintora.llm._io import trim_driver

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark, small):
    from vintora.llm import toxicity

    docs = spark.read.parquet(f"{small}/documents.parquet").select(*COLUMNS)
    bench = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        if name == "toxicity":
            weights, bias = toxicity.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
            keep = {i for i, t in before.items() if float(weights[sorted(toxic_bins(t))].sum(dtype="float64")) + bias < 0}
        elif name == "n-gram Jaccard join":
            # texts without words are near duplicates of nothing
            keep = {i for i, (_, c) in jaccard_truth(before).items() if i == c}
        elif name == "benchmark decontamination":
            keep = {i for i, t in before.items() if all(overlap_truth(t, b) is None for b in bench)}
        else:
            keep = set(before)
        out = stage(spark, docs, small)
        if (name, stage) != corpus_pipeline.STAGES[-1]:
            assert out.columns == COLUMNS
        rows = out.collect()
        assert sorted(r.doc_id for r in rows) == sorted(keep), name
        if name == "secret scans":
            for r in rows:
                assert not any(len(m[g]) >= n for p, g, n in PATTERNS for m in p.finditer(r.text or ""))
                if not any(len(m[g]) >= n for p, g, n in PATTERNS for m in p.finditer(before[r.doc_id] or "")) and r.doc_id != 10_016:
                    assert r.text == before[r.doc_id]
        seen[name] = len(rows)
        docs = out
    assert all(r.round_trip for r in docs.select("round_trip").collect())
    assert seen["n-gram Jaccard join"] < seen["toxicity"]


def test_toxic_documents_go_and_clean_ones_stay(spark, tmp_path):
    """Words that only toxic documents hold, in texts that carry no label."""
    words = [f"plain{k}" for k in range(60)]
    text = lambda k, bad: " ".join([*(words[(k * 7 + j * j) % 60] for j in range(25)), *(["vilest", "scumword"] if bad else [])])
    docs = spark.createDataFrame([(k, text(k, k % 4 == 0)) for k in range(400)], "doc_id long, text string")
    spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(200)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.keep_civil(spark, docs, str(tmp_path)).collect()}
    assert kept == {k for k in range(400) if k % 4}


ROWS = [(1, "T"), (2, "T"), (2, "U"), (None, "T"), (None, "V"), (3, None), (3, None), (None, " ")]
LONG = {"T": "the first text says one thing to everybody", "U": "a second text says quite another thing", "V": "a third one has no name at all here"}


def test_no_text_is_lost_for_anothers_id(spark, small):
    docs = spark.createDataFrame([(i, LONG.get(t, t), "x") for i, t in ROWS], "doc_id long, text string, row string").withColumnRenamed("row", "text_hash")
    names = {v: k for k, v in LONG.items()}
    out = corpus_pipeline.keep_one_of_each(spark, docs, small)
    assert out.columns == docs.columns
    got = sorted((r.doc_id or 0, names.get(r.text, r.text) or "") for r in out.collect())
    assert got == [(0, " "), (0, "V"), (1, "T"), (2, "U"), (3, ""), (3, "")]


def test_contaminated_rows_go_whatever_their_id(spark, tmp_path):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    spark.createDataFrame([(1, item), (None, "an item without an id that is long enough to be found by all the masks")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"see {item} here"), (1, "a clean text under the same id"), (None, item), (None, "clean and nameless"), (2, None), (3, "well an item without an id that is long enough to be found by all the masks")]
    out = corpus_pipeline.keep_uncontaminated(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path))
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [(0, "clean and nameless"), (1, "a clean text under the same id"), (2, "")]


def test_secrets_are_masked_whole(spark, small):
    rows = [(1, "key 9Xk2Lm0123456789abcdef0aQw7Zr7Lk2Xw9Vb4Nn6Ts1Yd3 end", 1), (1, None, 2), (None, "plain words alone", 3)]
    out = corpus_pipeline.redact_secrets(spark, spark.createDataFrame(rows, "doc_id long, text string, secret_spans int"), small)
    assert sorted((r.secret_spans, r.text) for r in out.collect()) == [(1, "key [SECRET] end"), (2, None), (3, "plain words alone")]


def test_repeated_rows_stay_once(spark, small):
    docs = spark.createDataFrame([(1, "some words that repeat in both rows"), (1, "some words that repeat in both rows"), (2, "others"), (None, "no name")], "doc_id long, text string")
    out = corpus_pipeline.keep_one_of_each(spark, docs, small)
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "no name"), (1, "some words that repeat in both rows"), (2, "others")]


def test_run_without_documents(spark, void):
    assert corpus_pipeline.run(spark, void).count() == 0


def test_rows_that_go_are_sent_not_those_that_stay(spark, tmp_path, monkeypatch):
    words = [" ".join(f"w{k}x{j}" for j in range(12)) for k in range(300)]
    rows = [(k, t) for k, t in enumerate(words)] + [(1000 + k, words[k].upper()) for k in range(7)] + [(None, words[9]), (2000, None), (2001, " \t"), (2001, " \t")]
    sent, stored = [], corpus_pipeline.stored

    def seen(df, name, **options):
        out = stored(df, name, **options)
        sent.append((name, out.count()))
        return out

    monkeypatch.setattr(corpus_pipeline, "stored", seen)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.keep_one_of_each(spark, docs, str(tmp_path)).collect()]
    assert sorted(kept, key=str) == sorted([*enumerate(words), (2000, None), (2001, " \t"), (2001, " \t")], key=str)
    assert [n for name, n in sent if name == "rows"] == [8]


def test_fit_holds_little_beside_its_sample():
    rng = np.random.default_rng(3)
    size = 1 << toxicity.BITS
    rows = [(k % 2, 0, np.arange(k % 64, size, 64, dtype="<i4")) for k in range(2000)] + [(1, 0, np.zeros(0, "<i4"))]
    tracemalloc.start()
    try:
        model = toxicity.Linear(rows, rng.normal(0, 1, size), 0.0, 1.0, 2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.isfinite(model.bias) and np.count_nonzero(model.weights) > size // 2
    assert peak < 3 * sum(r[2].nbytes for r in rows)


def test_runs_of_a_fit_change_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    ratio = rng.normal(0, 1, 1 << toxicity.BITS)
    rows = [(k % 2, 0, np.unique(rng.integers(0, 1000, rng.integers(0, 60))).astype("<i4")) for k in range(200)]
    whole = toxicity.Linear(rows, ratio, 0.3, 1.0, 50)
    monkeypatch.setattr(toxicity, "RUN", 70)
    parts = toxicity.Linear(rows, ratio, 0.3, 1.0, 50)
    assert np.allclose(whole.weights, parts.weights, atol=1e-9) and abs(whole.bias - parts.bias) < 1e-9
    assert not toxicity.Linear([], ratio, 0.3, 1.0, 2).weights.any()


def test_driver_gives_native_memory_back(spark):
    assert trim_driver(spark)
