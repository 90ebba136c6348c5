"""The corpus pipeline: stages applied one after the other to documents.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the
columns of documents, and columns beyond those the stages read (doc_id, text) pass through whatever their names. A row is
named by its id and its text, so no row is dropped for what another row of the same id holds, and rows without an id
are treated like others. Texts are read whole, however long. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintora.llm import bpe, decontaminate, jaccard, secrets, toxicity
from vintora.llm._io import stored
from vintora.llm.queries import vocabulary

#: Rows are dropped by a broadcast of up to this many; beyond, dropping them shuffles.
BROADCAST_ROWS = 1_000_000


def _matching(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """docs semi- or anti-joined with rows by (doc_id, text_hash); null ids equal each other."""
    rows = stored(rows.select("doc_id", "text_hash").distinct(), "rows")
    rows = (F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows).alias("_r")
    text_hash = F.xxhash64(F.coalesce(F.col("_d.text"), F.lit("")))
    return docs.alias("_d").join(rows, F.col("_d.doc_id").eqNullSafe(F.col("_r.doc_id")) & (text_hash == F.col("_r.text_hash")), how)


def _apart(docs: DataFrame, step) -> DataFrame:
    """step over docs, whose columns but text have other names meanwhile, so that none clashes with the step's own."""
    names = {c: "text" if c == "text" else f"column_{k}" for k, c in enumerate(docs.columns)}
    out = step(docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())))
    return out.select(*(F.col(n).alias(c) for c, n in names.items()))


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled rows among them, doesn't reject.

    Every row is judged by its own text, so repeated rows go or stay together. Null and empty texts get the prior's score;
    without labelled rows of both classes nothing is rejected.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _apart(docs, lambda rows: toxicity.score(rows, model).where("score < 0.5"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: that of the smallest id, then of the smallest text hash.

    An id goes before none. Of rows that repeat id and text one stays. Texts without words (null, empty, blank) are
    near duplicates of nothing and stay, each row.
    """
    groups = stored(jaccard.groups(docs), "groups").where("component IS NOT NULL")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    best = groups.groupBy("component").agg(F.min(row).alias("best"), F.max(row).alias("last")).where("NOT best <=> last").drop("last")
    others = jaccard.spread_join(groups.withColumn("row", row), best, "component", F.col("doc_id")).where("NOT row <=> best")
    kept = _matching(docs, others, "left_anti")  # those that go are far fewer than those that stay
    repeated = groups.groupBy("doc_id", "text_hash").count().where("count > 1")
    if repeated.limit(1).count():  # only the rows that repeat are shuffled
        kept = _matching(kept, repeated, "left_anti").unionByName(_matching(kept, repeated, "left_semi").dropDuplicates(["doc_id", "text"]))
    return kept


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item. Rows that repeat id and text go or stay together."""
    return _matching(docs, decontaminate.overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked. Null texts stay null; repeated rows are masked alike."""
    model = secrets.train(secrets.labelled_samples(docs))
    return _apart(docs, lambda rows: secrets.redact(secrets.find(rows, model)))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids, and whether the ids decode to the text; a row for each row of docs.

    A null text counts as empty.
    """
    path = vocabulary("byte_bpe_50k.json")
    coded = bpe.decode_documents(bpe.encode_documents(docs, path), path)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", keep_civil),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", keep_uncontaminated),
    ("secret scans", redact_secrets),
    ("BPE encoding and decoding", tokenize),
]
#: SQL can't train the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
