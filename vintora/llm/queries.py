"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintora.llm import bpe, collocations, decontaminate, exact, jaccard, licenses, lm_score, neighbours, resample, secrets, tokenfile, toxicity
from vintora.llm._io import table
from vintora.llm.oracles import ORACLES  # noqa: F401


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_documents(table(spark, sf_dir, "documents"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or vocabulary("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode_documents(bpe.encode_documents(docs, path), path)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_shards(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), path or vocabulary("word_bpe_49k.json"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, secrets.train(secrets.labelled_samples(docs)))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.shown("base_spans"), 256).alias("base_sha256"), secrets.shown("secret_spans").alias("spans"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.template_positions(spark))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return lm_score.score(docs, good)


def op9_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.count_documents(docs, path or vocabulary("byte_bpe_50k.json")).drop("text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_jaccard_join, op2_bpe_round_trip, op3_decontaminate, op4_token_shards, op5_nearest, op6_secrets, op7_licenses, op8_lm_score, op9_token_counts, op10_toxicity, op11_collocations, op12_exact_dedup, op13_resample)}
