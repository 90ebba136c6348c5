"""Secret scan: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Built-in functions only. Two bigram models, of random strings and of ordinary identifiers, are trained from
labelled samples, every bigram counted as often as it occurs: a table of rule-made strings (default_samples, or one of
the user's own), and all runs of the corpus, whatever its size (values that the fixed patterns find are random, all
other runs ordinary; a secret that no pattern knows is one run among all those of the corpus, so it hardly counts). A run
of key characters is a secret too if its log-likelihood ratio is at least LEVEL in all and THRESHOLD for each bigram.
Every run takes part, of whatever kind and length; those too short to reach LEVEL with the model's largest ratio are left
out by the pattern already.

Spans are in code points, end exclusive. A run that overlaps spans of the patterns stays a span of its own, unless it
lies within one. Odd input: a null text counts as empty and has no spans; repeated rows are scanned one by one; extra
columns are kept; an empty table gives an empty result; without samples of both kinds the models are level and add no
spans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
#: pattern, group whose length counts, least length of that group
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12)
ACCESS = (r"AKIA[A-Z0-9]+", 0, 18)
HEX = (r"[0-9a-f]+", 0, 16)

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: The same as a class of characters in patterns.
RUN = "A-Za-z0-9+/_=-"
#: Log-likelihood ratio from which a run counts as random, in all and for each of its bigrams.
LEVEL, THRESHOLD = 12.0, 0.6
#: Weight of even transitions in both models; it bounds what one unseen bigram can say.
EVEN = 0.1
#: Rows of each kind in the sample of default_samples.
SAMPLES = 4000

#: Parts of ordinary identifiers, in several languages.
PARTS = """account action address alert array average backend balance banner batch buffer button cache callback cancel
category channel character check child client cluster color column command comment common component config connection
container content context control controller counter country create current custom database default delete description
detail device dialog directory display document domain download element email enable encode engine entity entry error
event example execute export factory feature field file filter folder font format forward frame function gateway
generate global group handler header height history image import index information initialize input instance interface
internal invoice item iterator journal kernel keyboard label language layout length level library license limit list
listener loader local location login manager margin market master matrix member memory message method metric minimum
model module monitor name network node notification number object offset operation option order output package padding
page panel parameter parent parser partition path pattern payment percent performance permission person picture pipeline
platform player point policy position prefix preview price primary print process product profile program project
property provider query queue random range record reference region register release remote render report request
resource response result return revision router sample schedule schema score screen script search section select
sender sequence server service session setting shadow share signal simple socket source stack standard state statistic
status storage stream string style subject submit suffix summary support switch symbol system table target task
template temporary terminal text theme thread ticket timeout timer title toggle toolbar total transaction transfer
transform translate trigger type unique update upload user utility validate value variable vector vendor version view
virtual visible volume warning widget width window worker wrapper writer
gesellschaft verantwortung entwicklung beziehung geschichte wissenschaft bereich einheit zeichen schreiben
informacion desarrollo conocimiento trabajo siempre nacional derecho cuestion historia servicio
developpement gouvernement connaissance entreprise naturelle questionnaire quelquefois aujourdhui mouvement maintenant"""


def default_samples(spark: SparkSession, n: int = SAMPLES) -> DataFrame:
    """text, label (1: random string, 0: ordinary identifier): n rows of each, by a rule.

    Random ones are SHA-256 digests of numbers, in hexadecimal, in both base64 alphabets, and in small letters alone;
    ordinary ones are names of one to three words in several spellings, ruled lines, and characters in alphabetical order.
    """
    words = F.split(F.lit(" ".join(PARTS.split())), " ")
    rows = spark.range(n)
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    packed = F.base64(F.unhex(digest))
    letters = F.translate(F.lower(packed), "0123456789+/=", "bcdfghjkpqvwx")
    kind = F.col("id") % 4
    random = rows.select(F.when(kind == 0, F.substring(digest, 1, 40)).when(kind == 1, F.substring(packed, 1, 40)).when(kind == 2, F.substring(letters, 1, 40)).otherwise(F.translate(F.substring(packed, 1, 36), "+/", "-_")).alias("text"), F.lit(1).alias("label"))
    pick = lambda a, b: words[F.pmod(F.col("id") * a + b, F.size(words)).cast("int")]
    three = (pick(7, 1), pick(131, 17), pick(577, 53))
    ordinary = rows.select(F.when(F.col("id") % 3 == 0, F.concat_ws("_", *three)).when(F.col("id") % 3 == 1, F.concat(three[0], F.initcap(three[1]), F.initcap(three[2]))).when(F.col("id") % 6 == 2, F.concat_ws("-", *three, (F.col("id") % 40).cast("string"))).otherwise(F.concat(*three)).alias("text"), F.lit(0).alias("label"))
    ruled = rows.where(F.col("id") % 10 == 0).select(F.repeat(F.substring(F.lit(ALPHABET), (F.col("id") / 10 % len(ALPHABET)).cast("int") + 1, F.lit(1)), F.lit(40)).alias("text"), F.lit(0).alias("label"))
    ordered = rows.where(F.col("id") % 10 == 1).select(F.substring(F.lit(ALPHABET), (F.col("id") / 10 % (len(ALPHABET) - 8)).cast("int") + 1, F.lit(20)).alias("text"), F.lit(0).alias("label"))
    return random.unionByName(ordinary).unionByName(ruled).unionByName(ordered)


def _bigrams(s: Column) -> Column:
    """Bigrams of a string as numbers, in order; characters outside the alphabet share one symbol. Linear in length."""
    k = len(ALPHABET) + 1
    codes_of = F.array(*(F.lit(ALPHABET.index(chr(c)) if chr(c) in ALPHABET else k - 1) for c in range(128)))
    codes = F.transform(F.split(s, ""), lambda c: F.coalesce(F.get(codes_of, F.ascii(c)), F.lit(k - 1)))
    n = F.greatest(F.size(codes) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, 1, n), F.slice(codes, 2, n), lambda a, b: a * k + b)


def corpus_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """text, label, weight: the distinct runs of all documents, and how often each occurs.

    What a fixed pattern finds in a run is random (1); every other run is ordinary (0). Runs are counted before the
    exchange, and only distinct ones are looked at.
    """
    runs = docs.select(F.explode(F.split(F.coalesce(F.col(text), F.lit("")), f"[^{RUN}]+")).alias("text")).where("length(text) > 1").groupBy("text").agg(F.count("*").alias("weight"))
    values = [F.regexp_extract("text", p, g) for p, g in (ASSIGN[:2], (f"AKIA[A-Z0-9]{{{ACCESS[2] - 4},}}", 0), (f"[0-9a-f]{{{HEX[2]},}}", 0))]
    found = F.coalesce(*(F.when(F.length(v) >= n, v) for v, n in zip(values, (ASSIGN[2], 1, 1))))
    return runs.select(F.coalesce(found, "text").alias("text"), found.isNotNull().cast("int").alias("label"), "weight")


def labelled_samples(docs: DataFrame) -> DataFrame:
    """default_samples and corpus_samples together."""
    return default_samples(docs.sparkSession).withColumn("weight", F.lit(1)).unionByName(corpus_samples(docs))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each bigram of the alphabet (row by row).

    samples: text, label (1 or 0), and weight, 1 where there is no such column.
    """
    k = len(ALPHABET) + 1
    weight = F.col("weight") if "weight" in samples.columns else F.lit(1)
    texts = samples.where("text IS NOT NULL AND label IN (0, 1) AND length(text) > 1")
    pairs = texts.select("label", weight.alias("weight"), F.explode(_bigrams(F.col("text"))).alias("pair"))
    n = {(r[0], r[1] // k, r[1] % k): r[2] for r in pairs.groupBy("label", "pair").agg(F.sum("weight")).collect()}  # 2 k^2 rows at most
    rows = {(y, a): sum(n.get((y, a, b), 0) for b in range(k)) for y in (0, 1) for a in range(k)}
    if not all(any(rows[y, a] for a in range(k)) for y in (0, 1)):
        return [0.0] * (k * k)
    p = lambda y, a, b: math.log((1 - EVEN) * (n.get((y, a, b), 0) + 1) / (rows[y, a] + k) + EVEN / k)
    return [p(1, a, b) - p(0, a, b) for a in range(k) for b in range(k)]


SPAN = "struct<start:int,kind:int,end:int>"


def _spans(text: Column, kind: int, pattern: str, keep, counted: int = 0) -> Column:
    """Spans of the matches that `keep` accepts, leftmost non-overlapping. Matches come with the text between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("hit"), (F.regexp_extract_all(text, F.lit(pattern), F.lit(counted)) if counted else found).alias("value"))
    none = F.array().cast(f"array<{SPAN}>")

    def step(s: Column, m: Column) -> Column:
        start = s["at"] + F.length(m["gap"])
        end = start + F.length(m["hit"])
        new = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(keep(m["value"]), F.concat(s["spans"], new)).otherwise(s["spans"]).alias("spans"))

    walk = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda s: s["spans"])
    return F.when(F.size(found) > 0, walk).otherwise(none)


def looks_random(s: Column, model: list[float]) -> Column:
    """Whether the log-likelihood ratio of a string reaches LEVEL in all and THRESHOLD for each bigram."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    pairs = _bigrams(s)
    total = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + F.element_at(table, (p + 1).cast("int")))
    return (total >= LEVEL) & (total >= THRESHOLD * F.size(pairs))


def candidate_pattern(model: list[float]) -> str | None:
    """The pattern of the runs to be looked at; None if none can reach LEVEL. A run has no other right before it."""
    if (most := max(model)) < THRESHOLD:
        return None
    return rf"(?<![{RUN}])[{RUN}]{{{1 + math.ceil(LEVEL / most)},}}+"


def find(docs: DataFrame, model: list[float], text: str = "text") -> DataFrame:
    """docs with the columns base_spans and secret_spans (base and Markov): array<struct<start, kind, end>>, in order.

    kind is a place in KINDS. Columns of these names are replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    longer = lambda n: lambda v: F.length(v) >= n
    assign = _spans(t, 0, ASSIGN[0], longer(ASSIGN[2]), ASSIGN[1])
    access = _spans(t, 1, f"{ACCESS[0][:-1]}{{{ACCESS[2] - 4},}}", longer(ACCESS[2]))
    hexes = _spans(t, 2, f"{HEX[0][:-1]}{{{HEX[2]},}}", longer(HEX[2]))  # a run of hex digits is one match, so the bound may stand in the pattern
    pattern = candidate_pattern(model)
    runs = F.array().cast(f"array<{SPAN}>") if pattern is None else _spans(t, 3, pattern, lambda v: looks_random(v, model))
    out = docs.withColumn("base_spans", F.array_sort(F.concat(assign, access, hexes))).withColumn("_runs", runs)
    own = F.filter("_runs", lambda r: ~F.exists("base_spans", lambda b: (b["start"] <= r["start"]) & (r["end"] <= b["end"])))
    return out.withColumn("secret_spans", F.array_sort(F.concat("base_spans", own))).drop("_runs")


def shown(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", spans: str = "secret_spans", mask: str = "[SECRET]") -> DataFrame:
    """docs with each span of the text replaced by a mask; overlapping spans are replaced once."""
    t = F.col(text)
    step = lambda s, x: F.when(x["end"] <= s["at"], s).otherwise(F.struct(x["end"].alias("at"), F.concat(s["out"], F.when(x["start"] >= s["at"], F.concat(F.substring(t, s["at"] + 1, x["start"] - s["at"]), F.lit(mask))).otherwise(F.lit(""))).alias("out")))
    whole = F.aggregate(F.col(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(t, s["at"] + 1, F.length(t) - s["at"])))
    return docs.withColumn(text, F.when(F.size(spans) > 0, whole).otherwise(t))
