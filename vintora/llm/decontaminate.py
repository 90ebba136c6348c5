"""Benchmark decontamination by spaced-seed hashing, with built-in functions only.

Each mask looks at some of SPAN consecutive words and ignores the others, so a seed survives substitutions at
ignored places. Seeds of documents and test items, rows of (hash, place), are joined by hash. A hit names a
diagonal of a document and an item; each diagonal is then walked once, over all words that the item and the
document have on it, however long. It counts as overlap if the best-scoring stretch (+1 for an equal word, -2 for a
substituted one) reaches LEAST, or 0.8 of a shorter item, or if SHARE of the words are equal in any stretch of
LEAST words or more, or in the whole of a shorter item.

Items of SHORT to SPAN - 1 words are cut into one part more than the substitutions that leave 0.8 of them, so one
part is always intact; parts are sought as contiguous words. Items of 1 to SHORT - 1 words say nothing inside a
longer text: a document is contaminated by one only if it consists of the same words. Items without words match
nothing.

Odd input: null texts have no words; null ids, of documents or items, are ids like others; repeated rows are one
row (the same id and text), rows of one id with different texts are told apart; extra columns are ignored; an empty
table on either side gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintora.llm._io import stored
from vintora.llm.words import starts, words_of

SPAN = 11
MASKS = ((0, 1, 2, 4, 7, 8, 10), (0, 1, 3, 4, 5, 8, 10), (0, 2, 3, 6, 7, 9, 10))
SHORT = 8
LEAST = 12
#: Share of equal words, as tenths, that is enough in a stretch of LEAST words or more.
SHARE = 8
#: Seeds (three numbers each) of the test items that are broadcast at most; beyond, the join shuffles.
BROADCAST_SEEDS = 400_000
#: Bytes of words of the test items that are broadcast at most; beyond, the join shuffles.
BROADCAST_BYTES = 16 << 20
#: Ways in which shuffled seeds and items are dealt, so that a very common one isn't one task's.
SALTS = 16


def _parts(n: int) -> list[tuple[int, int]]:
    """(place, words) of the parts of a short item of n words."""
    k = n - -(-SHARE * n // 10) + 1
    cuts = [n * j // k for j in range(k + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _hash(kind: int, words: str, at: Column, mask) -> Column:
    return F.xxhash64(F.lit(kind), *(F.get(words, at + j) for j in mask))


def _item_seeds(items: DataFrame, sizes: list[int]) -> DataFrame:
    """hash, item, place: all places of the masks, the parts of short items, and shorter items as a whole."""
    at, n = F.col("at"), F.col("m")
    row = lambda seed, place: F.struct(seed.alias("hash"), place.cast("int").alias("place"))
    long = items.where(n >= SPAN).select("item", "item_words", F.explode(starts(n, SPAN)).alias("at"))
    long = long.select("item", F.inline(F.array(*(row(_hash(k, "item_words", at, m), at) for k, m in enumerate(MASKS)))))
    short = [row(_hash(len(MASKS) + k, "item_words", F.lit(a), range(k)), F.lit(a)).alias("x") for n_ in sizes for a, k in _parts(n_)]
    own = [F.col("m") == n_ for n_ in sizes for _ in _parts(n_)]
    found = long
    if short:
        some = items.where(F.col("m").between(SHORT, SPAN - 1)).select("item", F.explode(F.array_compact(F.array(*(F.when(c, s) for c, s in zip(own, short))))).alias("s"))
        found = found.unionByName(some.select("item", "s.hash", "s.place"))
    whole = items.where(n.between(1, SHORT - 1)).select("item", F.xxhash64(F.lit(-1), "item_words").alias("hash"), F.lit(0).alias("place"))
    return found.unionByName(whole).distinct()


def _doc_seeds(split: DataFrame, spans: list[int], whole: bool) -> DataFrame:
    """key columns, hash, place of every document, for masks, contiguous parts of some lengths, and short whole texts."""
    at, n = F.col("at"), F.col("n")
    kinds = [(k, m) for k, m in enumerate(MASKS)] + [(len(MASKS) + k, range(k)) for k in spans]
    shortest = min(m[-1] + 1 for _, m in kinds)
    each = [F.when(at + m[-1] < n, _hash(k, "words", at, m)) for k, m in kinds]
    if whole:
        shortest = 1
        each.append(F.when((at == 0) & (n < SHORT), F.xxhash64(F.lit(-1), "words")))
    places = split.select(*KEY, "words", "n", F.explode(starts(n, shortest)).alias("at"))
    return places.select(*KEY, "at", F.explode(F.array(*each)).alias("hash")).where("hash IS NOT NULL")


def _walk(here: Column, there: Column, size: Column, least: int) -> Column:
    """overlap and enough of two aligned runs of words, in one pass.

    best: sum of the best stretch by +1 / -2. A stretch of at least `whole` words has its share of equal words if its
    sum of 10 - SHARE and -SHARE is 0 or more; the best one that ends here is the last `whole` words (their equality
    is kept as bits), or the best one that ended before with this word.
    """
    whole = F.least(F.lit(least), size)
    mask = F.expr(f"shiftleft(1L, cast(least({least}, m) as int)) - 1")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("bits"), F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).cast("long").alias("tail"), F.lit(False).alias("share"))

    def step(s: Column, same: Column) -> Column:
        bits = (F.shiftleft(s["bits"], 1) + same.cast("long")).bitwiseAND(mask)
        at, now = s["at"] + 1, F.greatest(F.lit(0), s["now"] + F.when(same, 1).otherwise(-2))
        last = 10 * F.bit_count(bits) - SHARE * whole.cast("long")
        tail = F.when(at <= whole, last).otherwise(F.greatest(last, s["tail"] + F.when(same, 10 - SHARE).otherwise(-SHARE)))
        return F.struct(at.alias("at"), bits.alias("bits"), now.alias("now"), F.greatest(s["best"], now).alias("best"), tail.cast("long").alias("tail"), (s["share"] | ((at >= whole) & (tail >= 0))).alias("share"))

    need = F.least(F.lit(least), F.ceil(F.lit(SHARE) * size / 10).cast("int"))
    end = lambda s: F.struct(s["best"].alias("overlap"), ((s["best"] >= need) | s["share"]).alias("enough"))
    return F.aggregate(F.zip_with(here, there, lambda a, b: a == b), start, step, end)


#: What names a row of documents: its id and its text.
KEY = ("doc_id", "text_hash")


def _same_row(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), item_id, overlap (score of the best stretch).

    One row for each contaminated document (id and text) and item. Documents are read twice: for their seeds, and,
    those with a hit only, for their words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    items = benchmark.select("item_id", words_of(F.col("text")).alias("item_words")).withColumn("m", F.size("item_words")).where("m > 0").distinct()
    items = stored(items.withColumn("item", F.xxhash64("item_id", "item_words")), "items")
    facts = items.groupBy(F.least("m", F.lit(SPAN)).alias("m")).agg(F.sum(F.aggregate("item_words", F.lit(0).cast("long"), lambda a, w: a + 48 + F.length(w))).alias("bytes")).collect()  # SPAN rows at most
    sizes = sorted(r["m"] for r in facts if SHORT <= r["m"] < SPAN)
    spans = sorted({k for n in sizes for _, k in _parts(n)})
    seeds = stored(_item_seeds(items, sizes), "seeds")

    split = rows.select(*KEY, words_of(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    at = _doc_seeds(split, spans, any(r["m"] < SHORT for r in facts))
    few = seeds.count() <= BROADCAST_SEEDS
    if few:
        hit = at.join(F.broadcast(seeds), "hash")
    else:
        salt = F.pmod(F.xxhash64(*KEY, "at"), F.lit(SALTS)).cast("int").alias("salt")
        hit = at.select("*", salt).join(seeds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["hash", "salt"])
    lanes = hit.select(*KEY, "item", (F.col("at") - F.col("place")).alias("lane")).distinct()
    # as many lanes as the two have words, at most
    lanes = stored(lanes.groupBy(*KEY, "item").agg(F.collect_list("lane").alias("lanes")), "lanes")

    words = split.alias("r").join(lanes.select(*KEY).distinct().alias("k"), _same_row("r", "k"), "left_semi").dropDuplicates([*KEY])
    near = lanes.alias("l").join(words.alias("r"), _same_row("l", "r")).select("l.doc_id", "l.text_hash", "l.item", "l.lanes", "r.words", "r.n")
    if sum(r["bytes"] for r in facts) <= BROADCAST_BYTES:
        near = near.join(F.broadcast(items), "item")
    else:
        salt = F.pmod(F.xxhash64(*KEY), F.lit(SALTS)).cast("int").alias("salt")
        near = near.select("*", salt).join(items.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["item", "salt"])

    def along(lane: Column) -> Column:
        low = F.greatest(F.lit(0), lane)
        length = F.least(F.col("n"), lane + F.col("m")) - low
        return _walk(F.slice("words", low + 1, length), F.slice("item_words", low - lane + 1, length), F.col("m"), least)

    whole = F.array(F.struct(F.col("m").alias("overlap"), (F.col("words") == F.col("item_words")).alias("enough")))
    alike = F.filter(F.when(F.col("m") < SHORT, whole).otherwise(F.transform("lanes", along)), lambda x: x["enough"])
    found = near.select(*KEY, "item_id", F.explode(F.transform(alike, lambda x: x["overlap"])).alias("overlap"))
    return found.groupBy(*KEY, "item_id").agg(F.max("overlap").alias("overlap"))


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_items, item_ids (joined by commas, `null` for a null one), overlap (largest).

    One row for each contaminated document id; the rows that share one are taken together.
    """
    found = overlaps(docs, benchmark, least).groupBy("doc_id", "item_id").agg(F.max("overlap").alias("overlap"))
    found = found.groupBy("doc_id").agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items"), F.count(F.when(F.col("item_id").isNull(), 1)).alias("unnamed"), F.max("overlap").cast("long").alias("overlap"))
    ids = F.concat(F.col("items").cast("array<string>"), F.when(F.col("unnamed") > 0, F.array(F.lit("null"))).otherwise(F.array().cast("array<string>")))
    return found.select("doc_id", "n_items", F.array_join(ids, ",").alias("item_ids"), "overlap")
