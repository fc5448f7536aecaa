"""Operator 2: benchmark decontamination by winnowing, in DataFrame functions only.

Method: a text's k-grams of words are hashed; of every ``WINDOW`` consecutive k-gram hashes the
least is kept as a fingerprint. With K + WINDOW - 1 = 13, each run of 13 words that a document
shares with an item has the same least hash on both sides, so joining fingerprints misses none.
Each hit is then extended word by word, to the left and the right, and counts only where at
least 13 equal words are reached (actual words are compared, not hashes).

An item of fewer than 13 words is one window of its own length L; it is found the same way with
k-grams of L words and a winnowing window of one (only the lengths that occur are computed).

Steps: (1) one scan turns each document into its word count and its distinct fingerprints, a
written table keyed by a 128-bit hash of the text; (2) exploded fingerprints meet the
benchmark's: a broadcast join if the benchmark's fingerprints were counted to fit, else a
shuffle join that AQE may split; (3) only texts with a hit are read again, hits located and
extended. No step gathers more than one document's or one item's hits in a group.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z only.

Defined results: a NULL or empty text has no words, no hits and is not contaminated; equal
texts get equal results, whatever their ids (also NULL or repeated ids); an item without words
hits nothing; an item with a NULL id marks words but is no counted item; a repeated item id
counts once; items_sha256 of no items is that of the empty string; an empty benchmark leaves
every document clean, empty documents give no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm.common import BROADCAST_ROWS, broadcast_if_small, cut_lineage, pick, table

SPAN, K = 13, 8
WINDOW = SPAN - K + 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(parts, "")


def _grams(h: Column, n: Column, k: int) -> Column:
    """Hashes of the k-grams of word hashes ``h`` (k is part of the hash: lengths never mix)."""
    starts = F.slice(h, F.lit(1), F.greatest(n - (k - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.xxhash64(F.lit(k), x, *[F.get(h, i + j) for j in range(1, k)]))


def _minima(g: Column, w: int) -> Column:
    """The least of every w consecutive hashes."""
    starts = F.slice(g, F.lit(1), F.greatest(F.size(g) - (w - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.least(x, *[F.get(g, i + j) for j in range(1, w)])) if w > 1 else g


def _hashed(df: DataFrame) -> DataFrame:
    """Adds ``w`` (words), ``n`` (their number), ``h`` (their hashes); each is a column of its
    own that later expressions read many times, so it is evaluated once."""
    df = df.withColumn("w", words(F.col("text"))).withColumn("n", F.size("w"))
    return df.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))


def _plan(lengths: list[int]) -> list[tuple[int, int]]:
    """(k, winnowing window) for each item length that occurs (13 stands for 13 and more)."""
    return [(K, WINDOW) if length == SPAN else (length, 1) for length in lengths]


def _text_key() -> Column:
    return F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))


def _context(w: Column, i: Column, k: int, reach: int) -> list[Column]:
    """The k words at i, and the up to ``reach`` words before (nearest first) and after it."""
    lo = F.greatest(i - reach, F.lit(0))
    return [F.slice(w, i + 1, F.lit(k)).alias("mid"), F.reverse(F.slice(w, lo + 1, i - lo)).alias("left"),
            F.slice(w, i + k + 1, F.lit(reach)).alias("right")]


def _located(df: DataFrame, k: int, w: int, wanted: Column, keep: list[str]) -> DataFrame:
    """One row per position whose k-gram hash is in the array ``wanted``: hash, position, context."""
    reach = SPAN - k if w > 1 else 0
    df = df.withColumn("g", _grams(F.col("h"), F.col("n"), k)).withColumn("want", wanted(F.col("g")))
    df = df.withColumn("at", F.filter(F.sequence(F.lit(0), F.size("g")), lambda i: F.coalesce(F.array_contains("want", F.get("g", i)), F.lit(False))))
    df = df.withColumn("found", F.transform("at", lambda i: F.struct(F.get("g", i).alias("f"), i.alias("pos"), *_context(F.col("w"), i, k, reach))))
    # explode_outer: plain explode adds a size filter that is pushed down with all of the above inlined into its lambdas
    df = df.select(*keep, F.lit(k).alias("k"), F.lit(SPAN if w > 1 else k).alias("need"), F.explode_outer("found").alias("o"))
    return df.select(*keep, "k", "need", "o.*").where("f IS NOT NULL")


def _same(a: str, b: str) -> Column:
    """How many words of two contexts agree before the first difference."""
    runs, so_far = [], F.lit(True)
    for j in range(SPAN - K):
        so_far = so_far & F.coalesce(F.get(F.col(a), F.lit(j)) == F.get(F.col(b), F.lit(j)), F.lit(False))
        runs.append(so_far.cast("int"))
    return reduce(add, runs)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs(text, ...)`` with n_words, n_hit, n_items, items_sha256, contaminated added; the
    other columns of ``docs`` must not have these names."""
    items = cut_lineage(_hashed(pick(benchmark, item_id="string", text="string")).where("n > 0").select("item_id", "w", "n", "h"), "bench-items")
    lengths = sorted(r[0] for r in items.select(F.least("n", F.lit(SPAN))).distinct().collect())   # at most 13 values
    kinds = _plan(lengths)
    sides = []
    for k, w in kinds:
        own = items.where(F.col("n") >= SPAN) if w > 1 else items.where(F.col("n") == k)
        sides.append(_located(own, k, w, lambda g, w=w: F.array_distinct(_minima(g, w)), ["item_id"]))
    index = cut_lineage(reduce(DataFrame.unionByName, sides).drop("pos"), "bench-prints") if sides else None

    base = _hashed(docs.withColumn("_key", _text_key()))
    prints = F.array(*[]).cast("array<bigint>")
    for j, (k, w) in enumerate(kinds):
        base = base.withColumn(f"g{j}", _grams(F.col("h"), F.col("n"), k))
        prints = F.array_union(prints, _minima(F.col(f"g{j}"), w))
    columns = [c for c in docs.columns if c != "text"]
    scanned = cut_lineage(base.select(*columns, "_key", F.col("n").cast("long").alias("n_words"), prints.alias("prints")), "doc-prints")

    if index is None:
        hits = scanned.select("_key", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), F.lit("").alias("items")).limit(0)
    else:
        distinct_prints = broadcast_if_small(cut_lineage(index.select("f").distinct(), "bench-print-set"))
        met = (scanned.select("_key", F.explode("prints").alias("f")).join(distinct_prints, "f")
               .groupBy("_key").agg(F.collect_set("f").alias("fs")))
        met = cut_lineage(met, "doc-hits")
        small = broadcast_if_small(met, BROADCAST_ROWS // 8)
        again = _hashed(docs.select("text").withColumn("_key", _text_key()).join(small, "_key"))
        found = reduce(DataFrame.unionByName, [_located(again, k, w, lambda g: F.col("fs"), ["_key"]) for k, w in kinds])
        theirs = broadcast_if_small(index.select("f", "need", "item_id", *[F.col(c).alias(f"i_{c}") for c in ("mid", "left", "right")]), BROADCAST_ROWS // 8)
        before, after = _same("left", "i_left"), _same("right", "i_right")
        # need is part of the key: 8-grams of items of 8 words and of longer ones have the same hashes
        spans = (found.join(theirs, ["f", "need"]).where(F.col("mid") == F.col("i_mid"))
                 .select("_key", "item_id", "k", "need", "pos", before.alias("before"), after.alias("after"))
                 .where(F.col("before") + F.col("k") + F.col("after") >= F.col("need"))
                 .select("_key", "item_id", (F.col("pos") - F.col("before")).alias("lo"), (F.col("pos") + F.col("k") + F.col("after") - 1).alias("hi")))
        hits = (spans.distinct().groupBy("_key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"), F.collect_set("item_id").alias("ids"))
                .select("_key", F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["lo"], s["hi"]))))).cast("long").alias("n_hit"),
                        F.size("ids").cast("long").alias("n_items"), F.array_join(F.array_sort("ids"), ",").alias("items")))
    out = scanned.drop("prints").join(hits, "_key", "left").na.fill(0, ["n_hit", "n_items"])
    return out.select(*columns, "n_words", "n_hit", "n_items", F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not contaminated."""
    bad = decontaminate(docs.select(F.col("text").cast("string").alias("text"), _text_key().alias("text_key")), benchmark).where("contaminated").select("text_key").distinct()
    bad = broadcast_if_small(cut_lineage(bad.withColumnRenamed("text_key", "_voltframe_bad"), "contaminated"))
    keyed = docs.withColumn("_voltframe_key", _text_key())
    return keyed.join(bad, F.col("_voltframe_key") == F.col("_voltframe_bad"), "left_anti").select(*[f"`{c}`" for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(pick(table(spark, sf_dir, "documents"), doc_id="long", text="string"), table(spark, sf_dir, "benchmark"))


_WORDS = "regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format(t="text")}, []) AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS span FROM (SELECT item_id, {_WORDS.format(t="text")} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, span, array_to_string(w[s:s + span - 1], ' ') AS win
       FROM (SELECT item_id, w, span, unnest(range(1, len(w) - span + 2)) AS s FROM b)),
spans AS (SELECT DISTINCT span FROM bw),
dw AS (SELECT doc_id, span, s, array_to_string(w[s:s + span - 1], ' ') AS win
       FROM (SELECT doc_id, w, span, unnest(range(1, len(w) - span + 2)) AS s FROM d, spans WHERE len(w) >= span)),
hit AS (SELECT dw.doc_id, item_id, s, dw.span FROM dw JOIN bw USING (span, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + span)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""
