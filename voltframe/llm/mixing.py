"""Operator 4: mixing sources to target weights by iterative proportional fitting.

Method: documents fall into cells (source, language, topic). The cells' token totals are raked:
scaled in turn to the target share of every source, language and topic until all three marginals
fit. A document's inclusion probability is its cell's raked weight times one factor, at most 1,
calibrated so that the expected tokens of the sample are ``share`` of all; a document is drawn if
a fixed hash of it falls below (so the same documents are drawn on every run and every cluster).
``weight`` = raked weight / probability makes weighted totals of the sample fit the targets.

Only categories with a target are cells of their own, all others are ``other``: the number of
cells is at most the product of the target lists' lengths plus one each, whatever the data, so
the cell totals (summed by Spark over all documents) may be raked on the driver.

Tokens are white-space separated words. The topic of a text is a bucket (``t0``..``t7``) of its
most frequent lower-cased word of at least five characters (ties: the smallest); ``none`` without.

Defined results: NULL source or language is ``other``; NULL or empty text has no tokens and topic
``none``; a cell without tokens gets probability ``share``; categories absent from the data
lose their target to the others in proportion; targets that cannot be met together (an empty
crossing) are met as closely as ``ITERATIONS`` rounds get; an empty table gives no rows; equal
rows are drawn together.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm.common import cut_lineage, map_batches, pick, table, uniform

TOPICS, LEAST_LETTERS, ITERATIONS, SHARE, SEED = 8, 5, 500, 0.5, 4
OTHER = "other"
#: Target shares of tokens: the hot source is held to a tenth, languages and topics are levelled.
TARGETS = {
    "source": {"src0": 0.10} | {f"src{i}": 0.045 for i in range(1, 20)} | {OTHER: 0.045},
    "lang": {"en": 0.40, "de": 0.20, "fr": 0.20, "es": 0.15, OTHER: 0.05},
    "topic": {f"t{i}": 0.12 for i in range(TOPICS)} | {"none": 0.04},
}
_AXES = ("source", "lang", "topic")


def topic_of(words: list[str]) -> str:
    seen = Counter(w for w in words if len(w) >= LEAST_LETTERS)
    if not seen:
        return "none"
    most = max(seen.values())
    return f"t{zlib.crc32(min(w for w, n in seen.items() if n == most).encode('utf-8', 'surrogatepass')) % TOPICS}"


def rake(tokens: np.ndarray, targets: list[np.ndarray], iterations: int = ITERATIONS) -> np.ndarray:
    """Raked token shares of the cells of a dense array, one axis per marginal."""
    x = tokens / max(tokens.sum(), 1e-300)
    wanted = []
    for axis, t in enumerate(targets):
        there = tokens.sum(axis=tuple(a for a in range(tokens.ndim) if a != axis)) > 0
        t = np.where(there, t, 0.0)
        wanted.append(t / t.sum() if t.sum() else there / max(there.sum(), 1))
    for _ in range(iterations):
        worst = 0.0
        for axis, t in enumerate(wanted):
            now = x.sum(axis=tuple(a for a in range(x.ndim) if a != axis))
            factor = np.divide(t, now, out=np.zeros_like(t, dtype=float), where=now > 0)
            worst = max(worst, float(np.abs(now - t).max()))
            x = x * factor.reshape([-1 if a == axis else 1 for a in range(x.ndim)])
        if worst < 1e-12:
            break
    return x


def probabilities(tokens: np.ndarray, raked: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Inclusion probability and weight of each cell; the expected sample has ``share`` of all tokens
    (or all that the wanted cells have)."""
    total = tokens.sum()
    w = np.divide(raked * total, tokens, out=np.zeros_like(raked), where=tokens > 0)
    low, high = 0.0, 1.0
    reach = tokens[w > 0].sum()
    while (np.minimum(1, high * w) * tokens).sum() < min(share * total, reach) * (1 - 1e-12) and high < 1e18:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if (np.minimum(1, mid * w) * tokens).sum() < share * total else (low, mid)
    p = np.where(tokens > 0, np.minimum(1, high * w), share)
    return p, np.divide(w, p, out=np.zeros_like(w), where=p > 0)


def measured(docs: DataFrame, targets: dict, keep: list[str]) -> DataFrame:
    """``keep`` columns plus _mix_source, _mix_lang, _mix_topic (cells' categories) and _mix_tokens."""
    types = {f.name: f.dataType.simpleString() for f in docs.select(*[f"`{c}`" for c in keep]).schema}

    def run(b: pa.RecordBatch) -> dict:
        topics, tokens = [], []
        for t in b.column("text"):      # one text's words at a time
            words = (t.as_py() or "").lower().split()
            topics.append(topic_of(words))
            tokens.append(len(words))
        return {c: b.column(c) for c in types} | {"_mix_topic": topics, "_mix_tokens": tokens, "_mix_source": b.column("_mix_source"), "_mix_lang": b.column("_mix_lang")}

    def folded(c: str):
        known = [k for k in targets[c] if k != OTHER]
        text = F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")
        return F.when(text.isin(known), text).otherwise(F.lit(OTHER))

    cols = docs.withColumns({"_mix_source": folded("source"), "_mix_lang": folded("lang")}).select(*[f"`{c}`" for c in dict.fromkeys([*keep, "text"])], "_mix_source", "_mix_lang")
    out = map_batches(cols, run, "".join(f"`{c}` {t}, " for c, t in types.items()) + "_mix_source string, _mix_lang string, _mix_topic string, _mix_tokens long")
    known = [k for k in targets["topic"] if k != OTHER]
    return out.withColumn("_mix_topic", F.when(F.col("_mix_topic").isin(known), F.col("_mix_topic")).otherwise(F.lit(OTHER)))


def cell_table(spark: SparkSession, cells: DataFrame, targets: dict, share: float) -> DataFrame:
    """Probability and weight of every cell, from ``cells(_mix_source, _mix_lang, _mix_topic, tokens)``."""
    names = [list(dict.fromkeys([*targets[a], OTHER])) for a in _AXES]
    tokens = np.zeros([len(n) for n in names])
    for r in cells.collect():    # at most the product of the target lists, see above
        tokens[names[0].index(r._mix_source), names[1].index(r._mix_lang), names[2].index(r._mix_topic)] += float(r.tokens or 0)
    raked = rake(tokens, [np.array([targets[a].get(k, 0.0) for k in n]) for a, n in zip(_AXES, names)])
    p, w = probabilities(tokens, raked, share)
    rows = [(s, g, t, float(p[i, j, k]), float(w[i, j, k])) for i, s in enumerate(names[0]) for j, g in enumerate(names[1]) for k, t in enumerate(names[2])]
    return F.broadcast(spark.createDataFrame(rows, "_mix_source string, _mix_lang string, _mix_topic string, _mix_p double, _mix_w double"))


def mix(docs: DataFrame, targets: dict = TARGETS, share: float = SHARE, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all, if None) of every row plus _mix_source, _mix_lang, _mix_topic, _mix_tokens, _mix_p, _mix_w
    and _mix_drawn."""
    keep = keep or docs.columns
    narrow = cut_lineage(measured(docs, targets, []).groupBy("_mix_source", "_mix_lang", "_mix_topic").agg(F.sum("_mix_tokens").alias("tokens")), "cells")
    table_ = cell_table(docs.sparkSession, narrow, targets, share)
    rows = measured(docs.withColumn("_mix_u", uniform(F.col("doc_id"), F.xxhash64("text"), seed=seed)), targets, [*keep, "_mix_u"])
    return rows.join(table_, ["_mix_source", "_mix_lang", "_mix_topic"]).withColumn("_mix_drawn", F.col("_mix_u") < F.col("_mix_p"))


def sample(docs: DataFrame, targets: dict = TARGETS, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs``, all columns, with their probability and weight (as
    mix_probability, mix_weight; an underscore is added where docs has such a column)."""
    def free(name: str) -> str:
        while name.lower() in {c.lower() for c in docs.columns}:
            name += "_"
        return name

    return mix(docs, targets, share, seed).where("_mix_drawn").select(*[f"`{c}`" for c in docs.columns], F.col("_mix_p").alias(free("mix_probability")), F.col("_mix_w").alias(free("mix_weight")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="long", text="string", lang="string", source="string")
    return mix(docs, keep=["doc_id"]).select("doc_id", F.col("_mix_source").alias("source_cell"), F.col("_mix_lang").alias("lang_cell"), F.col("_mix_topic").alias("topic"),
                                             F.col("_mix_tokens").alias("n_tokens"), F.col("_mix_p").alias("probability"), F.col("_mix_w").alias("weight"), F.col("_mix_drawn").alias("drawn"))
