"""Operator 5: language identification by error-correcting output codes.

Method: every language gets a codeword; one binary logistic classifier per bit, over hashed
character n-grams, predicts it; loss-weighted decoding picks the codeword with the least
summed logistic loss, and a near tie of the two best is flagged as ambiguous.

Features: the whole lower-cased text, every run of other characters than letters folded to
one space; 1- to 3-grams hashed into ``BUCKETS`` counts, square-rooted, unit length.

The classifiers are fitted on about ``ROWS_PER_LANG`` different rows of each language, chosen by a
hash of id and text, and on at least one; with so many languages that these would be more than
``TRAIN_ROWS``, on fewer of each. All non-null languages that have a row with a letter are learned.

Defined results: text that is NULL or has no letter is ``und`` with score 0; without any labelled
row all rows are ``und``; with one language every text with a letter gets it; rows with a NULL id
or NULL lang are predicted, not learned from; repeated rows are predicted one by one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm.common import broadcast_if_light, crc_mod, cut_lineage, map_batches, pick, table, uniform

#: Feature buckets; sampled rows per language, and in all: more languages have fewer rows each.
BUCKETS, ROWS_PER_LANG, TRAIN_ROWS = 2048, 400, 20_000
#: A text is ambiguous if the best codeword's probability leads the second's by less.
AMBIGUOUS = 0.02
UNDEFINED = "und"

_LETTER, _OTHER = re.compile(r"[^\W\d_]"), re.compile(r"[\W\d_]+")


def features(text: str) -> np.ndarray:
    """Hashed 1- to 3-gram counts of the whole text (square roots, unit length)."""
    c = np.frombuffer((" " + _OTHER.sub(" ", text.lower()) + " ").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    two = c[:-1] * np.uint64(0x9E3779B1) + c[1:]
    three = two[:-1] * np.uint64(0x85EBCA6B) + c[2:]
    grams = np.concatenate([c * np.uint64(0xC2B2AE3D27D4EB4F), two * np.uint64(0x9E3779B97F4A7C15), three * np.uint64(0xD6E8FEB86659FD93)])
    x = np.sqrt(np.bincount((grams >> np.uint64(40)).astype(np.int64) % BUCKETS, minlength=BUCKETS)).astype(np.float32)
    return x / max(float(np.linalg.norm(x)), 1e-9)


def codewords(k: int) -> np.ndarray:
    """k rows of +1/-1. Up to 7 languages every way to split them in two is a bit; beyond, of 64
    drawn codes of 10 log2 k bits the one whose closest pair of rows is farthest apart."""
    if k <= 7:
        masks = [m for m in range(1, 2 ** (k - 1))] if k > 1 else [0]
        return np.array([[1 if m >> i & 1 else -1 for m in masks] for i in range(k)], dtype=np.float64)
    rng, bits, best, far = np.random.default_rng(5), int(np.ceil(10 * np.log2(k))), None, -1
    for _ in range(64):
        code = rng.choice([-1.0, 1.0], (k, bits))
        gap = (bits - (code @ code.T - 2 * bits * np.eye(k))).min()
        if gap > far and (abs(code.sum(0)) < k).all():
            best, far = code, gap
    return best


def fit_bits(x: np.ndarray, y: np.ndarray, code: np.ndarray, steps: int = 300) -> np.ndarray:
    """One logistic classifier per bit, all at once, by accelerated gradient steps."""
    x1 = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    target = code[y]
    w = np.zeros((x1.shape[1], code.shape[1]))
    ahead, rate = w.copy(), 4.0 / 2
    for t in range(steps):
        margin = target * (x1 @ ahead)
        grad = -x1.T @ (target / (1 + np.exp(margin))) / len(x) + 1e-5 * ahead
        new = ahead - rate * grad
        ahead, w = new + t / (t + 3) * (new - w), new
    return w


def decode(margins: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss-weighted decoding: index of the nearest codeword, its probability (the softmax of
    the negative losses), and its lead over the second."""
    loss = np.logaddexp(0, -margins[:, None, :] * code[None, :, :]).sum(2)
    p = np.exp(-(loss - loss.min(1, keepdims=True)))
    p /= p.sum(1, keepdims=True)
    best = p.argmax(1)
    top = np.sort(p, axis=1)[:, ::-1]
    return best, top[:, 0], top[:, 0] - (top[:, 1] if p.shape[1] > 1 else 0)


def fit(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> dict:
    """Model from ``docs(doc_id, text, lang)``: about ``rows_per_lang`` different rows of every language
    (fewer each where all would be more than ``TRAIN_ROWS``), at least one of each that has letters."""
    usable = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    usable = usable.withColumn("draw", uniform(F.col("doc_id"), F.col("text"), seed=5))
    sizes = cut_lineage(usable.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n"), F.min("draw").alias("least")), "languages")
    rows_per_lang = min(rows_per_lang, max(1, TRAIN_ROWS // max(1, sizes.count())))
    chosen = usable.join(broadcast_if_light(sizes), "lang").where((F.col("draw") < rows_per_lang / F.col("n")) | (F.col("draw") == F.col("least")))
    chosen = chosen.dropDuplicates(["lang", "doc_id", "text"])

    def run(b: pa.RecordBatch) -> dict:
        got = [(i, features(t)) for i, t in enumerate(b.column("text").to_pylist()) if _LETTER.search(t)]
        at = pa.array([i for i, _ in got], type=pa.int64())
        return {"doc_id": b.column("doc_id").take(at), "lang": b.column("lang").take(at), "x": [x.tobytes() for _, x in got]}

    rows = sorted((r.lang, r.doc_id, r.x) for r in map_batches(chosen.select("doc_id", "lang", "text"), run, "doc_id long, lang string, x binary").collect())
    langs = sorted({r[0] for r in rows})
    if not langs:
        return {"langs": []}
    x = np.array([np.frombuffer(r[2], dtype=np.float32) for r in rows])
    code = codewords(len(langs))
    return {"langs": langs, "code": code, "w": fit_bits(x, np.array([langs.index(r[0]) for r in rows]), code)}


def predict(texts: list[str | None], model: dict) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text."""
    n = len(texts)
    lang, score, unsure = [UNDEFINED] * n, np.zeros(n), np.zeros(n, dtype=bool)
    at = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)] if model["langs"] else []
    for part in (at[k:k + 256] for k in range(0, len(at), 256)):
        x = np.array([features(texts[i]) for i in part])
        best, p, lead = decode(x @ model["w"][:-1] + model["w"][-1], model["code"])
        for i, b in zip(part, best):
            lang[i] = model["langs"][b]
        score[part], unsure[part] = p, lead < AMBIGUOUS
    return lang, score, unsure


def identify(docs: DataFrame, model: dict, keep: dict[str, str], prefix: str = "") -> DataFrame:
    """``keep`` columns of every row plus ``lang_pred``, ``score``, ``ambiguous`` (with ``prefix``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> dict:
        lang, score, unsure = predict(b.column("text").to_pylist(), shared.value)
        return {c: b.column(c) for c in keep} | {f"{prefix}lang_pred": lang, f"{prefix}score": score, f"{prefix}ambiguous": unsure}

    cols = list(dict.fromkeys([*keep, "text"]))
    added = f", `{prefix}lang_pred` string, `{prefix}score` double, `{prefix}ambiguous` boolean"
    return map_batches(docs.select(*[f"`{c}`" for c in cols]), run, ", ".join(f"`{c}` {t}" for c, t in keep.items()) + added)


def keep_identified(docs: DataFrame, model: dict, drop_ambiguous: bool = False) -> DataFrame:
    """``docs``, all columns, without the rows that are ``und``; texts in two languages are flagged
    as ambiguous and stay, unless ``drop_ambiguous``."""
    found = identify(docs, model, {f.name: f.dataType.simpleString() for f in docs.schema}, prefix="_voltframe_")
    kept = found.where(F.col("_voltframe_lang_pred") != UNDEFINED)
    return (kept.where(~F.col("_voltframe_ambiguous")) if drop_ambiguous else kept).select(*[f"`{c}`" for c in docs.columns])


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: the fold crc32(doc_id) mod 3 <> 1."""
    return pick(docs, doc_id="long", text="string", lang="string").where(crc_mod(F.col("doc_id"), 3) != 1)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents")
    model = fit(training_rows(raw))
    docs = pick(raw, doc_id="long", text="string").withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)))
    return identify(docs, model, {"doc_id": "long", "held_out": "boolean"})
