"""Operator 1: quality classifier.

Method: random indexing gives every word a vector (the sum of its neighbours' sparse index
vectors), a document is the mean of its words' vectors, and a two-layer numpy network with a
calibrated temperature turns that into a probability of label 1.

A token counts twice: as its lower-cased core and as its shape (letters folded to ``A``/``a``,
digits to ``0``, marks kept), with one more shape word for an immediate repetition. Words live
in hashed buckets, so the vocabulary, and with it the model, has a fixed size (``VOCAB`` x
``DIM`` floats); words never seen in the sample have a zero context vector.

The model (word vectors and network) is fitted on about ``TRAIN_ROWS`` labelled rows, chosen by
a hash of their id; every whole text is scored. Inputs of a score: the text alone.

Defined results: NULL text scores as the empty text (mean vector zero); a document without a
usable label (NULL id, NULL or missing label) is scored, not learned from; repeated labels of an
id are averaged (>= 0.5 is 1); without any label, or with only one kind, the score is the share
of label 1 (0.5 without labels); repeated rows are scored one by one; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm.common import bounded_sample, crc_mod, cut_lineage, map_batches, pick, sigmoid, table

VOCAB, DIM, NONZERO, WINDOW = 1 << 14, 64, 8, 2
TRAIN_ROWS, HIDDEN, EPOCHS = 4000, 32, 60
THRESHOLD = 0.3
_CHUNK = 1024
_CACHE_WORDS = 200_000

_WORD = re.compile(r"\w")
_UPPER, _LOWER, _DIGIT = re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), re.compile(r"[^\W\d_A]+"), re.compile(r"\d+")


def codes(token: str) -> tuple[int, int]:
    """Buckets of a token's core and of its shape."""
    first = _WORD.search(token)
    core = token[first.start():len(token) - _WORD.search(token[::-1]).start()].lower() if first else ""
    shape = _DIGIT.sub("0", _LOWER.sub("a", _UPPER.sub("A", token)))
    return zlib.crc32(core.encode()) % VOCAB, zlib.crc32(b"\0" + shape.encode()) % VOCAB


REPEAT = zlib.crc32(b"\0\0repeat") % VOCAB


def index_vectors() -> np.ndarray:
    """The fixed sparse ternary index vector of each bucket."""
    rng = np.random.default_rng(20_240_101)
    out = np.zeros((VOCAB, DIM), dtype=np.float32)
    at = np.argsort(rng.random((VOCAB, DIM)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, at, rng.choice(np.array([-1, 1], dtype=np.float32), (VOCAB, NONZERO)), axis=1)
    return out / np.float32(np.sqrt(NONZERO))


class Encoder:
    """Token buckets with a bounded cache."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def __getitem__(self, token: str) -> tuple[int, int]:
        got = self.known.get(token)
        if got is None:
            if len(self.known) >= _CACHE_WORDS:
                self.known.clear()
            got = self.known[token] = codes(token)
        return got

    def sequence(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        both = np.array([self[t] for t in text.split()], dtype=np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


def _add_rows(into: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    if len(at):
        order = np.argsort(at, kind="stable")
        keys, first = np.unique(at[order], return_index=True)
        into[keys] += np.add.reduceat(rows[order], first, axis=0)


def _context_sums(batch: pa.RecordBatch, index: np.ndarray, enc: Encoder) -> np.ndarray:
    out = np.zeros((VOCAB, DIM), dtype=np.float32)
    for text in batch.column("text").to_pylist():
        core, shape = enc.sequence(text or "")
        own = index[core] + index[shape]
        ctx = np.zeros_like(own)
        for d in range(1, WINDOW + 1):
            ctx[d:] += own[:-d]
            ctx[:-d] += own[d:]
        _add_rows(out, core, ctx)
        _add_rows(out, shape, ctx)
    return out


def word_vectors(sample: DataFrame) -> np.ndarray:
    """Random-indexing vectors over the sample: partial sums in the tasks, added by Spark per
    chunk of buckets; unit length each (zero if unseen)."""

    def part(b: pa.RecordBatch) -> dict:
        c = _context_sums(b, index_vectors(), Encoder())
        used = [k for k in range(0, VOCAB, _CHUNK) if c[k:k + _CHUNK].any()]
        return {"chunk": used, "sums": [c[k:k + _CHUNK].tobytes() for k in used]}

    def add(pdf):
        total = sum(np.frombuffer(x, dtype=np.float32) for x in pdf["sums"])
        return pdf.head(1).assign(sums=[total.tobytes()])

    rows = (map_batches(sample.select("text").repartition(8), part, "chunk int, sums binary")
            .groupBy("chunk").applyInPandas(add, "chunk int, sums binary").collect())
    c = np.zeros((VOCAB, DIM), dtype=np.float32)
    for r in rows:
        c[r.chunk:r.chunk + _CHUNK] = np.frombuffer(r.sums, dtype=np.float32).reshape(-1, DIM)
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)


def pooled(texts: list[str | None], vectors: np.ndarray, index: np.ndarray, enc: Encoder) -> np.ndarray:
    """Mean core vector, mean shape vector and mean shape index vector of each text."""
    out = np.zeros((len(texts), 3 * DIM), dtype=np.float32)
    for i, text in enumerate(texts):
        tokens = (text or "").split()
        if not tokens:
            continue
        seen = Counter(tokens)
        n = np.fromiter(seen.values(), dtype=np.float32, count=len(seen))
        at = np.array([enc[t] for t in seen], dtype=np.int64)
        again = sum(map(eq, tokens, tokens[1:]))
        out[i, :DIM] = n @ vectors[at[:, 0]] / len(tokens)
        out[i, DIM:2 * DIM] = (n @ vectors[at[:, 1]] + again * vectors[REPEAT]) / len(tokens)
        out[i, 2 * DIM:] = (n @ index[at[:, 1]] + again * index[REPEAT]) / len(tokens)
    return out


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 7) -> dict:
    """Two layers (tanh, logistic) by Adam on four fifths of the rows; the temperature that
    fits the last fifth best. One kind of label: a constant."""
    if len(y) == 0 or y.min() == y.max():
        return {"constant": float(y.mean()) if len(y) else 0.5}
    rng = np.random.default_rng(seed)
    mean, std = x.mean(0), x.std(0) + 1e-4
    z = ((x - mean) / std).astype(np.float64)
    order = rng.permutation(len(y))
    cut = max(1, len(y) * 4 // 5)
    tr, va = order[:cut], order[cut:]
    p = {"w1": rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN),
         "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(1)}
    m, v, t = {k: 0 * a for k, a in p.items()}, {k: 0 * a for k, a in p.items()}, 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(tr), max(1, len(tr) // 64)):
            h = np.tanh(z[rows] @ p["w1"] + p["b1"])
            d = (sigmoid(h @ p["w2"] + p["b2"]) - y[rows]) / len(rows)
            dh = np.outer(d, p["w2"]) * (1 - h * h)
            grad = {"w1": z[rows].T @ dh + 1e-3 * p["w1"], "b1": dh.sum(0), "w2": h.T @ d + 1e-3 * p["w2"], "b2": d.sum(keepdims=True)}
            t += 1
            for k, g in grad.items():
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 0.003 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    model = p | {"mean": mean, "std": std, "temperature": 1.0}
    if len(va):
        raw = _logits(x[va], model)
        losses = {T: np.logaddexp(0, np.where(y[va] > 0, -raw / T, raw / T)).mean() for T in np.geomspace(0.25, 8, 41)}
        model["temperature"] = float(min(losses, key=losses.get))
    return model


def _logits(x: np.ndarray, model: dict) -> np.ndarray:
    z = (x - model["mean"]) / model["std"]
    return np.tanh(z @ model["w1"] + model["b1"]) @ model["w2"] + model["b2"][0]


def predict(x: np.ndarray, model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(x), model["constant"])
    return sigmoid(_logits(x, model) / model["temperature"])


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> dict:
    """Word vectors and network from ``docs(doc_id, text)`` and ``labels(doc_id, label)``."""
    chosen = bounded_sample(labels.where("doc_id IS NOT NULL AND label IS NOT NULL"), ["doc_id"], train_rows, seed=1)
    chosen = chosen.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    # at most about train_rows rows of 12 bytes: a proven bound for the broadcast
    sample = cut_lineage(docs.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "text"]), "quality-sample")
    sample = bounded_sample(sample, ["doc_id", "text"], train_rows, seed=2)   # an id may have many texts
    vectors, index = word_vectors(sample), index_vectors()

    def features(b: pa.RecordBatch) -> dict:
        x = pooled(b.column("text").to_pylist(), vectors, index, Encoder())
        return {"doc_id": b.column("doc_id"), "label": b.column("label"), "x": [r.tobytes() for r in x]}

    rows = sorted((r.doc_id, r.label, r.x) for r in map_batches(sample.select("doc_id", "label", "text"), features, "doc_id long, label int, x binary").collect())
    x = np.array([np.frombuffer(r[2], dtype=np.float32) for r in rows]).reshape(-1, 3 * DIM)
    return {"vectors": vectors, "net": fit_network(x, np.array([r[1] for r in rows], dtype=np.float64))}


def score(docs: DataFrame, model: dict, keep: dict[str, str]) -> DataFrame:
    """``keep`` columns of every row plus ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    state: dict = {}

    def run(b: pa.RecordBatch) -> dict:
        if not state:
            state.update(index=index_vectors(), enc=Encoder())
        x = pooled(b.column("text").to_pylist(), shared.value["vectors"], state["index"], state["enc"])
        return {c: b.column(c) for c in keep} | {"score": predict(x, shared.value["net"])}

    return map_batches(docs.select(*keep, "text"), run, ", ".join(f"{c} {t}" for c, t in keep.items()) + ", score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="long", text="string")
    labels = pick(table(spark, sf_dir, "labels"), doc_id="long", quality="int").withColumnRenamed("quality", "label")
    model = fit(docs, labels.where(crc_mod(F.col("doc_id"), 5) != 0))
    docs = docs.withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)))
    return score(docs, model, {"doc_id": "long", "held_out": "boolean"}).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
