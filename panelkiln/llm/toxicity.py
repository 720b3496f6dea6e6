"""Toxicity by non-negative positive-unlabelled learning.

A logistic classifier over the presence of hashed words and heads of words is trained in numpy from confirmed toxic examples (positive)
and other texts without regard to their labels (unlabelled). The risk is the positive-unlabelled estimator with a class
prior p: p * E_pos[l(+)] + max(0, E_unl[l(-)] - p * E_pos[l(-)]); where the bracket turns negative in a batch, the step goes
the other way, which undoes overfitting. Whole texts are scored in Arrow batches with the weights broadcast; their
size is fixed by `bits`. What reaches the driver is bounded in rows and in bytes, however often a doc_id repeats.

Labels of rows in the held-out fold are never read, and neither lang, source nor doc_id enters a score.

Defined results: a null or empty text has no words and gets the intercept's score. Rows with a null or repeated doc_id
are scored like others; a null doc_id is in no fold (held_out false) and never trains. Labels that are null or repeat
for a document count as toxic if any is 1. Without positive labels every score is the class prior. Words of a very
long text all count. Other columns play no part. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import settle

#: Bytes between words: ASCII that is neither a letter nor a digit.
GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
FOLDS, HELD = 4, 2
#: Bytes of a longer word's head that is a feature too, for words that share a stem.
HEADS = (4, 5)
#: Text bytes that one chunk scores: words, heads and their rows take some 60 times as much.
CHUNK_BYTES = 2 << 20


def fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def features(column, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed lower-case words and heads of words of each row, and where each row's begin (rows + 1)."""
    buf, offsets = K.string_buffers(column)
    starts, ends, first = K.spans(GAPS[buf], offsets)
    values = K.BYTE_VALUES[K.LOWER]
    hashes = [K.span_hashes(buf, starts, ends, values)]
    for n in HEADS:
        long = ends - starts > n
        hashes.append(K.mix(K.span_hashes(buf, starts[long], starts[long] + n, values) + np.uint64(n)))
    row = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    row = np.concatenate([row, *(row[ends - starts > n] for n in HEADS)])
    h = np.concatenate(hashes) >> np.uint64(64 - bits)
    both = K.distinct((row << np.uint64(bits)) | h)
    return (both & np.uint64((1 << bits) - 1)).astype(np.int64), np.searchsorted(both >> np.uint64(bits), np.arange(len(first)))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def risk_and_slope(s: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative risk of a batch with scores s, and the derivative of what the step descends in each row's logit:
    of the whole risk, or, where the bracket is negative, of the bracket with its sign turned."""
    p_pos, p_unl = prior * positive / positive.sum(), ~positive / (~positive).sum()
    toxic, clean = -np.log(np.maximum(s, 1e-12)), -np.log(np.maximum(1 - s, 1e-12))
    bracket = (p_unl - p_pos) @ clean
    # in the logit the derivative of l(+) is s - 1, of l(-) it is s
    slope = p_pos * (s - 1) + (p_unl - p_pos) * s if bracket >= 0 else -(p_unl - p_pos) * s
    return float(p_pos @ toxic + max(0.0, bracket)), slope


def _telling(positive: list[np.ndarray], unlabelled: list[np.ndarray], n: int, least_rows: int, least_z: float) -> tuple[np.ndarray, np.ndarray]:
    """Features in at least least_rows rows whose shares in the two samples differ by least_z standard errors, and by how many."""
    seen = []
    for sample in (positive, unlabelled):
        count = np.zeros(n, np.int32)
        for at in range(0, len(sample), 500):
            np.add.at(count, np.concatenate(sample[at : at + 500]), 1)
        seen.append(count)
    some = np.flatnonzero(seen[0] + seen[1] >= least_rows)
    seen = [count[some].astype(np.int64) for count in seen]
    share = [s / len(x) for s, x in zip(seen, (positive, unlabelled), strict=True)]
    both = (seen[0] + seen[1] + 1) / (len(positive) + len(unlabelled))
    z = (share[0] - share[1]) / np.sqrt(both * np.maximum(1 - both, 1e-9) * (1 / len(positive) + 1 / len(unlabelled)))
    used = np.abs(z) >= least_z
    return some[used], z[used]


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, bits: int, epochs: int = 60, batch: int = 1024, rate: float = 0.05, decay: float = 3e-4, least_rows: int = 5, least_z: float = 2.0, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights of all features and the intercept.

    decay: penalty on the square of a weight whose feature's shares in the two samples differ by 7 standard errors; it
    falls and grows with the fourth power of that number, so weak evidence is held back more instead of being cut off.
    """
    n, total = 1 << bits, len(positive) + len(unlabelled)
    is_pos = np.arange(total) < len(positive)
    bias = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return np.zeros(n), bias
    # features whose shares in the two samples differ by least_z standard errors
    names, z = _telling(positive, unlabelled, n, least_rows, least_z)
    k = len(names)
    number = np.full(n, -1, np.int32)
    number[names] = np.arange(k)
    rows = [x[x >= 0] for x in (number[r] for sample in (positive, unlabelled) for r in sample)]
    del number
    held_back = decay * (7.0 / np.abs(z)) ** 4
    w = np.zeros(k + 1)  # the last is the intercept
    w[-1] = bias
    m1, m2, step, mean, kept = np.zeros(k + 1), np.zeros(k + 1), 0, np.zeros(k + 1), 0
    random = np.random.default_rng(seed)
    for epoch in range(epochs):
        order = random.permutation(total)
        for at in range(0, len(order), batch):
            o = order[at : at + batch]
            pos = is_pos[o]
            if not pos.any() or pos.all():
                continue
            part = [rows[i] for i in o]
            flat = np.concatenate(part)
            owner = np.repeat(np.arange(len(o)), [len(p) for p in part])
            s = _sigmoid(np.bincount(owner, weights=w[flat], minlength=len(o)) + w[-1])
            slope = risk_and_slope(s, pos, prior)[1]
            g = np.append(np.bincount(flat, weights=slope[owner], minlength=k) + held_back * w[:-1], slope.sum())
            step += 1
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
            w = w - rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-6)
            if epoch >= epochs * 3 // 4:
                mean, kept = mean + w, kept + 1
    w = mean / kept if kept else w
    weights = np.zeros(n)
    weights[names] = w[:-1]
    return weights, float(w[-1])


def _bounded(rows: DataFrame, most: int, most_bytes: int) -> list[np.ndarray]:
    """Features of the first rows by key: at most `most` rows and, but for a single row, most_bytes."""
    sizes = rows.select("key", F.octet_length("ids").alias("size")).orderBy("key").limit(most).collect()
    if not sizes:
        return []
    n = max(1, int((np.cumsum([r.size for r in sizes]) <= most_bytes).sum()))
    last = sizes[n - 1].key
    same = sum(r.key == last for r in sizes[:n])
    last = F.struct(*(F.lit(last[c]).cast(rows.schema["key"].dataType[c].dataType).alias(c) for c in ("chance", "doc_id", "digest")))
    # rows with the last key are alike, so any of them will do
    kept = rows.filter(F.col("key") < last).select("key", "ids").unionByName(rows.filter(F.col("key") == last).limit(same).select("key", "ids"))
    # a partition at a time, so that the driver holds the sample once
    return [np.frombuffer(ids, "<i4") for _, ids in sorted((r.key.doc_id, bytes(r.ids)) for r in kept.toLocalIterator())]


def fit(docs: DataFrame, labels: DataFrame, bits: int = 20, most_positive: int = 3000, most_unlabelled: int = 9000, most_bytes: int = 256 << 20) -> dict:
    """A model from at most most_positive confirmed and most_unlabelled unlabelled rows, chosen by a hash of doc_id, and
    from fewer where the features of either sample would take more than most_bytes.

    The class prior is the share of toxic rows among all labels outside the held-out fold.
    """
    own = docs.select("doc_id", "text").filter("doc_id is not null").filter(fold() != HELD)
    marks = labels.filter("doc_id is not null").filter(fold() != HELD).groupBy("doc_id").agg(F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("toxic"))
    share = marks.agg(F.avg("toxic")).first()[0]
    prior = min(max(share or 0.0, 1e-4), 0.5)
    chance = F.xxhash64("doc_id", F.lit(17))
    toxic = marks.filter("toxic = 1").select("doc_id").orderBy(chance, "doc_id").limit(most_positive)
    others = own.select("doc_id").orderBy(chance, "doc_id").limit(most_unlabelled).distinct()
    # at most most_positive + most_unlabelled doc_ids; rows that repeat one are bounded below
    chosen = F.broadcast(toxic.withColumn("positive", F.lit(True)).unionByName(others.withColumn("positive", F.lit(False))))

    def run(batches):
        for t in K.chunks(batches, limit=CHUNK_BYTES):
            ids, first = features(t.column("text"), bits)
            data = ids.astype("<i4").tobytes()
            yield from pa.table({"doc_id": t.column("doc_id"), "positive": t.column("positive"), "ids": pa.array([data[4 * s : 4 * e] for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], pa.binary())}).to_batches()

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = own.join(chosen, "doc_id").select("doc_id", "positive", "text").mapInArrow(run, f"doc_id {kind}, positive boolean, ids binary")
    made = settle(made.withColumn("key", F.struct(chance.alias("chance"), "doc_id", F.xxhash64("ids").alias("digest"))), "training")
    toxic, others = (_bounded(made.filter(F.col("positive") == p), n, most_bytes) for p, n in ((True, most_positive), (False, most_unlabelled)))
    weights, bias = train(toxic, others, prior, bits)
    return {"weights": weights, "bias": bias, "bits": bits, "prior": prior}


def score(docs: DataFrame, model: dict, threshold: float = 0.3, keep: tuple = ()) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted and the columns in keep."""
    spark = docs.sparkSession
    names = np.flatnonzero(model["weights"])
    shared = spark.sparkContext.broadcast((names.astype(np.int32), model["weights"][names].astype(np.float64)))
    bits, bias = model["bits"], model["bias"]

    def run(batches):
        weights = np.zeros(1 << bits)
        weights[shared.value[0]] = shared.value[1]
        for t in K.chunks(batches, limit=CHUNK_BYTES):
            ids, first = features(t.column("text"), bits)
            total = np.append(0, np.cumsum(weights[ids]))
            yield from t.append_column("score", pa.array(_sigmoid(total[first[1:]] - total[first[:-1]] + bias))).drop_columns([] if "text" in keep else ["text"]).to_batches()

    rest = [c for c in keep if c not in ("doc_id", "text")]
    picked = docs.select("doc_id", "text", *rest)
    schema = ", ".join(f"`{c}` {kind}" for c, kind in picked.dtypes if c != "text" or "text" in keep)
    out = picked.mapInArrow(run, f"{schema}, score double")
    return out.withColumn("held_out", F.coalesce(fold() == HELD, F.lit(False))).withColumn("predicted", (F.col("score") >= threshold).cast("int")).select("doc_id", "held_out", "score", "predicted", *(c for c in keep if c != "doc_id"))
