"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes.

Features are the 3- to 6-grams of a lower-cased text, hashed into ``1 << BITS``
places; a feature's value is the square root of its frequency per thousand
n-grams, so texts of any length compare. Each feature is scaled by its
log-count ratio between the classes; a logistic regression on the scaled
features is fitted on at most ``PER_CLASS`` labelled documents of each class,
taken in the order of a hash of the id, as long as their texts are within
``SAMPLE_BYTES`` together (a longer text than that is passed over). These two
bounds are the only sample: priors are counted over all labelled rows, and
every whole text is scored.

The intercept is corrected from the classes' shares in the sample to those in
all labelled rows. The broadcast model is one float for each place (1 MB).

Defined cases: null and empty texts get the score of a text without features;
null labels and labels without a document are ignored; a document with several
labels counts as toxic if any says so; a null ``doc_id`` is not held out and
has no label; with labels of one class or none, every score is the prior
(0.5 without labels); repeated rows get equal rows; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernel.llm import _kernels as K
from quernel.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS, SIZES, PER_CLASS = 18, (3, 4, 5, 6), 2500
#: Bytes of text of one class that the driver holds while it fits.
SAMPLE_BYTES = 32 << 20
#: Documents in which a feature must occur, the least |log-count ratio|, the
#: documents that the common rate counts for in it, and the L2 penalty.
MIN_DOCS, MIN_RATIO, TRUST, PENALTY = 5, 0.7, 10, 2e-3


def grams(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Places of all n-grams of each text (with a space at both ends), repeats included."""
    ready = [" " + (t or "").lower() + " " for t in texts]
    at, n = 0, len(ready)
    while at < n:
        until, size = at, 0
        while until < n and (until == at or size + len(ready[until]) <= K.PIECE):
            size += len(ready[until])
            until += 1
        codes = np.frombuffer("".join(ready[at:until]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        hashes, h = {}, np.zeros(len(codes), np.uint64)
        for k in range(max(SIZES)):
            h = h[: len(codes) - k] * np.uint64(0x100000001B3) + codes[k:]
            if k + 1 in SIZES:
                x = h + np.uint64(k)
                x = (x ^ (x >> np.uint64(29))) * K._M1
                hashes[k + 1] = (x >> np.uint64(64 - BITS)).astype(np.int32)
        start = 0
        for text in ready[at:until]:
            end = start + len(text)
            yield np.concatenate([hashes[k][start : max(start, end - k + 1)] for k in SIZES])
            start = end
        at = until


def _frequencies(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and how many of a thousand n-grams fall on each."""
    own, n = np.unique(places, return_counts=True)
    return own, (n * (1000.0 / max(1, len(places)))).astype(np.float32)


def held_out(doc_id: Column, fold: int = 0) -> Column:
    remainder = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))
    return F.coalesce(remainder == fold, F.lit(False))


def fit(texts: list[str], toxic: np.ndarray, prior: float, steps: int = 150) -> tuple[np.ndarray, float]:
    """(weight of each place, intercept) from labelled texts.

    Full-batch Adam on the logistic loss with an L2 term; no randomness.
    """
    weights = np.zeros(1 << BITS, np.float32)
    base = float(np.log(prior / (1 - prior)))
    if not 0 < toxic.sum() < len(toxic):
        return weights, base
    # two passes over the sample, so that only the features of use are held
    yes, no, found = np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros(1 << BITS, np.int32)
    for x, y in zip(grams(texts), toxic, strict=True):
        own, often = _frequencies(x)
        (yes if y else no)[own] += often
        found[own] += 1
    rate, n_yes, n_no = (yes + no) / len(toxic), toxic.sum(), len(toxic) - toxic.sum()
    # both classes are drawn towards the common rate, so a rare feature has a ratio near 0
    ratio = np.log((yes + TRUST * rate + 1e-3) / (n_yes + TRUST)) - np.log((no + TRUST * rate + 1e-3) / (n_no + TRUST))
    good = (found >= MIN_DOCS) & (np.abs(ratio) >= MIN_RATIO)
    if not good.any():
        return weights, base
    index, scale = (np.cumsum(good) - 1).astype(np.int32), ratio[good].astype(np.float32)
    cols, values, sizes = [], [], []
    for x in grams(texts):
        own, often = _frequencies(x)
        use = good[own]
        cols.append(index[own[use]])
        values.append(scale[cols[-1]] * np.sqrt(often[use]))
        sizes.append(len(cols[-1]))
    col, value, row = np.concatenate(cols), np.concatenate(values), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    del cols, values
    w, b, target = np.zeros(len(scale)), 0.0, toxic.astype(float)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=w[col] * value, minlength=len(target)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / len(target)
        g = np.bincount(col, weights=error[row] * value, minlength=len(w)) + PENALTY * w
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.99**t
        w -= 0.02 * (m / c1) / (np.sqrt(v / c2) + 1e-9)
        b -= 0.02 * (mb / c1) / (np.sqrt(vb / c2) + 1e-9)
    weights[good] = (w * scale).astype(np.float32)
    sampled = toxic.mean()
    return weights, b + base - float(np.log(sampled / (1 - sampled)))


def _scorer(shared) -> Callable:
    def score(batches):
        weights, base = shared.value
        known = weights != 0
        for batch in batches:
            out = []
            for places in grams(batch.column(2).to_pylist()):
                own, n = np.unique(places[known[places]], return_counts=True)
                out.append(base + float((weights[own] * np.sqrt(n * (1000.0 / max(1, len(places))))).sum()))
            z = np.clip(np.array(out, float), -700, 700)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(1 / (1 + np.exp(-z)))], ["doc_id", "held_out", "score"])

    return score


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """The model from the labelled rows that aren't held out."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("y"))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    ids = None
    for y in (0, 1):
        some = known.where(F.col("y") == y).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(per_class)
        ids = some if ids is None else ids.unionByName(some)
    # at most twice PER_CLASS ids; whole texts are written once, and only those within the bound come to the driver
    sample = docs.join(F.broadcast(ids), docs.doc_id == ids.id).groupBy("id", "y").agg(F.max("text").alias("text"))
    sample = stored(sample.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")), "toxicity-sample")
    order = Window.partitionBy("y").orderBy(F.xxhash64(F.col("id").cast("string")), "id")
    within = sample.where(F.col("size") <= SAMPLE_BYTES).select("id", "y", F.sum("size").over(order).alias("sofar"))
    chosen = within.where(F.col("sofar") <= SAMPLE_BYTES).select(F.col("id").alias("chosen"), F.col("y").alias("cy"))
    table = sample.join(F.broadcast(chosen), (F.col("id") == F.col("chosen")) & (F.col("y") == F.col("cy"))).orderBy("id").select("y", "text").toArrow()
    return fit(table.column("text").to_pylist(), np.array(table.column("y").to_pylist(), float), prior)


def score(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``."""
    spark = docs.sparkSession
    K.small_batches(spark)
    docs = docs.select(F.col("doc_id").alias("doc_id"), "text")
    shared = spark.sparkContext.broadcast(train(docs, labels, per_class))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(_scorer(shared), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, labels)
