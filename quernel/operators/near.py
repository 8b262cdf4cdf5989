"""Near-duplicate audit on word shingles: exact links between shingle-set classes.

Copies are one class; links are found by an exact prefix filter with frequent
shingles last, so a passage that many documents share is in hardly any prefix.
Any order loses no pair: frequencies are counted for half of the shingles, and
only prefixes, a tenth of all shingles, are joined.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.functions import text as T
from quernel.session import small_batches, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MASK = (1 << 61) - 1
#: A shingle is frequent if more classes have it; so many frequent ones are broadcast, 8 bytes each.
OFTEN, FREQUENT = 8, 4_000_000
#: Classes up to which a band is joined as it is.
CROWD = 64
#: Ids up to which they are broadcast to pick rows, else joined by a shuffle.
BROADCAST_IDS = 4_000_000


def features(docs: DataFrame, size: int = 8, min_tokens: int = 50) -> DataFrame:
    """(doc_id, n_tokens, grams): sorted distinct shingle hashes of long documents."""
    made = lambda t: F.struct(F.size(t).cast("long").alias("n_tokens"), F.sort_array(F.array_distinct(T.gram_keys(t, size))).alias("grams"))
    long = F.filter(F.array(T.comparison_tokens(F.col("text"))), lambda t: F.size(t) >= min_tokens)
    # the number, which is no function of a row, keeps the filter above the projection; pushed below it, it would make all shingles twice
    rows = docs.select("doc_id", F.get(F.transform(long, made), 0).alias("f"), F.monotonically_increasing_id().alias("k"))
    return rows.where("size(f.grams) > 0 AND k >= 0").select("doc_id", "f.n_tokens", "f.grams")


def _set(grams: Column) -> Column:
    """The identity of a shingle set: its size and 128 bits of hashes."""
    return F.struct(F.size(grams).alias("n"), F.xxhash64(grams).alias("h"), F.xxhash64(F.lit(1), grams).alias("k"))


def _picked(rows: DataFrame, ids: DataFrame, names: list[str], how: str) -> DataFrame:
    """Rows by a semi or an anti join; rows of grams stay where they are if the ids can be broadcast."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, names, how)


def classes(feats: DataFrame) -> DataFrame:
    """(rep, n_tokens, n, grams, set) of distinct shingle sets; rep is the smallest id."""
    keyed = feats.withColumn("set", _set(F.col("grams")))
    reps = keyed.groupBy("set").agg(F.min("doc_id").alias("rep"))
    copies = stored(keyed.select("set", "doc_id").join(reps, "set").where("doc_id > rep").select("set", "doc_id"), "near-copies")
    return _picked(keyed, copies, ["set", "doc_id"], "left_anti").select(F.col("doc_id").alias("rep"), "n_tokens", F.size("grams").alias("n"), "grams", "set")


def signature(grams: Column, components: int = 8) -> Column:
    """One-permutation signature: the smallest remainder in each of eight parts."""
    part = lambda k: F.coalesce(F.array_min(F.transform(F.filter(grams, lambda x: F.shiftrightunsigned(x, 61) == k), lambda x: x.bitwiseAND(F.lit(MASK)))), F.lit(MASK))
    return F.array(*[part(k) for k in range(components)])


def _signatures(batches):
    """The ``signature`` of Arrow batches (rep, n, grams)."""
    for batch in batches:
        lists = batch.column(2)
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten().to_numpy()
        out = np.full(8 * len(lists), MASK, np.int64)
        np.minimum.at(out, owner * 8 + (flat.view(np.uint64) >> np.uint64(61)).astype(np.int64), flat & MASK)
        made = pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * 8), pa.array(out))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], ["rep", "n", "signature"])


def bands(sig: Column, rows: int = 2, count: int = 4) -> Column:
    return F.array(*[F.xxhash64(F.lit(b), *[F.get(sig, b * rows + r) for r in range(rows)]) for b in range(count)])


def lsh_candidates(sets: DataFrame, similarity: float = 0.9) -> DataFrame:
    """(a, b): classes that share a band of the signature and may be as similar.

    Very many classes can share a band, as those of a common passage do, or
    small sets that leave a band's parts empty. Within such a band classes are
    joined on the shingles of their prefixes, which similar ones share.
    """
    small_batches(sets.sparkSession)
    signed = sets.select("rep", F.col("n").cast("long").alias("n"), "grams").mapInArrow(_signatures, f"rep {sets.schema['rep'].dataType.simpleString()}, n long, signature array<long>")
    rows = stored(signed.select("rep", "n", F.explode(bands(F.col("signature"))).alias("band")), "near-bands")
    full = stored(rows.groupBy("band").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > CROWD).select("band"), "near-full-bands")
    crowded = _picked(rows, full, ["band"], "left_semi")
    inside = _picked(sets, crowded.select("rep").distinct(), ["rep"], "left_semi")
    keys = prefixes(inside, similarity).withColumnRenamed("n", "m").join(crowded, "rep").select("rep", "n", F.xxhash64("band", "gram").alias("key"))
    plain = _picked(rows, full, ["band"], "left_anti").select("rep", "n", F.col("band").alias("key"))
    return _pairs(plain, similarity).unionByName(_pairs(keys, similarity)).distinct()


def _pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of (rep, n, key) that share a key and whose sizes allow the similarity."""
    near = F.expr(f"x.key = y.key AND x.rep < y.rep AND least(x.n, y.n) >= {similarity} * greatest(x.n, y.n)")
    return rows.alias("x").join(rows.alias("y"), near).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))


def _prefix_rows(frequent: np.ndarray, similarity: float):
    """A function of Arrow batches (rep, n, grams): the first shingles of each set, frequent ones last."""

    def rows(batches):
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            flat = lists.flatten().to_numpy()
            late = np.zeros(len(flat), bool)
            if len(frequent):
                late = frequent[np.minimum(np.searchsorted(frequent, flat), len(frequent) - 1)] == flat
            owner = np.repeat(np.arange(len(sizes)), sizes)
            ends = np.cumsum(sizes)
            lates = np.append(0, np.cumsum(late))
            before = lates[ends - sizes]
            # places among the set's other shingles, or behind all of them
            early = np.arange(len(flat)) - (ends - sizes)[owner] - (lates[:-1] - before[owner])
            place = np.where(late, (sizes - (lates[ends] - before))[owner] + lates[:-1] - before[owner], early)
            keep = place < (sizes - np.ceil(sizes * similarity - 1e-9).astype(np.int64) + 1)[owner]
            mine = owner[keep]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(mine)), pa.array(sizes[mine]), pa.array(flat[keep])], ["rep", "n", "gram"])

    return rows


def prefixes(sets: DataFrame, similarity: float = 0.9) -> DataFrame:
    """(rep, n, gram): so many first shingles of each set that two similar sets share one.

    The order is by hash with frequent shingles last. They are known for the
    lower half of all hashes, which prefixes seldom leave.
    """
    spark = sets.sparkSession
    small_batches(spark)
    counts = sets.select(F.explode("grams").alias("gram")).where("gram < 0").groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    counts, least = stored(counts.where(F.col("df") > OFTEN), "near-frequent"), OFTEN
    while counts.where(F.col("df") > least).count() > FREQUENT:
        least *= 2
    shared = spark.sparkContext.broadcast(np.sort(np.array([r.gram for r in counts.where(F.col("df") > least).select("gram").toLocalIterator()], np.int64)))

    def first(batches):
        return _prefix_rows(shared.value, similarity)(batches)

    return sets.select("rep", F.col("n").cast("long").alias("n"), "grams").mapInArrow(first, f"rep {sets.schema['rep'].dataType.simpleString()}, n long, gram long")


def prefix_candidates(sets: DataFrame, similarity: float = 0.9) -> DataFrame:
    """(a, b): classes that share one of their first shingles; loses no pair."""
    rows = stored(prefixes(sets, similarity).withColumnRenamed("gram", "key"), "near-prefixes")
    return _pairs(rows, similarity).distinct()


def links(sets: DataFrame, candidates: DataFrame, similarity: float = 0.9, ratio: float = 0.9, most: int = 16, share: float = 0.02) -> DataFrame:
    """(a, b, shared, similarity, safe) of candidate pairs that are near.

    A pair is safe to remove if neither side has more than ``most`` shingles
    of its own, nor more than ``share`` of its set.
    """
    # only classes of some pair, with their grams, leave the scan
    candidates = stored(candidates, "near-candidates")
    sets = _picked(sets, candidates.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), ["rep"], "left_semi")
    left = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("n_tokens").alias("ta"), F.col("grams").alias("ga"))
    right = sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("n_tokens").alias("tb"), F.col("grams").alias("gb"))
    pairs = candidates.join(left, "a").join(right, "b").withColumn("length_ratio", T.length_ratio(F.col("ta"), F.col("tb"))).where(F.col("length_ratio") >= ratio)
    pairs = pairs.select("a", "b", "na", "nb", "length_ratio", F.size(F.array_intersect("ga", "gb")).alias("shared"))
    union = F.col("na") + F.col("nb") - F.col("shared")
    lonely = F.greatest(F.col("na") - F.col("shared"), F.col("nb") - F.col("shared"))
    own = F.greatest((F.col("na") - F.col("shared")) / F.col("na"), (F.col("nb") - F.col("shared")) / F.col("nb"))
    near = pairs.select("a", "b", F.col("shared").cast("long").alias("shared"), (F.col("shared") / union).alias("similarity"), ((lonely <= most) & (own <= share)).alias("safe"), "length_ratio")
    return near.where(F.col("similarity") >= similarity)


def signature_similarity(a: Column, b: Column) -> Column:
    """Share of equal components; two empty signatures are equal, different lengths an error."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return F.when(F.size(a) != F.size(b), F.raise_error(F.lit("signatures of different lengths"))).when(F.size(a) == 0, F.lit(1.0)).otherwise(same / F.size(a))


def report(found: DataFrame) -> DataFrame:
    """For each class with earlier near ones: how many, how many safe, and the best.

    Matches are ordered by similarity, then length ratio, then id; a class is
    removable if one match is safe, and ambiguous matches are the others.
    """
    key = F.struct((-F.col("similarity")).alias("less"), (-F.col("length_ratio")).alias("shorter"), F.col("a").alias("id"))
    best = found.groupBy(F.col("b").alias("doc_id")).agg(F.count(F.lit(1)).alias("matches"), F.count_if("safe").alias("safe"), F.count_if(~F.col("safe")).alias("ambiguous"), F.min(key).alias("best"))
    return best.select("doc_id", "matches", "safe", "ambiguous", F.col("best.id").alias("best_id"), (-F.col("best.less")).alias("best_similarity"), (F.col("safe") > 0).alias("would_remove"))


def audit(feats: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, near, safe): whether an earlier document is near, and safely so."""
    member = feats.select("doc_id", _set(F.col("grams")).alias("set"))
    member = member.join(sets.select(F.col("set").alias("rep_set"), "rep"), F.col("set") == F.col("rep_set"))
    both = found.select("a", "b", "safe").unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "safe"))
    first = both.groupBy("a").agg(F.min("b").alias("any_first"), F.min(F.when(F.col("safe"), F.col("b"))).alias("safe_first"))
    joined = member.join(first, F.col("rep") == F.col("a"), "left")
    copy = F.col("doc_id") > F.col("rep")
    return joined.select("doc_id", (copy | F.coalesce(F.col("any_first") < F.col("doc_id"), F.lit(False))).alias("near"), (copy | F.coalesce(F.col("safe_first") < F.col("doc_id"), F.lit(False))).alias("safe"))
