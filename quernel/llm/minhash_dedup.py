"""MinHash near-dedup with min-max hashing.

Under each permutation both the smallest and the largest hash of a document's
shingle set are kept: two signature values for one evaluation. Values are
grouped into bands; documents that share a band are candidates, and a
candidate counts only if the full sets confirm it.

Work on groups of copies stays linear:

1. documents with equal sets form a class with one representative;
2. in each bucket the representatives are compared with the smallest one;
3. links make components; a pair inside one component can't change the
   result, so only documents of buckets that hold several components go on;
4. of these, a document goes out if so many of its shingles occur in no other
   open document that no partner could reach the threshold;
5. the rest is compared in blocks: the documents of a bucket are dealt into
   blocks, and two blocks of different components are counted as one product
   of incidence matrices if a bucket has documents in both. A pair of blocks is
   counted once, however many buckets they share; a large group of buckets
   costs what its buckets cost, and only links come out, never pairs.

So every candidate pair either is confirmed or refuted on full sets, or lies
inside a component already: the components are those of all confirmed pairs.

With ``BANDS`` = 32 bands of two permutations (four values), a pair at the
threshold 0.8 is missed with a chance of (1 - 0.8**4)**32, below 1e-7.

Defined cases: a null or empty text has an empty set and is linked with
nothing; with one word, the word is the set; rows that share a ``doc_id`` are
one document for links; a row without id counts as a copy where a document
with an id has its set, and else is kept with a null component; an empty table
gives an empty result; other columns are ignored by ``near_duplicates`` and
passed through by ``deduplicate``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.llm import _kernels as K
from quernel.llm._graph import components
from quernel.llm._native import fresh, salted_join
from quernel.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS, SEED = 32, 20260501
#: Documents of one block; two of them meet in a task.
BLOCK = 512
NO_LABEL = -1 << 62
#: Ids of candidates up to this number are broadcast (8 MB) to the scan that
#: makes their sets; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    for lo, hi, h, at, _ in K.hashed_words(column):
        for i in range(hi - lo):
            own = h[at[i] : at[i + 1]]
            if len(own) >= words:
                grams = K.gram_hashes(own, words)
            elif len(own):
                grams = K.gram_hashes(own, len(own))
            else:
                grams = own
            yield np.unique(grams)


def _signer(words: int, bands: int) -> Callable:
    def sign(batches):
        draw = np.random.default_rng(SEED)
        mult = draw.integers(1, 1 << 63, 2 * bands, np.uint64) * np.uint64(2) + np.uint64(1)
        flip = draw.integers(0, 1 << 63, 2 * bands, np.uint64)
        salt = draw.integers(0, 1 << 63, bands, np.uint64)

        def banded(x: np.ndarray) -> np.ndarray:
            low = np.full(2 * bands, np.uint64(0xFFFFFFFFFFFFFFFF))
            high = np.zeros(2 * bands, np.uint64)
            for k in range(0, len(x), 4096):
                y = (x[k : k + 4096, None] ^ flip) * mult
                low, high = np.minimum(low, y.min(0)), np.maximum(high, y.max(0))
            key = salt.copy()
            for part in (low[::2], high[::2], low[1::2], high[1::2]):
                key = K.mixed(key * K._M1 + part)
            return key

        for batch in batches:
            ids, n, one, two, keys = batch.column(0), [], [], [], []
            for x in _sets(batch.column(1), words):
                n.append(len(x))
                with np.errstate(over="ignore"):
                    one.append(np.bitwise_xor.reduce(K.mixed(x ^ K._M2)) if len(x) else 0)
                    two.append(K.mixed(x + K._M1).sum(dtype=np.uint64) if len(x) else 0)
                if len(x):
                    keys.append(banded(x).view(np.int64))
            filled = np.array(n, np.int64) > 0
            offsets = np.concatenate(([0], np.cumsum(filled * bands))).astype(np.int32)
            values = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.cast(pa.int64()),
                    pa.array(np.array(n, np.int64)),
                    pa.array(np.array(one, np.uint64).view(np.int64)),
                    pa.array(np.array(two, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                ["doc_id", "n", "set1", "set2", "bands"],
            )

    return sign


def _set_maker(words: int, short: bool = False) -> Callable:
    def make(batches):
        kind = np.int32 if short else np.int64
        for batch in batches:
            sets = [np.unique((x >> np.uint64(32)).astype(np.uint32)).view(kind) if short else x.view(kind) for x in _sets(batch.column(1), words)]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            values = np.concatenate(sets) if sets else np.zeros(0, kind)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["node", "grams"])

    return make


def _confirmed(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those pairs (a, b, na, nb) that reach the threshold on full sets."""
    pairs = stored(pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b", "na", "nb"), "pairs")
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    ids = stored(ids, "pair-ids")
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.join(side, docs.doc_id == side.id, "left_semi").select("doc_id", "text")
    sets = stored(texts.mapInArrow(_set_maker(words), "node long, grams array<long>").dropDuplicates(["node"]), "sets")
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b")
    shared = F.size(F.array_intersect("ga", "gb"))
    return two.where(shared * 100 >= (F.col("na") + F.col("nb") - shared) * percent).select("a", "b")


def _open(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, n, label) of the buckets that hold several components."""
    named = buckets.join(labels.withColumnRenamed("node", "l_node"), F.col("node") == F.col("l_node"), "left")
    named = named.select("bucket", "node", "n", F.coalesce("label", "node").alias("label"))
    split = named.groupBy("bucket").agg(F.min("label").alias("l1"), F.max("label").alias("l2")).where("l1 <> l2").select("bucket")
    return named.join(split, "bucket", "left_semi")


def _across(docs: DataFrame, buckets: DataFrame, labels: DataFrame, words: int, percent: int) -> DataFrame | None:
    """Pairs (a, b, na, nb) of different components that may be linked, or None."""
    open_rows = stored(_open(buckets, labels), "open")
    nodes = stored(open_rows.groupBy("node").agg(F.first("n").alias("n"), F.first("label").alias("label")), "open-nodes")
    count = nodes.count()
    if count == 0:
        return None
    ids = nodes.select(F.col("node").alias("id"))
    texts = docs.join(F.broadcast(ids) if count <= BROADCAST_IDS else ids, F.col("doc_id") == F.col("id"), "left_semi").select("doc_id", "text")
    # 32 bits of each hash; what clashes inside one document take away is given back as slack,
    # so a clash can only add a candidate, and links are confirmed on full sets
    sets = stored(texts.mapInArrow(_set_maker(words, short=True), "node long, grams array<int>").dropDuplicates(["node"]), "open-sets")
    alone = sets.select("node", F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("times"), F.min("node").alias("node")).where("times = 1")
    alone = alone.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    live = nodes.join(alone, "node", "left").where((F.col("n") - F.coalesce("alone", F.lit(0))) * 100 >= F.col("n") * percent).select("node")
    open_rows = stored(_open(buckets.join(live, "node", "left_semi"), labels), "open-live")
    if open_rows.limit(1).count() == 0:
        return None
    # a document's home is the largest of its open buckets, so those of one hot bucket share their blocks
    sizes = open_rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    homes = open_rows.join(sizes, "bucket").groupBy("node").agg(F.max(F.struct("size", "bucket")).alias("top"))
    rows = stored(homes.select("node", F.col("top.bucket").alias("home")).join(nodes, "node"), "homes")
    per = rows.groupBy("home", "label").agg(F.count(F.lit(1)).alias("rows"))
    kinds = per.select(F.col("home").alias("k_home"), F.col("label").alias("k_label"), F.when(F.col("rows") >= BLOCK, F.col("label")).otherwise(NO_LABEL).alias("big"), "rows")
    parts = kinds.groupBy("k_home", "big").agg(F.ceil(F.sum("rows") / BLOCK).cast("int").alias("parts"))
    kinds = kinds.drop("rows").join(parts, ["k_home", "big"])
    named = rows.join(kinds, (F.col("home") == F.col("k_home")) & (F.col("label") == F.col("k_label")))
    block = F.struct("home", "big", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    named = stored(named.select("node", "n", "label", block.alias("block")), "blocks")
    # blocks meet where one bucket has documents in both; blocks of one component need no comparison
    touch = stored(open_rows.select("bucket", "node").join(named.select("node", "block"), "node").select("bucket", "block").distinct(), "bucket-blocks")
    left, right = touch.select("bucket", F.col("block").alias("x")), touch.select("bucket", F.col("block").alias("y"))
    jobs = left.join(right, "bucket").where(f"x <= y AND (x.big <> y.big OR x.big = {NO_LABEL})").select(F.struct("x", "y").alias("job")).distinct()
    sides = jobs.select("job", F.explode(F.array_distinct(F.array("job.x", "job.y"))).alias("block"))
    dealt = sides.join(named, "block").join(sets, "node")
    dealt = dealt.select("job", (F.col("block") == F.col("job.x")).alias("first"), "node", "n", "label", "grams")
    return dealt.groupBy("job").applyInArrow(_block_counter(percent), "a long, b long, na long, nb long")


def _block_counter(percent: int) -> Callable:
    def count(table: pa.Table) -> pa.Table:
        first = table.column("first").to_numpy(zero_copy_only=False).astype(bool)
        node, n, label = (table.column(c).to_numpy() for c in ("node", "n", "label"))
        lists = table.column("grams").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        owner, flat = np.repeat(np.arange(len(node)), sizes), lists.flatten().to_numpy()
        rows = np.flatnonzero(first)
        cols = np.flatnonzero(~first) if not first.all() else rows
        place = np.zeros(len(node), np.int64)
        place[rows] = np.arange(len(rows))
        own, gram = np.unique(flat, return_inverse=True)
        in_rows = np.bincount(gram[first[owner]], minlength=len(own))
        in_cols = np.bincount(gram[~first[owner]], minlength=len(own)) if not first.all() else in_rows - 1
        index = np.cumsum((in_rows > 0) & (in_cols > 0)) - 1
        use = ((in_rows > 0) & (in_cols > 0))[gram]
        at, who = index[gram[use]], owner[use]
        if cols is not rows:
            place[cols] = np.arange(len(cols))
        shared = np.zeros((len(rows), len(cols)), np.float32)
        order = np.argsort(at, kind="stable")
        at, who = at[order], who[order]
        for k in range(0, int(at[-1]) + 1 if len(at) else 0, 2048):
            part = slice(np.searchsorted(at, k), np.searchsorted(at, k + 2048))
            x = np.zeros((len(rows), 2048), np.float32)
            y = x if cols is rows else np.zeros((len(cols), 2048), np.float32)
            mine = first[who[part]]
            x[place[who[part][mine]], at[part][mine] - k] = 1
            if y is not x:
                y[place[who[part][~mine]], at[part][~mine] - k] = 1
            shared += x @ y.T
        total = n[rows][:, None] + n[cols][None, :]
        lost = n - sizes  # shingles of a document that share their 32 bits with others of it
        slack = np.minimum(lost[rows][:, None], lost[cols][None, :])
        hit = ((shared + slack) * (100 + percent) >= total * percent) & (label[rows][:, None] != label[cols][None, :])
        if cols is rows:
            hit &= node[rows][:, None] < node[cols][None, :]
        i, j = np.nonzero(hit)
        a, b, na, nb = node[rows][i], node[cols][j], n[rows][i], n[cols][j]
        swap = a > b
        a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
        return pa.table({"a": a, "b": b, "na": na, "nb": nb})

    return count


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    ``docs`` needs doc_id (integer) and text; shingles have ``words`` words
    and a pair is linked at ``percent`` per cent Jaccard similarity or more.
    """
    K.small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(docs.mapInArrow(_signer(words, bands), "doc_id long, n long, set1 long, set2 long, bands array<long>"), "signatures")
    # classes of equal sets; only those with copies need a row of their own
    same = ["n", "set1", "set2"]
    classes = signed.where("n > 0").groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows"))
    copied = stored(classes.where("rows > 1").drop("rows"), "classes")
    member = salted_join(signed, copied, same, F.xxhash64("doc_id"), "left", salts=8)
    member = member.select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")).alias("rep"), "bands")
    member = stored(member, "members")
    nodes = member.where("n > 0 AND rep IS NOT NULL AND doc_id = rep").select(F.col("rep").alias("node"), "n", F.explode("bands").alias("bucket"))
    shared = nodes.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("low"), F.max("node").alias("high")).where("low.node <> high")
    shared = shared.select("bucket", F.col("low.node").alias("low"), F.col("low.n").alias("low_n"))
    buckets = stored(nodes.join(shared, "bucket"), "buckets")
    order = [F.least("node", "with").alias("a"), F.greatest("node", "with").alias("b")]
    sizes = [F.when(F.col("node") < F.col("with"), F.col("n")).otherwise(F.col("m")).alias("na"), F.when(F.col("node") < F.col("with"), F.col("m")).otherwise(F.col("n")).alias("nb")]
    first = buckets.select("node", "n", F.col("low").alias("with"), F.col("low_n").alias("m")).where("node <> with").select(*order, *sizes).distinct()
    first = stored(first, "pairs-low")
    links = stored(_confirmed(docs, first, words, percent), "links-low")
    labels = components(links)
    across = _across(docs, buckets.select("bucket", "node", "n"), labels, words, percent)
    if across is not None:
        found = stored(_confirmed(docs, across, words, percent), "links-across")
        if found.limit(1).count():
            labels = components(links.unionByName(found))
    final = labels.select(F.col("node").alias("l_node"), "label")
    out = member.join(final, F.col("rep") == F.col("l_node"), "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id"))
    kept = F.when(F.col("component_id").isNull(), F.lit(True)).otherwise(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    return out.withColumn("kept", kept)


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component; columns of ``docs``.

    Of rows that repeat a kept ``doc_id``, one stays; rows without id stay.
    """
    mark, drop, rows = fresh(docs, "dedup_id", "dedup_drop", "dedup_rows")
    found = near_duplicates(docs, words, percent).where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(mark)).agg(F.max(~F.col("kept")).alias(drop), F.count(F.lit(1)).alias(rows))
    # the text is shuffled once, to meet the ids that go or repeat
    joined = docs.join(found.where(F.col(drop) | (F.col(rows) > 1)), docs.doc_id == F.col(mark), "left")
    left = joined.where(~F.coalesce(drop, F.lit(False)))
    once, again = left.where(F.coalesce(rows, F.lit(1)) == 1), left.where(F.col(rows) > 1).dropDuplicates(["doc_id"])
    return once.unionByName(again).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, words=2)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 2 THEN [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] ELSE w END) AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS m FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
      WHERE least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80 GROUP BY 1, 2),
l AS (SELECT a, b FROM c WHERE 100 * m >= 80 * (na + nb - m)),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS reach FROM d UNION SELECT r.node, u.b FROM r JOIN u ON r.reach = u.a),
m AS (SELECT node, min(reach) AS component_id FROM r GROUP BY 1)
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN m ON node = doc_id
"""
