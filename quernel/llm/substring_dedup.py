"""Substring dedup: fuzzy repeated passages by collinear chaining.

1. Seeds: runs of ``K_WORDS`` words whose middle word has the smallest hash of
   them, about one run in ``K_WORDS``. Whether a run is a seed depends on its
   own words alone, so an edit costs only the seeds it touches, and each run of
   words that two texts share gives both the same seeds.
2. Seeds of several documents are joined with the smallest document that has
   the seed (its leader): a passage of m documents gives m - 1 pairs, not m
   squared, and every document of it is in a pair. The same is done for wide
   seeds, ``WIDE`` neighbouring seeds as one: their leader shares a longer
   stretch, so passages that overlap each other differently in different
   documents aren't cut into pieces by the leaders of their single seeds.
3. In each pair, matches on one diagonal are joined to segments; segments are
   chained in order with costs for gaps, through a Fenwick tree of prefix
   maxima.
4. Chains are aligned on the words of both texts: gaps inside are compared
   word by word (with an edit alignment where their lengths differ), ends are
   extended. A chain is split at gaps of ``MIN_RANGE`` words or more that match
   for less than a third; one below ``IDENTITY`` is split at its longest gap,
   and its parts are tried alone, down to single segments.
5. A document's aligned ranges are merged, as one passage may have several
   leaders, also over gaps of fewer than ``WINDOW`` words (two leaders of
   neighbouring seeds can leave so much open between them); passages of at
   least ``MIN_WORDS`` words are reported.

Of passages with 5 to 25 % of the words of one copy replaced at random, 92 to
100 % of the words are found in the test; where both copies are edited, a rate
of 15 % each (measured before step 2 compared more than leaders). Missed can be a
pair whose seeds all have more than ``CROWD`` places, if neither neighbours nor
a leader bring it together. A range ends where its leader's text goes another way. If a third document
shares more than the leader of the last wide seed does, the range can end up
to ``K_WORDS + WINDOW`` words early at that side.

Hot seeds are combined on the map side; joins on leaders leave skewed keys to
the adaptive planner, which splits them. What one task holds of a document or
pair is bounded by that document's length.

Defined cases: null and empty texts have no passages; rows with a null
``doc_id`` are not compared; rows that share a ``doc_id`` are one document, for
which any one of the texts is aligned; repeats inside one document don't
count; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernel.llm import _kernels as K
from quernel.session import forget, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K_WORDS, WINDOW, WIDE = 5, 10, 5
#: Cost of a word of gap, words of context around a chain, least identity of
#: an alignment, least words of an aligned range and of a reported passage.
GAP, MARGIN, IDENTITY, MIN_RANGE, MIN_WORDS = 0.1, 64, 0.6, 16, 40
#: What a differing word costs an extension, in matching words.
MISS = 1.4
#: Places of a seed up to which all different texts meet; words compared around
#: those of a more frequent one, and differing words that its orders leave out.
CROWD, AROUND, SKIPS = 10, 16, (0, 1, 3)
#: Places of a seed up to which its orders are made in memory, and places that are sorted at once.
MANY, AT_ONCE = 10_000, 20_000
#: Ids up to this number are broadcast (8 MB); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def seed_places(h: np.ndarray) -> np.ndarray:
    """First words of the runs whose middle word has the smallest hash (the first of ties)."""
    half, n = K_WORDS // 2, len(h) - K_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    middle = h[half : half + n]
    ok = np.ones(n, bool)
    for k in range(K_WORDS):
        other = h[k : k + n]
        if k != half:
            ok &= middle < other if k < half else middle <= other
    return np.flatnonzero(ok)


def _seeds(batches):
    for batch in batches:
        ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
        for lo, hi, h, at, _ in K.hashed_words(batch.column(1)):
            docs, seeds, places = [], [], []
            if len(h) < K_WORDS:
                continue
            grams = K.gram_hashes(h, K_WORDS)
            for i in range(hi - lo):
                own = grams[at[i] : max(at[i], at[i + 1] - K_WORDS + 1)]
                where = seed_places(h[at[i] : at[i + 1]])
                runs = K.gram_hashes(own[where], WIDE)  # each stands at its middle seed
                docs.append(np.full(len(where) + len(runs), ids[lo + i]))
                seeds += [own[where], runs]
                places += [where, where[WIDE // 2 : WIDE // 2 + len(runs)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(docs)), pa.array(np.concatenate(seeds).view(np.int64)), pa.array(np.concatenate(places).astype(np.int32))],
                ["doc", "seed", "pos"],
            )


def _words(batches):
    for batch in batches:
        rows = [[np.zeros(0, np.int32)]]
        sizes = []
        for lo, hi, h, at, _ in K.hashed_words(batch.column(1)):
            rows.append([(h >> np.uint64(32)).astype(np.uint32).view(np.int32)])
            sizes += np.diff(at).tolist()
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        flat = np.concatenate([x for r in rows for x in r])
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["doc", "words"])


def segments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows (a0, a1, b0, b1) of matches at (a, b), joined along diagonals."""
    order = np.lexsort((a, b - a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (b[1:] - a[1:] != b[:-1] - a[:-1]) | (a[1:] - a[:-1] > K_WORDS + WINDOW)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a)) - 1
    rows = np.stack([a[first], a[last] + K_WORDS, b[first], b[last] + K_WORDS], 1)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


class Fenwick:
    """Prefix maxima of (value, owner)."""

    def __init__(self, n: int) -> None:
        self.best = [(-1e18, -1)] * (n + 1)

    def put(self, i: int, item: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if item > self.best[i]:
                self.best[i] = item
            i += i & -i

    def most(self, i: int) -> tuple[float, int]:
        """The largest item at places below ``i``."""
        out = (-1e18, -1)
        while i > 0:
            if self.best[i] > out:
                out = self.best[i]
            i -= i & -i
        return out


def chains(rows: np.ndarray) -> list[list[int]]:
    """Chains of segments, best first; each segment is in one chain at most.

    A segment may follow one that ends before it on both sides; the words of
    the gap on both sides cost ``GAP`` each.
    """
    n = len(rows)
    if n == 1:
        return [[0]]
    ends = np.unique(rows[:, 3])
    put_at = np.searchsorted(ends, rows[:, 3]).tolist()
    ask_at = np.searchsorted(ends, rows[:, 2], "right").tolist()
    by_end = np.argsort(rows[:, 1], kind="stable").tolist()
    a0, a1, b0, b1 = (rows[:, i].tolist() for i in range(4))
    tree, score, before, done = Fenwick(len(ends)), [0.0] * n, [-1] * n, 0
    for i in range(n):  # in the order of a0
        while done < n and a1[by_end[done]] <= a0[i]:
            j = by_end[done]
            tree.put(put_at[j], (score[j] + GAP * (a1[j] + b1[j]), j))
            done += 1
        score[i] = float(a1[i] - a0[i])
        value, j = tree.most(ask_at[i])
        if j >= 0 and value - GAP * (a0[i] + b0[i]) > 0:
            score[i] += value - GAP * (a0[i] + b0[i])
            before[i] = j
    used, out = [False] * n, []
    for i in sorted(range(n), key=score.__getitem__, reverse=True):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def _chain(batches):
    for batch in batches:
        out: list[list] = [[], [], [], [], [], [], []]
        for doc, leader, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
            rows = segments(np.asarray(a.values.to_numpy(), np.int64), np.asarray(b.values.to_numpy(), np.int64))
            for chain in chains(rows):
                own = rows[chain]
                low = np.maximum(own[0, [0, 2]] - MARGIN, 0)
                for column, value in zip(out, (doc, leader, int(low[0]), int(own[-1, 1]) + MARGIN, int(low[1]), int(own[-1, 3]) + MARGIN, own.ravel().tolist()), strict=True):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["doc", "leader", "lo", "hi", "leader_lo", "leader_hi", "segments"])


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Words that an alignment of two stretches can match, whatever their lengths.

    Common ends are taken first, and stretches that agree word by word for the
    most part are counted so; else one row of the longest common subsequence
    is held, so the space is linear.
    """
    n = min(len(x), len(y))
    if n == 0:
        return 0
    if len(x) == len(y):
        same = int((x == y).sum())
        if 2 * same >= n:
            return same
    front = int(np.argmin(np.append(x[:n] == y[:n], False)))
    back = int(np.argmin(np.append(x[::-1][: n - front] == y[::-1][: n - front], False)))
    x, y = x[front : len(x) - back], y[front : len(y) - back]
    x, y = x[np.isin(x, y)], y[np.isin(y, x)]  # words of one side only match nothing
    if len(x) > len(y):
        x, y = y, x
    row = np.zeros(len(y) + 1, np.int64)
    for word in x:
        here = np.maximum(row[1:], np.where(y == word, row[:-1] + 1, 0))
        row[1:] = np.maximum.accumulate(here)
    return front + back + int(row[-1])


def _extension(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """(words, matches) by which a diagonal can go on at a profit."""
    n = min(len(x), len(y))
    if n == 0:
        return 0, 0
    same = x[:n] == y[:n]
    gain = np.cumsum(np.where(same, 1.0, -MISS))
    best = int(gain.argmax())
    return (best + 1, int(same[: best + 1].sum())) if gain[best] > 0 else (0, 0)


def parts(x: np.ndarray, y: np.ndarray, rows: list[list[int]]) -> list[tuple[int, int, int, int, int]]:
    """The alignments of a chain, or of its parts where the whole is below ``IDENTITY``.

    A part is extended up to its neighbours only, so that what they share isn't counted twice.
    """
    runs = np.array([int((x[r[0] : r[1]] == y[r[2] : r[3]]).sum()) for r in rows])
    gaps = np.array([_common(x[p[1] : r[0]], y[p[3] : r[2]]) for p, r in zip(rows[:-1], rows[1:], strict=True)], np.int64)
    length = np.array([max(r[0] - p[1], r[2] - p[3]) for p, r in zip(rows[:-1], rows[1:], strict=True)])
    # a longer gap of which less than a third matches is foreign text, however good the rest is
    foreign = (np.flatnonzero((length >= MIN_RANGE) & (3 * gaps < length)) + 1).tolist()
    out, open_ = [], list(zip([0, *foreign], [*foreign, len(rows)], strict=True))[::-1]
    while open_:
        lo, hi = open_.pop()
        x_from, y_from = (rows[lo - 1][1], rows[lo - 1][3]) if lo else (0, 0)
        x_to, y_to = (rows[hi][0], rows[hi][2]) if hi < len(rows) else (len(x), len(y))
        left, found = _extension(x[x_from : rows[lo][0]][::-1], y[y_from : rows[lo][2]][::-1])
        right, more = _extension(x[rows[hi - 1][1] : x_to], y[rows[hi - 1][3] : y_to])
        n = int(runs[lo:hi].sum() + gaps[lo : hi - 1].sum()) + found + more
        x0, x1, y0, y1 = rows[lo][0] - left, rows[hi - 1][1] + right, rows[lo][2] - left, rows[hi - 1][3] + right
        if min(x1 - x0, y1 - y0) < MIN_RANGE:
            continue
        if n >= IDENTITY * max(x1 - x0, y1 - y0):
            out.append((x0, x1, y0, y1, n))
        elif hi - lo > 1:
            cut = lo + 1 + int(length[lo : hi - 1].argmax())
            open_ += [(cut, hi), (lo, cut)]
    return out


def _align(batches):
    for batch in batches:
        out: list[list] = [[], [], [], [], [], [], [], []]
        named = {name: batch.column(name) for name in batch.schema.names}
        plain = {k: named[k].to_pylist() for k in ("doc", "leader", "lo", "leader_lo")}
        for i in range(batch.num_rows):
            x, y = named["x"][i].values.to_numpy(), named["y"][i].values.to_numpy()
            rows = named["segments"][i].values.to_numpy().astype(np.int64).reshape(-1, 4) - np.array([plain["lo"][i]] * 2 + [plain["leader_lo"][i]] * 2)
            if rows[-1, 1] > len(x) or rows[-1, 3] > len(y):
                continue  # another text under the same id
            for x0, x1, y0, y1, n in parts(x, y, rows.tolist()):
                for column, value in zip(out, (plain["doc"][i], plain["leader"][i], x0 + plain["lo"][i], x1 + plain["lo"][i], y0 + plain["leader_lo"][i], y1 + plain["leader_lo"][i], n, n / max(x1 - x0, y1 - y0)), strict=True):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
        names = ["doc", "leader", "first", "past", "leader_first", "leader_past", "matches", "identity"]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names)


def _around(batches):
    """The words before (backwards) and behind each place, ``AROUND`` of each in 4 bytes; 0 where the text ends."""
    for batch in batches:
        for lo, hi, h, at, _ in K.hashed_words(batch.column(1)):
            word = (h >> np.uint64(32)).astype(np.uint32).view(np.int32)
            places = batch.column(2).slice(lo, hi - lo)
            sizes = places.value_lengths().to_numpy()
            flat = places.flatten()
            seed, pos, size = flat.field(0), flat.field(1).to_numpy(), flat.field(2)
            own = np.repeat(np.arange(hi - lo), sizes)
            first, past = at[own], at[own + 1]
            known = pos + K_WORDS <= past - first  # else another text under the same id
            seed, size, pos, own, first, past = seed.filter(pa.array(known)), size.filter(pa.array(known)), pos[known], own[known], first[known], past[known]
            step = np.arange(AROUND)
            sides = []
            for where in ((first + pos - 1)[:, None] - step, (first + pos + K_WORDS)[:, None] + step):
                inside = (where >= first[:, None]) & (where < past[:, None])
                value = np.where(inside, word[np.where(inside, where, 0)] if len(word) else 0, 0).astype(np.int32)
                ends = np.arange(len(pos) + 1, dtype=np.int32) * 4 * AROUND
                sides.append(pa.BinaryArray.from_buffers(pa.binary(), len(pos), [None, pa.py_buffer(ends), pa.py_buffer(value.tobytes())]))
            docs = batch.column(0).slice(lo, hi - lo).take(pa.array(own)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([seed, size, docs, pa.array(pos, pa.int32()), *sides], ["seed", "n", "doc", "pos", "before", "behind"])


def _reach(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Words by which each row can go on at a profit, as ``_extension`` does."""
    gain = np.cumsum(np.where((x == y) & (x != 0), 1.0, -MISS), 1)
    best = gain.argmax(1)
    return np.where(gain[np.arange(len(x)), best] > 0, best + 1, 0)


def _near(batches):
    """Pairs of neighbours that share ``MIN_RANGE`` words on the diagonal of their seed."""
    for batch in batches:
        named = {name: batch.column(name) for name in batch.schema.names}
        rows = lambda name: np.frombuffer(b"".join(named[name].to_pylist()), np.int32).reshape(-1, AROUND)  # noqa: B023, E731
        if not batch.num_rows:
            continue
        n = K_WORDS + _reach(rows("before"), rows("other_before")) + _reach(rows("behind"), rows("other_behind"))
        doc, other, pos, other_pos = (named[k].to_numpy() for k in ("doc", "other", "pos", "other_pos"))
        last = doc > other  # the smaller document leads
        columns = [np.where(last, doc, other), np.where(last, other, doc), np.where(last, pos, other_pos), np.where(last, other_pos, pos)]
        yield pa.RecordBatch.from_arrays([pa.array(x[n >= MIN_RANGE]) for x in columns], ["doc", "leader", "pos", "leader_pos"])


def _near_pairs(rows: pa.Table):
    """What ``_near`` finds in all orders of whole seeds."""
    seed, doc, pos = (rows.column(k).to_numpy() for k in ("seed", "doc", "pos"))
    base = np.lexsort((pos, doc, seed))  # the orders are stable, so that ties are by doc and pos
    seed, doc, pos = seed[base], doc[base], pos[base]
    sides = [np.frombuffer(b"".join(rows.column(k).to_pylist()), np.int32).reshape(-1, AROUND)[base] for k in ("before", "behind")]
    rank = np.cumsum(np.append(0, seed[1:] != seed[:-1])).astype(">u4").view(np.int32)[:, None]
    pairs = []
    for words in sides:
        for skip in SKIPS:
            key = np.ascontiguousarray(np.hstack([rank, words[:, skip:]]))
            order = np.argsort(key.view(f"S{key.shape[1] * 4}")[:, 0], kind="stable")
            z, i = order[:-1], order[1:]
            ok = (seed[z] == seed[i]) & (doc[z] != doc[i]) & (words[z, skip : skip + 2] == words[i, skip : skip + 2]).all(1)
            pairs.append(np.minimum(z, i)[ok] * len(seed) + np.maximum(z, i)[ok])
    lead, other = np.divmod(np.unique(np.concatenate(pairs)), len(seed))  # by doc within a seed, so the first leads
    if len(lead):
        before, behind = sides
        n = K_WORDS + _reach(before[other], before[lead]) + _reach(behind[other], behind[lead])
        lead, other = lead[n >= MIN_RANGE], other[n >= MIN_RANGE]
    columns = [doc[other], doc[lead], pos[other], pos[lead]]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["doc", "leader", "pos", "leader_pos"])


def _near_sorted(batches):
    """``_near_pairs`` of rows that come sorted by seed; some ``AT_ONCE`` and one seed are held."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < AT_ONCE:
            continue
        rows = pa.Table.from_batches(held)
        seed = rows.column("seed").to_numpy()
        whole = int(np.argmax(seed == seed[-1]))
        if whole:
            yield _near_pairs(rows.slice(0, whole))
        held, size = rows.slice(whole).combine_chunks().to_batches(), len(seed) - whole
    if size:
        yield _near_pairs(pa.Table.from_batches(held))


def crossed(places: DataFrame) -> DataFrame:
    """(doc, leader, pos, leader_pos): all pairs of places of a seed but those with its first place."""
    lists = places.groupBy("seed").agg(F.sort_array(F.collect_list(F.struct("doc", "pos"))).alias("m"))
    one = lists.select("m", F.posexplode("m").alias("i", "x")).where("i > 1")
    two = one.select("x", F.explode(F.slice("m", F.lit(2), F.col("i") - 1)).alias("y")).where("x.doc <> y.doc")
    return two.select(F.col("x.doc").alias("doc"), F.col("y.doc").alias("leader"), F.col("x.pos").alias("pos"), F.col("y.pos").alias("leader_pos"))


def neighbours(places: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc, leader, pos, leader_pos): places of a seed that are next to each other by the words around."""
    by_doc = places.groupBy("doc").agg(F.collect_list(F.struct("seed", "pos", "n")).alias("places"))
    texts = docs.join(by_doc, docs.doc_id == by_doc.doc).select("doc_id", "text", "places")
    around = stored(texts.mapInArrow(_around, "seed long, n long, doc long, pos int, before binary, behind binary"), "around")
    pairs = "doc long, leader long, pos int, leader_pos int"
    dealt = around.where(F.col("n") <= MANY).drop("n").repartition("seed").sortWithinPartitions("seed")
    found = [stored(dealt.mapInArrow(_near_sorted, pairs), "neighbours")]
    many = around.where(F.col("n") > MANY)
    if not many.isEmpty():
        found += _ordered(many, pairs)
    out = stored(reduce(DataFrame.unionByName, found).distinct(), "neighbour-pairs")
    forget(around, *found)
    return out


def _ordered(around: DataFrame, schema: str) -> list[DataFrame]:
    """Pairs of neighbours of seeds with any number of places, one table for each order."""
    found = []
    for side in ("before", "behind"):
        for skip in SKIPS:
            # written one by one, so that the shuffle files of one order are there at a time
            order = Window.partitionBy("seed").orderBy(F.expr(f"substring({side}, {4 * skip + 1})"), "doc", "pos")
            ahead = around.withColumn("z", F.lag(F.struct("doc", "pos", "before", "behind")).over(order)).where("z.doc <> doc")
            # a run of two words on the side that is sorted by, else nothing goes on there
            ahead = ahead.where(F.expr(f"substring({side}, {4 * skip + 1}, 8) = substring(z.{side}, {4 * skip + 1}, 8)"))
            pairs = ahead.select("doc", "pos", "before", "behind", *[F.col(f"z.{k}").alias(v) for k, v in (("doc", "other"), ("pos", "other_pos"), ("before", "other_before"), ("behind", "other_behind"))])
            found.append(stored(pairs.mapInArrow(_near, schema), "neighbours"))
    return found


def alignments(docs: DataFrame) -> DataFrame:
    """(doc, leader, first, past, leader_first, leader_past, matches, identity), in words."""
    K.small_batches(docs.sparkSession)
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seeds = docs.mapInArrow(_seeds, "doc long, seed long, pos int")
    shared = seeds.groupBy("seed").agg(F.min("doc").alias("leader"), F.max("doc").alias("last")).where("leader <> last").select("seed", "leader")
    # written first: a join can only split a hot seed if its sides come straight from their exchanges
    shared = stored(shared, "shared-seeds")
    matched = stored(seeds.join(shared, "seed"), "seeds")
    forget(shared)
    # the leader's first place of a seed; a seed repeated inside the leader is one place
    head = stored(matched.where("doc = leader").groupBy("seed").agg(F.min("pos").alias("leader_pos")), "leader-seeds")
    led = matched.where("doc <> leader").join(head, "seed").select("doc", "leader", "pos", "leader_pos")
    # copies of a text have the matches of the first of them
    firsts = docs.groupBy(F.xxhash64("text"), F.length("text")).agg(F.min("doc_id").alias("doc")).select("doc").distinct()
    places = matched.join(firsts, "doc", "left_semi").select("seed", "doc", "pos")
    sizes = places.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("least"), F.max("doc").alias("most")).where("n > 2 AND least <> most").select("seed", "n")
    places = stored(places.join(sizes, "seed"), "seed-places")
    near = neighbours(places.where(F.col("n") > CROWD), docs)
    pairs = led.unionByName(crossed(places.where(F.col("n") <= CROWD))).unionByName(near).groupBy("doc", "leader").agg(F.collect_list(F.struct("pos", "leader_pos")).alias("m"))
    pairs = pairs.select("doc", "leader", F.col("m.pos").alias("a"), F.col("m.leader_pos").alias("b"))
    found = pairs.mapInArrow(_chain, "doc long, leader long, lo int, hi int, leader_lo int, leader_hi int, segments array<int>")
    found = stored(found, "chains")
    forget(matched, head, places, near)
    ids = stored(found.select(F.col("doc").alias("id")).unionByName(found.select(F.col("leader").alias("id"))).distinct(), "chain-ids")
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.join(side, docs.doc_id == side.id, "left_semi")
    words = stored(texts.mapInArrow(_words, "doc long, words array<int>").dropDuplicates(["doc"]), "chain-words")
    one = found.join(words, "doc").withColumn("x", F.slice("words", F.col("lo") + 1, F.col("hi") - F.col("lo"))).drop("words")
    two = one.join(words.withColumnRenamed("doc", "leader"), "leader").withColumn("y", F.slice("words", F.col("leader_lo") + 1, F.col("leader_hi") - F.col("leader_lo")))
    ready = two.select("doc", "leader", "lo", "leader_lo", "segments", "x", "y")
    return ready.mapInArrow(_align, "doc long, leader long, first int, past int, leader_first int, leader_past int, matches int, identity double")


def passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, first_word, past_word, n_words, other_id): repeated passages.

    ``other_id`` is the smallest document known to share a part of it; word
    ranges are half open.
    """
    found = stored(alignments(docs), "alignments")
    ours = found.select("doc", "first", "past", F.col("leader").alias("other"))
    theirs = found.select(F.col("leader").alias("doc"), F.col("leader_first").alias("first"), F.col("leader_past").alias("past"), F.col("doc").alias("other"))
    # one row for each first word: a document has no more rows than words
    starts = ours.unionByName(theirs).groupBy("doc", "first").agg(F.max("past").alias("past"), F.min("other").alias("other"))
    order = Window.partitionBy("doc").orderBy("first")
    reach = F.max("past").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = starts.withColumn("new", F.when(F.col("first") < reach + WINDOW, 0).otherwise(1))
    marked = marked.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = marked.groupBy("doc", "island").agg(F.min("first").alias("first_word"), F.max("past").alias("past_word"), F.min("other").alias("other_id"))
    sized = merged.select(F.col("doc").alias("doc_id"), "first_word", "past_word", (F.col("past_word") - F.col("first_word")).alias("n_words"), "other_id")
    return sized.where(F.col("n_words") >= min_words)


def query(docs: DataFrame) -> DataFrame:
    return passages(docs)
