"""LM scoring with a weighted backoff automaton over all repeated n-grams.

States are contexts, arcs are the n-grams that training texts repeat, and a
state's failure arc goes to the state of one word less at the cost of its
backoff weight. Counts cover all training documents, and every n-gram that
occurs ``LEAST`` times is an arc, whatever the size of the corpus: the arcs are
a written table that grows with the input.

A text is traversed once from left to right. The state after a token depends on
the last ``ORDER - 1`` tokens only, so all positions of a batch take their arcs
at once: with ``bo(c)`` the weight of the failure arc of state ``c`` (0 for a
context without arcs), each order adds to the logarithm of the order below

    an arc (c, w):    log p(w | c) - log p(w | c without its first word)
    a failure arc:    bo(c)

and an arc is worth the difference to the failure arc, so that both are values
of the n-gram's own key, and what the traversal accumulates is a sum.

The most frequent ``HOT`` arcs of each order (a bound on what is broadcast,
whatever the corpus) are in the automaton that the scan carries. Keys beyond
them leave the scan with the number of their row and meet the rest of the arcs
in a shuffle join, and so do rare words. This decides where a value is found,
never what it is.

An n-gram that repeats consists of n-grams that repeat, so a bitmap of the kept
keys of each order (``_sieve``) spares the counts of the next order and the
scan most keys without a value before they are shuffled. A bitmap has no false
negatives and at most ``SIEVE`` bits: with more keys than that it fills up and
spares less, and results don't change.

Smoothing is absolute discounting with backoff; unigrams are the add-half
estimates of the base model, so that all of them sum to one with an unknown
word. Tokens are words of A-Z-lowered texts and one end for each document.

``ORDER`` is 3, so states are contexts of up to two words and a failure arc
leads from two words to one, and from one to the root.

Defined cases: a null or empty text is just its end; a null ``doc_id`` is
training data; repeated rows count as often as they occur and get equal
scores; without training data every token has the probability of an unknown
word; other columns are ignored.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from quernel.llm import _kernels as K
from quernel.llm.toxicity import held_out
from quernel.session import forget, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER, DISCOUNT, FOLD = 3, 0.75, 1
#: Keys of each order that the scan carries: 24 bytes each, on the driver and in each worker.
HOT = 1_000_000
#: Occurrences from which an n-gram is in the model.
LEAST = 2
#: Bits of a bitmap of kept keys: ``SPARSE`` for each key, 2 ** ``SIEVE`` (64 MB) at most, made in 2 ** ``SLICES`` parts.
SPARSE, SIEVE, SLICES = 16, 29, 6
#: The token that ends each document; no word hashes are reserved, so it is one of 2 ** 64.
END = np.uint64(0x5EED5EED5EED5EED)
#: Counts that are told apart when the hot keys are chosen.
TOP = 1_000
#: Hashes that a counting task holds before it passes its sums on.
HELD = 4 << 20


def _tokens(column: pa.Array):
    """Token hashes of each text, its end included, with the text's place."""
    for lo, hi, h, at, _ in K.hashed_words(column):
        n = len(h) + hi - lo
        flat = np.empty(n, np.uint64)
        ends = at[1:] + np.arange(hi - lo)
        words = np.ones(n, bool)
        words[ends] = False
        flat[words], flat[ends] = h, END
        yield lo, hi, flat, ends


class _Sums:
    """Counts of 64-bit keys, summed as they come and bounded in memory.

    ``parts`` go along with a key that determines them.
    """

    def __init__(self, *names: str) -> None:
        self.names = names
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, keys: np.ndarray, *parts: np.ndarray) -> None:
        self.held.append((keys, *parts))
        self.size += len(keys)

    def take(self):
        if self.size:
            keys, *parts = (np.concatenate(x) for x in zip(*self.held, strict=True))
            self.held, self.size = [], 0
            if parts:
                order = np.argsort(keys)
                keys = keys[order]
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                n = np.diff(np.append(first, len(keys)))
                columns = [x[order[first]] for x in parts]
            else:
                own, n = np.unique(keys, return_counts=True)
                columns = [own]
            yield pa.RecordBatch.from_arrays([*[pa.array(x.view(np.int64)) for x in columns], pa.array(n.astype(np.int64))], [*self.names, "n"])


def _count_words(batches):
    sums = _Sums("key")
    for batch in batches:
        for _, _, flat, _ in _tokens(batch.column(0)):
            sums.add(flat)
            if sums.size > HELD:
                yield from sums.take()
    yield from sums.take()


def _levels(flat: np.ndarray, ends: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, contexts, suffixes, first tokens) of the n-grams of each order from 2.

    A key is a hash of the keys of the n-gram without its last and without its
    first word; no n-gram reaches over an end.
    """
    within = np.ones(len(flat), bool)
    within[ends] = False
    lower, within = flat, within[:-1]
    for _ in range(order - 1):
        keys = K.pair_hashes(lower)
        yield keys[within], lower[:-1][within], lower[1:][within], np.flatnonzero(within)
        lower, within = keys, within[:-1] & within[1:]


def _holds(sieve: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are in a bitmap: all that it was made of, and some others."""
    at = keys >> np.uint64(64 - (8 * len(sieve)).bit_length() + 1)
    return (sieve[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def _slices(bits: int) -> Callable:
    """Parts of a bitmap of 2 ** ``bits``, by the first bits of the keys in them."""

    def build(batches):
        own = 1 << (bits - SLICES)
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            for part in np.unique(at // np.uint64(own)).tolist():
                inside = at[at // np.uint64(own) == part] % np.uint64(own)
                parts.setdefault(part, np.zeros(own, bool))[inside] = True
        for part, held in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())], ["part", "bits"])

    return build


def _sieve(keys: DataFrame) -> np.ndarray:
    """A bitmap of the column ``key``, of bounded size."""
    bits = min(SIEVE, max(SLICES + 3, (SPARSE * keys.count()).bit_length()))
    # a part is made by one task, so that no task sends more than its parts
    dealt = keys.select("key").repartition(1 << SLICES, F.shiftrightunsigned("key", 64 - SLICES))
    sieve = np.zeros(1 << (bits - 3), np.uint8)
    own = len(sieve) >> SLICES
    parts = stored(dealt.mapInArrow(_slices(bits), "part int, bits binary"), "lm-sieve")
    found = parts.toArrow()
    forget(parts)
    for part, held in zip(found.column("part").to_pylist(), found.column("bits"), strict=True):
        sieve[part * own : (part + 1) * own] = np.frombuffer(held.as_buffer(), np.uint8)
    return sieve


def _gram_counter(order: int, shared) -> Callable:
    """Counts (context, suffix) of the n-grams of one order whose parts are in the bitmap of the order below."""

    def count(batches):
        sieve = shared.value
        sums = _Sums("ctx", "low")
        for batch in batches:
            for _, _, flat, ends in _tokens(batch.column(0)):
                *_, (keys, context, suffix, _) = _levels(flat, ends, order)
                at = np.flatnonzero(_holds(sieve, context))
                at = at[_holds(sieve, suffix[at])]
                sums.add(keys[at], context[at], suffix[at])
                if sums.size > HELD:
                    yield from sums.take()
        yield from sums.take()

    return count


def _with_keys(batches):
    for batch in batches:
        context, suffix = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
        key = K.pair_hashes(np.stack([context, suffix], 1).ravel())[::2]
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *batch.columns], ["key", "ctx", "low", "n"])


class Model:
    """What a scan needs: totals, and the values of hot keys.

    ``hot`` has for each order the sorted keys, their counts and their values;
    keys of order k are hot from ``least[k - 1]`` occurrences. ``sieves`` are the
    bitmaps of the kept keys of the orders from 2.
    """

    def __init__(self, total: int, vocabulary: int, least: list[int], hot: list[tuple[np.ndarray, np.ndarray, np.ndarray]], sieves: list[np.ndarray]) -> None:
        self.total, self.vocabulary, self.least, self.hot, self.sieves = total, vocabulary, least, hot, sieves
        self.denominator = total + 0.5 * (vocabulary + 1)


def _arrays(df: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bounded (key, n, value) table as arrays sorted by the unsigned key."""
    table = df.select("key", "n", "value").toArrow()
    keys = table.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], table.column("n").to_numpy()[order], table.column("value").to_numpy()[order]


def train(texts: DataFrame, order: int = ORDER, most: int = HOT) -> tuple[Model, DataFrame]:
    """(model, table (key, n, level, value) of all words and kept n-grams) from the column ``text``."""
    spark = texts.sparkSession
    K.small_batches(spark)
    texts = texts.select("text")
    parts = texts.mapInArrow(_count_words, "key long, n long")
    vocabulary = stored(parts.groupBy("key").agg(F.sum("n").alias("n")), "lm-words")
    sums: Row = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    denominator = sums.total + 0.5 * (sums.distinct + 1)
    # (key, n, p, gain) of the order below; gain is the value without the key's own backoff weight
    below = vocabulary.select("key", "n", ((F.col("n") + 0.5) / F.lit(denominator)).alias("p"), F.lit(0.0).alias("gain"))
    values, sieves, held = [], [], [vocabulary]
    for level in range(2, order + 1):
        repeated = below.where(F.col("n") >= LEAST)  # what an n-gram holds occurs as often as it does
        shared = spark.sparkContext.broadcast(sieves[-1] if sieves else _sieve(repeated))
        grams = texts.mapInArrow(_gram_counter(level, shared), "ctx long, low long, n long").groupBy("ctx", "low").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)
        # each table is written, so that the joins and sums on its hot contexts can be split
        grams = stored(grams.mapInArrow(_with_keys, "key long, ctx long, low long, n long"), "lm-grams")
        shared.destroy()
        joined = grams.join(repeated.select(F.col("key").alias("low"), F.col("p").alias("low_p")), "low").join(repeated.select(F.col("key").alias("ctx"), F.col("n").alias("ctx_n")), "ctx")
        joined = stored(joined.select("key", "ctx", "n", "low_p", ((F.col("n") - DISCOUNT) / F.col("ctx_n")).alias("p")), "lm-probabilities")
        forget(grams)
        left, under = (F.greatest(1 - F.sum(c), F.lit(1e-12)) for c in ("p", "low_p"))
        backoff = stored(joined.groupBy("ctx").agg(F.log10(left / under).alias("backoff")), "lm-backoff")
        values.append(stored(_valued(below, backoff, level - 1), "lm-values"))
        gain = F.log10("p") - F.log10("low_p") - F.col("backoff")
        below = stored(joined.join(backoff, "ctx").select("key", "n", "p", gain.alias("gain")), "lm-gains")
        forget(*held, joined, backoff)
        held = [below]
        sieves.append(_sieve(below))
    values.append(below.select("key", "n", F.lit(order).alias("level"), F.col("gain").alias("value")))
    every = reduce(DataFrame.unionByName, values)
    least = _hot_from(every, order, most)
    hot = [_arrays(every.where((F.col("level") == level) & (F.col("n") >= least[level - 1]))) for level in range(1, order + 1)]
    return Model(sums.total, sums.distinct, least, hot, sieves), every


def _hot_from(values: DataFrame, order: int, most: int) -> list[int]:
    """For each order the least count that at most ``most`` keys reach.

    Only counts up to ``TOP`` and one row for all above come to the driver.
    """
    counts = values.groupBy("level", F.least("n", F.lit(TOP)).alias("n")).agg(F.count(F.lit(1)).alias("keys")).collect()
    out = []
    for level in range(1, order + 1):
        held, least = 0, None
        for n, keys in sorted(((r.n, r["keys"]) for r in counts if r.level == level), reverse=True):
            if held + keys > most:
                break
            held, least = held + keys, n
        if least is None:  # more keys than fit are above TOP, or there are none
            share = values.where(F.col("level") == level).select(F.sum("n").alias("all")).first()[0] or 0
            least = max(TOP, -(-share // most))  # at most `most` keys can have that share of all
        out.append(least)
    return out


def _valued(rows: DataFrame, backoff: DataFrame, level: int) -> DataFrame:
    """(key, n, level, value): gains with the backoff weights that the keys have as contexts."""
    joined = rows.join(backoff.withColumnRenamed("ctx", "key"), "key", "left")
    return joined.select("key", "n", F.lit(level).alias("level"), (F.col("gain") + F.coalesce("backoff", F.lit(0.0))).alias("value"))


def _found(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is it in the sorted table, its place there) for each key."""
    if not len(table):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    order = np.argsort(keys)  # a search in order is several times faster
    at = np.empty(len(keys), np.int64)
    at[order] = np.minimum(np.searchsorted(table, keys[order]), len(table) - 1)
    return table[at] == keys, at


def _scorer(shared) -> Callable:
    """Rows of two kinds: one for each text, with what the scan found, and one for each key that it didn't."""

    def score(batches):
        denominator, ((words, counts, weights), *grams), sieves = shared.value
        logp = np.log10((counts + 0.5) / denominator)
        unknown = math.log10(0.5 / denominator)
        for batch in batches:
            for lo, hi, flat, ends in _tokens(batch.column(3)):
                size = np.diff(ends, prepend=-1)
                doc = np.repeat(np.arange(hi - lo), size)
                total = lambda at, x: np.bincount(doc[at], weights=x, minlength=hi - lo)  # noqa: B023, E731
                hot, at = _found(flat, words)
                known, base = total(hot, np.ones(int(hot.sum()))), total(hot, logp[at[hot]]) + total(~hot, np.full(int((~hot).sum()), unknown))
                gain = total(hot, weights[at[hot]])
                cold = [(flat[~hot], doc[~hot])]
                passed = np.ones(len(flat), bool)  # tokens with which an n-gram of the order below starts whose parts were kept
                for k, ((keys, _, _, first), (table, _, value), sieve) in enumerate(zip(_levels(flat, ends, 1 + len(grams)), grams, sieves, strict=True), 2):
                    if k > 2:  # else its parts are words
                        kept = passed[first] & passed[first + 1]
                        keys, first = keys[kept], first[kept]
                    kept = _holds(sieve, keys)
                    keys, first = keys[kept], first[kept]
                    passed[:] = False
                    passed[first] = True
                    hot, at = _found(keys, table)
                    gain += total(first[hot], value[at[hot]])
                    cold.append((keys[~hot], doc[first[~hot]]))
                # by level, as columns that hardly change are small in a shuffle
                events = [[], [], [], []]
                for level, (keys, owners) in enumerate(cold, 1):
                    order = np.lexsort((keys, owners))
                    keys, owners = keys[order], owners[order]
                    new = np.ones(len(keys), bool)
                    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
                    place = np.flatnonzero(new)
                    for column, x in zip(events, (keys[place], owners[place], np.full(len(place), level, np.int8), np.diff(np.append(place, len(keys)))), strict=True):
                        column.append(x)
                keys, owners, levels, times = (np.concatenate(x) for x in events)
                rows = batch.column(0).slice(lo, hi - lo).to_numpy()
                n, m = hi - lo, len(keys)
                found = lambda x, kind: pa.concat_arrays([pa.array(x, kind), pa.nulls(m, kind)])  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((rows, rows[owners]))),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(keys.view(np.int64))]),
                        pa.array(np.concatenate((np.zeros(n, np.int8), levels))),
                        pa.array(np.concatenate((np.ones(n, np.int32), times.astype(np.int32)))),
                        *[found(x, pa.int64()) for x in (size, known.astype(np.int64))],
                        *[found(x, pa.float64()) for x in (base, gain)],
                        *[pa.concat_arrays([batch.column(i).slice(lo, n), pa.nulls(m, batch.column(i).type)]) for i in (1, 2)],
                    ],
                    ["row", "key", "level", "times", "n_tokens", "n_known", "base", "gain", "doc_id", "held_out"],
                )

    return score


def score(docs: DataFrame, model: Model, values: DataFrame) -> DataFrame:
    """Scores of ``docs`` (doc_id, held_out, text) under a trained model.

    Keys without a value go before the sums: an n-gram that isn't in the model
    is worth nothing, and a word counts as unknown until its count is found.
    """
    spark = docs.sparkSession
    K.small_batches(spark)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    # plain arrays: executors need no copy of this package to read them
    shared = spark.sparkContext.broadcast((model.denominator, model.hot, model.sieves))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, key long, level byte, times int, n_tokens long, n_known long, base double, gain double, doc_id {kind}, held_out boolean"
    events = numbered.mapInArrow(_scorer(shared), schema)
    cold = None
    for level, least in enumerate(model.least, 1):
        part = values.where((F.col("level") == level) & (F.col("n") < least)).select(F.col("key").alias("cold_key"), F.col("level").cast("byte").alias("cold_level"), (F.col("n") if level == 1 else F.lit(LEAST).cast("long")).alias("n"), F.col("value").alias("worth"))
        cold = part if cold is None else cold.unionByName(part)
    # rows of texts have no key; they are spread by their number
    at = F.coalesce("key", "row")
    joined = events.join(cold, (at == F.col("cold_key")) & (F.col("level") == F.col("cold_level")), "left").where(F.col("key").isNull() | F.col("n").isNotNull())
    word = (F.col("level") == 1) & F.col("key").isNotNull()
    more = F.log10((F.col("n") + 0.5) / F.lit(float(model.denominator))) - F.log10(F.lit(0.5) / F.lit(float(model.denominator)))
    sums = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.when(word, F.col("times")).otherwise(F.coalesce("n_known", F.lit(0)))).cast("long").alias("n_known"),
        F.sum(F.when(word, F.col("times") * more).otherwise(F.coalesce("base", F.lit(0.0)))).alias("base"),
        F.sum(F.when(F.col("key").isNull(), F.col("gain")).otherwise(F.col("times") * F.col("worth"))).alias("gain"),
    )
    total = F.lit(int(model.total)).cast("long").alias("train_tokens")
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", total, F.col("base").alias("base_score"), (F.col("base") + F.col("gain")).alias("score"))


def query(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", held_out(F.col("doc_id"), FOLD).alias("held_out"), "text")
    model, values = train(rows.where("NOT held_out"))
    return score(rows, model, values)
