"""Byte-level BPE without pre-tokenisation, special tokens, framing, usage.

Training needs one global argmax for each merge, so it runs in one place (the
driver or one task) on a bounded training corpus; encoding and decoding run
distributed, with the merges broadcast.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import sys
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.functions.text import SPECIALS, length_bucket
from quernel.session import small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WIDE = 1 << 32


def _spots(tokens: np.ndarray, left: int, right: int) -> np.ndarray:
    """Places of a pair, from left to right and without overlaps."""
    at = np.flatnonzero((tokens[:-1] == left) & (tokens[1:] == right))
    if left == right and len(at) > 1:
        # in a run, every second one counts from the run's start
        runs = np.flatnonzero(np.append(True, np.diff(at) > 1))
        at = at[(np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))) % 2 == 0]
    return at


def _merge(tokens: np.ndarray, at: np.ndarray, new: int) -> np.ndarray:
    keep = np.ones(len(tokens), bool)
    keep[at + 1] = False
    out = tokens.copy()
    out[at] = new
    return out[keep]


def _pairs(tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.unique(at[(at >= 0) & (at < len(tokens) - 1)])
    a, b = tokens[at], tokens[at + 1]
    ok = (a >= 0) & (b >= 0)
    return np.unique(a[ok] * _WIDE + b[ok], return_counts=True)


def train_merges(documents: Iterable[bytes], vocabulary: int, min_count: int = 2) -> list[tuple[int, int]]:
    """Merges by count, ties to the smaller pair, until the vocabulary is full.

    Counts are of adjacent pairs, overlapping ones included; they are kept up
    to date around the places of each merge.
    """
    parts = []
    for document in documents:
        parts += [np.frombuffer(document, np.uint8).astype(np.int64), np.array([-1])]
    tokens = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    keys, n = _pairs(tokens, np.arange(len(tokens)))
    counts = dict(zip(keys.tolist(), n.tolist(), strict=True))
    heap = [(-c, k) for k, c in counts.items()]
    heapq.heapify(heap)
    merges: list[tuple[int, int]] = []
    while heap and len(merges) < vocabulary - 256:
        count, key = heapq.heappop(heap)
        if counts.get(key, 0) != -count:
            continue
        if -count < min_count:
            break
        left, right = divmod(key, _WIDE)
        new = 256 + len(merges)
        at = _spots(tokens, left, right)
        before = _pairs(tokens, np.concatenate([at - 1, at, at + 1]))
        tokens = _merge(tokens, at, new)
        placed = at - np.arange(len(at))
        after = _pairs(tokens, np.concatenate([placed - 1, placed]))
        changed = set()
        for (ks, ns), sign in ((before, -1), (after, 1)):
            for k, c in zip(ks.tolist(), ns.tolist(), strict=True):
                counts[k] = counts.get(k, 0) + sign * c
                changed.add(k)
        for k in changed:
            if counts[k] > 0:
                heapq.heappush(heap, (-counts[k], k))
            else:
                del counts[k]
        merges.append((left, right))
    return merges


@dataclass
class Tokenizer:
    """256 bytes, merges, and special tokens as the last ids."""

    merges: list[tuple[int, int]]
    size: int
    specials: tuple[str, ...] = SPECIALS
    vocabulary: list[bytes] = field(init=False)

    def __post_init__(self) -> None:
        if len(set(self.specials)) != len(self.specials) or not all(self.specials):
            raise ValueError("special tokens must be distinct and not empty")
        if any(normal(t) != t for t in self.specials):
            raise ValueError("special tokens must be in normal form")
        if 256 + len(self.merges) > self.size - len(self.specials):
            raise ValueError("the vocabulary has no room for the special tokens")
        if len(set(map(tuple, self.merges))) != len(self.merges):
            raise ValueError("a pair is merged twice")
        self.vocabulary = [bytes([i]) for i in range(256)]
        for left, right in self.merges:
            if max(left, right) >= len(self.vocabulary):
                raise ValueError("a merge uses an id that doesn't exist yet")
            self.vocabulary.append(self.vocabulary[left] + self.vocabulary[right])
        keys = np.array([a * _WIDE + b for a, b in self.merges], np.int64)
        self._order = np.argsort(keys)
        self._keys = keys[self._order]

    @classmethod
    def train(cls, texts: Iterable[str], size: int, min_count: int = 2, specials: tuple[str, ...] = SPECIALS) -> Tokenizer:
        return cls(train_merges((normal(t).encode() for t in texts), size - len(specials), min_count), size, specials)

    def special_id(self, token: str) -> int:
        return self.size - len(self.specials) + self.specials.index(token)

    def encode_bytes(self, data: bytes) -> list[int]:
        """Lowest rank first; within a rank, from left to right."""
        tokens = np.frombuffer(data, np.uint8).astype(np.int64)
        while len(tokens) > 1 and len(self._keys):
            pairs = tokens[:-1] * _WIDE + tokens[1:]
            at = np.minimum(np.searchsorted(self._keys, pairs), len(self._keys) - 1)
            ranks = np.where(self._keys[at] == pairs, self._order[at], len(self.merges))
            rank = int(ranks.min())
            if rank == len(self.merges):
                break
            tokens = _merge(tokens, _spots(tokens, *self.merges[rank]), 256 + rank)
        return tokens.tolist()

    def encode(self, text: str, parse_special: bool = False) -> list[int]:
        text = normal(text)
        if not parse_special:
            return self.encode_bytes(text.encode())
        out, start = [], 0
        longest = sorted(self.specials, key=len, reverse=True)
        while start < len(text):
            spots = [(p, -len(s), s) for s in longest if (p := text.find(s, start)) >= 0]
            if not spots:
                break
            place, _, literal = min(spots)
            out += self.encode_bytes(text[start:place].encode()) + [self.special_id(literal)]
            start = place + len(literal)
        return out + self.encode_bytes(text[start:].encode())

    def encode_document(self, text: str) -> list[int]:
        """<bos> content <eos>; literals of special tokens in a text stay plain text."""
        return [self.special_id("<|bos|>"), *self.encode(text), self.special_id("<|eos|>")]

    def decode(self, ids: Sequence[int], skip_special: bool = False) -> str:
        first, parts = self.size - len(self.specials), []
        for i in ids:
            if first <= i < self.size:
                if not skip_special:
                    parts.append(self.specials[i - first].encode())
            elif 0 <= i < len(self.vocabulary):
                parts.append(self.vocabulary[i])
            else:
                raise ValueError(f"id {i} isn't assigned")
        return b"".join(parts).decode("utf-8", "strict")

    def to_json(self) -> str:
        rows = [[a, b, 256 + i] for i, (a, b) in enumerate(self.merges)]
        return json.dumps({"version": 1, "size": self.size, "specials": list(self.specials), "merges": rows}, ensure_ascii=False)

    def digest(self) -> str:
        """The identity of a tokenizer: a digest of its whole state."""
        return hashlib.sha256(json.dumps(json.loads(self.to_json()), sort_keys=True).encode()).hexdigest()

    def save(self, folder: str, report: dict | None = None) -> None:
        """The artifacts: tokenizer, config, vocabulary, merges and training report, each readable alone."""
        os.makedirs(folder, exist_ok=True)
        vocabulary = [{"id": i, "hex": v.hex()} for i, v in enumerate(self.vocabulary)] + [{"id": self.special_id(t), "special": t} for t in self.specials]
        files = {
            "tokenizer.json": self.to_json(),
            "config.json": json.dumps({"size": self.size, "merges": len(self.merges), "specials": list(self.specials), "sha256": self.digest()}),
            "vocab.json": json.dumps(vocabulary),
            "merges.json": json.dumps([[a, b, 256 + i] for i, (a, b) in enumerate(self.merges)]),
            "training_report.json": json.dumps(report or {}),
        }
        for name, content in files.items():
            with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
                f.write(content)
        if Tokenizer.load(folder) != self:
            raise ValueError(f"{folder} doesn't give back what was saved")

    @classmethod
    def load(cls, folder: str) -> Tokenizer:
        with open(f"{folder}/tokenizer.json", encoding="utf-8") as f:
            return cls.from_json(f.read())

    def id_to_token(self, i: int) -> bytes | str:
        first = self.size - len(self.specials)
        if not 0 <= i < self.size or len(self.vocabulary) <= i < first:
            raise ValueError(f"id {i} isn't assigned")
        return self.specials[i - first] if i >= first else self.vocabulary[i]

    def decode_document(self, ids: Sequence[int]) -> str:
        """The text of a framed document; anything else than <bos> content <eos> is an error."""
        first = self.size - len(self.specials)
        if len(ids) < 2 or ids[0] != self.special_id("<|bos|>") or ids[-1] != self.special_id("<|eos|>"):
            raise ValueError("a document starts with <|bos|> and ends with <|eos|>")
        if any(i >= first for i in ids[1:-1]):
            raise ValueError("a special token inside a document")
        return self.decode(ids[1:-1])

    @classmethod
    def from_json(cls, payload: str) -> Tokenizer:
        state = json.loads(payload)
        if [r[2] for r in state["merges"]] != list(range(256, 256 + len(state["merges"]))):
            raise ValueError("ids of merges aren't contiguous")
        return cls([(a, b) for a, b, _ in state["merges"]], state["size"], tuple(state["specials"]))


def normal(text: str) -> str:
    return unicodedata.normalize("NFC", text).replace("\r\n", "\n").replace("\r", "\n")


#: Different segments that a task remembers, and bytes of text that it cuts at once.
REMEMBERED, PIECE = 200_000, 1 << 20


class _Segments(dict):
    """Numbers of segments; new ones are listed."""

    def __init__(self) -> None:
        self.fresh: list[bytes] = []

    def __missing__(self, segment: bytes) -> int:
        self[segment] = number = len(self)
        self.fresh.append(segment)
        return number


class BatchEncoder:
    """``Tokenizer.encode`` for many texts at once.

    No token reaches over two neighbouring bytes that are neighbours in no
    piece of the vocabulary. Texts are cut there, and each different segment is
    encoded once; segments that are new are merged together, each by its own
    lowest rank, as one text would be.
    """

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.merges = np.array(tokenizer.merges, np.int64).reshape(-1, 2)
        self.keys, self.order = tokenizer._keys, tokenizer._order
        self.joined = np.zeros(1 << 16, bool)
        for piece in tokenizer.vocabulary:
            raw = np.frombuffer(piece, np.uint8).astype(np.int64)
            self.joined[raw[:-1] * 256 + raw[1:]] = True
        self.forget()

    def forget(self) -> None:
        self.numbers = _Segments()
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _merged(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all segments in order, and how many each has."""
        none = len(self.merges)
        ids = np.frombuffer(b"".join(segments), np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(segments)), [len(x) for x in segments])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            keys = ids[:-1] * _WIDE + ids[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), max(none - 1, 0))
            ranks = np.full(len(ids), none)
            if none:
                ranks[:-1] = np.where((self.keys[at] == keys) & (owner[:-1] == owner[1:]), self.order[at], none)
            firsts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.repeat(np.minimum.reduceat(ranks, firsts), np.diff(np.append(firsts, len(ids))))
            over = lowest == none
            if over.any():
                done.append((owner[over], ids[over]))
                owner, ids, ranks, lowest = owner[~over], ids[~over], ranks[~over], lowest[~over]
            spots = np.flatnonzero(ranks == lowest)
            if len(spots) > 1:
                # of equal tokens in a row, every second pair from the row's start
                runs = np.flatnonzero(np.append(True, np.diff(spots) > 1))
                spots = spots[(np.arange(len(spots)) - np.repeat(runs, np.diff(np.append(runs, len(spots))))) % 2 == 0]
            keep = np.ones(len(ids), bool)
            keep[spots + 1] = False
            ids[spots] = 256 + ranks[spots]
            owner, ids = owner[keep], ids[keep]
        owners, tokens = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        back = np.argsort(owners, kind="stable")
        return tokens[back].astype(np.int32), np.bincount(owners, minlength=len(segments))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts in order, and how many each has."""
        parts, sizes, lo = [], [], 0
        while lo < len(texts):
            hi, room = lo, PIECE
            while hi < len(texts) and (hi == lo or len(texts[hi]) <= room):
                room -= len(texts[hi])
                hi += 1
            part, size = self._encode(texts[lo:hi])
            parts.append(part)
            sizes.append(size)
            lo = hi
        return (np.concatenate(parts), np.concatenate(sizes)) if parts else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw = b"".join(texts)
        data = np.frombuffer(raw, np.uint8)
        if not len(self.merges):
            return data.astype(np.int32), np.array([len(x) for x in texts], np.int64)
        if len(self.numbers) > REMEMBERED:
            self.forget()
        ends = np.cumsum([len(x) for x in texts])
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = ~self.joined[data[:-1].astype(np.int64) * 256 + data[1:]]
        cut[ends] = True
        cut[0] = False
        cuts = np.flatnonzero(cut)
        places, numbers = cuts.tolist(), self.numbers
        which = np.fromiter((numbers[raw[a:b]] for a, b in zip([0, *places[:-1]], places, strict=True)), np.int64, len(places))
        if numbers.fresh:
            flat, sizes = self._merged(numbers.fresh)
            numbers.fresh.clear()
            self.flat = np.concatenate([self.flat, flat])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        return gathered(self.flat, self.starts[which], self.starts[which + 1] - self.starts[which], np.searchsorted(cuts, ends, "right"))


def gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices of ``flat`` one after the other, and their sizes summed for groups of slices that end at ``ends``."""
    past = np.cumsum(size)
    out = flat[np.arange(past[-1] if len(past) else 0) + np.repeat(first - past + size, size)]
    sums = np.append(0, past)[ends]
    return out, np.diff(np.append(0, sums))


def encoder(spark, tokenizer: Tokenizer, framed: bool = True):
    """A vectorised function text -> array<int>, in Arrow throughout."""
    small_batches(spark)
    # as JSON: executors need no copy of this package to read it
    shared = spark.sparkContext.broadcast(tokenizer.to_json())

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t = Tokenizer.from_json(shared.value)
        batch_encoder = BatchEncoder(t)
        for texts in batches:
            ids, sizes = batch_encoder.encode([normal(x).encode() if x else b"" for x in texts.to_pylist()])
            if framed:
                own = np.repeat(np.arange(len(sizes)), sizes)
                framed_ids = np.empty(len(ids) + 2 * len(sizes), np.int32)
                framed_ids[np.arange(len(ids)) + 2 * own + 1] = ids
                sizes = sizes + 2
                framed_ids[np.cumsum(sizes) - sizes] = t.special_id("<|bos|>")
                framed_ids[np.cumsum(sizes) - 1] = t.special_id("<|eos|>")
                ids = framed_ids
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            if texts.null_count:
                lost = texts.is_null()
                sizes = np.where(lost.to_numpy(zero_copy_only=False), 0, sizes)
                ids = ids[np.repeat(~lost.to_numpy(zero_copy_only=False), np.diff(offsets))]
                yield pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), pa.array(ids, pa.int32()), mask=lost)
            else:
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))

    return encode


def decoder(spark, tokenizer: Tokenizer, skip_special: bool = True):
    """A vectorised function array<int> -> text; an id that isn't assigned and bytes that are no UTF-8 are errors."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(tokenizer.to_json())

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t = Tokenizer.from_json(shared.value)
        gap = t.size - len(t.specials) - len(t.vocabulary)
        pieces = [*t.vocabulary, *[b""] * gap, *[b"" if skip_special else x.encode() for x in t.specials]]
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        length = np.array([len(x) for x in pieces], np.int64)
        start = np.cumsum(length) - length
        for lists in batches:
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            wrong = (ids < 0) | (ids >= t.size) | ((ids >= len(t.vocabulary)) & (ids < t.size - len(t.specials)))
            if wrong.any():
                raise ValueError(f"id {ids[wrong][0]} isn't assigned")
            count = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()], np.int64)
            raw, sizes = gathered(flat, start[ids], length[ids], np.cumsum(count))
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            valid = pa.array(lists.is_valid()).buffers()[1] if lists.null_count else None
            out = pa.StringArray.from_buffers(len(lists), pa.py_buffer(offsets), pa.py_buffer(raw), valid)
            out.validate(full=True)
            yield out

    return decode


def well_framed(ids: Column, tokenizer: Tokenizer) -> Column:
    """<bos> first, <eos> last, no special token between."""
    first = tokenizer.size - len(tokenizer.specials)
    inner = F.slice(ids, 2, F.greatest(F.size(ids) - 2, F.lit(0)))
    return (F.get(ids, F.lit(0)) == tokenizer.special_id("<|bos|>")) & (F.element_at(ids, -1) == tokenizer.special_id("<|eos|>")) & (F.size(ids) >= 2) & F.forall(inner, lambda x: (x >= 0) & (x < first))


def _count_pairs(batches):
    """Neighbouring bytes of all texts of a task, in one table of 65,536 places."""
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        column = batch.column(0).cast(pa.large_binary())
        _, ends, data = column.buffers()
        ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
        if len(raw) > 1:
            pair = raw[:-1].astype(np.int64) * 256 + raw[1:]
            inside = np.ones(len(pair), bool)
            cuts = ends[1:-1] - ends[0] - 1
            inside[cuts[(cuts >= 0) & (cuts < len(pair))]] = False
            total += np.bincount(pair[inside], minlength=1 << 16)
    own = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(own // 256), pa.array(own % 256), pa.array(total[own])], ["left_byte", "right_byte", "n"])


def byte_pair_counts(docs: DataFrame) -> DataFrame:
    """(left_byte, right_byte, n) of neighbouring bytes; a task gives one row for each pair at most."""
    parts = docs.where("text IS NOT NULL").select("text").mapInArrow(_count_pairs, "left_byte long, right_byte long, n long")
    return parts.groupBy("left_byte", "right_byte").agg(F.sum("n").alias("n"))


def usage(encoded: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(id, kind, byte_length, bucket, n) of the ids that occur in column ``ids``."""
    first = tokenizer.size - len(tokenizer.specials)
    sizes = [len(v) for v in tokenizer.vocabulary]
    counts = encoded.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    kind = F.when(F.col("id") >= first, "special").when(F.col("id") < 256, "byte").when(F.col("id") < len(sizes), "bpe").otherwise("unassigned")
    vocabulary = encoded.sparkSession.createDataFrame(list(enumerate(sizes)), "id int, byte_length int")
    out = counts.join(vocabulary, "id", "left").withColumn("kind", kind)
    return out.select("id", "kind", "byte_length", length_bucket(F.col("byte_length")).alias("bucket"), "n")


def compression(encoded: DataFrame, category: str) -> DataFrame:
    """Per category, and for all as null: documents, bytes, tokens, bytes a token, round trips that hold.

    ``encoded`` has ``text``, ``ids`` (unframed) and ``back``, the decoded text.
    """
    size = F.size("ids").cast("long")
    return encoded.rollup(category).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(F.octet_length("text")).cast("long").alias("utf8_bytes"),
        F.sum(size).alias("tokens"),
        F.round(F.try_divide(F.sum(F.octet_length("text")), F.sum(size)), 6).alias("bytes_per_token"),
        F.count_if(F.col("back") == F.col("text")).alias("round_trips"),
        F.bool_and(F.col("back") == F.col("text")).alias("all_round_trip"),
    )


def utilization(counts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Of ``usage``: ids used and unused of each kind, and the longest used piece."""
    known = {"byte": 256, "bpe": len(tokenizer.merges), "special": len(tokenizer.specials)}
    used = counts.groupBy("kind").agg(F.count(F.lit(1)).alias("used"), F.sum("n").alias("occurrences"), F.max(F.struct("byte_length", "n", (-F.col("id")).alias("id"))).alias("top"))
    return used.select("kind", "used", (F.element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), F.col("kind")) - F.col("used")).alias("unused"), "occurrences", "top.byte_length", (-F.col("top.id")).alias("longest_id"))
