"""Token shards: flat little-endian uint16 files with a manifest, as a data source.

Writing is two-phase: tasks write parts to a staging folder, ``commit`` checks
and moves them and writes the manifest last, ``abort`` removes what was staged.
The folder must be one that driver and executors share.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import sys
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from quernel.session import parallel, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "quernel-token-shards"


@dataclass
class _Written(WriterCommitMessage):
    #: (index, tokens, sha256, staged file) of each shard that a task wrote.
    shards: list[tuple[int, int, str, str]]


@dataclass
class _Files(InputPartition):
    #: (path, first position, sha256) of neighbouring shards.
    files: list[tuple[str, int, str]]


class TokenShards(DataSource):
    """Columns position (long) and token (int); options path, split, vocabulary, tasks, and start and count of a range.

    Rows that are written may also hold runs of tokens: position and ids.
    """

    @classmethod
    def name(cls) -> str:
        return "tokenshards"

    def schema(self) -> str:
        return "position long, token int"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("vocabulary", 65536)), int(self.options.get("start", 0)), int(self.options.get("count", -1)), int(self.options.get("tasks", 0)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options.get("split", "train"), int(self.options.get("pershard", 1_000_000)), int(self.options.get("vocabulary", 65536)), overwrite)


class _Reader(DataSourceReader):
    def __init__(self, path: str, vocabulary: int, start: int, count: int, tasks: int) -> None:
        self.path, self.vocabulary, self.start, self.count, self.tasks = path, vocabulary, start, count, tasks

    def partitions(self):
        manifest = load_manifest(self.path)
        past = manifest["total_tokens"] if self.count < 0 else self.start + self.count
        if self.start < 0 or past > manifest["total_tokens"]:
            raise ValueError(f"{self.path} has no tokens from {self.start} to {past}")
        # the manifest says which shards a range needs; the others aren't opened
        files = [(f"{self.path}/{s['filename']}", s["token_start"], s["sha256"]) for s in manifest["shards"] if s["token_end"] > self.start and s["token_start"] < past]
        each = -(-len(files) // self.tasks) if self.tasks else 1
        return [_Files(files[i : i + each]) for i in range(0, len(files), max(1, each))]

    def read(self, part):
        """Tokens of a task's shards in order; one shard at a time is held."""
        import pyarrow as pa

        for path, start, sha256 in part.files:
            with open(path, "rb") as f:
                raw = f.read()
            if hashlib.sha256(raw).hexdigest() != sha256:
                raise ValueError(f"{path} differs from its manifest")
            ids = np.frombuffer(raw, "<u2")
            if len(ids) and ids.max() >= self.vocabulary:
                raise ValueError(f"{path} has a token outside the vocabulary")
            first = max(0, self.start - start)
            past = len(ids) if self.count < 0 else min(len(ids), self.start + self.count - start)
            for k in range(first, past, 100_000):
                piece = ids[k : min(past, k + 100_000)]
                yield pa.RecordBatch.from_arrays([pa.array(start + k + np.arange(len(piece))), pa.array(piece.astype(np.int32))], ["position", "token"])


def _runs(batches):
    """(first position, ids) of neighbouring tokens, from rows of a token or of a run of tokens."""
    import pyarrow as pa

    for b in batches:
        if not b.num_rows:
            continue
        places, ids = b.column(0).to_numpy(), b.column(1)
        sizes = np.ones(len(places), np.int64)
        if not pa.types.is_integer(ids.type):
            sizes = np.diff(ids.offsets.to_numpy()).astype(np.int64)
            ids = ids.flatten()
        if (places[1:] != places[:-1] + sizes[:-1]).any():
            raise ValueError("a partition must be the tokens of whole shards in order")
        yield int(places[0]), ids.to_numpy(zero_copy_only=False)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, split: str, per_shard: int, vocabulary: int, overwrite: bool) -> None:
        if not split.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a split's name has letters, digits, - and _")
        if os.path.exists(f"{path}/manifest.json") and not overwrite:
            raise FileExistsError(f"{path} holds a split already")
        self.path, self.split, self.per_shard, self.vocabulary = path, split, per_shard, vocabulary
        self.stage = f"{path}.stage-{uuid.uuid4().hex}"

    def write(self, batches):
        """A partition is the tokens of neighbouring shards, in order; one shard at a time is held."""
        done, held, size, at = [], [], 0, None
        for first, ids in _runs(batches):
            if first != at and (at is not None or first % self.per_shard):
                raise ValueError("a partition must be the tokens of whole shards in order")
            at = first
            if ids.min(initial=0) < 0 or ids.max(initial=0) >= min(self.vocabulary, 65536):
                raise ValueError("a token lies outside the vocabulary")
            while len(ids):
                part = ids[: self.per_shard - size].astype("<u2")
                held.append(part)
                size, at, ids = size + len(part), at + len(part), ids[len(part) :]
                if size == self.per_shard:
                    done.append(self._staged((at - 1) // self.per_shard, held))
                    held, size = [], 0
        if size:
            done.append(self._staged((at - 1) // self.per_shard, held))
        return _Written(done)

    def _staged(self, index: int, parts: list[np.ndarray]) -> tuple[int, int, str, str]:
        raw = np.concatenate(parts).tobytes()
        os.makedirs(self.stage, exist_ok=True)
        staged = f"{self.stage}/{uuid.uuid4().hex}"
        with open(staged, "wb") as f:
            f.write(raw)
        return index, len(raw) // 2, hashlib.sha256(raw).hexdigest(), staged

    def commit(self, messages):
        done = sorted(x for m in messages if m is not None for x in m.shards)
        if [x[0] for x in done] != list(range(len(done))) or any(x[1] != self.per_shard for x in done[:-1]):
            raise ValueError("shards aren't contiguous")
        stream, shards, start = hashlib.sha256(), [], 0
        os.makedirs(self.stage, exist_ok=True)
        for index, count, sha256, staged in done:
            name = f"{self.split}-{index:05d}.bin"
            os.rename(staged, f"{self.stage}/{name}")
            with open(f"{self.stage}/{name}", "rb") as f:
                stream.update(f.read())
            shards.append({"filename": name, "index": index, "token_start": start, "token_end": start + count, "token_count": count, "byte_count": 2 * count, "sha256": sha256})
            start += count
        manifest = {"format": FORMAT, "version": 1, "dtype": "uint16-le", "split": self.split, "tokens_per_shard": self.per_shard, "total_tokens": start, "stream_sha256": stream.hexdigest(), "shards": shards}
        with open(f"{self.stage}/manifest.json", "w") as f:
            json.dump(manifest, f, indent=1)
        old = f"{self.path}.old-{uuid.uuid4().hex}"
        if os.path.exists(self.path):
            os.rename(self.path, old)
        try:
            os.rename(self.stage, self.path)
        except OSError:
            if os.path.exists(old):
                os.rename(old, self.path)
            raise
        shutil.rmtree(old, ignore_errors=True)

    def abort(self, messages):
        shutil.rmtree(self.stage, ignore_errors=True)


def load_manifest(path: str) -> dict:
    """A manifest whose shards follow each other and add up, or an error."""
    with open(f"{path}/manifest.json") as f:
        m = json.load(f)
    if (m.get("format"), m.get("version"), m.get("dtype")) != (FORMAT, 1, "uint16-le"):
        raise ValueError(f"{path} isn't a set of token shards")
    end = 0
    for i, s in enumerate(m["shards"]):
        if s["index"] != i or s["token_start"] != end or s["token_end"] - s["token_start"] != s["token_count"] or s["byte_count"] != 2 * s["token_count"] or os.path.basename(s["filename"]) != s["filename"]:
            raise ValueError(f"shard {i} of {path} breaks the sequence")
        end = s["token_end"]
    if end != m["total_tokens"]:
        raise ValueError(f"the shards of {path} don't add up")
    return m


def write(stream: DataFrame, path: str, split: str, per_shard: int = 1_000_000, vocabulary: int = 65536, overwrite: bool = False) -> dict:
    """Write a token stream, (position, token) or runs of tokens as (position, ids).

    A task sorts and writes neighbouring shards, so the number of tasks doesn't
    follow that of shards, which would make shuffle blocks its square.
    """
    from pyspark.sql import functions as F

    spark = stream.sparkSession
    spark.dataSource.register(TokenShards)
    small_batches(spark)
    runs = "ids" in stream.columns
    total = stream.agg(F.max(F.col("position") + (F.size("ids") if runs else F.lit(1)))).first()[0] or 0
    shards = max(1, -(-total // per_shard))
    each = -(-shards // parallel(spark))
    width, count = each * per_shard, -(-shards // each)
    if runs:
        # a run goes to each task of which it has tokens
        first, last = F.floor(F.col("position") / width), F.floor((F.col("position") + F.size("ids") - 1) / width)
        cut = stream.where(F.size("ids") > 0).select("position", "ids", (first == last).alias("whole"), F.explode(F.sequence(first, last)).alias("part"))
        lo = F.greatest(F.col("part") * width, F.col("position"))
        hi = F.least((F.col("part") + 1) * width, F.col("position") + F.size("ids"))
        ids = F.when(F.col("whole"), F.col("ids")).otherwise(F.slice("ids", (lo - F.col("position") + 1).cast("int"), (hi - lo).cast("int")))
        rows = cut.select(lo.alias("position"), ids.alias("ids"), F.col("part").cast("int").alias("part"))
    else:
        rows = stream.select("position", "token", F.floor(F.col("position") / width).cast("int").alias("part"))
    # partition ids are those of the parts
    dealt = rows.repartitionById(count, F.col("part")) if hasattr(rows, "repartitionById") else rows.repartitionByRange(count, "part")
    ready = dealt.sortWithinPartitions("position").drop("part")
    ready.write.format("tokenshards").option("path", path).option("split", split).option("pershard", per_shard).option("vocabulary", vocabulary).mode("overwrite" if overwrite else "append").save()
    return load_manifest(path)


def read(spark: SparkSession, path: str, vocabulary: int = 65536) -> DataFrame:
    spark.dataSource.register(TokenShards)
    return spark.read.format("tokenshards").option("path", path).option("vocabulary", vocabulary).option("tasks", parallel(spark)).load()


def token_range(spark: SparkSession, path: str, start: int, count: int, vocabulary: int = 65536) -> DataFrame:
    """Tokens from ``start``, across shards; only the shards of the range are read."""
    if start < 0 or count < 0:
        raise ValueError("a range can't be negative")
    spark.dataSource.register(TokenShards)
    return spark.read.format("tokenshards").option("path", path).option("vocabulary", vocabulary).option("tasks", parallel(spark)).option("start", start).option("count", count).load()
