"""The tokenised dataset as one operator, and its validator.

Build: normalise, split by groups, encode, place on each split's stream, write
token shards, summarise, and commit the whole folder at once. The folder has
to be one that driver and executors share, as the shard files are written by
the tasks. Every step that others read is a written table.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.functions import text as T
from quernel.operators import dataset, tokens, validate
from quernel.session import small_batches, stored
from quernel.sources import shards


def encoded(docs: DataFrame, tokenizer: tokens.Tokenizer, fraction: float, seed: int) -> DataFrame:
    """Documents (document_id, split_group, text) with split, framed ids and their place on the split's stream.

    Texts that are empty after normalisation go; blank ones stay.
    """
    spark = docs.sparkSession
    small_batches(spark)
    normal = docs.select("document_id", "split_group", T.normalize_text(F.col("text")).alias("text")).where("text <> ''")
    normal = stored(normal.select("*", F.length("text").cast("long").alias("n_chars"), F.octet_length("text").cast("long").alias("n_bytes")), "dataset-texts")
    plan = dataset.split_plan(normal.drop("text"), fraction, seed)
    ids = dataset.assign(normal, plan).select("document_id", "split_group", "split", "n_chars", "n_bytes", tokens.encoder(spark, tokenizer)("text").alias("ids"))
    return dataset.offsets(ids.withColumn("n_tokens", F.size("ids").cast("long")), "document_id", "n_tokens", ["split"])


def build(docs: DataFrame, tokenizer: tokens.Tokenizer, out: str, fraction: float = 0.01, seed: int = 2026, context: int = 2048, per_shard: int = 1_000_000, overwrite: bool = False) -> dict:
    """Write the dataset to ``out`` and return its manifest.

    An existing folder is an error without ``overwrite``, and stays as it was
    until the new one is complete.
    """
    if os.path.exists(out) and not overwrite:
        raise FileExistsError(f"{out} holds a dataset already")
    stage = f"{out}.stage-{uuid.uuid4().hex}"
    placed = stored(encoded(docs, tokenizer, fraction, seed), "dataset-tokens")
    try:
        os.makedirs(stage)
        splits = {}
        for row in dataset.stream_summary(placed, context).collect():  # one row for each split
            stream = placed.where(F.col("split") == row.split).select(F.col("token_start").alias("position"), "ids")
            written = shards.write(stream, f"{stage}/{row.split}", row.split, per_shard, tokenizer.size)
            splits[row.split] = row.asDict() | {"shards": len(written["shards"]), "stream_sha256": written["stream_sha256"]}
        manifest = {
            "tokenizer": {"size": tokenizer.size, "specials": list(tokenizer.specials), "sha256": tokenizer.digest()},
            "split_policy": {"fraction": fraction, "seed": seed, "prefix": dataset.SPLIT_PREFIX},
            "training_geometry": {"context": context, "window": context + 1, "stride": context, "padding": False},
            "storage": {"dtype": "uint16-le", "tokens_per_shard": per_shard},
            "splits": splits,
        }
        with open(f"{stage}/tokenizer.json", "w", encoding="utf-8") as f:
            f.write(tokenizer.to_json())
        with open(f"{stage}/dataset_manifest.json", "w", encoding="utf-8") as f:
            json.dump(manifest, f, indent=1)
        old = f"{out}.old-{uuid.uuid4().hex}"
        if os.path.exists(out):
            os.rename(out, old)
        try:
            os.rename(stage, out)
        except OSError:
            if os.path.exists(old):
                os.rename(old, out)
            raise
        shutil.rmtree(old, ignore_errors=True)
    finally:
        shutil.rmtree(stage, ignore_errors=True)
    return manifest


def validate_dataset(spark: SparkSession, out: str, docs: DataFrame | None = None) -> DataFrame:
    """(name, status, failures, observed): the checks of a written dataset.

    Everything is read back from the folder; with ``docs`` the split and the
    token counts are derived again from the texts and compared.
    """
    with open(f"{out}/dataset_manifest.json", encoding="utf-8") as f:
        manifest = json.load(f)
    with open(f"{out}/tokenizer.json", encoding="utf-8") as f:
        tokenizer = tokens.Tokenizer.from_json(f.read())
    geometry, policy, splits = manifest["training_geometry"], manifest["split_policy"], manifest["splits"]
    context = geometry["context"]
    bos, eos = tokenizer.special_id("<|bos|>"), tokenizer.special_id("<|eos|>")
    rows: list[tuple[str, int, int]] = []

    def note(name: str, wrong: int | bool, observed: int) -> None:
        rows.append((name, int(wrong), int(observed)))

    note("geometry", (geometry["window"], geometry["stride"], geometry["padding"]) != (context + 1, context, False) or manifest["storage"]["dtype"] != "uint16-le", context)
    note("tokenizer_identity", tokenizer.digest() != manifest["tokenizer"]["sha256"] or tokenizer.size != manifest["tokenizer"]["size"], tokenizer.size)
    for name in sorted(splits):
        told, held = splits[name], shards.load_manifest(f"{out}/{name}")
        total = held["total_tokens"]
        count = max(0, (total - 1) // context)
        note(f"{name}.token_count", total != told["token_count"], total)
        note(f"{name}.window_count", count != told["window_count"], count)
        note(f"{name}.tail", total - count * context != told["tail_token_count"], told["tail_token_count"])
        note(f"{name}.stream_digest", held["stream_sha256"] != told["stream_sha256"], len(held["shards"]))
        runs = validate.stream_runs(shards.read(spark, f"{out}/{name}", tokenizer.size), tokenizer.size, bos, eos, len(tokenizer.specials))
        # windows over a shard's end, each of which must have all its tokens
        cross = sorted({s["token_end"] // context for s in held["shards"][:-1] if s["token_end"] // context < count})
        note(f"{name}.shard_boundaries", validate.whole_windows(runs, cross, context) != len(cross), len(cross))
        starts, ends = sum(r.bos for r in runs), sum(r.eos for r in runs)
        note(f"{name}.documents", (starts, ends) != (told["document_count"], told["document_count"]), starts)
        for what, failures in validate.run_checks(runs, bos, eos).items():
            rows.append((f"{name}.{what}", failures, total))
    digests = [splits[n]["stream_sha256"] for n in splits]
    note("splits_are_distinct", len(set(digests)) != len(digests), len(digests))
    if docs is not None:
        again = encoded(docs, tokenizer, policy["fraction"], policy["seed"]).groupBy("split").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens")).collect()
        wrong = [r for r in again if (r.documents, r.tokens) != (splits[r.split]["document_count"], splits[r.split]["token_count"])]
        note("split_reproduces", len(wrong) or len(again) != len(splits), sum(r.documents for r in again))
    out_rows = spark.createDataFrame(rows, "name string, failures long, observed long")
    return out_rows.select("name", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("status"), "failures", "observed")
