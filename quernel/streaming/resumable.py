"""Resumable corpus builds: a micro-batch is one input file, or all files that are new.

A batch is judged like the batch build, except that "seen before" also asks
the fingerprints that earlier batches accepted. What a batch leaves is written
under its batch id, so a replayed batch overwrites its own output and a run
that stops between two batches neither loses nor doubles a document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.operators import corpus
from quernel.session import dealt, forget, shared_dir, stored


def batch_writer(spark: SparkSession, out: str, items: DataFrame, language: str | None = "en"):
    """A foreachBatch function that judges and writes one batch."""

    def write(batch: DataFrame, number: int) -> None:
        # texts are read by several steps, and the verdicts of a batch by two
        docs = stored(corpus.prepared(batch), "batch-docs")
        judged = kept = stored(corpus.reasons(docs, items, language), "batch-judged")
        accepted = judged.where("reason IS NULL OR reason = 'exact_duplicate'")
        if number:
            # batches of higher numbers are leftovers of a run that was rolled back
            before = spark.read.parquet(f"{out}/judged").where((F.col("batch") < number) & F.col("reason").isNull())
            known = accepted.select("sha").join(before.select("sha"), "sha", "left_semi").distinct().withColumn("known", F.lit(True))
            judged = judged.join(known, "sha", "left")
            judged = judged.withColumn("reason", F.when(F.col("reason").isNull() & F.col("known"), F.lit("exact_duplicate")).otherwise(F.col("reason")))
        judged.select("doc_id", "sha", "reason", "m").write.mode("overwrite").parquet(f"{out}/judged/batch={number}")
        forget(docs, kept)

    return write


def run(spark: SparkSession, files: str, schema, out: str, items: DataFrame, language: str | None = "en", batch_files: int | None = 1) -> DataFrame:
    """Process the files of a folder that no earlier run has processed.

    A batch has ``batch_files`` of them, or all with None: a large part that
    was written as many files is then read by as many tasks, as one batch.
    """
    reader = spark.readStream.schema(schema)
    stream = (reader.option("maxFilesPerTrigger", batch_files) if batch_files else reader).parquet(files)
    query = stream.writeStream.foreachBatch(batch_writer(spark, out, items, language)).option("checkpointLocation", f"{out}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{out}/judged")


def demo(spark: SparkSession, documents: DataFrame, items: DataFrame) -> DataFrame:
    """The funnel of ``documents`` built in batches, with a second run that finds nothing new.

    Batches are ranges of ids and are taken in the order of their time, so the
    first of equal texts is the one that stays, as in the batch build. Where
    the ranges end changes nothing of the result, so near quantiles will do;
    exact ones would gather all ids in the driver.
    """
    out = f"{shared_dir(spark)}/resumable-{uuid.uuid4().hex}"
    bounds = documents.approxQuantile("doc_id", [0.33, 0.66], 0.01)
    edges = [None, *bounds, None]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = documents
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        dealt(part).write.mode("append").parquet(f"{out}/incoming")
        run(spark, f"{out}/incoming", documents.schema, out, items, batch_files=None)
    judged = run(spark, f"{out}/incoming", documents.schema, out, items, batch_files=None)
    return corpus.funnel(judged.withColumn("reason", F.col("reason")))
