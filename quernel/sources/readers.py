"""Scans: web records, text files, evaluation sets, clean records, manifests."""

from __future__ import annotations

import gzip
import io
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.functions import text as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _lines(batches):
    """Physical lines of whole files, numbered from 1; blank ones count but aren't given out."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = content.as_py()
            stream = gzip.open(io.BytesIO(raw)) if path.endswith(".gz") else io.BytesIO(raw)
            numbers, values = [], []
            for number, line in enumerate(stream, 1):
                value = line.decode("utf-8", "strict").rstrip("\r\n")
                if value.strip():
                    numbers.append(number)
                    values.append(value)
                if len(values) == 2000:
                    yield _line_batch(path, numbers, values)
                    numbers, values = [], []
            if values:
                yield _line_batch(path, numbers, values)


def _line_batch(path: str, numbers: list[int], values: list[str]) -> pa.RecordBatch:
    name = path.rsplit("/", 1)[-1]
    return pa.RecordBatch.from_arrays([pa.array([path] * len(values)), pa.array([name] * len(values)), pa.array(numbers, pa.int64()), pa.array(values)], ["path", "shard", "line", "value"])


def numbered_lines(spark: SparkSession, folder: str, pattern: str = "*.jsonl.gz") -> DataFrame:
    """(path, shard, line, value); gzip files of several members are read whole.

    A gzip file can't be split, so a file is one task's work; lines stream.
    Bad UTF-8 is an error, not a replacement character.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    if files.limit(1).count() == 0:
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return files.select("path", "content").mapInArrow(_lines, "path string, shard string, line long, value string")


def web_records(lines: DataFrame, language: str | None = "eng") -> DataFrame:
    """Parsed lines with ``schema_reason``: the first schema rule that a line breaks.

    Types are tested on the parsed value, so a number isn't taken for a text.
    """
    v = lines.withColumn("v", F.try_parse_json("value"))
    kind = F.schema_of_variant(F.col("v"))
    has_text = F.array_contains(F.json_object_keys("value"), F.lit("text"))
    text_kind = F.coalesce(F.schema_of_variant(F.try_variant_get("v", "$.text", "variant")), F.lit("VOID"))

    def of(name: str):
        found = F.try_variant_get("v", f"$.{name}", "variant")
        return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get("v", f"$.{name}", "string"))

    out = v.select(
        "path", "shard", "line", of("text").alias("raw"), of("url").alias("url"), of("date").alias("date"), of("lang").alias("lang"),
        F.when(F.col("v").isNull(), "invalid_json").when(~kind.startswith("OBJECT"), "record_not_object").when(~F.coalesce(has_text, F.lit(False)), "missing_text")
        .when(text_kind != "STRING", "text_not_string").when(F.col("value").rlike(r"(?i)\\ud[89ab][0-9a-f]{2}(?!\\ud[c-f][0-9a-f]{2})"), "invalid_unicode").alias("schema_reason"),
    )
    if language:
        other = F.coalesce(T.primary_language(F.col("lang")), F.lit("")) != language
        out = out.withColumn("schema_reason", F.coalesce("schema_reason", F.when(other, F.lit("non_english"))))
    return out.withColumn("text", T.normalize_text(F.col("raw"))).drop("raw")


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, record, text): one document for each .txt, .text or .md file."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.{txt,text,md}").text(folder)
    return files.select(F.col("_metadata.file_path").alias("path"), F.lit(None).cast("long").alias("record"), T.normalize_text(F.col("value")).alias("text"))


def json_texts(spark: SparkSession, folder: str, field: str = "text") -> DataFrame:
    """(path, record, text) of .jsonl and .ndjson files; a record without the field is an error."""
    lines = numbered_lines(spark, folder, "*.{jsonl,ndjson,jsonl.gz,ndjson.gz}")
    value = F.get_json_object("value", f"$.{field}")
    checked = F.when(value.isNull(), F.raise_error(F.concat(F.col("path"), F.lit(": line "), F.col("line"), F.lit(" has no text")))).otherwise(value)
    return lines.select("path", F.col("line").alias("record"), T.normalize_text(checked).alias("text"))


def training_documents(sources: DataFrame) -> DataFrame:
    """Adds document_id and split_group defaults; empty texts go, blank ones stay."""
    made = F.concat("path", F.lit("#record="), F.coalesce(F.col("record").cast("string"), F.lit("0")))
    group = F.when(F.col("record").isNotNull(), F.to_json(F.array(F.col("path"), F.col("record").cast("string")))).otherwise(made)
    return sources.where("text <> ''").select("*", made.alias("document_id"), group.alias("split_group"))


def evaluation_items(spark: SparkSession, path: str) -> DataFrame:
    """(item_id, category, text) of a JSONL set; broken sets are errors."""
    rows = spark.read.schema("id string, category string, text string").option("mode", "FAILFAST").json(path)
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"), F.count_if(F.col("id").isNull() | (F.col("id") == "")).alias("no_id"), F.count_if(F.coalesce(T.blank_trim(F.col("text")), F.lit("")) == "").alias("no_text")
    ).first()
    for wrong, what in ((counts.rows == 0, "no items"), (counts.no_id, "an item without id"), (counts.no_text, "an item without text"), (counts.ids != counts.rows, "a repeated id")):
        if wrong:
            raise ValueError(f"evaluation set {path} has {what}")
    return rows.select(F.col("id").alias("item_id"), F.coalesce("category", F.lit("uncategorized")).alias("category"), "text")


def clean_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Clean records; a broken line is an error."""
    schema = "document_id string, text string, url string, date string, lang string, source_shard string, source_line long, text_sha256 string, split_group string"
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def take_within(docs: DataFrame, order: str, most_documents: int | None = None, most_bytes: int | None = None) -> DataFrame:
    """The longest prefix (by ``order``) within both limits.

    Prefix sums come from the two-level offsets of the packing operators.
    """
    from quernel.operators.dataset import offsets

    sized = offsets(docs.withColumn("one", F.lit(1).cast("long")), order, "one").withColumnRenamed("token_start", "documents_before").drop("one")
    out = sized if most_documents is None else sized.where(F.col("documents_before") < most_documents)
    if most_bytes is not None:
        measured = offsets(out.withColumn("b", F.octet_length("text").cast("long")), order, "b")
        over = measured.where(F.col("token_start") + F.col("b") > most_bytes).agg(F.min(order)).first()[0]
        out = measured.drop("b", "token_start")
        out = out if over is None else out.where(F.col(order) < over)
    return out.drop("documents_before")


def progress(lines: Iterator[str]) -> dict:
    """A build's progress file; absent or older ones give defaults."""
    import json

    text = "".join(lines).strip()
    state = json.loads(text) if text else {}
    return {"completed_shards": [], "next_output_index": 0, "totals": {}} | state
