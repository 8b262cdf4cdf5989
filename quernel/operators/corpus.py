"""Exact dedup, evaluation decontamination and the corpus funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernel.functions import quality as Q
from quernel.functions import text as T
from quernel.session import small_batches, stored

#: Shingles of an evaluation set up to which it is broadcast (8 bytes each and
#: an item number); a larger one is joined by a shuffle.
BROADCAST_SHINGLES = 2_000_000
#: Ids of documents that pass the row gates up to which these alone are compared with an evaluation set.
BROADCAST_IDS = 4_000_000


def prepared(docs: DataFrame, normalized: bool = False) -> DataFrame:
    """Driver documents as web records: url is null, line is doc_id, shard is source."""
    small_batches(docs.sparkSession)
    text = F.col("text") if normalized else T.normalize_text(F.col("text"))
    out = docs.select("doc_id", "lang", "source", text.alias("text"))
    return out.withColumn("sha", T.sha256_hex(F.col("text")))


def keep_first(docs: DataFrame, order: str = "doc_id") -> DataFrame:
    """Adds ``first_id``: the first row (by ``order``) with the same fingerprint.

    A grouped minimum and a join: partial minima are taken before the shuffle,
    so thousands of copies of one text don't meet in one sorted partition.
    """
    firsts = docs.groupBy("sha").agg(F.min(order).alias("first_id"))
    return docs.join(firsts, "sha")


def unseen(docs: DataFrame, history: DataFrame) -> DataFrame:
    """Documents whose fingerprint is in no earlier run."""
    return docs.join(history.select("sha").distinct(), "sha", "left_anti")


def evaluation_shingles(items: DataFrame, size: int = 8, min_tokens: int = 50) -> DataFrame:
    """(item_id, shingle, total) of the items that are long enough."""
    tokens = items.select("item_id", T.comparison_tokens(F.col("text")).alias("tokens")).where(F.size("tokens") >= min_tokens)
    sets = tokens.select("item_id", F.array_distinct(T.gram_keys(F.col("tokens"), size)).alias("grams"))
    return sets.select("item_id", F.size("grams").alias("total"), F.explode("grams").alias("shingle"))


def contained(docs: DataFrame, items: DataFrame, size: int = 8, min_tokens: int = 50, least: float = 0.8) -> DataFrame:
    """(doc_id, item_id, shared, total): items of which a document holds enough.

    Document shingles stream past the evaluation shingles; only those that hit
    are shuffled, to be counted for each document and item.
    """
    index = evaluation_shingles(items, size, min_tokens)
    side = F.broadcast(index) if index.count() <= BROADCAST_SHINGLES else index
    rows = docs.select("doc_id", F.explode(F.array_distinct(T.gram_keys(T.comparison_tokens(F.col("text")), size))).alias("shingle"))
    hits = rows.join(side, "shingle").groupBy("doc_id", "item_id", "total").agg(F.count(F.lit(1)).alias("shared"))
    return hits.where(F.col("shared") / F.col("total") >= least).select("doc_id", "item_id", "shared", F.col("total").cast("long").alias("total"))


def exact_items(docs: DataFrame, items: DataFrame, min_tokens: int = 50) -> DataFrame:
    """(doc_id, item_id): documents that are an item; of equal items, the first."""
    long = items.where(F.size(T.comparison_tokens(F.col("text"))) >= min_tokens)
    first = long.select("item_id", T.sha256_hex(T.normalize_text(F.col("text"))).alias("sha")).groupBy("sha").agg(F.min("item_id").alias("item_id"))
    return docs.join(first, "sha").select("doc_id", "item_id")


def verdicts(docs: DataFrame, items: DataFrame, size: int = 8, min_tokens: int = 50, least: float = 0.8) -> DataFrame:
    """One row for each match: exact ones first, then by containment and item."""
    same = exact_items(docs, items, min_tokens).withColumn("reason", F.lit("exact_match")).withColumn("containment", F.lit(1.0))
    part = contained(docs, items, size, min_tokens, least)
    part = part.join(same.select("doc_id", "item_id"), ["doc_id", "item_id"], "left_anti")
    part = part.select("doc_id", "item_id", F.lit("containment").alias("reason"), (F.col("shared") / F.col("total")).alias("containment"))
    return same.unionByName(part)


def best_verdict(docs: DataFrame, items: DataFrame, size: int = 8, min_tokens: int = 50, least: float = 0.8) -> DataFrame:
    key = F.struct((F.col("reason") != "exact_match").alias("later"), (-F.col("containment")).alias("less"), "item_id", "reason", "containment")
    best = verdicts(docs, items, size, min_tokens, least).groupBy("doc_id").agg(F.min(key).alias("best"), F.count(F.lit(1)).alias("n_matches"))
    return best.select("doc_id", F.col("best.item_id").alias("item_id"), F.col("best.reason").alias("reason"), F.col("best.containment").alias("containment"), "n_matches")


def reasons(
    docs: DataFrame,
    items: DataFrame | None,
    language: str | None = "en",
    rules: Q.QualityRules = Q.QualityRules(),
    script_rules: Q.ScriptRules | None = Q.ScriptRules(),
    secrets: bool = True,
    min_tokens: int = 50,
) -> DataFrame:
    """(doc_id, source, lang, sha, m, excerpt, reason): the first gate that each fails.

    Row gates come first (language, script, quality, secrets), then
    contamination, then duplication: a fingerprint counts as seen only once
    its document is accepted, so each copy of a contaminated text is
    contaminated and never a duplicate.
    """
    m = docs.select("doc_id", "lang", "source", "sha", "text", Q.metrics(F.col("text")).alias("m"))
    gates = []
    if language:
        gates.append(F.when(F.coalesce(T.primary_language(F.col("lang")), F.lit("")) != language, F.lit("non_english")))
    if script_rules:
        # inside the gate, so that only texts of the language are counted
        gates.append(F.when(Q.bound(Q.scripts(F.col("text")), lambda s: Q.script_mismatch(s, script_rules)), F.lit("language_script_mismatch")))
    gates.append(Q.quality_reason(F.col("text"), F.col("m"), rules, secrets))
    # one scan of the texts; the set operations below read these narrow rows
    judged = stored(m.select("doc_id", "source", "lang", "sha", "m", F.substring("text", 1, 300).alias("excerpt"), F.coalesce(*gates).alias("row_reason")), "row-reasons")
    firsts = judged.where("row_reason IS NULL").groupBy(F.col("sha").alias("first_sha")).agg(F.min("doc_id").alias("first_id"))
    out = judged.join(firsts, F.col("sha") == F.col("first_sha"), "left")
    if items is not None:
        passed = judged.where("row_reason IS NULL").select(F.col("doc_id").alias("passed_id"))
        if passed.count() <= BROADCAST_IDS:
            # a verdict counts for documents that pass the row gates alone
            docs = docs.join(F.broadcast(passed), F.col("doc_id") == F.col("passed_id"), "left_semi")
        best = best_verdict(docs, items, min_tokens=min_tokens)
        best = best.select(F.col("doc_id").alias("leak_id"), F.concat(F.lit("evaluation_contamination_"), F.when(F.col("reason") == "exact_match", "exact").otherwise("containment")).alias("leak"))
        out = out.join(best, F.col("doc_id") == F.col("leak_id"), "left")
    else:
        out = out.withColumn("leak", F.lit(None).cast("string"))
    again = F.when(F.col("doc_id") != F.col("first_id"), F.lit("exact_duplicate"))
    reason = F.when(F.col("row_reason").isNotNull(), F.col("row_reason")).otherwise(F.coalesce("leak", again))
    return out.select("doc_id", "source", "lang", "sha", "m", "excerpt", reason.alias("reason"))


def funnel(judged: DataFrame) -> DataFrame:
    """Documents, characters and bytes for each reason; accepted ones as "accepted"."""
    return judged.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum("m.characters").alias("characters"), F.sum("m.utf8_bytes").alias("utf8_bytes")
    )


def rejected_samples(judged: DataFrame, keep: int = 50) -> DataFrame:
    """The first rejected rows of each reason; duplicates keep none."""
    quota = max(keep // 10, 1)
    order = Window.partitionBy("reason").orderBy("source", "doc_id")
    rows = judged.where("reason IS NOT NULL AND reason <> 'exact_duplicate'")
    rows = rows.select("reason", "source", "doc_id", F.col("m.characters").alias("characters"), "excerpt", F.row_number().over(order).alias("k"))
    return rows.where(F.col("k") <= quota).drop("k")


def clean_records(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """Accepted documents as nine-column clean records."""
    made = T.document_id(F.col("text"))
    kept = judged.where("reason IS NULL").select(F.col("doc_id").alias("kept_id"))
    return docs.join(kept, F.col("doc_id") == F.col("kept_id"), "left_semi").select(
        made.alias("document_id"),
        "text",
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("date"),
        "lang",
        F.col("source").alias("source_shard"),
        F.col("doc_id").alias("source_line"),
        F.col("sha").alias("text_sha256"),
        made.alias("split_group"),
    )


def training_overlap(items: DataFrame, training: DataFrame, least: float = 0.1, size: int = 13, min_grams: int = 20) -> DataFrame:
    """(item_id, reason): the first reason for which an evaluation text can't be used, or null.

    ``items`` has item_id, source_key and text, ``training`` source_key and
    text. Reasons in order: a text of a source document that is trained on
    (keys compared without case), a text that is trained on, and too many of
    the text's n-grams in training texts.
    """
    keys = training.where("source_key IS NOT NULL").select(F.lower("source_key").alias("k")).distinct().withColumn("same_source", F.lit(True))
    texts = training.select(T.sha256_hex(T.normalize_text(F.col("text"))).alias("sha")).distinct().withColumn("same_text", F.lit(True))
    shares = ngram_overlap(items, training, size, min_grams).select(F.col("item_id").alias("shared_id"), (F.col("hits") / F.col("n_grams")).alias("overlap"))
    rows = items.select("item_id", F.lower("source_key").alias("key"), T.sha256_hex(T.normalize_text(F.col("text"))).alias("item_sha"))
    rows = rows.join(keys, F.col("key") == F.col("k"), "left").join(texts, F.col("item_sha") == F.col("sha"), "left").join(shares, F.col("item_id") == F.col("shared_id"), "left")
    reason = F.when(F.col("same_source"), "same_training_source_document").when(F.col("same_text"), "exact_training_text").when(F.col("overlap") >= least, "training_ngram_overlap")
    return rows.select("item_id", reason.alias("reason"))


def planted_controls(docs: DataFrame, count: int = 10, min_chars: int = 2000, seed: int = 42) -> DataFrame:
    """(item_id, text): corpus documents to plant in an evaluation set, in seeded order; all must be found again."""
    order = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")), 256)
    long = docs.where(F.length("text") >= min_chars).select(F.col("doc_id").alias("item_id"), "text", order.alias("k"))
    return long.orderBy("k", "item_id").limit(count).drop("k")


def category_counts(items: DataFrame, min_tokens: int = 50) -> DataFrame:
    """Items of an evaluation set by category, and how many are too short to be matched."""
    short = F.size(T.comparison_tokens(F.col("text"))) < min_tokens
    return items.groupBy(F.coalesce("category", F.lit("uncategorized")).alias("category")).agg(F.count(F.lit(1)).alias("items"), F.count_if(short).alias("skipped_short"))


def totals(runs: DataFrame) -> DataFrame:
    """Cumulative counts after each run, from ``run``, ``reason``, ``documents``, ``characters``; null is accepted."""
    # a run is one row after the sums, so the window is small
    seen = runs.groupBy("run").agg(
        F.sum("documents").alias("seen"), F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("documents"))), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("characters"))), F.lit(0)).alias("characters"),
    )
    sofar = Window.partitionBy().orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    return seen.select("run", *[F.sum(c).over(sofar).alias(c) for c in ("seen", "accepted", "characters")])


def ngram_overlap(texts: DataFrame, training: DataFrame, size: int = 13, min_grams: int = 20) -> DataFrame:
    """(item_id, n_grams, hits): share of a text's n-grams that training texts hold.

    Repeats in the candidate count as often as they occur; matching is case
    sensitive on words between white space.
    """
    words = lambda c: F.regexp_extract_all(c, F.lit(r"(?U)[^\s\x1c-\x1f]+"), F.lit(0))
    rows = texts.select("item_id", T.gram_keys(words(F.col("text")), size).alias("grams")).where(F.size("grams") >= min_grams)
    known = training.select(F.explode(T.gram_keys(words(F.col("text")), size)).alias("gram"))
    # read three times; candidates may be a large part of a corpus
    wanted = stored(rows.select("item_id", F.explode("grams").alias("gram")).groupBy("item_id", "gram").agg(F.count(F.lit(1)).alias("times")), "wanted-grams")
    # only grams that some candidate holds leave the scan of the training texts; where these are too many, all are dealt but not sorted
    keys = wanted.select("gram").distinct()
    side = F.broadcast(keys) if keys.count() <= BROADCAST_SHINGLES else keys.hint("shuffle_hash")
    seen = known.join(side, "gram", "left_semi").distinct().withColumn("seen", F.lit(1))
    joined = wanted.join(seen, "gram", "left")
    return joined.groupBy("item_id").agg(F.sum("times").alias("n_grams"), F.sum(F.when(F.col("seen") == 1, F.col("times")).otherwise(0)).alias("hits"))
