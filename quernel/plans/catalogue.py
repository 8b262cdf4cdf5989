"""Registry of the engine's own queries and their SQL oracles.

Driver tables stand in for web records: ``documents`` has no URL, its line is
``doc_id`` and its shard is ``source``; ``benchmark`` is the evaluation set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.functions import quality as Q
from quernel.functions import text as T
from quernel.operators import build, corpus, dataset, near, sampling, tokens, validate
from quernel.plans.oracles import ORACLES, PROBES
from quernel.session import dealt, load, shared_dir, stored
from quernel.sources import readers, writers

#: Categories' weights, budgets and sizes that the sample queries use.
WEIGHTS = {"en": 4.0, "fr": 2.0, "de": 1.0}
CONTEXT, SHARD = 2048, 1_000_000


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return corpus.prepared(dealt(load(spark, d, "documents")))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return corpus.reasons(stored(_docs(spark, d), "docs"), load(spark, d, "benchmark"))


def _sized(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    return docs.select(
        "doc_id", "source", F.col("lang").alias("category"), F.col("doc_id").cast("string").alias("document_id"), F.concat(F.lit("g"), F.floor(F.col("doc_id") / 3).cast("string")).alias("split_group"),
        F.length("text").cast("long").alias("n_chars"), F.octet_length("text").cast("long").alias("n_bytes"), (F.octet_length("text") + 2).cast("long").alias("n_tokens"),
    )


def normalize_text(s, d):
    raw = load(s, d, "documents")
    return raw.select("doc_id", T.sha256_hex(T.normalize_text(F.col("text"))).alias("sha"))


def fingerprint_ids(s, d):
    return _docs(s, d).select("doc_id", F.col("sha").alias("text_sha256"), T.document_id(F.col("text")).alias("document_id"))


def split_group_pages(s, d):
    return load(s, d, "pages").select("page_id", T.split_group(F.col("url"), F.lit("none")).alias("split_group"))


def primary_language_counts(s, d):
    return load(s, d, "documents").groupBy(T.primary_language(F.col("lang")).alias("language")).agg(F.count(F.lit(1)).alias("documents"))


def doc_metrics(s, d):
    m = _docs(s, d).select("doc_id", Q.metrics(F.col("text")).alias("m"))
    return m.select("doc_id", *[F.round(F.col(f"m.{n}"), 9).alias(n) if n.endswith("ratio") or n == "mean_line_length" else F.col(f"m.{n}") for n in Q.METRICS])


def script_metrics(s, d):
    m = _docs(s, d).select("doc_id", Q.scripts(F.col("text")).alias("s"))
    return m.select("doc_id", "s.alphabetic_characters", "s.latin_characters", F.round("s.latin_share", 9).alias("latin_share"), Q.script_mismatch(F.col("s")).alias("mismatch"))


#: What is planted by id to make each credential pattern hit (made up, of the right form).
PLANTED_SECRETS = (
    "-----BEGIN RSA " + "PRIVATE KEY-----", "AKIA" + "A1B2C3D4E5F6G7H8", "ghp_" + "a" * 36, "xoxb-" + "1234567890", "AIza" + "b" * 35, "sk_live_" + "c" * 24, "sk-" + "d" * 32,
    "eyJ" + "e" * 10 + ".eyJ" + "f" * 10 + ".", "Authorization: Bearer " + "g" * 40, "sk-" + "short", "AKIA" + "lowercase",
)


def secret_hits(s, d):
    """Credentials planted behind every text, of a kind that follows from its id; the last two kinds are none."""
    kinds = F.array(*[F.lit(x) for x in PLANTED_SECRETS])
    planted = F.concat("text", F.lit(" "), F.get(kinds, F.pmod("doc_id", F.lit(len(PLANTED_SECRETS))).cast("int")))
    return _docs(s, d).select("doc_id", Q.secret(planted).alias("secret"))


def special_token_texts(s, d):
    rows = load(s, d, "conversations")
    return rows.select("conv_id", "turn", T.has_special(F.col("text")).alias("has_special"), T.has_both_marks(F.col("text")).alias("has_both_marks"), T.count_specials(F.col("text")).alias("n_special"))


def quality_reason(s, d):
    m = _docs(s, d).select("doc_id", "text", Q.metrics(F.col("text")).alias("m"))
    return m.select("doc_id", F.coalesce(Q.quality_reason(F.col("text"), F.col("m")), F.lit("accepted")).alias("reason"))


def corpus_funnel(s, d):
    return corpus.funnel(_judged(s, d))


def acceptance_rate(s, d):
    return _judged(s, d).agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.col("reason").isNull()).alias("accepted"), F.round(F.coalesce(F.try_divide(F.count_if(F.col("reason").isNull()), F.count(F.lit(1))), F.lit(0.0)), 9).alias("rate"))


def rejected_samples(s, d):
    return corpus.rejected_samples(_judged(s, d)).drop("excerpt")


def exact_dedup_keep_first(s, d):
    return corpus.keep_first(_docs(s, d)).select("doc_id", "first_id", (F.col("doc_id") == F.col("first_id")).alias("kept"))


def duplicate_ratio(s, d):
    docs = _docs(s, d)
    return docs.groupBy("sha").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("documents"), F.count(F.lit(1)).alias("distinct_texts"), F.round(1 - F.count(F.lit(1)) / F.sum("n"), 9).alias("ratio"))


def dedup_anti_join(s, d):
    docs = _docs(s, d)
    return corpus.unseen(docs, docs.where("source = 'src0'")).select("doc_id", "sha")


def comparison_token_count(s, d):
    t = _docs(s, d).select("doc_id", T.comparison_tokens(F.col("text")).alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.size(F.array_distinct(T.gram_keys(F.col("t"), 8))).cast("long").alias("n_shingles"))


def _near(s, d):
    feats = stored(near.features(_docs(s, d)), "near-features")
    sets = near.classes(feats)
    return feats, sets, near.links(sets, near.prefix_candidates(sets))


def near_dup_links(s, d):
    return _near(s, d)[2].select("a", "b", "shared", F.round("similarity", 9).alias("similarity"), "safe")


def near_dup_audit(s, d):
    return near.audit(*_near(s, d))


def near_dup_report(s, d):
    return near.report(_near(s, d)[2]).withColumn("best_similarity", F.round("best_similarity", 9))


def near_dup_lsh(s, d):
    sets = near.classes(stored(near.features(_docs(s, d)), "near-features"))
    return near.links(sets, near.lsh_candidates(sets))


def minhash_signature(s, d):
    return near.features(_docs(s, d)).select("doc_id", near.signature(F.col("grams")).alias("signature"))


def decon_exact(s, d):
    """Every item is planted as a document as well, with other line ends."""
    items = load(s, d, "benchmark")
    planted = items.select((F.col("item_id") + 10_000_000).alias("doc_id"), F.lit("en").alias("lang"), F.lit("planted").alias("source"), F.replace("text", F.lit("\n"), F.lit("\r\n")).alias("text"))
    docs = load(s, d, "documents").select("doc_id", "lang", "source", "text").unionByName(planted)
    return corpus.exact_items(corpus.prepared(docs), items, min_tokens=1)


def evaluation_categories(s, d):
    items = load(s, d, "benchmark").withColumn("category", F.when(F.pmod("item_id", F.lit(3)) > 0, F.concat(F.lit("c"), F.pmod("item_id", F.lit(3)).cast("string"))))
    return corpus.category_counts(items)


def eval_decontamination(s, d):
    """Items, and the documents of one source as further candidates, against the other sources."""
    docs = load(s, d, "documents")
    training = docs.where("source <> 'src1'").select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("source_key"), "text")
    more = docs.where("source = 'src1'").select((F.col("doc_id") + 10_000_000).alias("item_id"), F.concat(F.lit("SRC0/"), (F.col("doc_id") + 1).cast("string")).alias("source_key"), "text")
    items = load(s, d, "benchmark").select("item_id", F.lit(None).cast("string").alias("source_key"), "text").unionByName(more)
    return corpus.training_overlap(items, training).select("item_id", F.coalesce("reason", F.lit("kept")).alias("reason"))


def planted_controls(s, d):
    docs = stored(_docs(s, d), "docs")
    planted = stored(corpus.planted_controls(docs), "controls")
    hits = corpus.contained(docs, planted, min_tokens=1).where("doc_id = item_id")
    return planted.join(hits.select("item_id", "shared", "total"), "item_id", "left").select("item_id", (F.coalesce("shared", F.lit(0)) == F.col("total")).alias("found"), "total")


def cumulative_totals(s, d):
    """Each source is a run."""
    runs = _judged(s, d).groupBy(F.col("source").alias("run"), "reason").agg(F.count(F.lit(1)).alias("documents"), F.sum("m.characters").alias("characters"))
    return corpus.totals(runs)


def count_reconciliation(s, d):
    """Accepted documents, characters and bytes as the funnel, the records and the digests have them."""
    docs = stored(_docs(s, d), "docs")
    judged = stored(corpus.reasons(docs, load(s, d, "benchmark")), "judged")
    records = stored(corpus.clean_records(docs, judged), "records")
    named = lambda df, source, *cols: df.agg(*cols).select(F.lit(source).alias("source"), F.posexplode(F.array(*[F.col(f"c{i}").cast("long") for i in range(len(cols))])).alias("k", "value"))
    funnel = named(judged.where("reason IS NULL"), "funnel", F.count(F.lit(1)).alias("c0"), F.sum("m.characters").alias("c1"), F.sum("m.utf8_bytes").alias("c2"))
    own = named(records, "records", F.count(F.lit(1)).alias("c0"), F.sum(F.length("text")).alias("c1"), F.sum(F.octet_length("text")).alias("c2"))
    digests = named(records, "digests", F.count_distinct("text_sha256").alias("c0"))
    names = F.get(F.array(*[F.lit(x) for x in ("documents", "characters", "utf8_bytes")]), F.col("k"))
    return validate.reconciled(funnel.unionByName(own).unionByName(digests).select("source", names.alias("measure"), "value"))


def decon_containment_50(s, d):
    return corpus.contained(_docs(s, d), load(s, d, "benchmark"))


def decon_containment_20(s, d):
    return corpus.contained(_docs(s, d), load(s, d, "benchmark"), min_tokens=20)


def decon_best(s, d):
    best = corpus.best_verdict(_docs(s, d), load(s, d, "benchmark"), min_tokens=20)
    return best.withColumn("containment", F.round("containment", 9))


def eval_ngram_overlap(s, d):
    return corpus.ngram_overlap(load(s, d, "benchmark"), load(s, d, "documents")).select("item_id", "n_grams", "hits", (F.col("hits") / F.col("n_grams") >= 0.1).alias("rejected"))


def split_plan(s, d):
    return dataset.split_plan(_sized(s, d), 0.05)


def split_summary(s, d):
    docs = _sized(s, d)
    return dataset.summary(dataset.assign(docs, dataset.split_plan(docs, 0.05)))


def pack_offsets(s, d):
    return dataset.offsets(_sized(s, d), "doc_id", "n_tokens").select("doc_id", "n_tokens", "token_start")


def window_index(s, d):
    parts = dataset.window_parts(dataset.offsets(_sized(s, d), "doc_id", "n_tokens"), CONTEXT)
    return parts.groupBy("window_id").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("part_to") - F.col("part_from") + 1).cast("long").alias("n_tokens"))


def shard_ranges(s, d):
    docs = _sized(s, d)
    totals = dataset.assign(docs, dataset.split_plan(docs, 0.05)).groupBy("split").agg(F.sum("n_tokens").alias("total_tokens"))
    return dataset.shard_ranges(totals, SHARD)


def shard_contiguity(s, d):
    """Planted: every second shard starts one token late."""
    return validate.shard_checks(shard_ranges(s, d).withColumn("token_start", F.col("token_start") + F.pmod("shard_index", F.lit(2))))


def byte_pair_counts(s, d):
    return tokens.byte_pair_counts(_docs(s, d))


#: Bytes of training text of the sample tokenizer; training holds them in one place.
TRAIN_BYTES, VOCABULARY = 200_000, 512


def _tokenizer(s, d):
    """A small vocabulary from a bounded sample of the documents, in seeded order."""
    docs = stored(_docs(s, d), "docs")
    order = sampling.running(docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), sampling.ordering(42, F.col("doc_id")).alias("key")), ["key", "doc_id"], ["n_bytes"])
    chosen = order.where(F.col("n_bytes_before") + F.col("n_bytes") <= TRAIN_BYTES).select("doc_id", "key")
    rows = docs.join(F.broadcast(chosen), "doc_id").orderBy("key", "doc_id").select("text").collect()
    return docs, tokens.Tokenizer.train([r.text for r in rows if r.text], VOCABULARY)


def bpe_merges(s, d):
    _, t = _tokenizer(s, d)
    return s.createDataFrame([(i, a, b) for i, (a, b) in enumerate(t.merges)], "rank long, left_id long, right_id long")


def bpe_roundtrip(s, d):
    _, t = _tokenizer(s, d)
    rows = stored(load(s, d, "conversations").withColumn("ids", tokens.encoder(s, t)("text")), "bpe-ids")
    return rows.select("conv_id", "turn", F.size("ids").alias("n_ids"), tokens.well_framed(F.col("ids"), t).alias("framed"), (tokens.decoder(s, t)("ids") == F.col("text")).alias("same"))


def _encoded(s, d):
    docs, t = _tokenizer(s, d)
    return t, stored(docs.select("doc_id", "lang", "text", tokens.encoder(s, t, framed=False)("text").alias("ids")), "bpe-documents")


def token_usage(s, d):
    t, rows = _encoded(s, d)
    return tokens.usage(rows, t)


def token_utilization(s, d):
    t, rows = _encoded(s, d)
    return tokens.utilization(tokens.usage(rows, t), t)


def tokenizer_metrics(s, d):
    t, rows = _encoded(s, d)
    return tokens.compression(rows.withColumn("back", tokens.decoder(s, t)("ids")), "lang")


def probe_rollup(s, d):
    """Probes by kind: how many, and whether each is given back; a reserved literal in a text stays plain text."""
    _, t = _tokenizer(s, d)
    probes = s.createDataFrame([(k, x) for k, x in PROBES], "kind string, text string")
    rows = probes.withColumn("ids", tokens.encoder(s, t)("text"))
    good = (tokens.decoder(s, t)("ids") == F.col("text")) & tokens.well_framed(F.col("ids"), t)
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("probes"), F.sum(F.octet_length("text")).cast("long").alias("utf8_bytes"), F.bool_and(good).alias("passed"))


def _bytes_tokenizer():
    """No merges: a token is a byte, so that SQL can count them too."""
    return tokens.Tokenizer([], 265)


def _dataset(s, d):
    import uuid

    out = f"{shared_dir(s).removeprefix('file:')}/dataset-{uuid.uuid4().hex}"
    turns = load(s, d, "conversations")
    docs = turns.select(F.concat_ws(":", "conv_id", "turn").alias("document_id"), F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("split_group"), "text")
    return out, docs, build.build(docs, _bytes_tokenizer(), out, 0.05, 2026, 256, 10_000)


def dataset_build(s, d):
    """The dataset of all conversation turns, split by conversation: what its manifest says."""
    _, _, manifest = _dataset(s, d)
    keys = ("document_count", "split_group_count", "normalized_characters", "normalized_utf8_bytes", "token_count", "longest_document", "window_count", "prediction_token_count", "tail_token_count", "shards")
    rows = [(k, *[int(v[x]) for x in keys], float(v["byte_share"])) for k, v in manifest["splits"].items()]
    return s.createDataFrame(rows, "split string, " + ", ".join(f"{k} long" for k in keys) + ", byte_share double")


def dataset_validator(s, d):
    out, docs, _ = _dataset(s, d)
    return build.validate_dataset(s, out, docs)


def token_range(s, d):
    """Tokens 8,000 to 14,000 of the train stream, which start and end inside shards."""
    from quernel.sources import shards

    out, _, _ = _dataset(s, d)
    part = shards.token_range(s, f"{out}/train", 8_000, 6_000, 265)
    return part.groupBy(F.floor(F.col("position") / 1_000).alias("block")).agg(F.count(F.lit(1)).alias("tokens"), F.sum("token").alias("total"))


def epoch_batches(s, d):
    w = s.range(0, 1003).select(F.col("id").alias("window_id"))
    return dataset.epoch_order(w, 2026, 3, batch=16).select("window_id", "step", "slot")


def web_scan(s, d):
    """Documents written as gzip JSON lines, some of them broken, then scanned and judged by schema and language."""
    import uuid

    path = f"{shared_dir(s)}/web-{uuid.uuid4().hex}"
    docs = load(s, d, "documents")
    good = F.to_json(F.struct("text", F.concat(F.lit("https://example.com/"), F.col("doc_id")).alias("url"), F.when(F.col("lang") == "en", "eng,deu").otherwise(F.col("lang")).alias("lang")))
    k = F.pmod("doc_id", F.lit(20))
    line = F.when(k == 1, "{bad").when(k == 2, "[1]").when(k == 3, '{"url": "x"}').when(k == 4, '{"text": 42}').when(k == 5, '{"text": null, "lang": "eng"}').when(k == 6, '{"text": "\\ud800", "lang": "eng"}').otherwise(good)
    docs.select(line.alias("value")).write.option("compression", "gzip").text(path)
    rows = readers.web_records(readers.numbered_lines(s, path, "*.txt.gz"))
    return rows.groupBy(F.coalesce("schema_reason", F.lit("read")).alias("reason")).agg(F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(F.when(F.col("schema_reason").isNull(), F.length("text"))), F.lit(0)).cast("long").alias("characters"))


def clean_corpus_round_trip(s, d):
    """Accepted documents written as JSON-lines shards and read back, with the checks of each record."""
    import uuid

    docs = stored(_docs(s, d), "docs")
    records = corpus.clean_records(docs, corpus.reasons(docs, load(s, d, "benchmark")))
    path = f"{shared_dir(s)}/clean-{uuid.uuid4().hex}"
    writers.write_jsonl(records, path, "source_line", most_bytes=500_000)
    back = readers.clean_corpus(s, path)
    return back.select("document_id", "source_line", "text_sha256", (F.sha2("text", 256) == F.col("text_sha256")).alias("holds"), F.length("text").cast("long").alias("characters"))


def category_distribution(s, d):
    return sampling.distribution(_sized(s, d)).select("category", "documents", "utf8_bytes", F.round("document_fraction", 9).alias("document_fraction"), F.round("byte_fraction", 9).alias("byte_fraction"))


def source_contribution(s, d):
    return sampling.contribution(_sized(s, d)).withColumn("share", F.round("share", 9))


def chunk_documents(s, d):
    pieces = sampling.chunks(_docs(s, d).select("doc_id", "text"), 600, 900, 100)
    return pieces.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.length("text")).alias("characters"), F.max(F.length("text")).alias("longest"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.struct(F.coalesce("chunk", F.lit(0)).alias("k"), "text")))["text"], ""), 256).alias("sha"))


def _pieces(s, d):
    pieces = sampling.chunks(_docs(s, d).select("doc_id", "text"), 600, 900, 100)
    return pieces.select(F.col("doc_id").alias("source"), F.coalesce("chunk", F.lit(0)).cast("long").alias("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"))


def source_cap(s, d):
    return sampling.cap_sources(_pieces(s, d), 2000)


def source_cap_keep_first(s, d):
    return sampling.cap_sources(_pieces(s, d), 500, keep_first=True)


def weighted_pass(s, d):
    docs = _sized(s, d).select("category", "doc_id", "n_bytes")
    shares = sampling.normal_weights(WEIGHTS, ["de", "en", "es", "fr"])
    return sampling.quota_pass(docs, s.createDataFrame(sorted(shares.items()), "category string, share double"), 500_000)


def weighted_fill(s, d):
    docs = _sized(s, d).select("category", "doc_id", "n_bytes")
    shares = s.createDataFrame(sorted(sampling.normal_weights(WEIGHTS, ["de", "en", "es", "fr"]).items()), "category string, share double")
    target = int(docs.agg(F.sum("n_bytes")).first()[0] * 0.8)  # more than some categories have
    return sampling.fill_up(docs, stored(sampling.quota_pass(docs, shares, target), "quota"), shares, target)


def distinct_turns(s, d):
    """Turns without repeats over all roles, as chunks of a tokenizer corpus are kept."""
    turns = load(s, d, "conversations").select(F.col("role").alias("category"), F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk"), "text")
    return sampling.distinct_chunks(turns).select("category", "doc_id", "chunk", "sha")


def corpus_validator(s, d):
    """Records with planted faults: text changed, line ends mixed, groups lost, by line number."""
    docs = stored(_docs(s, d), "docs")
    records = corpus.clean_records(docs, corpus.reasons(docs, load(s, d, "benchmark")))
    every = lambda n: F.pmod("source_line", F.lit(n)) == 0
    text = F.when(every(7), F.concat("text", F.lit("!"))).when(every(11), F.concat("text", F.lit("\r\n"))).otherwise(F.col("text"))
    broken = records.withColumn("text", text).withColumn("split_group", F.when(every(5), F.lit("x")).otherwise(F.col("split_group"))).withColumn("source_line", F.when(every(13), F.lit(-1)).otherwise(F.col("source_line")))
    return validate.corpus_checks(stored(broken, "records"))


def framing_validator(s, d):
    """Byte tokens of conversations as one stream: 256 starts and 257 ends a text, but every ninth conversation's don't end."""
    open_ = F.pmod("conv_id", F.lit(9)) == 0
    texts = load(s, d, "conversations").select((F.col("conv_id") * 64 + F.col("turn")).alias("place"), (F.octet_length("text") + F.when(open_, 1).otherwise(2)).cast("long").alias("n"), F.encode("text", "UTF-8").alias("b"), open_.alias("open"))
    placed = dataset.offsets(texts, "place", "n")
    codes = F.transform(F.regexp_extract_all(F.hex("b"), F.lit("[0-9A-F]{2}"), F.lit(0)), lambda h: F.conv(h, 16, 10).cast("int"))
    ids = F.concat(F.array(F.lit(256)), codes, F.when(F.col("open"), F.array().cast("array<int>")).otherwise(F.array(F.lit(257))))
    stream = placed.select("token_start", F.posexplode(ids).alias("k", "token")).select((F.col("token_start") + F.col("k")).alias("position"), "token")
    return validate.stream_checks(stream, 258, 256, 257, 2)


def lr_schedule(s, d):
    steps = s.range(0, 1000).select(F.col("id").alias("step"))
    return steps.select("step", F.round(dataset.learning_rate(F.col("step"), 6e-4, 6e-5, 100, 1000), 12).alias("rate"))


def resumable_build(s, d):
    from quernel.streaming import resumable

    return resumable.demo(s, load(s, d, "documents"), load(s, d, "benchmark"))


_ALL = [
    normalize_text, fingerprint_ids, split_group_pages, primary_language_counts, doc_metrics, script_metrics, secret_hits, special_token_texts, quality_reason,
    corpus_funnel, acceptance_rate, rejected_samples, exact_dedup_keep_first, duplicate_ratio, dedup_anti_join, comparison_token_count, near_dup_links, near_dup_audit,
    near_dup_lsh, minhash_signature, decon_exact, decon_containment_50, decon_containment_20, decon_best, eval_ngram_overlap, split_plan, split_summary, pack_offsets,
    window_index, shard_ranges, shard_contiguity, byte_pair_counts, bpe_merges, bpe_roundtrip, token_usage, token_utilization, tokenizer_metrics, probe_rollup, dataset_build, dataset_validator, token_range, epoch_batches, web_scan, clean_corpus_round_trip,
    near_dup_report, evaluation_categories, eval_decontamination, planted_controls, cumulative_totals, count_reconciliation, weighted_fill, distinct_turns, category_distribution, source_contribution, chunk_documents,
    source_cap, source_cap_keep_first, weighted_pass, corpus_validator, framing_validator, lr_schedule, resumable_build,
]


def queries() -> dict:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict:
    return {k: v for k, v in ORACLES.items() if k in queries()}
