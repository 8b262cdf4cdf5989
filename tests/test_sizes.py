"""Work that has to spread over tasks, and batches whose bytes have to stay bounded, as inputs grow."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from quernel.operators import corpus, near, sampling, tokens, validate
from quernel.session import stored
from quernel.sources import readers, shards, writers
from quernel.streaming import resumable

WORDS = ["harbour", "grain", "salt", "distant", "northern", "towns", "quiet", "morning", "boats", "carry", "hills", "beyond"]


def prose(draw, n):
    return " ".join(draw.choice(WORDS) + draw.choice("abcdefgh") for _ in range(n))


def test_a_batch_may_be_many_files(spark, tmp_path):
    """a part of a build is read by many tasks and judged as one batch, whichever file a first copy lies in."""
    draw = random.Random(1)
    texts = [prose(draw, 90) for _ in range(20)]
    rows = [(i, "en", "s", texts[i % 20]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    items = spark.createDataFrame([(7, prose(draw, 60))], "item_id long, text string")
    docs.orderBy(F.desc("doc_id")).repartitionByRange(6, F.desc("doc_id")).write.parquet(f"{tmp_path}/in")
    judged = resumable.run(spark, f"{tmp_path}/in", docs.schema, f"{tmp_path}/out", items, batch_files=None)
    assert {r.batch for r in judged.select("batch").distinct().collect()} == {0}
    assert sorted(r.doc_id for r in judged.where("reason IS NULL").collect()) == list(range(20))
    seen = {r.reason: r.documents for r in resumable.demo(spark, docs.repartition(6), items).collect()}
    assert seen == {"accepted": 20, "exact_duplicate": 40}


def test_tasks_do_not_follow_shards(spark, tmp_path):
    """many small shards are written and read by as many tasks as there are partitions; runs are cut at shard ends."""
    draw = random.Random(3)
    runs, place, flat = [], 0, []
    for _ in range(300):
        ids = [draw.randrange(900) for _ in range(draw.choice([1, 3, 9, 40]))]
        runs.append((place, ids))
        place, flat = place + len(ids), flat + ids
    path = str(tmp_path / "train")
    stream = spark.createDataFrame(runs, "position long, ids array<int>").repartition(5)
    manifest = shards.write(stream, path, "train", per_shard=7, vocabulary=900)
    assert manifest["total_tokens"] == len(flat) and len(manifest["shards"]) == -(-len(flat) // 7) > 300
    back = shards.read(spark, path, 900)
    assert back.rdd.getNumPartitions() <= 4
    assert [r.token for r in back.orderBy("position").collect()] == flat
    ends = [s["token_end"] for s in manifest["shards"]]
    assert [r.token for r in shards.token_range(spark, path, ends[2] - 3, 20, 900).orderBy("position").collect()] == flat[ends[2] - 3 : ends[2] + 17]


def test_stream_is_checked_where_it_is_read(spark):
    """the checks of a stream from a row for each run give what the checks of a row for each token give."""
    draw = random.Random(8)
    for _ in range(12):
        ids = []
        for _ in range(draw.randrange(1, 30)):
            ids += [256, *[draw.randrange(256) for _ in range(draw.randrange(4))], 257]
        for _ in range(draw.randrange(3)):
            ids[draw.randrange(len(ids))] = draw.choice([0, 255, 256, 257, 258, 300, -1])
        rows = spark.createDataFrame(list(enumerate(ids)), "position long, token int").coalesce(1).repartitionByRange(3, "position").sortWithinPartitions("position")
        want = {r.name: r.failures for r in validate.stream_checks(rows, 258, 256, 257, 2).collect()}
        runs = validate.stream_runs(rows, 258, 256, 257, 2)
        assert validate.run_checks(runs, 256, 257) == want
        assert len(runs) <= 3 and validate.whole_windows(runs, [0, 1, len(ids)], 3) == sum((w + 1) * 3 < len(ids) for w in (0, 1))


def test_batch_encoding_equals_one_text_at_a_time(spark):
    """texts of a batch are encoded together, each different segment once."""
    draw = random.Random(6)
    for kinds in ("ab", "aaab", "abc ", "abcdefgh \n", "aé日"):
        texts = ["".join(draw.choice(kinds) for _ in range(draw.randrange(60))) for _ in range(30)]
        t = tokens.Tokenizer.train(texts, draw.randrange(270, 330), 1)
        ids, sizes = tokens.BatchEncoder(t).encode([x.encode() for x in texts])
        ends = sizes.cumsum().tolist()
        assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends, strict=False)] == [t.encode(x) for x in texts]
        rows = spark.createDataFrame([(x,) for x in [*texts, None]], "text string").withColumn("ids", tokens.encoder(spark, t)("text")).withColumn("back", tokens.decoder(spark, t)("ids")).collect()
        assert all(r.back == r.text and (r.text is None or list(r.ids) == t.encode_document(r.text)) for r in rows)


def test_arrow_batches_of_texts_are_bounded_in_bytes(spark):
    """A batch of long texts holds few of them, whatever the limit in rows."""
    docs = spark.range(0, 600, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 20_000).alias("text"))
    sampling.chunks(docs, 600, 900, 100)

    @F.arrow_udf("long")
    def rows_together(texts: pa.Array) -> pa.Array:
        return pa.array([len(texts)] * len(texts), pa.int64())

    assert docs.select(rows_together("text").alias("n")).agg(F.max("n")).first()[0] * 100_000 <= 2 * (8 << 20)


def shingled(spark, draw):
    """Sets with a passage that all share, near ones, and small ones that leave parts of the signature empty."""
    common = [draw.randrange(-(1 << 63), 1 << 63) for _ in range(60)]
    rows = []
    for k in range(90):
        own = [draw.randrange(-(1 << 63), 1 << 63) for _ in range(20 if k % 3 else 120)]
        for _ in range(2 if k % 10 == 0 else 1):
            rows.append(sorted({*common, *own[: len(own) - len(rows) % 3]}))
    rows += [sorted(draw.sample(common, 6)) for _ in range(100)]
    return spark.createDataFrame([(i, len(g) + 7, g) for i, g in enumerate(rows)], "doc_id long, n_tokens long, grams array<long>")


def test_common_shingles_are_in_few_prefixes(spark, monkeypatch):
    """prefixes hold a part of the shingles, frequent ones last, and no near pair is lost."""
    sets = near.classes(shingled(spark, random.Random(2)))
    grams = {r.rep: set(r.grams) for r in sets.collect()}
    want = {(a, b) for a in grams for b in grams if a < b and len(grams[a] & grams[b]) >= 0.9 * len(grams[a] | grams[b])}
    for frequent in (near.FREQUENT, 5):
        monkeypatch.setattr(near, "FREQUENT", frequent)
        got = {(r.a, r.b) for r in near.links(sets, near.prefix_candidates(sets), ratio=0.0).collect()}
        assert len(want) > 5 and got == want
    monkeypatch.undo()
    rows = near.prefixes(sets.where("n > 30")).collect()
    assert max(sum(r.gram == g for r in rows) for g in {r.gram for r in rows}) <= 12
    assert len(rows) < 0.2 * sum(len(g) for g in grams.values() if len(g) > 30)


def test_full_bands_lose_no_near_pair(spark, monkeypatch):
    """links of classes that share a band are those of all pairs in it, also where very many share it."""
    sets = near.classes(shingled(spark, random.Random(4)))
    rows = {r.rep: (set(r.grams), set(r.bands)) for r in sets.select("rep", "grams", near.bands(near.signature(F.col("grams"))).alias("bands")).collect()}
    want = {(a, b) for a in rows for b in rows if a < b and rows[a][1] & rows[b][1] and len(rows[a][0] & rows[b][0]) >= 0.9 * len(rows[a][0] | rows[b][0])}
    for crowd in (2, near.CROWD):
        monkeypatch.setattr(near, "CROWD", crowd)
        candidates = near.lsh_candidates(sets)
        assert {(r.a, r.b) for r in near.links(sets, candidates, ratio=0.0).collect()} == want and want
    shared = sum(1 for a in rows for b in rows if a < b and rows[a][1] & rows[b][1])
    monkeypatch.setattr(near, "CROWD", 2)
    assert near.lsh_candidates(sets).count() < 0.5 * shared


def test_candidate_grams_are_made_once(spark, monkeypatch):
    """grams of candidates are written once and read; broadcast or not, the reasons are the same."""
    draw = random.Random(7)
    texts = [prose(draw, 80) for _ in range(12)]
    training = spark.createDataFrame([(f"S/{i}", t) for i, t in enumerate(texts)], "source_key string, text string")
    rows = [(i, None, prose(draw, 30) + " " + t[: 120 * (i % 3)]) for i, t in enumerate(texts)] + [(90, "s/3", "x"), (91, None, texts[0])]
    items = spark.createDataFrame(rows, "item_id long, source_key string, text string")
    names, found = [], []
    monkeypatch.setattr(corpus, "stored", lambda df, name: names.append(name) or stored(df, name))
    for most in (corpus.BROADCAST_SHINGLES, 0):
        monkeypatch.setattr(corpus, "BROADCAST_SHINGLES", most)
        found.append(sorted((r.item_id, r.reason) for r in corpus.training_overlap(items, training).collect()))
    words = [t.split() for t in texts]
    known = {tuple(w[k : k + 13]) for w in words for k in range(len(w) - 12)}
    share = lambda t: sum(tuple(w) in known for w in zip(*[t.split()[k:] for k in range(13)], strict=False)) / max(1, len(t.split()) - 12)
    want = [(i, "training_ngram_overlap" if i < 90 and share(t) >= 0.1 and len(t.split()) >= 32 else None) for i, _, t in rows]
    want = [(90, "same_training_source_document") if i == 90 else (91, "exact_training_text") if i == 91 else (i, r) for i, r in want]
    assert found == [want, want] and names == ["wanted-grams"] * 2


def test_passing_documents_alone_are_compared(spark, monkeypatch):
    """Documents that a row gate rejects aren't shingled; verdicts are the same without the short cut."""
    draw = random.Random(12)
    item = prose(draw, 70)
    rows = [(i, ("en", "fr", "en,fr")[i % 3], "s", prose(draw, 100) + (" " + item if i % 2 else "")) for i in range(18)] + [(50, "en", "s", item), (51, "fr", "s", item), (52, "en", "s", "short")]
    docs = corpus.prepared(spark.createDataFrame(rows, "doc_id long, lang string, source string, text string"))
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    seen, best, found = [], corpus.best_verdict, []
    monkeypatch.setattr(corpus, "best_verdict", lambda d, *a, **k: seen.append({r.doc_id for r in d.collect()}) or best(d, *a, **k))
    for most in (corpus.BROADCAST_IDS, 0):
        monkeypatch.setattr(corpus, "BROADCAST_IDS", most)
        found.append({r.doc_id: r.reason for r in corpus.reasons(docs, items).collect()})
    assert found[0] == found[1] and {found[0][i] for i in (1, 50)} == {"non_english", "evaluation_contamination_exact"}
    assert seen[0] == {i for i, r in found[0].items() if r is None or r.startswith("evaluation")} < seen[1] == set(found[0])


def test_json_lines_tasks_do_not_follow_shards(spark, tmp_path):
    """many small shards are written by as many tasks as there are partitions."""
    draw = random.Random(5)
    docs = corpus.prepared(spark.createDataFrame([(i, "en", "s", prose(draw, 80)) for i in range(60)], "doc_id long, lang string, source string, text string"))
    made = corpus.clean_records(docs, docs.withColumn("reason", F.lit(None).cast("string")))
    writers.write_jsonl(made, str(tmp_path / "out"), "source_line", most_bytes=2000)
    files = list((tmp_path / "out").glob("output_shard=*/*.gz"))
    assert len(files) == len({f.parent for f in files}) > 20 and len({f.name[:10] for f in files}) <= 4
    assert readers.clean_corpus(spark, str(tmp_path / "out")).count() == 60


def test_shingles_are_made_once(spark):
    """No filter below the projection of shingles makes them a second time."""
    docs = corpus.prepared(spark.range(0, 9).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.repeat(F.concat(F.col("id").cast("string"), F.lit(" word ")), 40).alias("text")))
    plan = near.features(docs.repartition(3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert {r.doc_id for r in near.features(docs).collect()} == set(range(9))
