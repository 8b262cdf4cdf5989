"""Normal form, dataset build and validation, tokenizer artifacts, evaluation checks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quernel.functions import text as T
from quernel.operators import build, corpus, dataset, near, prefix, sampling, tokens, validate


def test_texts_that_are_not_in_normal_form(spark):
    """Composed and decomposed spellings are one text, and matching folds case in full."""
    rows = [(1, "en", "s", "caf\u00e9 au lait"), (2, "en", "s", "cafe\u0301 au lait"), (3, "en", "s", "caf\u00e9 au\r\nlait"), (4, "en", "s", "caf\u00e9 au\nlait")]
    docs = corpus.prepared(spark.createDataFrame(rows, "doc_id long, lang string, source string, text string"))
    assert {r.doc_id: r.first_id for r in corpus.keep_first(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 3}
    words = " ".join(f"wo{i}" for i in range(60))
    items = spark.createDataFrame([(7, f"STRASSE \u0130ki \u017fo {words}")], "item_id long, text string")
    pages = spark.createDataFrame([(1, f"x stra\u00dfe i\u0307ki SO {words.upper()}")], "doc_id long, text string")
    found = corpus.contained(pages, items).collect()
    assert [(r.doc_id, r.item_id, r.shared == r.total) for r in found] == [(1, 7, True)]


@pytest.mark.parametrize("text", ["\u00b5 \u00df", "\u2126", "\u212b", "e\u0301", "\u1e9e\u0130", "plain \u2019 \u20ac", "\u0345", "\u2000x", "\u2160"])
def test_short_cuts_are_exact(spark, text):
    import unicodedata

    r = spark.createDataFrame([(text,)], "t string").select(T.normalize_text(F.col("t")).alias("n"), T.casefold(F.col("t")).alias("c")).first()
    assert (r.n, r.c) == (unicodedata.normalize("NFC", text), text.casefold())


def test_running_sums(spark):
    draw = random.Random(4)
    rows = [(f"g{draw.randrange(3)}", i, draw.randrange(50)) for i in range(300)]
    got = {r.k: r.v_before for r in prefix.running(spark.createDataFrame(rows, "g string, k long, v long"), ["k"], ["v"], ["g"]).collect()}
    for g, k, _ in rows:
        assert got[k] == sum(v for h, j, v in rows if h == g and j < k)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    draw = random.Random(9)
    rows = [(f"d{i:03d}", f"g{i // 4}", " ".join(draw.choice(["alpha", "beta", "caf\u00e9", "x"]) for _ in range(draw.randrange(1, 40)))) for i in range(80)] + [("empty", "g0", "")]
    docs = spark.createDataFrame(rows, "document_id string, split_group string, text string")
    out = str(tmp_path_factory.mktemp("data") / "set")
    tokenizer = tokens.Tokenizer.train([t for _, _, t in rows], 300)
    return docs, out, tokenizer, build.build(docs, tokenizer, out, 0.2, 7, 16, 100)


def test_dataset_build(spark, built):
    docs, out, tokenizer, manifest = built
    with pytest.raises(FileExistsError):
        build.build(docs, tokenizer, out)
    flat = {}
    for name in manifest["splits"]:
        flat[name] = [r.token for r in build.shards.read(spark, f"{out}/{name}").orderBy("position").collect()]
    bos, eos = tokenizer.special_id("<|bos|>"), tokenizer.special_id("<|eos|>")
    texts = []
    for ids in flat.values():
        start = None
        for i, t in enumerate(ids):
            if t == bos:
                start = i
            elif t == eos:
                texts.append(tokenizer.decode_document(ids[start : i + 1]))
    assert sorted(texts) == sorted(r.text for r in docs.collect() if r.text)
    assert sum(s["document_count"] for s in manifest["splits"].values()) == 80 and set(flat) == {"train", "validation"}
    for name, told in manifest["splits"].items():
        assert (told["window_count"], told["tail_token_count"]) == ((len(flat[name]) - 1) // 16, len(flat[name]) - (len(flat[name]) - 1) // 16 * 16)


def test_dataset_faults_are_found(spark, built):
    docs, out, *_ = built
    assert {r.status for r in build.validate_dataset(spark, out, docs).collect()} == {"PASS"}
    path = f"{out}/dataset_manifest.json"
    with open(path) as f:
        good = f.read()
    wrong = json.loads(good)
    wrong["splits"]["train"]["window_count"] += 1
    wrong["splits"]["train"]["document_count"] += 1
    wrong["training_geometry"]["stride"] = 8
    with open(path, "w") as f:
        json.dump(wrong, f)
    try:
        assert {r.name for r in build.validate_dataset(spark, out, docs).collect() if r.status == "FAIL"} == {"train.window_count", "train.documents", "geometry", "split_reproduces"}
    finally:
        with open(path, "w") as f:
            f.write(good)


def test_split_errors(spark):
    one = spark.createDataFrame([("a", "g", 5), ("b", "g", 6)], "document_id string, split_group string, n_bytes long")
    with pytest.raises(ValueError, match="two groups"):
        dataset.split_plan(one, 0.1)
    with pytest.raises(ValueError, match="repeated"):
        dataset.split_plan(one.unionByName(one), 0.1)


def test_tokenizer_artifacts(tmp_path):
    t = tokens.Tokenizer.train(["low lower lowest"] * 3, 280)
    t.save(str(tmp_path / "t"), {"documents": 3})
    assert tokens.Tokenizer.load(str(tmp_path / "t")) == t and t.digest() == tokens.Tokenizer.load(str(tmp_path / "t")).digest()
    assert t.id_to_token(97) == b"a" and t.id_to_token(t.special_id("<|eos|>")) == "<|eos|>"
    ids = t.encode_document("low <|bos|>")
    assert t.decode_document(ids) == "low <|bos|>"
    for bad in (ids[1:], ids[:-1], [*ids[:-1], t.special_id("<|pad|>"), ids[-1]]):
        with pytest.raises(ValueError):
            t.decode_document(bad)
    with pytest.raises(ValueError):
        t.id_to_token(t.size)


def test_compression_and_usage(spark):
    t = tokens.Tokenizer.train(["abab abab"] * 4, 270)
    rows = spark.createDataFrame([("a", "abab"), ("a", "zz"), ("b", "")], "kind string, text string").withColumn("ids", tokens.encoder(spark, t, framed=False)("text")).withColumn("back", tokens.decoder(spark, t)("ids"))
    got = {r.kind: r for r in tokens.compression(rows, "kind").collect()}
    size = {k: sum(len(t.encode(x)) for x in v) for k, v in {"a": ["abab", "zz"], "b": [""]}.items()}
    assert {k: (r.documents, r.tokens, r.all_round_trip) for k, r in got.items()} == {"a": (2, size["a"], True), "b": (1, 0, True), None: (3, size["a"], True)}
    used = {r.kind: r for r in tokens.utilization(tokens.usage(rows, t), t).collect()}
    assert used["byte"].used + used["byte"].unused == 256


def test_reasons_of_evaluation_texts(spark):
    long = " ".join(f"t{i}" for i in range(60))
    training = spark.createDataFrame([("S/1", long), ("S/2", "short text")], "source_key string, text string")
    items = spark.createDataFrame([(1, "s/1", "own"), (2, None, "short text"), (3, "x", "new " + long), (4, None, "entirely new")], "item_id long, source_key string, text string")
    assert {r.item_id: r.reason for r in corpus.training_overlap(items, training).collect()} == {1: "same_training_source_document", 2: "exact_training_text", 3: "training_ngram_overlap", 4: None}


def test_signatures_and_canonical_lines(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 0, 4])], "a array<long>, b array<long>")
    assert df.select(near.signature_similarity(F.col("a"), F.col("b"))).first()[0] == 0.75
    lines = spark.createDataFrame([('{"a":"é","b":1}',), ('{"a": 1}',), ('{"a":"\\u00e9"}',)], "value string")
    assert [r.canonical for r in validate.canonical_lines(lines).collect()] == [True, False, False]


def test_chunk_dedup_keeps_the_first(spark):
    rows = [("b", 1, 0, "x"), ("a", 2, 1, "x"), ("a", 2, 0, "y"), ("c", 1, 0, "x")]
    got = sampling.distinct_chunks(spark.createDataFrame(rows, "category string, doc_id long, chunk long, text string")).collect()
    assert sorted((r.category, r.doc_id, r.chunk) for r in got) == [("a", 2, 0), ("a", 2, 1)]
