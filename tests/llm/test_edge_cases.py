"""Nulls, empty and long texts, repeats, ties, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from quernel.llm import chat_format, decontaminate, license_scan, line_dedup, lm_score, minhash_dedup, mixing, quality_rules, substring_dedup, toxicity

#: Names that the operators use for columns of their own.
CLASHES = "key n node label rep bucket row draw size taken host line lines site content band bands gone keeper items spans words grams quality_key line_key leak_key dedup_id mix_key mix_times seed doc leader pos id y toxic_ held_out score __salt".split()
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
TEXTS = [(1, ""), (2, None), (None, "some text without an id"), (None, None), (3, LONG), (3, LONG), (4, "plain words " * 40), (4, "another text under the same id"), (5, " \n\t "), (6, "plain words " * 40), (7, "under the MIT license\n<|im_start|>"), (8, "\u0000 \U0001f600 é ß İ")]


def docs(spark, rows=TEXTS):
    frame = spark.createDataFrame([(i, t, None if k % 4 == 0 else f"s{k % 3}", None) for k, (i, t) in enumerate(rows)], "doc_id long, text string, source string, lang string")
    for name in CLASHES:
        frame = frame.withColumn(name, F.lit("x"))
    return frame


def bench(spark, rows=((1, "word1 word2 word3 word4 word5 word6 word7 word8 word9"), (2, None), (None, "another text under"), (4, ""))):
    return spark.createDataFrame(list(rows), "item_id long, text string").withColumn("w", F.lit(1)).withColumn("pattern", F.lit("x"))


def labels(spark, rows=((1, 1, 0), (2, 1, None), (None, 0, 1), (3, 0, 0), (3, 0, 1), (99, 0, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int").withColumn("id", F.lit(1)).withColumn("y", F.lit(1))


ROWWISE = {
    "toxicity": lambda s, d: toxicity.query(d, labels(s)),
    "mixing": lambda s, d: mixing.query(d),
    "lm_score": lambda s, d: lm_score.query(d),
    "decontaminate": lambda s, d: decontaminate.query(d, bench(s)),
    "license_scan": lambda s, d: license_scan.query(d),
    "quality_rules": lambda s, d: quality_rules.query(d),
    "line_dedup": lambda s, d: line_dedup.query(d),
    "minhash_dedup": lambda s, d: minhash_dedup.query(d),
}
FILTERS = {
    "quality": lambda s, d: quality_rules.clean(d),
    "lines": lambda s, d: line_dedup.drop_spread_lines(d),
    "near": lambda s, d: minhash_dedup.deduplicate(d),
    "leaks": lambda s, d: decontaminate.drop_contaminated(d, bench(s)),
    "mix": lambda s, d: mixing.mix(d),
}


@pytest.mark.parametrize("name", sorted(ROWWISE))
def test_one_row_for_each_row(spark, name):
    rows = ROWWISE[name](spark, docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in TEXTS)
    assert ROWWISE[name](spark, docs(spark).limit(0)).collect() == []


@pytest.mark.parametrize("name", sorted(FILTERS))
def test_filters_keep_columns(spark, name):
    given = docs(spark)
    out = FILTERS[name](spark, given)
    assert out.columns == given.columns and out.count() >= 0
    assert FILTERS[name](spark, given.limit(0)).collect() == []


def test_defined_results(spark):
    scores = {(r.doc_id, r.n_tokens) for r in lm_score.query(docs(spark)).collect()}
    assert {(1, 1), (2, 1), (3, 60_001), (None, 6), (None, 1)} <= scores
    near = minhash_dedup.query(docs(spark)).collect()
    assert {(r.doc_id, r.component_id) for r in near if r.doc_id in (1, 2, 4, 6)} == {(1, 1), (2, 2), (4, 4), (6, 4)}
    leaks = {(r.doc_id, r.n_items) for r in decontaminate.query(docs(spark), bench(spark)).collect()}
    assert {(3, 1), (4, 1), (4, 0), (1, 0), (2, 0)} <= leaks
    licenses = {r.doc_id: r for r in license_scan.query(docs(spark)).collect()}
    assert (licenses[7].base_labels, licenses[7].n_base, licenses[7].first_word, licenses[7].last_word) == ("mit", 1, 0, 0)
    assert (licenses[2].labels, licenses[2].first_word, licenses[2].score) == ("", None, 0.0)
    quality = {(r.doc_id, r.n_words, r.base_failed) for r in quality_rules.query(docs(spark)).collect()}
    assert {(1, 0, True), (2, 0, True), (6, 80, True)} <= quality
    kept = minhash_dedup.deduplicate(docs(spark)).select("doc_id", "text").collect()
    assert sum(r.doc_id == 3 for r in kept) == 1 and not any(r.doc_id == 6 for r in kept)


def test_equal_texts_have_equal_scores(spark):
    rows = [(i, "the same text in all rows here") for i in range(12)]
    assert len({round(r.score, 12) for r in lm_score.query(docs(spark, rows)).collect()}) == 1
    assert len({r.score for r in toxicity.query(docs(spark, rows), labels(spark)).collect()}) == 1


@pytest.mark.parametrize("rows", [(), ((1, 1, 1), (3, 1, 1)), ((1, 1, None),)])
def test_toxicity_without_two_classes(spark, rows):
    found = toxicity.query(docs(spark), labels(spark, rows)).collect()
    assert len({r.score for r in found}) == 1 and all(0 <= r.score <= 1 for r in found)


def test_empty_sides(spark):
    assert all(r.n_items == 0 for r in decontaminate.query(docs(spark), bench(spark).limit(0)).collect())
    assert substring_dedup.query(docs(spark).limit(0)).collect() == []
    assert substring_dedup.query(docs(spark, [(1, ""), (2, None), (None, LONG), (3, LONG), (3, LONG)])).collect() == []


def test_substring_of_long_and_repeated_rows(spark):
    found = {(r.doc_id, r.n_words) for r in substring_dedup.query(docs(spark, [(1, LONG), (1, LONG), (2, LONG), (3, "x " + LONG), (None, LONG)])).collect()}
    assert {i for i, _ in found} == {1, 2, 3}


def test_conversations(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, None, "user", None), (1, 2, None, "x"), (1, 2, "assistant", "y"), (1, 2, "assistant", "y"), (2, 0, "assistant", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("idx", "span", "tokens", "block", "part", "start", "n_tokens"):
        frame = frame.withColumn(name, F.lit("x"))
    found = {r.conv_id: r for r in chat_format.query(frame).collect()}
    assert {c: r.n_turns for c, r in found.items()} == {None: 2, 1: 4, 2: 1, -1: 2}
    assert found[1].loss_chars == 2 and found[None].loss_chars == 1 and found[2].loss_chars == 0
    assert [r.conv_id for r in chat_format.query(frame.limit(0)).collect()] == [-1]
