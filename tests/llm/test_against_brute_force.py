"""Operators against plain-Python versions and their SQL."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quernel.llm import chat_format, decontaminate, entry, license_scan, line_dedup, lm_score, minhash_dedup, mixing, quality_rules, substring_dedup, toxicity
from quernel.session import load
from tests.llm import brute

TABLES = "/root/testdata/sf0.001"


def plain(value):
    return f"{value:.9g}" if isinstance(value, float) else "NULL" if value is None else str(value)


def same_rows(ours, theirs):
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    at = [theirs.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in ours.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in theirs.fetchall())


def sql(text, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(f"_{name}", rows) if not isinstance(rows, str) else None
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM " + (f"'{rows}'" if isinstance(rows, str) else f"_{name}"))
    return con, con.sql(text)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, name):
    con, theirs = sql(entry.oracle_sql()[name], **{t: f"{TABLES}/{t}.parquet" for t in ("documents", "benchmark", "labels", "conversations")})
    same_rows(entry.queries()[name](spark, TABLES), theirs)


def random_texts(n, rng, vocabulary=400, longest=120):
    names = [f"{a}{b}" for a in "bcdfghjklmnprstvz" for b in ("ana", "ero", "iti", "olu", "ush", "yx")]
    pool = [names[i % len(names)] + str(i // len(names)) for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [" ".join(rng.choices(pool, weights, k=rng.randint(0, longest))) for _ in range(n)]


def near_fixture():
    rng, texts = random.Random(5), []
    for t in random_texts(40, rng):
        texts += [t, t]
        w = t.split()
        for change in (1, 2, 4, 8):  # links near both sides of the threshold
            v = list(w)
            for i in rng.sample(range(len(v)), min(change, len(v))):
                v[i] = f"other{rng.randint(0, 9)}"
            texts.append(" ".join(v))
    return texts + ["", None, "One", "one", "one two", "ONE  TWO", "a b a b a b", "a b a"]


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, words):
    docs = dict(enumerate(near_fixture()))
    wanted = brute.components({i: t or "" for i, t in docs.items()}, words, 80)
    found = minhash_dedup.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), words=words).collect()
    assert {r.doc_id: r.component_id for r in found} == wanted
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(brute.shingles(t, words)) for i, t in docs.items()}
    assert all(r.kept == (r.doc_id == wanted[r.doc_id]) for r in found)


def test_near_duplicates_of_a_large_crossed_group(spark, monkeypatch):
    """Many texts that share most words, so that several blocks are compared."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    rng = random.Random(8)
    common = [f"w{i}" for i in range(60)]
    docs = {}
    for i in range(150):
        own = list(common)
        for k in rng.sample(range(60), rng.randint(3, 9)):
            own[k] = f"x{rng.randint(0, 3)}"
        docs[i] = " ".join(own)
    found = minhash_dedup.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), words=2).collect()
    assert {r.doc_id: r.component_id for r in found} == brute.components(docs, 2, 80)


def test_language_model(spark):
    texts = [*random_texts(150, random.Random(3)), "", None, "Unseen words only", "bana0 bana0 bana0"]
    rows = [(i, t) for i, t in enumerate(texts)]
    training = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    model = brute.Backoff(training, lm_score.ORDER)
    found = {r.doc_id: r for r in lm_score.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        stream = [*brute.low_words(t), "</s>"]
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 5 == 1, len(stream), sum(model.unigrams[w] > 0 for w in stream), model.total)
        assert r.base_score == pytest.approx(sum(np.log10(model.base(w)) for w in stream))
        assert r.score == pytest.approx(model.score(t), abs=1e-6)


def test_language_model_tells_contexts_of_two_words_apart(spark):
    """All words and bigrams are as frequent in either text, only their trigrams differ."""
    texts = ["a b c", "d b e"] * 20 + ["a b e", "d b c"]
    rows = [(i, t) for i, t in enumerate(texts)]
    model = brute.Backoff([t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1], 3)
    found = {r.doc_id: r.score for r in lm_score.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i] == pytest.approx(model.score(t), abs=1e-6) for i, t in rows)
    assert min(found[0], found[1]) > max(found[40], found[41]) + 0.3


@pytest.mark.parametrize(("order", "most"), [(2, 40), (3, 40), (3, 10**6), (1, 5)])
def test_language_model_whatever_the_scan_carries(spark, monkeypatch, order, most):
    """Every n-gram that occurs twice is in the model, however few of them the scan carries."""
    monkeypatch.setattr(lm_score, "TOP", 3)
    texts = random_texts(150, random.Random(3))
    model = brute.Backoff(texts, order)
    frame = spark.createDataFrame([(i, False, t) for i, t in enumerate(texts)], "doc_id long, held_out boolean, text string")
    carried, values = lm_score.train(frame, order=order, most=most)
    assert all(len(keys) <= most for keys, _, _ in carried.hot)
    found = {r.doc_id: r for r in lm_score.score(frame, carried, values).collect()}
    for i, t in enumerate(texts):
        assert found[i].score == pytest.approx(model.score(t), abs=1e-6)


def test_language_model_leaves_keys_without_a_value_in_the_scan(spark):
    """N-grams that occur once are not shuffled, neither to count them nor to score them."""
    texts = random_texts(150, random.Random(3))
    frame = spark.createDataFrame([(i, False, t) for i, t in enumerate(texts)], "doc_id long, held_out boolean, text string")
    model, _ = lm_score.train(frame, order=3)
    assert all(lm_score._holds(sieve, keys).all() and len(keys) for sieve, (keys, _, _) in zip(model.sieves, model.hot[1:], strict=True))
    stream = [x for _, _, flat, ends in lm_score._tokens(pa.array(texts)) for x in lm_score._levels(flat, ends, 3)]
    once = [np.setdiff1d(keys, model.hot[level][0]) for level, (keys, *_) in enumerate(stream, 1)]
    passed = sum(int(lm_score._holds(sieve, keys).sum()) for sieve, keys in zip(model.sieves, once, strict=True))
    assert passed < 0.3 * sum(map(len, once))


@pytest.mark.parametrize("bits", [3, 9])
def test_language_model_with_a_full_bitmap(spark, monkeypatch, bits):
    """A bitmap that is too small spares less and changes no score."""
    monkeypatch.setattr(lm_score, "SIEVE", lm_score.SLICES + bits)
    texts = random_texts(150, random.Random(3))
    model = brute.Backoff(texts, 3)
    frame = spark.createDataFrame([(i, False, t) for i, t in enumerate(texts)], "doc_id long, held_out boolean, text string")
    carried, values = lm_score.train(frame, order=3, most=40)
    found = {r.doc_id: r.score for r in lm_score.score(frame, carried, values).collect()}
    assert all(found[i] == pytest.approx(model.score(t), abs=1e-6) for i, t in enumerate(texts))


def test_language_model_sums_to_one():
    model = brute.Backoff(random_texts(60, random.Random(4), vocabulary=30))
    for context in [(), *list(model.kept)[:40]]:
        if len(context) < 3 and "</s>" not in context:
            total = sum(model.p(context, w) for w in model.unigrams) + model.p(context, "never seen")
            assert total == pytest.approx(1)


def test_language_model_beats_its_base_on_held_out_texts(spark):
    r = lm_score.query(load(spark, "/root/testdata/sf0.01", "documents")).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def test_toxicity_on_held_out_labels(spark):
    tables = "/root/testdata/sf0.01"
    rows = toxicity.query(load(spark, tables, "documents"), load(spark, tables, "labels")).join(load(spark, tables, "labels"), "doc_id").where("held_out").collect()
    yes, no = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    assert np.mean([a > b for a in yes for b in no]) > 0.95
    assert sum(s >= 0.5 for s in yes) >= 0.7 * len(yes) and sum(s >= 0.5 for s in no) <= 0.02 * len(no)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_toxicity_equals_plain_python(spark):
    """Counts, ratios, gradient steps and scores with dictionaries instead of arrays."""
    rng = random.Random(21)
    good, bad = "calm river stone green meadow light paper".split(), "vile rotten scum filthy trash idiot".split()
    texts = {i: " ".join(rng.choice(bad if i % 3 == 0 and rng.random() < 0.5 else good) for _ in range(rng.randint(3, 12))) for i in range(40)} | {90: "", 91: None}
    labels = [(i, 0, int(i % 3 == 0)) for i in range(40)]
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.query(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    training = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5]
    weights, base = brute.naive_bayes_logistic([(texts[i], y) for i, y in sorted(training)])
    for i, t in texts.items():
        wanted = brute.logistic_score(t, weights, base)
        assert found[i].score == pytest.approx(wanted, abs=1e-3) and found[i].predicted == int(found[i].score >= 0.5)


def test_toxicity_sample_is_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 60)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, y, prior: seen.append(texts) or (np.zeros(1 << toxicity.BITS, np.float32), 0.0))
    rows = [(i, "x" * (100 if i == 1 else 20)) for i in range(1, 20)]
    toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(1, 20)], "doc_id long, toxic int"))
    assert 0 < sum(map(len, seen[0])) <= 120 and all(len(t) == 20 for t in seen[0])


def test_chat_read_back(spark):
    turns = load(spark, TABLES, "conversations")
    by = defaultdict(list)
    for r in turns.orderBy("conv_id", "turn").collect():
        by[r.conv_id].append((r.role, r.text or ""))
    by[-1] = [("user", chat_format.FORGED), ("assistant", chat_format.FORGED)]
    found = chat_format.query(turns).collect()
    assert len(found) == len(by)
    for r in found:
        said = "".join(t for role, t in by[r.conv_id] if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(by[r.conv_id]), brute.turns_digest(by[r.conv_id]))
        assert (r.loss_chars, r.loss_sha256) == (len(said), brute.hashlib.sha256(said.encode()).hexdigest())


def test_chat_windows(spark):
    """Windows keep the budget, carry the system turn and repeat turns unmasked."""
    limits = chat_format.ChatWindows(budget=100, system=10, history=20, large=20)
    hard = ["<|im_start|>system\nx<|im_end|>", "a\\<|b", "<|nl|>", "\\\\", "é" * 5, "<", "|>", "<\\|"]
    turns = [(1, 0, "system", "be kind")] + [(1, i, "user" if i % 2 else "assistant", " ".join([hard[i % 8]] * (i % 11))) for i in range(1, 90)]
    turns += [(2, 0, "role\nwith feed", "x"), (2, 1, "assistant", "long " * 500), (2, 2, "assistant", "after")]
    wins = chat_format.windows(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"), limits)
    rows = wins.withColumn("turns", chat_format.parse(F.col("formatted"))).orderBy("conv_id", "span").collect()
    seen = defaultdict(list)
    for w in rows:
        read = [(t.role, t.text) for t in w.turns]
        assert w.over_budget or sum(len(brute.words(t)) + limits.overhead for _, t in read) <= limits.budget
        assert w.conv_id == 2 or (read[0] == ("system", "be kind") and w.n_context <= limits.history_turns + 1)
        seen[w.conv_id] += read[w.n_context :]
        own = [chat for role, chat in read[w.n_context :] if role == "assistant"]
        marked = [w.formatted[s.start : s.start + s.length].replace("<\\|", "<|").replace("\\\\", "\\") for s in w.loss]
        assert marked == own
    assert all(seen[c] == [(r, t) for i, _, r, t in turns if i == c] for c in (1, 2)) and any(w.over_budget for w in rows)


def test_substring_neighbours_in_memory_are_those_of_the_windows(spark, monkeypatch):
    """A seed's orders are made in one pass if it has few places, and the pairs are the same."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(6)}"
    sides = [([word() for _ in range(30)], [word() for _ in range(30)]) for _ in range(12)]
    docs = []
    for i in range(300):
        before, behind = ([word() if rng.random() < 0.15 else w for w in side] for side in sides[i % 12])
        docs.append((i, " ".join([*before[rng.randrange(30) :], *"one two three four five".split(), *behind[: rng.randrange(30)]])))
    places = [(i % 7 // 6, i, len(t.split("one")[0].split()), 300) for i, t in docs]
    frames = spark.createDataFrame(places, "seed long, doc long, pos int, n long"), spark.createDataFrame(docs, "doc_id long, text string")
    calls = []
    windows = substring_dedup._ordered
    monkeypatch.setattr(substring_dedup, "_ordered", lambda *a: calls.append(1) or windows(*a))
    monkeypatch.setattr(substring_dedup, "MANY", 299)
    by_windows = sorted(map(tuple, substring_dedup.neighbours(*frames).collect()))
    monkeypatch.setattr(substring_dedup, "MANY", 300)
    assert sorted(map(tuple, substring_dedup.neighbours(*frames).collect())) == by_windows
    assert len(by_windows) > 20 and calls == [1]


def test_substring_passages(spark):
    rng = random.Random(11)
    filler = lambda n: [f"u{rng.randint(0, 10**9)}" for _ in range(n)]
    exact, fuzzy = filler(60), filler(120)
    docs, spots = {}, {}
    for i in range(30):
        front, kind = filler(rng.randint(0, 200)), (exact, fuzzy, [])[i % 3]
        body = list(kind)
        if kind is fuzzy and i > 1:
            for k in rng.sample(range(120), 6):
                body[k] = f"edit{rng.randint(0, 10**9)}"
        docs[i] = " ".join(front + body + filler(rng.randint(0, 200)))
        spots[i] = (len(front), len(front) + len(body))
    found = defaultdict(set)
    for r in substring_dedup.query(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect():
        found[r.doc_id] |= set(range(r.first_word, r.past_word))
        assert r.n_words == r.past_word - r.first_word and docs[r.other_id]
    for i, (lo, hi) in spots.items():
        wanted = set(range(lo, hi))
        assert len(found[i] & wanted) >= 0.9 * len(wanted) and not found[i] - wanted, i


def test_fuzzy_passages_are_found_at_every_rate(spark):
    """Pairs of passages of 120 words, one of each edited at 5 to 25 %; and one gap of 300 words."""
    rng, docs, spots = random.Random(33), [], {}
    new = lambda n: [f"u{rng.randint(0, 10**9)}" for _ in range(n)]
    rates = (0.05, 0.1, 0.15, 0.2, 0.25)
    for k in range(60):
        source = new(120)
        for copy in (source, [x if rng.random() >= rates[k % 5] else new(1)[0] for x in source]):
            front = new(rng.randint(20, 90))
            spots[len(docs)] = (len(front), rates[k % 5])
            docs.append(front + copy + new(rng.randint(20, 90)))
    long = new(320)
    docs += [new(5) + long + new(5), new(5) + long[:150] + long[151:] + new(5)]
    found = defaultdict(set)
    for r in substring_dedup.query(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")).collect():
        found[r.doc_id] |= set(range(r.first_word, r.past_word))
    for rate in rates:
        own = [(i, lo) for i, (lo, r) in spots.items() if r == rate]
        assert sum(len(found[i] & set(range(lo, lo + 120))) for i, lo in own) >= 0.9 * 120 * len(own), rate
        assert not any(found[i] - set(range(lo, lo + 120)) for i, lo in own)
    assert len(found[len(docs) - 2]) >= 318 and len(found[len(docs) - 1]) >= 317


def test_long_gaps_are_aligned():
    x = np.arange(300)
    assert substring_dedup._common(np.r_[-1, x[1:], -2], np.r_[-3, np.delete(x, 150)[1:], -4]) == 298
    assert substring_dedup._common(x[:190], np.delete(x[:190], 7)) == 189 and substring_dedup._common(x, x[:0]) == 0


@pytest.mark.parametrize(("n", "between"), [(60, 60), (60, 200), (50, 100), (100, 200)])
def test_two_passages_of_one_pair_are_reported(spark, n, between):
    """Two exact passages in the same order, with foreign text between them."""
    one, two = ([f"{k}x{i}" for i in range(n)] for k in "pq")
    rows = [(i, " ".join([*one, *[f"{i}z{k}" for k in range(between)], *two])) for i in range(2)]
    found = sorted(tuple(r)[:3] for r in substring_dedup.query(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == [(i, a, a + n) for i in range(2) for a in (0, n + between)]


@pytest.mark.parametrize("others", [1, 14])
def test_passages_that_no_leader_shares(spark, others):
    """Two documents share an edited passage, and smaller ones hold its runs apart from each other."""
    new = iter(range(10**6))
    runs = [[f"r{k}w{i}" for i in range(9)] for k in range(7)]
    far = lambda n: [f"u{next(new)}" for _ in range(n)]
    docs = [sum((run + far(100) for run in runs[::-1]), []) for _ in range(others)]
    spots = {}
    for _ in range(2):
        spots[len(docs)] = (30, 30 + 69)
        docs.append(far(30) + sum((run + far(1) for run in runs), [])[:-1] + far(30))
    found = substring_dedup.query(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")).collect()
    assert {r.doc_id: (r.first_word, r.past_word) for r in found} == spots


def test_overlapping_runs_are_reported(spark):
    """Brute force: runs of 50 words that two documents share, where every document cuts them elsewhere.

    Ranges may end early at an edge, as stated, so a share of the words is asked for.
    """
    rng = random.Random(12)
    pool = [[f"p{k}q{i}" for i in range(90)] for k in range(6)]
    docs = {}
    for i in range(40):
        w = []
        for _ in range(rng.randint(1, 4)):
            a = rng.randint(0, 35)
            w += pool[rng.randrange(6)][a : a + 55] + [f"z{rng.randint(0, 10**9)}" for _ in range(rng.randint(5, 40))]
        docs[i] = w
    holders = defaultdict(set)
    for i, w in docs.items():
        for k in range(len(w) - 49):
            holders[tuple(w[k : k + 50])].add(i)
    wanted = {(i, k) for i, w in docs.items() for k in range(len(w) - 49) if len(holders[tuple(w[k : k + 50])]) > 1}
    found = defaultdict(set)
    for r in substring_dedup.query(spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")).collect():
        found[r.doc_id] |= set(range(r.first_word, r.past_word))
    assert {i for i, _ in wanted} <= set(found)
    assert sum(len(set(range(k, k + 50)) & found[i]) for i, k in wanted) > 0.93 * 50 * len(wanted)


def test_mixing_takes_what_it_aims_at(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.query(docs).collect()
    again = mixing.query(docs.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    by = defaultdict(lambda: [0, 0.0, 0])
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    for r in rows:
        assert r.taken <= 2 * r.size
        s = by[source[r.doc_id]]
        s[0], s[1], s[2] = s[0] + r.taken, r.target, r.source_size
    assert sum(s[1] for s in by.values()) == pytest.approx(1.5 * sum(s[2] for s in by.values()))
    assert all(abs(taken - target) <= max(5, 0.01 * target) for taken, target, _ in by.values())


def test_mixing_of_repeated_rows(spark):
    """Equal rows are rows of their own: the last document goes in once, and other columns keep their values."""
    rows = [(1, "w " * 100, "s", f"tag{k}") for k in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, tag string")
    planned = mixing.query(frame).collect()
    assert (planned[0].target, sum(r.taken for r in planned)) == (600.0, 600)
    mixed = Counter(r.tag for r in mixing.mix(frame).collect())
    assert sum(mixed.values()) == 6 and set(mixed) == {f"tag{k}" for k in range(4)} and max(mixed.values()) == 2
    same = spark.createDataFrame([(1, "w " * 100, "s", "t")] * 4, frame.schema)
    assert mixing.mix(same).count() == 6
    # a budget that isn't a multiple: the nearest number of whole documents
    odd = mixing.plan(frame, share=575 / 400).collect()
    assert (odd[0].target, sum(r.taken for r in odd)) == (575.0, 600)


def test_decontamination_offsets(spark):
    bench = spark.createDataFrame([(1, "What is the Capital city of the old kingdom by the sea?"), (2, "short one"), (3, None)], "item_id long, text string")
    text = "¡Hola! WHAT is -- the capital\tcity of the OLD kingdom... Then a Short, one."
    row = decontaminate.scan(spark.createDataFrame([(7, text)], "doc_id long, text string"), bench).first()
    assert [text[c.start : c.end] for c in row.chars] == ["WHAT is -- the capital\tcity of the OLD kingdom", "Short, one"]
    assert row["items"] == ["1", "2"] and row.n_hit == 11
    split = decontaminate.scan(spark.createDataFrame([(7, text)], "doc_id long, text string"), bench, shard=2).first()
    assert split["items"] == row["items"] and split.n_hit == row.n_hit


def test_short_items_remove_no_documents(spark):
    bench = spark.createDataFrame([(1, "yes"), (2, "one two three four five six seven eight"), (3, "one two three four five six seven")], "item_id long, text string")
    rows = [(1, "the answer is yes"), (2, "Zero one two three four five six seven eight nine"), (3, "one two three four five six seven ate")]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    for shard in (500, 1):
        left = decontaminate.drop_contaminated(given, bench, shard=shard)
        assert sorted(r.doc_id for r in left.collect()) == [1, 3]


def test_pipeline(spark):
    """The whole pipeline against five brute-force stages."""
    docs = [tuple(r) for r in load(spark, TABLES, "documents").select("doc_id", "text", "source").collect()]
    kept = brute.spread_clean(brute.quality_clean(docs))
    comp = brute.components({i: t for i, t, _ in kept}, 5, 80)
    items = [r.text for r in load(spark, TABLES, "benchmark").collect()]
    left = [(i, t, s) for i, t, s in kept if comp[i] == i and not brute.leaks(t, items)]
    import pandas as pd

    _, theirs = sql(mixing.ORACLE, documents=pd.DataFrame(left, columns=["doc_id", "text", "source"]))
    taken = {r[0]: (r[4] // r[1] if r[1] else 0) for r in theirs.fetchall()}
    wanted = Counter({(i, t): taken[i] for i, t, _ in left if taken[i]})
    assert Counter((r.doc_id, r.text) for r in corpus_pipeline.run(spark, TABLES).collect()) == wanted


def test_line_spread_is_exact_near_the_threshold(spark):
    rows = [(100 * k + s, f"own line {k} {s}\nshared {k}", f"site{s}") for k in range(5, 16) for s in range(k)]
    found = line_dedup.drop_spread_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {(r.doc_id, r.text) for r in found.collect()} == {(i, t) for i, t, _ in brute.spread_clean(rows)}


def test_frequent_lines(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        host, body = f"h{i % 3}", " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(40, 90)))
        extra = "\nSubscribe  to our letter" * (i % 4) + ("\n" + "menu home about contact " * 30 if i % 3 == 0 and i % 2 else "")
        rows.append((i, body + extra, host))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {(r.doc_id, r.text) for r in quality_rules.clean(frame).collect()} == {(i, t) for i, t, _ in brute.quality_clean(rows)}


def test_short_and_wrapped_notices_match(spark):
    grant = "Permission is hereby granted, free of charge, to any person obtaining\n * a copy of this software and associated documentation\n * files (the Software)"
    rows = [(1, "This work is licensed under the GNU General Public License, version 3."), (2, "x\nAll rights reserved.\ny"), (3, grant), (4, "general license, no rights")]
    found = {r.doc_id: (r.labels, r.score) for r in license_scan.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: ("gpl", 1.0), 2: ("proprietary", 1.0), 3: ("mit", 1.0), 4: ("", 0.0)}


NOTICES = {
    "gpl": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial license (CC BY-NC).",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike license (CC BY-SA).",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
}


@pytest.mark.parametrize("width", [0, 28, 60, 160])
def test_related_licenses_are_told_apart(spark, width):
    """One notice has one label, on one line or wrapped over several."""
    import textwrap

    rows = [(i, "Intro\n" + ("\n".join(textwrap.wrap(t, width)) if width else t) + "\nend") for i, t in enumerate(NOTICES.values())]
    found = {r.doc_id: r.labels for r in license_scan.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [set(found[i].split(",")) for i in range(len(rows))] == [{x} for x in NOTICES]


def test_low_thresholds_lose_no_match(spark):
    rows = [(1, "mozilla"), (2, "nothing here of them")]
    found = {(r.key, r.label) for r in license_scan.matches(spark.createDataFrame(rows, "doc_id long, text string"), 0.3).where("label = 'mpl-2'").collect()}
    assert len(found) == 1


def test_license_containment(spark):
    """All pairs of blocks and templates, without any filter."""
    rng, rows = random.Random(6), []
    for i in range(300):
        label, template = rng.choice(license_scan.TEMPLATES)
        w = template.split()
        w = [x for x in w if rng.random() < rng.choice([0.7, 0.85, 0.95, 1])] + ["noise"] * rng.randint(0, 3)
        rng.shuffle(w)
        rows.append((i, "Intro line\n" + " ".join(x.upper() if rng.random() < 0.2 else x for x in w) + ".\nend"))
    wanted = defaultdict(set)
    sets = [(label, license_scan.FAMILY.get(label, label), set(t.split())) for label, t in license_scan.TEMPLATES]
    for i, text in rows:
        lines = [set(x.lower().replace(".", "").split()) for x in text.split("\n")]
        blocks = [(x, 0) for x in lines] + [(set().union(*lines[k : k + license_scan.RUN]), license_scan.LONG) for k in range(len(lines))]
        for own, least in blocks:
            best = defaultdict(list)
            for label, family, t in sets:
                if len(t) >= least and len(own & t) >= 0.8 * len(t) - 1e-9:
                    best[family].append((len(own & t) / len(t), len(own & t), label))
            for hits in best.values():
                wanted[i] |= {h[2] for h in hits if h[:2] == max(x[:2] for x in hits)}
    found = {r.doc_id: r for r in license_scan.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, _ in rows:
        base = {x for x in found[i].base_labels.split(",") if x}
        assert {x for x in found[i].labels.split(",") if x} == wanted[i] | base
