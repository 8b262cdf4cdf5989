"""License scans: exact set-similarity join of text blocks with license templates.

A block is a line or, for templates of at least ``LONG`` words, a sliding run of
``RUN`` neighbouring lines without those longer than ``WRAPPED`` characters, as
long notices are often wrapped; a template is the word set of a license notice.
A block matches a template if it holds at least ``THRESHOLD`` of the template's
words. All such pairs are found, with the usual exact filters:

* tokens are ordered by how many documents of the whole table hold them, rare
  ones first;
* prefix filter: a match must hold one of the first ``|T| - need + 1`` tokens;
* length filter: a block with fewer known tokens than ``need`` can't match;
* positional filter: after the first common token, the tokens that are left on
  either side must suffice.

Survivors are verified by intersection. Notices of related licenses share most
of their words, so that one notice can reach the threshold of several: of the
matches of one block within a ``FAMILY`` only the best give a label, by
containment and then by common words (``matches`` returns the others too, with
``best`` false). A tie, as for a notice that names both terms, gives all.

Templates are a constant of this module, so the table that is broadcast has a
fixed size. Besides, exact phrases are looked up at word level. Only
expressions and DataFrame operations are used.

Defined cases: a null text counts as empty; empty texts have no places, empty
label strings and score 0; repeated rows get equal rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernel.llm._native import ALNUM_WORD, NOT_ALNUM, let, row_key
from quernel.session import stored

#: Phrases whose words must stand next to each other.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices whose word sets are joined with blocks.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "distributed under the bsd license"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial license cc by nc"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike license cc by sa"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    # short forms: all words of at most four are needed at this threshold
    ("gpl", "gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2", "mozilla public license"),
    ("epl", "eclipse public license"),
    ("proprietary", "all rights reserved"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced without prior written permission"),
)
#: Labels whose notices differ in a few words only; other labels stand alone.
FAMILY = {"gpl": "gnu", "lgpl": "gnu", "agpl": "gnu", "cc-by": "cc", "cc-by-nc": "cc", "cc-by-sa": "cc"}
THRESHOLD = 0.8
#: Lines of a run, the longest line in one, and the fewest words of a template that may be wrapped.
RUN, WRAPPED, LONG = 8, 200, 12
_VOCABULARY = sorted({w for _, t in TEMPLATES for w in t.split()})


def _token_set(line: Column) -> Column:
    """Known template words of a line, lower-cased over A-Z only."""
    words = F.regexp_extract_all(line, F.lit(ALNUM_WORD), F.lit(0))
    short = F.filter(words, lambda w: F.length(w) == F.octet_length(w))  # template words are ASCII
    return F.array_intersect(F.array(*[F.lit(w) for w in _VOCABULARY]), F.transform(short, F.lower))


def blocks(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, block, tokens, run) of each block that can match: lines, and runs of lines.

    Blocks with fewer known words than any template needs can't match. Runs
    are formed only in texts that as a whole hold enough of a long template.
    ``block`` tells the blocks of one text apart.
    """
    least_line = max(1, min(_need(len(set(t.split())), threshold) for _, t in TEMPLATES))
    long = [x for x in (sorted(set(t.split())) for _, t in TEMPLATES) if len(x) >= LONG]
    least_run = max(1, min(_need(len(x), threshold) for x in long))
    none = F.array().cast("array<struct<block:int,tokens:array<string>,run:boolean>>")

    def block(i: Column, tokens: Column, run: bool) -> Column:
        return F.struct(i.cast("int").alias("block"), tokens.alias("tokens"), F.lit(run).alias("run"))

    def enough(known: Column) -> Column:
        """A text that as a whole holds too little of each long template has no run that matches."""
        return F.array_max(F.array(*[F.size(F.array_intersect(F.array(*[F.lit(w) for w in x]), known)) >= _need(len(x), threshold) for x in long]))

    def runs(short: Column) -> Column:
        every = F.transform(short, lambda x, i: block(i, F.array_distinct(F.flatten(F.slice(short, i + 1, F.lit(RUN)))), True))
        return F.when(let(F.array_distinct(F.flatten(short)), enough), F.filter(every, lambda x: F.size(x["tokens"]) >= least_run)).otherwise(none)

    def made(lines: Column) -> Column:
        single = F.filter(F.transform(lines, lambda x, i: block(i, x["tokens"], False)), lambda x: F.size(x["tokens"]) >= least_line)
        return F.concat(single, let(F.transform(lines, lambda x: F.when(x["short"], x["tokens"]).otherwise(F.array().cast("array<string>"))), runs))

    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(_token_set(x).alias("tokens"), (F.length(x) <= WRAPPED).alias("short")))
    # each text is split into words once, for lines and runs together
    found = docs.where("text IS NOT NULL").select(row_key("doc_id", "text").alias("key"), F.explode(let(lines, made)).alias("b"))
    return found.select("key", "b.block", "b.tokens", "b.run")


def _need(n: int, threshold: float) -> int:
    return -int(-threshold * n // 1)


def matches(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, block, run, label, common, containment, best): every block and template over the threshold."""
    spark = docs.sparkSession
    found = stored(blocks(docs, threshold), "license-blocks")
    counts = found.select(F.explode("tokens").alias("token")).groupBy("token").count()
    known = spark.createDataFrame([(w,) for w in _VOCABULARY], "token string")
    ranks = known.join(counts, "token", "left").select("token", F.coalesce("count", F.lit(0)).alias("n"))
    # as many rows as the templates have words
    order = [r.token for r in ranks.orderBy("n", "token").collect()]
    place = {w: i for i, w in enumerate(order)}
    rows = []
    for number, (label, text) in enumerate(TEMPLATES):
        tokens = sorted(set(text.split()), key=place.__getitem__)
        need = _need(len(tokens), threshold)
        rows += [(tokens[i], number, label, tokens, len(tokens), need, i) for i in range(len(tokens) - need + 1)]
    prefixes = spark.createDataFrame(rows, "token string, template int, label string, words array<string>, n_words int, need int, at int")
    ordered = found.select("key", "block", "run", F.array_intersect(F.array(*[F.lit(w) for w in order]), "tokens").alias("tokens"))
    probes = ordered.select("key", "block", "run", "tokens", F.posexplode("tokens").alias("place", "token"))
    pairs = probes.join(F.broadcast(prefixes), "token").where(
        (F.size("tokens") >= F.col("need")) & (~F.col("run") | (F.col("n_words") >= LONG)) & (1 + F.least(F.col("n_words") - F.col("at") - 1, F.size("tokens") - F.col("place") - 1) >= F.col("need"))
    )
    # the first common token decides, so that each pair is verified once
    common = F.array_intersect("words", "tokens")
    pairs = pairs.select("key", "block", "run", "label", "n_words", "need", "token", common.alias("words")).where(F.get("words", F.lit(0)) == F.col("token"))
    pairs = pairs.where(F.size("words") >= F.col("need"))
    pairs = pairs.select("key", "block", "run", "label", F.size("words").alias("common"), (F.size("words") / F.col("n_words")).alias("containment"))
    family = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in FAMILY.items() for x in kv]), F.col("label")), F.col("label"))
    # a block meets each template once, so these groups hold a few rows
    rank = F.rank().over(Window.partitionBy("key", "block", "run", family).orderBy(F.desc("containment"), F.desc("common")))
    return pairs.withColumn("best", rank == 1)


def _spaced(text: Column) -> Column:
    """The words with one space before each and one at the end."""
    inner = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), NOT_ALNUM, " "))
    return F.when(inner == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def places(spaced: Column, phrase: str) -> Column:
    """struct(n, first, last): places of a phrase in words from 0.

    A phrase can't overlap itself here, as none ends with its first word.
    """
    n = len(phrase.split())
    pieces = F.split(spaced, f"(?i) {phrase}(?= )")
    total = _spaces(spaced) - 1

    def found(p: Column) -> Column:
        return F.when(
            F.size(p) > 1,
            F.struct(
                (F.size(p) - 1).cast("long").alias("n"),
                _spaces(F.get(p, F.lit(0))).cast("long").alias("first"),
                # the last piece starts with the space before its first word and ends with one more
                (total - (_spaces(F.get(p, F.size(p) - 1)) - 1) - n).cast("long").alias("last"),
            ),
        )

    return F.when(spaced.rlike(f"(?i) {phrase} "), let(pieces, found))


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): phrases, labels, score.

    The score is 1 for a document with a phrase, else the best containment of
    a template in one of its blocks, else 0.
    """
    names = list(PHRASES)
    base = docs.select("doc_id", row_key("doc_id", "text").alias("key"), _spaced(F.col("text")).alias("spaced"))
    base = base.select("doc_id", "key", (_spaces(F.col("spaced")) - 1).cast("long").alias("n_words"), *[places(F.col("spaced"), p).alias(f"p{i}") for i, p in enumerate(names)])
    found = [f"p{i}" for i in range(len(names))]
    own = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(PHRASES[names[i]])) for i, c in enumerate(found)]))
    total = sum((F.coalesce(F.col(f"{c}.n"), F.lit(0)) for c in found), F.lit(0))
    base = base.select(
        "doc_id",
        "key",
        "n_words",
        total.cast("long").alias("n_base"),
        F.array_min(F.array(*[F.col(f"{c}.first") for c in found])).alias("first_word"),
        F.array_max(F.array(*[F.col(f"{c}.last") for c in found])).alias("last_word"),
        F.array_sort(own).alias("own"),
    )
    joined = matches(docs, threshold).where("best").groupBy("key").agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
    out = base.join(joined, "key", "left")
    every = F.array_sort(F.array_distinct(F.concat("own", F.coalesce("more", F.array().cast("array<string>")))))
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("own", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


def query(docs: DataFrame) -> DataFrame:
    return scan(docs)


def oracle() -> str:
    """SQL for the same rows: every block against every template, no filters."""
    template = ", ".join(f"('{label}', '{FAMILY.get(label, label)}', [{', '.join(repr(w) for w in sorted(set(text.split())))}])" for label, text in TEMPLATES)
    phrase = ", ".join(f"('{label}', [{', '.join(repr(w) for w in text.split())}])" for text, label in PHRASES.items())
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH t(label, family, tw) AS (VALUES {template}), ph(label, pw) AS (VALUES {phrase}),
d AS (SELECT row_number() OVER () AS r, doc_id, text, {words.format(low.format("coalesce(text, '')"))} AS w FROM documents),
ln AS (SELECT r, generate_subscripts(a, 1) AS i, unnest(a) AS l FROM (SELECT r, string_split(text, chr(10)) AS a FROM d)),
lw AS (SELECT r, i, length(l) AS n, list_distinct({words.format(low.format("l"))}) AS s FROM ln),
block AS (SELECT r, i, false AS run, s FROM lw UNION ALL
  SELECT a.r, a.i, true, list_distinct(flatten(list(CASE WHEN b.n <= {WRAPPED} THEN b.s ELSE [] END))) FROM lw a JOIN lw b ON a.r = b.r AND b.i BETWEEN a.i AND a.i + {RUN - 1} GROUP BY 1, 2),
cand AS (SELECT r, i, run, label, family, len(list_intersect(tw, s)) AS m, len(tw) AS n FROM block, t WHERE NOT run OR len(tw) >= {LONG}),
hit AS (SELECT r, label, m / n AS c FROM (SELECT *, rank() OVER (PARTITION BY r, i, run, family ORDER BY m / n DESC, m DESC) AS k FROM cand WHERE m >= ceil({THRESHOLD} * n)) WHERE k = 1),
pos AS (SELECT r, w, unnest(range(len(w))) AS i FROM d),
base AS (SELECT r, i, label FROM pos JOIN ph ON w[i + 1] = pw[1] AND w[i + 1 : i + len(pw)] = pw),
b AS (SELECT r, count(*) AS n, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY 1),
every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM base UNION ALL SELECT r, label FROM hit) GROUP BY 1),
best AS (SELECT r, max(c) AS c FROM hit GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first_word, last_word, coalesce(b.labels, '') AS base_labels,
  coalesce(every.labels, '') AS labels, CASE WHEN n > 0 THEN 1.0 ELSE coalesce(c, 0) END::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN every USING (r) LEFT JOIN best USING (r)
"""
