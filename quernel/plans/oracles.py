"""SQL for the catalogue's queries, written against the raw tables.

These are independent statements of the same results: on strings where the
engine uses hashes, and on whole joins where it uses filters.
"""

from __future__ import annotations

from quernel.functions.quality import METRICS, NAVIGATION_WORDS, SECRET_PATTERNS

#: Texts by kind that a tokenizer has to give back.
PROBES = (
    ("prose", "Every quiet morning the harbour fills with boats."), ("code", "def f(x):\n    return [i ** 2 for i in range(x)]\n"), ("numbers", "3.14159 1,000,000 0x1F 10^-9"), ("unicode", "naïve café, Ωmega, 日本語, \U0001f600"),
    ("whitespace", "a\tb  c\n\n d "), ("urls", "https://example.com/a?b=c&d=%20e"), ("special", "a<|eos|>b"), ("special", "<|bos|>"), ("prose", ""),
)

_CLEAN = r"replace(replace(nfc_normalize(text), chr(13) || chr(10), chr(10)), chr(13), chr(10))"
_DOCS = f"d AS (SELECT doc_id, lang, source, {_CLEAN} AS text, sha256({_CLEAN}) AS sha FROM documents)"
_FOLD = "replace(replace(lower({}), 'ß', 'ss'), chr(181), chr(956))"
_SPACE = r"[\s\x0B\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_TOKENS = r"regexp_extract_all(" + _FOLD + r", '[\p{{L}}\p{{N}}_]+')"
_CHROME = ", ".join(f"'{w}'" for w in NAVIGATION_WORDS)


def _n(pattern: str, text: str = "text") -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


_METRICS = rf"""
{_DOCS},
l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw FROM d),
l1 AS (SELECT doc_id, regexp_replace(raw, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS s FROM l0),
l AS (SELECT doc_id, count(*) AS lines, count(*) FILTER (WHERE s <> '') AS full_lines, count(DISTINCT s) FILTER (WHERE s <> '') AS kinds,
  coalesce(sum(length(s)), 0) AS chars, count(*) FILTER (WHERE s <> '' AND length(s) < 30) AS short,
  count(*) FILTER (WHERE regexp_full_match(s, '(?i)(?:https?://|www\.)\S+')) AS urls,
  count(*) FILTER (WHERE regexp_replace({_FOLD.format('s')}, '^[ \t:;.|–—>»-]+|[ \t:;.|–—>»-]+$', '', 'g') IN ({_CHROME})) AS nav FROM l1 GROUP BY 1),
w AS (SELECT doc_id, regexp_extract_all(text, '[\p{{L}}\p{{Nl}}\p{{No}}]+') AS ws FROM d),
v AS (SELECT doc_id, len(ws) AS words, len(list_distinct(list_transform(ws, lambda x: {_FOLD.format('x')}))) AS uniq FROM w),
m AS (SELECT doc_id, text, lang, source, sha, length(text)::BIGINT AS characters, strlen(text)::BIGINT AS utf8_bytes, lines::BIGINT AS lines, full_lines::BIGINT AS non_empty_lines,
  words::BIGINT AS words, uniq::BIGINT AS unique_words, greatest(length(text) - {_n(_SPACE)}, 1) AS solid,
  {_n(r'\p{L}')} AS na, {_n(r'[\p{Nd}²³¹]')} AS nd, {_n(r'[\p{P}\p{S}]')} AS np, {_n(r'[\p{Cc}\p{Cf}]')} - {_n(r'[\t\n\x0B\f\r\x1c-\x1f\x{85}]')} AS nc,
  {_n(chr(0xFFFD))}::BIGINT AS replacement_chars, chars, kinds, short, urls, nav FROM d JOIN l USING (doc_id) JOIN v USING (doc_id)),
mm AS (SELECT doc_id, text, lang, source, sha, characters, utf8_bytes, lines, non_empty_lines, words, unique_words, na / solid AS alphabetic_ratio, nd / solid AS digit_ratio,
  np / solid AS punctuation_ratio, nc / solid AS control_ratio, replacement_chars, CASE WHEN non_empty_lines > 0 THEN chars / non_empty_lines ELSE 0 END AS mean_line_length,
  CASE WHEN non_empty_lines > 0 THEN (non_empty_lines - kinds) / non_empty_lines ELSE 0 END AS duplicate_line_ratio,
  CASE WHEN non_empty_lines > 0 THEN short / non_empty_lines ELSE 0 END AS short_line_ratio, CASE WHEN non_empty_lines > 0 THEN urls / non_empty_lines ELSE 0 END AS url_line_ratio,
  CASE WHEN words > 0 THEN unique_words / words ELSE 0 END AS type_token_ratio, CASE WHEN non_empty_lines > 0 THEN nav / non_empty_lines ELSE 0 END AS nav_line_ratio FROM m)"""


# word edges are ASCII ones here
_SECRET = "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in SECRET_PATTERNS) + " END"
_REASON = f"""CASE WHEN regexp_full_match(text, '{_SPACE}*') THEN 'empty_text' WHEN characters < 300 THEN 'too_short' WHEN words < 50 THEN 'too_few_words'
  WHEN replacement_chars > 5 THEN 'replacement_characters' WHEN control_ratio > 0.005 THEN 'control_characters' WHEN alphabetic_ratio < 0.4 THEN 'low_alphabetic_ratio'
  WHEN non_empty_lines >= 4 AND duplicate_line_ratio > 0.5 THEN 'duplicate_lines'
  WHEN non_empty_lines >= 15 AND mean_line_length < 30 AND short_line_ratio >= 0.8 AND nav_line_ratio >= 0.25 THEN 'navigation_boilerplate'
  WHEN url_line_ratio > 0.5 THEN 'url_directory' WHEN words >= 200 AND type_token_ratio < 0.1 THEN 'keyword_wall' WHEN {_SECRET} IS NOT NULL THEN 'secret_material' END"""


def _index(least: int) -> str:
    return f"""
it AS (SELECT item_id, {_TOKENS.format('text')} AS t, {_CLEAN} AS clean FROM benchmark),
ig AS (SELECT DISTINCT item_id, array_to_string(t[i + 1 : i + 8], ' ') AS g FROM (SELECT item_id, t, unnest(range(len(t) - 7)) AS i FROM it WHERE len(t) >= {least} AND len(t) >= 8)),
tot AS (SELECT item_id, count(*) AS total FROM ig GROUP BY 1),
dg AS (SELECT DISTINCT doc_id, array_to_string(t[i + 1 : i + 8], ' ') AS g FROM (SELECT doc_id, t, unnest(range(len(t) - 7)) AS i FROM (SELECT doc_id, {_TOKENS.format('text')} AS t FROM d) WHERE len(t) >= 8)),
part AS (SELECT doc_id, item_id, count(*) AS shared, any_value(total) AS total FROM dg JOIN ig USING (g) JOIN tot USING (item_id) GROUP BY 1, 2 HAVING count(*) / any_value(total) >= 0.8),
ex AS (SELECT doc_id, min(item_id) AS item_id FROM d JOIN it ON sha256(clean) = d.sha WHERE len(t) >= {least} GROUP BY 1),
ver AS (SELECT doc_id, item_id, 'exact_match' AS reason, 1.0::DOUBLE AS containment FROM ex UNION ALL
  SELECT doc_id, item_id, 'containment', shared / total FROM part ANTI JOIN ex USING (doc_id, item_id)),
best AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_matches, row_number() OVER (PARTITION BY doc_id ORDER BY reason <> 'exact_match', containment DESC, item_id) AS k FROM ver) WHERE k = 1)"""


_LATIN = "[A-Za-zÀ-ÖØ-öø-ɏ]"
#: Greek, Cyrillic, Hebrew and Arabic stand for the families that may dominate.
_OTHERS = ", ".join(_n(rf"[{x}]", r"regexp_replace(text, '[^\p{L}]', '', 'g')") for x in (r"\x{370}-\x{3ff}", r"\x{400}-\x{52f}", r"\x{590}-\x{5ff}", r"\x{600}-\x{6ff}", r"\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{ac00}-\x{d7ff}"))
_SCRIPT = rf"{_n(chr(92) + 'p{L}')} >= 100 AND {_n(_LATIN)} < 0.5 * {_n(chr(92) + 'p{L}')} AND greatest({_OTHERS}) >= 0.7 * {_n(chr(92) + 'p{L}')}"

_JUDGED = f"""{_METRICS}, {_index(50).strip()},
rows_ AS (SELECT *, CASE WHEN coalesce(nullif(lower(trim(string_split(lang, ',')[1])), ''), '') <> 'en' THEN 'non_english' WHEN {_SCRIPT} THEN 'language_script_mismatch' ELSE {_REASON} END AS row_reason FROM mm),
firsts AS (SELECT sha, min(doc_id) AS first_id FROM rows_ WHERE row_reason IS NULL GROUP BY 1),
judged AS (SELECT rows_.*, coalesce(row_reason, CASE best.reason WHEN 'exact_match' THEN 'evaluation_contamination_exact' WHEN 'containment' THEN 'evaluation_contamination_containment' END,
  CASE WHEN rows_.doc_id <> first_id THEN 'exact_duplicate' END) AS reason FROM rows_ LEFT JOIN firsts USING (sha) LEFT JOIN best ON best.doc_id = rows_.doc_id)"""

_SIZED = f"""{_DOCS}, z AS (SELECT doc_id, source, lang AS category, 'g' || (doc_id // 3)::VARCHAR AS grp, length(text)::BIGINT AS n_chars, strlen(text)::BIGINT AS n_bytes, strlen(text)::BIGINT + 2 AS n_tokens FROM d)"""
_PLAN = f"""{_SIZED}, gs AS (SELECT grp, sum(n_bytes)::BIGINT AS bytes FROM z GROUP BY 1),
rk AS (SELECT grp, bytes, row_number() OVER o AS position, (sum(bytes) OVER (o ROWS UNBOUNDED PRECEDING))::BIGINT AS cumulative FROM gs
  WINDOW o AS (ORDER BY sha256('LLM_PRETRAIN_SPLIT_V1' || chr(0) || '2026' || chr(0) || grp), grp)),
cut AS (SELECT position AS p FROM rk WHERE position < (SELECT count(*) FROM rk) ORDER BY abs(cumulative - (SELECT sum(bytes) FROM rk) * 0.05::DOUBLE), position LIMIT 1),
plan AS (SELECT grp, bytes, position, cumulative, position <= (SELECT p FROM cut) AS is_validation FROM rk)"""
_NEAR = f"""{_DOCS},
f AS (SELECT doc_id, len(t) AS nt, t FROM (SELECT doc_id, {_TOKENS.format('text')} AS t FROM d) WHERE len(t) >= 50),
g AS (SELECT DISTINCT doc_id, nt, array_to_string(t[i + 1 : i + 8], ' ') AS g FROM (SELECT doc_id, nt, t, unnest(range(len(t) - 7)) AS i FROM f)),
s AS (SELECT doc_id, any_value(nt) AS nt, count(*) AS n, string_agg(g, chr(1) ORDER BY g) AS k FROM g GROUP BY 1),
c AS (SELECT doc_id, nt, n, min(doc_id) OVER (PARTITION BY k) AS rep FROM s),
r AS (SELECT g.* FROM g JOIN c USING (doc_id) WHERE c.rep = g.doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM r x JOIN r y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
q AS (SELECT a, b, shared, ca.n AS na, cb.n AS nb, shared / (ca.n + cb.n - shared) AS similarity, least(ca.nt, cb.nt) / greatest(ca.nt, cb.nt) AS lr FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b),
links AS (SELECT a, b, shared, similarity, lr, greatest(na, nb) - shared <= 16 AND greatest((na - shared) / na, (nb - shared) / nb) <= 0.02 AS safe FROM q WHERE similarity >= 0.9 AND lr >= 0.9)"""

_PLANTED = (
    "['-----BEGIN RSA ' || 'PRIVATE KEY-----', 'AKIA' || 'A1B2C3D4E5F6G7H8', 'ghp_' || repeat('a', 36), 'xoxb-1234567890', 'AIza' || repeat('b', 35), 'sk_live_' || repeat('c', 24), 'sk-' || repeat('d', 32), "
    "'eyJ' || repeat('e', 10) || '.eyJ' || repeat('f', 10) || '.', 'Authorization: Bearer ' || repeat('g', 40), 'sk-short', 'AKIAlowercase']"
)
#: The byte tokens of all turns, placed in the order of their ids in each split.
_TURNS = f"""t AS (SELECT conv_id || ':' || turn AS id, 'c' || conv_id AS grp, {_CLEAN} AS text FROM conversations WHERE {_CLEAN} <> ''),
gs AS (SELECT grp, sum(strlen(text))::BIGINT AS bytes FROM t GROUP BY 1),
rk AS (SELECT grp, bytes, row_number() OVER o AS position, (sum(bytes) OVER (o ROWS UNBOUNDED PRECEDING))::BIGINT AS cumulative FROM gs
  WINDOW o AS (ORDER BY sha256('LLM_PRETRAIN_SPLIT_V1' || chr(0) || '2026' || chr(0) || grp), grp)),
cut AS (SELECT position AS p FROM rk WHERE position < (SELECT count(*) FROM rk) ORDER BY abs(cumulative - (SELECT sum(bytes) FROM rk) * 0.05::DOUBLE), position LIMIT 1),
sp AS (SELECT t.*, CASE WHEN position <= (SELECT p FROM cut) THEN 'validation' ELSE 'train' END AS split, strlen(text)::BIGINT + 2 AS n FROM t JOIN rk USING (grp)),
pl AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY split ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM sp),
sm AS (SELECT split, count(*) AS document_count, count(DISTINCT grp) AS split_group_count, sum(length(text))::BIGINT AS normalized_characters, sum(strlen(text))::BIGINT AS normalized_utf8_bytes,
  sum(n)::BIGINT AS token_count, max(n)::BIGINT AS longest_document, ((sum(n) - 1) // 256)::BIGINT AS window_count, (sum(n) + 9999) // 10000 AS shards FROM sp GROUP BY 1)"""

ORACLES: dict[str, str] = {
    "normalize_text": f"WITH {_DOCS} SELECT doc_id, sha FROM d",
    "fingerprint_ids": f"WITH {_DOCS} SELECT doc_id, sha AS text_sha256, 'cc-' || substr(sha, 1, 24) AS document_id FROM d",
    "split_group_pages": "SELECT page_id, CASE WHEN length(trim(url)) > 0 THEN substr(sha256(trim(url)), 1, 16) ELSE 'none' END AS split_group FROM pages",
    "primary_language_counts": "SELECT nullif(lower(trim(string_split(lang, ',')[1])), '') AS language, count(*) AS documents FROM documents GROUP BY 1",
    "doc_metrics": f"WITH {_METRICS} SELECT doc_id, " + ", ".join(f"round({m}::DOUBLE, 9) AS {m}" if m.endswith("ratio") or m == "mean_line_length" else m for m in METRICS) + " FROM mm",
    "script_metrics": rf"WITH {_DOCS} SELECT doc_id, {_n(r'\p{L}')}::BIGINT AS alphabetic_characters, {_n(r'[A-Za-zÀ-ÖØ-öø-ɏ]')}::BIGINT AS latin_characters, "
    rf"round(CASE WHEN {_n(r'\p{L}')} > 0 THEN {_n(r'[A-Za-zÀ-ÖØ-öø-ɏ]')} / {_n(r'\p{L}')} ELSE 0 END, 9) AS latin_share, "
    rf"{_n(r'\p{L}')} >= 100 AND {_n(r'[A-Za-zÀ-ÖØ-öø-ɏ]')} < 0.5 * {_n(r'\p{L}')} AND {_n(r'\p{L}')} - {_n(r'[A-Za-zÀ-ÖØ-öø-ɏ]')} >= 0.7 * {_n(r'\p{L}')} AS mismatch FROM d",
    "secret_hits": f"WITH {_DOCS}, p AS (SELECT doc_id, text || ' ' || {_PLANTED}[1 + doc_id % 11] AS text FROM d) SELECT doc_id, {_SECRET} AS secret FROM p",
    "special_token_texts": r"""SELECT conv_id, turn, n > 0 AS has_special, contains(text, '<|') AND contains(text, '|>') AS has_both_marks, n AS n_special
      FROM (SELECT *, len(regexp_extract_all(text, '<\|(pad|bos|eos|system|user|assistant|end_turn|tool|tool_result)\|>'))::BIGINT AS n FROM conversations)""",
    "quality_reason": f"WITH {_METRICS} SELECT doc_id, coalesce({_REASON}, 'accepted') AS reason FROM mm",
    "corpus_funnel": f"WITH {_JUDGED} SELECT coalesce(reason, 'accepted') AS reason, count(*) AS documents, sum(characters)::BIGINT AS characters, sum(utf8_bytes)::BIGINT AS utf8_bytes FROM judged GROUP BY 1",
    "acceptance_rate": f"WITH {_JUDGED} SELECT count(*) AS seen, count(*) FILTER (WHERE reason IS NULL) AS accepted, round(count(*) FILTER (WHERE reason IS NULL) / count(*), 9) AS rate FROM judged",
    "rejected_samples": f"WITH {_JUDGED} SELECT reason, source, doc_id, characters FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY source, doc_id) AS k FROM judged WHERE reason IS NOT NULL AND reason <> 'exact_duplicate') WHERE k <= 5",
    "exact_dedup_keep_first": f"WITH {_DOCS} SELECT doc_id, min(doc_id) OVER (PARTITION BY sha) AS first_id, doc_id = min(doc_id) OVER (PARTITION BY sha) AS kept FROM d",
    "duplicate_ratio": f"WITH {_DOCS} SELECT count(*) AS documents, count(DISTINCT sha) AS distinct_texts, round(1 - count(DISTINCT sha) / count(*), 9) AS ratio FROM d",
    "dedup_anti_join": f"WITH {_DOCS} SELECT doc_id, sha FROM d WHERE sha NOT IN (SELECT sha FROM d WHERE source = 'src0')",
    "comparison_token_count": f"""WITH {_DOCS}, t AS (SELECT doc_id, {_TOKENS.format('text')} AS t FROM d)
      SELECT doc_id, len(t)::BIGINT AS n_tokens, len(list_distinct([array_to_string(t[i + 1 : i + 8], ' ') FOR i IN range(greatest(len(t) - 7, 0))]))::BIGINT AS n_shingles FROM t""",
    "near_dup_links": f"WITH {_NEAR} SELECT a, b, shared, round(similarity, 9) AS similarity, safe FROM links",
    "near_dup_audit": f"""WITH {_NEAR}, m AS (SELECT a, b, safe FROM links UNION ALL SELECT b, a, safe FROM links),
      o AS (SELECT c.doc_id, c.rep, (SELECT count(*) FROM m WHERE m.a = c.rep AND m.b < c.doc_id) AS n_any, (SELECT count(*) FROM m WHERE m.a = c.rep AND m.b < c.doc_id AND m.safe) AS n_safe FROM c)
      SELECT doc_id, doc_id > rep OR n_any > 0 AS near, doc_id > rep OR n_safe > 0 AS safe FROM o""",
    "decon_exact": f"WITH d AS (SELECT doc_id, sha256({_CLEAN}) AS sha FROM documents UNION ALL SELECT item_id + 10000000, sha256({_CLEAN}) FROM benchmark), "
    f"i AS (SELECT sha256({_CLEAN}) AS sha, min(item_id) AS item_id FROM benchmark WHERE len({_TOKENS.format('text')}) >= 1 GROUP BY 1) SELECT doc_id, item_id FROM d JOIN i USING (sha)",
    "evaluation_categories": f"""SELECT CASE WHEN item_id % 3 > 0 THEN 'c' || item_id % 3 ELSE 'uncategorized' END AS category, count(*) AS items, count(*) FILTER (WHERE len({_TOKENS.format('text')}) < 50) AS skipped_short
      FROM benchmark GROUP BY 1""",
    "eval_decontamination": rf"""WITH tr AS (SELECT source || '/' || doc_id AS k, {_CLEAN} AS c, text FROM documents WHERE source <> 'src1'),
      i AS (SELECT item_id, NULL AS k, {_CLEAN} AS c, text FROM benchmark UNION ALL SELECT doc_id + 10000000, 'src0/' || (doc_id + 1), {_CLEAN}, text FROM documents WHERE source = 'src1'),
      w AS (SELECT item_id, regexp_extract_all(text, '[^\s\x0B\x1c-\x1f]+') AS w FROM i),
      g AS (SELECT item_id, array_to_string(w[n + 1 : n + 13], chr(31)) AS g FROM (SELECT item_id, w, unnest(range(len(w) - 12)) AS n FROM w WHERE len(w) - 12 >= 20)),
      t AS (SELECT DISTINCT array_to_string(w[n + 1 : n + 13], chr(31)) AS g FROM (SELECT w, unnest(range(len(w) - 12)) AS n FROM (SELECT regexp_extract_all(text, '[^\s\x0B\x1c-\x1f]+') AS w FROM tr) WHERE len(w) >= 13)),
      o AS (SELECT item_id, count(t.g) / count(*) AS share FROM g LEFT JOIN t USING (g) GROUP BY 1)
      SELECT item_id, CASE WHEN k IN (SELECT k FROM tr) THEN 'same_training_source_document' WHEN c IN (SELECT c FROM tr) THEN 'exact_training_text' WHEN share >= 0.1 THEN 'training_ngram_overlap' ELSE 'kept' END AS reason
      FROM i LEFT JOIN o USING (item_id)""",
    "planted_controls": f"""WITH {_DOCS}, p AS (SELECT doc_id AS item_id, {_TOKENS.format('text')} AS t FROM d WHERE length(text) >= 2000 ORDER BY sha256('42:' || doc_id), doc_id LIMIT 10)
      SELECT item_id, true AS found, len(list_distinct([array_to_string(t[i + 1 : i + 8], ' ') FOR i IN range(len(t) - 7)]))::BIGINT AS total FROM p""",
    "cumulative_totals": f"""WITH {_JUDGED}, r AS (SELECT source AS run, count(*) AS seen, count(*) FILTER (WHERE reason IS NULL) AS accepted, coalesce(sum(characters) FILTER (WHERE reason IS NULL), 0) AS characters FROM judged GROUP BY 1)
      SELECT run, (sum(seen) OVER o)::BIGINT AS seen, (sum(accepted) OVER o)::BIGINT AS accepted, (sum(characters) OVER o)::BIGINT AS characters FROM r WINDOW o AS (ORDER BY run ROWS UNBOUNDED PRECEDING)""",
    "count_reconciliation": f"""WITH {_JUDGED}, a AS (SELECT count(*) AS n, count(DISTINCT sha) AS k, sum(characters)::BIGINT AS c, sum(utf8_bytes)::BIGINT AS b FROM judged WHERE reason IS NULL)
      SELECT 'documents' AS measure, 3::BIGINT AS sources, least(n, k) AS smallest, greatest(n, k) AS largest, n = k AS agree FROM a
      UNION ALL SELECT 'characters', 2, c, c, true FROM a UNION ALL SELECT 'utf8_bytes', 2, b, b, true FROM a""",
    "near_dup_report": f"""WITH {_NEAR}, m AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY similarity DESC, lr DESC, a) AS k FROM links)
      SELECT b AS doc_id, count(*) AS matches, count(*) FILTER (WHERE safe) AS safe, count(*) FILTER (WHERE NOT safe) AS ambiguous, min(a) FILTER (WHERE k = 1) AS best_id,
        round(max(similarity), 9) AS best_similarity, count(*) FILTER (WHERE safe) > 0 AS would_remove FROM m GROUP BY 1""",
    "weighted_fill": f"""WITH {_SIZED}, q(category, share) AS (VALUES ('en', 0.5::DOUBLE), ('fr', 0.25), ('de', 0.125), ('es', 0.125)), goal AS (SELECT floor(sum(n_bytes) * 0.8::DOUBLE) AS t FROM z),
      o AS (SELECT category, doc_id, n_bytes, share * (SELECT t FROM goal) AS quota, sha256('42:' || category || ':' || doc_id) AS k,
        coalesce(sum(n_bytes) OVER (PARTITION BY category ORDER BY sha256('42:' || category || ':' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM z JOIN q USING (category)),
      first AS (SELECT coalesce(sum(n_bytes), 0) AS got FROM o WHERE a < quota),
      m AS (SELECT *, coalesce(sum(n_bytes) OVER (ORDER BY a / greatest(quota, 1.0), category, k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o WHERE a >= quota)
      SELECT category, doc_id, n_bytes FROM m WHERE before + (SELECT got FROM first) < (SELECT t FROM goal)""",
    "distinct_turns": """SELECT category, doc_id, chunk, sha FROM (SELECT role AS category, conv_id AS doc_id, turn AS chunk, sha256(text) AS sha, row_number() OVER (PARTITION BY text ORDER BY role, conv_id, turn) AS k FROM conversations) WHERE k = 1""",
    "dataset_build": f"""WITH {_TURNS} SELECT split, document_count, split_group_count, normalized_characters, normalized_utf8_bytes, token_count, longest_document, window_count, window_count * 256 AS prediction_token_count,
      token_count - window_count * 256 AS tail_token_count, shards::BIGINT AS shards, round(normalized_utf8_bytes / sum(normalized_utf8_bytes) OVER (), 9) AS byte_share FROM sm""",
    "dataset_validator": f"""WITH {_TURNS}, b AS (SELECT split, count(DISTINCT w) AS n FROM (SELECT split, window_count, unnest(range(1, shards::BIGINT)) * 10000 // 256 AS w FROM sm) WHERE w < window_count GROUP BY 1)
      SELECT name, 'PASS' AS status, 0::BIGINT AS failures, observed::BIGINT AS observed FROM (
        SELECT 'geometry' AS name, 256 AS observed UNION ALL SELECT 'tokenizer_identity', 265 UNION ALL SELECT 'splits_are_distinct', count(*) FROM sm UNION ALL SELECT 'split_reproduces', count(*) FROM sp
        UNION ALL SELECT split || '.token_count', token_count FROM sm UNION ALL SELECT split || '.window_count', window_count FROM sm UNION ALL SELECT split || '.tail', token_count - window_count * 256 FROM sm
        UNION ALL SELECT split || '.stream_digest', shards FROM sm UNION ALL SELECT split || '.documents', document_count FROM sm UNION ALL SELECT split || '.shard_boundaries', coalesce(n, 0) FROM sm LEFT JOIN b USING (split)
        UNION ALL SELECT split || '.' || c, token_count FROM sm, (SELECT unnest(['endpoints', 'no_other_specials', 'range', 'alternation']) AS c))""",
    "token_range": f"""WITH {_TURNS}, h AS (SELECT a, n, hex(encode(text)) AS h FROM pl WHERE split = 'train'),
      k AS (SELECT a + i AS position, CASE WHEN i = 0 THEN 257 WHEN i = n - 1 THEN 258 ELSE ('0x' || substr(h, 2 * i - 1, 2))::BIGINT END AS token FROM (SELECT a, n, h, unnest(range(n)) AS i FROM h))
      SELECT position // 1000 AS block, count(*) AS tokens, sum(token)::BIGINT AS total FROM k WHERE position >= 8000 AND position < 14000 GROUP BY 1""",
    "epoch_batches": """SELECT window_id, k // 16 AS step, k % 16 AS slot FROM (SELECT i AS window_id, row_number() OVER (ORDER BY sha256('2026:3:' || i), i) - 1 AS k FROM (SELECT unnest(range(1003)) AS i)) WHERE k // 16 < 1003 // 16""",
    "web_scan": f"""WITH r AS (SELECT CASE doc_id % 20 WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'record_not_object' WHEN 3 THEN 'missing_text' WHEN 4 THEN 'text_not_string' WHEN 5 THEN 'text_not_string' WHEN 6 THEN 'invalid_unicode'
      ELSE CASE WHEN lang = 'en' THEN 'read' ELSE 'non_english' END END AS reason, {_CLEAN} AS text FROM documents) SELECT reason, count(*) AS records, CASE WHEN reason = 'read' THEN sum(length(text)) ELSE 0 END::BIGINT AS characters FROM r GROUP BY 1""",
    "clean_corpus_round_trip": f"WITH {_JUDGED} SELECT 'cc-' || substr(sha, 1, 24) AS document_id, doc_id AS source_line, sha AS text_sha256, true AS holds, characters FROM judged WHERE reason IS NULL",
    "probe_rollup": "SELECT kind, count(*) AS probes, sum(strlen(text))::BIGINT AS utf8_bytes, true AS passed FROM (VALUES " + ", ".join(f"('{k}', '{x}')" for k, x in PROBES) + ") t(kind, text) GROUP BY 1",
    "decon_containment_50": f"WITH {_DOCS}, {_index(50).strip()} SELECT doc_id, item_id, shared, total FROM part",
    "decon_containment_20": f"WITH {_DOCS}, {_index(20).strip()} SELECT doc_id, item_id, shared, total FROM part",
    "decon_best": f"WITH {_DOCS}, {_index(20).strip()} SELECT doc_id, item_id, reason, round(containment, 9) AS containment, n_matches FROM best",
    "eval_ngram_overlap": r"""WITH i AS (SELECT item_id, regexp_extract_all(text, '[^\s\x0B\x1c-\x1f]+') AS w FROM benchmark),
      c AS (SELECT item_id, array_to_string(w[k + 1 : k + 13], chr(31)) AS g FROM (SELECT item_id, w, unnest(range(len(w) - 12)) AS k FROM i WHERE len(w) - 12 >= 20)),
      t AS (SELECT DISTINCT array_to_string(w[k + 1 : k + 13], chr(31)) AS g FROM (SELECT w, unnest(range(len(w) - 12)) AS k FROM (SELECT regexp_extract_all(text, '[^\s\x0B\x1c-\x1f]+') AS w FROM documents) WHERE len(w) >= 13))
      SELECT item_id, count(*) AS n_grams, count(t.g) AS hits, count(t.g) / count(*) >= 0.1 AS rejected FROM c LEFT JOIN t USING (g) GROUP BY 1""",
    "split_plan": f"WITH {_PLAN} SELECT grp, bytes, position, cumulative, is_validation FROM plan",
    "split_summary": f"""WITH {_PLAN} SELECT CASE WHEN is_validation THEN 'validation' ELSE 'train' END AS split, count(*) AS document_count, count(DISTINCT grp) AS split_group_count,
      sum(n_chars)::BIGINT AS normalized_characters, sum(n_bytes)::BIGINT AS normalized_utf8_bytes FROM z JOIN plan USING (grp) GROUP BY 1""",
    "pack_offsets": f"WITH {_SIZED} SELECT doc_id, n_tokens, coalesce(sum(n_tokens) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS token_start FROM z",
    "window_index": f"""WITH {_SIZED}, o AS (SELECT doc_id, n_tokens, coalesce(sum(n_tokens) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM z),
      w AS (SELECT unnest(range((SELECT (sum(n_tokens) - 1) // 2048 FROM z)::BIGINT)) AS window_id)
      SELECT window_id, count(*) AS documents, sum(least((window_id + 1) * 2048, a + n_tokens - 1) - greatest(window_id * 2048, a) + 1)::BIGINT AS n_tokens
      FROM w JOIN o ON a <= (window_id + 1) * 2048 AND a + n_tokens - 1 >= window_id * 2048 GROUP BY 1""",
    "shard_ranges": f"""WITH {_PLAN}, t AS (SELECT CASE WHEN is_validation THEN 'validation' ELSE 'train' END AS split, sum(n_tokens)::BIGINT AS total FROM z JOIN plan USING (grp) GROUP BY 1)
      SELECT split, i AS shard_index, i * 1000000 AS token_start, least((i + 1) * 1000000, total) AS token_end, least((i + 1) * 1000000, total) - i * 1000000 AS token_count
      FROM (SELECT split, total, unnest(range(((total + 999999) // 1000000)::BIGINT)) AS i FROM t)""",
    "shard_contiguity": f"""WITH {_PLAN}, t AS (SELECT CASE WHEN is_validation THEN 'validation' ELSE 'train' END AS split, sum(n_tokens)::BIGINT AS total FROM z JOIN plan USING (grp) GROUP BY 1),
      h AS (SELECT split, i, total, i * 1000000 + i % 2 AS start, least((i + 1) * 1000000, total) AS stop, least((i + 1) * 1000000, total) - i * 1000000 AS n FROM (SELECT split, total, unnest(range(((total + 999999) // 1000000)::BIGINT)) AS i FROM t)),
      c AS (SELECT count(*) FILTER (WHERE start <> coalesce(prev, 0)) AS a, count(*) FILTER (WHERE stop - start <> n) AS b, count(*) FILTER (WHERE n <= 0) AS e FROM (SELECT *, lag(stop) OVER (PARTITION BY split ORDER BY i) AS prev FROM h)),
      r AS (SELECT unnest(['contiguous', 'count', 'not_empty']) AS name, unnest([a, b, e]) AS failures FROM c) SELECT name, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status, failures FROM r""",
    "byte_pair_counts": f"""WITH {_DOCS}, h AS (SELECT hex(encode(text)) AS h FROM d), p AS (SELECT substr(h, 2 * i + 1, 4) AS x FROM (SELECT h, unnest(range(length(h) // 2 - 1)) AS i FROM h WHERE length(h) >= 4))
      SELECT ('0x' || substr(x, 1, 2))::BIGINT AS left_byte, ('0x' || substr(x, 3, 2))::BIGINT AS right_byte, count(*) AS n FROM p GROUP BY 1, 2""",
    "category_distribution": f"""WITH {_SIZED} SELECT category, count(*) AS documents, sum(n_bytes)::BIGINT AS utf8_bytes, round(count(*) / sum(count(*)) OVER (), 9) AS document_fraction,
      round(sum(n_bytes) / sum(sum(n_bytes)) OVER (), 9) AS byte_fraction FROM z GROUP BY 1""",
    "source_contribution": f"""WITH {_SIZED} SELECT source, sum(n_bytes)::BIGINT AS utf8_bytes, count(*) AS documents, count(DISTINCT doc_id) AS distinct_documents, max(n_bytes) AS largest, round(sum(n_bytes) / sum(sum(n_bytes)) OVER (), 9) AS share FROM z GROUP BY 1
      ORDER BY 2 DESC, 1 LIMIT 10""",
    "weighted_pass": f"""WITH {_SIZED}, q(category, share) AS (VALUES ('en', 0.5::DOUBLE), ('fr', 0.25), ('de', 0.125), ('es', 0.125)),
      o AS (SELECT category, doc_id, n_bytes, coalesce(sum(n_bytes) OVER (PARTITION BY category ORDER BY sha256('42:' || category || ':' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM z)
      SELECT category, doc_id, n_bytes FROM o JOIN q USING (category) WHERE a < share * 500000""",
    "corpus_validator": f"""WITH {_JUDGED},
      q AS (SELECT doc_id, 'cc-' || substr(sha, 1, 24) AS id, sha, text || CASE WHEN doc_id % 7 = 0 THEN '!' WHEN doc_id % 11 = 0 THEN chr(13) || chr(10) ELSE '' END AS text FROM judged WHERE reason IS NULL),
      c AS (SELECT count(*) FILTER (WHERE id <> 'cc-' || substr(sha256(text), 1, 24)) AS a, count(*) FILTER (WHERE {_CLEAN} <> text) AS b, count(*) FILTER (WHERE regexp_full_match(text, '{_SPACE}*')) AS e,
        count(*) FILTER (WHERE doc_id % 13 = 0) AS f, count(*) FILTER (WHERE doc_id % 5 = 0) AS g, count(*) FILTER (WHERE sha <> sha256(text)) AS h, count(*) - count(DISTINCT sha) AS i FROM q),
      r AS (SELECT unnest(['document_id', 'normal_form', 'not_empty', 'source_line', 'split_group', 'text_sha256', 'unique_text']) AS name, unnest([a, b, e, f, g, h, i]) AS failures FROM c)
      SELECT name, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status, failures FROM r""",
    "framing_validator": """WITH t AS (SELECT conv_id % 9 = 0 AS open, lag(conv_id % 9 = 0) OVER o AS before, lead(conv_id) OVER o IS NULL AS final FROM conversations WINDOW o AS (ORDER BY conv_id * 64 + turn)),
      c AS (SELECT count(*) FILTER (WHERE final AND open) AS a, count(*) FILTER (WHERE before) AS b FROM t),
      r AS (SELECT unnest(['endpoints', 'no_other_specials', 'range', 'alternation']) AS name, unnest([a, 0, 0, b]) AS failures FROM c) SELECT name, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status, failures::BIGINT AS failures FROM r""",
    "lr_schedule": """SELECT step, round(CASE WHEN step < 100 THEN 6e-4 * (step + 1) / 100 ELSE 6e-5 + 0.5 * (6e-4 - 6e-5) * (1 + cos(pi() * least((step - 100) / 900, 1.0))) END, 12)::DOUBLE AS rate
      FROM (SELECT unnest(range(1000)) AS step)""",
}

ORACLES["resumable_build"] = ORACLES["corpus_funnel"]
