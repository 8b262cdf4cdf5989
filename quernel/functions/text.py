"""Scalar text functions: normal form, identities, comparison tokens, shingles."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: White space as Python's str.isspace() has it.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITE) + "]"
#: Letters, numbers and the underscore; Java's own \\w also takes marks.
TOKEN = r"[\p{L}\p{N}_]+"
# The reserved literals, in the order of their ids.
SPECIALS = ("<|pad|>", "<|bos|>", "<|eos|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end_turn|>", "<|tool|>", "<|tool_result|>")
#: Text beyond these code points may not be in NFC: below U+0300 nothing composes,
#: and of the punctuation from U+2010 to U+2027 and the euro sign nothing does.
_SAFE_NFC = r"\x{0}-\x{2ff}\x{2010}-\x{2027}\x{20ac}"
#: Text beyond these may fold to something else than its lower case.
SAFE_FOLD = r"\x{0}-\x{ff}\x{2010}-\x{2027}\x{20ac}"


def beyond(text: Column, members: str) -> Column:
    """A text has a code point outside the class, which holds ASCII at least.

    One possessive run over the text; a search for an excluded class would try
    each place anew, at ten times the cost.
    """
    return (F.octet_length(text) > F.length(text)) & ~text.rlike(rf"\A[{members}]*+\z")


def blank_trim(text: Column) -> Column:
    """Python's strip()."""
    return F.btrim(text, F.lit(WHITE))


@F.pandas_udf(StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


@F.pandas_udf(StringType())
def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else x.casefold())


def line_feeds(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def normalize_text(text: Column) -> Column:
    """NFC with line feeds; nothing is trimmed or squeezed.

    NFC isn't among the built-in functions. Texts without a code point that
    could compose or decompose are in NFC and stay in the JVM; only the others
    cross to Arrow, as the first ones are null there.
    """
    return line_feeds(F.coalesce(_nfc(F.when(beyond(text, _SAFE_NFC), text)), text))


def casefold(text: Column, of: Column | None = None) -> Column:
    """Full case folding; ``of`` may name a text that has all code points of ``text`` and is at hand.

    Of Latin-1, the sharp s and the micro sign alone fold to something else
    than their lower case, so texts in it stay in the JVM; others cross to Arrow.
    """
    plain = F.replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), F.lit("\u00b5"), F.lit("\u03bc"))
    return F.coalesce(_folded(F.when(beyond(text if of is None else of, SAFE_FOLD), text)), plain)


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def document_id(text: Column) -> Column:
    return F.concat(F.lit("cc-"), F.substring(sha256_hex(text), 1, 24))


def split_group(url: Column, fallback: Column) -> Column:
    """A digest of the URL, so that one page stays on one side; else the id."""
    bare = blank_trim(url)
    return F.when(F.length(bare) > 0, F.substring(sha256_hex(bare), 1, 16)).otherwise(fallback)


def primary_language(lang: Column) -> Column:
    """The first of comma-separated codes, in lower case; null for blank."""
    first = F.lower(blank_trim(F.get(F.split(lang, ","), F.lit(0))))
    return F.nullif(first, F.lit(""))


def chunk_document_id(category: Column, path: Column, record: Column, chunk: Column, sha: Column) -> Column:
    """Identity of a piece of a source file; missing parts are empty, not skipped."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (category, path, record, chunk, sha)]
    return F.substring(F.sha2(F.concat_ws("\u0000", *parts), 256), 1, 24)


def source_key(path: Column, record: Column) -> Column:
    return F.struct(F.lower(path).alias("path"), record.alias("record"))


def comparison_tokens(text: Column) -> Column:
    """Case-folded words of letters, numbers and underscores."""
    return F.regexp_extract_all(casefold(text), F.lit(TOKEN), F.lit(0))


def grams(tokens: Column, n: int, separator: str = " ") -> Column:
    """Every run of ``n`` tokens as a string; none if there are fewer."""

    def runs(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        return F.when(F.size(words) >= n, F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), separator))).otherwise(F.array().cast("array<string>"))

    return F.get(F.transform(F.array(tokens), runs), 0)


def gram_keys(tokens: Column, n: int) -> Column:
    """Hashes of the runs of ``n`` tokens; the form for joins on whole tables."""

    def runs(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - n)
        return F.when(F.size(words) >= n, F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))).otherwise(F.array().cast("array<bigint>"))

    return F.get(F.transform(F.array(tokens), runs), 0)


def has_special(text: Column, specials: Sequence[str] = SPECIALS) -> Column:
    """A text holds one of the reserved literals."""
    found = F.lit(False)
    for literal in specials:
        found = found | text.contains(literal)
    return found


def has_both_marks(text: Column) -> Column:
    """The stricter page rule: an opening and a closing mark, anywhere."""
    return text.contains("<|") & text.contains("|>")


def count_specials(text: Column, specials: Sequence[str] = SPECIALS) -> Column:
    """Non-overlapping occurrences of all reserved literals."""
    total = F.lit(0)
    for literal in specials:
        total = total + F.floor((F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))) / len(literal))
    return total.cast("long")


def length_ratio(a: Column, b: Column) -> Column:
    """Smaller over larger; two empty things are equal."""
    return F.when((a == 0) & (b == 0), F.lit(1.0)).otherwise(F.least(a, b) / F.greatest(a, b))


def length_bucket(n: Column) -> Column:
    return F.when(n <= 4, n.cast("string")).when(n <= 8, "5-8").when(n <= 16, "9-16").otherwise("17+")


@F.pandas_udf(StringType())
def _ascii_part(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


def slug(title: Column, longest: int = 80) -> Column:
    """A file name part: ASCII letters and digits of the NFKD form with single underscores."""
    ascii_ = F.coalesce(_ascii_part(F.when(title.rlike(r"[^\x00-\x7f]"), title)), title)
    plain = F.regexp_replace(F.lower(ascii_), r"[^a-z0-9]+", "_")
    short = F.regexp_replace(F.substring(F.regexp_replace(plain, "^_+|_+$", ""), 1, longest), "_+$", "")
    return F.when(short == "", F.lit("untitled")).otherwise(short)
