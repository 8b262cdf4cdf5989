"""Column helpers shared by the operators that stay inside Catalyst.

Every helper here is an expression or a composition of DataFrame operations;
nothing in this module starts a Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Runs of ASCII white space, and the words between them.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Words of ASCII letters, digits and everything beyond ASCII; A-Z counts as
#: its lower-case letter, so the class lists both.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Copies of a small join side, so that one hot key meets several tasks.
SALTS = 16


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row.

    A lambda variable can't be inlined by the optimizer, so an expensive array
    that a lambda indexes isn't built again for each of its elements.
    """
    return F.get(F.transform(F.array(value), use), 0)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def count_words(text: Column, pattern: str = WORD) -> Column:
    """Words in a text; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def normal_line(line: Column) -> Column:
    """A line as it is compared: lower case, white space squeezed and trimmed."""
    return F.trim(F.regexp_replace(F.lower(line), SPACES, " "))


def row_key(*columns: Column) -> Column:
    """A key for a row that also holds for null and repeated ids."""
    return F.xxhash64(*columns)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def salted_join(large: DataFrame, small: DataFrame, on: Sequence[str], by: Column, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join ``large`` to a much smaller side whose keys may be hot in ``large``.

    Rows of a key spread over ``salts`` tasks by ``by``; each row of ``small``
    is repeated that often. No size of either side is assumed.
    """
    spread = large.withColumn("__salt", F.pmod(by, F.lit(salts)).cast("int"))
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, "__salt"], how).drop("__salt")


def bucketed_prefix(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str | Column], values: Sequence[str], suffix: str = "_before") -> DataFrame:
    """Exclusive prefix sums of ``values`` in each group, in two levels.

    ``bucket`` is a column that rises with ``order`` inside a group. Buckets
    are summed first (with map-side combination), their sums are accumulated
    over the few rows that this leaves, and only the rows of one bucket are
    ever sorted together: a hot group spreads over as many tasks as it has
    buckets. Null group keys form a group of their own.
    """
    keys = [*group, bucket]
    totals = df.groupBy(*keys).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    ahead = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.coalesce(F.sum(f"__t_{v}").over(ahead), F.lit(0)).alias(f"__o_{v}") for v in values],
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"__l_{v}") for v in values])
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        condition = same if condition is None else condition & same
    joined = local.join(offsets, condition, "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"__l_{v}") + F.col(f"__o_{v}")).alias(f"{v}{suffix}") for v in values],
    )


def line_hashes(text: Column) -> Column:
    """Hashes of a text's normalised lines that hold a word, each once."""
    lines = F.transform(F.split(text, "\n"), normal_line)
    return F.array_distinct(F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.xxhash64(x)))


def without_lines(text: Column, hashes: Column) -> Column:
    """The text without the lines whose normal form hashes into ``hashes``."""
    kept = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(hashes, F.xxhash64(normal_line(x))))
    return F.array_join(kept, "\n")
