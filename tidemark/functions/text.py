"""Text expressions built from Spark's higher-order array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise(col: Column) -> Column:
    """Lower-case and turn ASCII punctuation into spaces (optional step;
    the clustering job runs on raw text by default)."""
    return F.regexp_replace(F.lower(col), r"\p{Punct}", " ")


def characters(col: Column) -> Column:
    """The string as an array of code points ('' -> empty array)."""
    return F.when(F.length(col) == 0, F.array().cast("array<string>")).otherwise(F.split(col, ""))


def substrings(chars: Column, min_n: int = 1, max_n: int = 4) -> Column:
    """All runs of n elements of an array of characters, n in [min_n, max_n],
    joined (1-grams first).  Taking them from the array keeps a long text linear:
    a substring by position walks the text from its start.

    A character n-gram is such a run with spaces between its characters; since
    that spacing preserves lexicographic order, counting and ranking can run on
    the raw runs and only the kept terms need ``spaced``."""
    size = F.size(chars)

    def of(n):
        starts = F.sequence(F.lit(1), size - F.lit(n) + 1)
        return F.when(
            size >= n, F.transform(starts, lambda i: F.concat(*[F.element_at(chars, i + k) for k in range(n)]))
        ).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.array(*[of(n) for n in range(min_n, max_n + 1)]))


def spaced(col: Column) -> Column:
    """'abc' -> 'a b c' (characters joined by one space)."""
    return F.array_join(characters(col), " ")


def windows(col: Column, n: int) -> Column:
    """The run of ``n`` characters from each position of a text (fewer at its end), in one
    pass over the text.  The k-grams of the text are the windows' prefixes of k."""
    return F.regexp_extract_all(col, F.lit(rf"(?s)(?=(.{{1,{n}}}))."), 1)


def prefixes(window: Column, min_n: int, max_n: int) -> Column:
    """The prefixes of a window with ``min_n`` to ``max_n`` characters, null beyond its
    end."""
    return F.array(*[F.when(F.length(window) >= n, F.substring(window, 1, n)) for n in range(min_n, max_n + 1)])
