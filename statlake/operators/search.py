"""Alias-aware substring search over text columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import (
    NAME_ONLY_ALIASES, SEARCH_ALIASES, SEARCH_HIT_COLUMNS, SEARCH_RANKS, UNRANKED,
)
from ..functions.lookups import lookup
from ..plans.sizing import quoted
from .filters import from_source


def expand_terms(query: str | None,
                 aliases: Mapping[str, Sequence[str]] = SEARCH_ALIASES) -> tuple[str, ...]:
    """Lower-case needles a query stands for; none for a blank query."""
    word = (query or "").strip().lower()
    if not word:
        return ()
    return tuple(n.lower() for n in aliases.get(word, (word,)))


def search_rows(
    df: DataFrame,
    query: str | None,
    *,
    source: str | None = None,
    columns: Sequence[str] = ("name", "title"),
    long_columns: Sequence[str] = ("description",),
    aliases: Mapping[str, Sequence[str]] = SEARCH_ALIASES,
    name_only: Sequence[str] = NAME_ONLY_ALIASES,
) -> DataFrame:
    """Rows where a needle occurs, ignoring case, in any of the text columns.

    ``long_columns`` are skipped for aliases in ``name_only``.  Columns the table lacks
    count as empty.  Needles are literal text.
    """
    out = from_source(df, source)
    needles = expand_terms(query, aliases)
    if not needles:
        return out
    searched = list(columns)
    if (query or "").strip().lower() not in name_only:
        searched += list(long_columns)
    # Each text is put in lower case once, however many needles it is searched for.
    texts = [F.lower(F.coalesce(F.col(quoted(c)).cast("string"), F.lit(""))) for c in searched if c in out.columns]
    if not texts:
        return out.limit(0)
    return out.filter(F.exists(F.array(*texts), lambda t: reduce(
        lambda x, y: x | y, [F.contains(t, F.lit(n)) for n in needles])))


def ranked(
    df: DataFrame,
    query: str | None,
    *,
    ranks: Mapping[str, Mapping[str, int]] = SEARCH_RANKS,
    name: str = "name",
    column: str = "rank",
) -> DataFrame:
    """Add the rank of each row's name for this query (``UNRANKED`` if it has none)."""
    table = ranks.get((query or "").strip().lower(), {})
    if not table:
        return df.withColumn(column, F.lit(UNRANKED))
    return df.withColumn(column, lookup(F.col(name), dict(table), UNRANKED))


def search_catalog(df: DataFrame, query: str | None, *, source: str | None = None,
                   **options) -> DataFrame:
    """Search hits; headline datasets of an alias come first, the rest of them by name."""
    ranks = options.pop("ranks", SEARCH_RANKS)
    hits = search_rows(df, query, source=source, **options)
    if ranks.get((query or "").strip().lower()) and "name" in df.columns:
        hits = ranked(hits, query, ranks=ranks, column="__rank").orderBy("__rank", "name").drop("__rank")
    return hits


def compact_hits(df: DataFrame) -> DataFrame:
    """The identifying columns of a search hit, those the table has."""
    return df.select(*[c for c in SEARCH_HIT_COLUMNS if c in df.columns])
