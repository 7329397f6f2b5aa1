"""URL, locale and e-mail expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_url(url: Column) -> Column:
    """Remove the text after the last ``?`` wherever it occurs, then every ``?``.

    So ``a?b?c`` becomes ``ab``. A URL without ``?`` is unchanged.
    """
    tail = F.element_at(F.split(url, "[?]"), -1)
    stripped = F.when(url.contains("?"), F.replace(url, tail, F.lit(""))).otherwise(url)
    return F.replace(stripped, F.lit("?"), F.lit(""))


def url_without_query(url: Column) -> Column:
    """Everything before the first ``?``."""
    return F.substring_index(url, "?", 1)


def url_section(cleaned: Column, level: int, home: str = "/homepage") -> Column:
    """Piece ``level + 1`` of the URL split at ``/``: for an absolute URL level 1 is the host.

    Empty or missing pieces become ``home``. On level 1, pieces naming a download or a
    get-started page are one section.
    """
    piece = F.get(F.split(cleaned, "/"), F.lit(level + 1))
    blank = piece.isNull() | (piece == "") | piece.startswith("?")
    section = F.when(blank, F.lit(home))
    if level == 1:
        section = section.when(piece.contains("get-started") | piece.contains("download"), F.lit("/get-started"))
    return section.otherwise(F.concat(F.lit("/"), piece))


def locale_parts(locale: Column) -> dict[str, Column]:
    """First two characters as ``country``, up to five from the fourth on as ``language``."""
    return {"country": F.substring(locale, 1, 2), "language": F.substring(locale, 4, 5)}


def contains_any(column: Column, texts: Sequence[str]) -> Column:
    """One pattern for several texts, so that a derived column is evaluated once."""
    if len(texts) == 1:
        return column.contains(texts[0])
    return column.rlike("|".join(re.escape(t) for t in texts))


def external_email(email: Column, internal: str, keep_null: bool = True) -> Column:
    """True for e-mail addresses not matching the ``LIKE`` pattern ``internal``."""
    outside = ~email.like(internal)
    return email.isNull() | outside if keep_null else outside


def distinct_list(column: str) -> Column:
    """Aggregate: the distinct values of a group, in order, as one comma-separated text; null if none."""
    values = F.array_sort(F.collect_set(column))
    return F.when(F.size(values) > 0, F.array_join(values, ","))
