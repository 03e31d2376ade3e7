"""Message text: white space, lines, commit type, prefix, previews."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gitsift import fixed_values as fv

TYPE_WORDS = "|".join(fv.COMMIT_TYPES)
PREFIX_PATTERN = (
    rf"(?isu)^{fv.SPACE_CLASS}*({TYPE_WORDS})(?:\([^)]*\))?(!)?"
    rf"{fv.SPACE_CLASS}*:{fv.SPACE_CLASS}*(.+)"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(fv.WHITE_SPACE))


def unify_lines(text: Column) -> Column:
    """Every kind of line break becomes a newline."""
    return F.regexp_replace(text, fv.LINE_BREAK, "\n")


def lines(text: Column) -> Column:
    """Lines of a text; a final line break does not open another line."""
    parts = F.split(text, fv.LINE_BREAK)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        let(
            parts,
            lambda p: F.when(
                (F.size(p) > 1) & (F.element_at(p, -1) == ""), F.slice(p, 1, F.size(p) - 1)
            ).otherwise(p),
        )
    )


def first_line(text: Column) -> Column:
    """Line 1 as it stands, ``""`` for null."""
    return F.coalesce(F.split(text, fv.LINE_BREAK, 2)[0], F.lit(""))


def commit_type(message: Column) -> Column:
    """Conventional-Commit type of the first line after stripping, else null."""
    head = first_line(strip(message))
    return F.nullif(F.lower(F.regexp_extract(head, PREFIX_PATTERN, 1)), F.lit(""))


def strip_prefix(message: Column, max_chars: int | None = None) -> Column:
    """Message without its type prefix, cut only if ``max_chars`` says so; ``""`` for null."""

    def cleaned(text: Column) -> Column:
        head = F.substring_index(text, "\n", 1)
        rest = strip(F.regexp_extract(head, PREFIX_PATTERN, 3))
        kept = F.when(head.rlike(PREFIX_PATTERN), rest).otherwise(head)
        tail = F.substring(text, F.length(head) + 1, F.length(text))
        whole = strip(F.concat(kept, tail))
        return whole if max_chars is None else F.substring(whole, 1, max_chars)

    return F.coalesce(let(unify_lines(strip(message)), cleaned), F.lit(""))


def subject(message: Column, limit: int) -> Column:
    """First line cut to ``limit`` characters."""
    return F.substring(first_line(message), 1, limit)


def preview(text: Column, limit: int = fv.PREVIEW_CHARS) -> Column:
    return F.substring(F.coalesce(text, F.lit("")), 1, limit)


def truncate(text: Column, limit: int) -> Column:
    """Cut with a visible mark when longer than ``limit``."""
    body = F.coalesce(text, F.lit(""))
    return F.when(F.length(body) <= limit, body).otherwise(
        F.concat(F.substring(body, 1, limit), F.lit(fv.TRUNCATION_MARK))
    )


def _utc(ts: Column) -> Column:
    """A time that the session's zone shows as UTC does."""
    return F.to_utc_timestamp(ts, F.current_timezone())


def iso_seconds(ts: Column) -> Column:
    return F.date_format(_utc(ts), "yyyy-MM-dd'T'HH:mm:ss")


def day(ts: Column) -> Column:
    return F.date_format(_utc(ts), "yyyy-MM-dd")
