"""Answers of language models: commit lines, JSON, class words, tool calls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.functions.text import TYPE_WORDS, first_line, let, lines, strip

LINE_PATTERN = (
    rf"(?iu)^({TYPE_WORDS})(?:\(([^)]*)\))?(!)?{fv.SPACE_CLASS}*:{fv.SPACE_CLASS}*(.+)$"
)
NOT_WORD = r"[^\p{L}\p{N}_]"
CLASS_WORD = rf"(?is)(?:^|{NOT_WORD})({'|'.join(fv.TARGET_CLASSES)})(?:$|{NOT_WORD})"
GREEDY_OBJECT = r"(?s)\{.*\}"
SHORT_OBJECT = r"(?s)\{.*?\}"
FENCES = rf"(?md)^```(?:json)?{fv.SPACE_CLASS}*|{fv.SPACE_CLASS}*```$"


def parse_json(text: Column) -> Column:
    """Variant holding ``[value]`` when the whole text is one JSON value, else null.

    The brackets make anything after the value an error.
    """
    boxed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    single = (F.try_variant_get(boxed, "$[0]", "variant").isNotNull()
              & F.try_variant_get(boxed, "$[1]", "variant").isNull())
    return F.when(single, boxed)


def is_object(boxed: Column) -> Column:
    value = F.try_variant_get(boxed, "$[0]", "variant")
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def json_text(boxed: Column, key: str) -> Column:
    """Field of the boxed object as stripped text; ``""`` for a missing or null field."""
    return strip(F.coalesce(F.try_variant_get(boxed, f"$[0].{key}", "string"), F.lit("")))


def _parsed(kind: Column, scope: Column, subject: Column) -> Column:
    return F.struct(kind.alias("parsed_type"), scope.alias("scope"), subject.alias("subject"))


def parse_commit_line(text: Column) -> Column:
    """Type, scope and subject of the first commit-shaped line.

    Without one: null, ``""`` and the first line cut to 120 characters.
    """
    stripped = F.transform(lines(F.coalesce(text, F.lit(""))), strip)
    match = F.get(F.filter(stripped, lambda line: line.rlike(LINE_PATTERN)), F.lit(0))

    def parts(line: Column) -> Column:
        return F.when(
            line.isNotNull(),
            _parsed(
                F.lower(F.regexp_extract(line, LINE_PATTERN, 1)),
                strip(F.regexp_extract(line, LINE_PATTERN, 2)),
                strip(F.regexp_extract(line, LINE_PATTERN, 4)),
            ),
        ).otherwise(
            _parsed(
                F.lit(None).cast("string"), F.lit(""),
                F.substring(first_line(strip(text)), 1, fv.RAW_PREVIEW_CHARS),
            )
        )

    return let(match, parts)


def parse_json_message(text: Column) -> Column:
    """Type, scope and subject of a JSON answer, else of the widest ``{...}``, else of a line.

    A type outside the five classes, or a JSON value that is no object, gives a null type.
    """

    def from_object(boxed: Column) -> Column:
        kind = F.lower(json_text(boxed, "type"))
        return _parsed(
            F.when(kind.isin(fv.TARGET_CLASSES), kind),
            F.when(is_object(boxed), json_text(boxed, "scope")).otherwise(""),
            F.when(is_object(boxed), json_text(boxed, "subject")).otherwise(""),
        )

    inner = F.nullif(F.regexp_extract(text, GREEDY_OBJECT, 0), F.lit(""))
    boxed = F.coalesce(parse_json(text), parse_json(inner))
    return let(
        boxed, lambda b: F.when(b.isNotNull(), from_object(b)).otherwise(parse_commit_line(text))
    )


def parse_message(text: Column, strategy: Column) -> Column:
    return F.when(strategy == "json_mode", parse_json_message(text)).otherwise(
        parse_commit_line(text)
    )


def parse_class(raw: Column, strategy: Column) -> Column:
    """Class named by an answer, null when none is.

    JSON answers: the type of the object, or null if it is no class; when the
    text is no JSON, the first ``{...}``, and only then the first class word.
    """
    word = F.nullif(F.lower(F.regexp_extract(raw, CLASS_WORD, 1)), F.lit(""))

    def target(boxed: Column) -> Column:
        kind = F.lower(json_text(boxed, "type"))
        return F.when(kind.isin(fv.TARGET_CLASSES), kind)

    inner = F.nullif(F.regexp_extract(raw, SHORT_OBJECT, 0), F.lit(""))
    from_json = let(
        parse_json(raw),
        lambda b: F.when(b.isNotNull(), target(b)).otherwise(
            F.coalesce(target(parse_json(inner)), word)
        ),
    )
    return F.when(F.coalesce(raw, F.lit("")) == "", F.lit(None).cast("string")).otherwise(
        F.when(strategy == "json_mode", from_json).otherwise(word)
    )


def one_liner(kind: Column, scope: Column, subject: Column, raw: Column) -> Column:
    """``type(scope): subject``; without a type the subject, else the first raw line."""
    spare = F.when(subject != "", subject).otherwise(
        F.substring(first_line(raw), 1, fv.RAW_PREVIEW_CHARS)
    )
    scoped = F.when(scope != "", F.concat(F.lit("("), scope, F.lit(")"))).otherwise("")
    full = strip(F.concat(kind, scoped, F.lit(": "), subject))
    return (
        F.when(F.coalesce(kind, F.lit("")) != "", full)
        .when(F.coalesce(raw, F.lit("")) == "", "")
        .otherwise(spare)
    )


def in_target(kind: Column) -> Column:
    return F.coalesce(kind.isin(fv.TARGET_CLASSES), F.lit(False))


def tool_call(text: Column) -> Column:
    """``struct<name, arguments>`` of a tool call written as JSON in a message, else null."""
    cleaned = F.regexp_replace(strip(text), FENCES, "")

    def call(boxed: Column) -> Column:
        name = F.coalesce(*[
            F.nullif(F.try_variant_get(boxed, f"$[0].{key}", "string"), F.lit(""))
            for key in ("name", "tool")
        ])
        arguments = F.coalesce(*[
            F.nullif(F.to_json(F.try_variant_get(boxed, f"$[0].{key}", "variant")), F.lit("{}"))
            for key in ("arguments", "args", "parameters")
        ], F.lit("{}"))
        return F.when(
            is_object(boxed) & name.isin(fv.TOOL_NAMES),
            F.struct(name.alias("name"), arguments.alias("arguments")),
        )

    def parsed(body: Column) -> Column:
        inner = F.nullif(F.regexp_extract(body, GREEDY_OBJECT, 0), F.lit(""))
        return let(F.coalesce(parse_json(body), parse_json(inner)), call)

    return let(cleaned, parsed)
