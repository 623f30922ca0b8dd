"""Text columns: whitespace, labels, Python-style lists, JSON cut-out."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse_whitespace(text: Column) -> Column:
    """Every run of (Unicode) white space becomes one space; ends are trimmed."""
    # single spaces, most of all white space, are left as they are
    return F.trim(F.regexp_replace(text, r"(?U)\s{2,}|[^\S ]", " "))


def _without_label(text: Column, label: str) -> Column:
    name = re.sub(r"([^A-Za-z0-9 ])", r"\\\1", label)
    pattern = rf"(?iU)^(?:step\s*\d+\s*[:.-]?\s*)?(?:{name}\s*[:.-]?\s*)?"
    return F.regexp_replace(text, pattern, "")


def strip_leading_label(text: Column, label: str) -> Column:
    """Drop one leading ``Step n:`` and one repeat of the label, in any case."""
    return F.regexp_replace(_without_label(text, label), r"(?U)^\s+|\s+$", "")


def collapsed_without_label(text: Column, label: str) -> Column:
    """``strip_leading_label`` after ``collapse_whitespace``, which leaves no white space but spaces."""
    return F.trim(_without_label(collapse_whitespace(text), label))


def episode_id_from_url(url: Column) -> Column:
    """Digits after the first ``ep`` that has digits, as a number; null without a match."""
    return F.regexp_extract(url, r"ep(\d+)", 1).try_cast("bigint")


def route_label(label: Column) -> Column:
    """struct(kind, text): ``subtask`` or ``object`` with what follows the colon, untrimmed;
    null for any other label."""
    return F.when(
        label.startswith("subtask:"),
        F.struct(F.lit("subtask").alias("kind"), F.substring(label, 9, 1 << 30).alias("text")),
    ).when(
        label.startswith("object:"),
        F.struct(F.lit("object").alias("kind"), F.substring(label, 8, 1 << 30).alias("text")),
    )


def python_string(text: Column) -> Column:
    """A string as Python prints it: single quotes, or double ones around a lone ``'``."""
    plain = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for char, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        plain = F.replace(plain, F.lit(char), F.lit(shown))
    double = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(single)


def list_repr(items: Column) -> Column:
    """A list of strings as Python prints it."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, python_string), ", "), F.lit("]"))


def int_list_repr(items: Column) -> Column:
    """A list of whole numbers as Python prints it."""
    return F.concat(F.lit("["), F.array_join(items.cast("array<string>"), ", "), F.lit("]"))


#: Code fences, and the one that ends an answer.
FENCE, LAST_FENCE = r"(?U)```(?:json|markdown|md|text)?\s*", r"(?U)\s*```$"


def without_fences(raw: Column) -> Column:
    """An answer trimmed and without code fences.  A text from ``{`` to ``}`` without fences and
    carriage returns is left as it is, which spares the search."""
    lines = F.replace(F.replace(raw, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    text = F.regexp_replace(lines, r"(?U)^\s+|\s+$", "")
    text = F.regexp_replace(text, FENCE, "")
    text = F.regexp_replace(text, LAST_FENCE, "")
    bare = raw.startswith("{") & raw.endswith("}") & ~raw.contains("```") & ~raw.contains("\r")
    return F.when(bare, raw).otherwise(text)


def outer_object(text: Column) -> Column:
    """From the first ``{`` to the last ``}``, if there is such a part."""
    first = F.instr(text, "{")
    last = F.length(text) - F.instr(F.reverse(text), "}") + 1
    cut = (first > 0) & F.contains(text, F.lit("}")) & (last > first)
    return F.when(cut, F.substring(text, first, last - first + 1)).otherwise(text)


def extract_json_object(raw: Column) -> Column:
    """What is left of an answer without code fences, from the first ``{`` to the last ``}``."""
    return outer_object(without_fences(raw))


def fill(template: str, **values: Column) -> Column:
    """A template's pieces and columns side by side; a value is never read as a template."""
    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(values[name].cast("string"))
    return F.concat(*parts)


def scene_stem(scene_id: Column) -> Column:
    """Last part of a path without its last suffix."""
    name = F.regexp_extract(scene_id, r"([^/]*)/*$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def video_name(episode_id: Column) -> Column:
    return F.format_string("ep%05d.mp4", episode_id)


def frame_name(episode_id: Column, frame: Column, suffix: str = "jpg") -> Column:
    return F.format_string(f"ep%05d_frame%04d.{suffix}", episode_id, frame)


def crop_name(episode_id: Column, scene: Column) -> Column:
    return F.format_string("ep%05d_%s", episode_id, scene)
