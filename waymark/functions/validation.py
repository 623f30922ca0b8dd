"""Strict checks of a model's answer, as one reason code per answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions import fixed_texts as T
from waymark.functions.actions import action_mentions
from waymark.functions.boxes import normalize_bbox
from waymark.functions.prompts import has_objects
from waymark.functions.text import (
    collapse_whitespace,
    collapsed_without_label,
    extract_json_object,
    int_list_repr,
)


def _compact(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", "")


def clean_step(text: Column, name: str) -> Column:
    return collapsed_without_label(text, name.replace("_", " "))


def answer_text(content: Column) -> Column:
    """The JSON text of a raw answer."""
    return extract_json_object(F.coalesce(content, F.lit("")))


def is_whole(text: Column, value: Column) -> Column:
    """Whether the text is one JSON value and nothing more; ``value`` is its ``try_parse_json``, which
    reads the first value strictly.  What follows it leaves one of the two shells open."""
    wrapped = F.concat(F.lit('{"k":'), text, F.lit("}"))
    alone = (F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1) & (
        F.size(F.json_object_keys(wrapped)) == 1
    )
    return F.coalesce(value.isNotNull() & alone, F.lit(False))


def answer_fields(value: Column) -> list[tuple[Column, Column]]:
    """The kind and the cleaned text of each step's field of an answer."""
    fields = []
    for name in T.STEPS:
        kind = F.schema_of_variant(F.try_variant_get(value, f"$.{name}", "variant"))
        text = F.try_variant_get(value, f"$.{name}", "string")
        fields.append((kind, clean_step(text, name)))
    return fields


def trace_of(text: Column, whole: Column, kind: Column, fields: list[tuple[Column, Column]]) -> Column:
    """The struct of ``parse_trace`` for an answer's text, its kind and its fields."""
    checks = (
        F.when(text == "", "empty").when(~whole, "json").when(~kind.startswith("OBJECT"), "object")
    )
    steps = {}
    for name, (own, step) in zip(T.STEPS, fields):
        steps[name] = step
        checks = (
            checks.when(own.isNull(), f"missing:{name}")
            .when(own != "STRING", f"type:{name}")
            .when(steps[name] == "", f"blank:{name}")
            .when(F.length(steps[name]) > T.MAX_STEP_CHARS, f"long:{name}")
        )
    names = F.array(*map(F.lit, T.STEPS))
    extra = F.size(F.array_except(F.json_object_keys(text), names)) > 0
    return F.struct(checks.when(extra, "extra").alias("json_error"), *[c.alias(n) for n, c in steps.items()])


def parse_trace(content: Column) -> Column:
    """struct(json_error, the four cleaned steps) of a raw answer.

    json_error is the first of: empty, json, object, missing:/type:/blank:/long: of a field in
    order, extra; null if all fields are good.  One whole JSON value is asked for: trailing
    text, comments, single quotes and repeated keys are not JSON.  As one column it holds its parts
    many times over; tables go through ``operators.traces.with_trace``.
    """
    text = answer_text(content)
    value = F.try_parse_json(text)
    return trace_of(text, is_whole(text, value), F.schema_of_variant(value), answer_fields(value))


def checked_steps(steps: dict[str, Column]) -> Column:
    """The struct of ``parse_trace`` for four cleaned steps by name."""
    checks = F.when(F.lit(False), "")
    for name, step in steps.items():
        checks = (
            checks.when(step.isNull(), f"missing:{name}")
            .when(step == "", f"blank:{name}")
            .when(F.length(step) > T.MAX_STEP_CHARS, f"long:{name}")
        )
    return F.struct(checks.alias("json_error"), *[c.alias(n) for n, c in steps.items()])


def total_error(steps: list[Column]) -> Column:
    """``total`` if all steps together are too long; four valid steps never are."""
    length = F.length(steps[0]) + F.length(steps[1]) + F.length(steps[2]) + F.length(steps[3])
    return F.when(length > T.MAX_TOTAL_CHARS, "total")


def needed_labels(objects: Column) -> Column:
    """The labels that step 2 must name: one line, lower case."""
    return F.transform(objects, lambda o: F.lower(collapse_whitespace(F.coalesce(o["label"], F.lit("object")))))


def needed_boxes(objects: Column) -> Column:
    """The boxes that step 2 must name, without spaces."""
    return F.transform(objects, lambda o: _compact(int_list_repr(normalize_bbox(o["bbox"]))))


def visibility_error(step2: Column, objects: Column) -> Column:
    """Step 2 against the frame's objects.

    With objects: no phrase of absence, every label and every box named.  Without: some
    phrase of absence.
    """
    low = F.lower(step2)
    absent = F.lit(False)
    for phrase in T.UNSEEN_PHRASES:
        absent = absent | F.contains(low, F.lit(phrase))
    named = F.forall(needed_labels(objects), lambda label: F.contains(low, label))
    boxed = F.forall(needed_boxes(objects), lambda box: F.contains(_compact(step2), box))
    seen = F.when(absent, "unseen").when(~named, "label").when(~boxed, "bbox")
    return F.when(has_objects(objects), seen).otherwise(F.when(~absent, "visible"))


def action_error(step3: Column, step4: Column, action: Column) -> Column:
    """Action named in steps 3 and 4, and step 4 at most one sentence end."""

    def named(step: Column) -> Column:
        return F.exists(action_mentions(action), lambda m: F.contains(F.lower(step), m))

    return (
        F.when(~named(step3), "step3_action")
        .when(~named(step4), "step4_action")
        .when(F.regexp_count(step4, F.lit(r"(?U)[.!?](?:\s|$)")) > 1, "sentence")
    )


def first_error(trace: Column, objects: Column, action: Column) -> Column:
    """The first rule that an answer (from ``parse_trace``) breaks; null if it is valid."""
    steps = [trace[n] for n in T.STEPS]
    return F.coalesce(
        trace["json_error"],
        total_error(steps),
        visibility_error(steps[1], objects),
        action_error(steps[2], steps[3], action),
    )
