"""Prompts, requests, corrections and answers as columns."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions import answer_rules
from waymark.functions import fixed_texts as T
from waymark.functions.actions import (
    action_phrase,
    completed_subtasks,
    current_subtask,
    history_memory_text,
)
from waymark.functions.boxes import format_annotated_objects, normalize_bbox
from waymark.functions.text import fill, int_list_repr, list_repr


def has_objects(objects: Column) -> Column:
    return F.coalesce(F.size(objects), F.lit(0)) > 0


def prompt_halves(
    subtask: Column,
    objects: Column,
    instruction: Column,
    subtasks: Column,
    completed: Column,
    action: Column,
) -> tuple[Column, Column]:
    """The request text of a frame before and after the memory; the first object is the target."""
    first = F.get(objects, F.lit(0))
    values = {
        "global_instruction": instruction,
        "global_subtasks_list": list_repr(subtasks),
        "completed_subtasks": completed_subtasks(subtasks, completed),
        "completed_index": completed,
        "current_subtask": current_subtask(subtask, subtasks, completed, instruction),
        "next_action": action,
    }
    seen = {
        "target_object_name": first["label"],
        "bbox_norm": int_list_repr(normalize_bbox(first["bbox"])),
        "annotated_objects": format_annotated_objects(objects),
    }
    halves = zip(T.PROMPT_VISIBLE.split("{script_memory}"), T.PROMPT_UNSEEN.split("{script_memory}"))
    before, after = (
        F.when(has_objects(objects), fill(visible, **values, **seen)).otherwise(fill(unseen, **values))
        for visible, unseen in halves
    )
    return before, after


def build_prompt(
    subtask: Column,
    objects: Column,
    memory: Column,
    instruction: Column,
    subtasks: Column,
    completed: Column,
    action: Column,
) -> Column:
    """The request text of a frame."""
    before, after = prompt_halves(subtask, objects, instruction, subtasks, completed, action)
    return F.concat(before, history_memory_text(memory), after)


def render_trace(steps: list[Column], action: Column) -> Column:
    """The final answer text of four accepted steps."""
    return fill(T.ANSWER, **{f"step{i}": s for i, s in enumerate(steps, 1)}, action=action)


def template_halves(
    subtask: Column,
    objects: Column,
    instruction: Column,
    subtasks: Column,
    completed: Column,
    action: Column,
) -> tuple[tuple[Column, Column], list[Column]]:
    """Four steps made from ground truth alone: the first one before and after what it says of
    the memory, and the others, which do not show it."""
    total = F.greatest(F.lit(1), F.size(subtasks))
    done = F.greatest(F.lit(0), F.least(completed, total))
    step = F.greatest(F.lit(1), F.least(completed + 1, total))
    now = current_subtask(subtask, subtasks, completed, instruction)
    before, after = T.TRUTH_STEP1.split("{clause}")
    first = (F.lit(before), fill(after, done=done, total=total, step=step, subtask=now))
    about = {"step": step, "subtask": now}
    seen = fill(T.TRUTH_STEP3_OTHER, **about)
    for name, text in T.TRUTH_STEP3.items():
        seen = F.when(action == name, fill(text, **about)).otherwise(seen)
    unseen = F.when(action == "STOP", T.TRUTH_STEP3_UNSEEN_STOP).otherwise(
        fill(T.TRUTH_STEP3_UNSEEN, **about, phrase=action_phrase(action))
    )
    some = has_objects(objects)
    return first, [
        F.when(some, fill(T.TRUTH_STEP2, objects=format_annotated_objects(objects))).otherwise(
            F.lit(T.TRUTH_STEP2_UNSEEN)
        ),
        F.when(some, F.concat(F.lit(T.TRUTH_LAYOUT), seen)).otherwise(unseen),
        fill(T.TRUTH_STEP4, **about, phrase=action_phrase(action)),
    ]


def template_steps(
    subtask: Column,
    objects: Column,
    memory: Column,
    instruction: Column,
    subtasks: Column,
    completed: Column,
    action: Column,
) -> list[Column]:
    """The four steps after this memory; they too must pass validation to be used."""
    (before, after), others = template_halves(subtask, objects, instruction, subtasks, completed, action)
    shown = history_memory_text(memory)
    clause = F.when(shown == "None", T.TRUTH_NO_MEMORY).otherwise(fill(T.TRUTH_MEMORY, memory=shown))
    return [F.concat(before, clause, after), *others]


def request_messages(prompt: Column, image: Column) -> Column:
    """System and user message as JSON text; the image comes before the text if there is one."""
    text = F.to_json(F.struct(F.lit("text").alias("type"), prompt.alias("text")))
    picture = F.to_json(F.struct(F.lit("image_path").alias("type"), image.alias("image_path")))
    content = F.when(image.isNull(), text).otherwise(F.concat(picture, F.lit(","), text))
    system = F.to_json(F.struct(F.lit("system").alias("role"), F.lit(T.SYSTEM_PROMPT).alias("content")))
    return F.concat(
        F.lit("["), system, F.lit(',{"role":"user","content":['), content, F.lit("]}]")
    )


def extra_parameters(thinking_mode: Column, hosted: bool = False) -> Column:
    """Extra request parameters as JSON: a served model repeats less and takes the thinking
    switch as a template argument, a hosted one takes it directly; ``auto`` sets none."""
    on = F.when(thinking_mode == "on", "true").otherwise("false")
    if hosted:
        return F.when(thinking_mode == "auto", "{}").otherwise(
            F.concat(F.lit('{"enable_thinking":'), on, F.lit("}"))
        )
    return F.when(thinking_mode == "auto", '{"repetition_penalty":1.01}').otherwise(
        F.concat(
            F.lit('{"repetition_penalty":1.01,"chat_template_kwargs":{"enable_thinking":'), on, F.lit("}}")
        )
    )


def retry_answer(content: Column) -> Column:
    """The bad answer as it is sent back: ``{}`` if blank, its first 4000 characters else."""
    raw = F.coalesce(content, F.lit(""))
    blank = F.regexp_replace(raw, r"(?U)\s+", "") == ""
    return F.when(blank, "{}").otherwise(F.substring(raw, 1, T.MAX_FEEDBACK_CHARS))


def error_cause(reason: Column, content: Column) -> Column:
    """What only the answer can say of its error: where its JSON breaks off, as the reference's parser
    tells it, or the first key too many; null for other reasons, whose answers are not looked at."""

    @F.pandas_udf("string")
    def told(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for contents, reasons in batches:
            yield pd.Series([answer_rules.cause(c, r) for c, r in zip(contents, reasons)], dtype=object)

    return told(F.when(reason.isin(*T.ERROR_CAUSES), content), reason)


def error_text(reason: Column, cause: Column | None = None) -> Column:
    """What a reason code (``code`` or ``code:field``) says in words, with its ``error_cause`` if given."""
    code, field = (F.split_part(reason, F.lit(":"), F.lit(k)) for k in (1, 2))
    text = F.when(F.lit(False), "")
    for name, told in T.ERROR_CAUSES.items() if cause is not None else ():
        text = text.when((code == name) & cause.isNotNull(), fill(told, cause=cause))
    for name, told in T.ERRORS.items():
        text = text.when(code == name, fill(told, field=field))
    return text.otherwise(reason)


def retry_request(reason: Column, action: Column, cause: Column | None = None) -> Column:
    """The request to correct an answer that failed for this reason and cause."""
    return fill(T.CORRECTION, error=error_text(reason, cause), action=action)
