"""Actions, task state and memory sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions import fixed_texts as T
from waymark.functions.boxes import format_object_names
from waymark.functions.text import collapse_whitespace, fill, list_repr

#: Action codes.
ACTIONS = {0: "STOP", 1: "MOVE_FORWARD", 2: "TURN_LEFT", 3: "TURN_RIGHT"}


def decode_action(code: Column) -> Column:
    """The action's name, ``UNKNOWN_<code>`` for other codes."""
    names = F.create_map(*[F.lit(x) for k, v in ACTIONS.items() for x in (k, v)])
    return F.coalesce(F.try_element_at(names, code.cast("int")), F.concat(F.lit("UNKNOWN_"), code.cast("string")))


def action_phrase(action: Column) -> Column:
    return F.replace(F.lower(action), F.lit("_"), F.lit(" "))


def action_mentions(action: Column) -> Column:
    """Spellings of an action that a text may use."""
    return F.array(F.lower(action), action_phrase(action))


def history_memory_text(memory: Column) -> Column:
    """Memory as prompts show it: in one line, ``None`` if missing or blank."""
    return F.coalesce(F.nullif(collapse_whitespace(memory), F.lit("")), F.lit("None"))


def current_subtask(subtask: Column, subtasks: Column, completed: Column, instruction: Column) -> Column:
    """The frame's sub-task, else the one at the completed index, else the instruction."""
    at = F.when(completed >= 0, F.get(subtasks, completed.cast("int")))
    return F.coalesce(subtask, at, instruction)


def completed_subtasks(subtasks: Column, completed: Column) -> Column:
    """The sub-tasks before the completed index, printed as a list."""
    return list_repr(F.slice(subtasks, F.lit(1), F.greatest(completed.cast("int"), F.lit(0))))


def memory_anchor(subtask: Column, objects: Column, action: Column, preferred: Column) -> Column:
    """The memory that a frame hands on: the preferred text, else a sentence of facts."""
    on = collapse_whitespace(F.coalesce(F.nullif(subtask, F.lit("")), F.lit(T.ANCHOR_SUBTASK)))
    some = F.coalesce(F.size(objects), F.lit(0)) > 0
    seen = F.when(some, fill(T.ANCHOR_SEEN, objects=format_object_names(objects))).otherwise(F.lit(T.ANCHOR_UNSEEN))
    facts = fill(T.ANCHOR, subtask=on, seen=seen, phrase=action_phrase(action))
    return F.when(preferred != "", history_memory_text(preferred)).otherwise(facts)
