"""The rules of an answer for one answer at a time, where an answer is needed before the next
question can be asked.

Texts, limits, phrases and the order of the rules are those of the columns in ``validation``
and ``prompts``; what a rule needs to know of a frame comes ready-made from columns, so only
the answer itself is looked at here.  Tests hold both forms against each other.
"""

from __future__ import annotations

import json
import re

from waymark.functions import fixed_texts as T

#: Fixed value: Unicode's white space, which the columns' patterns use.
WHITE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(
    map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
_GAPS = re.compile(f"[{WHITE}]+")
_FENCE = re.compile(rf"```(?:json|markdown|md|text)?[{WHITE}]*")
_SENTENCE_END = re.compile(rf"[.!?](?:[{WHITE}]|$)")
_LABEL = {
    name: re.compile(
        rf"(?i)^(?:step[{WHITE}]*\d+[{WHITE}]*[:.-]?[{WHITE}]*)?"
        rf"(?:{name.replace('_', ' ')}[{WHITE}]*[:.-]?[{WHITE}]*)?"
    )
    for name in T.STEPS
}


def _spaces_only(text: str) -> bool:
    """Whether blanks are the only white space, which most texts show at once."""
    return text.isascii() and text.isprintable()


def collapse(text: str | None) -> str:
    text = text or ""
    if "  " not in text and _spaces_only(text):
        return text.strip(" ")
    return _GAPS.sub(" ", text).strip(" ")


def shown_memory(memory: str | None) -> str:
    return collapse(memory) or "None"


def clean(text: str, name: str) -> str:
    text = collapse(text)
    if text.isascii() and not text.startswith(("s", "S", name[0])):  # no label begins otherwise
        return text.strip(WHITE)
    return _LABEL[name].sub("", text, count=1).strip(WHITE)


def _no_repeats(pairs: list[tuple]) -> dict:
    value = dict(pairs)
    if len(value) < len(pairs):
        raise ValueError("repeated key")
    return value


def _no_constant(name: str):
    raise ValueError(name)


def _json_text(content: str | None) -> str:
    text = (content or "").replace("\r\n", "\n").replace("\r", "\n").strip(WHITE)
    if "```" in text:
        text = _FENCE.sub("", text)
        text = re.sub(rf"[{WHITE}]*```$", "", text)
    first, last = text.find("{"), text.rfind("}")
    return text[first : last + 1] if 0 <= first < last else text


def read_steps(content: str | None) -> tuple[str | None, dict[str, str] | None]:
    """(error, steps) of a raw answer."""
    text = _json_text(content)
    if not text:
        return "empty", None
    try:
        value = json.loads(text, object_pairs_hook=_no_repeats, parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return "json", None
    if not isinstance(value, dict):
        return "object", None
    steps = {}
    for name in T.STEPS:
        if name not in value:
            return f"missing:{name}", None
        if not isinstance(value[name], str):
            return f"type:{name}", None
        steps[name] = clean(value[name], name)
        if error := length_error(steps[name], name):
            return error, None
    return ("extra", None) if len(value) > len(T.STEPS) else (None, steps)


def length_error(step: str, name: str) -> str | None:
    if not step:
        return f"blank:{name}"
    return f"long:{name}" if len(step) > T.MAX_STEP_CHARS else None


def facts_error(steps: dict[str, str], facts: dict) -> str | None:
    """The first rule that good fields break.  ``facts``: ``some`` (the frame has objects),
    their ``labels`` (one line, lower case) and ``boxes`` (no white space), ``mentions``."""
    _, seen, why, memory = (steps[name] for name in T.STEPS)
    if sum(map(len, steps.values())) > T.MAX_TOTAL_CHARS:
        return "total"
    low, dense = seen.lower(), seen.replace(" ", "") if _spaces_only(seen) else _GAPS.sub("", seen)
    absent = any(phrase in low for phrase in T.UNSEEN_PHRASES)
    if not facts["some"]:
        if not absent:
            return "visible"
    elif absent:
        return "unseen"
    elif not all(label in low for label in facts["labels"]):
        return "label"
    elif not all(box in dense for box in facts["boxes"]):
        return "bbox"
    for code, step in (("step3_action", why), ("step4_action", memory)):
        if not any(m in step.lower() for m in facts["mentions"]):
            return code
    return "sentence" if len(_SENTENCE_END.findall(memory)) > 1 else None


def judge(content: str | None, facts: dict) -> tuple[str | None, dict[str, str] | None]:
    """(reason, steps): the first rule that an answer breaks, else its steps."""
    error, steps = read_steps(content)
    error = error or facts_error(steps, facts)
    return error, None if error else steps


def cause(content: str | None, reason: str | None) -> str | None:
    """What is said of an answer besides its reason: where its JSON breaks off, in the words of the
    reference's parser, or the first key too many.  A repeated key has none, as that parser takes it."""
    if reason == "json":
        from pydantic_core import from_json

        try:
            from_json(_json_text(content).encode("utf-8", "surrogatepass"))
        except ValueError as error:
            return str(error)
    if reason == "extra":
        return repr(next(key for key in json.loads(_json_text(content)) if key not in T.STEPS))
    return None


def correction(content: str | None, reason: str, action: str, cause: str | None = None) -> tuple[str, str]:
    """The bad answer as it is sent back, and the request to correct it."""
    code, _, field = reason.partition(":")
    error = T.ERRORS[code].replace("{field}", field)
    if cause is not None:
        error = T.ERROR_CAUSES[code].replace("{cause}", cause)
    shown = (content or "")[: T.MAX_FEEDBACK_CHARS] if collapse(content) else "{}"
    return shown, T.CORRECTION.format(error=error, action=action)


def truth_steps(memory: str | None, facts: dict) -> dict[str, str] | None:
    """The steps from ground truth after this memory, if they pass; only the first shows it."""
    told = shown_memory(memory)
    clause = T.TRUTH_NO_MEMORY if told == "None" else T.TRUTH_MEMORY.format(memory=told)
    texts = [facts["truth_before"] + clause + facts["truth_after"], *facts["truth"]]
    steps = {name: clean(text, name) for name, text in zip(T.STEPS, texts)}
    if any(length_error(step, name) for name, step in steps.items()) or facts_error(steps, facts):
        return None
    return steps
