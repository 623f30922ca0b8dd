"""Requests to correct an answer: the answer itself, and what only it can say of its error."""

import json

import pytest
from pyspark.sql import functions as F

from waymark.functions import answer_rules as rules
from waymark.functions.fixed_texts import STEPS
from waymark.functions.prompts import error_cause, retry_request
from waymark.operators import chain, traces
from waymark.plans.queries import QUERIES

GOOD = dict.fromkeys(STEPS, "x")
TOLD = {
    ('{"a": ', "json"): "(): Invalid JSON: EOF while parsing a value at line 1 column 5",
    ("```json\n{'a': 1}\n```", "json"): "(): Invalid JSON: key must be a string at line 1 column 2",
    ('so {"a": 1,\r\n}', "json"): "(): Invalid JSON: trailing comma at line 2 column 1",
    ("no", "json"): "(): Invalid JSON: expected ident at line 1 column 2",
    ('{"a": 1, "a": 2}', "json"): "(): Invalid JSON",
    (json.dumps(GOOD | {"more": 1, "most": 2}), "extra"): "('more',): Extra inputs are not permitted",
    (json.dumps({"it's": 1} | GOOD), "extra"): '("it\'s",): Extra inputs are not permitted',
    ("[1]", "object"): "(): Input should be an object",
    ("{}", "missing:step1_task_progress"): "('step1_task_progress',): Field required",
}


def test_a_correction_says_what_the_answer_does(spark):
    rows = spark.createDataFrame([(c, r, "STOP") for c, r in TOLD], "content string, reason string, action string")
    asked = retry_request(F.col("reason"), F.col("action"), error_cause(F.col("reason"), F.col("content")))
    for r in rows.withColumn("asked", asked).collect():
        want = TOLD[r.content, r.reason]
        assert f"Validation error: {want}. Return" in r.asked
        assert rules.correction(r.content, r.reason, r.action, rules.cause(r.content, r.reason))[1] == r.asked


def test_causes_are_those_of_the_parser_itself():
    pydantic = pytest.importorskip("pydantic")
    model = pydantic.create_model("Answer", __config__=pydantic.ConfigDict(extra="forbid"), **dict.fromkeys(STEPS, (str, ...)))
    for (content, reason), told in TOLD.items():
        if told != "(): Invalid JSON":
            with pytest.raises(pydantic.ValidationError) as caught:
                model.model_validate_json(rules._json_text(content))
            first = caught.value.errors(include_url=False)[0]
            assert f"{first['loc']}: {first['msg']}" == told


def test_feedback_brings_the_bad_answer(spark, sf_dir):
    rows = QUERIES["retry_feedback"](spark, sf_dir).collect()
    assert {r.answer for r in rows} >= {"{}", "[1]", '{"a": '}
    assert sum("('more',): Extra inputs" in r.request for r in rows) > 0


def test_later_attempts_see_the_cause(spark):
    said = [(0, 1, 0, k, "ok", '{"a": ', "json", "STOP") for k in (1, 2)]
    rows = spark.createDataFrame(said, "src_idx int, task_idx long, frame_pos int, attempt int, status string, content string, reason string, action string")
    (note,) = next(r.feedback for r in traces.retry_history(rows).collect() if r.attempt == 2)
    assert note.assistant == '{"a": ' and "EOF while parsing a value" in note.user and note.reason == "json"


def test_the_walk_tells_the_cause():
    seen = []
    walk = chain.EpisodeWalk(lambda prompt, notes, attempt, frame: (seen.append(notes), ("ok", '{"a": '))[1])
    card = {"prompt": ["", ""], "facts": {}, "bare": "b", "frame": {"frame_pos": 0, "frame": 1, "action": "STOP"}}
    walk._turn((1, None, None), json.dumps(card), None, [])
    assert [len(n) for n in seen] == [0, 1, 2] and "EOF while parsing a value" in seen[1][0][1]
