"""Hand-made cases of column functions."""

import pytest
from pyspark.sql import functions as F

from waymark.functions import actions, boxes, geometry, text, validation
from waymark.functions.fixed_texts import STEPS


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def string(s):
    return F.lit(s).cast("string")


@pytest.mark.parametrize(
    "url, expected",
    [("x/ep00012.mp4", 12), ("x/video.mp4", None), ("", None), (None, None), ("deep/ep7_ep8", 7)],
)
def test_episode_id(spark, url, expected):
    assert value(spark, text.episode_id_from_url(string(url))) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("step1 task progress: x", "task progress: x"),
        ("Step 1: step1 task progress: x", "x"),
        ("Step 2. STEP1 Task Progress - x", "x"),
        ("task progress: x", "task progress: x"),
        ("", ""),
        (None, None),
    ],
)
def test_strip_leading_label(spark, raw, expected):
    assert value(spark, text.strip_leading_label(string(raw), "step1 task progress")) == expected


def test_whitespace(spark):
    assert value(spark, text.collapse_whitespace(string(" a \n b\t"))) == "a b"


@pytest.mark.parametrize("items", [[], ["a"], ["a", "b's"], ['c"d\'e'], ["x\\y\n"], ["'", '"']])
def test_list_repr_is_python(spark, items):
    column = F.array(*map(string, items)).cast("array<string>")
    assert value(spark, text.list_repr(column)) == str(items)


@pytest.mark.parametrize("label, kind, rest", [("subtask: a ", "subtask", " a "), ("object:", "object", "")])
def test_route(spark, label, kind, rest):
    got = value(spark, text.route_label(string(label)))
    assert (got["kind"], got["text"]) == (kind, rest)
    assert value(spark, text.route_label(string("other:x"))) is None


def box(x, y, w, h):
    return F.struct(*[F.lit(float(v)).alias(n) for v, n in zip((x, y, w, h), ("x", "y", "width", "height"))])


def test_normalize(spark):
    assert value(spark, boxes.normalize_bbox(box(0.05, 0.15, 0, 0.1))) == [0, 2, 0, 2]
    assert value(spark, boxes.normalize_bbox(box(95, -3, 10, 200))) == [950, 0, 1000, 1000]


@pytest.mark.parametrize(
    "x, y, expected",
    [(500, 500, "center of the view"), (333, 500, "center of the view"), (332, 668, "lower-left area of the view"),
     (700, 500, "right side of the view"), (500, 100, "upper center of the view")],
)
def test_zone(spark, x, y, expected):
    assert value(spark, boxes.bbox_zone(F.array(*map(F.lit, (x, y, x, y))))) == expected


@pytest.mark.parametrize(
    "dx, dy, expected", [(80, 0, "near"), (81, 0, "right of"), (-81, 81, "below-left of"), (0, -81, "above of")]
)
def test_relation(spark, dx, dy, expected):
    a = F.array(*map(F.lit, (500, 500, 500, 500)))
    b = F.array(*map(F.lit, (500 + dx, 500 + dy) * 2))
    assert value(spark, boxes.bbox_relation(a, b)) == expected


def test_names_of_nothing(spark):
    none = F.array().cast("array<struct<label:string,bbox:struct<x:double,y:double,width:double,height:double>>>")
    assert value(spark, boxes.format_object_names(none)) == "no annotated objects"
    assert value(spark, boxes.format_annotated_objects(none)) == "[]"
    assert value(spark, boxes.format_annotated_objects(F.lit(None).cast(none_type()))) == "[]"


def none_type():
    return "array<struct<label:string,bbox:struct<x:double,y:double,width:double,height:double>>>"


def test_actions(spark):
    assert value(spark, actions.decode_action(F.lit(3))) == "TURN_RIGHT"
    assert value(spark, actions.decode_action(F.lit(9))) == "UNKNOWN_9"
    assert value(spark, actions.history_memory_text(string(" \n"))) == "None"


def test_projection(spark):
    zero = (F.lit(0.0),) * 3
    got = value(spark, geometry.project_point((F.lit(0.0), F.lit(0.0), F.lit(-1.0)), zero, (F.lit(1.0), *zero)))
    assert tuple(got) == (320.0, 213.0, 1.0)
    mesh = value(spark, F.array(*geometry.to_mesh_axes(F.lit(1), F.lit(2), F.lit(3))))
    assert mesh == [1, -3, 2]


def trace(**changes):
    import json

    steps = dict.fromkeys(STEPS, "move forward, not visible.") | changes
    return json.dumps({k: v for k, v in steps.items() if v != "drop"})


GOOD = trace()


@pytest.mark.parametrize(
    "raw, expected",
    [
        (GOOD, None),
        (f"```json\n{GOOD}\n```", None),
        (f"{GOOD[:-1]}, }}", "json"),
        (GOOD.replace('"', "'"), "json"),
        (f"{GOOD} {GOOD}", "json"),
        (f'{GOOD[:-1]}, "step1_task_progress": "x"}}', "json"),
        ("", "empty"),
        (None, "empty"),
        ("[1]", "object"),
        (trace(step2_spatial_perception="drop"), "missing:step2_spatial_perception"),
        (trace(step1_task_progress=5), "type:step1_task_progress"),
        (trace(step1_task_progress=None), "type:step1_task_progress"),
        (trace(step1_task_progress=" \n"), "blank:step1_task_progress"),
        (trace(step3_decision_logic="move forward " + "x" * 400), "long:step3_decision_logic"),
        (trace(more="x"), "extra"),
        (trace(step2_spatial_perception="a wall"), "visible"),
        (trace(step3_decision_logic="go"), "step3_action"),
        (trace(step4_memory_update="go"), "step4_action"),
        (trace(step4_memory_update="move_forward. b."), "sentence"),
        (trace(step4_memory_update="move_forward v1.2 ok."), None),
    ],
)
def test_first_error(spark, raw, expected):
    none = F.array().cast(none_type())
    error = validation.first_error(validation.parse_trace(string(raw)), none, F.lit("MOVE_FORWARD"))
    assert value(spark, error) == expected
