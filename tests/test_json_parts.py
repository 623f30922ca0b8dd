"""Splittable JSON files against Python's reader, with files cut at every place."""

import json
import random

import pytest
from pyspark.sql import functions as F

from waymark.sources import json_parts, readers


@pytest.fixture(params=[53, 10_000])
def small_splits(spark, request):
    """Files are read in splits of so many bytes."""
    names = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield request.param
    for k in names:
        spark.conf.unset(k)


def odd_objects(rng, n):
    nasty = ['}', '{', ']', '[', '"', "\\", "\\\\", '\\"}', "}}}]", '","', "é日😀", "\n", "", '"}, {"a": "']
    for k in range(n):
        inner = {"k": k, "text": "".join(rng.choice(nasty) for _ in range(rng.randint(0, 6)))}
        if rng.random() < 0.4:
            inner["deep"] = [{"x": [{}]}, [], {"y": {"z": rng.choice(nasty)}}]
        yield inner


def texts(spark, path, **how):
    rows = json_parts.read_parts(spark, str(path), **how).orderBy("src_idx", "part_idx").collect()
    assert [r.part_idx for r in rows] == list(range(len(rows)))
    return [json.loads(r.value) for r in rows]


@pytest.mark.parametrize("indent, ascii_only", [(None, True), (2, False)])
def test_elements_equal_pythons(spark, tmp_path, small_splits, indent, ascii_only):
    want = list(odd_objects(random.Random(small_splits), 14))
    keyed = {f"k{i}}}\"{{": o for i, o in enumerate(want)}
    write = lambda name, text: (tmp_path / name).write_text(text, encoding="utf-8")
    how = {"indent": indent, "ensure_ascii": ascii_only}
    write("array.json", json.dumps(want, **how))
    write("object.json", "\n " + json.dumps(keyed, **how) + "\n\n")
    write("lines.json", "\n\n".join(json.dumps(o, ensure_ascii=ascii_only) for o in want) + "\n")
    assert texts(spark, tmp_path / "array.json") == want
    assert texts(spark, tmp_path / "array.json", lines=True) == want
    assert texts(spark, tmp_path / "object.json") == [{k: v} for k, v in keyed.items()]
    assert texts(spark, tmp_path / "lines.json", lines=True) == want


def test_files_are_read_in_many_splits(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(json.dumps(list(odd_objects(random.Random(1), 40))))
    parts = spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).rdd.getNumPartitions()
    assert parts > 10 or small_splits == 10_000


@pytest.mark.parametrize("text", ["[]", "{}", " [ ] \n", "{ }\n"])
def test_files_without_elements(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    assert texts(spark, tmp_path / "a.json") == []


BROKEN = [
    '[{"a":1}', '[{"a":1}, {"b":', '[{"a":1}}', '[1, {"a":1}]', '[{"a":1}, 2]', '[{"a":1} {"b":2}]',
    '{"a":{"b":1}', '{"a":{"b":1} "c":{}}', "[1, 2]",
]


@pytest.mark.parametrize("text", BROKEN)
def test_broken_files_fail(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="JSON file"):
        json_parts.read_parts(spark, str(tmp_path / "a.json")).collect()


def test_one_export_in_many_partitions(spark, tmp_path, small_splits):
    """The readers' own results do not depend on how a file is cut."""
    tasks = [{"data": {"meta": json.dumps({"v": {"duration": k}}), "v": f"ep{k}.mp4"}, "annotations": [{"result": []}]} for k in range(30)]
    (tmp_path / "export.json").write_text(json.dumps(tasks))
    rows = readers.read_annotation_export(spark, str(tmp_path / "export.json")).orderBy("task_idx").collect()
    assert [(r.src_idx, r.task_idx, r.data["v"]) for r in rows] == [(0, k, f"ep{k}.mp4") for k in range(30)]
    truth = {str(k): {"actions": [k, 1], "locations": [[0.5, k, 1]]} for k in range(30)}
    (tmp_path / "truth.json").write_text(json.dumps(truth))
    got = readers.read_ground_truth(spark, str(tmp_path / "truth.json")).select("episode_key", F.to_json("actions").alias("a")).collect()
    assert {r.episode_key: json.loads(r.a) for r in got} == {k: v["actions"] for k, v in truth.items()}
    episodes = [{"episode_id": k, "instruction": "go }{", "duration": 3, "frames": []} for k in range(30)]
    (tmp_path / "episodes.json").write_text(json.dumps(episodes, indent=1))
    rows = readers.read_episodes(spark, str(tmp_path / "episodes.json")).orderBy("task_idx").collect()
    assert [(r.episode_id, r.instruction) for r in rows] == [(k, "go }{") for k in range(30)]


@pytest.mark.parametrize("whole", [0, json_parts.WHOLE])
@pytest.mark.parametrize("text", [*BROKEN, '[{"a":1}]]', '["{}"]', "[null]"])
def test_no_way_of_reading_takes_a_broken_file(spark, tmp_path, text, whole):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="JSON file"):
        json_parts.read_parts(spark, str(tmp_path / "a.json"), whole=whole).collect()


def test_elements_equal_pythons_at_braces(spark, tmp_path, small_splits):
    want = list(odd_objects(random.Random(7), 14))
    (tmp_path / "array.json").write_text(json.dumps(want))
    assert texts(spark, tmp_path / "array.json", whole=0) == texts(spark, tmp_path / "array.json") == want


def test_sound_files_are_not_cut_at_braces(spark, tmp_path, small_splits, monkeypatch):
    """What is taken as it stands never reaches the search for braces; other files still do."""
    want = list(odd_objects(random.Random(3), 14))
    (tmp_path / "array.json").write_text(json.dumps(want))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(o) for o in want))
    cut = []
    inner = json_parts._cut_parts
    monkeypatch.setattr(json_parts, "_cut_parts", lambda spark, paths, lines: cut.extend(paths) or inner(spark, paths, lines))
    rows = json_parts.read_parts(spark, str(tmp_path), lines=True).orderBy("src_idx", "part_idx").collect()
    assert not cut and [r.part_idx for r in rows] == [*range(14)] * 2
    assert [json.loads(r.value) for r in rows] == want * 2
    (tmp_path / "c.json").write_text("".join(json.dumps(o, indent=1) for o in want))
    rows = json_parts.read_parts(spark, str(tmp_path), lines=True).orderBy("src_idx", "part_idx").collect()
    assert len(cut) == 1 and [json.loads(r.value) for r in rows] == want * 3
