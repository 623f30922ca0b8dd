"""Chains, chat records, pages and readers."""

import hashlib
import json
import random
import sys
from collections import Counter

from pyspark import cloudpickle
from pyspark.sql import functions as F

from waymark.functions import fixed_texts as T
from waymark.functions.actions import action_phrase
from waymark.functions.boxes import format_annotated_objects
from waymark.functions.fixed_texts import STEPS
from waymark.functions.prompts import error_text
from waymark.operators import chain, documents, spatial, traces
from waymark.plans import harness as H
from waymark.sources import readers, sinks
from waymark.streaming import answers

#: Digests of the texts as they were checked by eye, so that an edit by mistake shows.
PROMPTS, CORRECTION, ANSWER = "7f4ae6c8d92e7176", "07bc7ff14e195f8a", "b9865da9c55abc80"

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors cannot import tests


def answer(prompt, notes, attempt, frame):
    """A good answer at the second attempt; none for every fifth frame."""
    if frame["frame"] % 5 == 0:
        return ("ok", "{}") if frame["frame"] % 2 else ("transport_error", "")
    if attempt == 1:
        return "ok", "no json"
    assert notes and notes[0][0] == "no json" and "Invalid JSON" in notes[0][1]
    return "ok", json.dumps(dict(zip(STEPS, ["on", frame["seen"], frame["said"], f"{frame['said']} at {frame['frame']}"])))


def first_turns(spark, sf_dir, n):
    rows = traces.eligible_frames(H.frames(spark, sf_dir), H.truth(spark, sf_dir)).where(f"frame_pos <= {n}")
    seen = F.when(F.size("objects") > 0, format_annotated_objects(F.col("objects"))).otherwise("not visible")
    return rows.withColumns({"seen": seen, "said": action_phrase(F.col("action"))}).cache()


def recorded(spark, eligible, responder, attempts=3):
    told = []
    for r in eligible.collect():
        notes = []
        for k in range(1, attempts + 1):
            status, content = responder("", notes, k, r.asDict(recursive=True))
            told.append((r.src_idx, r.task_idx, r.frame_pos, k, status, content))
            notes = notes + [(content, "Invalid JSON")]
    schema = "src_idx int, task_idx long, frame_pos int, attempt int, status string, content string"
    return spark.createDataFrame(told, schema)


COLS = ["task_idx", "frame_pos", "outcome", "memory", "history_source_frame", "anchor", "prompt", "answer"]


def shown(df):
    return sorted(map(repr, df.select(*COLS).collect()))


def test_live_equals_replay(spark, sf_dir):
    eligible = first_turns(spark, sf_dir, 1000)
    responses = recorded(spark, eligible, answer)
    for policy in chain.POLICIES:
        live = shown(chain.generate_chain(eligible, answer, policy))
        assert live == shown(chain.replay(eligible, responses, policy)) and len(live) == eligible.count()
        assert sum("outcome='trace'" in r for r in live) > len(live) / 2
    assert chain.generate_chain(eligible.limit(0), answer).count() == 0


def test_template_policy(spark, sf_dir):
    eligible = first_turns(spark, sf_dir, 1)
    rows = chain.generate_chain(eligible, lambda p, n, k, f: ("ok", ""), "template").collect()
    assert {r.outcome for r in rows} <= {"template", "invalid"}
    assert any(r.outcome == "template" and "Task Progress" in r.answer for r in rows)
    failed = chain.generate_chain(eligible, lambda p, n, k, f: ("transport_error", ""), "template").collect()
    assert {r.outcome for r in failed} == {"failed"}
    assert all(r.answer is None and r.anchor for r in failed)


def test_template_answers_that_hang_on_the_memory_before(spark, sf_dir):
    """Labels and sub-tasks of all lengths, so that a memory may be too long to be told."""
    eligible = first_turns(spark, sf_dir, 4)
    size = F.pmod(F.xxhash64("task_idx", "frame_pos"), F.lit(260)).cast("int")
    wide = F.transform("objects", lambda o: o.withField("label", F.concat(F.repeat(F.lit("l"), size), F.lit("o"))))
    eligible = eligible.withColumn("objects", F.when(F.pmod(F.hash("frame_pos", "task_idx"), F.lit(3)) > 0, F.slice(wide, 1, 1)).otherwise(F.slice("objects", 1, 0)))
    long_task = F.concat(F.col("subtask"), F.repeat(F.lit("s"), F.pmod(F.xxhash64("frame_pos", "task_idx"), F.lit(180)).cast("int")))
    eligible = eligible.withColumn("subtask", long_task).cache()
    bad = lambda p, n, k, f: ("ok", "no") if (f["frame"] + f["task_idx"]) % 9 else ("transport_error", "")
    live = shown(chain.generate_chain(eligible, bad, "template", 1))
    assert live == shown(chain.replay(eligible, recorded(spark, eligible, bad, 1), "template", 1))
    kinds = Counter(r.split("outcome='")[1].split("'")[0] for r in live)
    assert min(kinds["template"], kinds["invalid"]) > 10 and kinds["failed"]


def test_chat_lines_and_pages(spark, sf_dir, tmp_path):
    eligible = traces.eligible_frames(H.frames(spark, sf_dir), H.truth(spark, sf_dir), [1, 2])
    validated = traces.validate_responses(eligible, H.responses(spark, sf_dir))
    chained = traces.with_prompt(traces.memory_chain(eligible, traces.choose_outcome(validated)))
    videos = spark.createDataFrame([(1,)], "episode_id long")
    records = traces.chat_records(traces.with_image(chained, videos, "frames"))
    sinks.write_chat(records, str(tmp_path / "chat"))
    lines = [x for p in sorted((tmp_path / "chat").glob("part-*")) for x in p.read_text().splitlines()]
    assert len(lines) == records.count() > 0
    first = json.loads(lines[0])
    assert list(first) == ["episode_id", "frame", "input_state", "messages"]
    assert all("history_source_frame" in json.loads(x)["input_state"] for x in lines)
    assert first["messages"][0]["content"][0]["type"] == "image_path"
    (tmp_path / "chat.jsonl").write_text("\n\n".join(lines) + "\n  \n")
    chat = readers.read_chat(spark, str(tmp_path / "chat.jsonl"))
    pages = documents.chat_to_markdown(chat, include_prompt=True)
    assert sorted(r.record_idx for r in chat.select("record_idx").collect()) == list(range(len(lines)))
    assert sinks.export_markdown(spark, str(tmp_path / "chat.jsonl"), include_prompt=True) == str(tmp_path / "chat_md")
    assert [r.position for r in documents.markdown_index(chat).orderBy("position").collect()] == list(range(len(lines) + 4))
    sinks.write_files(pages, str(tmp_path / "md"))
    names = {p.name for p in (tmp_path / "md").iterdir()}
    assert names == {p.name for p in (tmp_path / "chat_md").iterdir() if p.is_file()}
    assert f"ep00001_frame{first['frame']:04d}.md" in names and len(names) == len(lines)
    body = (tmp_path / "md" / f"ep00001_frame{first['frame']:04d}.md").read_text()
    assert body.startswith("# Episode 1 Frame") and "## User Prompt" in body and body.endswith("```\n")
    sinks.write_index(documents.markdown_index(chat), str(tmp_path / "index"))
    index = "".join(p.read_text() for p in sorted((tmp_path / "index").glob("part-*")))
    assert index.startswith(f"# Frame Index\n\n- Total Frames: {len(lines)}\n\n- [Episode 1")


def test_an_answer_is_parsed_once(spark, sf_dir):
    """What is asked of the reason and the trace does not bring their expressions along."""
    eligible = traces.eligible_frames(H.frames(spark, sf_dir), H.truth(spark, sf_dir))
    validated = traces.validate_responses(eligible, H.responses(spark, sf_dir))
    asked = validated.where("reason is not null and reason <> 'transport' and trace.json_error is null")
    plan = lambda rows: rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan(asked).count("```(?:json") == plan(validated).count("```(?:json") < 20


def test_stream_of_answers(spark, sf_dir, tmp_path):
    eligible = traces.eligible_frames(H.frames(spark, sf_dir), H.truth(spark, sf_dir))
    H.responses(spark, sf_dir).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = answers.write_checked(answers.validate_stream(eligible, stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = traces.validate_responses(eligible, H.responses(spark, sf_dir)).select(*got.columns)
    assert got.exceptAll(batch).count() == 0 == batch.exceptAll(got).count()


def test_records_are_numbered_over_files_and_blocks(spark, tmp_path):
    (tmp_path / "chats").mkdir()
    for name, ids in (("a", range(0, 40)), ("b", range(40, 47)), ("c", range(47, 50))):
        lines = [json.dumps({"episode_id": str(i), "frame": i, "messages": [{"role": "user", "content": [{"type": "text", "text": "x" * i}]}]}) for i in ids]
        (tmp_path / "chats" / name).write_text("\n \n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = readers.read_chat(spark, str(tmp_path / "chats")).select("record_idx", "episode_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, got)) == [(i, i) for i in range(50)]


def test_files_are_numbered_in_order(spark, tmp_path):
    task = lambda n: json.dumps([{"data": {"video": f"v{n}"}, "annotations": []}] * n)
    for name, n in (("xa.json", 1), ("a.json", 2), ("c d+%20é.json", 3)):
        (tmp_path / name).write_text(task(n))
    read = lambda paths: sorted((r.src_idx, r.task_idx) for r in readers.read_annotation_export(spark, paths).collect())
    names = [str(tmp_path / n) for n in ("a.json", "xa.json")]
    assert read(names) == [(0, 0), (0, 1), (1, 0)] == read([*names, names[0]])
    assert read(names[::-1]) == [(0, 0), (1, 0), (1, 1)] and read(names[0]) == [(0, 0), (0, 1)]
    assert read(str(tmp_path)) == [(0, 0), (0, 1), (1, 0), (1, 1), (1, 2), (2, 0)]


def test_tables_of_meshes_and_answers(spark, tmp_path):
    spark.createDataFrame([(1, "s", 0.0)], "vertex_id int, scene string, x double").write.partitionBy("scene").parquet(str(tmp_path / "v"))
    spark.createDataFrame([(1, "s")], "face_id int, scene string").write.partitionBy("scene").parquet(str(tmp_path / "f"))
    vertices, faces = readers.read_mesh(spark, str(tmp_path / "v"), str(tmp_path / "f"))
    assert vertices.first().asDict() == {"vertex_id": 1, "x": 0.0, "scene": "s"} and faces.count() == 1
    spark.createDataFrame([(0, 1, "ok")], "src_idx int, attempt int, status string").write.parquet(str(tmp_path / "r"))
    assert readers.read_responses(spark, str(tmp_path / "r")).first().status == "ok"
    (tmp_path / "videos").mkdir()
    for name in ("ep00012.mp4", "ep3.mp4", "other.mp4", "ep4.txt"):
        (tmp_path / "videos" / name).write_text("x")
    assert sorted(r.episode_id for r in readers.list_videos(spark, str(tmp_path / "videos")).collect()) == [3, 12]


def test_texts_are_the_fixed_ones(spark):
    digests = {
        "prompt": (T.PROMPT_VISIBLE + T.PROMPT_UNSEEN + T.SYSTEM_PROMPT, PROMPTS),
        "correction": (T.CORRECTION, CORRECTION),
        "answer": (T.ANSWER, ANSWER),
    }
    for name, (text, digest) in digests.items():
        assert hashlib.sha256(text.encode()).hexdigest()[:16] == digest, name
    reasons = ["missing:step3_decision_logic", "blank:step1_task_progress", "bbox", "empty", "odd"]
    rows = spark.createDataFrame([(r,) for r in reasons], "reason string").select(error_text(F.col("reason")))
    assert [r[0] for r in rows.collect()] == [
        "('step3_decision_logic',): Field required",
        "('step1_task_progress',): Value error, must not be empty",
        "(): Value error, step2 must include every visible annotated object's bbox",
        "empty response",
        "odd",
    ]


def test_readers_of_objects(spark, tmp_path):
    (tmp_path / "gt.json").write_text(json.dumps({"7": {"actions": [1, 2], "locations": [[0, 1, 2]]}}))
    truth = readers.read_ground_truth(spark, str(tmp_path / "gt.json")).collect()
    assert [(r.episode_key, r.actions, r.locations) for r in truth] == [("7", [1, 2], [[0.0, 1.0, 2.0]])]
    eps = [{"episode_id": 1, "instruction": {"instruction_text": t}} for t in ("a", "b")]
    (tmp_path / "train.json").write_text(json.dumps({"episodes": eps}))
    assert [(r.episode_id, r.text) for r in readers.read_instructions(spark, str(tmp_path / "train.json")).collect()] == [(1, "b")]
    shape = {"folder": "", "filename": "f", "path": "", "objects": [{"name": "closet", "vertices": [[1, 2, 3]] * 8}] * 2}
    (tmp_path / "ep00004_x.json").write_text(json.dumps(shape))
    points = spatial.label_points(readers.read_labels_3d(spark, str(tmp_path / "ep00004_x.json")))
    got = points.collect()
    assert len(got) == 16 and tuple(got[0])[:4] == (4, 0, "closet", 0) and (got[0].x, got[0].y, got[0].z) == (1.0, 3.0, -2.0)


def test_padding_of_one_point(spark):
    t = spark.createDataFrame([(1, 1, "a/b.glb", [[0.0, 0.0, 0.0]])], "episode_id long, trajectory_id long, scene_id string, locations array<array<double>>")
    b = spatial.padded_boxes(t, F.array(*map(F.lit, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]))).first()
    assert [b[f"low_{a}"] for a in "xyz"] == [-2, -5, -4]
    assert [b[f"high_{a}"] for a in "xyz"] == [1, 6, 3]


def test_box_behind_the_camera(spark):
    pose = spark.createDataFrame([(1, 1, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)], "episode_id long, frame int, px double, py double, pz double, qx double, qy double, qz double, qw double")
    points = spark.createDataFrame([(1, 0, "a", i, float(i), float(i), z) for i, z in enumerate((-1.0, -2.0, 1.0))], "episode_id long, object_idx int, name string, vertex_idx int, x double, y double, z double")
    assert [r.visible for r in spatial.project_labels(pose, points).collect()] == [False]
    ahead = points.withColumn("z", -F.abs("z"))
    assert [r.visible for r in spatial.project_labels(pose, ahead).collect()] == [True]
