"""Live generation: the rules of one answer against the columns, streams, waits, odd order."""

import json
import random
import sys
import time

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from waymark.functions import answer_rules as rules
from waymark.functions.actions import action_phrase
from waymark.functions.boxes import format_annotated_objects
from waymark.functions.fixed_texts import STEPS
from waymark.functions.prompts import retry_answer, retry_request
from waymark.functions.validation import first_error, parse_trace
from waymark.operators import chain, traces
from waymark.plans import harness as H
from waymark.plans.queries import recorded_answer
from waymark.streaming import episodes

cloudpickle.register_pickle_by_value(sys.modules[__name__])
SHOWN = ["task_idx", "frame_pos", "outcome", "memory", "history_source_frame", "anchor"]


@pytest.fixture(scope="module")
def eligible(spark, sf_dir):
    rows = traces.eligible_frames(H.frames(spark, sf_dir), H.truth(spark, sf_dir))
    said = F.sort_array(F.collect_list(F.struct("attempt", "status", "content")))
    said = H.responses(spark, sf_dir).groupBy(*traces.FRAME).agg(said.alias("said"))
    turn = F.row_number().over(Window.partitionBy(*traces.TASK).orderBy("frame_pos"))
    return rows.join(said, traces.FRAME, "left").withColumn("turn", turn).cache()


def shown(rows):
    steps = [F.col("trace")[s].alias(s) for s in STEPS]
    return sorted(map(repr, rows.select(*SHOWN, *steps).collect()))


def odd_answers(rng, seen, said):
    """Answers around the rules: broken JSON, fences, labels, lengths, phrases and boxes."""
    steps = ["Step 1: step1 task progress - on", seen, said, f"{said} now."]
    good = dict(zip(STEPS, steps))
    full = json.dumps(good)
    yield from (full, f"```json\n{full}\n```", f"so: {full} done", full + full, f"[{full}]", "", "{}", "no", "null", None, "{", " \u3000 ")
    yield from (full.replace('"', "'"), full[:-1] + ",}", full[:-1] + ', "more": 1}', full.replace("step2", "step1", 1), full[:-1] + ', "x": NaN}')
    yield from ("```md " + full + " ``` ```", full.replace(": ", ":\r\n\t"), full.replace("on", "o\nn", 1), "[" * 50 + "]" * 50)
    for name in STEPS:
        for value in (None, 3, "", " \u2003\x0b", "Step 4. " + name, name.replace("_", "  ").upper() + ": ", "x" * 400, "x" * 401, "é" * 400, [], {"a": 1}, True):
            yield json.dumps(good | {name: value}, ensure_ascii=rng.random() < 0.5)
        yield json.dumps({k: v for k, v in good.items() if k != name})
    for text in ("One. Two.", "One.Two", "a! b?", "v1.5 is it.", said + ".\u00a0And.", said + "...", f"{said}.  Then. ", said.upper()):
        yield json.dumps(good | {STEPS[3]: text}) and json.dumps(good | {STEPS[3]: f"{said} {text}", STEPS[2]: said.upper()})
    for text in ("it is not visible", "NOT VISIBLE", seen.upper(), seen.lower(), seen.replace(" ", ""), seen.replace("[", "[ "), seen.replace("[", "[9"), seen[1:], seen + " not visible", "x" * 398):
        yield json.dumps(good | {STEPS[1]: text})
    yield json.dumps(good | dict.fromkeys((STEPS[0], STEPS[2], STEPS[3]), said + "x" * 380))


def test_rules_of_one_answer_equal_the_columns(spark, eligible):
    rng = random.Random(5)
    seen = F.when(F.size("objects") > 0, format_annotated_objects(F.col("objects"))).otherwise("target is not visible")
    frames = eligible.withColumns({"seen": seen, "phrase": action_phrase(F.col("action"))}).limit(25).cache()
    texts = [(r.task_idx, r.frame_pos, t) for r in frames.collect() for t in odd_answers(rng, r.seen, r.phrase)]
    told = spark.createDataFrame(texts, "task_idx long, frame_pos int, content string")
    rows = chain.frame_cards(frames).join(frames.select("task_idx", "turn", "frame_pos", "objects", "action"), ["task_idx", "turn"])
    rows = rows.join(told, ["task_idx", "frame_pos"]).withColumn("parsed", parse_trace(F.col("content")))
    rows = rows.withColumn("reason", first_error(F.col("parsed"), F.col("objects"), F.col("action")))
    rows = rows.withColumn("sent", retry_answer(F.col("content"))).withColumn("asked", retry_request(F.col("reason"), F.col("action")))
    kinds = set()
    for r in rows.collect():
        reason, steps = rules.judge(r.content, json.loads(r.card)["facts"])
        assert reason == r.reason, (r.content, reason, r.reason)
        kinds.add((reason or "valid").split(":")[0])
        if reason is None:
            assert steps == {k: v for k, v in r.parsed.asDict().items() if k in STEPS}
        else:
            assert rules.correction(r.content, reason, r.action) == (r.sent, r.asked)
    assert kinds >= {"valid", "empty", "json", "object", "missing", "type", "blank", "long", "extra", "unseen", "label", "bbox", "visible", "step3_action", "step4_action", "sentence"}


def test_long_episode_is_one_walk(spark, eligible):
    """As many frames in one episode as there are rows: still one job with one walk."""
    turn = F.row_number().over(Window.orderBy("task_idx", "frame_pos"))
    one = eligible.withColumn("frame_pos", turn.cast("int")).withColumn("task_idx", F.lit(1).cast("long")).drop("turn")
    live = chain.generate_chain(one, recorded_answer)
    responses = one.select(*traces.FRAME, F.explode("said").alias("s")).select(*traces.FRAME, "s.*")
    assert shown(live) == shown(chain.replay(one, responses))
    exchanges = [chain.generate_chain(rows, recorded_answer)._jdf.queryExecution().toString().count("Exchange") for rows in (one, one.limit(3))]
    assert abs(exchanges[0] - exchanges[1]) <= 2


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_stream_in_pieces_and_any_order(spark, eligible, sf_dir, tmp_path):
    """Later frames arrive first, in several micro-batches and after a restart."""
    for k, part in enumerate(("turn % 3 = 0", "turn % 3 = 2")):
        eligible.where(part).coalesce(1).write.parquet(str(tmp_path / f"part{k}"))
    source = tmp_path / "in"
    source.mkdir()

    def arrive(k):
        for f in (tmp_path / f"part{k}").glob("*.parquet"):
            f.rename(source / f"{k}-{f.name}")

    def run():
        walked = episodes.generate_stream(stream_of(spark, source, eligible.schema), recorded_answer, waits=False)
        episodes.write_walked(walked, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    arrive(0)
    arrive(1)
    assert run().count() == 0  # no episode has its first frame yet
    eligible.where("turn % 3 = 1").coalesce(1).write.parquet(str(tmp_path / "part2"))
    arrive(2)
    want = chain.replay(eligible, H.responses(spark, sf_dir))
    assert shown(run()) == shown(want)


def flaky(prompt, notes, attempt, frame):
    """A transport error, then a bad answer, then the recorded one."""
    if attempt == 1:
        return "transport_error", None
    return ("ok", "{}") if attempt == 2 else recorded_answer(prompt, notes, 1, frame)


def test_failed_attempts_wait_for_a_timer(spark, eligible, tmp_path):
    frames = eligible.where("turn <= 2 and task_idx < 4")
    frames.coalesce(1).write.parquet(str(tmp_path / "in"))
    walked = episodes.generate_stream(stream_of(spark, tmp_path / "in", eligible.schema), flaky)
    began = time.time()
    query = episodes.write_walked(walked, str(tmp_path / "out"), str(tmp_path / "check"), "1 second")
    try:
        expected, schema = frames.count(), StructType([StructField("outcome", StringType())])
        while time.time() - began < 90:
            made = spark.read.schema(schema).parquet(str(tmp_path / "out")).count() if (tmp_path / "out").exists() else 0
            if made == expected or not query.isActive:
                break
            time.sleep(1)
    finally:
        query.stop()
    responses = frames.select(*traces.FRAME, F.explode(F.array(*[F.lit(k) for k in (1, 2, 3)])).alias("attempt"), "said").select(
        *traces.FRAME,
        "attempt",
        F.when(F.col("attempt") == 1, "transport_error").when(F.col("attempt") == 2, "ok").otherwise(F.coalesce(F.col("said")[0]["status"], F.lit("transport_error"))).alias("status"),
        F.when(F.col("attempt") == 2, "{}").when(F.col("attempt") == 3, F.col("said")[0]["content"]).alias("content"),
    )
    assert shown(spark.read.parquet(str(tmp_path / "out"))) == shown(chain.replay(frames, responses))
    assert time.time() - began > 2 * 3  # two frames an episode, each with pauses of 2 s and 1 s


def test_the_store_is_not_asked_after_every_frame(spark):
    from waymark.operators.chain import EpisodeWalk

    class Store:
        calls, value = 0, None

        def exists(self):
            self.calls += 1
            return False

        def update(self, value):
            self.value = value

    walk, stores = EpisodeWalk(lambda p, n, k, f: ("transport_error", "")), [Store(), Store(), Store()]
    walk.walk, walk.waiting, walk.trying = stores
    cards = [json.dumps({"prompt": ["", ""], "facts": {}, "bare": "b", "frame": {"frame_pos": k, "frame": k, "action": "STOP"}}) for k in range(50)]
    (rows,) = walk.handleInputRows((0, 1), iter([pd.DataFrame({"turn": range(1, 51), "card": cards})]), None)
    assert rows["history_source_frame"].tolist()[1:] == list(range(49)) and walk.walk.value == (51, "b", 49)
    assert sum(s.calls for s in stores) <= 3
