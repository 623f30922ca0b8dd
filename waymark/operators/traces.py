"""Frames to chat records by replay of recorded answers.

The anchor of a frame depends on its own answer and facts only, so the memory of the next
frame is a lag, taken over chunks of an episode.  That holds for the policy ``skip``; under ``template`` a frame has
one of two anchors, and which one is settled by ``template_chain``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.functions import fixed_texts as T
from waymark.functions.actions import decode_action, history_memory_text, memory_anchor
from waymark.functions.prompts import build_prompt, error_cause, render_trace, retry_answer, retry_request, template_steps
from waymark.functions.text import frame_name, outer_object, without_fences
from waymark.functions.validation import answer_fields, checked_steps, clean_step, first_error, is_whole, trace_of
from waymark.operators import scan
from waymark.sources.scratch import materialize

TASK = ["src_idx", "task_idx"]
FRAME = [*TASK, "frame_pos"]


def only_episodes(rows: DataFrame, ids: DataFrame | list | None, empty_is_all: bool = False) -> DataFrame:
    """Rows of the listed episodes.  No list: all.  An empty list: none, or all if asked.

    A list that is a DataFrame (episode_id) is a semi join, so it may be of any length.
    """
    if ids is None:
        return rows
    if isinstance(ids, DataFrame):
        if empty_is_all and not ids.limit(1).count():
            return rows
        return rows.join(ids.select("episode_id").distinct(), "episode_id", "left_semi")
    if not ids:
        return rows if empty_is_all else rows.limit(0)
    return rows.where(F.col("episode_id").isin(list(ids)))


def with_truth(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """Join the ground truth (episode_key, ...) by the id as text."""
    return rows.join(truth, rows["episode_id"].cast("string") == truth["episode_key"])


def without_truth(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """Rows whose episode has no ground truth."""
    return rows.join(
        truth.select("episode_key"), rows["episode_id"].cast("string") == F.col("episode_key"), "left_anti"
    )


def distinct_subtasks(frames: DataFrame) -> DataFrame:
    """(task, subtasks): the different sub-tasks over all frames in the order first seen."""
    first = frames.where("subtask is not null").groupBy(*TASK, "subtask").agg(F.min("frame_pos").alias("at"))
    ordered = F.sort_array(F.collect_list(F.struct("at", "subtask")))
    return first.groupBy(*TASK).agg(F.transform(ordered, lambda s: s["subtask"]).alias("subtasks"))


def eligible_frames(frames: DataFrame, truth: DataFrame, ids: DataFrame | list | None = None) -> DataFrame:
    """Frames with a sub-task and an action at their number; the others leave memory alone.

    ``frames``: src_idx, task_idx, frame_pos, episode_id, instruction, frame, subtask, objects.
    Adds ``action``, the task's ``subtasks`` and ``completed``, the index of the frame's
    sub-task among them.
    """
    chosen = only_episodes(frames, ids)
    with_lists = chosen.join(distinct_subtasks(chosen), TASK, "left")
    code = F.get(F.col("actions"), F.col("frame") - 1)
    return (
        with_truth(with_lists, truth)
        .where("subtask is not null and frame >= 1 and frame <= size(actions)")
        .withColumn("action", decode_action(code))
        .withColumn("completed", (F.array_position("subtasks", F.col("subtask")) - 1).cast("int"))
        .drop("actions", "locations", "episode_key")
    )


def _fixed(rows: DataFrame, *names: str) -> DataFrame:
    """The rows with these columns behind a generator.

    A filter on a column is pushed below it: Spark would write the column's whole expression into
    the filter, once for each mention.  Nothing is pushed through a generator.
    """
    others = [c for c in rows.columns if c not in names]
    return rows.select(*others, F.inline(F.array(F.struct(*names))))


def with_trace(rows: DataFrame) -> DataFrame:
    """Add ``trace``, ``parse_trace`` of ``content``, each part of it as a column of its own."""
    # in stages, as Java does not compile what becomes too large as one piece of code
    rows = _fixed(rows.withColumn("_plain", without_fences(F.coalesce("content", F.lit("")))), "_plain")
    rows = _fixed(rows.withColumn("_text", outer_object(F.col("_plain"))), "_text").drop("_plain")
    rows = _fixed(rows.withColumn("_value", F.try_parse_json("_text")), "_value")
    pairs = dict(zip(T.STEPS, answer_fields(F.col("_value"))))
    fields = {f"_{at}_{n}": p[k] for n, p in pairs.items() for k, at in enumerate(("kind", "text"))}
    whole, kind = is_whole(F.col("_text"), F.col("_value")), F.schema_of_variant("_value")
    rows = _fixed(rows.withColumns(fields | {"_kind": kind, "_whole": whole}), "_kind", "_whole", *fields)
    trace = trace_of(F.col("_text"), F.col("_whole"), F.col("_kind"), [(F.col(f"_kind_{n}"), F.col(f"_text_{n}")) for n in T.STEPS])
    rows = rows.withColumn("trace", trace).drop("_text", "_whole", "_value", "_kind", *fields)
    return _fixed(rows, "trace")


def validate_responses(eligible: DataFrame, responses: DataFrame) -> DataFrame:
    """Every attempt of every eligible frame with ``reason`` (null: valid) and its steps.

    ``responses``: src_idx, task_idx, frame_pos, attempt, status, content.  A transport
    error has the reason ``transport``.
    """
    rows = eligible.select(*FRAME, "action", "objects").join(responses, FRAME)
    reason = F.when(F.col("status") != "ok", "transport").otherwise(
        first_error(F.col("trace"), F.col("objects"), F.col("action"))
    )
    return _fixed(with_trace(rows).withColumn("reason", reason), "reason")


def accepted_attempts(validated: DataFrame, max_retries: int = 3) -> DataFrame:
    """The first valid attempt among the first ``max_retries`` of each frame."""
    order = Window.partitionBy(*FRAME).orderBy("attempt")
    valid = validated.where(f"reason is null and attempt <= {max_retries}")
    return valid.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def choose_outcome(validated: DataFrame, max_retries: int = 3) -> DataFrame:
    """(frame key, outcome, trace): ``trace`` with the first valid attempt, ``invalid`` if
    some answer was bad and none good, ``failed`` if only transport failed."""
    tried = validated.where(f"attempt <= {max_retries}")
    best = F.min(F.when(F.col("reason").isNull(), F.struct("attempt", "trace")))
    bad = F.bool_or(F.coalesce(F.col("reason") != "transport", F.lit(False)))
    return (
        tried.groupBy(*FRAME)
        .agg(best.alias("best"), bad.alias("bad"))
        .select(
            *FRAME,
            F.when(F.col("best").isNotNull(), "trace").when(F.col("bad"), "invalid").otherwise("failed").alias("outcome"),
            F.col("best.attempt").alias("attempt"),
            F.col("best.trace").alias("trace"),
        )
    )


def _with_anchor(eligible: DataFrame, outcomes: DataFrame) -> DataFrame:
    rows = eligible.join(outcomes, FRAME, "left").withColumn("outcome", F.coalesce("outcome", F.lit("failed")))
    anchor = memory_anchor(
        F.col("subtask"), F.col("objects"), F.col("action"), F.col("trace")["step4_memory_update"]
    )
    return rows.withColumn("anchor", anchor)


def memory_chain(eligible: DataFrame, outcomes: DataFrame, size: int = scan.SIZE) -> DataFrame:
    """Eligible frames with their outcome, anchor, incoming memory and its source frame.

    Frames that failed still hand on a memory, so this runs before any filter.  An episode is
    scanned in chunks of ``size`` positions, so a long one spreads over tasks.
    """
    rows = scan.in_chunks(_with_anchor(eligible, outcomes), "frame_pos", size)
    before = {"memory": "anchor", "history_source_frame": "frame"}
    return scan.lags(rows, TASK, "frame_pos", before).drop(scan.CHUNK)


def _truth_steps(memory: Column) -> list[Column]:
    return template_steps(
        F.col("subtask"), F.col("objects"), memory, F.col("instruction"),
        F.col("subtasks"), F.col("completed"), F.col("action"),
    )


def _with_template(rows: DataFrame, memory: Column, name: str) -> DataFrame:
    """Add the steps from ground truth after this memory, null if they break a rule or the
    frame's answers were not all bad.  Each stage is a column of its own, so that no
    expression holds another one over and over."""
    wanted = F.when(F.col("outcome") == "invalid", F.array(*_truth_steps(memory)))
    cleaned = {f"_{s}": clean_step(F.get("_steps", F.lit(k)), s) for k, s in enumerate(T.STEPS)}
    staged = rows.withColumn("_steps", wanted).withColumns(cleaned)
    staged = staged.withColumn("_checked", checked_steps({s: F.col(f"_{s}") for s in T.STEPS}))
    staged = staged.withColumn("_error", first_error(F.col("_checked"), F.col("objects"), F.col("action")))
    made = F.when(F.col("_error").isNull(), F.struct(*[F.col(f"_{s}").alias(s) for s in T.STEPS]))
    return staged.withColumn(name, made).drop("_steps", "_checked", "_error", *cleaned)


def template_trace(rows: DataFrame) -> DataFrame:
    """Give frames whose answers were all bad (outcome ``invalid``, memory known) the trace
    from ground truth and the outcome ``template``, if that trace is valid."""
    known = F.struct(*[F.col("trace")[s].alias(s) for s in T.STEPS])
    return _with_template(rows, F.col("memory"), "_made").select(
        *[c for c in rows.columns if c not in ("outcome", "trace")],
        F.when(F.col("_made").isNotNull(), "template").otherwise(F.col("outcome")).alias("outcome"),
        F.when(F.col("trace").isNotNull(), known).otherwise(F.col("_made")).alias("trace"),
    )


def template_chain(eligible: DataFrame, outcomes: DataFrame, size: int = scan.SIZE) -> DataFrame:
    """``memory_chain`` under the policy ``template``.

    The steps from ground truth show the memory, so whether they are valid may depend on the
    frame before, and so on.  A frame hands on one of two anchors: with or without its
    trace.  Whether it has one is tried for both anchors of the frame before; where that
    agrees it is settled, and in between it is passed on, straight or turned round, which
    chunks of an episode compose like single frames (``scan.settle``).
    """
    rows = _with_anchor(eligible, outcomes)
    bare = memory_anchor(F.col("subtask"), F.col("objects"), F.col("action"), F.lit(None).cast("string"))
    # the anchor so far is that of the trace, where there is one; the last step from ground
    # truth, and so its anchor, does not show the memory
    last = clean_step(_truth_steps(F.lit(None).cast("string"))[3], T.STEPS[3])
    rows = rows.withColumns({"_bare": bare, "_last": last})
    told = F.when(F.col("trace").isNull(), history_memory_text(F.col("_last"))).otherwise(F.col("anchor"))
    rows = scan.in_chunks(rows.withColumn("_told", told).drop("_last"), "frame_pos", size)
    before = {"_lag_bare": "_bare", "_lag_told": "_told", "history_source_frame": "frame"}
    rows = scan.lags(rows, TASK, "frame_pos", before)
    rows = _with_template(rows, F.col("_lag_bare"), "_after_bare")
    rows = _with_template(rows, F.col("_lag_told"), "_after_told")
    known = F.col("trace").isNotNull()
    rows = rows.withColumns(
        {"_if_bare": known | F.col("_after_bare").isNotNull(), "_if_told": known | F.col("_after_told").isNotNull()}
    )
    settled = F.when((F.col("_if_bare") == F.col("_if_told")) | F.col("_lag_bare").isNull(), F.col("_if_bare"))
    rows = rows.withColumns({"_settled": settled, "_turn": (F.col("_if_bare") & ~F.col("_if_told")).cast("int")})
    rows = materialize(rows.drop("_after_bare", "_after_told", "_if_bare", "_if_told"), "settled")
    rows = scan.settle(rows, TASK, "frame_pos", "_settled", "_turn", "_has")
    rows = rows.withColumns(
        {
            "anchor": F.when(F.col("_has"), F.col("_told")).otherwise(F.col("_bare")),
            "memory": F.when(F.col("_has_before"), F.col("_lag_told")).otherwise(F.col("_lag_bare")),
        }
    )
    return template_trace(rows.drop(*[c for c in rows.columns if c.startswith("_")]))


def with_image(rows: DataFrame, videos: DataFrame, folder: str) -> DataFrame:
    """Add image_path: a name under ``folder`` if the episode's video exists, else null."""
    there = videos.select(F.col("episode_id").alias("_video")).distinct()
    name = F.concat(F.lit(folder.rstrip("/") + "/"), frame_name(F.col("episode_id"), F.col("frame")))
    return (
        rows.join(there, rows["episode_id"] == F.col("_video"), "left")
        .withColumn("image_path", F.when(F.col("_video").isNotNull(), name))
        .drop("_video")
    )


def with_prompt(chained: DataFrame) -> DataFrame:
    """Add the prompt that the frame's state and memory give."""
    return chained.withColumn(
        "prompt",
        build_prompt(
            F.col("subtask"),
            F.col("objects"),
            F.col("memory"),
            F.col("instruction"),
            F.col("subtasks"),
            F.col("completed"),
            F.col("action"),
        ),
    )


def chat_records(chained: DataFrame) -> DataFrame:
    """(task, frame_pos, episode_id, frame, line): one JSON line per accepted frame.

    ``chained`` has prompt and, optionally, image_path.  The user's content is an array and
    the assistant's a string; the source frame of a missing memory is written as null.
    """
    image = F.col("image_path") if "image_path" in chained.columns else F.lit(None).cast("string")
    text = F.to_json(F.struct(F.lit("text").alias("type"), F.col("prompt").alias("text")))
    picture = F.to_json(F.struct(F.lit("image_path").alias("type"), image.alias("image_path")))
    content = F.when(image.isNull(), text).otherwise(F.concat(picture, F.lit(","), text))
    answer = render_trace([F.col("trace")[s] for s in T.STEPS], F.col("action"))
    state = F.to_json(
        F.struct(
            history_memory_text(F.col("memory")).alias("historical_trajectory_memory"),
            F.col("history_source_frame"),
        ),
        {"ignoreNullFields": "false"},
    )
    head = F.to_json(F.struct("episode_id", "frame"), {"ignoreNullFields": "false"})
    told = F.to_json(F.struct(F.lit("assistant").alias("role"), answer.alias("content")))
    line = F.concat(
        F.expr("substring(_head, 1, length(_head) - 1)"),
        F.lit(',"input_state":'), F.col("_state"),
        F.lit(',"messages":[{"role":"user","content":['), F.col("_content"),
        F.lit("]},"), F.col("_told"), F.lit("]}"),
    )
    return (
        chained.where("outcome in ('trace', 'template')")
        .withColumns({"_head": head, "_state": state, "_content": content, "_told": told})
        .select(*FRAME, "episode_id", "frame", line.alias("line"))
    )


def retry_history(validated: DataFrame) -> DataFrame:
    """Attempts with the messages that precede them: the feedback of all earlier invalid
    ones, each as the bad answer, a request to correct it and the reason code."""
    earlier = Window.partitionBy(*FRAME).orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    note = F.when(
        F.col("reason").isNotNull() & (F.col("reason") != "transport"),
        F.struct(
            retry_answer(F.col("content")).alias("assistant"),
            retry_request(F.col("reason"), F.col("action"), F.col("_cause")).alias("user"),
            "reason",
        ),
    )
    rows = validated.withColumn("_cause", error_cause(F.col("reason"), F.col("content")))
    return rows.withColumn("feedback", F.collect_list(note).over(earlier)).drop("_cause")


def action_log(rows: DataFrame) -> DataFrame:
    """Add ``log``: ``Step t: Executed a.`` of all earlier frames, in one line."""
    earlier = Window.partitionBy(*TASK).orderBy("frame_pos").rowsBetween(Window.unboundedPreceding, -1)
    said = F.concat(F.lit("Step "), F.col("frame").cast("string"), F.lit(": Executed "), F.col("action"), F.lit("."))
    return rows.withColumn("log", F.array_join(F.collect_list(said).over(earlier), " "))


def response_diagnosis(responses: DataFrame) -> DataFrame:
    """Per thinking mode and response format: answers, empty and truncated ones, and the mean
    length of reasoning."""
    empty = F.coalesce(F.col("content"), F.lit("")) == ""
    return responses.groupBy("thinking_mode", "response_format").agg(
        F.count(F.lit(1)).alias("answers"),
        F.count_if(empty).alias("empty"),
        F.count_if(F.col("finish_reason") == "length").alias("truncated"),
        F.count_if(empty & (F.col("finish_reason") == "length")).alias("truncated_empty"),
        F.avg(F.length(F.coalesce("reasoning", F.lit("")))).alias("mean_reasoning"),
    )
