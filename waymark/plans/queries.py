"""One registered query per operator, each beside its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import actions as A
from waymark.functions import boxes as B
from waymark.functions import geometry as G
from waymark.functions import prompts as P
from waymark.functions import text as X
from waymark.functions import validation as V
from waymark.operators import chain, documents, frames, spatial, traces
from waymark.plans import harness as H
from waymark.plans.oracle_views import sql
from waymark.sources import readers, sinks
from waymark.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(needs: list[str] | None = None, body: str | None = None):
    """Register a query, with SQL behind the named views unless SQL cannot say it."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if body is not None:
            SQL[f.__name__] = sql(needs or [], body) if needs else body
        return f

    return add


C = F.col


# --- tasks and headers -------------------------------------------------------------------


@query(["headers"], "SELECT task_idx, episode_id FROM headers")
def episode_id_from_url(spark, d):
    return H.tasks(spark, d).select("task_idx", X.episode_id_from_url(C("video_url")).alias("episode_id"))


@query(["tasks"], "SELECT task_idx, 'video' AS first_key, video_url FROM tasks")
def first_meta_key(spark, d):
    key = frames.first_video_key(C("data"))
    return H.raw_tasks(spark, d).select(
        "task_idx", key.alias("first_key"), F.try_element_at("data", key).alias("video_url")
    )


@query(
    ["tasks"],
    """SELECT dense_rank() OVER (ORDER BY task_idx // 1024) - 1 AS src_idx, row_number() OVER (PARTITION BY task_idx // 1024 ORDER BY task_idx) - 1 AS task_idx,
      video_url, coalesce(trunc(meta_duration), trunc(result_duration), 0)::INT AS duration FROM tasks""",
)
def src_annotation_export(spark, d):
    path = scratch_path(spark, "export")
    H.export_files(spark, d, path)
    read = frames.task_header(readers.read_annotation_export(spark, path), "fallback")
    return read.select("src_idx", "task_idx", "video_url", "duration")


@query(["truth"], "SELECT episode_key, array_to_string(actions, ' ') AS actions FROM truth")
def src_ground_truth(spark, d):
    path = scratch_path(spark, "truth")
    H.truth_files(spark, d, path)
    return readers.read_ground_truth(spark, path).select("episode_key", F.array_join(C("actions").cast("array<string>"), " ").alias("actions"))


@query(
    ["tasks"],
    "SELECT task_idx, trunc(meta_duration)::INT AS duration, CASE WHEN meta_duration IS NULL THEN 'duration' END AS problem FROM tasks",
)
def duration_strict(spark, d):
    return frames.task_header(H.raw_tasks(spark, d), "strict").select("task_idx", "duration", "problem")


@query(
    ["tasks"],
    "SELECT task_idx, coalesce(trunc(meta_duration), trunc(result_duration), 0)::INT AS duration FROM tasks",
)
def duration_fallback(spark, d):
    return frames.task_header(H.raw_tasks(spark, d), "fallback").select("task_idx", "duration")


@query(
    ["tasks"],
    "SELECT task_idx, i AS result_idx, CASE i WHEN 0 THEN 'first ' ELSE 'second ' END || task_idx AS text, 2 AS frame FROM tasks, (SELECT unnest([0, 1]) AS i)",
)
def first_annotation_only(spark, d):
    return frames.explode_keyframes(H.raw_tasks(spark, d)).select("task_idx", "result_idx", "text", "frame")


@query(
    None,
    "SELECT o_custkey AS episode_id, arg_max(o_orderpriority, o_orderkey) AS text FROM orders GROUP BY o_custkey",
)
def src_instructions_last_wins(spark, d):
    rows = H.table(spark, d, "orders").selectExpr("o_custkey as episode_id", "o_orderpriority as text", "o_orderkey as pos")
    return readers.last_wins(rows, "episode_id", "pos")


@query(["told"], "SELECT task_idx, episode_id, instruction FROM told")
def join_instruction_left(spark, d):
    return _told(spark, d).select("task_idx", "episode_id", "instruction")


def _told(spark, d):
    return frames.with_instruction(H.headers(spark, d), H.instructions(spark, d))


# --- keyframes to frames -----------------------------------------------------------------


@query(
    ["keylabels"],
    "SELECT l_orderkey AS task_idx, l_linenumber AS result_idx, kind, text FROM keylabels",
)
def label_prefix_route(spark, d):
    rows = H.keyframes(spark, d).where("seq_idx = 0")
    label = F.concat("kind", F.lit(":"), "text")
    other = rows.withColumn("label", F.concat(F.lit("other:"), "text"))
    both = rows.withColumn("label", label).unionByName(other).withColumn("r", X.route_label(C("label")))
    return both.where("r is not null").select("task_idx", "result_idx", "r.kind", "r.text")


@query(["placed"], "SELECT task_idx, result_idx, seq_idx, frame, text FROM placed")
def enabled_keyframes(spark, d):
    kept = frames.enabled_keyframes(H.keyframes(spark, d), H.headers(spark, d))
    return kept.select("task_idx", "result_idx", "seq_idx", "frame", "text")


@query(["ranges"], "SELECT task_idx, result_idx, text, start_frame, end_frame FROM ranges")
def agg_subtask_range(spark, d):
    found = frames.subtask_ranges(H.keyframes(spark, d), H.headers(spark, d))
    return found.select("task_idx", "result_idx", "text", "start_frame", "end_frame")


@query(
    ["ranges", "skeleton"],
    "SELECT s.task_idx, frame, result_idx, text FROM skeleton s JOIN ranges r ON s.task_idx = r.task_idx AND frame BETWEEN start_frame AND end_frame",
)
def join_subtask_range(spark, d):
    ranges = frames.subtask_ranges(H.keyframes(spark, d), H.headers(spark, d))
    return frames.range_frames(ranges).select("task_idx", "frame", "result_idx", "text")


@query(["labelled"], "SELECT task_idx, frame, subtask FROM labelled WHERE subtask IS NOT NULL")
def agg_subtask_last_wins(spark, d):
    heads = H.headers(spark, d)
    ranges = frames.subtask_ranges(H.keyframes(spark, d), heads)
    return frames.frame_subtasks(heads, ranges).select("task_idx", "frame", "subtask")


def _object_text(column: str):
    return F.array_join(
        F.transform(
            column,
            lambda o: F.concat(
                o["label"], F.lit("@"), o["bbox"]["x"].cast("bigint").cast("string"), F.lit(","),
                o["bbox"]["y"].cast("bigint").cast("string"),
            ),
        ),
        "; ",
    )


@query(["placed_text"], "SELECT task_idx, frame, objects FROM placed_text")
def agg_objects_ordered(spark, d):
    found = frames.frame_objects(H.keyframes(spark, d), H.headers(spark, d))
    return found.select("task_idx", "frame", _object_text("objects").alias("objects"))


def _frames1(spark, d):
    return frames.expand_frames(H.headers(spark, d), H.keyframes(spark, d))


@query(
    ["labelled", "placed_text"],
    "SELECT l.task_idx, l.frame, subtask, coalesce(objects, '') AS objects FROM labelled l LEFT JOIN placed_text p ON l.task_idx = p.task_idx AND l.frame = p.frame",
)
def join_objects_left(spark, d):
    return _frames1(spark, d).select("task_idx", "frame", "subtask", _object_text("objects").alias("objects"))


@query(
    ["told", "labelled", "placed_text"],
    """SELECT t.task_idx, any_value(t.episode_id) AS episode_id, any_value(instruction) AS instruction, count(l.frame) AS n_frames,
      string_agg(l.frame || ':' || coalesce(subtask, '-') || ':' || coalesce(n_objects, 0), ' ' ORDER BY l.frame) AS frames
    FROM told t JOIN labelled l ON t.task_idx = l.task_idx LEFT JOIN placed_text p ON l.task_idx = p.task_idx AND l.frame = p.frame GROUP BY t.task_idx""",
)
def agg_assemble_frames(spark, d):
    rows = frames.assemble_episodes(_told(spark, d), frames.nested_frames(H.headers(spark, d), H.keyframes(spark, d)))
    return _assembled(rows).select("task_idx", "episode_id", "instruction", "n_frames", "frames")


def _assembled(rows):
    told = F.transform(
        "frames",
        lambda f: F.concat_ws(":", f["frame"].cast("string"), F.coalesce(f["subtask"], F.lit("-")), F.size(f["objects"]).cast("string")),
    )
    return rows.withColumns({"n_frames": F.size("frames").cast("long"), "frames": F.array_join(told, " ")})


@query(
    ["told", "labelled", "placed_text"],
    """SELECT any_value(t.episode_id) AS episode_id, any_value(instruction) AS instruction, count(l.frame) AS n_frames,
      string_agg(l.frame || ':' || coalesce(subtask, '-') || ':' || coalesce(n_objects, 0), ' ' ORDER BY l.frame) AS frames
    FROM told t JOIN labelled l ON t.task_idx = l.task_idx LEFT JOIN placed_text p ON l.task_idx = p.task_idx AND l.frame = p.frame GROUP BY t.task_idx""",
)
def src_processed_episodes(spark, d):
    path = scratch_path(spark, "episodes")
    rows = frames.assemble_episodes(_told(spark, d), frames.nested_frames(H.headers(spark, d), H.keyframes(spark, d)))
    sinks.write_episodes(rows, path, compression="gzip")
    return _assembled(readers.read_episodes(spark, path)).select("episode_id", "instruction", "n_frames", "frames")


# --- quality errors ----------------------------------------------------------------------

_ERROR = "src_idx, task_idx, phase, result_idx, label_idx, frame, code, message"


def _error_columns(errors: DataFrame) -> DataFrame:
    return errors.select(*_ERROR.split(", "))


@query(["errors"], f"SELECT {_ERROR} FROM errors WHERE phase = 0")
def err_missing_instruction(spark, d):
    return _error_columns(frames.instruction_errors(_told(spark, d)))


@query(["errors"], f"SELECT {_ERROR} FROM errors WHERE phase = 1")
def err_not_in_instruction(spark, d):
    return _error_columns(frames.label_errors(_told(spark, d), H.keyframes(spark, d)))


@query(["errors"], f"SELECT {_ERROR} FROM errors WHERE phase = 2")
def err_missing_subtask(spark, d):
    return _error_columns(frames.frame_errors(_subtasks1(spark, d)))


def _subtasks1(spark, d):
    return frames.labelled_frames(H.headers(spark, d), H.keyframes(spark, d))


def _errors(spark, d):
    return frames.quality_errors(_told(spark, d), H.keyframes(spark, d), _subtasks1(spark, d))


@query(
    ["errors"],
    """SELECT row_number() OVER (ORDER BY src_idx, task_idx, phase, result_idx, label_idx, frame, i) - 1 AS record_idx, lines[i + 1] AS value
    FROM (SELECT *, unnest(range(len(lines))) AS i FROM (SELECT *, string_split(message, chr(10)) AS lines FROM errors))""",
)
def sink_error_log(spark, d):
    """The log's lines by their place in the files."""
    path = scratch_path(spark, "error-log")
    sinks.write_error_log(frames.error_lists(_told(spark, d), H.headers(spark, d), H.keyframes(spark, d)), path, "gzip")
    return readers.numbered_lines(spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start"))


@query(["errors"], f"SELECT {_ERROR} FROM errors ORDER BY src_idx, task_idx, phase, result_idx, label_idx, frame")
def error_log_ordered(spark, d):
    lists = frames.error_lists(_told(spark, d), H.headers(spark, d), H.keyframes(spark, d))
    return _error_columns(frames.expand_errors(lists.orderBy(*frames.ERROR_ORDER)))


@query(
    ["errors", "told", "labelled"],
    """SELECT (SELECT count(*) FROM told) AS tasks, (SELECT min(episode_id) FROM told) AS first_id, (SELECT max(episode_id) FROM told) AS last_id,
      (SELECT count(*) FROM errors) AS errors, (SELECT count(*) FROM labelled) AS frames, (SELECT count(subtask) FROM labelled) AS labelled_frames""",
)
def agg_run_report(spark, d):
    return frames.run_report(_told(spark, d), _errors(spark, d), _subtasks1(spark, d))


_PART = "SELECT part_idx, src_idx, task_idx, episode_id FROM (SELECT 0 AS part_idx, * FROM headers WHERE task_idx % 3 > 0 UNION ALL SELECT 1, * FROM headers WHERE task_idx % 3 < 2)"


def _merged(spark, d, ascending):
    heads = H.headers(spark, d)
    rows = frames.merge_episodes(heads.where("task_idx % 3 > 0"), heads.where("task_idx % 3 < 2"), ascending=ascending)
    return rows.select("part_idx", "src_idx", "task_idx", "episode_id")


@query(["headers"], _PART + " ORDER BY episode_id DESC NULLS LAST, part_idx, task_idx")
def sort_desc_stable(spark, d):
    return _merged(spark, d, False)


@query(["headers"], _PART + " ORDER BY episode_id ASC NULLS LAST, part_idx, task_idx")
def sort_asc_stable(spark, d):
    return _merged(spark, d, True)


@query(["headers"], f"SELECT part_idx, count(*) AS rows, count(DISTINCT task_idx) AS tasks FROM ({_PART}) GROUP BY part_idx")
def union_all_exports(spark, d):
    rows = _merged(spark, d, True).groupBy("part_idx")
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("task_idx").alias("tasks"))


# --- scalar functions --------------------------------------------------------------------


@query(
    None,
    r"""SELECT doc_id, trim(regexp_replace('  ' || replace(text, ' ', '  ' || chr(9)) || chr(10), '\s+', ' ', 'g')) AS text FROM documents
    UNION ALL SELECT page_id, trim(regexp_replace(html, '\s+', ' ', 'g')) FROM pages""",
)
def collapse_whitespace(spark, d):
    spaced = F.concat(F.lit("  "), F.replace(C("text"), F.lit(" "), F.lit("  \t")), F.lit("\n"))
    docs = H.table(spark, d, "documents").select("doc_id", X.collapse_whitespace(spaced).alias("text"))
    pages = H.table(spark, d, "pages").select("page_id", X.collapse_whitespace(C("html")))
    return docs.union(pages)


@query(
    None,
    r"""SELECT doc_id, CASE doc_id % 5 WHEN 2 THEN 'task progress: ' || t WHEN 4 THEN 'note step 1: ' || t ELSE t END AS text
    FROM (SELECT doc_id, 'z' || regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '\s+', ' ', 'g') AS t FROM documents)""",
)
def strip_leading_label(spark, d):
    t = F.concat(F.lit("z"), X.collapse_whitespace(C("text")))
    k = C("doc_id") % 5
    labelled = (
        F.when(k == 0, F.concat(F.lit("Step 1: TASK progress - "), t))
        .when(k == 1, F.concat(F.lit("task progress:"), t))
        .when(k == 2, F.concat(F.lit("step1 task progress: "), F.lit("task progress: "), t))
        .when(k == 3, F.concat(F.lit("STEP 12. "), t))
        .otherwise(F.concat(F.lit("note step 1: "), t))
    )
    return H.table(spark, d, "documents").select("doc_id", X.strip_leading_label(labelled, "task progress").alias("text"))


def _frame_objects(spark, d):
    f = H.frames(spark, d)
    return f.select("event_id", "objects", F.posexplode("objects").alias("idx", "o")).withColumn("b", B.normalize_bbox(C("o.bbox")))


@query(["boxes"], "SELECT event_id, idx, x1, y1, x2, y2 FROM boxes")
def normalize_bbox(spark, d):
    return _frame_objects(spark, d).select("event_id", "idx", *[C("b")[i].alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))])


@query(["boxes"], "SELECT event_id, idx, cx::DOUBLE AS cx, cy::DOUBLE AS cy FROM boxes")
def bbox_center(spark, d):
    return _frame_objects(spark, d).select("event_id", "idx", B.bbox_center(C("b")).alias("c")).select("event_id", "idx", "c.*")


@query(["phrases"], "SELECT event_id, idx, relation FROM phrases")
def bbox_relation(spark, d):
    first = B.normalize_bbox(F.get("objects", F.lit(0))["bbox"])
    return _frame_objects(spark, d).select("event_id", "idx", B.bbox_relation(first, C("b")).alias("relation"))


@query(["zones"], "SELECT event_id, idx, zone FROM zones")
def bbox_screen_zone(spark, d):
    return _frame_objects(spark, d).select("event_id", "idx", B.bbox_zone(C("b")).alias("zone"))


@query(["summaries"], "SELECT task_idx, frame_pos, summary FROM summaries")
def format_annotated_objects(spark, d):
    return H.frames(spark, d).select("task_idx", "frame_pos", B.format_annotated_objects(C("objects")).alias("summary"))


@query(["summaries"], "SELECT task_idx, frame_pos, names FROM summaries")
def format_object_names(spark, d):
    return H.frames(spark, d).select("task_idx", "frame_pos", B.format_object_names(C("objects")).alias("names"))


@query(
    ["chats"],
    r"SELECT record_idx, CASE WHEN memory IS NULL OR record_idx % 6 = 1 THEN 'None' ELSE memory END AS memory FROM chats",
)
def history_memory_text(spark, d):
    raw = F.when(C("record_idx") % 6 == 1, " \t ").otherwise(F.replace(C("memory"), F.lit(" "), F.lit(" \n ")))
    return H.chat(spark, d).select("record_idx", A.history_memory_text(raw).alias("memory"))


@query(
    None,
    "SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'STOP' WHEN 1 THEN 'MOVE_FORWARD' WHEN 2 THEN 'TURN_LEFT' WHEN 3 THEN 'TURN_RIGHT' ELSE 'UNKNOWN_' || (event_id % 6) END AS action FROM events",
)
def action_decode(spark, d):
    return H.table(spark, d, "events").select("event_id", A.decode_action(C("event_id") % 6).alias("action"))


@query(
    None,
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'stop' WHEN 1 THEN 'move forward' WHEN 2 THEN 'turn left' WHEN 3 THEN 'turn right' ELSE 'unknown 4' END AS phrase,
    CASE event_id % 5 WHEN 0 THEN 'stop|stop' WHEN 1 THEN 'move_forward|move forward' WHEN 2 THEN 'turn_left|turn left' WHEN 3 THEN 'turn_right|turn right' ELSE 'unknown_4|unknown 4' END AS mentions FROM events""",
)
def action_phrase(spark, d):
    action = A.decode_action(C("event_id") % 5)
    return H.table(spark, d, "events").select(
        "event_id", A.action_phrase(action).alias("phrase"), F.array_join(A.action_mentions(action), "|").alias("mentions")
    )


@query(
    ["crops"],
    "SELECT episode_id, scene FROM crops",
)
def scene_stem(spark, d):
    return H.trajectories(spark, d).select("episode_id", X.scene_stem(C("scene_id")).alias("scene"))


@query(
    None,
    """SELECT event_id, printf('ep%05d.mp4', event_id * 37) AS video, printf('ep%05d_frame%04d.jpg', event_id * 37, event_id % 12000) AS image,
    printf('ep%05d_frame%04d.md', event_id * 37, event_id % 12000) AS page, printf('ep%05d_%s', event_id * 37, event_type) AS crop FROM events""",
)
def artifact_names(spark, d):
    i, n = C("event_id") * 37, C("event_id") % 12000
    return H.table(spark, d, "events").select(
        "event_id",
        X.video_name(i).alias("video"),
        X.frame_name(i, n).alias("image"),
        X.frame_name(i, n, "md").alias("page"),
        X.crop_name(i, C("event_type")).alias("crop"),
    )


@query(
    None,
    r"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '[]' WHEN 1 THEN '[''' || lang || ''', ''' || source || ''']'
      WHEN 2 THEN '["' || lang || '''s", ''a\''b"c'']' ELSE '[''x\\y\n'', ''' || source || ''']' END AS shown FROM documents""",
)
def list_repr(spark, d):
    k = C("doc_id") % 4
    items = (
        F.when(k == 0, F.array().cast("array<string>"))
        .when(k == 1, F.array("lang", "source"))
        .when(k == 2, F.array(F.concat("lang", F.lit("'s")), F.lit("a'b\"c")))
        .otherwise(F.array(F.lit("x\\y\n"), C("source")))
    )
    return H.table(spark, d, "documents").select("doc_id", X.list_repr(items).alias("shown"))


@query(
    None,
    """SELECT doc_id, CASE doc_id % 4 WHEN 3 THEN 'no json ' || doc_id ELSE '{"a": "' || doc_id || '"}' END AS cut FROM documents""",
)
def extract_json_object(spark, d):
    body = F.concat(F.lit('{"a": "'), C("doc_id").cast("string"), F.lit('"}'))
    k = C("doc_id") % 4
    raw = (
        F.when(k == 0, F.concat(F.lit("```json\r\n"), body, F.lit("\r\n```  ")))
        .when(k == 1, F.concat(F.lit("Sure: "), body, F.lit(" done")))
        .when(k == 2, body)
        .otherwise(F.concat(F.lit(" \n no json "), C("doc_id").cast("string"), F.lit("  ")))
    )
    return H.table(spark, d, "documents").select("doc_id", X.extract_json_object(raw).alias("cut"))


@query(
    None,
    """SELECT event_id, '[' || greatest(0, least(1000, round_even((event_id % 640) * 1000.0::DOUBLE / 640, 0)))::INT || ', ' || greatest(0, least(1000, round_even((event_id % 426) * 1000.0::DOUBLE / 426, 0)))::INT
     || ', ' || greatest(0, least(1000, round_even((event_id % 640 + 50) * 1000.0::DOUBLE / 640, 0)))::INT || ', ' || greatest(0, least(1000, round_even((event_id % 426 + 30) * 1000.0::DOUBLE / 426, 0)))::INT || ']' AS box FROM events""",
)
def doc_pixel_bbox(spark, d):
    x, y = C("event_id") % 640, C("event_id") % 426
    box = B.pixel_bbox(F.array(x, y, x + 50, y + 30), F.lit(640), F.lit(426))
    return H.table(spark, d, "events").select("event_id", X.int_list_repr(box).alias("box"))


# --- frames to traces --------------------------------------------------------------------


def _eligible(spark, d, ids=None):
    return traces.eligible_frames(H.frames(spark, d), H.truth(spark, d), ids)


@query(
    ["frames"],
    "SELECT episode_id, count(*) AS frames, 'listed' AS kind FROM frames WHERE episode_id IN (1, 2, 5) GROUP BY episode_id UNION ALL SELECT episode_id, count(*), 'all' FROM frames GROUP BY episode_id",
)
def filter_episodes_strict(spark, d):
    f = H.frames(spark, d)
    cases = {"listed": [1, 2, 5], "all": None, "empty": []}
    parts = [
        traces.only_episodes(f, ids).groupBy("episode_id").agg(F.count(F.lit(1)).alias("frames")).withColumn("kind", F.lit(k))
        for k, ids in cases.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    ["frames"],
    "SELECT episode_id, count(*) AS frames, k AS kind FROM frames, (SELECT unnest(['all', 'empty']) AS k) GROUP BY episode_id, k UNION ALL SELECT episode_id, count(*), 'listed' FROM frames WHERE episode_id IN (1, 2, 5) GROUP BY episode_id",
)
def filter_episodes_lenient(spark, d):
    f = H.frames(spark, d)
    cases = {"listed": [1, 2, 5], "all": None, "empty": []}
    parts = [
        traces.only_episodes(f, ids, empty_is_all=True).groupBy("episode_id").agg(F.count(F.lit(1)).alias("frames")).withColumn("kind", F.lit(k))
        for k, ids in cases.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    ["frames", "truth"],
    "SELECT DISTINCT f.episode_id, len(actions) AS n_actions FROM frames f JOIN truth t ON f.episode_id::VARCHAR = t.episode_key",
)
def join_ground_truth(spark, d):
    ids = H.frames(spark, d).select("episode_id").distinct()
    return traces.with_truth(ids, H.truth(spark, d)).select("episode_id", F.size("actions").cast("long").alias("n_actions"))


@query(["frames", "truth"], "SELECT DISTINCT episode_id FROM frames WHERE episode_id::VARCHAR NOT IN (SELECT episode_key FROM truth)")
def missing_ground_truth(spark, d):
    return traces.without_truth(H.frames(spark, d).select("episode_id").distinct(), H.truth(spark, d))


@query(["eligible"], "SELECT task_idx, frame_pos, frame, subtask, action FROM eligible")
def eligible_frames(spark, d):
    return _eligible(spark, d).select("task_idx", "frame_pos", "frame", "subtask", "action")


@query(
    ["frames", "truth"],
    "SELECT f.task_idx, f.frame, actions[frame] AS code FROM frames f JOIN truth t ON f.episode_id::VARCHAR = t.episode_key",
)
def join_frame_action(spark, d):
    both = traces.with_truth(H.frames(spark, d), H.truth(spark, d))
    return both.select("task_idx", "frame", F.get("actions", C("frame") - 1).alias("code"))


@query(["seen"], "SELECT task_idx, array_to_string(subtasks, '|') AS subtasks FROM seen")
def agg_distinct_first_seen(spark, d):
    found = traces.distinct_subtasks(H.frames(spark, d))
    return found.select("task_idx", F.array_join("subtasks", "|").alias("subtasks"))


@query(["eligible"], "SELECT task_idx, frame_pos, completed FROM eligible")
def win_completed_index(spark, d):
    return _eligible(spark, d).select("task_idx", "frame_pos", "completed")


@query(
    ["worded"],
    """SELECT task_idx, frame_pos, CASE WHEN event_id % 4 = 0 THEN CASE WHEN completed < 3 THEN subtasks[completed + 1] ELSE instruction END ELSE subtask END AS current, done_text AS completed_list FROM worded""",
)
def task_state(spark, d):
    e = _eligible(spark, d)
    own = F.when(C("event_id") % 4 != 0, C("subtask"))
    short = F.slice("subtasks", 1, 3)
    return e.select(
        "task_idx",
        "frame_pos",
        A.current_subtask(own, short, C("completed"), C("instruction")).alias("current"),
        A.completed_subtasks(C("subtasks"), C("completed")).alias("completed_list"),
    )


@query(
    ["worded"],
    "SELECT task_idx, frame_pos, CASE WHEN event_id % 5 = 0 THEN 'kept memory' ELSE facts END AS anchor FROM worded",
)
def memory_anchor(spark, d):
    preferred = F.when(C("event_id") % 5 == 0, " kept \n memory ").when(C("event_id") % 5 == 1, "")
    anchor = A.memory_anchor(C("subtask"), C("objects"), C("action"), preferred)
    return _eligible(spark, d).select("task_idx", "frame_pos", anchor.alias("anchor"))


@query(
    ["eligible"],
    "SELECT task_idx, frame_pos, CASE WHEN episode_id % 3 > 0 THEN 'f/' || printf('ep%05d_frame%04d.jpg', episode_id, frame) END AS image_path FROM eligible",
)
def image_reference_left(spark, d):
    e = _eligible(spark, d)
    videos = e.select(H.renamed("episode_id", 3, 0))
    return traces.with_image(e, videos, "f/").select("task_idx", "frame_pos", "image_path")


_PROMPT = """SELECT task_idx, frame_pos, md5(prompt) AS prompt_md5, length(prompt) AS n FROM (
  SELECT *, CASE WHEN n_objects > 0 THEN {seen} ELSE {unseen} END AS prompt FROM {source})"""


def _sql_text(template: str, **columns: str) -> str:
    import string

    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append("'" + literal.replace("'", "''") + "'")
        if name:
            parts.append(columns[name])
    return " || ".join(parts)


def _prompt_sql(source: str, memory: str) -> str:
    from waymark.functions import fixed_texts as T

    columns = {
        "global_instruction": "instruction",
        "global_subtasks_list": "all_text",
        "completed_subtasks": "done_text",
        "completed_index": "completed",
        "current_subtask": "subtask",
        "script_memory": memory,
        "next_action": "action",
        "target_object_name": "first_raw",
        "bbox_norm": "first_box",
        "annotated_objects": "summary",
    }
    return _PROMPT.format(
        seen=_sql_text(T.PROMPT_VISIBLE, **columns), unseen=_sql_text(T.PROMPT_UNSEEN, **columns), source=source
    )


def _prompt_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "task_idx", "frame_pos", F.md5(C("prompt").cast("binary")).alias("prompt_md5"), F.length("prompt").cast("long").alias("n")
    )


@query(["worded"], _prompt_sql("worded", "'None'"))
def build_prompt(spark, d):
    return _prompt_rows(traces.with_prompt(_eligible(spark, d).withColumn("memory", F.lit(None).cast("string"))))


def _template_sql() -> str:
    from waymark.functions import fixed_texts as T

    about = {"step": "(completed + 1)", "subtask": "subtask", "phrase": "phrase"}
    cases = " ".join(f"WHEN '{k}' THEN {_sql_text(v, **about)}" for k, v in T.TRUTH_STEP3.items())
    seen = f"{_sql_text(T.TRUTH_LAYOUT)} || CASE action {cases} ELSE {_sql_text(T.TRUTH_STEP3_OTHER, **about)} END"
    unseen = f"CASE action WHEN 'STOP' THEN {_sql_text(T.TRUTH_STEP3_UNSEEN_STOP)} ELSE {_sql_text(T.TRUTH_STEP3_UNSEEN, **about)} END"
    clause = f"CASE WHEN event_id % 2 = 0 THEN {_sql_text(T.TRUTH_NO_MEMORY)} ELSE {_sql_text(T.TRUTH_MEMORY, memory='facts')} END"
    step1 = _sql_text(T.TRUTH_STEP1, clause=clause, done="completed", total="len(subtasks)", **about)
    step2 = f"CASE WHEN n_objects > 0 THEN {_sql_text(T.TRUTH_STEP2, objects='summary')} ELSE {_sql_text(T.TRUTH_STEP2_UNSEEN)} END"
    return f"""SELECT task_idx, frame_pos, {step1} AS step1, {step2} AS step2,
      CASE WHEN n_objects > 0 THEN {seen} ELSE {unseen} END AS step3, {_sql_text(T.TRUTH_STEP4, **about)} AS step4 FROM worded"""


@query(["worded"], _template_sql())
def template_trace(spark, d):
    facts = A.memory_anchor(C("subtask"), C("objects"), C("action"), F.lit(None).cast("string"))
    memory = F.when(C("event_id") % 2 != 0, facts)
    steps = P.template_steps(C("subtask"), C("objects"), memory, C("instruction"), C("subtasks"), C("completed"), C("action"))
    return _eligible(spark, d).select("task_idx", "frame_pos", *[s.alias(f"step{i}") for i, s in enumerate(steps, 1)])


@query(
    ["eligible"],
    """SELECT task_idx, frame_pos, CASE event_id % 3 WHEN 0 THEN '{"repetition_penalty":1.01}' WHEN 1 THEN '{"repetition_penalty":1.01,"chat_template_kwargs":{"enable_thinking":true}}'
      ELSE '{"repetition_penalty":1.01,"chat_template_kwargs":{"enable_thinking":false}}' END AS served,
      CASE event_id % 3 WHEN 0 THEN '{}' WHEN 1 THEN '{"enable_thinking":true}' ELSE '{"enable_thinking":false}' END AS hosted,
      CASE WHEN event_id % 2 = 0 THEN '[{"type":"text","text":"p"}]' ELSE '[{"type":"image_path","image_path":"i.jpg"},{"type":"text","text":"p"}]' END AS content FROM eligible""",
)
def request_rows(spark, d):
    mode = F.when(C("event_id") % 3 == 0, "auto").when(C("event_id") % 3 == 1, "on").otherwise("off")
    image = F.when(C("event_id") % 2 != 0, "i.jpg")
    messages = P.request_messages(F.lit("p"), image)
    return _eligible(spark, d).select(
        "task_idx",
        "frame_pos",
        P.extra_parameters(mode).alias("served"),
        P.extra_parameters(mode, hosted=True).alias("hosted"),
        F.get_json_object(messages, "$[1].content").alias("content"),
    )


# --- validation and outcomes -------------------------------------------------------------


def _validated(spark, d):
    return traces.validate_responses(_eligible(spark, d), H.responses(spark, d))


_CODE = "task_idx, frame_pos, attempt"


@query(["attempts"], f"SELECT {_CODE}, reason FROM attempts")
def trace_first_error(spark, d):
    return _validated(spark, d).select(*_CODE.split(", "), "reason")


@query(
    ["attempts"],
    f"SELECT {_CODE}, CASE WHEN reason LIKE '%:%' OR reason IN ('json', 'object', 'empty', 'extra') THEN reason WHEN kind = 17 THEN 'empty' END AS json_error FROM attempts",
)
def trace_schema_check(spark, d):
    return _validated(spark, d).select(*_CODE.split(", "), "trace.json_error")


@query(
    ["attempts"],
    f"SELECT {_CODE}, reason FROM attempts WHERE kind IN (0, 1, 2, 3, 9, 10, 11, 12, 13) AND (reason IS NULL OR reason IN ('unseen', 'visible', 'bbox', 'label'))",
)
def trace_visibility_check(spark, d):
    v = _validated(spark, d).where("trace.json_error is null and reason <=> reason")
    error = V.visibility_error(C("trace.step2_spatial_perception"), C("objects"))
    rows = v.withColumn("seen", error)
    return rows.where("status = 'ok' and (seen is not null or reason is null)").select(*_CODE.split(", "), C("seen").alias("reason"))


@query(
    ["attempts"],
    f"SELECT {_CODE}, CASE WHEN kind IN (11, 12) THEN reason END AS reason FROM attempts WHERE kind IN (0, 1, 2, 3, 9, 10, 11, 12, 13)",
)
def trace_action_check(spark, d):
    v = _validated(spark, d).where("status = 'ok' and trace.json_error is null")
    error = V.action_error(C("trace.step3_decision_logic"), C("trace.step4_memory_update"), C("action"))
    return v.select(*_CODE.split(", "), error.alias("reason"))


@query(
    None,
    "SELECT doc_id, CASE WHEN 4 * length(text) > 1600 THEN 'total' END AS reason FROM documents",
)
def trace_total_length(spark, d):
    return H.table(spark, d, "documents").select("doc_id", V.total_error([C("text")] * 4).alias("reason"))


@query(
    ["outcomes"],
    "SELECT task_idx, frame_pos, attempt FROM outcomes WHERE outcome = 'trace'",
)
def win_first_valid_attempt(spark, d):
    return traces.accepted_attempts(_validated(spark, d)).select("task_idx", "frame_pos", "attempt")


@query(["attempts"], "SELECT task_idx, frame_pos, attempt, reason FROM attempts")
def src_responses(spark, d):
    path = scratch_path(spark, "responses")
    H.responses(spark, d).write.parquet(path)
    checked = traces.validate_responses(_eligible(spark, d), readers.read_responses(spark, path))
    return checked.select("task_idx", "frame_pos", "attempt", "reason")


@query(["outcomes"], "SELECT task_idx, frame_pos, outcome, attempt FROM outcomes")
def outcome_policy(spark, d):
    return traces.choose_outcome(_validated(spark, d)).select("task_idx", "frame_pos", "outcome", "attempt")


def _content(spark, d):
    return H.responses(spark, d).selectExpr("task_idx", "frame_pos", "attempt", "content")


def _error_sql(reason: str) -> str:
    from waymark.functions import fixed_texts as T

    cases = " ".join(
        f"WHEN '{k}' THEN {_sql_text(v, field=f'split_part({reason}, {chr(39)}:{chr(39)}, 2)')}" for k, v in T.ERRORS.items()
    )
    return f"CASE split_part({reason}, ':', 1) {cases} ELSE {reason} END"


def _retry_sql() -> str:
    from waymark.functions import fixed_texts as T

    error = f"""CASE reason WHEN 'json' THEN '(): Invalid JSON: EOF while parsing a value at line 1 column 5'
      WHEN 'extra' THEN '(''more'',): Extra inputs are not permitted' ELSE {_error_sql('reason')} END"""
    text = _sql_text(T.CORRECTION, error=f"({error})", action="action")
    return f"""SELECT {_CODE}, CASE WHEN trim(content) = '' THEN '{{}}' ELSE left(content, 4000) END AS answer, {text} AS request FROM (
      SELECT *, CASE kind WHEN 14 THEN '{{"a": ' WHEN 15 THEN ' ' WHEN 16 THEN '[1]' ELSE
          CASE WHEN kind = 6 THEN '{{"step1_task_progress": 5' ELSE '{{"step1_task_progress": "' || CASE WHEN kind = 8 THEN repeat('x', 401) ELSE 'Step 1: On track.' END || '"' END
          || ', "step2_spatial_perception": "' || CASE WHEN kind = 7 THEN '  ' WHEN kind = 9 AND n_objects = 0 THEN 'I see a wall.'
            WHEN kind = 9 OR n_objects = 0 THEN 'The object is not visible.' WHEN kind = 10 THEN 'I see ' || labels ELSE 'I see ' || boxed END
          || CASE WHEN kind = 4 THEN '", "step3_other": "x' ELSE '", "step3_decision_logic": "' || CASE WHEN kind = 11 THEN 'It fits.' ELSE 'So ' || phrase || ' fits.' END END
          || '", "step4_memory_update": "Now ' || phrase || ' at ' || event_id || CASE WHEN kind = 12 THEN '. Then on.' ELSE '.' END || '"'
          || CASE WHEN kind = 5 THEN ', "more": "x"' ELSE '' END || '}}' END AS content
      FROM attempts WHERE reason <> 'transport')"""


@query(["attempts"], _retry_sql())
def retry_feedback(spark, d):
    bad = _validated(spark, d).where("reason is not null and reason <> 'transport'")
    bad = bad.withColumn("cause", P.error_cause(C("reason"), C("content")))
    request = P.retry_request(C("reason"), C("action"), C("cause"))
    return bad.select(*_CODE.split(", "), P.retry_answer(C("content")).alias("answer"), request.alias("request"))


@query(
    ["attempts"],
    f"""SELECT a.task_idx, a.frame_pos, a.attempt, count(b.attempt) AS earlier,
      coalesce(string_agg({_error_sql('b.reason')}, '|' ORDER BY b.attempt), '') AS reasons
    FROM attempts a LEFT JOIN attempts b ON a.task_idx = b.task_idx AND a.frame_pos = b.frame_pos AND b.attempt < a.attempt AND b.reason <> 'transport'
    GROUP BY ALL""",
)
def win_retry_history(spark, d):
    reason = lambda m: P.error_text(m["reason"])
    rows = traces.retry_history(_validated(spark, d))
    return rows.select(
        *_CODE.split(", "),
        F.size("feedback").cast("long").alias("earlier"),
        F.array_join(F.transform("feedback", reason), "|").alias("reasons"),
    )


def _chain(spark, d):
    return traces.memory_chain(_eligible(spark, d), traces.choose_outcome(_validated(spark, d)))


@query(["chain"], "SELECT task_idx, frame_pos, memory FROM chain")
def win_memory_chain(spark, d):
    return _chain(spark, d).select("task_idx", "frame_pos", "memory")


@query(["chain"], "SELECT task_idx, frame_pos, history_source_frame FROM chain")
def win_history_source(spark, d):
    return _chain(spark, d).select("task_idx", "frame_pos", "history_source_frame")


@query(["chain"], "SELECT task_idx, frame_pos, outcome, anchor FROM chain WHERE outcome <> 'trace'")
def outcome_skip_keeps_anchor(spark, d):
    return _chain(spark, d).where("outcome <> 'trace'").select("task_idx", "frame_pos", "outcome", "anchor")


_STEP2 = "CASE WHEN n_objects > 0 THEN 'I see ' || boxed ELSE 'The object is not visible.' END"


def _answer_sql() -> str:
    from waymark.functions import fixed_texts as T

    return _sql_text(
        T.ANSWER,
        step1="'On track.'",
        step2=_STEP2,
        step3="'So ' || phrase || ' fits.'",
        step4="'Now ' || phrase || ' at ' || event_id || '.'",
        action="action",
    )


@query(["chain"], f"SELECT task_idx, frame_pos, {_answer_sql()} AS answer FROM chain WHERE outcome = 'trace'")
def render_trace(spark, d):
    from waymark.functions import fixed_texts as T

    rows = _chain(spark, d).where("outcome = 'trace'")
    return rows.select("task_idx", "frame_pos", P.render_trace([C("trace")[s] for s in T.STEPS], C("action")).alias("answer"))


@query(
    ["chain"],
    f"""SELECT task_idx, frame_pos, episode_id::VARCHAR AS episode_id, frame::VARCHAR AS frame, coalesce(memory, 'None') AS memory,
      history_source_frame::VARCHAR AS source, {_answer_sql()} AS answer, 'user' AS first_role FROM chain WHERE outcome = 'trace'""",
)
def chat_jsonl_lines(spark, d):
    rows = traces.chat_records(traces.with_prompt(_chain(spark, d)))
    got = lambda path: F.get_json_object("line", path)
    return rows.select(
        "task_idx",
        "frame_pos",
        got("$.episode_id").alias("episode_id"),
        got("$.frame").alias("frame"),
        got("$.input_state.historical_trajectory_memory").alias("memory"),
        got("$.input_state.history_source_frame").alias("source"),
        got("$.messages[1].content").alias("answer"),
        got("$.messages[0].role").alias("first_role"),
    )


def _walk_sql() -> str:
    from waymark.functions import fixed_texts as T

    about = {"step": "(completed + 1)", "subtask": "subtask", "phrase": "phrase"}
    cases = " ".join(f"WHEN '{k}' THEN {_sql_text(v, **about)}" for k, v in T.TRUTH_STEP3.items())
    seen = f"{_sql_text(T.TRUTH_LAYOUT)} || CASE action {cases} ELSE {_sql_text(T.TRUTH_STEP3_OTHER, **about)} END"
    unseen = f"CASE action WHEN 'STOP' THEN {_sql_text(T.TRUTH_STEP3_UNSEEN_STOP)} ELSE {_sql_text(T.TRUTH_STEP3_UNSEEN, **about)} END"
    step2 = f"CASE WHEN n_objects > 0 THEN {_sql_text(T.TRUTH_STEP2, objects='summary')} ELSE {_sql_text(T.TRUTH_STEP2_UNSEEN)} END"

    def turn(memory: str) -> str:
        clause = f"CASE WHEN {memory} IS NULL THEN {_sql_text(T.TRUTH_NO_MEMORY)} ELSE {_sql_text(T.TRUTH_MEMORY, memory=memory)} END"
        step1 = _sql_text(T.TRUTH_STEP1, clause=clause, done="completed", total="len(subtasks)", **about)
        made = f"CASE WHEN outcome = 'invalid' AND fits AND length({step1}) <= 400 THEN 'template' ELSE outcome END"
        anchor = f"CASE {made} WHEN 'trace' THEN 'Now ' || phrase || ' at ' || event_id || '.' WHEN 'template' THEN step4 ELSE facts END"
        return f"{made} AS outcome, {memory} AS memory, {anchor} AS anchor"

    return f""", turned AS (
      SELECT w.*, o.outcome, row_number() OVER (PARTITION BY w.task_idx ORDER BY w.frame_pos) AS turn, {_sql_text(T.TRUTH_STEP4, **about)} AS step4,
        length({step2}) <= 400 AND length(CASE WHEN n_objects > 0 THEN {seen} ELSE {unseen} END) <= 400 AND length({_sql_text(T.TRUTH_STEP4, **about)}) <= 400
          AND NOT (n_objects > 0 AND action LIKE 'UNKNOWN%') AS fits
      FROM worded w JOIN outcomes o ON w.task_idx = o.task_idx AND w.frame_pos = o.frame_pos
    ), walk AS (
      SELECT task_idx, frame_pos, turn, {turn("NULL::VARCHAR")} FROM turned WHERE turn = 1
      UNION ALL SELECT t.task_idx, t.frame_pos, t.turn, {turn("before")} FROM (
        SELECT t.*, w.anchor AS before FROM walk w JOIN turned t ON t.task_idx = w.task_idx AND t.turn = w.turn + 1) t
    ) SELECT task_idx, frame_pos, outcome, memory, anchor FROM walk"""


@query(["worded", "outcomes"], _walk_sql())
def outcome_template_policy(spark, d):
    walked = chain.replay(_eligible(spark, d), H.responses(spark, d), "template")
    return walked.select("task_idx", "frame_pos", "outcome", "memory", "anchor")


def recorded_answer(prompt, notes, attempt, frame):
    """A responder that says what was recorded for this attempt."""
    for said in frame["said"] or []:
        if said["attempt"] == attempt:
            return said["status"], said["content"]
    return "transport_error", None


@query(
    ["chain"],
    "SELECT task_idx, frame_pos, outcome, memory, history_source_frame, anchor FROM chain",
)
def generate_chain_udf(spark, d):
    """Live: the answer to an attempt is looked up in what the frame carries of the recording."""
    said = F.sort_array(F.collect_list(F.struct("attempt", "status", "content")))
    said = H.responses(spark, d).groupBy(*traces.FRAME).agg(said.alias("said"))
    asked = _eligible(spark, d).join(said, traces.FRAME, "left")
    walked = chain.generate_chain(asked, recorded_answer)
    return walked.select("task_idx", "frame_pos", "outcome", "memory", "history_source_frame", "anchor")


@query(
    ["eligible"],
    """SELECT task_idx, frame_pos, coalesce(string_agg('Step ' || frame || ': Executed ' || action || '.', ' ') OVER w, '') AS log FROM eligible
    WINDOW w AS (PARTITION BY task_idx ORDER BY frame_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def doc_action_log(spark, d):
    return traces.action_log(_eligible(spark, d)).select("task_idx", "frame_pos", "log")


@query(
    ["frames"],
    """SELECT thinking_mode, response_format, count(*) AS answers, count(*) FILTER (WHERE kind = 17) AS empty, count(*) FILTER (WHERE kind IN (14, 15)) AS truncated,
      0::BIGINT AS truncated_empty, avg(CASE WHEN kind % 2 = 0 THEN event_id % 50 ELSE 0 END) AS mean_reasoning
    FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'on' ELSE 'off' END AS thinking_mode, CASE WHEN kind % 3 = 0 THEN 'json_object' ELSE 'text' END AS response_format
      FROM (SELECT *, (event_id + attempt * 5) % 18 AS kind FROM (SELECT *, unnest(range(1, 2 + event_id % 3)) AS attempt FROM frames)))
    GROUP BY thinking_mode, response_format""",
)
def doc_response_diagnosis(spark, d):
    return traces.response_diagnosis(H.responses(spark, d))


# --- documents ---------------------------------------------------------------------------


@query(
    ["chats"],
    """SELECT row_number() OVER (ORDER BY record_idx) - 1 AS record_idx, episode_id, frame::BIGINT AS frame, memory, history_source_frame,
      image_path, prompt, answer FROM chats""",
)
def src_chat_jsonl(spark, d):
    path = scratch_path(spark, "chat")
    H.chat_lines(spark, d).write.text(path)
    told = readers.read_chat(spark, path).withColumn("c", documents.first_contents(C("messages")))
    return told.select("record_idx", "episode_id", "frame", "memory", "history_source_frame", "c.image_path", "c.prompt", "c.answer")


@query(
    None,
    r"SELECT count(*) AS kept FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_replace(line, '\s+', '', 'g') <> ''",
)
def src_chat_nonblank(spark, d):
    lines = H.table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return readers.nonblank_lines(lines).agg(F.count(F.lit(1)).alias("kept"))


@query(["chats"], "SELECT record_idx, image_path, prompt, answer FROM chats")
def first_role_content(spark, d):
    told = H.chat(spark, d).select("record_idx", documents.first_contents(C("messages")).alias("c"))
    return told.select("record_idx", "c.image_path", "c.prompt", "c.answer")


_PAGES = r"""SELECT record_idx, printf('ep%05d_frame%04d.md', episode_id, frame) AS file,
      '# Episode ' || episode_id || ' Frame ' || frame || chr(10) || chr(10) || '- Episode ID: ' || episode_id || chr(10) || '- Frame: ' || frame || chr(10)
      || coalesce('- Image Path: `' || image_path || '`' || chr(10), '') || coalesce('- Historical Memory Input: "' || memory || '"' || chr(10), '')
      || coalesce('- History Source Frame: ' || history_source_frame || chr(10), '') || chr(10) || '## Assistant Output' || chr(10) || chr(10)
      || CASE WHEN regexp_replace(answer, '\s+$', '') = '' AND prompt IS NULL THEN '' ELSE regexp_replace(answer, '\s+$', '') || chr(10) END
      || coalesce(chr(10) || '## User Prompt' || chr(10) || chr(10) || '```text' || chr(10) || regexp_replace(prompt, '\s+$', '') || chr(10) || '```' || chr(10), '') AS body
    FROM chats"""


@query(["chats"], _PAGES)
def frame_markdown(spark, d):
    return documents.chat_to_markdown(H.chat(spark, d), include_prompt=True)


@query(["chats"], f"SELECT file, arg_max(body, record_idx) AS body FROM ({_PAGES}) GROUP BY file")
def sink_markdown_files(spark, d):
    path = scratch_path(spark, "pages")
    sinks.write_files(documents.chat_to_markdown(H.chat(spark, d), include_prompt=True), path)
    pages = spark.read.text(path, wholetext=True)
    return pages.select(F.regexp_extract("_metadata.file_path", "([^/]*)$", 1).alias("file"), C("value").alias("body"))


@query(
    ["chats"],
    """SELECT 0::BIGINT AS position, '# Frame Index' AS line UNION ALL SELECT 1, '' UNION ALL SELECT 2, '- Total Frames: ' || count(*) FROM chats UNION ALL SELECT 3, ''
    UNION ALL SELECT record_idx + 4, '- [Episode ' || episode_id || ' Frame ' || frame || '](' || printf('ep%05d_frame%04d.md', episode_id, frame) || ')' FROM chats""",
)
def markdown_index(spark, d):
    return documents.markdown_index(H.chat(spark, d))


# --- spatial -----------------------------------------------------------------------------


def _padding():
    return G.padding_defaults({"py": F.lit(2.5)}, F.lit(3.0))


def _boxes(spark, d):
    return spatial.padded_boxes(H.trajectories(spark, d), _padding())


@query(["vertices"], "SELECT vertex_id, x AS mx, -z AS my, y AS mz, x AS wx, y AS wy, z AS wz FROM vertices")
def axis_roundtrip(spark, d):
    mesh = G.to_mesh_axes(C("x"), C("y"), C("z"))
    world = G.to_world_axes(*mesh)
    named = [c.alias(n) for c, n in zip([*mesh, *world], ("mx", "my", "mz", "wx", "wy", "wz"))]
    return H.scenes(spark, d).select("vertex_id", *named)


@query(
    ["places"],
    "SELECT DISTINCT episode_id, '3.0,3.0,' || CASE WHEN episode_id % 20 = 0 THEN '3.0' ELSE '2.5' END || ',3.0,3.0,3.0' AS padding FROM places",
)
def padding_defaults(spark, d):
    pad = G.padding_defaults({"py": F.when(C("episode_id") % 20 != 0, F.lit(2.5))}, F.lit(3.0))
    return H.trajectories(spark, d).select("episode_id", F.array_join(pad.cast("array<string>"), ",").alias("padding"))


_ROUND = ", ".join(f"round({s}_{a}, 6) AS {s}_{a}" for s in ("low", "high") for a in "xyz")


@query(["crops"], f"SELECT episode_id, {_ROUND} FROM crops")
def agg_padded_bbox(spark, d):
    return _boxes(spark, d).select(
        "episode_id", *[F.round(f"{s}_{a}", 6).alias(f"{s}_{a}") for s in ("low", "high") for a in "xyz"]
    )


@query(["crops"], "SELECT scene, count(*) AS episodes, string_agg(episode_id, ',' ORDER BY episode_id) AS ids FROM crops GROUP BY scene")
def agg_scene_groups(spark, d):
    found = spatial.scene_groups(H.trajectories(spark, d))
    return found.select("scene", "episodes", F.array_join(C("ids").cast("array<string>"), ",").alias("ids"))


@query(
    ["crops"],
    """SELECT scene, chunk, count(*) AS episodes, string_agg(episode_id, ',' ORDER BY episode_id) AS ids
    FROM (SELECT scene, episode_id, (row_number() OVER (PARTITION BY scene ORDER BY episode_id) - 1) // 16 AS chunk FROM crops) GROUP BY scene, chunk""",
)
def agg_scene_chunks(spark, d):
    found = spatial.scene_chunks(H.trajectories(spark, d), 16)
    return found.select("scene", "chunk", "episodes", F.array_join(C("ids").cast("array<string>"), ",").alias("ids"))


def _kept(spark, d):
    return spatial.crop_vertices(H.scenes(spark, d), _boxes(spark, d))


@query(["kept"], "SELECT episode_id, scene, vertex_id FROM kept")
def crop_vertices(spark, d):
    return _kept(spark, d).select("episode_id", "scene", "vertex_id")


@query(["kept_faces"], "SELECT episode_id, scene, face_id FROM kept_faces")
def crop_faces(spark, d):
    return _kept_faces(spark, d)


def _kept_faces(spark, d):
    hulls = spatial.face_hulls(H.scene_faces(spark, d), H.scenes(spark, d))
    return spatial.crop_hulls(hulls, _boxes(spark, d))


def _counts(spark, d):
    return spatial.crop_counts(_kept(spark, d), _kept_faces(spark, d))


_COUNTS = """SELECT k.episode_id, num_vertices, coalesce(num_faces, 0) AS num_faces FROM (SELECT episode_id, count(*) AS num_vertices FROM kept GROUP BY 1) k
  LEFT JOIN (SELECT episode_id, count(*) AS num_faces FROM kept_faces GROUP BY 1) f ON k.episode_id = f.episode_id"""


@query(["kept", "kept_faces"], _COUNTS)
def agg_crop_counts(spark, d):
    return _counts(spark, d)


@query(["crops", "kept"], "SELECT c.episode_id FROM crops c WHERE EXISTS (SELECT 1 FROM kept k WHERE k.episode_id = c.episode_id)")
def crop_nonempty(spark, d):
    return _counts(spark, d).select("episode_id")


@query(
    ["crops", "kept", "kept_faces"],
    f"""SELECT printf('ep%05d_%s.json', c.episode_id, scene) AS file, c.episode_id::VARCHAR AS episode_id, trajectory_id::VARCHAR AS trajectory_id,
      num_vertices::VARCHAR AS num_vertices, num_faces::VARCHAR AS num_faces, '[3.0,3.0,2.5,3.0,3.0,3.0]' AS padding
    FROM crops c JOIN ({_COUNTS}) n ON c.episode_id = n.episode_id""",
)
def crop_metadata(spark, d):
    rows = spatial.crop_metadata(H.trajectories(spark, d), _boxes(spark, d), _counts(spark, d))
    got = lambda name: F.get_json_object("json", f"$.{name}").alias(name)
    return rows.select(
        "file", *map(got, ("episode_id", "trajectory_id", "num_vertices", "num_faces")),
        F.get_json_object("json", "$.padding_m").alias("padding"),
    )


def _poses(spark, d):
    """Each episode's three places as poses, turned about the upright axis."""
    t = H.trajectories(spark, d).select("episode_id", F.posexplode("locations").alias("frame", "p"))
    half = F.radians((C("episode_id") % 24) * 15.0) / 2
    return t.select(
        "episode_id",
        (C("frame") + 1).alias("frame"),
        C("p")[0].alias("px"), C("p")[1].alias("py"), C("p")[2].alias("pz"),
        F.lit(0.0).alias("qx"), F.sin(half).alias("qy"), F.lit(0.0).alias("qz"), F.cos(half).alias("qw"),
    )


def _labels(spark, d):
    """Two boxes per episode, one a few metres behind and one around its first place."""
    t = H.trajectories(spark, d)

    def corner(shift: float, i: int):
        p = F.get("locations", F.lit(0))
        sx, sy, sz = (1 if i & b else -1 for b in (1, 2, 4))
        return F.array(p[0] + 0.5 * sx + shift, -(p[2] + 0.5 * sz - 3 * shift), p[1] + 0.5 * sy)

    def box(name: str, shift: float):
        return F.struct(F.lit(name).alias("name"), F.array(*[corner(shift, i) for i in range(8)]).alias("vertices"))

    return t.select("episode_id", F.array(box("closet", 1.0), box("closet", 0.0)).alias("objects"))


_POSES = """SELECT episode_id, k // 3 AS frame, px, py, pz, sin(radians((episode_id % 24) * 15.0::DOUBLE) / 2) AS qy, cos(radians((episode_id % 24) * 15.0::DOUBLE) / 2) AS qw FROM places"""
_CORNERS = """SELECT episode_id, o AS object_idx, i AS vertex_idx, px + 0.5 * (CASE WHEN i & 1 > 0 THEN 1 ELSE -1 END) + s AS x,
  py + 0.5 * (CASE WHEN i & 2 > 0 THEN 1 ELSE -1 END) AS y, pz + 0.5 * (CASE WHEN i & 4 > 0 THEN 1 ELSE -1 END) - 3 * s AS z
  FROM places, (SELECT unnest([0, 1]) AS o, unnest([1.0::DOUBLE, 0.0::DOUBLE]) AS s), (SELECT unnest(range(8)) AS i) WHERE k = 3"""
_POINTS = f"""SELECT *, 320 / tan(radians(86.0::DOUBLE) / 2) * r / nullif(depth, 0) + 320 AS u, -213 / tan(radians(57.0::DOUBLE) / 2) * up / nullif(depth, 0) + 213 AS v FROM (
  SELECT p.episode_id, frame, object_idx, vertex_idx, (1 - 2 * qy * qy) * (x - px) - 2 * qw * qy * (z - pz) AS r, y - py AS up,
    -(2 * qw * qy * (x - px) + (1 - 2 * qy * qy) * (z - pz)) AS depth
  FROM ({_POSES}) p JOIN ({_CORNERS}) c ON p.episode_id = c.episode_id)"""
_BOXED = f"""SELECT episode_id, frame, object_idx, bool_and(depth > 0) AS front, trunc(greatest(0, least(639, min(u))))::INT AS x1, trunc(greatest(0, least(425, min(v))))::INT AS y1,
  trunc(greatest(0, least(639, max(u))))::INT AS x2, trunc(greatest(0, least(425, max(v))))::INT AS y2 FROM ({_POINTS}) GROUP BY ALL"""


@query(["places"], f"SELECT episode_id, object_idx, vertex_idx, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) + 0.0 AS z FROM ({_CORNERS})")
def src_labels_3d(spark, d):
    """Label files, one an episode, written and read back."""
    path, name = scratch_path(spark, "labels"), F.format_string("ep%05d_labels.json", "episode_id")
    shape = F.struct(F.lit("").alias("folder"), name.alias("filename"), F.lit("").alias("path"), "objects")
    sinks.write_json_files(_labels(spark, d).select(name.alias("file"), F.to_json(shape).alias("json")), path)
    points = spatial.label_points(readers.read_labels_3d(spark, path))
    return points.select("episode_id", "object_idx", "vertex_idx", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), (F.round("z", 6) + 0.0).alias("z"))


@query(["vertices", "faces"], "SELECT f.scene, face_id, v2, x, y, z FROM faces f JOIN vertices v ON f.scene = v.scene AND f.v2 = v.vertex_id")
def src_mesh(spark, d):
    path = scratch_path(spark, "mesh")
    H.scenes(spark, d).write.partitionBy("scene").parquet(f"{path}/vertices")
    H.scene_faces(spark, d).write.partitionBy("scene").parquet(f"{path}/faces")
    vertices, corners = readers.read_mesh(spark, f"{path}/vertices", f"{path}/faces")
    both = corners.join(vertices, (corners["scene"] == vertices["scene"]) & (corners["v2"] == vertices["vertex_id"]))
    return both.select(corners["scene"], "face_id", "v2", "x", "y", "z")


@query(["places"], f"SELECT p.episode_id, frame, object_idx, vertex_idx FROM ({_POSES}) p JOIN ({_CORNERS}) c ON p.episode_id = c.episode_id")
def pose_label_product(spark, d):
    both = _poses(spark, d).join(spatial.label_points(_labels(spark, d)), "episode_id")
    return both.select("episode_id", "frame", "object_idx", "vertex_idx")


@query(
    ["places"],
    f"""SELECT episode_id, frame, object_idx, vertex_idx, CASE WHEN abs(depth) > 0.001 THEN round(u, 3) END AS u,
      CASE WHEN abs(depth) > 0.001 THEN round(v, 3) END AS v, round(depth, 5) + 0.0 AS depth FROM ({_POINTS})""",
)
def project_points(spark, d):
    both = _poses(spark, d).join(spatial.label_points(_labels(spark, d)), "episode_id")
    at = G.project_point(
        tuple(map(C, "xyz")), tuple(map(C, ("px", "py", "pz"))), tuple(map(C, ("qw", "qx", "qy", "qz")))
    )
    rows = both.withColumn("at", at)
    # next to the camera's plane the last digits of a place are those of rounding errors
    ahead = F.abs("at.depth") > 0.001
    return rows.select(
        "episode_id", "frame", "object_idx", "vertex_idx",
        F.when(ahead, F.round("at.u", 3)).alias("u"), F.when(ahead, F.round("at.v", 3)).alias("v"),
        (F.round("at.depth", 5) + 0.0).alias("depth"),
    )


def _projected(spark, d):
    return spatial.project_labels(_poses(spark, d), spatial.label_points(_labels(spark, d)))


@query(["places"], f"SELECT episode_id, frame, object_idx, x1, y1, x2, y2 FROM ({_BOXED}) WHERE front")
def agg_projected_bbox(spark, d):
    both = _poses(spark, d).join(spatial.label_points(_labels(spark, d)), "episode_id")
    front = both.withColumn("depth", _depth()).groupBy("episode_id", "frame", "object_idx").agg(F.min("depth").alias("near"))
    rows = _projected(spark, d).join(front.where("near > 0"), ["episode_id", "frame", "object_idx"])
    return rows.select("episode_id", "frame", "object_idx", "x1", "y1", "x2", "y2")


def _depth():
    at = G.project_point(
        tuple(map(C, "xyz")), tuple(map(C, ("px", "py", "pz"))), tuple(map(C, ("qw", "qx", "qy", "qz")))
    )
    return at["depth"]


@query(["places"], f"SELECT episode_id, frame, object_idx, front AND x2 > x1 AND y2 > y1 AS visible FROM ({_BOXED})")
def visible_boxes(spark, d):
    found = spatial.visible_labels(_poses(spark, d), spatial.label_points(_labels(spark, d)))
    return found.select("episode_id", "frame", "object_idx", "visible")


@query(
    ["frames"],
    """SELECT task_idx, frame, coalesce(sum(CASE event_id % 5 WHEN 2 THEN 15.0::DOUBLE WHEN 3 THEN -15.0::DOUBLE ELSE 0.0::DOUBLE END) OVER (
      PARTITION BY task_idx ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS heading FROM frames""",
)
def win_heading(spark, d):
    rows = H.frames(spark, d).withColumn("action_code", (C("event_id") % 5).cast("int"))
    return spatial.headings(rows, ["task_idx"], "frame").select("task_idx", "frame", "heading")
