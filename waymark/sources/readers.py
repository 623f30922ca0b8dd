"""Readers of exports, instructions, ground truth, episodes, chats, labels and meshes.

Exports, ground truth and episodes are read split by split, however large a file is;
instructions and label files, which are small, one row a file.  A broken file fails loudly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.sources.json_parts import FILE, bare_path, read_parts
from waymark.sources.scratch import materialize

_BOX = "x:double,y:double,width:double,height:double"
TASK_TYPE = (
    "struct<data:map<string,string>,annotations:array<struct<result:array<struct<value:struct<"
    f"labels:array<string>,sequence:array<struct<frame:int,enabled:boolean,{_BOX}>>,duration:double>>>>>>"
)
EPISODE_TYPE = (
    "struct<episode_id:bigint,video_url:string,instruction:string,duration:int,frames:array<struct<"
    f"frame:int,subtask:string,objects:array<struct<label:string,bbox:struct<{_BOX}>>>>>>"
)
INSTRUCTION_TYPE = (
    "struct<episodes:array<struct<episode_id:bigint,trajectory_id:bigint,scene_id:string,"
    "start_position:array<double>,start_rotation:array<double>,instruction:struct<instruction_text:string>>>>"
)
TRUTH_TYPE = "map<string,struct<actions:array<int>,locations:array<array<double>>>>"
CHAT_TYPE = (
    "episode_id string, frame string, input_state struct<historical_trajectory_memory:string,"
    "history_source_frame:bigint>, messages array<struct<role:string,content:variant>>"
)
LABEL_TYPE = (
    "struct<folder:string,filename:string,path:string,"
    "objects:array<struct<name:string,vertices:array<array<double>>>>>"
)
_STRICT = {"mode": "FAILFAST"}


def _whole(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row a file."""
    listed = list(dict.fromkeys([paths] if isinstance(paths, str) else paths))
    return spark.read.text(listed, wholetext=True).withColumn(FILE, bare_path())


def read_annotation_export(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """src_idx, task_idx, data, annotations: one row per task of each JSON array."""
    parsed = F.from_json("value", TASK_TYPE, _STRICT)
    rows = read_parts(spark, paths).select("src_idx", F.col("part_idx").alias("task_idx"), parsed.alias("t"))
    return rows.select("src_idx", "task_idx", "t.data", "t.annotations")


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the last in order, as when a dictionary is filled."""
    rest = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(*[F.max_by(c, order).alias(c) for c in rest])


def read_instructions(spark: SparkSession, path: str) -> DataFrame:
    """episode_id, text, trajectory_id, scene_id, start_position, start_rotation; of a
    repeated id the last entry counts."""
    parsed = F.from_json("value", INSTRUCTION_TYPE, _STRICT)["episodes"]
    rows = _whole(spark, path).select(F.posexplode(parsed).alias("pos", "e"))
    flat = rows.select(
        "pos",
        F.col("e.episode_id").alias("episode_id"),
        F.coalesce("e.instruction.instruction_text", F.lit("")).alias("text"),
        "e.trajectory_id",
        "e.scene_id",
        "e.start_position",
        "e.start_rotation",
    )
    return last_wins(flat, "episode_id", "pos")


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """episode_key (text), actions, locations from an object keyed by episode."""
    rows = read_parts(spark, path).select(F.explode(F.from_json("value", TRUTH_TYPE, _STRICT)))
    return rows.select(F.col("key").alias("episode_key"), "value.actions", "value.locations")


def read_episodes(spark: SparkSession, path: str) -> DataFrame:
    """Processed episodes: an array in one file, or one JSON object a line."""
    parsed = F.from_json("value", EPISODE_TYPE, _STRICT)
    rows = read_parts(spark, path, lines=True).select("src_idx", F.col("part_idx").alias("task_idx"), parsed.alias("e"))
    return rows.select("src_idx", "task_idx", "e.*")


def nonblank_lines(lines: DataFrame) -> DataFrame:
    """Lines that are more than white space."""
    return lines.where(F.regexp_replace("value", r"(?U)\s+", "") != "")


def numbered_lines(lines: DataFrame) -> DataFrame:
    """(record_idx, value) of lines with their file_path and file_block_start.

    The number of a line is its place among the lines of its block of a file, after all lines
    of earlier blocks and files.  A block is read by one task in one go, so a line's place is how far its
    running number is from the block's first; no line is shuffled, and only the blocks' counts
    are summed in one place.
    """
    rows = lines.withColumn("_at", F.monotonically_increasing_id())
    rows = materialize(rows, "chat-lines")  # a number must not change when a task is run again
    block = ["file_path", "file_block_start"]
    counts = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(*block, (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(F.broadcast(starts), block).select((F.col("_shift") + F.col("_at")).alias("record_idx"), "value")


def read_chat(spark: SparkSession, path: str) -> DataFrame:
    """record_idx, episode_id, frame, memory, history_source_frame, messages (role, items, text).

    A message's content is an array of items for the user and a string for the assistant;
    ids given as text become numbers.  record_idx counts the lines that are not blank, from 0
    and without gaps, in the order of files and lines.
    """
    items = "array<struct<type:string,image_path:string,text:string>>"
    lines = numbered_lines(nonblank_lines(spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")))
    parsed = lines.select("record_idx", F.from_json("value", CHAT_TYPE, _STRICT).alias("r"))
    messages = F.transform(
        "r.messages",
        lambda m: F.struct(
            m["role"].alias("role"),
            F.try_variant_get(m["content"], "$", items).alias("items"),
            F.try_variant_get(m["content"], "$", "string").alias("text"),
        ),
    )
    return parsed.select(
        "record_idx",
        # as text first: numbers may be given as text, with a fraction that is cut off
        *[F.col(f"r.{c}").cast("decimal(38, 6)").cast("bigint").alias(c) for c in ("episode_id", "frame")],
        F.col("r.input_state.historical_trajectory_memory").alias("memory"),
        F.col("r.input_state.history_source_frame").alias("history_source_frame"),
        messages.alias("messages"),
    )


def read_labels_3d(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """episode_id (from the file name), filename, objects of label files."""
    parsed = F.from_json("value", LABEL_TYPE, _STRICT)
    return _whole(spark, paths).select(
        F.regexp_extract("_path", r"ep(\d+)[^/]*$", 1).try_cast("bigint").alias("episode_id"),
        parsed["filename"].alias("filename"),
        parsed["objects"].alias("objects"),
    )


def read_mesh(spark: SparkSession, vertices: str, faces: str) -> tuple[DataFrame, DataFrame]:
    """Vertex and face tables, Parquet partitioned by scene."""
    return spark.read.parquet(vertices), spark.read.parquet(faces)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Recorded answers: task key, frame, attempt, status, content, reasoning, finish_reason."""
    return spark.read.parquet(path)


def list_videos(spark: SparkSession, folder: str) -> DataFrame:
    """episode_id of every ``ep*.mp4`` under a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "ep*.mp4").load(folder)
    return files.select(F.regexp_extract("path", r"ep(\d+)\.mp4$", 1).try_cast("bigint").alias("episode_id"))
