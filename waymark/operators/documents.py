"""Chat records to Markdown pages and an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.text import frame_name


def _rstrip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+$", "")


def first_contents(messages: Column) -> Column:
    """struct(image_path, prompt, answer) of messages (role, items, text).

    The first user message's items (type, image_path, text) give the image and the prompt,
    the last of each kind; the first assistant message gives the answer, '' without one.
    """
    user = F.get(F.filter(messages, lambda m: m["role"] == "user"), F.lit(0))
    told = F.get(F.filter(messages, lambda m: m["role"] == "assistant"), F.lit(0))

    def last(kind: str, field: str) -> Column:
        return F.try_element_at(F.filter(user["items"], lambda i: i["type"] == kind), F.lit(-1))[field]

    return F.struct(
        last("image_path", "image_path").alias("image_path"),
        last("text", "text").alias("prompt"),
        F.coalesce(told["text"], F.lit("")).alias("answer"),
    )


def frame_markdown(
    episode_id: Column,
    frame: Column,
    image_path: Column,
    memory: Column,
    source_frame: Column,
    answer: Column,
    prompt: Column,
    include_prompt: bool = False,
) -> Column:
    """One frame's page; lines without a value and an unwanted or empty prompt are absent."""

    def line(*parts) -> Column:
        return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])

    blank = F.lit("")
    lines = [
        line("# Episode ", episode_id, " Frame ", frame),
        blank,
        line("- Episode ID: ", episode_id),
        line("- Frame: ", frame),
        F.when(image_path != "", line("- Image Path: `", image_path, "`")),
        F.when(memory.isNotNull(), line('- Historical Memory Input: "', memory, '"')),
        F.when(source_frame.isNotNull(), line("- History Source Frame: ", source_frame)),
        blank,
        F.lit("## Assistant Output"),
        blank,
        _rstrip(answer),
        blank,
    ]
    if include_prompt:
        block = line("## User Prompt\n\n```text\n", _rstrip(prompt), "\n```\n")
        lines.append(F.when(prompt != "", block))
    body = F.array_join(F.array_compact(F.array(*lines)), "\n")
    return F.concat(_rstrip(body), F.lit("\n"))


def chat_to_markdown(chat: DataFrame, include_prompt: bool = False) -> DataFrame:
    """(file, body) of every chat record: record_idx, episode_id, frame, memory,
    history_source_frame, messages."""
    told = chat.withColumn("_c", first_contents(F.col("messages")))
    body = frame_markdown(
        F.col("episode_id"),
        F.col("frame"),
        F.col("_c.image_path"),
        F.col("memory"),
        F.col("history_source_frame"),
        F.col("_c.answer"),
        F.col("_c.prompt"),
        include_prompt,
    )
    return told.select(
        "record_idx", frame_name(F.col("episode_id"), F.col("frame"), "md").alias("file"), body.alias("body")
    )


def index_lines(chat: DataFrame) -> DataFrame:
    """(record_idx, line): a link per record; records that repeat a frame all stay."""
    name = frame_name(F.col("episode_id"), F.col("frame"), "md")
    return chat.select(
        "record_idx",
        F.format_string("- [Episode %s Frame %s](%s)", F.col("episode_id").cast("string"), F.col("frame").cast("string"), name).alias("line"),
    )


def markdown_index(chat: DataFrame) -> DataFrame:
    """(position, line) of the index page: its head and then one link per record in order.

    Rows instead of one string, so that an index of any length stays distributed.
    """
    head = chat.agg(F.count(F.lit(1)).alias("n")).select(
        F.posexplode(
            F.array(
                F.lit("# Frame Index"),
                F.lit(""),
                F.concat(F.lit("- Total Frames: "), F.col("n").cast("string")),
                F.lit(""),
            )
        ).alias("position", "line")
    )
    links = index_lines(chat).select((F.col("record_idx") + 4).alias("position"), "line")
    return head.select(F.col("position").cast("long"), "line").unionByName(
        links.select(F.col("position").cast("long"), "line")
    )
