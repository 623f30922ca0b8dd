"""Writers: episodes, error logs, chat lines, Markdown pages, crop metadata."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_episodes(episodes: DataFrame, path: str, compression: str | None = None) -> None:
    """One JSON object a line, null fields kept; rows keep their order across files.  A file that is
    compressed is read by one task, so files should be those of many tasks."""
    rows = episodes.select("episode_id", "video_url", "instruction", "duration", "frames")
    rows.write.option("ignoreNullFields", False).json(path, compression=compression)


def write_error_log(errors: DataFrame, path: str, compression: str | None = None) -> None:
    """Messages as text in the order of tasks, phases, labels and frames.  Rows of ``error_lists`` are
    sorted as lists and told one by one where they are written."""
    from waymark.operators.frames import ERROR_ORDER, expand_errors

    rows = errors.orderBy(*ERROR_ORDER)
    told = expand_errors(rows) if "frames" in rows.columns else rows
    told.select("message").write.text(path, compression=compression)


def write_chat(records: DataFrame, path: str) -> None:
    """Chat lines in task and frame order."""
    records.orderBy("src_idx", "task_idx", "frame_pos").select("line").write.text(path)


def write_json_files(rows: DataFrame, folder: str) -> None:
    """One file per (file, json) row."""
    write_files(rows.select("file", F.col("json").alias("body")), folder, end="}")


def write_files(rows: DataFrame, folder: str, end: str = "\n") -> None:
    """One file per (file, body) row in ``folder``, on any file system that Spark writes to; a
    repeated name keeps the body of the greatest record_idx, else the greatest body.

    Bodies end with ``end``, else the job fails.  They are written beside the folder and moved to
    their places when the job is over, which costs the driver a rename a file; if the job fails,
    what it wrote is removed and the folder is as before.  On a folder of the machines' own file
    system tasks write the files themselves, as Spark's writer starts a process for each
    file's permissions there; on others Spark writes each into a directory of its own name.
    Either way tasks that fail or run twice leave nothing.
    Rows without a name are left out; a file that is there already is replaced.
    """
    spark = rows.sparkSession
    order = "record_idx" if "record_idx" in rows.columns else "body"
    rows = rows.where("file is not null").groupBy("file").agg(F.max_by("body", order).alias("body"))
    whole = F.when(F.col("body").endswith(end), F.expr(f"left(body, length(body) - {len(end)})"))
    text = F.coalesce(whole, F.raise_error(F.concat(F.lit(f"does not end with {end!r}: "), "file")).cast("string"))
    staged = f"{folder.rstrip('/')}.{uuid.uuid4().hex}"
    fs, path = _file_system(spark, staged)
    local = fs.makeQualified(path).toUri()
    try:
        if local.getScheme() == "file":
            os.makedirs(local.getPath())
            bodies = rows.select("file", F.concat(text, F.lit(end)).cast("binary").alias("body"))
            bodies.mapInArrow(_file_writer(local.getPath()), "n long").agg(F.sum("n")).collect()
            _move_local(local.getPath(), _file_system(spark, folder)[1].toUri().getPath())
            return
        rows.select("file", text.alias("value")).write.partitionBy("file").option("lineSep", end).text(staged)
        _move_files(spark, staged, folder)
    finally:
        fs.delete(path, True)


def _file_writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes a task's files; a name is taken by a whole file only."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column("file"), batch.column("body")):
                part = os.path.join(folder, f"{_WRITING}{uuid.uuid4().hex}")
                with open(part, "wb") as out:
                    out.write(body.as_buffer())
                os.replace(part, os.path.join(folder, _escaped(name.as_py())))
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return write


#: What stands before the name of a file that is being written; no escaped name has it.
_WRITING = "%"


def _escaped(name: str) -> str:
    return "file=" + name.replace("%", "%25").replace("/", "%2F")


def _move_local(staged: str, folder: str) -> None:
    os.makedirs(folder, exist_ok=True)
    there = set(os.listdir(folder))
    with os.scandir(staged) as files:
        for file in files:
            if file.name.startswith(_WRITING):  # of a task that failed
                continue
            name = unquote(file.name.removeprefix("file="))
            if (sums := f".{name}.crc") in there:  # those of a file that is replaced
                os.remove(os.path.join(folder, sums))
            os.replace(file.path, os.path.join(folder, name))


def _file_system(spark: SparkSession, path: str) -> tuple:
    """Spark's own file system for a path, and the path in its form."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _move_files(spark: SparkSession, staged: str, folder: str) -> None:
    fs, source = _file_system(spark, staged)
    _, target = _file_system(spark, folder)
    fs.mkdirs(target)
    make = spark._jvm.org.apache.hadoop.fs.Path
    # a local disk keeps checksums in files of their own, which stay behind
    sums = spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.ChecksumFileSystem")
    plain = fs.getRawFileSystem() if sums.isInstance(fs) else fs

    def move(status) -> None:
        name = unquote(status.getPath().getName().removeprefix("file="))
        (part,) = [p.getPath() for p in fs.listStatus(status.getPath()) if p.getPath().getName().startswith("part-")]
        place = make(target, name)
        if fs.exists(place):
            fs.delete(place, False)
        if not plain.rename(part, place):
            raise OSError(f"cannot move {part} to {place}")

    folders = [s for s in fs.listStatus(source) if s.isDirectory() and s.getPath().getName().startswith("file=")]
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, folders))


def markdown_folder(path: str) -> str:
    """Where the pages of a chat file go if nothing else is said: ``<stem>_md`` beside it."""
    return f"{os.path.splitext(path)[0]}_md"


def export_markdown(spark: SparkSession, path: str, folder: str | None = None, include_prompt: bool = False) -> str:
    """A page for every frame of a chat file, and the lines of their index; the folder."""
    from waymark.operators.documents import chat_to_markdown, markdown_index
    from waymark.sources.readers import read_chat

    folder = folder or markdown_folder(path)
    chat = read_chat(spark, path)
    write_files(chat_to_markdown(chat, include_prompt), folder)
    write_index(markdown_index(chat), os.path.join(folder, "index"))
    return folder


def write_index(lines: DataFrame, path: str) -> None:
    """The index page's lines in order."""
    lines.orderBy("position").select("line").write.text(path)
