"""Files of rows: whole, replaced, or not there at all."""

import pytest
from pyspark.sql import functions as F

from waymark.sources import sinks


def names(folder):
    return sorted(p.name for p in folder.iterdir())


def test_files_hold_their_bodies(spark, tmp_path):
    rows = [("a b.md", "one\ntwo\n", 1), ("é%3D=x.md", "\r\n\n", 1), ("c.md", "old\n", 1), ("c.md", "new\n", 2), (None, "x\n", 1)]
    frame = spark.createDataFrame(rows, "file string, body string, record_idx long").repartition(3)
    sinks.write_files(frame, str(tmp_path / "out"))
    assert names(tmp_path / "out") == ["a b.md", "c.md", "é%3D=x.md"] and names(tmp_path) == ["out"]
    assert (tmp_path / "out" / "c.md").read_bytes() == b"new\n"
    assert (tmp_path / "out" / "a b.md").read_bytes() == b"one\ntwo\n"
    assert (tmp_path / "out" / "é%3D=x.md").read_bytes() == b"\r\n\n"
    sinks.write_files(frame.where("file = 'c.md'").withColumn("body", F.lit("third\n")), str(tmp_path / "out"))
    assert (tmp_path / "out" / "c.md").read_bytes() == b"third\n" and len(names(tmp_path / "out")) == 3


def test_json_files(spark, tmp_path):
    sinks.write_json_files(spark.createDataFrame([("a.json", '{"a": {}}')], "file string, json string"), str(tmp_path / "out"))
    assert (tmp_path / "out" / "a.json").read_text() == '{"a": {}}'


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    frame = spark.range(20).selectExpr("concat(id, '.md') as file", "concat(id, '\n') as body").repartition(4)
    broken = frame.withColumn("body", F.when(F.col("file") == "7.md", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("body")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_files(broken, str(tmp_path / "out"))
    assert names(tmp_path) == []
    with pytest.raises(Exception, match="does not end"):
        sinks.write_files(frame.withColumn("body", F.lit("no end")), str(tmp_path / "out"))
    assert names(tmp_path) == []


def test_local_files_are_written_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "_move_files", lambda *_: pytest.fail("a driver's call a file"))
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "a.md").write_text("old\n")
    (tmp_path / "out" / ".a.md.crc").write_bytes(b"crc\0\0\0\2\0\0\0\0\0")
    rows = spark.createDataFrame([("a.md", "new\n", 1), ("%.md", "é\n", 1)], "file string, body string, record_idx long")
    sinks.write_files(rows, f"file://{tmp_path}/out")
    assert names(tmp_path / "out") == ["%.md", "a.md"] and names(tmp_path) == ["out"]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["new", "é"]


def test_label_files_are_not_numbered_in_the_driver(spark, tmp_path):
    from waymark.sources import readers

    (tmp_path / "ep00004_x.json").write_text('{"folder": "", "filename": "f", "path": "", "objects": []}')
    plan = readers.read_labels_3d(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Join" not in plan and "LocalRelation" not in plan


def test_episodes_between_writer_and_reader_are_small(spark, sf_dir, tmp_path, monkeypatch):
    """What the query writes in between is compressed, and all of it is read back."""
    from waymark.plans import queries

    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    told = queries.QUERIES["src_processed_episodes"](spark, sf_dir).count()
    lines = spark.read.text(str(tmp_path / "episodes"))
    assert lines.count() == told > 0
    size = sum(f.stat().st_size for f in (tmp_path / "episodes").glob("part-*"))
    assert size * 4 < sum(len(r.value) for r in lines.collect())
