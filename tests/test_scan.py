"""Scans over chunks against plain loops, whatever the size of a chunk."""

import random

import pytest
from pyspark.sql import functions as F

from waymark.operators import scan, spatial, traces
from waymark.plans import harness as H

SCHEMA = "g int, pos int, text string, v long, settled boolean, turn int, action_code int"


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(6)
    out = {}
    for g, n in enumerate((1, 2, 17, 60, 300)):
        at = sorted(rng.sample(range(-5, 4 * n), n))
        rows = []
        for k, pos in enumerate(at):
            settled = rng.choice([True, False]) if k == 0 or rng.random() < 0.15 else None
            rows.append((g, pos, rng.choice([None, "a", "b"]), rng.randint(-3, 9), settled, rng.randint(0, 1), rng.randint(0, 4)))
        out[g] = rows
    return out


def plain(rows):
    total, value, before, out = 0, None, None, {}
    for k, (g, pos, text, v, settled, turn, _) in enumerate(rows):
        was = value
        value = settled if settled is not None else value != bool(turn)
        out[g, pos] = (rows[k - 1][2] if k else None, rows[k - 1][1] if k else None, total, value, was)
        total += v
    return out


@pytest.mark.parametrize("size", [1, 3, 50, 100_000])
def test_scans_equal_loops(spark, groups, size):
    rows = [r for g in groups.values() for r in g]
    random.Random(size).shuffle(rows)
    chunked = scan.in_chunks(spark.createDataFrame(rows, SCHEMA).repartition(3), "pos", size)
    told = scan.lags(chunked, ["g"], "pos", {"text_before": "text", "pos_before": "pos"})
    told = scan.earlier_sum(told, ["g"], "pos", F.col("v"), "total")
    told = scan.settle(told, ["g"], "pos", "settled", "turn", "has")
    got = {(r.g, r.pos): (r.text_before, r.pos_before, r.total, r.has, r.has_before) for r in told.collect()}
    assert got == {k: v for g in groups.values() for k, v in plain(g).items()}
    assert set(told.columns) - set(chunked.columns) == {"text_before", "pos_before", "total", "has", "has_before"}


def test_headings_over_chunks(spark, groups):
    frame = spark.createDataFrame([r for g in groups.values() for r in g], SCHEMA)
    got = {(r.g, r.pos): r.heading for r in spatial.headings(frame, ["g"], "pos", size=4).collect()}
    for rows in groups.values():
        angle = 0.0
        for g, pos, *_, code in rows:
            assert got[g, pos] == angle
            angle += {2: 15.0, 3: -15.0}.get(code, 0.0)


@pytest.mark.parametrize("chain", [traces.memory_chain, traces.template_chain])
def test_chains_do_not_depend_on_chunks(spark, sf_dir, chain):
    eligible = traces.eligible_frames(H.frames(spark, sf_dir), H.truth(spark, sf_dir), [1, 2, 4])
    outcomes = traces.choose_outcome(traces.validate_responses(eligible, H.responses(spark, sf_dir)))
    shown = lambda rows: sorted(map(repr, rows.select("task_idx", "frame_pos", "outcome", "memory", "anchor", "history_source_frame").collect()))
    whole = shown(chain(eligible, outcomes))
    assert shown(chain(eligible, outcomes, size=5)) == whole and len(whole) == eligible.count()


def test_a_long_group_spreads_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(4000).selectExpr("1 as g", "id as pos", "id % 7 as v")
        told = scan.lags(scan.in_chunks(rows, "pos", 100), ["g"], "pos", {"before": "v"})
        shares = told.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(shares) == 8 and max(r["count"] for r in shares) < 1200
