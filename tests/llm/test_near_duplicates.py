"""What pairs of near duplicates are tested by: short code that Java compiles, and the same counts."""

import numpy as np
from pyspark.sql import functions as F

from waymark.llm import superminhash


def test_sketches_differ_in_as_many_places(spark):
    rng = np.random.default_rng(3)
    for places in (superminhash.PLACES, superminhash.FINE_PLACES):
        a = rng.integers(0, 2**63, places).astype(np.uint64)
        b = np.where(rng.random(places) < 0.6, a, rng.integers(0, 2**63, places).astype(np.uint64))
        want = int(((a & np.uint64(15)) != (b & np.uint64(15))).sum())
        sides = [[int(v) for v in superminhash.four_bits(s)] for s in (a, b)]
        rows = spark.createDataFrame([tuple((s,) for s in sides)], "x struct<s:array<long>>, y struct<s:array<long>>")
        assert rows.select(F.expr(superminhash._differ("s", "x", "y", places))).first()[0] == want


def test_tests_of_pairs_are_compiled(spark):
    """No generated method of a join by bucket is beyond the 8000 bytes up to which Java compiles one."""
    rows = spark.range(4).selectExpr("id as rep", "1L as bucket", "9L as n", "array(1L, id) as sketch", "id as component", "9L as most")
    cheap = superminhash._close("x", "y", 80, True)
    joined = rows.alias("x").join(rows.alias("y"), "bucket").where("x.rep < y.rep and " + cheap).selectExpr("x.rep as a", "y.rep as b")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = joined._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    codes = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
    assert codes.size() and all(codes.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(codes.size()))
