"""How answers are taken apart: the short way, and code that Java compiles."""

import pytest
from pyspark.sql import functions as F


def test_steps_of_an_answer_are_compiled(spark):
    """No generated method of the step is beyond the 8000 bytes up to which Java compiles one."""
    from waymark.operators import traces

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(3).selectExpr("id", "concat('{\"a\": ', id, '}') as content")
        plan = traces.with_trace(rows)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    codes = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
    assert codes.size() and all(codes.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(codes.size()))


@pytest.mark.parametrize("text", ["{a}", "{a}\n", "{}", "{", "}", "{a}```", "```json\n{a}\n```", "{a\r}", "\u00a0{a}\u2003", "x{a}y{b}z", "{```}", " }{ ", ""])
def test_answers_without_fences_are_left_as_they_are(spark, text):
    """The short way gives what the search gives."""
    import re

    from waymark.functions.text import extract_json_object

    want = re.sub(r"\s*```$", "", re.sub(r"```(?:json|markdown|md|text)?\s*", "", text.replace("\r\n", "\n").replace("\r", "\n").strip()))
    first, last = want.find("{"), want.rfind("}")
    want = want[first : last + 1] if 0 <= first < last else want
    assert spark.createDataFrame([(text,)], "t string").select(extract_json_object(F.col("t"))).first()[0] == want
