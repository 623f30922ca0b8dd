"""Elements of JSON files without reading a large file in one piece.

Most files need no search for their elements: small ones are one row each, and files of one object
a line are read by lines.  Files that are sound in this form are taken so; all others, large
arrays and whatever is broken or unusual, are cut at braces.

There Spark's text source splits a file at any byte and ends its records at ``}``, so a split needs
nothing of the others to be read.  What stands between - how deep a record begins, and whether
inside a string - is a scan over splits: each is reduced to the parity of its quotes and to
how it changes the depth in either case, these few rows are scanned in file order, and every
record then knows its depth.  A brace that ends at the elements' depth ends an element.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.sources.scratch import materialize

FILE, SPLIT, AT = "_path", "_split", "_at"
#: Bytes up to which a file is read as one row.
WHOLE = 4 << 20
#: Both listings of files spell a path alike, but not always what stands before it.
BARE = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def _listed(spark: SparkSession, paths: str | list[str]) -> dict[str, int]:
    """Names of files and their numbers, in the order of the caller's list, those of a folder or
    pattern in the order of their paths; what is listed again counts where it came first.

    Only paths, which the driver lists anyway, are ordered there; contents stay in tasks.
    """
    numbers: dict[str, int] = {}
    for p in dict.fromkeys([paths] if isinstance(paths, str) else paths):
        for name in sorted(spark.read.text(p, wholetext=True).inputFiles()):
            numbers.setdefault(name, len(numbers))
    return numbers


def _numbered(spark: SparkSession, numbers: dict[str, int]) -> DataFrame:
    columns = {FILE: pa.array([re.sub(BARE, "", n) for n in numbers], pa.string()), "src_idx": pa.array(numbers.values(), pa.int32())}
    return spark.createDataFrame(pa.table(columns))


def bare_path() -> Column:
    return F.regexp_replace("_metadata.file_path", BARE, "")


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records with quotes and the change of depth if they begin outside or inside a string.

    The order in a split is that of reading; only it is used of the running number, so a task
    that is run again changes nothing.
    """
    listed = list(dict.fromkeys([paths] if isinstance(paths, str) else paths))
    rows = spark.read.option("lineSep", "}").text(listed).select(
        "value",
        bare_path().alias(FILE),
        F.col("_metadata.file_block_start").alias(SPLIT),
        F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias(AT),
    )
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # a brace ends the record, so no escape is cut
    outside = F.regexp_replace(plain, r'"[^"]*("|$)', "")
    inside = F.regexp_replace(F.concat(F.lit('"'), plain), r'"[^"]*("|$)', "")
    rows = rows.withColumns({"_quotes": _count(plain, '"'), "_d0": _count(outside, "{[") - _count(outside, "]"), "_d1": _count(inside, "{[") - _count(inside, "]")})
    order = Window.partitionBy(FILE, SPLIT).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("_quotes").over(order), F.lit(0)) % 2 == 1
    rows = rows.withColumn("_odd", odd)
    # if the split begins outside a string (0) or inside one (1)
    for k in (0, 1):
        begins_in = F.col("_odd") != F.lit(bool(k))
        ends_in = begins_in != (F.col("_quotes") % 2 == 1)
        change = F.when(begins_in, F.col("_d1")).otherwise(F.col("_d0"))
        rows = rows.withColumns({f"_ends_in{k}": ends_in, f"_change{k}": change - F.when(ends_in, 0).otherwise(1)})
    return rows


def _splits(records: DataFrame, lines: bool) -> tuple[DataFrame, DataFrame]:
    """(what each split begins with, what each file is): a row a split and a row a file."""
    first = F.min_by(F.substring(F.ltrim("value", F.lit(" \t\r\n")), 1, 1), F.when(F.regexp_like("value", F.lit(r"\S")), F.col(AT)))
    splits = records.groupBy(FILE, SPLIT).agg(
        (F.sum("_quotes") % 2 == 1).alias("_odd_split"),
        F.sum("_change0").alias("_by0"),
        F.sum("_change1").alias("_by1"),
        F.sum(F.octet_length("value") + 1).alias("_bytes"),
        F.max("_size").alias("_size"),
        first.alias("_first"),
    )
    before = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    begins_in = F.coalesce(F.sum(F.col("_odd_split").cast("int")).over(before), F.lit(0)) % 2 == 1
    splits = splits.withColumn("_in", begins_in)
    by = F.when(F.col("_in"), F.col("_by1")).otherwise(F.col("_by0"))
    splits = splits.withColumn("_depth", F.coalesce(F.sum(by).over(before), F.lit(0)))
    kind = F.coalesce(F.min_by("_first", F.when(F.col("_first") != "", F.col(SPLIT))), F.lit(""))
    files = splits.groupBy(FILE).agg(
        kind.alias("_kind"), (F.sum("_bytes") != F.max("_size")).alias("_open_end")
    )
    level = F.when(F.col("_kind") == "[", 1).when(F.lit(lines), 0).otherwise(1)
    return splits.select(FILE, SPLIT, "_in", "_depth"), files.withColumn("_level", level)


def _pieces(records: DataFrame, begins: DataFrame, files: DataFrame) -> DataFrame:
    """Parts of elements inside one split, with the element's number counted from there."""
    known = records.join(begins.join(files, FILE), [FILE, SPLIT])
    order = Window.partitionBy(FILE, SPLIT).orderBy(AT)
    chosen = {c: F.when(F.col("_in"), F.col(f"_{c}1")).otherwise(F.col(f"_{c}0")) for c in ("ends_in", "change")}
    known = known.withColumns({f"_{c}": v for c, v in chosen.items()})
    depth = F.col("_depth") + F.sum("_change").over(order)
    known = known.withColumn("_ends", (~F.col("_ends_in") & (depth == F.col("_level"))).cast("long"))
    known = known.withColumn("_local", F.sum("_ends").over(order) - F.col("_ends"))
    text = F.sort_array(F.collect_list(F.struct(AT, F.concat("value", F.lit("}")).alias("value"))))
    return known.groupBy(FILE, SPLIT, "_local").agg(
        F.array_join(F.transform(text, lambda t: t["value"]), "").alias("value"), F.max("_ends").alias("_ends")
    )


def read_parts(spark: SparkSession, paths: str | list[str], lines: bool = False, whole: int = WHOLE) -> DataFrame:
    """src_idx, part_idx, kind, value: the elements of each file in order, as texts.

    A file is an array of objects, an object whose values are objects, or with ``lines``
    objects one after the other; ``kind`` is its first character.  An element of an object is
    an object of that one key.  Elements count from 0 in each file.  Strings may hold brackets,
    quotes and escapes.  A file that is cut off, or has more than white space where an
    element or the end should stand, fails the job.

    Arrays of at most ``whole`` bytes and files of one object a line are checked and read as they
    stand, the rest at braces.  The longest task reads one split, and an element must fit a row;
    files that are compressed as a whole are one split.  An empty array or object has no elements.
    """
    numbers = _listed(spark, paths)
    names = list(dict.fromkeys([paths] if isinstance(paths, str) else paths))
    texts, found = _whole_texts(spark, names, whole), []
    taken = _paths(texts.where(_sound_array()))
    if taken:
        found.append(_array_elements(texts.where(_sound_array())))
    if lines and len(taken) < len(numbers):
        rows = _lines(spark, names)
        good = materialize(rows.groupBy(FILE, SPLIT).agg(F.bool_and(_sound_line()).alias("_good"), F.count(F.lit(1)).alias("_n")), "json-lines")
        sound = _paths(good.groupBy(FILE).agg(F.bool_and("_good").alias("_good")).where("_good"))
        if sound:
            found.append(_line_elements(rows, good))
            taken |= sound
    rest = [n for n in numbers if re.sub(BARE, "", n) not in taken]
    if rest or not found:
        found.append(_cut_parts(spark, rest or names, lines))
    parts = functools.reduce(DataFrame.unionByName, found)
    known = F.broadcast(_numbered(spark, numbers))
    return parts.join(known, FILE).select("src_idx", "part_idx", "kind", "value")


def _paths(rows: DataFrame) -> set[str]:
    return {r[0] for r in rows.select(FILE).collect()}


def _alone(text: Column) -> Column:
    """Whether a text is one JSON value and nothing more: what would end one of both shells too
    early leaves the other one open."""
    keys = F.size(F.json_object_keys(F.concat(F.lit('{"k":'), text, F.lit("}"))))
    return (F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1) & (keys == 1)


def _whole_texts(spark: SparkSession, names: list[str], whole: int) -> DataFrame:
    rows = spark.read.text(names, wholetext=True).where(F.col("_metadata.file_size") <= whole)
    return rows.select(bare_path().alias(FILE), "value")


def _sound_array() -> Column:
    """Whether a text is an array of objects; elements of other kinds make it null."""
    objects = F.from_json("value", "array<struct<>>")
    good = F.regexp_like("value", F.lit(r"^\s*\[")) & _alone(F.col("value")) & F.forall(objects, lambda o: o.isNotNull())
    return F.coalesce(good, F.lit(False))


def _array_elements(texts: DataFrame) -> DataFrame:
    parts = F.posexplode(F.from_json("value", "array<string>"))
    return texts.select(FILE, parts.alias("part_idx", "value")).select(FILE, F.col("part_idx").cast("long").alias("part_idx"), F.lit("[").alias("kind"), "value")


def _lines(spark: SparkSession, names: list[str]) -> DataFrame:
    """The lines that are not blank, with their split and their order in it."""
    rows = spark.read.text(names).where(F.regexp_like("value", F.lit(r"\S")))
    return rows.select("value", bare_path().alias(FILE), F.col("_metadata.file_block_start").alias(SPLIT), F.monotonically_increasing_id().alias(AT))


def _sound_line() -> Column:
    return F.coalesce(F.regexp_like("value", F.lit(r"^\s*\{")) & _alone(F.col("value")), F.lit(False))


def _line_elements(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines of files that are sound in all splits.  Nobody who asks for no numbers pays for them."""
    per_file, order = Window.partitionBy(FILE), Window.partitionBy(FILE, SPLIT).orderBy(AT)
    before = per_file.orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    known = splits.select(
        FILE, SPLIT, F.bool_and("_good").over(per_file).alias("_good"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    sound = known.where("_good").select(FILE).distinct()
    base = F.coalesce("_base", F.raise_error(F.concat(F.lit("splits have changed: "), F.col(FILE))).cast("long"))
    numbered = rows.join(F.broadcast(sound), FILE, "left_semi").join(F.broadcast(known.drop("_good")), [FILE, SPLIT], "left")
    numbered = numbered.withColumn("_place", F.row_number().over(order))
    return numbered.select(FILE, (base + F.col("_place") - 1).alias("part_idx"), F.lit("{").alias("kind"), "value")


def _cut_parts(spark: SparkSession, paths: list[str], lines: bool) -> DataFrame:
    """_path, part_idx, kind, value of elements that are found by the braces of their files."""
    records = _records(spark, paths)
    begins, files = _splits(records, lines)
    begins, files = materialize(begins, "json-splits"), materialize(files, "json-files")
    pieces = materialize(_pieces(records, begins, files), "json-pieces")
    before = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    bases = pieces.groupBy(FILE, SPLIT).agg(F.sum("_ends").alias("_n"))
    bases = bases.select(FILE, SPLIT, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    text = F.sort_array(F.collect_list(F.struct(SPLIT, "value")))
    whole = (
        pieces.join(bases, [FILE, SPLIT])
        .groupBy(FILE, (F.col("_base") + F.col("_local")).alias("part_idx"))
        .agg(F.array_join(F.transform(text, lambda t: t["value"]), "").alias("value"), F.max("_ends").alias("_ends"))
        .join(files, FILE)
    )
    counts = pieces.groupBy(FILE).agg(F.sum("_ends").alias("_n"))
    whole = whole.join(counts, FILE)
    checked = _checked(whole, lines)
    # a file must end: without anything behind its last element an array or object is cut off
    ends = whole.groupBy(FILE).agg(F.max((F.col("_ends") == 0).cast("int")).alias("_tail"))
    wrong = (F.col("_tail") == 0) & ((F.col("_kind") == "[") | F.lit(not lines))
    return (
        checked.join(ends, FILE)
        .withColumn("value", F.when(wrong, _fails("is cut off")).otherwise(F.col("value")))
        .where("value is not null")
        .select(FILE, "part_idx", F.col("_kind").alias("kind"), "value")
    )


def _fails(what: str) -> Column:
    return F.raise_error(F.concat(F.lit("malformed JSON file "), F.col(FILE), F.lit(f": it {what}"))).cast("string")


def _checked(whole: DataFrame, lines: bool) -> DataFrame:
    """Elements without what stands before them; what is behind the last one must be the end."""
    array, kind = F.col("_kind") == "[", F.col("_kind")
    start = F.when(F.col("part_idx") == 0, kind).otherwise(",")
    head = F.instr("value", "{").cast("int") - 1  # what stands before an element of an array
    lead = F.regexp_replace(F.substring(F.col("value"), F.lit(1), head), r"\s", "")
    element = F.when(lead == start, F.substring(F.col("value"), head + 1, F.length("value"))).otherwise(
        _fails("has an element that is no object")
    )
    keyed = F.regexp_extract("value", r"(?s)^\s*([{,])\s*(.*)$", 2)
    sign = F.regexp_extract("value", r"^\s*([{,])", 1)
    entry = F.when(sign == start, F.concat(F.lit("{"), keyed, F.lit("}"))).otherwise(_fails("has no key where one is due"))
    if lines:
        bare = F.regexp_replace("value", r"^\s+", "")
        entry = F.when(bare.startswith("{"), bare).otherwise(_fails("has a line that is no object"))
    # behind the last element; the record at a file's end may have been given a brace too many
    shut = F.when(array, "]").otherwise(F.lit("" if lines else "}"))
    rest = F.regexp_replace("value", r"\s", "")
    want = F.when(F.col("_n") == 0, F.concat(F.when(array | F.lit(not lines), kind).otherwise(""), shut)).otherwise(shut)
    good = (rest == want) | (F.col("_open_end") & (rest == F.concat(want, F.lit("}"))))
    tail = F.when(~good, _fails("does not end where it should"))
    found = F.when(F.col("_ends") == 0, tail).when(array, element).otherwise(entry)
    return whole.withColumn("value", found)
