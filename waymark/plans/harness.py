"""Annotation-shaped views over the driver tables, made of expressions that SQL can repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tasks of one export: url, duration (missing for some) and key."""
    o = table(spark, sf_dir, "orders")
    named = F.format_string("http://v/ep%05d.mp4", "o_custkey")
    seconds = (5 + F.col("o_orderkey") % 20) + F.lit(0.75)
    return o.select(
        F.lit(0).alias("src_idx"),
        F.col("o_orderkey").alias("task_idx"),
        F.when(F.col("o_orderkey") % 13 == 0, "http://v/video.mp4").otherwise(named).alias("video_url"),
        F.when(F.col("o_orderkey") % 17 != 0, seconds).alias("meta_duration"),
        F.when(F.col("o_orderkey") % 34 == 0, F.lit(7.0)).alias("result_duration"),
    )


def raw_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tasks in the shape of an export, with two annotation sets each."""
    t = tasks(spark, sf_dir)
    meta = F.concat(
        F.lit('{"video":{'),
        F.coalesce(F.concat(F.lit('"duration":'), F.col("meta_duration").cast("string")), F.lit("")),
        F.lit('},"other":{"duration":99}}'),
    )
    value = lambda text, duration: F.struct(
        F.struct(
            F.array(F.concat(F.lit(f"subtask:{text} "), F.col("task_idx").cast("string"))).alias("labels"),
            F.array(
                F.struct(
                    F.lit(2).alias("frame"), F.lit(True).alias("enabled"),
                    *[F.lit(1.0).alias(c) for c in ("x", "y", "width", "height")],
                )
            ).alias("sequence"),
            duration.alias("duration"),
        ).alias("value")
    )
    return t.select(
        "src_idx",
        "task_idx",
        F.create_map(F.lit("video"), F.col("video_url"), F.lit("meta"), meta).alias("data"),
        F.array(
            F.struct(F.array(value("first", F.lit(None).cast("double")), value("second", F.col("result_duration"))).alias("result")),
            F.struct(F.array(value("unused", F.lit(3.0))).alias("result")),
        ).alias("annotations"),
    )


def export_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The tasks as exports: a file, each a JSON array, for every 1024 order keys."""
    task = F.struct("task_idx", F.to_json(F.struct("data", "annotations"), {"ignoreNullFields": "false"}).alias("json"))
    tasks_of = F.transform(F.sort_array(F.collect_list(task)), lambda t: t["json"])
    _files(raw_tasks(spark, sf_dir), "task_idx", tasks_of, "[]").write.partitionBy("file").text(path)


def truth_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The ground truth as objects keyed by episode."""
    entry = F.concat(F.lit('"'), F.col("episode_key"), F.lit('":'), F.to_json(F.struct("actions")))
    rows = truth(spark, sf_dir)
    _files(rows, "episode_key", F.collect_list(entry), "{}").write.partitionBy("file").text(path)


def _files(rows: DataFrame, key: str, parts, ends: str) -> DataFrame:
    file = F.format_string("%010d", F.floor(F.col(key).cast("long") / 1024))
    body = F.concat(F.lit(ends[0]), F.array_join(parts, ","), F.lit(ends[1]))
    return rows.groupBy(file.alias("file")).agg(body.alias("value"))


def keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as keyframes: one label per line number of an order, named by a part."""
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    by_result = ["l_orderkey", "l_linenumber"]
    order = Window.partitionBy(*by_result).orderBy(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    rows = li.withColumn("seq_idx", F.row_number().over(order) - 1)
    first = (
        rows.where("seq_idx = 0")
        .join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            *by_result,
            F.when(F.col("l_linestatus") == "O", "subtask").otherwise("object").alias("kind"),
            F.col("p_name").alias("text"),
        )
    )
    return rows.join(first, by_result).select(
        F.lit(0).alias("src_idx"),
        F.col("l_orderkey").alias("task_idx"),
        F.col("l_linenumber").alias("result_idx"),
        F.lit(0).alias("label_idx"),
        "kind",
        "text",
        "seq_idx",
        (1 + F.col("l_partkey") % 25).cast("int").alias("frame"),
        F.when(F.col("l_returnflag") == "N", True).when(F.col("l_returnflag") == "R", False).alias("enabled"),
        (F.col("l_quantity") * 2).alias("x"),
        (F.rint(F.col("l_discount") * 100) * 10).alias("y"),
        (F.rint(F.col("l_tax") * 100) * 10).alias("width"),
        F.col("l_quantity").alias("height"),
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task headers: id from the url, duration 5 to 24."""
    t = tasks(spark, sf_dir)
    ids = F.regexp_extract("video_url", r"ep(\d+)", 1).try_cast("bigint")
    duration = (5 + F.col("task_idx") % 20).cast("int")
    return t.select("src_idx", "task_idx", ids.alias("episode_id"), "video_url", duration.alias("duration"))


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text per customer that names parts of the first lines of its orders; some are known
    by another key and some empty."""
    li = table(spark, sf_dir, "lineitem").where("l_linenumber = 1")
    orders, part = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    names = (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("o_custkey").alias("episode_id"))
        .agg(F.array_join(F.sort_array(F.collect_set("p_name")), ", ").alias("names"))
    )
    text = F.when(F.col("episode_id") % 11 == 0, "").otherwise(F.concat(F.lit("Walk past "), F.upper("names")))
    return names.select(renamed("episode_id", 7, 0), text.alias("text"))


def renamed(key: str, every: int, at: int):
    """A key that no other table knows for some rows, so that joins miss and no row is lost."""
    return F.when(F.col(key) % every == at, -1 - F.col(key)).otherwise(F.col(key)).alias(key)


_OBJECT = "array<struct<label:string,bbox:struct<x:double,y:double,width:double,height:double>>>"


def _object(label, x, y, width, height):
    box = F.struct(x.alias("x"), y.alias("y"), width.alias("width"), height.alias("height"))
    return F.struct(label.alias("label"), box.alias("bbox"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as frames of one episode per user, with up to two objects each."""
    e = table(spark, sf_dir, "events")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    i = F.col("event_id")
    one = _object(
        F.concat(F.col("event_type"), F.lit(" door")),
        (i * 7 % 90).cast("double"),
        (i * 13 % 90) + F.lit(0.25),
        (i % 17) + F.lit(0.5),
        (i % 11) + F.lit(0.25),
    )
    two = _object(
        F.lit("  the\tred   chair "),
        (i * 3 % 95) + F.lit(0.05),
        (i * 5 % 95).cast("double"),
        (i % 23).cast("double"),
        (i % 9) + F.lit(0.75),
    )
    objects = F.when(i % 3 == 0, F.array().cast(_OBJECT)).when(i % 3 == 1, F.array(one).cast(_OBJECT)).otherwise(
        F.array(one, two).cast(_OBJECT)
    )
    return e.select(
        F.lit(0).alias("src_idx"),
        F.col("user_id").alias("task_idx"),
        (F.row_number().over(order) - 1).cast("int").alias("frame_pos"),
        F.col("user_id").alias("episode_id"),
        F.concat(F.lit("Follow visitor "), F.col("user_id").cast("string"), F.lit(" to the end.")).alias("instruction"),
        F.row_number().over(order).cast("int").alias("frame"),
        F.when(i % 7 != 0, F.concat(F.lit("go to '"), F.col("event_type"), F.lit("'"))).alias("subtask"),
        objects.alias("objects"),
        "event_id",
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions per user, from event ids (4 is an unknown code); some users are known by
    another key and some lists five short."""
    f = frames(spark, sf_dir)
    codes = F.transform(
        F.sort_array(F.collect_list(F.struct("frame_pos", (F.col("event_id") % 5).cast("int").alias("code")))),
        lambda s: s["code"],
    )
    rows = f.groupBy("episode_id").agg(codes.alias("codes"))
    short = F.slice("codes", F.lit(1), F.greatest(F.size("codes") - 5, F.lit(0)))
    return rows.select(
        renamed("episode_id", 10, 3).cast("string").alias("episode_key"),
        F.when(F.col("episode_id") % 4 == 1, short).otherwise(F.col("codes")).alias("actions"),
    )


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as vertices: vec_id, scene, x, y, z."""
    e = table(spark, sf_dir, "embeddings")
    xyz = [F.round(F.get("embedding", F.lit(k)).cast("double") * 10, 3).alias(c) for k, c in enumerate("xyz")]
    return e.select(F.format_string("s%03d.v1", "label").alias("scene"), F.col("vec_id").alias("vertex_id"), *xyz)


def scene_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each three neighbouring vertices of a scene as a face."""
    order = Window.partitionBy("scene").orderBy("vertex_id")
    rows = scenes(spark, sf_dir).select(
        "scene",
        F.col("vertex_id").alias("face_id"),
        F.col("vertex_id").alias("v0"),
        F.lead("vertex_id", 1).over(order).alias("v1"),
        F.lead("vertex_id", 2).over(order).alias("v2"),
    )
    return rows.where("v2 is not null")


def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector starts an episode in its scene with three places."""
    e = table(spark, sf_dir, "embeddings")

    def value(k: int):
        return F.round(F.get("embedding", F.lit(k)).cast("double") * 5, 3)

    return e.select(
        F.col("vec_id").alias("episode_id"),
        (F.col("vec_id") * 2).alias("trajectory_id"),
        F.format_string("mp3d/s%03d/s%03d.v1.glb", "label", "label").alias("scene_id"),
        F.array(*[F.array(*[value(k + j) for j in range(3)]) for k in (3, 6, 9)]).alias("locations"),
    )


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as chat records: one record per conversation, turns as messages."""
    c = table(spark, sf_dir, "conversations")
    none = F.lit(None).cast("string")
    image = F.concat(F.lit("f/"), F.col("conv_id").cast("string"), F.lit(".jpg"))

    def item(kind: str, path, text):
        return F.struct(F.lit(kind).alias("type"), path.alias("image_path"), text.alias("text"))

    words = item("text", none, F.col("text"))
    items = F.when(F.col("conv_id") % 3 == 0, F.array(words)).otherwise(F.array(item("image_path", image, none), words))
    user = F.col("role") == "user"
    message = F.struct(
        "turn",
        "role",
        F.when(user, items).alias("items"),
        F.when(~user, F.col("text")).alias("text"),
    )
    rows = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(message)).alias("messages"))
    return rows.select(
        F.col("conv_id").alias("record_idx"),
        (F.col("conv_id") % 50).alias("episode_id"),
        (1 + F.col("conv_id") % 9).cast("int").alias("frame"),
        F.when(F.col("conv_id") % 4 != 0, F.concat(F.lit("memory "), F.col("conv_id").cast("string"))).alias("memory"),
        F.when(F.col("conv_id") % 5 != 0, F.col("conv_id") % 7).alias("history_source_frame"),
        "messages",
    )


def chat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chat records as JSON lines, in order over the files they are written to."""
    def alone(field: str, value):
        j = F.to_json(F.struct(value.alias(field)), {"ignoreNullFields": "false"})
        return F.substring(j, len(field) + 5, F.length(j) - len(field) - 5)

    rows = chat(spark, sf_dir)
    told = F.transform(
        "messages",
        lambda m: F.concat(
            F.lit('{"role":'), alone("role", m["role"]), F.lit(',"content":'),
            F.coalesce(F.to_json(m["items"]), alone("text", m["text"])), F.lit("}"),
        ),
    )
    state = F.to_json(
        F.struct(F.col("memory").alias("historical_trajectory_memory"), "history_source_frame"),
        {"ignoreNullFields": "false"},
    )
    line = F.concat(
        F.lit('{"episode_id":"'), F.col("episode_id").cast("string"), F.lit('","frame":'), F.col("frame").cast("string"),
        F.lit(',"input_state":'), state, F.lit(',"messages":['), F.array_join(told, ","), F.lit("]}"),
    )
    ordered = rows.select("record_idx", line.alias("value")).repartitionByRange("record_idx")
    return ordered.sortWithinPartitions("record_idx").select("value")


#: Kinds of recorded answers; ``responses`` deals them by event and attempt.
KINDS = 18


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three recorded answers per frame, good and bad in every way that is checked."""
    from waymark.functions.actions import action_phrase, decode_action
    from waymark.functions.boxes import normalize_bbox, object_name
    from waymark.functions.text import int_list_repr

    f = frames(spark, sf_dir).withColumn("attempt", F.explode(F.sequence(F.lit(1), (1 + F.col("event_id") % 3).cast("int"))))
    f = f.withColumn("kind", ((F.col("event_id") + F.col("attempt") * 5) % KINDS).cast("int"))
    phrase = action_phrase(decode_action(F.col("event_id") % 5))
    some = F.size("objects") > 0
    named = F.array_join(F.transform("objects", object_name), " and ")
    boxed = F.array_join(
        F.transform("objects", lambda o: F.concat(object_name(o), F.lit(" "), F.replace(int_list_repr(normalize_bbox(o["bbox"])), F.lit(" "), F.lit("")))),
        " and ",
    )
    unseen = F.lit("The object is not visible.")
    k = F.col("kind")
    s1 = F.when(k == 8, F.repeat(F.lit("x"), 401)).otherwise(F.lit("Step 1: On track."))
    s2 = (
        F.when(k == 7, "  ")
        .when((k == 9) & some, unseen)
        .when(k == 9, "I see a wall.")
        .when((k == 10) & some, F.concat(F.lit("I see "), named))
        .when(some, F.concat(F.lit("I see "), boxed))
        .otherwise(unseen)
    )
    s3 = F.when(k == 11, "It fits.").otherwise(F.concat(F.lit("So "), phrase, F.lit(" fits.")))
    s4 = F.concat(F.lit("Now "), phrase, F.lit(" at "), F.col("event_id").cast("string"), F.lit("."))
    s4 = F.when(k == 12, F.concat(s4, F.lit(" Then on."))).otherwise(s4)

    def pair(name: str, value):
        return F.concat(F.lit(f'"{name}": "'), value, F.lit('"'))

    first = F.when(k == 6, '"step1_task_progress": 5').otherwise(pair("step1_task_progress", s1))
    third = F.when(k == 4, '"step3_other": "x"').otherwise(pair("step3_decision_logic", s3))
    whole = F.concat(
        F.lit("{"), first, F.lit(", "), pair("step2_spatial_perception", s2), F.lit(", "), third, F.lit(", "),
        pair("step4_memory_update", s4), F.when(k == 5, ', "more": "x"').otherwise(""), F.lit("}"),
    )
    content = (
        F.when(k == 13, F.concat(F.lit("```json\n"), whole, F.lit("\n```")))
        .when(k == 14, '{"a": ')
        .when(k == 15, " ")
        .when(k == 16, "[1]")
        .when(k != 17, whole)
    )
    return f.select(
        "src_idx",
        "task_idx",
        "frame_pos",
        "attempt",
        F.when(k == 17, "transport_error").otherwise("ok").alias("status"),
        content.alias("content"),
        F.when(k % 2 == 0, F.repeat(F.lit("r"), (F.col("event_id") % 50).cast("int"))).alias("reasoning"),
        F.when(k.isin(15, 14), "length").otherwise("stop").alias("finish_reason"),
        F.when(F.col("event_id") % 2 == 0, "on").otherwise("off").alias("thinking_mode"),
        F.when(k % 3 == 0, "json_object").otherwise("text").alias("response_format"),
    )
