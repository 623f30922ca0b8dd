"""Near-duplicate documents by SuperMinHash signatures, banding and verified links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.components import connected_components
from waymark.llm.shingles import mix, shingle_set
from waymark.llm.storage import materialize

#: Signature places, and places to a band: a pair of similarity 0.8 shares no band of 32
#: with probability (1 - 0.8**4)**32, below 1e-7.
PLACES, BAND = 128, 4
#: Places in which the four-bit sketches of a linked pair may differ: a pair of similarity
#: 0.8 differs in 24 of 128 on average (standard deviation 4.4, and 3.6 as measured here).
MOST_DIFFERENT = 44
#: The same for the finer sketches of texts that are compared pair by pair: 96 of 512 on
#: average (standard deviation 8.8, less for SuperMinHash).
FINE_PLACES, FINE_DIFFERENT = 512, 136
#: Rounds of comparing with one member of each bucket before all that is left is compared.
HUB_ROUNDS = 2
_LOW = np.uint64(0xFFFFFFFF)
_SALTS = mix(np.arange(1, FINE_PLACES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def super_min_hash(shingles: np.ndarray, places: int = PLACES) -> np.ndarray:
    """The signature of a non-empty set of 64-bit shingles.

    Element by element the method draws a random permutation of the places and offers
    level + uniform at the place that stands at that level; each place keeps its least
    offer.  All elements are taken together, level by level.  It stops early: once every
    place has an offer below the next level nothing later can win, so a large set costs
    one level and a small one a few.
    """
    n = len(shingles)
    least = np.full(places, np.inf)
    picks: list[np.ndarray] = []
    # few elements go through many levels: they keep their permutations whole
    order = np.tile(np.arange(places), (n, 1)) if n < places else None
    rows = np.arange(n)
    for level in range(places):
        draw = mix(shingles ^ _SALTS[level])
        uniform = (draw >> np.uint64(32)).astype(np.float64) / float(1 << 32)
        pick = (draw & _LOW) * np.uint64(places - level) >> np.uint64(32)
        pick = pick.astype(np.int64) + level
        if order is None:
            place = pick
            for i in range(level - 1, -1, -1):  # where the swaps so far took it from
                place = np.where(place == i, picks[i], np.where(place == picks[i], i, place))
            picks.append(pick)
        else:
            place = order[rows, pick]
            order[rows, pick] = order[:, level]
        np.minimum.at(least, place, level + uniform)
        if least.max() < level + 1:
            break
    return least


def four_bits(signature: np.ndarray) -> np.ndarray:
    """Four bits of each place: of 64 places four numbers, one for each of the bits."""
    bits = signature.reshape(-1, 1, 64) >> np.arange(4, dtype=np.uint64)[:, None] & np.uint64(1)
    return np.bitwise_or.reduce(bits << np.arange(64, dtype=np.uint64), axis=2).reshape(-1).view(np.int64)


def describe(text: str | None, k: int) -> tuple[int, bytes | None, np.ndarray | None, np.ndarray | None]:
    """Set size, fingerprint of the set, band hashes and the signature's four-bit sketch."""
    shingles = shingle_set(text, k)
    if not len(shingles):
        return 0, None, None, None
    signature = mix(super_min_hash(shingles).view(np.uint64))
    bands = signature.reshape(-1, BAND)
    total = np.arange(len(bands), dtype=np.uint64)
    for j in range(BAND):
        total = mix(total ^ bands[:, j]) + np.uint64(j)
    print_ = xxhash.xxh3_128_digest(shingles.tobytes())
    return len(shingles), print_, total.view(np.int64), four_bits(signature)


def _described(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    kind = "n long, fp binary, bands array<long>, sketch array<long>"

    @F.pandas_udf(kind)
    def tell(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [describe(t, k) for t in batch]
            yield pd.DataFrame(rows, columns=["n", "fp", "bands", "sketch"])

    return docs.select(F.col(id_col).alias("id"), tell(F.col(text_col)).alias("s")).select("id", "s.*")


def _verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""

    @F.pandas_udf("boolean")
    def alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        kept: dict[str, np.ndarray] = {}

        def sets(text: str) -> np.ndarray:
            # a hub's text comes again and again within a batch
            if text not in kept:
                if len(kept) >= 64:
                    kept.clear()
                kept[text] = shingle_set(text, k)
            return kept[text]

        for left, right in batches:
            out = []
            for x, y in zip(left, right):
                a, b = sets(x), sets(y)
                both = len(np.intersect1d(a, b, assume_unique=True))
                out.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pd.Series(out, dtype=bool)

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(alike("text_a", "text_b"))
        .select("a", "b")
    )


def _open_texts(texts: DataFrame, open_: DataFrame, k: int, percent: int) -> DataFrame:
    """(rep, most, fine) of texts in ``open_`` that can have a partner there.

    ``most`` bounds what a text shares with any other: its shingles that some other of these
    texts has too.  ``fine`` is a finer sketch.
    """

    @F.pandas_udf("shingles array<long>, fine array<long>")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                found = shingle_set(text, k)
                fine = four_bits(mix(super_min_hash(found, FINE_PLACES).view(np.uint64)))
                out.append((found.view(np.int64), fine))
            yield pd.DataFrame(out, columns=["shingles", "fine"])

    reps = open_.select("rep", "n").distinct()
    sets = materialize(
        texts.join(reps, texts["id"] == reps["rep"])
        .select("rep", "n", look("text").alias("s"))
        .select("rep", "n", "s.*"),
        "open-sets",
    )
    rows = sets.select("rep", F.explode("shingles").alias("shingle"))
    single = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("m"), F.first("rep").alias("rep"))
    own = single.where("m = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("own"))
    return (
        sets.drop("shingles")
        .join(own, "rep", "left")
        .withColumn("most", F.col("n") - F.coalesce("own", F.lit(0)))
        .where(f"100 * most >= {percent} * n")
        .select("rep", "most", "fine")
    )


def _differ(column: str, a: str, b: str, places: int) -> str:
    """SQL for the number of four-bit places in which two sketches differ.  It is short, as Java
    compiles no method beyond 8000 bytes and a join's whole condition stands in one."""
    terms = []
    for i in range(0, places // 16, 4):
        bits = [f"({a}.{column}[{k}] ^ {b}.{column}[{k}])" for k in range(i, i + 4)]
        terms.append(f"bit_count({' | '.join(bits)})")
    return " + ".join(terms)


def _close(a: str, b: str, percent: int, sketches: bool) -> str:
    """Cheap tests that a pair similar enough passes: set sizes, and the sketches' places."""
    sizes = f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)"
    return f"{sizes} and {_differ('sketch', a, b, PLACES)} <= {MOST_DIFFERENT}" if sketches else sizes


def _pair_by_pair(open_: DataFrame, able: DataFrame, percent: int, sketches: bool) -> DataFrame:
    """(a, b): pairs of a bucket and of different components that pass every test.

    Nearly all pairs fail the first tests, which are short enough to be compiled; the finer sketches
    come to the few that are left, each once and not in every bucket.
    """
    near = materialize(open_.join(able.select("rep", "most"), "rep"), "able")
    most = "least(x.most, y.most)"
    pairs = (
        near.alias("x")
        .join(near.alias("y"), "bucket")
        .where(
            "x.rep < y.rep and x.component <> y.component and "
            f"100 * {most} >= {percent} * (x.n + y.n - {most}) and {_close('x', 'y', percent, sketches)}"
        )
        .selectExpr("x.rep as a", "y.rep as b")
        .distinct()
    )
    if not sketches:
        return pairs
    x, y = (able.select(F.col("rep").alias(s), F.struct("fine").alias(t)) for s, t in (("a", "x"), ("b", "y")))
    fine = f"{_differ('fine', 'x', 'y', FINE_PLACES)} <= {FINE_DIFFERENT}"
    return pairs.join(x, "a").join(y, "b").where(fine).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    sketches: bool = True,
) -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    Texts are lower-cased (A to Z) and cut in words; a document's set is its distinct
    ``k``-word shingles, and documents are linked if 100 * intersection >= percent *
    union.  component_id is the smallest id reachable over links, the row's own included.

    1. Documents with equal sets form a class; its smallest id stands for it.
    2. Classes that share a band of their signatures are in a bucket.  In each of
       ``HUB_ROUNDS`` rounds every member of a bucket that holds more than one component
       is compared with one member (another one each round), so a group of n copies costs
       n comparisons, not n * n.
    3. What is then still in different components of one bucket is compared pair by pair.
       Shingles that only one of these texts has bound what it can share with any other,
       which settles heavily edited copies without a comparison; sizes, sketches and
       finer sketches test the rest.  Links are confirmed on the full sets of whole texts.
    4. Components come from union by smallest label over tables in the shared folder.

    ``sketches=False`` leaves out the sketch tests, which a linked pair fails with a
    probability below 1e-5: every pair that shares a band and whose sizes allow it is then
    compared in full.

    Null and empty texts have size 0 and are their own component, and so is a null id
    (with a null component).  Repeated rows are copies of each other; rows that share an
    id but not a text are placed by their texts.  An empty table gives an empty result.
    """
    described = materialize(_described(docs, k, id_col, text_col), "signatures")
    usable = described.where("n > 0 and id is not null")
    classes = materialize(
        usable.groupBy("fp").agg(
            F.min("id").alias("rep"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    members = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("bucket")
    members = materialize(
        members.join(shared, "bucket").join(classes.select("rep", "n", "sketch"), "rep"), "buckets"
    )
    # texts of the documents that stand for a class in some shared bucket
    wanted = members.select(F.col("rep").alias("id")).distinct()
    texts = materialize(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .where("text is not null")
        .join(wanted, "id", "left_semi"),
        "texts",
    )
    links = None
    labels = members.select("rep").distinct().select(F.col("rep").alias("node"), F.col("rep").alias("component"))
    for turn in range(HUB_ROUNDS + 1):
        placed = members.join(labels, members["rep"] == labels["node"], "left").select(
            *members.columns, F.coalesce("component", "rep").alias("component")
        )
        mixed = (
            placed.groupBy("bucket")
            .agg(
                F.min("component").alias("low"),
                F.max("component").alias("high"),
                F.min_by(
                    F.struct("rep", "n", "sketch", "component"),
                    F.xxhash64(F.lit(turn), "rep") if turn else F.col("rep"),
                ).alias("hub"),
            )
            .where("low <> high")
            .drop("low", "high")
        )
        if turn < HUB_ROUNDS:
            found = placed.alias("x").join(mixed.alias("y"), "bucket").where(
                "x.component <> y.hub.component and " + _close("x", "y.hub", percent, sketches)
            )
            pairs = found.selectExpr(
                "least(x.rep, y.hub.rep) as a", "greatest(x.rep, y.hub.rep) as b"
            )
        else:
            open_ = materialize(placed.join(mixed.select("bucket"), "bucket"), "open")
            able = materialize(_open_texts(texts, open_, k, percent), "open-texts")
            pairs = _pair_by_pair(open_, able, percent, sketches)
        pairs = materialize(pairs.distinct(), "pairs")
        new = materialize(_verify(pairs, texts, k, percent), "links")
        links = new if links is None else links.unionByName(new)
        if new.limit(1).count():
            labels = connected_components(links)
    whole = classes.join(labels, classes["rep"] == labels["node"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component")
    )
    return described.join(whole, "fp", "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component"))
        .otherwise(F.col("id"))
        .alias("component_id"),
    )


def group_documents(docs: DataFrame, k: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    return near_duplicates(docs, k).select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
