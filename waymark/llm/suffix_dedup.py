"""Exact removal of long repeated byte strings by blockwise suffix sorting.

A suffix is looked at up to ``WIDTH`` bytes, its window.  The smallest hash among a window's
``GRAM``-byte strings is its anchor; equal windows have the same anchor at the same place, so
suffixes are bucketed by anchor, and consecutive suffixes with one anchor form a segment.
Buckets that hold one text only are dropped; equal segments are counted; and only where
different segments share a bucket are suffixes sorted: bytes of these segments are brought
together, block after block, and ties longer than ``PERIOD`` bytes are decided by the ranks
of a difference-cover sample that are computed once per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.shingles import mix
from waymark.llm.storage import materialize

WIDTH = 400
GRAM = 32
#: Period of the difference cover; WIDTH must be a multiple of it.
PERIOD = 100
#: Bytes of one block of buckets that a task sorts at a time.
BLOCK_BYTES = 1 << 20
#: A bucket with more different segments is split by longer prefixes, not sorted in one task.
BUCKET_SEGMENTS = 256
#: Suffixes to a piece of a split bucket.
PIECE = 16
#: Starts of a text that are looked at together; longer texts are taken block by block.
SCAN_STARTS = 1 << 22
#: Rows with bytes that a task hands on at a time.
OUT_ROWS = 4096
#: Bits of a key that hold a place in such a block.
_PLACE = np.uint64(28)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _grow(n: int) -> None:
    if len(_powers[0]) < n:
        for i, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(2 * n, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)


class Strings:
    """Hashes of any substrings of one byte array."""

    def __init__(self, data: np.ndarray):
        _grow(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_VALUE[data] * _powers[0][: len(data)], out=self.sums[1:])

    def hashes(self, start: np.ndarray, length) -> np.ndarray:
        length = np.asarray(length)
        inside = (self.sums[start + length] - self.sums[start]) * _powers[1][start]
        return mix(inside + length.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def difference_cover(period: int) -> np.ndarray:
    """Residues such that any two positions reach two of them by the same step: the numbers
    below r and the multiples of r, for r about the root of the period."""
    r = int(np.ceil(np.sqrt(period)))
    return np.unique(np.concatenate([np.arange(min(r, period)), np.arange(0, period, r)]))


def segments(data: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """(first, last, offset, anchor, print) of the runs of starts with one anchor.

    ``offset`` is the anchor's place behind ``first``; ``print`` is a hash of the bytes
    from ``first`` to the end of the last window, and of offset and run length.  A run
    ends at the latest with a block of ``SCAN_STARTS`` starts.
    """
    blocks = []
    for start in range(0, max(1, len(data) - width + 1), SCAN_STARTS):
        first, last, *rest = _block_segments(data[start : start + SCAN_STARTS + width - 1], width)
        blocks.append((first + start, last + start, *rest))
    return blocks[0] if len(blocks) == 1 else tuple(map(np.concatenate, zip(*blocks)))


def _block_segments(data: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    n = len(data)
    if n < width:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    strings = Strings(data)
    grams = strings.hashes(np.arange(n - GRAM + 1), GRAM)
    span = width - GRAM + 1
    # smallest hash in each window, the leftmost of equals: its place is in the low bits
    keys = (grams >> _PLACE << _PLACE) | np.arange(len(grams), dtype=np.uint64)
    padded = np.full(-(-len(keys) // span) * span, np.iinfo(np.uint64).max)
    padded[: len(keys)] = keys
    table = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    least = np.minimum(behind[:count], ahead[span - 1 : span - 1 + count])
    place = (least & np.uint64((1 << 28) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.concatenate((first[1:] - 1, [count - 1]))
    offset = place[first] - first
    prints = strings.hashes(first, last - first + width)
    prints = mix(prints ^ (offset.astype(np.uint64) << np.uint64(32)) ^ (last - first).astype(np.uint64))
    return first, last, offset, grams[place[first]], prints


def repeated_starts(
    parts: list[np.ndarray], offsets: np.ndarray, width: int = WIDTH, period: int = PERIOD
) -> list[np.ndarray]:
    """For each segment's bytes, which of its starts has a window equal to another start's.

    The segments stand in one array, each with its anchor at a multiple of ``period``, so
    that suffixes which may be equal have equal residues and reach the cover by the same
    step.  Suffixes are sorted by a hash of their first ``period`` bytes; what ties is ordered by the
    rank of the sample suffix a step further, which covers all but the last ``period``
    bytes, and then by those.  Equal windows end up side by side.
    """
    sizes = np.array([len(p) for p in parts])
    at = np.empty(len(parts), dtype=np.int64)
    end = 0
    for j, size in enumerate(sizes):
        at[j] = end + (-(end + offsets[j])) % period
        end = at[j] + size
    text = np.zeros(end, dtype=np.uint8)
    valid = np.zeros(end, dtype=bool)  # sample suffixes that lie inside one segment
    depth = width - period
    for a, size, part in zip(at.tolist(), sizes.tolist(), parts):
        text[a : a + size] = part
        valid[a : a + size - depth + 1] = True
    strings = Strings(text)
    cover = np.zeros(period, dtype=bool)
    cover[difference_cover(period)] = True
    sample = np.flatnonzero(valid & cover[np.arange(end) % period])
    # ranks by doubling along the period: position + period is in the sample's residues too
    _, rank = np.unique(strings.hashes(sample, period), return_inverse=True)
    for step in range(period, depth, period):
        following = strings.hashes(sample + step, period)
        order = np.lexsort((following, rank))
        new = (rank[order][1:] != rank[order][:-1]) | (following[order][1:] != following[order][:-1])
        rank[order] = np.concatenate(([0], np.cumsum(new)))
    ranks = np.full(end, -1, dtype=np.int64)
    ranks[sample] = rank
    step_of = np.array([next(d for d in range(period) if cover[(r + d) % period]) for r in range(period)])
    counts = sizes - width + 1
    starts = np.concatenate([np.arange(a, a + c) for a, c in zip(at.tolist(), counts.tolist())])
    # only suffixes that take the same step to the cover can be equal, or be compared by it
    step = step_of[starts % period]
    head = mix(strings.hashes(starts, period) + step.astype(np.uint64))
    tie = ranks[starts + step]
    tail = strings.hashes(starts + depth, period)
    order = np.lexsort((tail, tie, head))
    h, t, e = head[order], tie[order], tail[order]
    same = (h[1:] == h[:-1]) & (t[1:] == t[:-1]) & (e[1:] == e[:-1])
    twin = np.zeros(len(order) + 1, dtype=bool)
    twin[1:-1] = same
    out = np.empty(len(order), dtype=bool)
    out[order] = twin[1:] | twin[:-1]
    return np.split(out, np.cumsum(counts)[:-1])


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last index of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


_KEY = "k1 long, k2 long"
_SEGMENTS = f"{_KEY}, anchor long, print long, first int, last int, place int, again boolean"
_RANGES = f"{_KEY}, first int, last int"


def _scan(width: int):
    """Each text's different segments; runs that a text has itself twice have no anchor."""
    names = ["anchor", "print", "first", "last", "place", "again"]

    def frame(keys: list, found: list[tuple[np.ndarray, ...]], own: list) -> pd.DataFrame:
        sizes = [len(f[0]) for f in found]
        columns = {n: np.concatenate(c) for n, c in zip(names, zip(*found))} if found else {n: [] for n in names}
        columns = {c: np.repeat([k[j] for k in keys], sizes) for j, c in enumerate(("k1", "k2"))} | columns
        rows = pd.DataFrame(columns)[["k1", "k2", *names]].astype({"anchor": "Int64", "print": "Int64"})
        alone = pd.DataFrame(own, columns=["k1", "k2", "first", "last"]).assign(place=0, again=True)
        alone["anchor"] = alone["print"] = pd.array([None] * len(alone), dtype="Int64")
        return pd.concat([rows, alone[rows.columns]], ignore_index=True) if own else rows

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, found, own = [], [], []
            for k1, k2, text in zip(batch["k1"], batch["k2"], batch["text"]):
                first, last, place, anchor, prints = segments(_bytes(text), width)
                if not len(first):
                    continue
                _, one, where, times = np.unique(
                    mix(anchor) ^ prints, return_index=True, return_inverse=True, return_counts=True
                )
                keys.append((k1, k2))
                found.append(
                    (anchor[one].view(np.int64), prints[one].view(np.int64), first[one], last[one], place[one], times > 1)
                )
                doubled = times[where] > 1
                if doubled.any():
                    edge = np.zeros(int(last[-1]) + 2, dtype=np.int64)
                    np.add.at(edge, first[doubled], 1)
                    np.add.at(edge, last[doubled] + 1, -1)
                    own += [(k1, k2, a, b) for a, b in _runs(np.cumsum(edge)[:-1] > 0)]
                if len(found) >= 512:
                    yield frame(keys, found, own)
                    keys, found, own = [], [], []
            if found:
                yield frame(keys, found, own)

    return scan


def _cut(width: int):
    """The bytes of the wanted segments of each text."""

    columns = ["k1", "k2", "anchor", "first", "place", "hot", "part"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k1, k2, text, wanted in zip(batch["k1"], batch["k2"], batch["text"], batch["wanted"]):
                data = _bytes(text)
                for w in wanted:
                    part = data[w["first"] : w["last"] + width].tobytes()
                    out.append((k1, k2, w["anchor"], w["first"], w["place"], w["hot"], part))
                if len(out) >= OUT_ROWS:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)

    return cut


def _sort_blocks(width: int, block_bytes: int):
    """Ranges of repeated starts, from rows sorted by anchor; one block in memory at a time."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(p, dtype=np.uint8) for p in rows["part"]]
        flags = repeated_starts(parts, rows["place"].to_numpy(), width)
        out = [
            (k1, k2, first + a, first + b)
            for k1, k2, first, f in zip(rows["k1"], rows["k2"], rows["first"], flags)
            for a, b in _runs(f)
        ]
        return pd.DataFrame(out, columns=["k1", "k2", "first", "last"])

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            while len(batch):
                grown = size + batch["part"].map(len).cumsum().to_numpy()
                full = int(np.searchsorted(grown, block_bytes)) + 1
                # a block ends where a bucket ends
                anchors = batch["anchor"].to_numpy()
                while 0 < full < len(batch) and anchors[full] == anchors[full - 1]:
                    full += 1
                if full >= len(batch):
                    held.append(batch)
                    size = int(grown[-1])
                    break
                block = pd.concat([*held, batch.iloc[:full]], ignore_index=True)
                held, size, batch = [], 0, batch.iloc[full:]
                yield solve(block)
            else:
                continue
            if size >= block_bytes:
                rows = pd.concat(held, ignore_index=True)
                last = rows["anchor"].iloc[-1]
                done = (rows["anchor"] != last).to_numpy()
                if done.any():
                    yield solve(rows[done].reset_index(drop=True))
                    held = [rows[~done]]
                    size = int(held[0]["part"].map(len).sum())
        if held:
            yield solve(pd.concat(held, ignore_index=True))

    return sort


def _pieces(width: int):
    """A split bucket's pieces: a hash of what all their windows share, a hash of the whole
    piece, and its bytes with the anchor's place among them."""

    columns = ["k1", "k2", "core", "print", "first", "last", "place", "part"]

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k1, k2, first, place, part in zip(
                batch["k1"], batch["k2"], batch["first"], batch["place"], batch["part"]
            ):
                data = np.frombuffer(part, dtype=np.uint8)
                strings = Strings(data)
                # pieces are counted from the anchor, so that equal windows share a piece
                distance = place - np.arange(len(data) - width + 1)
                edges = np.flatnonzero(np.diff(distance // PIECE)) + 1
                for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(distance)]):
                    low = place - int(distance[a]) // PIECE * PIECE
                    core = strings.hashes(np.array([low]), width - PIECE + 1).view(np.int64)
                    whole = strings.hashes(np.array([a]), b - a - 1 + width)
                    whole = mix(whole ^ np.uint64(distance[a])).view(np.int64)
                    piece = data[a : b - 1 + width].tobytes()
                    out.append((k1, k2, int(core[0]), int(whole[0]), first + a, first + b - 1, place - a, piece))
                if len(out) >= OUT_ROWS:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)

    return split


def _windows(width: int):
    """Hashes of the single windows of pieces."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k1, k2, first, part in zip(batch["k1"], batch["k2"], batch["first"], batch["part"]):
                data = np.frombuffer(part, dtype=np.uint8)
                starts = np.arange(len(data) - width + 1)
                hashes = Strings(data).hashes(starts, width).view(np.int64)
                yield pd.DataFrame({"k1": k1, "k2": k2, "window": hashes, "first": first + starts})

    return windows


def _split_buckets(hot: DataFrame, width: int) -> DataFrame:
    """Repeated starts of buckets with very many different segments, which no task could
    sort whole.  They are split into finer buckets of pieces that share a longer string, and
    these are sorted; where even such a bucket has very many different pieces, windows are
    counted one by one."""
    pieces = materialize(
        hot.mapInPandas(
            _pieces(width), f"{_KEY}, core long, print long, first int, last int, place int, part binary"
        ),
        "pieces",
    )
    kinds = materialize(
        pieces.groupBy("core", "print").agg(
            F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("k1", "k2", "first", "place", "part")]
        ),
        "piece-kinds",
    )
    equal = pieces.drop("part").join(kinds.where("n > 1").select("core", "print"), ["core", "print"])
    mixed = materialize(
        kinds.groupBy("core").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "piece-buckets"
    )
    rest = kinds.join(mixed, "core").withColumn("anchor", F.col("core"))
    single = materialize(
        rest.where(F.col("m") > BUCKET_SEGMENTS)
        .select("k1", "k2", "first", "part")
        .mapInPandas(_windows(width), f"{_KEY}, window long, first int"),
        "windows",
    )
    twice = materialize(
        single.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window"), "twice"
    )
    return (
        equal.select("k1", "k2", "first", "last")
        .unionByName(_sorted(rest.where(F.col("m") <= BUCKET_SEGMENTS), width))
        .unionByName(single.join(twice, "window").selectExpr("k1", "k2", "first", "first as last"))
    )


def _sorted(parts: DataFrame, width: int) -> DataFrame:
    """Ranges of repeated starts, bucket by bucket through the sort of suffixes."""
    return (
        parts.select("k1", "k2", "anchor", "first", "place", "part")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInPandas(_sort_blocks(width, BLOCK_BYTES), _RANGES)
    )


def repeated_ranges(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(k1, k2, first, last): ranges of starts whose ``width``-byte string starts elsewhere too.

    ``docs`` has k1, k2 and text; texts with equal keys must be equal.
    """
    if width % PERIOD or width < 2 * PERIOD:
        raise ValueError(f"width must be a multiple of {PERIOD}, and twice that at least")
    found = materialize(docs.mapInPandas(_scan(width), _SEGMENTS), "segments")
    own = found.where("anchor is null").select("k1", "k2", "first", "last")
    found = found.where("anchor is not null")
    # counts are written before they are joined, so that AQE can split a frequent anchor
    often = materialize(
        found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "anchors"
    )
    shared = materialize(found.join(often, "anchor"), "shared-segments")
    kinds = materialize(
        shared.groupBy("anchor", "print").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.first(c).alias(c) for c in ("k1", "k2", "first", "last", "place")],
        ),
        "segment-kinds",
    )
    equal = shared.join(kinds.where("n > 1").select("anchor", "print"), ["anchor", "print"])
    mixed = materialize(
        kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "anchor-kinds"
    )
    wanted = (
        kinds.select("k1", "k2", "anchor", "first", "last", "place").join(mixed, "anchor")
        .withColumn("hot", F.col("m") > BUCKET_SEGMENTS)
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("anchor", "first", "last", "place", "hot")).alias("wanted"))
    )
    parts = materialize(
        docs.join(wanted, ["k1", "k2"]).mapInPandas(
            _cut(width), f"{_KEY}, anchor long, first int, place int, hot boolean, part binary"
        ),
        "segment-bytes",
    )
    return (
        own.unionByName(equal.select("k1", "k2", "first", "last"))
        .unionByName(_sorted(parts.where("not hot"), width))
        .unionByName(_split_buckets(parts.where("hot"), width))
    )


def covered_spans(ranges, width: int) -> list[tuple[int, int]]:
    """Maximal byte runs [start, end) that the strings at these starts cover."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last + width))
        else:
            out.append((first, last + width))
    return out


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text, ranges) of every row; ranges (null if none) are the starts, first to
    last, of ``width``-byte strings in its text's UTF-8 bytes that also start anywhere else.

    Null is an empty text; a text shorter than ``width`` has no such string; matches never
    cross texts; repeated rows repeat each other, and so do rows that share an id.  Ids may be
    null and of any type.  An empty table gives an empty result.
    """
    keyed = docs.select(
        "doc_id",
        "text",
        F.xxhash64("doc_id").alias("k1"),
        F.xxhash64("text").alias("k2"),
    )
    found = repeated_ranges(keyed.where(F.octet_length("text") >= width).select("k1", "k2", "text"), width)
    by_text = found.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    return keyed.join(by_text, ["k1", "k2"], "left").select("doc_id", "text", "ranges")


def remove_documents(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def digest(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, ranges in batches:
            out = []
            for text, found in zip(texts, ranges):
                data = _bytes(text).tobytes()
                spans = covered_spans([(r["first"], r["last"]) for r in found], width) if found is not None else []
                kept, done = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(data[done:a])
                    done = b
                kept.update(data[done:])
                out.append((len(data), sum(b - a for a, b in spans), len(spans), kept.hexdigest()))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = remove_repeats(docs, width)
    return rows.select("doc_id", digest("text", "ranges").alias("d")).select("doc_id", "d.*")
