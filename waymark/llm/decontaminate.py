"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast, SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.storage import materialize

#: ASCII letters are lower-cased, digits and all bytes from 0x80 stay, the rest separates.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
WINDOW = 13
#: Words of test items in one automaton; a larger benchmark takes a pass over the documents
#: for each such block.
BLOCK_WORDS = 250_000


def words(text: str | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the windows of each item.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not
    none, is one window as a whole.  States hold transitions by word number, the suffix
    link and the longest length.  ``due[state]`` lists (length, items): the windows that
    end where that state ends, found along the suffix links.  An item without id has
    windows but is not named.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        number = self.vocabulary.setdefault
        coded = [(i, [number(w, len(self.vocabulary)) for w in ws]) for i, ws in items if ws]
        for _, seq in coded:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.shortest = min((min(len(s), window) for _, s in coded), default=0)
        self.pairs = np.unique(
            np.array([a << 32 | b for _, s in coded for a, b in zip(s, s[1:])] or [-1], dtype=np.int64)
        )
        own: dict[int, dict[int, set[str]]] = {}
        for item, seq in coded:
            size, state, have = min(len(seq), window), 0, 0
            for c in seq:
                state, have = self.step(state, have, c)
                if have >= size:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    named = own.setdefault(at, {}).setdefault(size, set())
                    if item is not None:
                        named.add(item)
        self.due: list[tuple[tuple[int, frozenset[str]], ...]] = [()] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            mine = tuple((n, frozenset(s)) for n, s in own.get(state, {}).items())
            self.due[state] = mine + (self.due[self.link[state]] if state else ())

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def step(self, state: int, have: int, c: int) -> tuple[int, int]:
        """Follow one word; ``have`` is the longest matching length."""
        nxt = self.next
        while state and c not in nxt[state]:
            state = self.link[state]
            have = self.length[state]
        if c in nxt[state]:
            return nxt[state][c], have + 1
        return 0, 0

    def scan(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal hit word ranges [start, end) and the items whose windows occur.

        Stretches that cannot hold a window - a word or word pair that no item has breaks
        every match - are skipped; the automaton reads all others.
        """
        n, spans, found = len(text_words), [], set()
        if n < max(1, self.shortest) or not self.vocabulary:
            return spans, found
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in text_words), dtype=np.int64, count=n)
        known = ids >= 0
        code = ids[:-1] << 32 | ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        joined = known[:-1] & known[1:] & (self.pairs[at] == code)
        # stretch k: words linked one to the next by known pairs
        starts = np.flatnonzero(known & np.concatenate(([True], ~joined)))
        ends = np.flatnonzero(known & np.concatenate((~joined, [True]))) + 1
        keep = ends - starts >= self.shortest
        for start, end in zip(starts[keep].tolist(), ends[keep].tolist()):
            state = have = 0
            for i, c in enumerate(ids[start:end].tolist(), start):
                state, have = self.step(state, have, c)
                reach = 0
                for size, items in self.due[state]:
                    if size <= have:
                        reach = max(reach, size)
                        found |= items
                if reach:
                    first = i + 1 - reach
                    while spans and first <= spans[-1][1]:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i + 1))
        return spans, found


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The stated query set, block by block; one block is in memory at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        ws = words(row[1])
        if ws:
            block.append((row[0], ws))
            size += len(ws)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def _hits(automaton: SuffixAutomaton, texts: Column) -> tuple[Column, Broadcast]:
    """Number of words, hit spans and items of each text for one block of items."""
    shared = SparkContext.getOrCreate().broadcast(automaton)

    @F.pandas_udf("n_words long, spans array<array<int>>, items array<string>")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                ws = words(text)
                spans, items = shared.value.scan(ws)
                out.append((len(ws), [list(x) for x in spans], sorted(items)))
            yield pd.DataFrame(out, columns=["n_words", "spans", "items"])

    return hits(texts), shared


def find_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Add n_words, ``hit_spans`` (word ranges [start, end)) and ``hit_items`` to ``docs``.

    The items are the stated query set.  They are read in blocks of ``block_words`` words,
    so that neither the driver nor a worker ever holds more than one block's automaton.
    All blocks but the last pass over the documents one after the other and leave the hits
    of the texts that have any, by a hash of the text; the last pass adds its own to these.
    A benchmark of one block takes a single pass without a shuffle.

    Old columns of the added names are replaced.  A null or empty text has no words and no
    hits; items without words have no windows; windows of an item without id hit words but
    name no item; equal items all count; repeated rows each have their hits.  An empty table
    on either side gives rows without hits, or none.
    """
    made = ("n_words", "hit_spans", "hit_items")
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in made]).alias("row"), "text")
    before: list[DataFrame] = []
    last: list = []
    for block in _blocks(benchmark, block_words):
        if last:
            before.append(_one_block(rows, SuffixAutomaton(last, window)))
        last = block
    hits, _ = _hits(SuffixAutomaton(last, window), F.col("text"))
    if not before:
        found = rows.select("row", hits.alias("hits"))
        spans, items = F.col("hits.spans"), F.col("hits.items")
    else:
        earlier = functools.reduce(DataFrame.unionByName, before).groupBy("code").agg(
            F.flatten(F.collect_list("spans")).alias("old_spans"),
            F.flatten(F.collect_list("items")).alias("old_items"),
        )
        found = (
            rows.withColumn("code", F.xxhash64("text"))
            .join(earlier, "code", "left")
            .select("row", hits.alias("hits"), "old_spans", "old_items")
        )
        none = F.array()
        spans = _merge(F.concat("hits.spans", F.coalesce("old_spans", none)))
        items = F.array_distinct(F.concat("hits.items", F.coalesce("old_items", none)))
    return found.select(
        "row.*",
        F.col("hits.n_words").alias("n_words"),
        spans.alias("hit_spans"),
        items.alias("hit_items"),
    )


def _one_block(rows: DataFrame, automaton: SuffixAutomaton) -> DataFrame:
    """(code, spans, items) of the different texts that one block of items hits."""
    hits, shared = _hits(automaton, F.col("text"))
    found = rows.select(F.xxhash64("text").alias("code"), hits.alias("hits")).where("size(hits.spans) > 0")
    found = found.groupBy("code").agg(F.first("hits.spans").alias("spans"), F.first("hits.items").alias("items"))
    found = materialize(found, "block-hits")
    shared.destroy()
    return found


def _merge(spans: Column) -> Column:
    """``merged`` of an array of ranges."""

    @F.pandas_udf("array<array<int>>")
    def merge(batch: pd.Series) -> pd.Series:
        return pd.Series([[list(x) for x in merged([tuple(map(int, s)) for s in row])] for row in batch])

    return merge(spans)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, non-touching ranges with the same union."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def with_verdict(hits: DataFrame, share: int = 20) -> DataFrame:
    """Add n_hit and ``contaminated``: some word is hit, and one in ``share`` or more."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]))
    return hits.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    )


def remove_spans(hits: DataFrame, out_col: str = "clean_text") -> DataFrame:
    """Add the text without its hit words; what stands between kept words stays."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, s) for t, s in zip(texts, spans)])

    return hits.withColumn(out_col, cut("text", "hit_spans"))


def _cut(text: str | None, spans) -> str | None:
    if text is None or spans is None or not len(spans):
        return text
    data = text.encode("utf-8", "surrogatepass")
    flat = np.frombuffer(data.translate(_WORD_BYTES), dtype=np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flat, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    parts, done = [], 0
    for a, b in spans:
        parts.append(data[done : starts[a]])
        done = ends[b - 1]
    return b"".join([*parts, data[done:]]).decode("utf-8", "surrogatepass")


def decontaminate_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = with_verdict(find_hits(docs.select("doc_id", "text"), benchmark))
    items = F.concat_ws(",", F.array_sort("hit_items"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def digest(items: list[str]) -> str:
    """The digest of a list of item ids, as the query returns it."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
