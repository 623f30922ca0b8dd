"""Ranked search of items over all documents by K2-treaps of term-document grids."""

from __future__ import annotations

import functools
import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.llm.storage import materialize

#: ASCII letters are lower-cased, digits and all bytes from 0x80 stay, the rest separates.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
BEST = 50
#: Documents under one treap (columns of its grid), and ranges that are opened at a time.
BLOCK_DOCS, BATCH = 1 << 13, 64
#: Terms of items in one pass over the documents.
BLOCK_TERMS = 250_000
#: Fixed values of the score: 1000000000 * tf div (1000 * tf + 20 * m), m = 50 + 50 * n * N div L.
TF_SCALE, TF_ADD, M_ADD, M_BASE, M_SLOPE, W_SCALE = 1_000_000_000, 1_000, 20, 50, 50, 1_000


def terms(text: str | None) -> list[bytes]:
    """Terms ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` as UTF-8, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(W_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """What terms of these weights and counts add to the score of documents of n terms."""
    m = M_BASE + (M_SLOPE * n * n_docs) // max(all_terms, 1)
    return weight * ((TF_SCALE * tf) // (TF_ADD * tf + M_ADD * m))


class K2Treap:
    """Quadtree over a grid of terms (rows) and documents (columns) with the greatest impact
    of each cell.

    Only cells with an impact above 0 exist.  A node is a number over all levels; ``mask``
    says which of its four quadrants exist, ``first`` where they begin, and ``top`` is its
    greatest impact.  Node -1 stands for an empty cell, with a top of 0.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, side_bits: int):
        some = values > 0
        rows, columns, values = rows[some].astype(np.int64), columns[some].astype(np.int64), values[some]
        code = np.zeros(len(rows), dtype=np.int64)
        for k in range(side_bits):
            code |= ((columns >> k) & 1) << (2 * k) | ((rows >> k) & 1) << (2 * k + 1)
        order = np.argsort(code, kind="stable")
        code, values = code[order], values[order]
        levels = [(code, values)]
        for _ in range(side_bits):
            code, values = levels[-1]
            upper = code >> 2
            begins = np.flatnonzero(np.diff(upper, prepend=-1))
            levels.append((upper[begins], np.maximum.reduceat(values, begins) if len(begins) else values[:0]))
        levels.reverse()
        self.side_bits = side_bits
        masks, firsts, offset = [], [], 0
        for (code, _), (below, _) in zip(levels, [*levels[1:], (np.empty(0, np.int64),) * 2]):
            offset += len(code)
            begins = np.searchsorted(below >> 2, code)
            mask = np.zeros(len(code), dtype=np.uint8)
            if len(below):
                np.bitwise_or.at(mask, np.searchsorted(code, below >> 2), (1 << (below & 3)).astype(np.uint8))
            masks.append(mask)
            firsts.append((begins + offset).astype(np.int32))
        self.mask = np.concatenate([*masks, np.zeros(1, np.uint8)])
        self.first = np.concatenate([*firsts, np.zeros(1, np.int32)])
        self.top = np.concatenate([*(v for _, v in levels), np.zeros(1, np.int64)])

    #: How many quadrants exist before one of a mask.
    _BEFORE = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], dtype=np.int32)

    def below(self, nodes: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """Each node's child in a quadrant, -1 if there is none."""
        mask = self.mask[nodes]
        child = self.first[nodes] + self._BEFORE[mask, quadrant]
        return np.where((mask >> quadrant) & 1, child, -1)

    def search(self, rows: np.ndarray, kept: list, doc_ids: list, keep: int = BEST, batch: int = BATCH) -> None:
        """Put the best columns by the sum of the rows' impacts into the heap ``kept``.

        The paths of all rows go down together: a range of columns has one node a row, and
        the sum of their greatest impacts bounds every column in it.  Ranges are opened in
        the order of their bounds, some at a time, until the best of them cannot beat the
        heap's last.  The heap holds (score, how its id goes last among equals) and carries
        over from one treap to the next.
        """
        if len(self.top) == 1:
            return
        at = np.zeros((1, len(rows)), dtype=np.int32)
        bound = int(self.top[0]) * len(rows)
        queue = [(-bound, 0, 0, at[0])]
        count = 0
        while queue:
            least = kept[0][0] if len(kept) == keep else 1
            opened = []
            while queue and len(opened) < batch and -queue[0][0] >= least:
                opened.append(heapq.heappop(queue))
            if not opened:
                break
            # entries: (-bound, number, column << 6 | bits left, nodes); leaves have no bits left
            size = np.array([self.side_bits - (e[2] & 63) for e in opened])
            column = np.array([e[2] >> 6 for e in opened])
            nodes = np.stack([e[3] for e in opened])
            row_bit = (rows[None, :] >> (size[:, None] - 1)) & 1
            for half in (0, 1):
                child = self.below(nodes, 2 * row_bit + half)
                bounds = self.top[child].sum(axis=1)
                start = column + (half << (size - 1))
                least = kept[0][0] if len(kept) == keep else 1
                for k in np.flatnonzero(bounds >= least).tolist():
                    if size[k] == 1:
                        doc = doc_ids[start[k]]
                        entry = (int(bounds[k]), _last_first(doc), doc)
                        if len(kept) < keep:
                            heapq.heappush(kept, entry)
                        elif entry[:2] > kept[0][:2]:
                            heapq.heapreplace(kept, entry)
                    else:
                        count += 1
                        done = self.side_bits - int(size[k]) + 1
                        heapq.heappush(queue, (-int(bounds[k]), count, int(start[k]) << 6 | done, child[k]))


def _last_first(doc) -> tuple:
    """Sorts ids so that the greatest is the least, and none below all."""
    return (0, 0) if doc is None else (1, -doc)


def _blocks(items: DataFrame, block_terms: int) -> Iterator[list[tuple]]:
    """The stated query set, block by block: (number, item_id, different terms)."""
    block, size = [], 0
    for number, (item_id, text) in enumerate(items.select("item_id", "text").toLocalIterator()):
        own = sorted(set(terms(text)))
        if own:
            block.append((number, item_id, own))
            size += len(own)
        if size >= block_terms:
            yield block
            block, size = [], 0
    if block:
        yield block


def count_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (terms with repeats) and, of the vocabulary, ``found`` and their ``counts``."""
    shared = SparkContext.getOrCreate().broadcast({t: i for i, t in enumerate(vocabulary)})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = shared.value
        for batch in batches:
            out = []
            for text in batch["text"]:
                own = terms(text)
                met = [(number[t], k) for t, k in Counter(own).items() if t in number]
                out.append((len(own), [i for i, _ in met], [k for _, k in met]))
            told = pd.DataFrame(out, columns=["n", "found", "counts"])
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), told], axis=1)

    rows = docs.select(F.col("doc_id").cast("string"), "text")
    return rows.mapInPandas(count, "doc_id string, n long, found array<int>, counts array<int>")


def _search_block(docs: DataFrame, block: list[tuple], keep: int, block_docs: int) -> DataFrame:
    """(number, doc_id, score): the best documents of each item of a block, of every task."""
    vocabulary = sorted({t for *_, own in block for t in own})
    counted = materialize(count_terms(docs, vocabulary), "term-counts")
    n_docs, all_terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counted.select(F.explode("found").alias("term")).groupBy("term").count().collect()
    weight = np.zeros(len(vocabulary), dtype=np.int64)
    for term, df in held:  # one row a term of the items
        weight[term] = term_weight(n_docs, df)
    # rows of like weight lie together, so that a cell's greatest impact is near to all of them
    order = np.argsort(-weight, kind="stable")
    row_of = np.empty(len(order), dtype=np.int64)
    row_of[order] = np.arange(len(order))
    number = {t: i for i, t in enumerate(vocabulary)}
    asked = [(k, np.sort(row_of[[number[t] for t in own]])) for k, _, own in block]
    shared = docs.sparkSession.sparkContext.broadcast((weight, row_of, asked))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight, row_of, asked = shared.value
        kept: list[list] = [[] for _ in asked]
        waiting: list[tuple] = []

        def look() -> None:
            waiting.sort(key=lambda d: d[1])  # documents of like length have like impacts
            sizes = np.array([len(d[2]) for d in waiting])
            columns = np.repeat(np.arange(len(waiting)), sizes)
            found = np.concatenate([d[2] for d in waiting]).astype(np.int64)
            tf = np.concatenate([d[3] for d in waiting]).astype(np.int64)
            n = np.repeat(np.array([d[1] for d in waiting], dtype=np.int64), sizes)
            values = impacts(weight[found], tf, n, n_docs, all_terms)
            side = max(len(weight), len(waiting), 2)
            treap = K2Treap(row_of[found], columns, values, (side - 1).bit_length())
            ids = [d[0] for d in waiting]
            for (_, rows), best in zip(asked, kept):
                treap.search(rows, best, ids, keep)
            waiting.clear()

        for batch in batches:
            for doc, n, found, counts in zip(batch["doc_id"], batch["n"].tolist(), batch["found"], batch["counts"]):
                if len(found):
                    waiting.append((None if doc is None else int(doc), n, found, counts))
                if len(waiting) == block_docs:
                    look()
        if waiting:
            look()
        out = [(k, doc, score) for (k, _), best in zip(asked, kept) for score, _, doc in best]
        numbers, ids, scores = zip(*out) if out else ((), (), ())
        yield pd.DataFrame({"number": numbers, "doc_id": pd.array(ids, dtype="Int64"), "score": scores})

    return counted.select("doc_id", "n", "found", "counts").mapInPandas(search, "number long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, keep: int = BEST, block_docs: int = BLOCK_DOCS, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``keep`` best documents with a score above 0.

    The items are the stated query set.  They are read in blocks of ``block_terms`` terms; a
    block takes one pass over the texts, which leaves the counts of its terms, and one over
    these counts.  The second builds a treap for every ``block_docs`` documents, and a task
    keeps the best documents of each item over all its treaps, so that later ones are left
    as soon as they cannot do better.  What a task returns grows with the items, not with the
    documents; the best of all tasks are ranked per item.

    Null texts have no terms, and count nowhere.  Ids are whole numbers; equal scores go by
    doc_id, null last.
    Repeated rows are documents of their own; so are items, each of which is ranked, and an
    item without terms, or whose terms no document holds, has no rows.  An empty table on
    either side gives an empty result.
    """
    best_first = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found, names = [], []
    for block in _blocks(items, block_terms):
        best = _search_block(docs, block, keep, block_docs)
        best = best.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= keep)
        found.append(best)
        names += [(number, item_id) for number, item_id, _ in block]
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    named = spark.createDataFrame(names, f"number long, item_id {kind}")
    rows = functools.reduce(DataFrame.unionByName, found)
    return rows.join(named, "number").select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score of the 50 best documents of every benchmark item."""
    return search(docs.select("doc_id", "text"), benchmark)
