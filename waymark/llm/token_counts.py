"""Token counts by byte-pair merging with a heap over a linked list of symbols."""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
#: Fixed value: how a byte-level tokenizer cuts text before it merges bytes.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces remembered by one Python worker, and the longest piece that is remembered.
CACHE_PIECES, CACHE_LENGTH = 1 << 18, 64


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class PieceCounts(dict):
    """Piece -> number of tokens; a missing piece is merged and, if short, remembered."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and cut["type"] == "ByteLevel" and cut["use_regex"]
        odd = cut["add_prefix_space"] or spec["normalizer"] or model.get("ignore_merges")
        if not plain or odd or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("only plain byte-level BPE files are supported")
        vocab = model["vocab"]
        self.first = [vocab[c] for c in byte_symbols()]
        self.width = len(vocab)
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(vocab[left] * self.width + vocab[right], rank)
            self.made.append(vocab[left + right])
        names = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.pieces = regex.compile(PIECES).findall

    def __missing__(self, piece: str) -> int:
        data = piece.encode("utf-8", "surrogatepass")
        n = len(data) - self.merges([self.first[b] for b in data])
        if len(piece) <= CACHE_LENGTH:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = n
        return n

    def merges(self, symbols: list[int]) -> int:
        """How many merges apply.  Heap entries are rank * 2**32 + position of the left
        symbol; one is stale if the pair at its position no longer has that rank."""
        n, width, rank_of, made = len(symbols), self.width, self.rank.get, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = rank_of(symbols[i] * width + symbols[i + 1])
            if rank is not None:
                heap.append(rank << 32 | i)
        heapq.heapify(heap)
        done = 0
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            if symbols[i] < 0:
                continue
            j = after[i]
            if j >= n or rank_of(symbols[i] * width + symbols[j]) != rank:
                continue
            symbols[i], symbols[j] = made[rank], -1
            k = after[i] = after[j]
            done += 1
            if k < n:
                before[k] = i
                rank = rank_of(symbols[i] * width + symbols[k])
                if rank is not None:
                    heapq.heappush(heap, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(symbols[h] * width + symbols[i])
                if rank is not None:
                    heapq.heappush(heap, rank << 32 | h)
        return done

    def count(self, text: str) -> int:
        """Tokens of a text; the strings of special tokens count one each."""
        of, pieces = self.__getitem__, self.pieces
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(sum(map(of, pieces(p))) for p in parts)
        return sum(map(of, pieces(text)))


@lru_cache(maxsize=2)
def counter(tokenizer: str) -> PieceCounts:
    """One per worker process.  A bare name is looked up in the installed vocabularies."""
    if not os.path.isabs(tokenizer):
        import public_tokenizers

        tokenizer = public_tokenizers.path(tokenizer)
    return PieceCounts(tokenizer)


def n_tokens(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Number of tokens of ``text`` (null: 0) in a byte-level BPE vocabulary file.

    No token ids are made.  ``tokenizer`` is an absolute path that exists on every
    executor, or the name of an installed file.  A piece of m bytes costs O(m log m) time
    and O(m) memory, however long it is.
    """

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = counter(tokenizer).count
        for batch in batches:
            yield pd.Series([tokens(t) if t else 0 for t in batch], dtype="int64")

    return count(text)


def count_documents(docs: DataFrame, limit: int = 512, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; a map without a shuffle.

    Null is an empty text of no tokens.  Pairs of one rank merge from left to right.  Repeated
    rows each have a result; an empty table gives an empty result.
    """
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        n_tokens(F.col("text"), tokenizer).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
