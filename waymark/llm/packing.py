"""Packing token sequences by several context sizes: tiers, gaps, cuts and step groups."""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.llm.storage import materialize
from waymark.llm.token_counts import PIECES, TOKENIZER, byte_symbols

END_ID = 1
#: Context sizes, powers of two; the last is the window that others are padded to.
TIERS = (256, 512, 1024, 2048)
#: Tokens of unpacked rests that one task holds; it packs them when there are more.
HOLD_TOKENS = 1 << 21
#: Tokens that one optimiser step takes, over all tiers.
STEP_TOKENS = 1 << 20
#: Chunks remembered by one Python worker, and the longest chunk that is remembered.
CACHE_CHUNKS, CACHE_LENGTH = 1 << 18, 32
#: Fixed value: the white space of the tokenizer's pattern.
SPACE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(
    map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
PIECE_SCHEMA = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier int, part int, place long"
)


class TokenIds(dict):
    """Chunk -> its token ids as little-endian unsigned 32-bit numbers.

    A chunk is a run without white space and the one blank before it, or white space; no
    token crosses a chunk's edge.  Chunks that are not remembered are encoded together, one
    call a text, and told apart by the bytes of their tokens.
    """

    def __init__(self, path: str):
        super().__init__()
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and cut["type"] == "ByteLevel" and cut["use_regex"]
        odd = cut["add_prefix_space"] or spec["normalizer"] or model.get("ignore_merges")
        if not plain or odd or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("only plain byte-level BPE files are supported")
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in s): i for s, i in model["vocab"].items() if s not in special}
        for k, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if model["vocab"][left + right] != 256 + k:
                raise ValueError("ids must follow the order of merges")
        self.encode = tiktoken.Encoding(
            "own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.width = np.zeros(max([*ranks.values(), 0]) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.width[i] = len(token)
        self.special = special
        names = sorted(special, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, names))})").split if names else lambda t: [t]
        self.chunks = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall

    def of(self, text: str) -> bytes:
        """Ids of a text, as the library gives them without added tokens."""
        parts = self.cut(text)
        if len(parts) == 1:
            return self._plain(text)
        coded = [array("I", [self.special[p]]).tobytes() if k % 2 else self._plain(p) for k, p in enumerate(parts)]
        return b"".join(coded)

    def _plain(self, text: str) -> bytes:
        chunks = self.chunks(text)
        found = list(map(self.get, chunks))
        if None in found:
            # only chunks that begin with a blank may stand beside each other
            new = dict.fromkeys(c for c, ids in zip(chunks, found) if ids is None)
            beside = [c for c in new if c[0] == " " and not c[1:2].isspace() and len(c) > 1]
            for c, ids in zip(beside, self._together(beside)):
                new[c] = ids
            for c, ids in new.items():
                if ids is None:
                    new[c] = array("I", self.encode(c)).tobytes()
            found = [new[c] if ids is None else ids for c, ids in zip(chunks, found)]
            if len(self) + len(new) > CACHE_CHUNKS:
                self.clear()
            self.update((c, ids) for c, ids in new.items() if len(c) <= CACHE_LENGTH)
        return b"".join(found)

    def _together(self, chunks: list[str]) -> list[bytes]:
        data = [c.encode("utf-8", "surrogatepass") for c in chunks]
        ids = np.array(self.encode("".join(chunks)), dtype="<u4")
        ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(d) for d in data])) + 1
        raw = ids.tobytes()
        edges = [0, *(4 * ends).tolist()]
        return [raw[a:b] for a, b in zip(edges, edges[1:])]


@lru_cache(maxsize=1)
def token_ids(tokenizer: str) -> TokenIds:
    """One per worker process.  A bare name is looked up in the installed vocabularies."""
    if not os.path.isabs(tokenizer):
        import public_tokenizers

        tokenizer = public_tokenizers.path(tokenizer)
    return TokenIds(tokenizer)


class Packer:
    """Packs one task's documents; sequences come out full.

    Whole windows are cut from the front of a long document.  What is left of it, its rest,
    is routed to the smallest tier that holds it.  Tiers are packed from the longest: a
    rest opens a window of its tier, the gap takes the longest rests that fit whole, and
    when none fits the shortest one that is longer is cut at the gap.  So a window is short
    only when nothing is left; these last tokens become sequences of powers of two.
    """

    def __init__(self, tiers: tuple[int, ...] = TIERS, hold: int = HOLD_TOKENS, part: int = 0):
        if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
            raise ValueError("tiers must be rising powers of two")
        self.tiers, self.window, self.hold, self.part = tiers, tiers[-1], hold, part
        self.rests: dict[int, list] = {}
        self.lengths = 0  # bit n: there is a rest of n tokens
        self.held = self.made = 0
        self.place: dict[int, int] = {}
        self.rows: list[tuple] = []

    def add(self, doc, ids: bytes) -> None:
        """``ids``: all tokens of a document with its end id, four bytes each."""
        n, start = len(ids) // 4, 0
        while n - start >= self.window:
            self._emit([(doc, ids[4 * start : 4 * (start + self.window)], n, start)], self.window)
            start += self.window
        if start < n:
            self._keep((doc, ids[4 * start :], n, start))
        if self.held >= self.hold:
            self.pack()

    def _keep(self, rest: tuple) -> None:
        n = len(rest[1]) // 4
        self.rests.setdefault(n, []).append(rest)
        self.lengths |= 1 << n
        self.held += n

    def _take(self, n: int) -> tuple:
        stack = self.rests[n]
        rest = stack.pop()
        if not stack:
            del self.rests[n]
            self.lengths &= ~(1 << n)
        self.held -= n
        return rest

    def _longest(self, limit: int) -> int:
        """Length of the longest rest of ``limit`` tokens at most; 0: none."""
        return max(0, (self.lengths & ((1 << (limit + 1)) - 1)).bit_length() - 1)

    def _fill(self, size: int) -> list[tuple]:
        """Pieces of ``size`` tokens together, or of all that is held if that is less."""
        pieces = []
        while size and self.lengths:
            n = self._longest(size)
            if n:
                pieces.append(self._take(n))
                size -= n
                continue
            longer = self.lengths >> (size + 1)
            doc, ids, total, start = self._take(size + (longer & -longer).bit_length())
            pieces.append((doc, ids[: 4 * size], total, start))
            self._keep((doc, ids[4 * size :], total, start + size))
            size = 0
        return pieces

    def pack(self, last: bool = False) -> None:
        """Pack what is held; unless this is the ``last`` call, less than a tier may stay."""
        below = [*self.tiers[-2::-1], 0]
        for tier, shorter in zip(self.tiers[::-1], below):
            while self._longest(tier) > shorter and self.held >= tier:
                self._emit(self._fill(tier), tier)
        while last and self.held:
            size = 1 << (self.held.bit_length() - 1)
            self._emit(self._fill(min(size, self.window)), min(size, self.window))

    def _emit(self, pieces: list[tuple], tier: int) -> None:
        sequence, offset = self.part << 33 | self.made, 0
        self.made += 1
        place = self.place[tier] = self.place.get(tier, -1) + 1
        for doc, ids, total, start in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, sequence, offset, tier, self.part, place))
            offset += n

    def drain(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack_pieces(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    tiers: tuple[int, ...] = TIERS,
    hold: int = HOLD_TOKENS,
) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    tier, part, place.

    A task packs the documents it reads, so neither texts nor ids are shuffled, and it holds
    ``hold`` tokens and one document at most.  ``tier`` is the size of the piece's sequence
    and ``place`` that sequence's number among the task's sequences of this size.  Sequence
    ids carry the task's number, so they are unique; they follow the way the table is split.
    A task that is run again gives the same rows.

    Null is an empty text, which is its end id alone.  Repeated rows and rows without id are
    documents of their own.  An empty table gives no pieces.
    """
    names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = Packer(tiers, hold, TaskContext.get().partitionId())
        ids, end = token_ids(tokenizer).of, array("I", [END_ID]).tobytes()
        for batch in batches:
            for doc, text in zip(batch["doc_id"].tolist(), batch["text"]):
                packer.add(doc, (ids(text) if text else b"") + end)
            yield pd.DataFrame(packer.drain(), columns=names)
        packer.pack(last=True)
        yield pd.DataFrame(packer.drain(), columns=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    # as text: a null among whole numbers would make them floats in pandas
    rows = docs.select(F.col("doc_id").cast("string"), "text")
    packed = rows.mapInPandas(pack, PIECE_SCHEMA.format(id="string"))
    return packed.withColumn("doc_id", F.col("doc_id").cast(kind))


def balance_steps(pieces: DataFrame, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Add ``step``: groups of sequences with nearly equal tokens and an equal mix of tiers.

    There are as many steps as the tokens fill, and each tier's sequences are dealt to all of
    them evenly: sequence r of a tier of n goes to step r * steps div n, so steps differ by
    one sequence of each tier at most.  A sequence's rank is its place in its task plus
    the totals of the tasks before, so only one row a task and tier is summed up.
    """
    pieces = materialize(pieces, "pieces")
    counts = pieces.groupBy("tier", "part").agg((F.max("place") + 1).alias("n"))
    before = Window.partitionBy("tier").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("tier").agg(F.sum("n").alias("of_tier"))
    sizes = sizes.withColumn(
        "steps",
        F.ceil(F.sum(F.col("tier") * F.col("of_tier")).over(Window.partitionBy()) / F.lit(step_tokens)),
    )
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).join(sizes, "tier")
    return (
        pieces.join(bases.drop("n"), ["tier", "part"])
        .withColumn("step", F.expr("((base + place) * steps) div of_tier"))
        .select(*[c for c in pieces.columns if c not in ("part", "place")], "step")
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step of every
    piece of every document."""
    return balance_steps(pack_pieces(docs.select("doc_id", "text")))
