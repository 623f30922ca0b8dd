"""Prediction by partial matching over the bytes of documents, with a unigram base score."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.language_id import held_out
from waymark.llm.shingles import hash_words, mix, space_words
from waymark.llm.storage import materialize

#: Bytes of context; a gram of ``ORDER`` + 1 bytes is packed in one 64-bit number.
ORDER = 5
#: Context bytes of the levels that every task holds: at most 2^24 grams, whatever the input.
LOW_ORDER = 2
#: UTF-8 bytes of text that one chunk is meant to hold.
CHUNK_BYTES = 8 << 20
#: The token that ends a text: no word can be or hold a line feed.
END = b"\n"
_GAP = 32
#: Tokens whose positions are held at once, and those before them that contexts can reach.
_SLICE_TOKENS = 1 << 20
_REACH = ORDER // 2 + 1
#: Chunks whose packets of one bucket meet in one group.
GROUP_CHUNKS = 4096
#: Groups of one bucket whose sums are added up at a time.
MERGE_SHARES = 64
#: Bits of the number of buckets, at most.
MAX_BITS = 12
#: Share of one occurrence that each kind of symbol in a context leaves to the escape.
ESCAPE = 0.3


def positions(words: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Packed grams of every byte of every word and its closing gap, and word boundaries.

    The gram of a position is its byte after ``order`` bytes of context, which run over the
    words before it; before the first word and after an ``END`` context is all gaps.
    """
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = b" ".join([*words, b""]).replace(END + b" ", END + b" " * (order + 1))
    flat = np.frombuffer(data, dtype=np.uint8)
    gap = flat == _GAP
    read = ~gap
    read[1:] |= ~gap[:-1]  # a gap after a gap is padding
    packed = np.ndarray(len(data), ">u8", b" " * 8 + data, offset=1, strides=(1,))
    mask = np.uint64((1 << 8 * (order + 1)) - 1)
    return packed[read].astype(np.uint64) & mask, np.flatnonzero(gap[read]) + 1


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted number in sorted ``keys``, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class ByteModel:
    """A byte-context trie, one level per order, as sorted arrays.

    Level k holds grams of k context bytes and a symbol with their counts, and contexts
    with the log escape and log denominator both from a fresh start and after the symbols
    of the context one byte longer were excluded.
    """

    order: int
    grams: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    fresh: list[tuple[np.ndarray, np.ndarray]]
    excluded: list[tuple[np.ndarray, np.ndarray]]
    sums: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def fit(
        grams: np.ndarray, counts: np.ndarray, order: int = ORDER, base: ByteModel | None = None
    ) -> ByteModel:
        """From distinct full grams and their counts; shorter ones are their sums.

        With ``base``, the levels it has are taken from it, and ``grams`` need only be all
        those whose contexts end in some given ``base.order`` + 1 bytes.
        """
        model = ByteModel(order, [], [], [], [], [], [])
        if base:
            for mine, theirs in zip(model.levels(), base.levels()):
                mine.extend(theirs)
        sums = model.sums
        for k in range(len(sums), order + 1):
            mask = np.uint64((1 << 8 * (k + 1)) - 1)
            keys, where = np.unique(grams & mask, return_inverse=True)
            n = np.bincount(where, weights=counts, minlength=len(keys))
            context, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            total = np.bincount(at, weights=n, minlength=len(context))
            kinds = np.bincount(at, minlength=len(context)).astype(float)
            model.grams.append(keys)
            model.counts.append(n)
            model.contexts.append(context)
            model.fresh.append(_logs(total, kinds))
            sums.append((total, kinds))
            if k == 0:
                # below the trie all 257 - kinds remaining symbols are alike
                model.excluded.append((np.zeros(len(context)), np.log(257.0 - kinds)))
                continue
            # what the context one byte shorter still offers once these symbols are excluded
            shorter = np.uint64((1 << 8 * k) - 1)
            low = _lookup(model.grams[k - 1], keys & shorter)
            low_n = np.bincount(at, weights=model.counts[k - 1][low], minlength=len(context))
            parent = _lookup(model.contexts[k - 1], context & (shorter >> np.uint64(8)))
            whole, all_kinds = sums[k - 1]
            model.excluded.append(_logs(whole[parent] - low_n, all_kinds[parent] - kinds))
        return model

    def levels(self) -> tuple[list, ...]:
        return self.grams, self.counts, self.contexts, self.fresh, self.excluded, self.sums

    def score(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's symbol after its context."""
        out = np.zeros(len(grams))
        todo = np.arange(len(grams))
        carried = np.zeros(len(grams), dtype=bool)  # an escape has been paid already
        denominator = np.zeros(len(grams))
        escape = np.zeros(len(grams))
        for k in range(self.order, -1, -1):
            mask = np.uint64((1 << 8 * (k + 1)) - 1)
            g = grams[todo] & mask
            context = _lookup(self.contexts[k], g >> np.uint64(8))
            known = context >= 0
            begin = known & ~carried[todo]
            esc, den = self.fresh[k]
            escape[todo[begin]] = esc[context[begin]]
            denominator[todo[begin]] = den[context[begin]]
            hit = np.where(known, _lookup(self.grams[k], g), -1)
            done = hit >= 0
            d = todo[done]
            out[d] += np.log(self.counts[k][hit[done]] - ESCAPE) - denominator[d]
            missed = known & ~done
            m = todo[missed]
            out[m] += escape[m]
            carried[m] = True
            if k:
                esc, den = self.excluded[k]
                escape[m], denominator[m] = esc[context[missed]], den[context[missed]]
            else:
                out[m] -= self.excluded[0][1][context[missed]]
            todo = todo[~done]
        if not len(self.contexts[0]):
            out[:] = -np.log(257.0)
        return out / np.log(10.0)


def _logs(total: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log escape and log denominator: every kind of symbol gives ``ESCAPE`` of its count to
    the escape (method D gives one half); with nothing left an escape is free."""
    open_ = kinds > 0.5
    whole = np.where(open_, total, 1.0)
    return np.where(open_, np.log(np.where(open_, ESCAPE * kinds, 1.0) / whole), 0.0), np.log(whole)


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words and one end; null is an empty text."""
    return [*space_words(text, lower=True), END]


def _sliced(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``positions`` of a long sequence of tokens, some ``_SLICE_TOKENS`` at a time."""
    for start in range(0, len(words), _SLICE_TOKENS):
        before = min(start, _REACH)
        grams, ends = positions(words[start - before : start + _SLICE_TOKENS])
        known = int(ends[before - 1]) if before else 0
        yield grams[known:], ends[before:] - known


def count_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of a sequence of tokens, ascending, with their counts."""
    parts = [np.unique(grams, return_counts=True) for grams, _ in _sliced(words)]
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else order
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


_UPPER = np.uint64(8 * (ORDER - LOW_ORDER - 1))
_BYTE = np.uint64(8)


def to_codes(grams: np.ndarray) -> np.ndarray:
    """Grams with the last bytes of their contexts, one more than ``LOW_ORDER``, in front."""
    last = (grams >> _BYTE) & np.uint64((1 << 8 * (LOW_ORDER + 1)) - 1)
    upper = grams >> np.uint64(8 * (LOW_ORDER + 2))
    return last << (_UPPER + _BYTE) | upper << _BYTE | grams & np.uint64(255)


def to_grams(codes: np.ndarray) -> np.ndarray:
    last = codes >> (_UPPER + _BYTE)
    upper = (codes >> _BYTE) & np.uint64((1 << int(_UPPER)) - 1)
    return upper << np.uint64(8 * (LOW_ORDER + 2)) | last << _BYTE | codes & np.uint64(255)


def by_context(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of distinct grams, ascending, and the order that sorts the grams so, and by
    their codes in a bucket.

    Grams whose contexts end in the same bytes, one more than ``LOW_ORDER``, share a bucket,
    so it has every longer context of its grams whole.
    """
    codes = to_codes(grams)
    first = np.argsort(codes)
    buckets = mix(codes[first] >> (_UPPER + _BYTE)) >> np.uint64(64 - bits)
    order = np.argsort(buckets, kind="stable")
    return buckets[order], first[order]


def pack(values: np.ndarray) -> bytes:
    """Steps from number to number, byte by byte of all of them: what ascends slowly, or
    is alike, then compresses well."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unpack(data: bytes, kind: type = np.uint64) -> np.ndarray:
    size = np.dtype(kind).itemsize
    steps = np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()
    return np.cumsum(steps, dtype=kind)


def _slices(buckets: np.ndarray):
    edges = np.flatnonzero(np.diff(buckets)) + 1
    cuts = [0, *edges.tolist(), len(buckets)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield int(buckets[a]), slice(a, b)


def _flat(texts: list[list[bytes]]) -> list[bytes]:
    return [w for words in texts for w in words]


_TOKENS, _GRAMS = 0, 1
_PACKETS = "chunk long, kind int, bucket long, keys binary, counts binary"


def _gather(bits: int):
    """Of each chunk: its distinct tokens and grams with their counts in the documents to
    learn from, packed by bucket."""

    def gather(key, docs: pd.DataFrame) -> pd.DataFrame:
        texts, train = [tokens(t) for t in docs["text"]], docs["train"].to_numpy(bool)
        learn = _flat([ws for ws, t in zip(texts, train) if t])
        other = _flat([ws for ws, t in zip(texts, train) if not t])
        codes, found = pd.factorize(hash_words(learn + other))
        times = np.bincount(codes[: len(learn)], minlength=len(found))
        order = np.argsort(found)
        found, times = found[order], times[order]
        out = [
            (key[0], _TOKENS, b, pack(found[s]), pack(times[s].astype(np.uint64)))
            for b, s in _slices(found >> np.uint64(64 - bits))
        ]
        grams, times = count_grams(learn)
        more = np.setdiff1d(count_grams(other)[0], grams, assume_unique=True)
        grams, times = np.concatenate((grams, more)), np.concatenate((times, np.zeros(len(more), np.int64)))
        buckets, order = by_context(grams, bits)
        codes, times = to_codes(grams[order]), times[order].astype(np.uint64)
        out += [(key[0], _GRAMS, b, pack(codes[s]), pack(times[s])) for b, s in _slices(buckets)]
        return pd.DataFrame(out, columns=["chunk", "kind", "bucket", "keys", "counts"])

    return gather


_SUMS = "kind int, bucket long, share long, keys binary, counts binary"
_GROUPS = f"{_SUMS}, chunks binary, sizes binary, at binary"


def _meet(key, rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket of some chunks: its distinct keys with their sums, and where each chunk's
    keys stand among them."""
    keys = [unpack(k) for k in rows["keys"]]
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([unpack(c) for c in rows["counts"]])
    total = np.bincount(where, weights=counts, minlength=len(distinct)).astype(np.uint64)
    sizes = np.fromiter(map(len, keys), np.int64, len(keys))
    parts = (rows["chunk"].to_numpy(np.int64).tobytes(), sizes.tobytes(), pack(where.astype(np.uint32)))
    columns = ["kind", "bucket", "share", "keys", "counts", "chunks", "sizes", "at"]
    return pd.DataFrame([(*key, pack(distinct), pack(total), *parts)], columns=columns)


def _add(key, rows: pd.DataFrame) -> pd.DataFrame:
    """The sums of one bucket over some shares."""
    keys, counts = (np.concatenate([unpack(x) for x in rows[c]]) for c in ("keys", "counts"))
    keys, counts = summed(keys, counts)
    return pd.DataFrame([(*key, pack(keys), pack(counts))], columns=["kind", "bucket", "share", "keys", "counts"])


def _bucket_sums(groups: DataFrame, shares: int) -> DataFrame:
    """(kind, bucket, keys, counts): all shares of a bucket added up, some at a time, so that
    no group is larger than so many times the bucket."""
    sums = groups.select("kind", "bucket", "share", "keys", "counts")
    while True:
        shares = -(-shares // MERGE_SHARES)
        merged = F.floor(F.col("share") / MERGE_SHARES).alias("share")
        sums = sums.groupBy("kind", "bucket", merged).applyInPandas(_add, _SUMS)
        if shares <= 1:
            return materialize(sums.drop("share"), "gram-sums")


def _return(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each chunk's values in its own order, from a group and its bucket's values."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            value = np.frombuffer(row.value, np.float32 if row.kind == _GRAMS else np.int64)
            value = value[np.searchsorted(unpack(row.known), unpack(row.keys))]
            value = value[unpack(row.at, np.uint32)]
            ends = np.cumsum(np.frombuffer(row.sizes, np.int64))
            packets = [part.tobytes() for part in np.split(value, ends[:-1])]
            chunks = np.frombuffer(row.chunks, np.int64)
            yield pd.DataFrame({"chunk": chunks, "kind": row.kind, "bucket": row.bucket, "packet": packets})


def _byte_model(grams: np.ndarray, counts: np.ndarray, base: ByteModel) -> np.ndarray:
    """log10 probability of a bucket's grams after the counts of all documents."""
    known = counts > 0
    model = ByteModel.fit(grams[known], counts[known].astype(float), base=base)
    return model.score(grams).astype(np.float32)


def _low_levels(sums: DataFrame) -> ByteModel:
    """The levels up to ``LOW_ORDER`` over all documents to learn from."""

    def shorten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"]):
                short = to_grams(unpack(keys)) & np.uint64((1 << 8 * (LOW_ORDER + 1)) - 1)
                grams, n = summed(short, unpack(counts))
                yield pd.DataFrame({"gram": grams.astype(np.int64), "n": n.astype(np.int64)})

    rows = (
        sums.where(f"kind = {_GRAMS}")
        .select("keys", "counts")
        .mapInPandas(shorten, "gram long, n long")
        .where("n > 0")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
        .sort_values("gram")
    )
    return ByteModel.fit(rows["gram"].to_numpy().astype(np.uint64), rows["n"].to_numpy(float), LOW_ORDER)


def _totals(counts: str) -> Column:
    """struct(n, v): the sum of packed counts, and how many are not 0."""

    @F.pandas_udf("n long, v long")
    def total(batch: pd.Series) -> pd.DataFrame:
        found = [unpack(c) for c in batch]
        return pd.DataFrame({"n": [int(c.sum()) for c in found], "v": [int((c > 0).sum()) for c in found]})

    return total(counts)


def _price(
    words: list[bytes], bits: int, returned: dict[tuple[int, int], bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of each position of a chunk's tokens, from what the buckets sent for
    its distinct grams, and where each token ends among the positions."""
    parts, stops, done = [], [], 0
    for grams, ends in _sliced(words):
        codes, distinct = pd.factorize(grams)
        parts.append((codes.astype(np.int32), distinct))
        stops.append(ends + done)
        done += len(grams)
    grams = np.unique(np.concatenate([distinct for _, distinct in parts]))
    price = np.empty(len(grams))
    buckets, order = by_context(grams, bits)
    for b, s in _slices(buckets):
        price[order[s]] = np.frombuffer(returned[_GRAMS, b], np.float32)
    each = [price[np.searchsorted(grams, distinct)][codes] for codes, distinct in parts]
    return np.concatenate(each), np.concatenate(stops)


def score_documents(
    docs: DataFrame,
    parts: int = 10,
    chunk_bytes: int = CHUNK_BYTES,
    group_chunks: int = GROUP_CHUNKS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    The score is the code length of the document's bytes in order after a trie of all
    training documents: contexts run over its words.

    1. Documents are dealt to chunks by a hash of id and text.  A chunk sends its distinct
       tokens (hashed to 64 bits) and byte grams, packed by bucket; grams are dealt by the
       last bytes of their contexts, so that a bucket has its longer contexts whole.
    2. Packets of one bucket meet in groups of ``group_chunks`` chunks, which leave their
       distinct keys, their sums, and each chunk's places among these keys.
    3. Sums are added up over groups.  The levels up to ``LOW_ORDER``, bounded by
       the number of byte values, are broadcast; each bucket fits the longer levels and
       prices its grams.
    4. Groups meet their bucket's prices, send them back to the chunks, and documents are
       scored.

    Every gram counts, and neither trie nor vocabulary is ever in one place; what moves is
    the text and each chunk's vocabulary and grams.

    A null text is an empty one: one end.  A null id counts as held out.  Repeated rows each
    count and each have a result.  Without training documents N and V are 0 and the trie is
    uniform; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks = max(8, -(-size // chunk_bytes))
    bits = max(4, min(MAX_BITS, math.ceil(math.log2(n_chunks))))
    dealt = docs.select(
        "doc_id",
        "text",
        (~held_out(F.col("doc_id"), parts)).alias("train"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).alias("chunk"),
    )
    packets = dealt.groupBy("chunk").applyInPandas(_gather(bits), _PACKETS)
    share = F.floor(F.col("chunk") / group_chunks).alias("share")
    groups = materialize(
        packets.groupBy("kind", "bucket", share).applyInPandas(_meet, _GROUPS), "gram-groups"
    )
    sums = _bucket_sums(groups, -(-n_chunks // group_chunks))
    n, v = sums.where(f"kind = {_TOKENS}").select(_totals("counts").alias("t")).agg(F.sum("t.n"), F.sum("t.v")).first()
    n, v = n or 0, v or 0
    rest = math.log10(n + 0.1 * (v + 1))
    low = spark.sparkContext.broadcast(_low_levels(sums))

    def value(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for kind, bucket, known, counts in zip(batch["kind"], batch["bucket"], batch["keys"], batch["counts"]):
                found = unpack(counts).astype(np.int64)
                if kind == _GRAMS:
                    found = _byte_model(to_grams(unpack(known)), found, low.value)
                row = (kind, bucket, known, found.tobytes())
                yield pd.DataFrame([row], columns=["kind", "bucket", "known", "value"])

    values = sums.mapInPandas(value, "kind int, bucket long, known binary, value binary")
    returned = groups.drop("counts", "share").join(values, ["kind", "bucket"]).mapInPandas(
        _return, "chunk long, kind int, bucket long, packet binary"
    )

    def score(_, docs: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        packets = dict(zip(zip(sums["kind"], sums["bucket"]), sums["packet"]))
        texts = [tokens(t) for t in docs["text"]]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        words = _flat(texts)
        codes, found = pd.factorize(hash_words(words))
        order = np.argsort(found)
        counts = np.empty(len(found), dtype=np.int64)
        for b, s in _slices(found[order] >> np.uint64(64 - bits)):
            counts[order[s]] = np.frombuffer(packets[_TOKENS, b], np.int64)
        # every text has its end, so no part is empty
        starts = np.cumsum(sizes) - sizes
        price, stops = _price(words, bits, packets)
        begins = np.concatenate(([0], stops[starts[1:] - 1]))
        return pd.DataFrame(
            {
                "doc_id": docs["doc_id"].array,
                "held_out": ~docs["train"].to_numpy(bool),
                "n_tokens": sizes,
                "n_known": np.add.reduceat((counts > 0).astype(np.int64)[codes], starts),
                "base_score": np.add.reduceat((np.log10(counts + 0.1) - rest)[codes], starts),
                "score": np.add.reduceat(price, begins),
            }
        )

    return (
        dealt.groupBy("chunk")
        .cogroup(returned.groupBy("chunk"))
        .applyInPandas(
            score,
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, "
            "n_tokens long, n_known long, base_score double, score double",
        )
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(n).cast("long").alias("train_tokens"),
            "base_score",
            "score",
        )
    )
