"""Packing against the tokenizer library and the rules of its result."""

import random
import struct
import zlib
from collections import defaultdict

import pytest

from waymark.llm import packing

SCHEMA = "doc_id long, text string, start int, step string"


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    odd = [
        None, "", " ", "  ", "\n\n a  b\t c\r\n", "<|endoftext|>", "a<|endoftext|> b <|endoftext", "don't we'll 12 345",
        "é ü 日本語 😀   x y 　z", "x" * 9_000, " \x1c\x1d a\x85b", "the " * 4_000, "no\nblank\n\nlines \n here",
    ]
    letters = "abcdefgh ABC   \n\t.,;'é日  1 "
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 900))) for _ in range(120)]
    long = [" ".join(rng.choice(["alpha", "beta,", "Gamma", "1984", "d-e-l"]) for _ in range(n)) for n in (1_500, 3_000, 20_000)]
    return odd + made + long


@pytest.fixture(scope="module")
def packed(spark, texts):
    rows = [(i, t, -1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, (None, "no id", 0, "")], SCHEMA).repartition(3)
    return [r.asDict() for r in packing.pack_documents(docs).collect()]


def test_ids_equal_the_library(texts):
    import public_tokenizers

    own, tok = packing.TokenIds(public_tokenizers.path("byte_bpe_50k.json")), library()
    for t in texts + texts:
        if t is not None:
            want = tok.encode(t, add_special_tokens=False).ids
            assert own.of(t) == struct.pack(f"<{len(want)}I", *want), t[:80]


def test_a_full_memory_of_chunks_changes_nothing(texts, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "CACHE_CHUNKS", 5)
    small, large = packing.TokenIds(public_tokenizers.path("byte_bpe_50k.json")), packing.token_ids("byte_bpe_50k.json")
    assert [small.of(t or "") for t in texts] == [large.of(t or "") for t in texts]


def test_every_id_lies_in_one_piece(packed, texts):
    tok, by_doc = library(), defaultdict(list)
    for r in packed:
        by_doc[r["doc_id"]].append(r)
    assert set(by_doc) == {*range(len(texts)), None}
    for i, t in [*enumerate(texts), (None, "no id")]:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["length"]) == (at, len(ids), len(part))
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r["length"]
        assert at == len(ids)


def test_sequences_are_full_and_gapless(packed):
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append(r)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == rows[0]["tier"] and at & (at - 1) == 0 and at <= 2048
        assert len({(r["tier"], r["step"]) for r in rows}) == 1


def test_tiers_take_short_documents_whole():
    packer = packing.Packer((4, 8, 16), hold=1 << 20)
    for doc, n in enumerate([10, 6, 7, 3, 4, 2, 40]):
        packer.add(doc, bytes(4 * n))
    packer.pack(last=True)
    rows = packer.drain()
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r[5]].append((r[0], r[1], r[2]))
    # whole windows of the long one first; its rest and others stay whole where they fit
    assert by_seq[0] == [(6, 0, 16)] and by_seq[1] == [(6, 16, 16)]
    assert by_seq[2] == [(0, 0, 10), (1, 0, 6)]
    assert by_seq[3] == [(6, 32, 8)]
    assert by_seq[4][0] == (2, 0, 7)
    assert sum(n for s in by_seq.values() for _, _, n in s) == 72


def test_small_holds_give_the_same_tokens():
    rng = random.Random(3)
    sizes = [rng.randint(1, 60) for _ in range(500)]
    for hold in (1, 40, 1 << 20):
        packer = packing.Packer((4, 8, 16), hold=hold)
        for doc, n in enumerate(sizes):
            packer.add(doc, bytes(4 * n))
            assert packer.held < max(hold, 16) + 60
        packer.pack(last=True)
        got, used = defaultdict(int), defaultdict(int)
        for doc, _, n, _, _, seq, _, tier, *_ in packer.drain():
            got[doc] += n
            used[seq, tier] += n
        assert [got[d] for d in range(500)] == sizes
        assert all(n == tier for (_, tier), n in used.items())
        assert len(used) < sum(sizes) / 16 * (3 if hold == 1 else 2)


def test_steps_hold_equal_mixes(spark):
    rng = random.Random(5)
    texts = [" ".join("word" for _ in range(rng.randint(1, 2500))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    steps, tokens = defaultdict(lambda: defaultdict(set)), defaultdict(int)
    for r in packing.balance_steps(packing.pack_pieces(docs), step_tokens=1 << 15).collect():
        steps[r["step"]][r["tier"]].add(r["sequence_id"])
        tokens[r["step"]] += r["length"]
    assert len(steps) > 5 and sorted(steps) == list(range(len(steps)))
    for tier in packing.TIERS:
        counts = [len(s[tier]) for s in steps.values()]
        assert max(counts) - min(counts) <= 1
    assert max(tokens.values()) - min(tokens.values()) <= 2 * sum(packing.TIERS)


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []
