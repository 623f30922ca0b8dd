"""The pipeline's stages on planted documents, and its rows as a whole."""

import hashlib
import random
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from waymark.llm import decontaminate, mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, language string, size string, row long"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(8)
    item = sentence(rng, 30)
    clean = [sentence(rng, rng.randint(30, 200)) for _ in range(60)]
    near = clean[3].split()
    near[5] = "changed"
    texts = [*clean, clean[0], clean[0], " ".join(near), f"{sentence(rng, 20)} {item}", "!!! 123", None, ""]
    rows = [(i, t, "en", f"s{i % 3}", 1, "x", "y", 7) for i, t in enumerate(texts)]
    folder = tmp_path_factory.mktemp("sf")
    docs = spark.createDataFrame([*rows, rows[9]], SCHEMA).repartition(2)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, str(folder), texts


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_stages(spark, planted):
    docs, folder, texts = planted
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
    stage = dict(corpus_pipeline.STAGES)
    told = stage["language_id"](spark, docs, folder)
    assert ids(told) == sorted([*range(64), 9])
    deduped = stage["near_dedup"](spark, told, folder)
    assert ids(deduped) == [*range(60), 63]
    clean = stage["decontamination"](spark, deduped, folder)
    assert ids(clean) == [*range(60)]
    mixed = stage["mixing"](spark, clean, folder)
    assert set(ids(mixed)) <= set(range(60)) and mixed.columns == docs.columns
    expected = {r.doc_id: r.copies for r in mixing.mix_documents(clean).collect()}
    got = ids(mixed)
    assert all(got.count(i) == n for i, n in expected.items())
    sharded = stage["sharding"](spark, mixed, folder).collect()
    assert len(sharded) == len(got) and {r.shard for r in sharded} == set(range(8))
    for df in (told, deduped, clean):
        assert df.columns == docs.columns
    hit = decontaminate.with_verdict(decontaminate.find_hits(deduped, spark.read.parquet(f"{folder}/benchmark.parquet")))
    assert [r.doc_id for r in hit.where("contaminated").collect()] == [63]


def test_rows_without_id_are_near_copies_too(spark):
    rng = random.Random(2)
    a, b, c = ([sentence(rng, 1) for _ in range(100)] for _ in range(3))
    texts = [(7, a), (None, a), (None, c), (None, c), (9, c), (None, b), (None, b)]
    rows = [(i, " ".join(t), "en", "s", 1, "x", "y", 7) for i, t in texts]
    rows += [(i, "", "en", "s", 1, "x", "y", 7) for i in (3, 3, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, len(r.text) > 0) for r in kept) == [
        (False, 3, False), (False, 7, True), (False, 9, True), (True, 0, False), (True, 0, False), (True, 0, True)
    ]


def test_run_and_empty_tables(spark, planted, tmp_path):
    _, folder, _ = planted
    assert corpus_pipeline.run(spark, folder).count() > 0
    for n in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{n}.parquet").limit(0).write.parquet(f"{tmp_path}/{n}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def brute_mix(rows):
    """(index, copies) of rows (doc_id, text, source): shares by weight, at most three times,
    whole documents in the order of a hash."""
    sizes = [len((t or "").encode().split()) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows if s is not None}) + [None] * any(s is None for _, _, s in rows)
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    own = {s: sum(n for n, r in zip(sizes, rows) if r[2] == s) for s in names}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes))
    while left > 1e-9 and open_:
        whole, rest = sum(weight[s] for s in open_), 0.0
        for s in sorted(open_, key=str):
            gain = left * weight[s] / whole
            room = 3 * own[s] - target[s]
            target[s] += min(gain, room)
            rest += max(0.0, gain - room)
        open_ = {s for s in open_ if target[s] < 3 * own[s] - 1e-9}
        left = rest
    copies = [0] * len(rows)
    for s in names:
        mine = [i for i, r in enumerate(rows) if r[2] == s]
        mine.sort(key=lambda i: (hashlib.md5(f"mix:{rows[i][0]}".encode()).hexdigest(), sizes[i]))
        epochs = int(target[s] // own[s]) if own[s] else 0
        part, end = target[s] - epochs * own[s], 0
        for i in mine:
            end += sizes[i]
            copies[i] = min(3, epochs + (sizes[i] > 0 and end - sizes[i] / 2 < part))
    return copies


def test_run_is_what_its_stages_say(spark, planted):
    """The whole pipeline against plain Python; only the language model's verdict is taken
    from the stage, which keeps all but texts without letters here."""
    docs, folder, texts = planted
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first().text.split()
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (r[1].split() for r in rows)]
    group = list(range(len(rows)))
    for _ in rows:  # labels spread until nothing changes
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 80 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    first = {}
    for i, g in enumerate(group):
        if g not in first or rows[i][0] < rows[first[g]][0]:
            first[g] = i
    kept = [rows[i] for i in first.values()]
    windows = {tuple(item[i : i + 13]) for i in range(len(item) - 12)}

    def share(text):
        w = text.split()
        hit = {j for i in range(len(w) - 12) if tuple(w[i : i + 13]) in windows for j in range(i, i + 13)}
        return 20 * len(hit) >= len(w) and len(hit) > 0

    kept = [r for r in kept if not share(r[1])]
    mixed = sorted(
        (r[0], len(r[1].encode()) + 1, zlib.crc32(r[1].encode())) for r, n in zip(kept, brute_mix(kept)) for _ in range(n)
    )
    total, upto, slots, told = sum(m[1] for m in mixed), 0, Counter(), []
    for doc, size, crc in mixed:
        upto += size
        shard = min(7, (2 * upto - size) * 8 // (2 * total))
        told.append((doc, size, crc, shard, slots[shard]))
        slots[shard] += 1
    got = [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got) == sorted(told)


def test_run_with_nulls_and_long_texts(spark, planted, tmp_path):
    docs, folder, _ = planted
    rng = random.Random(1)
    long, other = sentence(rng, 30_000), sentence(rng, 50)
    more = [(None, long, None, None), (None, long, "en", "s1"), (5000, long, "en", "s1"), (None, other, None, None), (None, None, None, None), (5001, None, "de", None)]
    rows = spark.createDataFrame([(i, t, g, s, 1, "x", "y", 7) for i, t, g, s in more], SCHEMA)
    docs.unionByName(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, spark.read.parquet(f"{folder}/benchmark.parquet").first().text), (None, "zz zz zz"), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)
    told = stage["language_id"](spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    deduped = stage["near_dedup"](spark, told, str(tmp_path)).collect()
    assert [r.doc_id for r in deduped if r.text == long] == [5000]
    assert [r.doc_id for r in deduped if r.text == other] == [None]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(r["size"] == len(long) + 1 for r in out) > 0 and {r.shard for r in out} <= set(range(8))
