"""The training-data operators against brute force, with nulls, empties, ties and extra columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm import (
    components,
    decision_list,
    decontaminate,
    html_template,
    language_id,
    mixing,
    ppm,
    queries,
    sharding,
    suffix_dedup,
    superminhash,
    token_counts,
)
from waymark.llm.shingles import shingle_set

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, copies int, row string"


def word(rng, letters="abcdefg"):
    return "".join(rng.choice(letters) for _ in range(rng.randint(1, 7)))


def words(rng, n):
    return " ".join(word(rng) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    base = words(rng, 120)
    out = [None, "", " \n ", "!!!", "é", "a", base, base, base.upper(), words(rng, 20_000), "x" * 50_000]
    for k in range(30):
        t = base.split()
        t[rng.randrange(len(t))] = f"edit{k}"
        out.append(" ".join(t))
    return out + [words(rng, rng.randint(1, 200)) for _ in range(40)] + ["the " * 300]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 4}" if i % 9 else None, None, -1, -1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[6], rows[0]], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(docs):
    """Rows of ``docs`` with some without an id, repeated too."""
    nameless = docs.where("doc_id in (0, 1, 6, 9, 20)").withColumn("doc_id", F.lit(None).cast("long"))
    return docs.unionByName(nameless).unionByName(nameless.where("text is not null")).repartition(4)


def split(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


# --- 1 token counts


def test_token_counts_equal_the_library(docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in token_counts.count_documents(docs).collect()}
    for i, text in enumerate(texts):
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 512)


def test_token_counts_of_odd_strings():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    count, rng = token_counts.counter("byte_bpe_50k.json").count, random.Random(1)
    pool = [*map(chr, range(32, 127)), *"\t\n\r\x0b\x1c\x85\xa0é漢½😀​'", "<|endoftext|>", "'ll", "   "]
    for _ in range(1500):
        s = "".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))
        assert count(s) == len(t.encode(s, add_special_tokens=False).ids), s


# --- 2 main text

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script><style>p{}</style></head><body>
<header>H</header><div class="site-nav menu"><ul><li>m1<li>m2</ul></div><div class="main-column"><h1>One &amp;
 two</h1><p>A <b>bold<p>B&nbsp;&eacute;</b><br>C<!-- c --></div><section id="comments"><p>bad</p></section>
<aside>s</aside><form><p>f</p></form><div class="cookie-notice">n</div><footer>F</footer></body></html>"""


def test_main_text():
    assert html_template.main_text(PAGE, None) == "One & two A bold B é C"
    assert html_template.main_text(None, None) == html_template.main_text("", None) == ""
    assert html_template.main_text("plain < text", None) == "plain < text"
    article = "<nav>x</nav><p>out</p><article><p>in</p><div class=comments>c</div></article>"
    assert html_template.main_text(article, None) == "in"
    assert html_template.main_text("<p>a" + "<div>" * 3000 + "b", None) == "a b"


def test_marks_are_whole_names_and_never_hold_the_article():
    read = html_template.main_text
    art = "<article><h2 id='related-work'>a</h2><p class='notice-period'>b</p><p title='a hidden gem' data-id='menu'>c</p></article>"
    for wrap in ("<div class='content has-sidebar'>%s</div>", "<div id='page' class='fixed-header'>%s</div>"):
        assert read(wrap % art, None) == "a b c"
    for wrap in ("<form id=aspnet>%s</form>", "<div class=widget><div hidden>%s</div></div>"):
        assert read(wrap % art, None) == "a b c"
    assert read("<div class='widget'><p>long main text</p></div><p>x</p>", None) == "long main text x"
    assert read(art + "<aside><article>t</article></aside><p hidden>no</p>", None) == "a b c"
    off = "<p>main text</p><p hidden=''>h</p><div class='site_nav'>n</div><p style='display: none'>s</p><p aria-hidden=true>r</p>"
    assert read(off, None) == "main text"


def test_templates_choose_the_slot_of_the_text(spark):
    def page(k):
        side = "".join(f"<p>teaser {k} {j}</p>" for j in range(2))
        body = "".join(f"<p>{'story %d %d ' % (k, j) * 20}</p>" for j in range(5))
        return f"<html><body><div class='left'>{side}</div><div class='mid'>{body}</div></body></html>"

    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(6)] + [(6, None, page(6)), (7, "http://h.example/x", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))
    got = {r.page_id: r.text for r in html_template.extract_pages(pages).collect()}
    assert len(got) == 8 and "teaser" not in got[0] and got[0].startswith("story 0 0")
    assert "teaser" in got[6] and got[7] == ""
    assert html_template.extract_pages(pages.limit(0)).count() == 0


def plain_pages(n):
    """Pages whose elements are all alike in name: long texts that repeat, short stories that don't."""
    rng = random.Random(12)
    sides = [words(rng, 60) for _ in range(2)]
    for k in range(n):
        story = f"<h1>{words(rng, 4)} {k}</h1>" + "".join(f"<p>{words(rng, 12)}</p>" for _ in range(rng.randint(1, 5)))
        text = " ".join(story.replace("<h1>", " ").replace("</h1>", " ").replace("<p>", " ").replace("</p>", " ").split())
        yield k, f"http://h.example/{k}", f"<body><div>home {k % 3}</div><div>{sides[k % 2]}</div><div>{story}</div><div>end</div></body>", text


def test_templates_work_without_names(spark):
    rows = list(plain_pages(24))
    pages = spark.createDataFrame([r[:3] for r in rows] + [rows[0][:3]], "page_id long, url string, html string")
    got = html_template.extract_pages(pages.repartition(3)).collect()
    assert sorted((r.page_id, r.text) for r in got) == sorted([(r[0], r[3]) for r in rows] + [(0, rows[0][3])])


def test_templates_need_occurrence_vectors(spark, monkeypatch):
    rows = list(plain_pages(24))
    pages = spark.createDataFrame([("h", r[0], r[2]) for r in rows], "host string, page long, html string")
    assert [len(r.regions) for r in html_template.host_templates(pages).collect()] == [2]
    # with one vector for all tokens classes cannot be told apart, and none is valid
    alike = pages.mapInPandas(html_template._tokens, html_template._TOKENS).withColumns({"v1": F.lit(1), "v2": F.lit(1)})
    monkeypatch.setattr(html_template, "scan_tokens", lambda pages: alike)
    assert html_template.host_templates(pages).count() == 0


def test_hosts_with_equal_pages_keep_templates_apart(spark):
    rows = list(plain_pages(12))
    both = [(r[0], f"http://{h}.example/{r[0]}", r[2]) for r in rows for h in ("a", "b")]
    other = [(100 + k, f"http://c.example/{k}", f"<body><div>{'long text here ' * 9} {k}</div><div>x</div></body>") for k in range(5)]
    pages = spark.createDataFrame(both + other, "page_id long, url string, html string")
    got = {(r.page_id, r.url): r.text for r in html_template.extract_pages(pages).collect()}
    assert all(got[r[0], f"http://{h}.example/{r[0]}"] == r[3] for r in rows for h in "ab")
    assert got[100, "http://c.example/0"].endswith("here 0")


def test_all_slots_are_extracted():
    slots = html_template.slot_texts("<body><div>a</div><div>b<p>c</p>d</div></body>", None)
    assert slots == {"*body#1/div#1": "a", "*body#1/div#2": "b d", "*body#1/div#2/p#1": "c"}
    page = html_template.parse("<body><div>a</div><div>b</div></body>")
    told = html_template.slot_texts("<body><div>a</div><div>b</div></body>", page.keys[1:2] + page.keys[3:])
    assert told == {"body#1/div#1": "a", "*body#1/div#2": "b"}
    read = html_template.main_text
    two = "<article class=post>a b c</article><article class=teaser>t</article><article class=post>d</article>"
    assert read(two, None) == "a b c d"


def test_inline_elements_off_the_main_text():
    read = html_template.main_text
    for off in ("<span class='advert'>Buy now</span>", "<span hidden>x</span>", "<b style='display:none'>x</b>", "<svg><text>x</text></svg>",
                "<canvas>x</canvas>", "<object>x</object>", "<span class=ad><i>x <b>y</b></i></span>"):
        assert read(f"<article><p>one {off}two <em>three</em></p><p>four</p></article>", None) == "one two three four"
    assert read("<p>a <span hidden>b<p>c</p>", None) == "a c"
    assert read("<body>a <span hidden>b<div>c</div></span> d</body>", None) == "a d"
    assert read("<p>in <span class='tag'>word</span>s</p>", None) == "in words"


def test_what_belongs_to_an_article_stays():
    read = html_template.main_text
    article = "<article><header><h1>Title here</h1></header><p>a</p><div class=tags>b</div><p id=related>c</p><div class=widget>d</div><footer>f</footer></article>"
    assert read(f"<body><header>site</header>{article}<div class=related>r</div></body>", None) == "Title here a b c d"
    assert read("<body><header>site</header><div class=masthead>m</div><p>long main text of it</p><div class=related>r</div></body>", None) == "long main text of it"


def neutral_pages(n, rng):
    """Pages of unnamed elements: the skeleton and two lines on all, a box on some, odd lines on others."""
    for k in range(n):
        box = "<p>box head</p><p>box foot</p>" if k % 5 < 3 else ""
        lone = "<p>now and then</p>" if k % 5 > 1 else ""
        story = [words(rng, 12) for _ in range(3)]
        body = "".join(f"<p>{x}</p>" for x in story)
        html = f"<body><div><p>Get our letter every week</p>{body}<div>{box}</div><section>{lone}</section><p>Written by our staff</p></div></body>"
        yield k, f"http://h.example/{k}", html, story, bool(lone)


def test_texts_of_the_template_are_taken_out(spark, monkeypatch):
    """Two lines on every page and a box of two on three pages in five are template; a lone line on as
    many pages is a class of its own, too small.  So grouping by vectors decides."""
    rows = list(neutral_pages(20, random.Random(3)))
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_template.extract_pages(pages).collect()}
    for k, _, _, story, lone in rows:
        assert got[k] == " ".join(story + ["now and then"] * lone)
    merged = pages.select(F.lit("h.example").alias("host"), F.xxhash64("page_id", "url").alias("page"), "html")
    alike = merged.coalesce(1).mapInPandas(html_template._tokens, html_template._TOKENS)
    # one vector for all tokens of equal count: the lone line is taken for part of the box
    one = alike.withColumns({"v1": F.lit(1), "v2": F.lit(1)})
    monkeypatch.setattr(html_template, "scan_tokens", lambda pages: one)
    monkeypatch.setattr(html_template, "same_pages", lambda rows: F.lit(True))
    got = {r.page_id: r.text for r in html_template.extract_pages(pages).collect()}
    assert not any("now and then" in t for t in got.values())


def test_copies_of_an_article_are_no_template(spark):
    rng = random.Random(6)
    story = "".join(f"<p>{words(rng, 15)}</p>" for _ in range(4))
    own = ["".join(f"<p>{words(rng, 15)}</p>" for _ in range(4)) for _ in range(10)]
    for copies, others in ((4, 6), (10, 0)):
        bodies = [story] * copies + own[:others]
        rows = [(k, f"http://h.example/{k}", f"<body><div>{b}</div></body>") for k, b in enumerate(bodies)]
        got = {r.page_id: r.text for r in html_template.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        assert got == {k: " ".join(b.replace("</p>", "").replace("<p>", " ").split()) for k, b in enumerate(bodies)}


# --- 3 quality rules


def brute_counts(text):
    ws = split(text)
    wins = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    rep = {i + j for i in range(len(ws) - 7) if wins[tuple(ws[i : i + 8])] > 1 for j in range(8)}
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dups += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in ws)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>") if ws else 0
    return len(ws), chars, symbols, dups, len(rep)


def test_quality_counts(texts):
    more = ["a\na\n \nb\na", "x y z " * 9, "# * a|b c\x1cd"]
    for t in [*texts, *more]:
        assert decision_list.text_counts(t)[:5] == brute_counts(t)


def test_quality_rules_learn_and_judge(spark, sf_dir, docs, empty):
    d, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    out = decision_list.judge_documents(d, labels).join(labels, "doc_id").toPandas()
    right = (out.kept == (out.quality == 1)) | out.base_failed
    assert right.mean() > 0.9 and out[out.quality == 1].kept.mean() > 0.9
    assert decision_list.judge_documents(docs, labels.limit(0)).where("kept = base_failed").count() == 0
    assert decision_list.judge_documents(empty, labels).count() == 0


def test_rules_are_conjunctions_in_order():
    rng = np.random.default_rng(0)
    rows = {"a": rng.random(900), "b": rng.random(900)}
    bad = (rows["a"] > 0.7) & (rows["b"] <= 0.4)
    rules = decision_list.learn_rules(rows, bad)
    hit = np.zeros(900, dtype=bool)
    for r in rules:
        hit |= decision_list.covered(r, rows, 900)
    assert (hit == bad).mean() > 0.97 and max(map(len, rules)) >= 2


# --- 4 language


def test_word_probabilities_sum_to_at_most_one():
    import itertools

    model = language_id.fit_language({"aba": 3, "abc": 2, "b": 1}, 3)
    ws = ["".join(x) for n in range(1, 7) for x in itertools.product("abc", repeat=n)]
    mass = np.exp(language_id.word_scores(ws, language_id.Tables([model]))[:, 0]).sum()
    assert 0.8 < mass <= 1.0 + 1e-9


def brute_kneser_ney(counts, order):
    """A word's probability by interpolated Kneser-Ney from plain dictionaries."""
    start, end = "<s>", "</s>"
    grams = [Counter() for _ in range(order + 1)]
    for w, n in counts.items():
        s = [start, *w, end]
        for i in range(1, len(s)):
            for k in range(1, min(order, i + 1) + 1):
                grams[k][tuple(s[i - k + 1 : i + 1])] += n
    left = [{} for _ in range(order + 2)]
    for k in range(2, order + 1):
        for g in grams[k]:
            left[k - 1].setdefault(g[1:], set()).add(g[0])
    tables = [{} for _ in range(order + 1)]
    for k in range(1, order + 1):
        for g, n in grams[k].items():
            tables[k][g] = n if k == order or g[0] == start else len(left[k].get(g, ()))

    def prob(context, symbol):
        p = language_id._FLOOR
        for k in range(1, len(context) + 2):
            c = context[len(context) - k + 1 :]
            table = {g: n for g, n in tables[k].items() if g[:-1] == c}
            ones, twos = (sum(n == x for n in tables[k].values()) for x in (1, 2))
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            total = sum(table.values())
            if total:
                n = table.get((*c, symbol), 0)
                p = max(n - d, 0) / total + d * len(table) / total * p
        return p

    def score(word):
        s = [start, *word, end]
        return sum(math.log(prob(tuple(s[max(0, i - order + 1) : i]), s[i])) for i in range(1, len(s)))

    return score


def test_word_probabilities_are_those_of_plain_kneser_ney():
    rng = random.Random(2)
    languages = [{word(rng, letters): rng.randint(1, 4) for _ in range(150)} for letters in ("abc", "bcdé")]
    models = [language_id.fit_language(c, 4) for c in languages]
    ws = [*list(languages[0])[:20], *list(languages[1])[:20], "zz", "a", "cabcab", "ébd"]
    got = language_id.word_scores(ws, language_id.Tables(models))
    for m, counts in enumerate(languages):
        score = brute_kneser_ney(counts, 4)
        assert np.allclose(got[:, m], [score(w) for w in ws])


def test_language_id(spark, sf_dir, docs, empty):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = language_id.predict_documents(d).join(d, "doc_id").toPandas()
    held = out[out.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.95 and out.score.between(0, 1).all()
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in zip(out.doc_id, out.held_out))
    odd = {r.doc_id: r for r in language_id.predict_documents(docs).collect()}
    assert {odd[i].lang_pred for i in range(4)} == {"und"} and odd[6].lang_pred in ("en", "de")
    assert language_id.predict_documents(empty).count() == 0


def test_tables_of_unlike_languages_are_sparse():
    rng = np.random.default_rng(3)
    own = []
    for m in range(30):
        keys = np.unique(rng.integers(0, 5000, 60).astype(np.uint64) + np.uint64(10_000 * m * (m % 3 > 0)))
        own.append((keys, rng.random(len(keys))))
    asked = rng.integers(0, 400_000, 3000).astype(np.uint64)
    asked[::2] = rng.choice(np.concatenate([k for k, _ in own]), 1500)
    for missing in (0.0, 1.0):
        dense, sparse = (language_id.Table(own, missing, d) for d in (True, False))
        assert np.array_equal(dense.find(asked), sparse.find(asked))
        assert (dense.find(asked) != missing).any()
    assert language_id.Table(own, 0.0).rows is None and language_id.Table(own[:1], 0.0).rows is not None


def test_dirty_labels_do_not_grow_the_model(spark):
    rng = random.Random(8)
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    rows = [(i, " ".join(word(rng, alphabets[k]) for _ in range(40)), k) for i in range(300) for k in [rng.choice(list(alphabets))]]
    rows += [(1000 + i, "zz zz", f"junk {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, languages=3)
    assert model.languages == ["aa", "bb", "cc"]
    assert list(model.predict(["abc cab", "kol mon", None]).lang) == ["aa", "cc", "und"]


# --- 5 shards


@pytest.mark.parametrize("n", [1, 8, 200])
def test_shards_are_contiguous_and_even(docs, n):
    rows = sharding.shard_documents(docs, n).toPandas().sort_values(["doc_id", "size", "text_crc32"])
    assert len(rows) == docs.count() and rows["shard"].is_monotonic_increasing
    total, largest = rows["size"].sum(), rows["size"].max()
    for _, part in rows.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
        assert abs(part["size"].sum() - total / n) <= 2 * largest


def test_no_shards(empty):
    assert sharding.shard_documents(empty).count() == 0


# --- 6 near duplicates


def brute_groups(ids, texts, k):
    sets = {i: {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set()) for i, w in ((i, split(t, True)) for i, t in zip(ids, texts))}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(ids)
    for a in order:
        for b in order:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(docs, texts, empty, k):
    expected = brute_groups(range(len(texts)), texts, k)
    got = superminhash.near_duplicates(docs, k).collect()
    assert len(got) == docs.count()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == expected
    exact = superminhash.near_duplicates(docs, k, sketches=False).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in exact} == expected
    assert superminhash.near_duplicates(empty).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    error = []
    for n in (20, 300, 900):
        x = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        a, b = x[: n + n // 3], x[n // 3 :]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        same = (superminhash.super_min_hash(a) == superminhash.super_min_hash(b)).mean()
        error.append(abs(true - same))
    assert max(error) < 0.15


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(200, 201), (201, 200), (3, 7)]
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(7, 60)} == {3} and got[201] == 200


# --- 7 repeated strings


def brute_repeats(texts, width):
    data = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - width + 1):
            if times[b[i : i + width]] > 1:
                gone[i : i + width] = True
        runs = int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_long_texts_are_scanned_block_by_block(monkeypatch):
    data = np.frombuffer(words(random.Random(1), 900).encode(), np.uint8)

    def anchors():
        first, last, place, anchor, _ = suffix_dedup.segments(data, 200)
        return [(i, f + p, a) for f, e, p, a in zip(first, last, place, anchor) for i in range(f, e + 1)]

    whole = anchors()
    assert [i for i, _, _ in whole] == list(range(len(data) - 199))
    for starts in (1, 64, 500):
        monkeypatch.setattr(suffix_dedup, "SCAN_STARTS", starts)
        assert anchors() == whole


@pytest.mark.parametrize("width, bucket", [(400, 256), (200, 3), (200, 12), (200, 0)])
def test_repeats(spark, monkeypatch, width, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET_SEGMENTS", bucket)
    rng = random.Random(9)
    passages = [words(rng, 130) for _ in range(5)]
    texts = [None, "", "x" * 1500, "x" * 900, "ab" * 700, "é" * 300]
    for _ in range(80):
        parts = [words(rng, rng.randint(0, 50))]
        for _ in range(rng.randint(0, 3)):
            p = list(rng.choice(passages))[rng.randint(0, 60) :]
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = "Z"
            parts += ["".join(p), words(rng, rng.randint(0, 30))]
        texts.append(" ".join(parts))
    texts += texts[10:13]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = suffix_dedup.remove_documents(df, width).toPandas().sort_values("doc_id")
    got = list(zip(rows.n_bytes, rows.n_removed, rows.n_spans, rows.kept_sha256))
    assert got == brute_repeats(texts, width)
    assert suffix_dedup.remove_documents(df.limit(0)).count() == 0


def test_repeats_with_odd_ids_and_columns(spark):
    rng = random.Random(3)
    a, b = words(rng, 150), words(rng, 150)
    rows = [("x", a), ("x", a), (None, b), (None, b), (None, None), ("y", "é" + b), ("z", words(rng, 200))]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "doc_id string, text string, k1 int, k2 int, first int, ranges int")
    got = suffix_dedup.remove_documents(df).collect()
    told = brute_repeats([r[1] for r in rows], 400)
    assert sorted((r.doc_id or "", r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(
        (r[0] or "", *t) for r, t in zip(rows, told)
    )


def test_the_cover_reaches_every_pair():
    cover = set(suffix_dedup.difference_cover(100).tolist())
    for d in range(100):
        assert any((a + d) % 100 in cover for a in cover)


# --- 8 partial matching


def test_trie_is_a_distribution():
    grams, _ = ppm.positions([b"abc", b"abd", b"ab", b"xa"], 2)
    keys, n = np.unique(grams, return_counts=True)
    model = ppm.ByteModel.fit(keys, n.astype(float), 2)
    for context in (b"ab", b"  ", b"zz", b"xa"):
        code = context[0] << 16 | context[1] << 8
        p = 10 ** model.score(np.array([code | s for s in range(256)], dtype=np.uint64))
        assert 0.99 < p.sum() <= 1.0 and (p > 0).all()


def test_a_worker_holds_tables_only():
    """A shipped language model drops its arrays once they are tables, and looks words up in slices."""
    import pickle

    import numpy as np

    from waymark.llm import language_id as L

    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdef"), rng.integers(1, 9))) for _ in range(L.SLICE_WORDS + 500)]
    models = [L.fit_language(dict.fromkeys(words[k::2], 1)) for k in range(2)]
    own = L.Identifier(["a", "b"], models, np.zeros(2), np.zeros(2))
    shipped = pickle.loads(pickle.dumps(own))
    assert shipped.models == [] and len(own.models) == 2
    texts = [" ".join(words), "abc def", "", None]
    told, want = shipped.predict(texts), own.predict(texts)
    assert told.equals(want)
    whole = L.word_scores(list(dict.fromkeys(words)), own._tables)
    at = [shipped._rows[w] for w in dict.fromkeys(words)]
    assert np.allclose(shipped._table[at], whole, atol=1e-6)


def test_scores(docs, texts, empty):
    out = ppm.score_documents(docs, chunk_bytes=20_000).toPandas().drop_duplicates("doc_id").set_index("doc_id")
    toks = {i: [*split(t, True), b"\n"] for i, t in enumerate(texts)}
    counts = Counter()
    for i in [*toks, 6, 0]:
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(toks[i])
    n, v = sum(counts.values()), len(counts)
    for i, ws in toks.items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        r = out.loc[i]
        assert (r.n_tokens, r.train_tokens, r.n_known) == (len(ws), n, sum(counts[w] > 0 for w in ws))
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    assert ppm.score_documents(empty).count() == 0


def brute_ppm(data, learnt, order=ppm.ORDER):
    """log10 probability of bytes after PPM with exclusion over learnt sequences, symbol by
    symbol from plain dictionaries of contexts."""
    tables = [{} for _ in range(order + 1)]
    for seq in learnt:
        for i in range(order, len(seq)):
            for k in range(order + 1):
                tables[k].setdefault(seq[i - k : i], Counter())[seq[i]] += 1
    total = 0.0
    for i in range(order, len(data)):
        if data[i - 1 : i + 1] == b"  ":
            continue  # padding
        gone, p = set(), 1.0
        for k in range(order, -1, -1):
            seen = {c: n for c, n in tables[k].get(data[i - k : i], {}).items() if c not in gone}
            whole = sum(seen.values())
            if data[i] in seen:
                p *= (seen[data[i]] - ppm.ESCAPE) / whole
                break
            if seen:
                p *= ppm.ESCAPE * len(seen) / whole
            gone |= set(tables[k].get(data[i - k : i], {}))
        else:
            p /= 257 - len(gone)
        total += math.log10(p)
    return total


def scored(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id: r for r in ppm.score_documents(df, chunk_bytes=20_000).collect()}


def padded(text):
    return b" " * ppm.ORDER + b" ".join([*ppm.tokens(text), b""])


def test_packets_are_read_back():
    rng = np.random.default_rng(3)
    for kind in (np.uint32, np.uint64):
        for values in (rng.integers(0, 1 << 31, 500).astype(kind), np.empty(0, kind), np.array([np.iinfo(kind).max, 0], kind)):
            assert np.array_equal(ppm.unpack(ppm.pack(values), kind), values)
    grams = rng.integers(0, 1 << 48, 500, dtype=np.uint64)
    assert np.array_equal(ppm.to_grams(ppm.to_codes(grams)), grams)


def test_slices_have_the_positions_of_the_whole(monkeypatch):
    rng = random.Random(5)
    flat = [w for n in (1, 0, 30, 2, 50) for w in ppm.tokens(words(rng, n))]
    grams, ends = ppm.positions(flat)
    for size in (1, 2, 7, 1000):
        monkeypatch.setattr(ppm, "_SLICE_TOKENS", size)
        parts = list(ppm._sliced(flat))
        assert np.array_equal(np.concatenate([g for g, _ in parts]), grams)
        before = np.cumsum([0] + [len(g) for g, _ in parts])
        assert np.array_equal(np.concatenate([e + b for (_, e), b in zip(parts, before)]), ends)


@pytest.mark.parametrize("share", [4096, 2])
def test_scores_are_those_of_plain_partial_matching(spark, share):
    rng = random.Random(6)
    texts = [None, "", " ", *(words(rng, rng.randint(1, 60)) for _ in range(60)), "zq\u4e16\u754c qqz~1 ~2", words(rng, 900)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in ppm.score_documents(df, chunk_bytes=1000, group_chunks=share).collect()}
    assert len(got) == len(texts) and any(r.held_out for r in got.values())
    learnt = [padded(t) for i, t in enumerate(texts) if not got[i].held_out]
    for i in [0, 1, 7, 20, 63, 64, *[i for i, r in got.items() if r.held_out][:4]]:
        s = brute_ppm(padded(texts[i]), learnt)
        assert abs(got[i].score - s) < 1e-5 * max(1, abs(s)), i


def test_contexts_run_over_words(spark):
    grams, ends = ppm.positions([b"ab", b"c", ppm.END, b"d", ppm.END], 2)
    assert [int(g).to_bytes(3, "big") for g in grams] == [
        b"  a", b" ab", b"ab ", b"b c", b" c ", b"c \n", b" \n ", b"  d", b" d ", b"d \n", b" \n "
    ]
    assert ends.tolist() == [3, 5, 7, 9, 11]
    told = "every traveller leaves home quite early"
    turned = " ".join(reversed(told.split()))
    rows = scored(spark, [told] * 40 + [turned])
    assert rows[0].n_tokens == rows[40].n_tokens and rows[0].score > rows[40].score + 1


def test_no_gram_is_left_out_however_many_there_are():
    assert not hasattr(ppm, "MAX_GRAMS")
    rng = np.random.default_rng(5)
    grams = np.unique(rng.integers(0, 1 << 48, 1_200_000, dtype=np.uint64))
    low, n = np.unique(grams & np.uint64((1 << 24) - 1), return_counts=True)
    base = ppm.ByteModel.fit(low, n.astype(float), ppm.LOW_ORDER)
    buckets, order = ppm.by_context(grams, 4)
    whole = ppm.ByteModel.fit(grams, np.ones(len(grams)))
    for b, s in list(ppm._slices(buckets))[:2]:
        mine = np.sort(grams[order[s]])
        part = ppm.ByteModel.fit(mine, np.ones(len(mine)), base=base)
        assert len(part.grams[ppm.ORDER]) == len(mine) and np.allclose(part.score(mine), whole.score(mine))


# --- 9 mixing


def test_mixture(spark, docs, empty):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 40), [None, "a", "b", "c", "é"][min(i % 9, 4)]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_documents(df).toPandas()
    assert len(out) == 3000 and (out["taken"] <= 3 * out["size"]).all()
    sizes = out.groupby("source", dropna=False)["size"].sum()
    total = sizes.sum()
    weight = dict(zip(["a", "b", "c", "é", None], [1, 2, 3, 1, 2]))
    target = {k: 0.0 for k in weight}
    open_, left = set(weight), float(total)
    while left > 1e-6:  # share, stop at three times, share the excess again
        w = sum(weight[k] for k in open_)
        gain = {k: left * weight[k] / w for k in open_}
        left = 0.0
        for k, g in gain.items():
            size = sizes[sizes.index.isna()].sum() if k is None else sizes[k]
            room = 3 * size - target[k]
            target[k] += min(g, room)
            left += max(0.0, g - room)
            if g >= room:
                open_.discard(k)
    for k, part in out.groupby("source", dropna=False):
        k = k if isinstance(k, str) else None
        assert abs(part["target"].iloc[0] - target[k]) < 1e-3 and abs(part["taken"].sum() - target[k]) <= 40
    again = mixing.mix_documents(df.repartition(7)).toPandas()
    assert dict(zip(out.doc_id, out.taken)) == dict(zip(again.doc_id, again.taken))
    assert mixing.mix_documents(docs).count() == docs.count() and mixing.mix_documents(empty).count() == 0


# --- 10 contamination


def test_windows_found(spark, empty):
    rng = random.Random(3)
    items = [(i, None if i == 0 else " ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 4, 13, 15])))) for i in range(12)]
    items += [(12, items[5][1]), (None, "n u l l"), (None, "")]
    texts = [None, "", "A-b.c", "x n u L L y n u l", "n u l l", "n u l l"] + [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 120))) for _ in range(60)]
    texts += [f"x {items[k][1]} y" for k in range(1, 12)]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.decontaminate_documents(df, bench).collect()}
    for i, t in enumerate(texts):
        ws, hit, found = decontaminate.words(t), set(), set()
        for item, text in items:
            w = decontaminate.words(text)
            n = min(13, len(w))
            for a in range(len(w) - n + 1 if w else 0):
                for p in range(len(ws) - n + 1):
                    if ws[p : p + n] == w[a : a + n]:
                        hit |= set(range(p, p + n))
                        if item is not None:
                            found.add(str(item))
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(ws), len(hit), len(found), decontaminate.digest(list(found)))
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(ws))
    small = decontaminate.find_hits(df, bench, block_words=25).collect()

    def told(rows):
        return {r.doc_id: (r.n_words, [tuple(s) for s in r.hit_spans], sorted(r.hit_items)) for r in rows}

    assert len(small) == len(texts) and told(small) == told(decontaminate.find_hits(df, bench).collect())
    assert decontaminate.decontaminate_documents(empty, bench).count() == 0
    assert decontaminate.decontaminate_documents(df, bench.limit(0)).where("n_hit > 0").count() == 0


def test_spans_are_cut(spark):
    bench = spark.createDataFrame([("q", "two Words")], "item_id string, text string")
    df = spark.createDataFrame([(1, "Keep, (TWO words) and éne.", 1), (2, None, 1)], "doc_id long, text string, hits int")
    out = decontaminate.remove_spans(decontaminate.find_hits(df, bench)).collect()
    assert {r.doc_id: r.clean_text for r in out} == {1: "Keep, () and éne.", 2: None}


# --- rows without id, repeated rows, nulls and clashing names


def test_rows_without_id(odd, docs, spark, sf_dir):
    n, nameless = odd.count(), odd.where("doc_id is null").count()
    assert nameless == 12
    labels = spark.createDataFrame([(1, 0), (6, 1), (6, 0), (None, 1), (9, None), (9, 1), (77777, 0)], "doc_id long, quality int")
    made = {
        1: token_counts.count_documents(odd),
        3: decision_list.judge_documents(odd, labels),
        4: language_id.predict_documents(odd),
        5: sharding.shard_documents(odd),
        6: superminhash.group_documents(odd),
        7: suffix_dedup.remove_documents(odd),
        8: ppm.score_documents(odd, chunk_bytes=50_000),
        9: mixing.mix_documents(odd),
        10: decontaminate.decontaminate_documents(odd, spark.read.parquet(f"{sf_dir}/benchmark.parquet")),
    }
    rows = {k: df.collect() for k, df in made.items()}
    for k, got in rows.items():
        assert len(got) == n and sum(r.doc_id is None for r in got) == nameless, k
        assert len(set(got[0].asDict())) == len(got[0]), k
    placed = ("shard", "slot", "taken", "copies")  # these tell repeated rows apart
    for k, got in rows.items():
        told = [{c: v for c, v in r.asDict().items() if c not in placed} for r in got if r.doc_id == 6]
        assert len(told) == 2 and told[0] == pytest.approx(told[1]), k
    assert all(r.held_out for k in (4, 8) for r in rows[k] if r.doc_id is None)
    assert all(r.kept and r.component_id is None for r in rows[6] if r.doc_id is None)
    assert all(r.taken <= 3 * r.size for r in rows[9])
    again = mixing.mix_documents(odd.repartition(9)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows[9]))


def test_no_tokens(empty):
    assert token_counts.count_documents(empty).count() == 0


def test_odd_pages(spark):
    rows = [(None, None, None), (1, None, "<p>a</p>"), (1, None, "<p>a</p>"), (2, "http://h/", ""), (3, "no host", "<b"), (4, "http://h/x", "x" * 300_000)]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, text int, regions int")
    got = html_template.extract_pages(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 0), (3, 0), (4, 300_000)]


def test_rules_hold_for_documents_that_did_not_teach(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    out = decision_list.judge_documents(d, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    right = (out.kept == (out.quality == 1)) | out.base_failed
    assert len(out) > 100 and right.mean() > 0.9 and out[out.quality == 1].kept.mean() > 0.9


def test_rules_do_not_hang_on_the_order_of_rows(spark, odd):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 2, "doc_id long, quality int")
    made = [
        decision_list.fit(decision_list.with_statistics(decision_list.with_counts(odd.repartition(k))), labels.repartition(k), 10)
        for k in (1, 5)
    ]
    assert made[0] == made[1]


# --- queries and shared pieces


def test_short_texts_are_one_shingle():
    assert len(shingle_set("a b c", 4)) == 1 and len(shingle_set(None, 4)) == len(shingle_set(" ", 4)) == 0
    assert shingle_set("a b", 4)[0] != shingle_set("a b c", 4)[0]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    from compare import connect, spark_rows, sql_rows

    assert spark_rows(queries.queries()[name](spark, sf_dir)) == sql_rows(connect(sf_dir), queries.SQL[name])


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
