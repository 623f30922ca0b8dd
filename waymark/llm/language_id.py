"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.shingles import STEP, mix
from waymark.llm.storage import materialize

ORDER = 5
#: Characters per language, as expected, of the sampled labelled documents that fit a model.
SAMPLE_CHARS = 4_000_000
#: Languages that are learned, those with the most characters, and characters of all their
#: samples together: what bounds the models that the driver and each worker hold.
MAX_LANGUAGES, ALL_SAMPLES = 256, 64_000_000
UNKNOWN = "und"
_RUNS = re.compile(r"[^\W\d_]+").findall
_START, _END = 0x110000, 0x110001
#: Probability of a character that a language's sample never has.
_FLOOR = 1e-4
CACHE_WORDS = 1 << 17
#: Words that are looked up at a time.
SLICE_WORDS = 1 << 14


def letter_runs(text: str | None) -> list[str]:
    """Lower-cased runs of letters; null has none."""
    if not text:
        return []
    found = _RUNS(text.lower())
    return found if text.isascii() else [w for w in found if any(map(str.isalpha, w))]


def held_out(doc_id: Column, parts: int) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo ``parts``; so does a null id."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % parts
    return F.coalesce(rest == 0, F.lit(True))


@dataclass
class LanguageModel:
    """Per order k: sorted hashes of k-grams with their discounted shares, and sorted
    hashes of (k-1)-symbol contexts with the weight of the next lower order."""

    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)


class Places:
    """All places of some words at which a symbol - a letter or a word's end - is told.

    ``inside`` is the place in its word, 1 for the first letter; ``word`` is its number.
    """

    def __init__(self, words: list[str]):
        joined = "\n".join(["", *words, ""]).encode("utf-32-le", "surrogatepass")
        self.seen = np.frombuffer(joined, np.uint32).astype(np.uint64)
        breaks = np.flatnonzero(self.seen == 10)
        self.starts, self.ends = breaks[:-1], breaks[1:]
        # a break is read as a word's end when it is told and as a start when it is context
        self.told = self.seen.copy()
        self.seen[breaks], self.told[breaks] = _START, _END
        sizes = np.diff(breaks)
        self.inside = np.zeros(len(self.seen), dtype=np.int64)
        self.inside[1:] = np.arange(1, len(self.seen)) - np.repeat(self.starts, sizes)
        self.word = np.concatenate(([0], np.repeat(np.arange(len(words)), sizes)))

    def hashes(self, orders: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For k = 0, 1, ... symbols before a place: the places that have them, and hashes of
        these symbols and of them with the one there."""
        past, power = np.zeros(len(self.seen), dtype=np.uint64), np.ones(1, dtype=np.uint64)
        for k in range(orders):
            fits = np.flatnonzero(self.inside >= max(k, 1))
            before, symbol = past[fits], self.told[fits]
            gram = mix((np.uint64(k + 1) * power + before) * STEP + symbol)
            yield fits, mix(np.uint64(k) * power + before), gram
            past = past + np.roll(self.seen, k + 1) * power
            power = power * STEP


def fit_language(word_counts: dict[str, int], order: int = ORDER) -> LanguageModel:
    """Interpolated Kneser-Ney over the letters of counted words.

    The longest grams, and grams that begin a word, count their occurrences; all others
    count the distinct symbols that precede them, which are the distinct grams one symbol
    longer.  Contexts do not cross words.
    """
    at = Places(list(word_counts))
    times = np.fromiter(word_counts.values(), np.int64, len(word_counts))
    levels = list(at.hashes(order))
    model = LanguageModel()
    for k, (fits, contexts, grams) in enumerate(levels):
        counted = at.inside[fits] == k if k + 1 < order else np.ones(len(fits), dtype=bool)
        told, n = [grams[counted]], [times[at.word[fits[counted]]]]
        if k + 1 < order:
            longer, _, wider = levels[k + 1]
            _, first = np.unique(wider, return_index=True)
            told.append(grams[np.searchsorted(fits, longer[first])])
            n.append(np.ones(len(first), dtype=np.int64))
        keys, where = np.unique(np.concatenate(told), return_inverse=True)
        counts = np.bincount(where, weights=np.concatenate(n), minlength=len(keys))
        ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        some, first = np.unique(grams, return_index=True)
        context = contexts[first[np.searchsorted(some, keys)]]
        known, of = np.unique(context, return_inverse=True)
        total, kinds = np.bincount(of, weights=counts), np.bincount(of)
        model.grams.append((keys, (counts - discount) / total[of]))
        model.contexts.append((known, discount * kinds / total))
    return model


class Table:
    """Hashes of all languages in one sorted array, and each language's value for each.

    Where languages share most hashes the values are a row of one number a language; else
    each hash has a run of (language, value) pairs, so that the table grows with what the
    languages hold and not with all hashes times all languages.
    """

    def __init__(self, own: list[tuple[np.ndarray, np.ndarray]], missing: float, dense: bool | None = None):
        self.missing, self.n = missing, len(own)
        keys = np.concatenate([k for k, _ in own])
        language = np.repeat(np.arange(self.n), [len(k) for k, _ in own])
        values = np.concatenate([v for _, v in own])
        order = np.argsort(keys, kind="stable")
        self.keys, begins = np.unique(keys[order], return_index=True)
        full = 4 * len(keys) >= len(self.keys) * self.n
        self.rows = None
        if full if dense is None else dense:
            self.rows = np.full((len(self.keys) + 1, self.n), missing)
            self.rows[np.searchsorted(self.keys, keys), language] = values
        else:
            self.begins = np.append(begins, len(keys))
            self.language, self.values = language[order], values[order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """A row of one value a language for each hash."""
        known = self.keys
        if not len(known):
            return np.full((len(keys), self.n), self.missing)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        hit = known[at] == keys
        if self.rows is not None:
            return self.rows[np.where(hit, at, len(known))]
        out = np.full((len(keys), self.n), self.missing)
        where = np.flatnonzero(hit)
        first, sizes = self.begins[at[where]], self.begins[at[where] + 1] - self.begins[at[where]]
        run = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)
        out[np.repeat(where, sizes), self.language[run]] = self.values[run]
        return out


class Tables:
    """The models of all languages side by side, so that a hash is looked up once."""

    def __init__(self, models: list[LanguageModel]):
        orders = range(len(models[0].grams)) if models else ()
        self.n = len(models)
        self.grams = [Table([m.grams[k] for m in models], 0.0) for k in orders]
        self.contexts = [Table([m.contexts[k] for m in models], 1.0) for k in orders]


def word_scores(words: list[str], tables: Tables) -> np.ndarray:
    """Natural log probability of each word (its letters and its end) per language."""
    at = Places(words)
    p = np.full((len(at.seen), tables.n), _FLOOR)
    levels = at.hashes(len(tables.grams))
    for grams, contexts, (fits, before, gram) in zip(tables.grams, tables.contexts, levels):
        p[fits] = grams.find(gram) + contexts.find(before) * p[fits]
    total = np.zeros_like(p)
    np.cumsum(np.log(p[1:]), axis=0, out=total[1:])
    return total[at.ends] - total[at.starts]


@dataclass
class Identifier:
    """All languages' models with the limits beyond which a text is rejected."""

    languages: list[str]
    models: list[LanguageModel]
    mean: np.ndarray
    spread: np.ndarray

    def __post_init__(self):
        self._tables = Tables(self.models)
        self._forget()

    def _forget(self) -> None:
        self._rows: dict[str, int] = {}
        self._table, self._sizes = np.empty((0, len(self.languages))), np.empty(0)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        """In a worker only the tables are needed, so the models go when these are built."""
        self.__dict__.update(state)
        self.__post_init__()
        self.models = []

    def predict(self, texts, z: float = 8.0, slack: float = 0.3) -> pd.DataFrame:
        """lang, score, entropy, length and rejected of each text.

        The language has the lowest cross-entropy per letter (ties: the first in order).
        The score is its share among exp(-entropy * letters), letters counted up to 20.
        A text is rejected if its entropy is above its language's calibrated mean by more
        than ``slack`` and ``z`` standard errors for its length, or if it has no letter.
        """
        runs = [Counter(letter_runs(t)) for t in texts]
        if len(self._rows) > CACHE_WORDS:
            self._forget()
        new = {w for r in runs for w in r if w not in self._rows}
        if new and self.languages:
            new = list(new)
            self._rows.update(zip(new, range(len(self._rows), len(self._rows) + len(new))))
            slices = [word_scores(new[k : k + SLICE_WORDS], self._tables) for k in range(0, len(new), SLICE_WORDS)]
            self._table = np.concatenate([self._table, *slices])
            self._sizes = np.concatenate([self._sizes, [len(w) + 1 for w in new]])
        out = []
        for run in runs:
            if not run or not self.languages:
                out.append((UNKNOWN, 0.0, None, 0, True))
                continue
            n = np.fromiter(run.values(), dtype=np.float64, count=len(run))
            at = np.fromiter(map(self._rows.__getitem__, run), dtype=np.int64, count=len(run))
            length = int(n @ self._sizes[at])
            h = -(n @ self._table[at]) / length
            best = int(np.argmin(h))
            share = 1.0 / float(np.exp((h[best] - h) * min(length, 20)).sum())
            limit = self.mean[best] + slack + z * self.spread[best] / np.sqrt(length)
            out.append((self.languages[best], share, float(h[best]), length, bool(h[best] > limit)))
        return pd.DataFrame(out, columns=["lang", "score", "entropy", "length", "rejected"])


_PREDICTION = "lang string, score double, entropy double, length long, rejected boolean"


def identify(docs: DataFrame, model: Identifier, text_col: str = "text") -> Column:
    """A struct column with the prediction for each text; a map without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(_PREDICTION)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, max(len(batch), 1), 512):
                yield shared.value.predict(batch.iloc[k : k + 512])

    return predict(F.col(text_col))


def fit(
    docs: DataFrame, parts: int = 5, sample_chars: int = SAMPLE_CHARS, languages: int = MAX_LANGUAGES
) -> Identifier:
    """Learn from documents with text and lang whose id is not held out.

    Characters are totalled per language first, which gives each language the sampling
    rate that is expected to yield ``sample_chars``; documents are then taken whole by a
    hash of their id.  The ``languages`` with the most characters are learned (ties: the first
    in order), and many share ``ALL_SAMPLES`` characters, so labels that are no languages cannot
    grow the model without bound.  Nine tenths of the sample fit the models, one tenth calibrates
    rejection.  Word counts are summed in Spark and each language's model is fitted in a task;
    sorted arrays, bounded by the sample of a language, reach the driver, for as many
    languages as there are.  No language at all gives a model that answers ``und``.
    """
    usable = docs.where("text is not null and lang is not null").where(~held_out(F.col("doc_id"), parts))
    sizes = usable.groupBy("lang").agg(F.sum(F.length("text")).alias("n"))
    sizes = materialize(sizes.orderBy(F.desc("n"), "lang").limit(languages), "languages")
    names = sorted(r["lang"] for r in sizes.select("lang").collect())
    if not names:
        return Identifier([], [], np.empty(0), np.empty(0))
    wanted = min(sample_chars, ALL_SAMPLES // len(names))
    rates = sizes.select("lang", F.least(F.lit(1.0), F.lit(float(wanted)) / F.greatest(F.lit(1), "n")).alias("rate"))
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col("doc_id")), F.lit(1_000_000))
    taken = materialize(
        usable.join(F.broadcast(rates), "lang").where(draw < F.col("rate") * 1_000_000).select(
            "lang", "text", (F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id")), F.lit(10)) == 0).alias("check")
        ),
        "language-sample",
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                seen = Counter(w for t in texts for w in letter_runs(t))
                yield pd.DataFrame({"lang": lang, "word": list(seen), "n": list(seen.values())})

    def learn(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("word", kind="stable")
        model = fit_language(dict(zip(rows["word"], rows["n"])))
        return pd.DataFrame({"lang": [key[0]], "model": [pickle.dumps(model)]})

    learnt = (
        taken.where("not check")
        .select("lang", "text")
        .mapInPandas(count, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .applyInPandas(learn, "lang string, model binary")
        .collect()
    )
    models = {r["lang"]: pickle.loads(bytes(r["model"])) for r in learnt}
    names = [k for k in names if k in models]
    n = len(names)
    model = Identifier(names, [models[k] for k in names], np.zeros(n), np.zeros(n))
    if not n:
        return model
    stats = (
        taken.where("check")
        .withColumn("p", identify(taken, model))
        .where("p.lang = lang")
        .groupBy("lang")
        .agg(
            F.avg("p.entropy").alias("mean"),
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col("p.entropy") * F.col("p.entropy") * F.col("p.length")).alias("s2"),
            F.avg(F.col("p.entropy") * F.col("p.length")).alias("s1"),
            F.avg(F.col("p.length")).alias("s0"),
        )
        .collect()
    )
    # a language with too few calibration texts is never rejected
    model.mean, model.spread = np.full(n, np.inf), np.zeros(n)
    for r in stats:
        if r["n"] >= 20:
            k, mean = names.index(r["lang"]), r["mean"]
            model.mean[k] = mean
            model.spread[k] = np.sqrt(max(r["s2"] - 2 * mean * r["s1"] + mean * mean * r["s0"], 0.0))
    return model


def predict_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document.

    A null text and a text without letters are ``und`` with score 0, and rejected.  A null id
    counts as held out.  Of languages that fit equally well the first in order is told.
    Repeated rows each have a result; an empty table gives an empty result.
    """
    model = fit(docs.select("doc_id", "text", "lang"))
    return (
        docs.select("doc_id", "text")
        .withColumn("p", identify(docs, model))
        .select(
            "doc_id",
            held_out(F.col("doc_id"), 5).alias("held_out"),
            F.col("p.lang").alias("lang_pred"),
            F.col("p.score").alias("score"),
            F.col("p.rejected").alias("rejected"),
        )
    )
