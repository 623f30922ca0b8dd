"""Quality rules: a decision list learned by sequential covering from labelled statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.shingles import hash_words, run_hashes, space_words
from waymark.llm.storage import materialize

SYMBOLS = "#*$%&|<>"
#: Labelled rows that a fit may use, taken in the order of a hash of doc_id.
SAMPLE_ROWS = 20_000
#: Rows that teach, to a labelled row on average, where several documents share an id; the
#: first in the order of a hash of doc_id, label and statistics.
MAX_ROWS_PER_LABEL = 2
COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_distinct n_upper "
    "n_letters n_digits n_exclaim n_stops"
).split()
#: Statistic -> SQL over the counts; all are ratios, so they mean the same for any length.
STATISTICS = {
    "mean_word_chars": "word_chars / n_words",
    "symbol_ratio": "n_symbols / n_words",
    "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_ratio": "n_repeat_words / n_words",
    "distinct_ratio": "n_distinct / n_words",
    "upper_ratio": "n_upper / greatest(n_letters, 1)",
    "letter_ratio": "n_letters / greatest(word_chars, 1)",
    "digit_ratio": "n_digits / greatest(word_chars, 1)",
    "exclaim_ratio": "n_exclaim / n_words",
    "stop_ratio": "n_stops / n_words",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``; null counts as empty."""
    words = space_words(text)
    if not words:
        return (0,) * len(COUNTS)
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            lines += 1
            dups += line in seen
            seen.add(line)
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    flags = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    upper = (flags >= 65) & (flags <= 90)
    letters = upper | ((flags >= 97) & (flags <= 122)) | (flags >= 192)
    digits = (flags >= 48) & (flags <= 57)
    return (
        len(words),
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        dups,
        repeated_words(words),
        lines,
        len(set(words)),
        int(upper.sum()),
        int(letters.sum()),
        int(digits.sum()),
        text.count("!"),
        text.count(".") + text.count("?"),
    )


def repeated_words(words: list[bytes], window: int = 8) -> int:
    """Words inside windows that stand twice or more in the text, the first one included."""
    if len(words) <= window:
        return 0
    _, where, times = np.unique(
        run_hashes(hash_words(words), window), return_inverse=True, return_counts=True
    )
    starts = np.flatnonzero(times[where] > 1)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text; a map without a shuffle."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([text_counts(t) for t in batch], columns=COUNTS, dtype="int64")

    return docs.select("doc_id", counts(F.col("text")).alias("_c")).select("doc_id", "_c.*")


def with_statistics(counts: DataFrame) -> DataFrame:
    """Add the ratios; a text without words has null ratios, which no condition matches."""
    return counts.withColumns(
        {k: F.expr(f"CASE WHEN n_words > 0 THEN {e} END") for k, e in STATISTICS.items()}
    )


@dataclass(frozen=True)
class Condition:
    """``statistic`` above (or at most) a threshold."""

    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        value = rows[self.statistic]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covered(rule: Rule, rows: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for c in rule:
        out &= c.holds(rows)
    return out


def _best_condition(rows, bad, inside) -> tuple[float, Condition | None]:
    """The condition of greatest FOIL gain among the rows inside the rule so far."""
    p0, n0 = int((bad & inside).sum()), int((~bad & inside).sum())
    base, best = np.log2(max(p0, 1e-9) / max(p0 + n0, 1)), (1e-9, None)
    for name, values in rows.items():
        v, y = values[inside], bad[inside]
        order = np.argsort(v, kind="stable")
        v, y = v[order], y[order]
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        low_p, size = np.cumsum(y)[cuts], cuts + 1
        mid = (v[cuts] + v[cuts + 1]) / 2
        for above, p, t in ((False, low_p, size), (True, p0 - low_p, len(v) - size)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1e-9) / t) - base), -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), Condition(name, above, float(mid[k])))
    return best


def learn_rules(
    rows: dict[str, np.ndarray],
    bad: np.ndarray,
    max_rules: int = 16,
    max_conditions: int = 4,
    min_precision: float = 0.95,
    min_covered: int = 3,
) -> list[Rule]:
    """Ordered rules for the bad class.

    Each round splits what is not covered yet in two thirds to grow a conjunction by
    greatest FOIL gain and one third to prune conditions from its end by
    (p - n) / (p + n); the rule is kept if it is precise enough on all of it, and what it
    covers is taken away.  Learning ends with the first rule that is not.
    """
    left, rules = np.ones(len(bad), dtype=bool), []
    third = np.arange(len(bad)) % 3 == 2
    while len(rules) < max_rules and (bad & left).any():
        grow = left & ~third
        if not (bad & grow).any():
            grow = left
        sub = {k: v[grow] for k, v in rows.items()}
        y, inside, rule = bad[grow], np.ones(int(grow.sum()), dtype=bool), ()
        while len(rule) < max_conditions and (~y & inside).any():
            _, condition = _best_condition(sub, y, inside)
            if condition is None:
                break
            rule += (condition,)
            inside &= condition.holds(sub)
        check = left & third
        held = {k: v[check] for k, v in rows.items()}

        def worth(r: Rule) -> float:
            c = covered(r, held, int(check.sum()))
            p, n = int((bad[check] & c).sum()), int((~bad[check] & c).sum())
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = covered(rule, rows, len(bad)) & left if rule else np.zeros(len(bad), dtype=bool)
        p, n = int((bad & hit).sum()), int((~bad & hit).sum())
        if p < min_covered or p < min_precision * (p + n):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(
    statistics: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """Learn from at most ``sample_rows`` labelled documents (quality 0 is bad).

    The sample is the first rows in the order of a hash of doc_id.  Rows with a null id,
    null label or without words teach nothing; without both classes the list is empty.
    """
    sample = (
        labels.where("doc_id is not null and quality is not null")
        .select("doc_id", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(sample_rows)
    )
    rows = (
        statistics.where("n_words > 0")
        .join(F.broadcast(sample), "doc_id")
        .select("doc_id", "quality", *STATISTICS)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *STATISTICS)
        .limit(MAX_ROWS_PER_LABEL * sample_rows)
        .toPandas()
        .sort_values(["doc_id", "quality", *STATISTICS], kind="stable", ignore_index=True)
    )
    # a fixed shuffle, so that both parts of a split hold rows from everywhere
    rows = rows.iloc[np.random.default_rng(7).permutation(len(rows))]
    bad = (rows["quality"] == 0).to_numpy()
    if bad.all() or not bad.any():
        return []
    return learn_rules({k: rows[k].to_numpy(dtype=float) for k in STATISTICS}, bad)


def verdict(rules: list[Rule]) -> Column:
    """The rules as one ordered conditional: the first that matches rejects; else keep."""
    if not rules:
        return F.lit(True)
    chain = None
    for rule in rules:
        test = F.lit(True)
        for c in rule:
            test = test & c.column()
        chain = F.when(test, F.lit(False)) if chain is None else chain.when(test, F.lit(False))
    return chain.otherwise(F.lit(True))


def explain_rules(rules: list[Rule]) -> list[str]:
    """One readable line per rule, in order."""
    return ["reject if " + " and ".join(map(str, r)) for r in rules] + ["else keep"]


def judge_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, base counts, base_failed and kept of every document.

    The counts are made once and stored (numbers only); learning reads the labelled ones.
    """
    counts = materialize(with_counts(docs), "quality-counts")
    statistics = with_statistics(counts)
    rules = fit(statistics, labels, sample_rows)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return statistics.select(
        "doc_id",
        *COUNTS[:5],
        failed.alias("base_failed"),
        (~failed & verdict(rules)).alias("kept"),
    )
