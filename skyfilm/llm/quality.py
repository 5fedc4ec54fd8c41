"""Quality of texts by weak supervision: rules vote or abstain, and EM weighs them.

Each rule says good, bad or nothing of a text.  Expectation-maximisation over the counts of vote
patterns, at most three to the number of rules, estimates how often each rule votes which way on good
and on bad texts; the posterior probability of a good text given its votes decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import U64, mix, sized, word_hashes

_BLANK = re.compile("[\x20\x09-\x0d]")
_WORD = re.compile("[^\x20\x09-\x0d]")
_SYMBOLS = "#*$%&|<>"
_IS_SYMBOL = np.isin(np.arange(256), list(_SYMBOLS.encode()))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_short", "n_distinct", "n_letters", "n_marked", "n_alpha")


def repeated_words(words: np.ndarray, k: int = 3) -> int:
    """Words inside k-word windows found twice or more."""
    if len(words) < k + 1:
        return 0
    window = np.zeros(len(words) - k + 1, dtype=U64)
    for j in range(k):
        window = mix(window + words[j : len(words) - k + 1 + j])
    _, back, n = np.unique(window, return_inverse=True, return_counts=True)
    twice = n[back] > 1
    covered = np.zeros(len(words), dtype=bool)
    for j in range(k):
        covered[j : j + len(twice)] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and lines with a word."""
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return len(lines) - len(set(lines)), len(lines)


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that rules look at, for each row of docs(doc_id, text); null counts as empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            h, at = word_hashes(texts, lower=False)
            rows = []
            for t, a, b in zip(texts, at[:-1], at[1:], strict=True):
                own, (dup, lines) = h[a:b], duplicate_lines(t)
                raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
                seen = np.bincount(raw, minlength=256)
                blanks = int(seen[0x20] + seen[9:14].sum())
                upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
                space = np.isin(raw, (0x20, 9, 10, 11, 12, 13))
                edge = np.flatnonzero(np.diff(~space, prepend=False, append=False))
                short = int((edge[1::2] - edge[::2] <= 3).sum())
                marked = len(np.unique(np.searchsorted(edge[::2], np.flatnonzero(_IS_SYMBOL[raw]), side="right")))
                alpha = upper + lower + len(t) - int(seen[:128].sum())
                rows.append((b - a, len(t) - blanks, int(seen[list(_SYMBOLS.encode())].sum()), dup, repeated_words(own), lines, upper, int(seen[33] + seen[63]), short, len(np.unique(own)), upper + lower, marked, alpha))
            columns = np.array(rows, dtype=np.int64).reshape(-1, len(_COUNTS)).T
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in columns)], ["doc_id", *_COUNTS])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS))


def _vote(bad: str, good: str) -> Column:
    return F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)


def rule_votes() -> dict[str, Column]:
    """Each rule's vote, 1 good, -1 bad, 0 none, over the columns of text_counts."""
    return {
        "symbols": _vote("n_symbols > 0.1 * n_words", "n_symbols <= 0.02 * n_words"),
        "marked_words": _vote("n_marked > 0.1 * n_words", "n_marked <= 0.02 * n_words"),
        "letters": _vote("n_words > 0 AND n_alpha < 0.8 * word_chars", "n_alpha > 0.9 * word_chars"),
        "repeats": _vote("n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.1 * n_words"),
        "capitals": _vote("n_letters > 0 AND n_upper > 0.4 * n_letters", "n_upper <= 0.15 * n_letters"),
        "marks": _vote("n_marks > 0.3 * n_words", "n_marks <= 0.05 * n_words"),
        "word_length": _vote("n_words > 0 AND (word_chars < 2.5 * n_words OR word_chars > 10 * n_words)", "n_words > 0 AND word_chars BETWEEN 3.5 * n_words AND 8 * n_words"),
        "vocabulary": _vote("n_words >= 50 AND n_distinct < 0.25 * n_words", "n_words < 2000 AND n_distinct > 0.45 * n_words"),
        "lines": _vote("n_lines >= 3 AND n_dup_lines > 0.3 * n_lines", "n_lines >= 3 AND n_dup_lines = 0"),
        "short_words": _vote("n_words >= 50 AND n_short < 0.03 * n_words", "n_short > 0.1 * n_words"),
    }


def em_posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, prior_good: float = 0.85, prior_weight: float = 10.0) -> tuple[np.ndarray, np.ndarray]:
    """Posterior probability of good for each vote pattern, and P(vote | class) as (class, rule, vote).

    Starts from the view that one bad vote makes a bad text, as kinds of junk differ and few rules see each.
    Pseudo-counts say, weakly, that rules tend to be right.
    """
    if not len(patterns):
        return np.zeros(0), np.zeros((2, 0, 3))
    votes = patterns + 1
    good = 1 / (1 + np.exp(-(2.0 + 0.25 * (patterns > 0).sum(axis=1) - 5.0 * (patterns < 0).sum(axis=1))))
    pseudo = np.array([[3.0, 3.0, 1.0], [1.0, 3.0, 3.0]]) * prior_weight / 7
    table = np.zeros((2, patterns.shape[1], 3))
    for _ in range(rounds):
        share = (counts @ good + prior_weight * prior_good) / (counts.sum() + prior_weight)
        for c, weight in enumerate((counts * (1 - good), counts * good)):
            for r in range(patterns.shape[1]):
                table[c, r] = np.bincount(votes[:, r], weights=weight, minlength=3) + pseudo[c]
        table /= table.sum(axis=2, keepdims=True)
        log_odds = np.log(share / (1 - share)) + sum(np.log(table[1, r, votes[:, r]]) - np.log(table[0, r, votes[:, r]]) for r in range(patterns.shape[1]))
        new = 1 / (1 + np.exp(-np.clip(log_odds, -50, 50)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return good, table


def judge_quality(spark: SparkSession, docs: DataFrame, threshold: float = 0.5, least_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """One row for each row of docs(doc_id, text): the base counts, base_failed, p_good, pattern and kept.

    base_failed: fewer than least_words words, or more than most_repeated per cent of them repeated.  Null
    texts count as empty, so they fail.  Rules are weighed over all rows that the base lets through, as the
    others are decided; an empty table gives no rows.
    """
    scratch = Scratch(spark, "quality")
    rules = rule_votes()
    pattern = F.concat(*[(v + 1).cast("string") for v in rules.values()])
    failed = f"n_words < {least_words} OR 100 * n_repeat_words > {most_repeated} * n_words"
    counted = scratch.keep(text_counts(docs).withColumns({"pattern": pattern, "base_failed": F.expr(failed)}), "counts")
    found = counted.groupBy("pattern").agg(F.count_if(~F.col("base_failed")).alias("n")).orderBy("pattern").collect()  # 3 ** rules at most
    patterns = np.array([[int(c) - 1 for c in r["pattern"]] for r in found], dtype=np.int64).reshape(-1, len(rules))
    good, _ = em_posteriors(patterns, np.array([r["n"] for r in found], dtype=float))
    odds = spark.createDataFrame([(r["pattern"], float(g)) for r, g in zip(found, good, strict=True)], "pattern string, p_good double")
    judged = counted.join(F.broadcast(odds), "pattern")
    return judged.select("doc_id", *_COUNTS[:5], "base_failed", (~F.col("base_failed") & (F.col("p_good") >= threshold)).alias("kept"), "p_good", "pattern")
