"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Texts are lower-cased, look-alike letters and digit substitutions are folded to plain letters, and all
else becomes word boundaries.  The lexicon holds words and word beginnings that labelled documents show
to be far likelier in toxic ones; exception phrases, also from the labels or given, switch off what
they cover.  The weights found, and the weights for each word of the text, give a calibrated score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import sized

SAMPLE_ROWS = 20_000
LEXICON_SIZE = 2_000
LEAST_TOXIC = 4
LEAST_G2 = 24.0
STEMS = (4, 5, 6, 7)

# fixed values: letters of other scripts that look like Latin ones, and what they look like
_LOOK_ALIKE = str.maketrans("асеорхуіјѕвнкмтԁԛԝһαοερτυνκιβ", "aceopxyijsbhkmtdqwhaoeptuvkib")
# fixed values: digits and signs written for letters
_DIGITS = bytes.maketrans(b"013457@$", b"oieastas")
_OTHER_SCRIPT = re.compile("[Ͱ-ԯ！-～]")
_PLAIN = bytes(c if chr(c).isalnum() or c >= 128 or c in b"@$" else 32 for c in range(256))


def fold(text: str | None) -> str:
    """The text's folded words, one space before and after each."""
    text = text or ""
    if not text.isascii():
        text = text.lower()
    if _OTHER_SCRIPT.search(text):
        text = "".join(chr(ord(c) - 0xFEE0) if "！" <= c <= "～" else c for c in text).lower().translate(_LOOK_ALIKE)
    raw = text.encode("utf-8", "surrogatepass").lower().translate(_PLAIN)
    return " " + b" ".join(raw.translate(_DIGITS).split()).decode("utf-8", "replace") + " "


@dataclass
class Lexicon:
    """weights: pattern to weight, a word with blanks around it or a word's beginning after a blank."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    beta: tuple[float, float, float] = (-4.0, 0.0, 0.0)
    automaton: object = None

    def __getstate__(self):
        return {**self.__dict__, "automaton": None}

    def _automaton(self):
        import ahocorasick

        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for p, w in self.weights.items():
                self.automaton.add_word(p, (len(p), w))
            for p in self.exceptions:
                self.automaton.add_word(f" {p} ", (len(p) + 2, None))
            self.automaton.make_automaton()
        return self.automaton

    def features(self, text: str | None) -> tuple[float, float, int, int]:
        """log(1 + weight found), log(1 + 100 * weight found / words), hits and words."""
        folded = fold(text)
        words = folded.count(" ") - 1 if len(folded) > 2 else 0
        if not self.weights or not words:
            return 0.0, 0.0, 0, words
        best: dict[int, float] = {}
        covered: list[tuple[int, int]] = []
        for end, (n, w) in self._automaton().iter(folded):
            start = end - n + 1
            if w is None:
                covered.append((start, end))
            elif w > best.get(start, 0.0):
                best[start] = w
        for a, b in covered:
            for start in [s for s in best if a <= s < b]:
                del best[start]
        total = sum(best.values())
        return math.log1p(total), math.log1p(100 * total / words), len(best), words

    def score(self, text: str | None) -> tuple[float, int]:
        x, y, hits, _ = self.features(text)
        z = self.beta[0] + self.beta[1] * x + self.beta[2] * y
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z)))), hits


def _patterns(text: str | None) -> set[str]:
    out: set[str] = set()
    for w in set(fold(text).split()):
        if 3 <= len(w) <= 24:
            out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in STEMS if len(w) >= n)
    return out


def _g2(tox: np.ndarray, clean: np.ndarray, n_tox: int, n_clean: int) -> np.ndarray:
    def part(k, e):
        return np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / e), 0.0)

    share = (tox + clean) / (n_tox + n_clean)
    return 2 * (part(tox, n_tox * share) + part(clean, n_clean * share))


def _counts(sample: DataFrame, terms) -> DataFrame:
    """(term, toxic, clean): documents of the sample with a term, by label."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                both[toxic].update(terms(text))
            keys = list(both[0] | both[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([both[1][k] for k in keys], pa.int64()), pa.array([both[0][k] for k in keys], pa.int64())], ["term", "toxic", "clean"])

    return sample.mapInArrow(run, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    beta, penalty = np.zeros(x.shape[1]), np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve(x.T @ (x * w[:, None]) + penalty + 1e-9 * np.eye(x.shape[1]), x.T @ (y - p) - penalty @ beta)
        norm = np.abs(step).max()
        beta += step * min(1.0, 5 / max(norm, 1e-12))
        if norm < 1e-6:
            break
    return beta


def in_training(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def fit_lexicon(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, exceptions: Sequence[str] = ()) -> Lexicon:
    """A lexicon from labelled documents outside the held-out fold.

    It is fitted on at most ``sample_rows`` labelled doc_ids, those first in the order of a hash.  A doc_id
    labelled twice counts as toxic if one label says so; null labels and null doc_ids are ignored.  Without a
    toxic and a clean document among them the lexicon is empty and all scores are those of a clean text.
    """
    labels = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    chosen = labels.where(in_training(F.col("doc_id"))).orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id").limit(sample_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic").persist()
    try:
        size = dict(sample.groupBy("toxic").count().collect())
        n_tox, n_clean = size.get(1, 0), size.get(0, 0)
        lexicon = Lexicon(exceptions=[fold(p).strip() for p in exceptions])
        if not n_tox or not n_clean:
            return lexicon
        few = _counts(sample, _patterns).where(f"toxic >= {LEAST_TOXIC} AND toxic * {n_clean} > 4 * clean * {n_tox}")
        few = few.orderBy(F.desc(F.expr(f"toxic * ln((toxic + 0.5) / {n_tox + 1} / ((clean + 0.5) / {n_clean + 1}))")), "term").limit(4 * LEXICON_SIZE).toPandas()
        few = few[_g2(few.toxic.to_numpy(float), few.clean.to_numpy(float), n_tox, n_clean) >= LEAST_G2].head(LEXICON_SIZE)
        lexicon.weights = dict(zip(few.term, np.log((few.toxic + 0.5) / (n_tox + 1)) - np.log((few.clean + 0.5) / (n_clean + 1)), strict=True))
        lexicon.exceptions += _exceptions(sample, lexicon)
        lexicon.beta = tuple(_fit_score(sample, lexicon))
        return lexicon
    finally:
        sample.unpersist()


def _exceptions(sample: DataFrame, lexicon: Lexicon) -> list[str]:
    """Two-word phrases around a match that clean documents hold three times or more and toxic ones never."""

    def phrases(text: str | None) -> set[str]:
        words, out = fold(text).split(), set()
        for i, w in enumerate(words):
            if f" {w} " in lexicon.weights or any(f" {w[:n]}" in lexicon.weights for n in STEMS):
                out.update(" ".join(words[a : a + 2]) for a in (i - 1, i) if a >= 0 and a + 1 < len(words))
        return out

    return [r.term for r in _counts(sample, phrases).where("clean >= 3 AND toxic = 0").orderBy(F.desc("clean"), "term").limit(LEXICON_SIZE).collect()]


def _fit_score(sample: DataFrame, lexicon: Lexicon) -> np.ndarray:
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            xy = [lexicon.features(t)[:2] for t in pdf["text"]]
            yield pd.DataFrame({"x": [v[0] for v in xy], "y": [v[1] for v in xy], "toxic": pdf["toxic"]})

    found = sample.mapInPandas(run, "x double, y double, toxic int").toPandas()
    return _logistic(found[["x", "y"]].to_numpy(), found["toxic"].to_numpy(float))


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """docs with score (0 to 1), predicted (1 from 0.5 on) and n_hits; for whole texts, null as empty.

    Columns of docs with these names are replaced; rows that repeat stay; an empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted", "n_hits")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, "text"):
            found = [lexicon.score(t) for t in batch.column("text").to_pylist()]
            new = [pa.array([s for s, _ in found], pa.float64()), pa.array([int(s >= 0.5) for s, _ in found], pa.int32()), pa.array([n for _, n in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new], [*kept, "score", "predicted", "n_hits"])

    fields = [docs.schema[c] for c in kept]
    new = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("n_hits", T.LongType())]
    return docs.select(*kept).mapInArrow(run, T.StructType([*fields, *new]))
