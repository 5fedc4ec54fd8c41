"""Phrases of up to three words that stand out, by language, from suffix automata of shards.

A shard of texts becomes a generalised suffix automaton over words, bounded in depth: its states are the classes of phrases
with the same end positions, told apart by their counts along the suffix links.  It is built by sorting
positions by their last, second last and third last word, which gives the tree of suffix links directly.  Shards
enumerate the phrases of their states with their counts, Spark adds the counts up.

Lengths are counted one after another.  A phrase is enumerated only if its suffix link and its prefix, both one word shorter, may
be frequent: shards look them up in a bitmap of fixed size with a bit for the hash of each frequent phrase.  Hashes that
meet let some more phrases through, whose counts are below the limit and drop out, so results do not hang on the size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bitmap import BITS, bitmap, flat, maybe
from .scratch import Scratch
from .skew import join_distinct
from .words import U64, mix, word_spans

DEPTH, LEAST, COVERED, FIRST = 3, 10, 50, 2000
#: bytes of text in a shard
SHARD = 1 << 21
#: rows of a record batch
_ROWS = 1 << 16
#: phrases that make up more than one in so many words are joined by broadcast
SHARE = 4096
#: rows of a language that one task ranks, about
RANKED = 1 << 16
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
#: A-Z to small letters, all ends of pieces to one of them
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + _PIECE_ENDS, bytes(range(97, 123)) + b"\n" * len(_PIECE_ENDS))
_SEED = U64(0x9E3779B97F4A7C15)


class Automaton:
    """States of the phrases of up to depth words that end at the positions of a shard.

    ids are words as numbers from 0, new marks positions whose word begins a piece.  For each length d (from 1):
    ends[d-1] a position at which each phrase ends, counts[d-1] how many end positions it has, links[d-1] the number of its
    suffix that is a word shorter among those of length d-1, and prefixes[d-1] likewise that of its prefix.  A phrase
    belongs to the state of a longer one that ends in it if both have the same count.
    """

    def __init__(self, ids: np.ndarray, new: np.ndarray, depth: int = DEPTH):
        n = len(ids)
        inside = np.ones(n, dtype=bool)
        columns = []
        for d in range(depth):
            if d:
                # position i reaches back d words if position i - d + 1 does not begin a piece
                inside[:d] = False
                inside[d:] &= ~new[1 : n - d + 1]
            word = np.zeros(n, np.int64)
            word[d:] = ids[: max(n - d, 0)] + 1
            columns.append(np.where(inside, word, 0))
        bits = int(ids.max(initial=0) + 1).bit_length()
        if bits * depth <= 63:
            order = np.argsort(sum(c << (bits * (depth - 1 - d)) for d, c in enumerate(columns)), kind="stable")
        else:
            order = np.lexsort(columns[::-1])
        self.ends, self.counts, self.links, self.prefixes = [], [], [], []
        above, place = np.full(n, -1), np.full(n, -1)
        starts_here = np.zeros(n, dtype=bool)
        starts_here[:1] = True
        for d, column in enumerate(columns):
            sorted_ = column[order]
            starts_here[1:] |= sorted_[1:] != sorted_[:-1]
            starts = np.flatnonzero(starts_here)
            sizes, real = np.diff(starts, append=n), sorted_[starts] > 0
            self.ends.append(order[starts[real]])
            self.counts.append(sizes[real])
            self.links.append(above[starts[real]])
            self.prefixes.append(place[self.ends[-1] - 1] if d else self.links[-1])
            above = np.repeat(np.where(real, np.cumsum(real) - 1, -1), sizes)
            place = np.empty(n, np.int64)
            place[order] = above


def _hashes(words: np.ndarray, ends: np.ndarray, length: int, lang: np.ndarray) -> np.ndarray:
    """64-bit hashes of phrases, from those of their words and languages."""
    h = lang[ends] * _SEED + U64(length)
    for k in range(length):
        h = mix(h * _SEED + words[ends - (length - 1 - k)])
    return h


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _slices(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of many slices one after another, and their offsets."""
    size = end - start
    at = np.concatenate([[0], np.cumsum(size)])
    return buf[np.repeat(start - at[:-1], size) + np.arange(at[-1])], at


def _spaced(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words with one space behind each, and where each begins (one more entry than words)."""
    at = np.concatenate([[0], np.cumsum(end - start + 1)])
    flat = np.empty(at[-1], np.uint8)
    for i in range(0, len(start), _ROWS):
        j = min(i + _ROWS, len(start))
        flat[at[i] : at[j]] = _slices(buf, start[i:j], end[i:j] + 1)[0]
    flat[at[1:] - 1] = 32
    return flat, at


def _shards(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[bytes, np.ndarray, list[str], np.ndarray]]:
    """Texts of about size bytes, cut at ends of pieces only: their bytes, where parts begin, languages and the language of each part."""
    parts: list[bytes] = []
    langs: list[str] = []
    total = 0

    def done():
        known = {x: i for i, x in enumerate(dict.fromkeys(langs))}
        begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        return b"\n".join([*parts, b""]), begins, list(known), np.array([known[x] for x in langs])

    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass").translate(_PLAIN)
            at = 0
            while at < len(raw):
                to = min(len(raw), at + size)
                if to < len(raw):
                    cut = raw.rfind(b"\n", at, to)
                    cut = raw.find(b"\n", to) if cut < 0 else cut
                    to = cut + 1 if cut >= 0 else len(raw)
                parts.append(raw[at:to])
                langs.append(lang)
                total += to - at
                at = to
                if total >= size:
                    yield done()
                    parts.clear()
                    langs.clear()
                    total = 0
    if parts:
        yield done()


def _enumerated(length: int, sent: list, bits: int, size: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of a shard's phrases of one length whose suffix link and prefix may be frequent; for single words also each language's words, under a null phrase."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [flat(blocks.value, bits) for blocks in sent]
        for whole, begins, names, lang_of_part in _shards(batches, size):
            buf = np.frombuffer(whole, np.uint8)
            words, start, end = word_spans(whole)
            if not len(words):
                continue
            piece = np.searchsorted(np.flatnonzero(buf == 10), start)
            lang = lang_of_part[np.searchsorted(begins, start, side="right") - 1]
            seeds = np.array([_lang_hash(x) for x in names], U64)
            if length == 1:
                total = np.bincount(lang, minlength=len(names)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.nulls(len(names), pa.string()), pa.array(total)], ["lang", "phrase", "n"])
            else:
                # rare words are in no phrase that counts, so pieces may end at them
                frequent = maybe(known[0], _hashes(words, np.arange(len(words)), 1, seeds[lang]), bits)
                piece = piece + np.cumsum(~frequent)
                words, start, end, piece, lang = (x[frequent] for x in (words, start, end, piece, lang))
            _, ids = np.unique(mix(words + seeds[lang] * _SEED), return_inverse=True)
            tree = Automaton(ids, np.diff(piece, prepend=-1) != 0, length)
            ends, counts = tree.ends[-1], tree.counts[-1]
            if length > 2:
                shorter = maybe(known[-1], _hashes(words, tree.ends[-2], length - 1, seeds[lang]), bits)
                keep = shorter[tree.links[-1]] & shorter[tree.prefixes[-1]]
                ends, counts = ends[keep], counts[keep]
            spaced, at = _spaced(buf, start, end)
            for i in range(0, len(ends), _ROWS):
                last = ends[i : i + _ROWS]
                raw, offsets = _slices(spaced, at[last - length + 1], at[last + 1] - 1)
                phrases = pa.StringArray.from_buffers(len(last), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw))
                tongue = pa.DictionaryArray.from_arrays(pa.array(lang[last].astype(np.int32)), pa.array(names, pa.string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([tongue, phrases, pa.array(counts[i : i + _ROWS].astype(np.int64))], ["lang", "phrase", "n"])

    return run


def _phrase_hashes(length: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                words, _, _ = word_spans("\n".join([*batch.column("phrase").to_pylist(), ""]).encode("utf-8", "surrogatepass"))
                names = batch.column("lang").dictionary_encode()
                lang = np.array([_lang_hash(x) for x in names.dictionary.to_pylist()], U64)[names.indices.to_numpy()]
                h = _hashes(words, np.arange(batch.num_rows) * length + length - 1, length, np.repeat(lang, length))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    return run


def phrase_counts(spark: SparkSession, docs: DataFrame, scratch: Scratch, depth: int = DEPTH, least: int = LEAST, bits: int = BITS, shard: int = SHARD) -> list[DataFrame]:
    """For each length a stored table (lang, phrase, n) of the phrases found least times; that of single words holds each language's words under a null phrase."""
    texts = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    tables, sent = [], []
    for length in range(1, depth + 1):
        rows = texts.mapInArrow(_enumerated(length, list(sent), bits, shard), "lang string, phrase string, n long")
        counted = rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | F.col("phrase").isNull())
        tables.append(scratch.keep(counted, f"phrases{length}"))
        if length < depth:
            hashes = tables[-1].where("phrase IS NOT NULL").mapInArrow(_phrase_hashes(length), "h long")
            sent.append(spark.sparkContext.broadcast(bitmap(hashes, "h", bits)))
    return tables


def exact_score(a: str, left: str, right: str) -> Column:
    """floor(10^6 a a / (left right)) in decimals of 38 digits, for counts below 10^15."""
    a, left, right = (f"CAST({c} AS DECIMAL(15, 0))" for c in (a, left, right))
    return F.expr(f"(1000000BD * {a} * {a}) div ({left} * {right})")


def first_of_each(rows: DataFrame, key: str, order: list[Column], first: int, by: str) -> DataFrame:
    """The first rows of each key with their rank, in rounds over ever fewer buckets, so that a key with most rows is no single task."""
    buckets = -(-rows.count() // RANKED)
    while buckets > 1:
        window = Window.partitionBy(key, F.pmod(F.xxhash64(by), F.lit(buckets))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= first).drop("rank")
        buckets = min(buckets // 8, -(-buckets * first // RANKED))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= first)


def collocations(spark: SparkSession, docs: DataFrame, depth: int = DEPTH, least: int = LEAST, covered: int = COVERED, first: int = FIRST, bits: int = BITS, shard: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases by score, of docs(text, lang).

    Texts are lower-cased (A-Z) and cut into pieces at . , ; : ! ? and line ends, pieces into words at spaces and tabs.  a counts a phrase's
    occurrences inside pieces, l and r those of the two parts of the cut with the lowest score, n the words of the
    language.  Phrases have 2 to depth words and least occurrences; one that lies inside a longer phrase with at least covered per cent of its
    occurrences drops out.  Null texts are empty, null languages are `und`, rows that repeat count each time; an empty table, and texts
    without such phrases, give no rows.  Other columns are not looked at.  Words are told apart by 64-bit hashes within a shard.
    """
    scratch = Scratch(spark, "collocations")
    tables = phrase_counts(spark, docs, scratch, depth, least, bits, shard)
    parts = tables[0].where("phrase IS NOT NULL")
    for table in tables[1:-1]:
        parts = parts.unionByName(table)
    phrases = tables[1]
    for table in tables[2:]:
        phrases = phrases.unionByName(table)
    totals = tables[0].where("phrase IS NULL").select("lang", F.col("n").alias("words"))
    all_words = totals.agg(F.sum("words")).first()[0] or 0
    split = phrases.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cut = split.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut"))
    text = lambda words: F.array_join(words, " ")
    sides = F.array(F.struct(F.lit("l").alias("side"), text(F.slice("w", F.lit(1), F.col("cut"))).alias("part")), F.struct(F.lit("r").alias("side"), text(F.slice("w", F.col("cut") + 1, F.size("w"))).alias("part")))
    asked = scratch.keep(cut.select("lang", "phrase", "a", "cut", F.explode(sides).alias("s")).select("lang", "phrase", "a", "cut", "s.side", "s.part"), "asked")
    told = join_distinct(asked, parts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")), ["lang", "part"], F.col("f") * SHARE > all_words)
    cuts = told.groupBy("lang", "phrase", "a", "cut").agg(F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(exact_score("a", "l", "r").alias("score"), "cut", "l", "r")).alias("x"))
    # what lies inside a longer phrase: its prefix and its suffix link, and what lies inside those
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: text(F.slice("w", i, k)))))
    around = split.where(F.size("w") > 2).select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {covered} * a")
    listed = scratch.keep(kept.select("lang", "phrase", "a", "x.l", "x.r", "x.score"), "scored")
    top = first_of_each(listed, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], first, "phrase")
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
