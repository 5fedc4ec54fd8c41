import re
import zlib

import numpy as np
import pytest

from skyfilm.llm.ngram_join import keep_one_of_each, near_duplicates
from skyfilm.llm.words import shingle_hashes, word_hashes

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if sets[i] and ids else d))
    return sorted(out, key=str)


def near_rows():
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(300)]
    rows, base = [], []
    for i in range(60):
        base.append(" ".join(rng.choice(vocab, int(rng.integers(1, 120)))))
    for i in range(400):
        words = base[int(rng.integers(0, 60))].split()
        for _ in range(int(rng.integers(0, 4))):
            words[int(rng.integers(0, len(words)))] = str(rng.choice(vocab))
        rows.append((i, " ".join(words)))
    # one large group of near copies of one text, most of which link only with the original
    long = [f"k{i}" for i in range(150)]
    for i in range(150):
        words = list(long)
        for j in rng.choice(150, int(rng.integers(1, 6)), replace=False):
            words[j] = f"x{i}-{j}"
        rows.append((1000 + i, " ".join(words)))
    rows.append((5000, " ".join(long)))
    return rows


def test_matches_brute_force(spark):
    rows = near_rows()
    got = near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()], key=str) == brute(rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two"), (7, "one two"), (None, "one two"), (None, "lonely text"), (8, "a b c d e"), (8, "entirely other words here now ok"), (9, "é É Ä"), (10, "é É ä"), (11, "x " * 30000), (12, "x x x x x x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(spark, df)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()], key=str) == brute(rows)
    empty = near_duplicates(spark, df.where("doc_id > 99"))
    assert empty.count() == 0


def test_keep_one(spark):
    rows = [(3, "a b c d e f", "s"), (1, "A b c d e f", "t"), (1, "A b c d e f", "t"), (2, None, "u"), (2, None, "u"), (4, "other words are in this one", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = keep_one_of_each(spark, df)
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect() if r.node) == [(1, "A b c d e f", "t"), (2, None, "u"), (2, None, "u")]
    assert got.count() == 4


@pytest.mark.parametrize("text", ["a bb  ccc\n\tdd", "", " x ", "é ñ ok", "w" * 3000000 + " tail", "lo " * 900000])
def test_word_hashes(text):
    h, at = word_hashes([text, None, "Tail"])
    words = WORD.findall(text)
    assert list(np.diff(at)) == [len(words), 0, 1]
    seen = {}
    for w, x in zip(words, h.tolist()):
        assert seen.setdefault(w.lower() if w.isascii() else w, x) == x
    assert len(set(h[: len(words)].tolist())) == len(set(words))
    assert ("tail" in words) == (h[-1] in h[:-1].tolist() if len(words) < 5 else False) or len(words) >= 5


def test_shingles_differ_by_order():
    h, _ = word_hashes(["a b c d e f"])
    assert len(set(shingle_hashes(h).tolist())) == 2
    assert shingle_hashes(h[:5])[0] != shingle_hashes(h[[1, 0, 2, 3, 4]])[0]
    assert shingle_hashes(h[:2])[0] != shingle_hashes(h[:3])[0]
    assert zlib.crc32(b"1") % 5 in range(5)
