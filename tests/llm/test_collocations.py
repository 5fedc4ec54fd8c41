import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfilm.llm import collocations as co
from skyfilm.llm import queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=10, covered=50, first=2000):
    f, words = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, c in f.items():
        found = {p: n for p, n in c.items() if len(p) > 1 and n >= least}
        longer = Counter()
        for p, n in found.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], n)
        ranked = []
        for p, a in found.items():
            if 100 * longer[p] >= covered * a and longer[p]:
                continue
            score, _, left, right = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(ranked)[:first], 1):
            out.add((lang, rank, p.decode(), -a, left, right, words[lang], -s))
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def plain_automaton(pieces):
    """A generalised suffix automaton built word by word; end positions counted along the suffix links."""
    nexts, link, length, ends = [{}], [-1], [0], [set()]
    at = 0
    for piece in pieces:
        last = 0
        for w in piece:
            if w in nexts[last] and length[nexts[last][w]] == length[last] + 1:
                last = nexts[last][w]
                ends[last].add(at)
                at += 1
                continue
            clone_of = nexts[last].get(w)
            new = len(nexts)
            p = last
            if clone_of is None:
                nexts.append({})
                link.append(0)
                length.append(length[last] + 1)
                ends.append(set())
                while p != -1 and w not in nexts[p]:
                    nexts[p][w] = new
                    p = link[p]
            target = new
            if p != -1:
                q = nexts[p][w]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    clone = len(nexts)
                    nexts.append(dict(nexts[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    ends.append(set())
                    while p != -1 and nexts[p].get(w) == q:
                        nexts[p][w] = clone
                        p = link[p]
                    link[q] = clone
                    if clone_of is None:
                        link[new] = clone
                    else:
                        target = clone
            last = target
            ends[last].add(at)
            at += 1
    for s in sorted(range(1, len(nexts)), key=lambda s: -length[s]):
        ends[link[s]] |= ends[s]
    return nexts, link, length, ends


@pytest.mark.parametrize("seed", range(5))
def test_states_of_a_shard(seed):
    """Counts, suffix links and states equal those of an automaton built word by word."""
    rng = random.Random(seed)
    pieces = [[rng.randrange(6) for _ in range(rng.randint(1, 9))] for _ in range(40)]
    ids = np.array(sum(pieces, []))
    new = np.array(sum(([True] + [False] * (len(p) - 1) for p in pieces), []))
    tree = co.Automaton(ids, new, 3)
    nexts, link, length, ends = plain_automaton(pieces)

    def state(words):
        s = 0
        for w in words:
            s = nexts[s][w]
        return s

    for d in range(3):
        phrases = [tuple(ids[e - d : e + 1].tolist()) for e in tree.ends[d].tolist()]
        assert Counter(phrases) == Counter({tuple(p[i : i + d + 1]) for p in pieces for i in range(len(p) - d)})
        for k, phrase in enumerate(phrases):
            assert tree.counts[d][k] == len(ends[state(phrase)])
            if d:
                e = tree.ends[d - 1][tree.links[d][k]]
                assert tuple(ids[e - d + 1 : e + 1].tolist()) == phrase[1:]
                e = tree.ends[d - 1][tree.prefixes[d][k]]
                assert tuple(ids[e - d + 1 : e + 1].tolist()) == phrase[:-1]
                same = tree.counts[d][k] == tree.counts[d - 1][tree.links[d][k]]
                assert same == (state(phrase) == state(phrase[1:]))


def texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)] + ["É", "日本", " ", "A", "a", "b-c", "x" * 300]
    out = [(" ".join(rng.choice(words[: rng.randint(2, len(words))]) + rng.choice(["", "", "", ",", ".\n", "\t", "  ", "\x0b", "!?"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", "und", None, ""])) for _ in range(400)]
    out += [("new york city " * 50, "en"), ("Same Text, again and again", "de")] + [("one text that is in most rows; of all", "fr")] * 300
    return out + [(None, "en"), ("", None), ("only words of one long piece " * 3000, "long"), (" . , \n", "en"), ("rare " * 9, "it")]


@pytest.mark.parametrize("bits,shard,ranked", [(26, 1 << 21, 1 << 16), (15, 2000, 40)])
def test_phrases_against_brute_force(spark, monkeypatch, bits, shard, ranked):
    """Also with a bitmap in which most hashes meet, shards of a few texts and rounds of ranking."""
    monkeypatch.setattr(co, "RANKED", ranked)
    rows = texts()
    df = spark.createDataFrame([(t, lang, 0.5) for t, lang in rows], "text string, lang string, n double").withColumns({c: F.lit(0.125) for c in ("phrase", "score", "rank", "a", "l", "r", "w", "words", "cut")})
    got = rows_of(co.collocations(spark, df.repartition(4), bits=bits, shard=shard, first=60))
    assert got == brute(rows, first=60) and len({r[0] for r in got}) > 4


def test_empty_tables(spark):
    df = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    assert co.collocations(spark, df).count() == 0 and co.collocations(spark, df.where("text = ''")).count() == 0


def test_scores_beyond_64_bits(spark):
    rows = [(123_456_789_012, 987_654_321_098, 123_456_789_013), (99_999_999_999_999, 99_999_999_999_999, 100_000_000_000_001), (10, 10, 10)]
    got = [r.s for r in spark.createDataFrame(rows, "a long, l long, r long").select(co.exact_score("a", "l", "r").alias("s")).collect()]
    assert got == [10**6 * a * a // (left * right) for a, left, right in rows] and not isinstance(got[0], Decimal)


def test_query_against_brute_force(spark):
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(queries.op12_collocations(spark, SF)) == brute(rows)
