import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyfilm.llm import hpy_lm, line_dedup, mixing, packing, quality, rp_forest, seating, token_counts, toxicity, url_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = ["", " ", "a", "<|endoftext|> x <|ENDOFTEXT|>", "ΑΣ Σ Straße İ", "naïve ｆｕｌｌ １２３", "日本語 のテキスト", "don't   stop\n\n\tnow 's", "x" * 5000, "e\u0301 \u2003wide", "tab\x0bform\x0cfeed", "🙂 emoji 🙃", "1234567 8.9e10", "word " * 3000]


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def sf_texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


# ---- packing


def test_first_fit_equals_a_plain_search():
    lengths = sorted(np.random.default_rng(0).integers(1, 100, 300).tolist(), reverse=True)
    bins = packing.Bins(128)
    room = [128] * len(lengths)
    for n in lengths:
        b, o = bins.place(n)
        assert b == next(i for i, r in enumerate(room) if r >= n) and o == 128 - room[b]
        room[b] -= n


def test_packing_round_trip(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(i, t) for i, t in sf_texts(spark)] + [(10_000 + i, t) for i, t in enumerate([*ODD, None, "same", "same"])] + [(None, "no id"), (7, "again")]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path).collect()
    tok = Tokenizer.from_file(path)
    want = Counter((d, tuple([*tok.encode(t or "", add_special_tokens=False).ids, 1])) for d, t in rows)
    sequences, whole = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r.ids) == r.length and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        sequences[r.sequence_id].append((r.offset, r.length))
        whole[(r.doc_id, r.doc_tokens)].append((r.start, tuple(r.ids)))
    for parts in sequences.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    found = Counter()
    for (d, n), parts in whole.items():
        if sum(len(p[1]) for p in parts) == n:
            found[(d, sum((p[1] for p in sorted(parts)), ()))] += 1
        else:  # repeated rows with one id: each short, so one piece
            for p in parts:
                found[(d, p[1])] += 1
    assert found == want
    assert sum(r.length for r in got) / (2048 * len(sequences)) > 0.95


def test_ids_of_odd_texts_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, encoder, rng = Tokenizer.from_file(path), packing.WordEncoder(path), random.Random(3)
    assert encoder.by_word
    letters = "aAbZzéÉßÿÀ÷'\u2019.,;:!?-1٢# \n\t\u0331\u0301\u0308\u030aTWHJY日ΑΣσİǅ<|>…"
    texts = ["T\u0308x", "W\u030a", "H\u0331", "J\u030c", "Plain THEN T\u0308x and E\u0301", *ODD, "x." * 70000, None]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    flat, begins = encoder.ids(texts)
    for t, a, b in zip(texts, begins[:-1], begins[1:], strict=True):
        assert flat[a:b].tolist() == tok.encode(t or "", add_special_tokens=False).ids


def test_other_tokenizer_files_go_to_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = packing.WordEncoder(path)
    assert not encoder.by_word
    flat, begins = encoder.ids(["Two  words", None, "x"])
    assert [flat[a:b].tolist() for a, b in zip(begins[:-1], begins[1:], strict=True)] == [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in ("Two  words", "", "x")]


def test_packing_very_long_text_and_clashing_columns(spark):
    rows = [(1, "word " * 1_000_000, 5, 6), (2, "short one", 5, 6), (3, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, grp long, deal long")
    got = packing.pack_documents(df, public_tokenizers.path("word_bpe_49k.json"), with_ids=False).collect()
    assert Counter(r.doc_id for r in got) == {1: -(-1_000_001 // 2048), 2: 1, 3: 1}
    assert sum(r.length for r in got if r.doc_id == 1) == 1_000_001 and len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_packing_empty(spark):
    assert packing.pack_documents(docs_of(spark, ["x"]).where("doc_id > 5"), public_tokenizers.path("word_bpe_49k.json")).count() == 0


# ---- token counts


def test_token_counts_equal_the_library(spark):
    paths = [public_tokenizers.path(f"byte_bpe_50k.{k}") for k in ("json", "tiktoken")]
    texts = [t for _, t in sf_texts(spark)] + ODD + [None, "mixed 日本 " * 400, "a b" * 2000, "don't " * 900 + "<|endoftext|> tail"]
    tok = Tokenizer.from_file(paths[0])
    want = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)]
    df = docs_of(spark, texts)
    for chunk, overlap, ranks in ((1 << 15, 256, paths[1]), (300, 20, paths[1]), (300, 20, None)):
        got = token_counts.token_counts(df, paths[0], ranks, public_tokenizers.PATTERN if ranks else None, chunk=chunk, overlap=overlap)
        assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()) == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in got.collect())


# ---- url rules


def plain_judge(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return (host, path, *(best or (None, "allow")))


def test_urls(spark):
    from skyfilm.llm.queries import URL_RULES

    rules = [*URL_RULES, ("a.b.c.com/x/", "block"), ("com/", "allow"), ("b.c.com/x/y", "block"), ("example.com/en/77", "block")]
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/7?q=1", "http://example.com/en/77#a", "http://x.example.net/de/8/", "http://example.net/de/7", "http://myexample.org/es/", "ftp://a.b.c.com/x/y/z", "http://b.c.com/x/yes", "http://com/en/", "http://com", "http://É.com/en/ü", "http://a:80/en/", "http://a.com//en/", "x://y://com/en/", "http://" + "a." * 3000 + "com/en/1", "http://example.com?x/en/7", "http://example.com/\n/en/"] * 2
    df = spark.createDataFrame([(i, u, "clash", 1, 2, "z", "w") for i, u in enumerate(urls)], "page_id long, url string, rule string, hit int, at int, row string, part string")
    got = url_rules.judge_urls(df, url_rules.rules_frame(spark, rules), points_a_task=2)
    want = [(i, *plain_judge(u, rules)) for i, u in enumerate(urls)]
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()) == want
    assert url_rules.judge_urls(df.where("page_id < 0"), url_rules.rules_frame(spark, rules)).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(df, url_rules.rules_frame(spark, rules).where("rule = ''")).collect()} == {"allow"}


# ---- mixing


def plain_edf(quanta, slots):
    """Source of each slot: of the released blocks that with the earliest deadline, in exact fractions."""
    total, done, out = sum(quanta.values()), dict.fromkeys(quanta, 0), []
    for t in range(slots):
        ready = [(math.ceil(Fraction((done[s] + 1) * total, q)), q, s) for s, q in quanta.items() if Fraction(done[s] * total, q) < t + 1]
        out.append(min(ready)[2])
        done[out[-1]] += 1
    return out


def test_period_equals_a_plain_edf(spark):
    for quanta in ({"a": 7, "b": 5, "c": 3, "d": 1, "e": 1}, {"x": 1}, {"a": 90, "b": 9, "c": 1}, {f"s{i:02}": i % 4 + 1 for i in range(30)}):
        got = mixing.period_schedule(spark.createDataFrame(list(quanta.items()), "source string, q long")).orderBy("slot").collect()
        assert [r.source for r in got] == plain_edf(quanta, sum(quanta.values()))
        assert [r.slot for r in got] == list(range(sum(quanta.values()))) and all(r.release <= r.slot < r.deadline for r in got)


@pytest.mark.parametrize("weights", [{"a": 0.9, "b": 0.0999, "c": 0.0001}, {"a": 5.0, "b": 3, "c": 1.5}, None])
def test_mixing_stays_within_one_block_of_its_targets(spark, weights):
    sizes = {"a": 3000, "b": 900, "c": 330} | ({} if weights else {"d": 40, None: 75, "": 50})
    rows = [(i, s, 1, 2, "x", None) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, k long, q long, first string, slot long")
    got = mixing.mix_sources(df, weights, block=1).collect()
    assert len(got) == len(rows) and len({r.mix_position for r in got}) == len(rows)
    assert all(r.release <= r.slot < r.deadline and (r.k, r.q, r["first"]) == (1, 2, "x") for r in got)
    share = weights or {r.source: r.q for r in mixing.source_slots(spark.createDataFrame(list(sizes.items()), "source string, rows long")).collect()}
    total = sum(Fraction(str(v)) for v in share.values())
    slots = defaultdict(list)
    for r in got:
        slots[r.source].append(r.slot)
    last = min(max(s) for s in slots.values())  # until a source has ended
    for s, own in slots.items():
        w, done, own = Fraction(str(share[s])) / total, 0, sorted(own)
        assert len(own) == sizes[s] == len(set(own))
        for t in range(last + 1):
            done += done < len(own) and own[done] == t
            assert abs(done - (t + 1) * w) < 1
    again = mixing.mix_sources(df.repartition(5), weights, block=1).collect()
    assert sorted((r.doc_id, str(r.source), r.slot) for r in again) == sorted((r.doc_id, str(r.source), r.slot) for r in got)


def test_mixing_edges(spark):
    df = spark.createDataFrame([(1, "a", "t"), (1, "a", "t"), (None, None, None), (2, "b", "word " * 100000)], "doc_id long, source string, text string")
    got = mixing.mix_sources(df, {"a": 1, "b": 2}, block=1).collect()
    assert len({r.mix_position for r in got}) == 4 and {len(r.text or "") for r in got} == {0, 1, 500000}
    assert mixing.mix_sources(df.where("doc_id < 0")).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(df, {"a": 1, "b": 0.0000001})
    with pytest.raises(ValueError):
        mixing.mix_sources(spark.range(mixing.LONGEST_PERIOD + 1).selectExpr("id AS doc_id", "cast(id AS string) AS source"))


def test_mixing_many_sources(spark):
    slots = spark.range(50_000).selectExpr("cast(id AS string) AS source", "id % 3 + 1 AS q")
    got = mixing.period_schedule(slots)
    row = got.selectExpr("count(*) AS n", "count(DISTINCT slot) AS slots", "sum(q) AS q", "bool_and(release <= slot AND slot < deadline) AS fair").first()
    assert row.n == row.slots == 50_000 * 2 - 1 and row.fair


def test_mixing_equal_rows(spark):
    """Rows that repeat are spread by their count; each row keeps the rank that numbering all rows by their hash gives, up to equal ones."""
    df = spark.range(40_000).selectExpr("CASE WHEN id < 30000 THEN 7 ELSE id END AS doc_id", "CASE WHEN id < 36000 THEN 'big' ELSE 'small' END AS source", "'same' AS text")
    got = mixing.mix_sources(df).collect()
    kinds = lambda rows: Counter((r.doc_id, r.source) for r in rows)
    assert kinds(got) == kinds(df.collect()) and len({r.mix_position for r in got}) == 40_000
    order = F.md5(F.concat(F.lit("17 "), F.to_json(F.struct("doc_id", "source", "text"))))
    want = defaultdict(list)
    for r in df.select("doc_id", "source", order.alias("h")).collect():
        want[r.source].append((r.h, r.doc_id))
    for s, rows in want.items():
        assert [r.doc_id for r in sorted((g for g in got if g.source == s), key=lambda g: g.source_rank)] == [d for _, d in sorted(rows)]
        assert sorted(g.source_rank for g in got if g.source == s) == list(range(len(rows)))


# ---- line dedup


@pytest.mark.parametrize("pages_a_task,hosts", [(1024, 1024), (7, 1024), (3, 1)])
def test_line_dedup(spark, monkeypatch, pages_a_task, hosts):
    monkeypatch.setattr(line_dedup, "PAGES_A_TASK", pages_a_task)
    monkeypatch.setattr(line_dedup, "SPLIT_HOSTS", hosts)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(200):
        host = "big" if i % 3 else ("small" if i % 2 else None)
        lines = [f"own {i} {j}" for j in range(int(rng.integers(0, 4)))] + ["menu"] * int(rng.random() < 0.4) + ["  rare "] * int(rng.random() < 0.05) + [""] * int(rng.random() < 0.3)
        rows.append((i, host, "\n".join(lines), "x"))
    rows += [(900, "tiny", "one\ntwo", "x"), (901, "tiny", "one\nthree", "x"), (902, "big", None, "x"), (902, "big", None, "x"), (903, "big", "\n\n", "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, lines string")
    with_line, pages = Counter(), Counter(r[1] for r in rows)
    for _, h, t, _ in rows:
        with_line.update({(h, x.strip(" \t\r")) for x in (t or "").split("\n") if x.strip(" \t\r")})
    bad = {k for k, n in with_line.items() if n >= 5 and n > 0.1 * pages[k[0]]}
    want = []
    for d, h, t, _ in rows:
        lines = t.split("\n") if t is not None else []
        stay = [x for x in lines if (h, x.strip(" \t\r")) not in bad]
        want.append((d, None if t is None else "\n".join(stay), len(lines), len(lines) - len(stay)))
    df = df.selectExpr("*", "'h' AS host", "1 AS salt", "2 AS row", "3 AS stays", "4 AS n_lines", "5 AS boilerplate")
    got = line_dedup.dedup_lines(df, ratio=0.1, least_pages=5)
    assert {(r.lines, r.host, r.salt, r.row, r.stays, r.boilerplate) for r in got.collect()} == {("x", "h", 1, 2, 3, 5)}
    key = lambda r: tuple(map(str, r))
    assert bad and sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped_lines) for r in got.collect()), key=key) == sorted(want, key=key)
    assert line_dedup.dedup_lines(df.where("doc_id < 0").drop("lines")).count() == 0


def test_line_dedup_drops_lines_on_six_percent_but_keeps_copies(spark):
    texts = [f"own {i}\nmenu" if i < 18 else f"own {i}" for i in range(280)] + ["one text\nof two lines"] * 20
    df = spark.createDataFrame([(i, "host", t) for i, t in enumerate(texts)], "doc_id long, source string, text string")
    dropped = lambda **kw: Counter(r.n_dropped_lines for r in line_dedup.dedup_lines(df, **kw).collect())
    assert dropped() == {0: 262, 1: 18, 2: 20}
    assert dropped(copies_once=True) == {0: 282, 1: 18}


# ---- toxicity


def test_toxicity_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    lexicon = toxicity.fit_lexicon(spark, docs, labels)
    rows = toxicity.score_toxicity(docs, lexicon).join(labels, "doc_id").where(~toxicity.in_training(F.col("doc_id"))).select("score", "predicted", "toxic").collect()
    assert len(rows) > 50 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) >= 0.95


def test_toxicity_edges(spark):
    rows = [(i, ("you idiot fool" if i % 3 == 0 else "nice plain text") + " words here", int(i % 3 == 0)) for i in range(200)]
    docs = spark.createDataFrame([(i, t, "k") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.fit_lexicon(spark, docs, labels, exceptions=["fool idiot"])
    probe = spark.createDataFrame([(1, "1d10t here"), (2, "іdіоt"), (3, None), (4, ""), (5, "fool idiot"), (6, "x " * 50000), (7, "ＩＤＩＯＴ")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score_toxicity(probe, lexicon).collect()}
    assert got[1].n_hits and got[2].n_hits and got[7].n_hits and not got[5].n_hits
    assert got[3].score == got[4].score and got[3].predicted == 0 and got[1].score > got[4].score
    blank = toxicity.fit_lexicon(spark, docs, labels.where("toxic = 0"))
    assert not blank.weights and {r.predicted for r in toxicity.score_toxicity(probe, blank).collect()} == {0}


def test_fold_lowers_accented_capitals():
    assert toxicity.fold("ÉCRIT Ñandú ÜBEL") == toxicity.fold("écrit ñandú übel") == " écrit ñandú übel "


# ---- quality


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_quality_counts(spark):
    texts = [t for _, t in sf_texts(spark)] + ODD + [None, "a b c a b c", "a a a a", "x\nx\n\n \n x\nx", "A a A a A a"]
    got = quality.judge_quality(spark, docs_of(spark, texts)).collect()
    for r in got:
        n = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0]) and not (r.kept and r.base_failed)
    assert quality.judge_quality(spark, docs_of(spark, ["x"]).where("doc_id > 3")).count() == 0


def test_em_finds_good_rules():
    rng = np.random.default_rng(0)
    good = rng.random(5000) < 0.8
    votes = np.stack([np.where(rng.random(5000) < 0.3, 0, np.where((rng.random(5000) < a) == good, 1, -1)) for a in (0.95, 0.9, 0.85, 0.7)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    p, table = quality.em_posteriors(patterns, counts.astype(float))
    own = p[[int(np.flatnonzero((patterns == v).all(axis=1))[0]) for v in votes[:500]]]
    assert ((own > 0.5) == good[:500]).mean() > 0.93
    assert table[1, 0, 2] > table[0, 0, 2]


def test_quality_follows_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.judge_quality(spark, spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("NOT base_failed").collect()
    clean = [r.kept for r in got if r.quality == 1]
    assert np.mean(clean) > 0.98 and np.mean([not r.kept for r in got if r.quality == 0]) > 0.8


# ---- nearest neighbours


def test_forest_recall(spark):
    """The registered query's own parameters, on a table large enough for several leaves."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = {r.vec_id: np.array(r.embedding, float) for r in rows.collect()}
    got = defaultdict(dict)
    for r in rp_forest.nearest(spark, rows, F.col("vec_id") % 50 == 0).collect():
        got[r.query_id][r.rank] = r
    hit = total = 0
    for q in (i for i in data if i % 50 == 0):
        score = {i: float(data[q] @ x / np.linalg.norm(data[q]) / np.linalg.norm(x)) for i, x in data.items() if i != q}
        best = sorted(score, key=lambda i: (-score[i], i))[:5]
        own = [got[q][k].vec_id for k in range(1, 6)]
        assert all(abs(got[q][k].score - score[got[q][k].vec_id]) < 1e-12 for k in range(1, 6))
        hit, total = hit + len(set(best) & set(own)), total + 5
    assert hit / total >= 0.9


def test_forest_edges(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (100, None), (150, [0.0, 0.0]), (200, [float("nan"), 1.0]), (250, [1.0, None]), (300, [1.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in rp_forest.nearest(spark, df, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, i + 1, v) for i, v in enumerate((2, 3, 7, 8, 9))] + [(50, i + 1, v) for i, v in enumerate((0, 2, 3, 7, 8))]
    assert rp_forest.nearest(spark, df.where("vec_id = 100"), F.lit(True)).count() == 0


# ---- language model


def exact_tables(c, discount, strength, parent):
    """Mean number of tables of one dish with c customers, from the numbers of all ways to seat them."""
    ways = np.zeros((c + 1, c + 1))
    ways[0, 0] = 1
    for n in range(1, c + 1):
        for t in range(1, n + 1):
            ways[n, t] = ways[n - 1, t - 1] + (n - 1 - t * discount) * ways[n - 1, t]
    w = np.array([ways[c, t] * np.prod([strength + discount * i for i in range(t)]) * parent**t for t in range(1, c + 1)])
    return (w * np.arange(1, c + 1)).sum() / w.sum()


@pytest.mark.parametrize("most", [64, 3])
def test_gibbs_scans_reach_the_exact_posterior(most):
    """Thousands of restaurants with one dish each; fewer moves in a scan change its pace, not where it leads."""
    rng = np.random.default_rng(1)
    for c, d, strength, parent in ((2, 0.5, 1.0, 0.3), (7, 0.6, 1.0, 0.3), (12, 0.3, 2.0, 0.05)):
        customers = np.full(4000, c)
        used = seating.first_tables(customers, 1.0, d, rng)
        sizes, tables, seen = seating.first_sizes(customers, used), used.copy(), []
        for scan in range(120):
            used, sizes = seating.reseat(customers, used, sizes, np.arange(4000), tables, np.full(4000, parent), d, strength, rng, most)
            if scan > 70:
                seen.append(used.mean())
        assert (np.add.reduceat(sizes, np.cumsum(used) - used) == c).all() and (tables == used).all() and sizes.min() > 0
        assert abs(np.mean(seen) - exact_tables(c, d, strength, parent)) < 0.02


def test_all_customers_of_frequent_dishes_move_in_a_scan(monkeypatch):
    """Where each customer has a table of its own, a scan brings most of them together; a part of the dishes is in memory at a time."""
    monkeypatch.setattr(seating, "HELD", 30000, raising=False)
    rng, c = np.random.default_rng(4), np.repeat([3000, 65, 9000], 30)
    in_group = c.copy()
    used, sizes = seating.reseat(c, c, seating.first_sizes(c, c), np.arange(90), in_group, np.full(90, 0.1), 0.5, 1.0, rng)
    assert (np.add.reduceat(sizes, np.cumsum(used) - used) == c).all() and sizes.min() > 0 and (used == in_group).all()
    assert (used.reshape(3, 30).mean(axis=1) < 0.7 * c.reshape(3, 30)[:, 0]).all()


@pytest.mark.parametrize("c, d, strength, parent", [(70, 0.6, 1.0, 0.3), (100, 0.4, 5.0, 0.02)])
def test_blocks_of_customers_reach_the_exact_posterior(c, d, strength, parent):
    rng, customers = np.random.default_rng(5), np.full(1000, c)
    used = np.full(1000, 4)
    sizes, tables, seen = seating.first_sizes(customers, used), used.copy(), []
    for scan in range(90):
        used, sizes = seating.reseat_blocks(customers, used, sizes, np.arange(1000), tables, np.full(1000, parent), d, strength, rng)
        if scan > 40:
            seen.append(used.mean())
    assert (np.add.reduceat(sizes, np.cumsum(used) - used) == c).all() and (tables == used).all() and sizes.min() > 0
    assert abs(np.mean(seen) / exact_tables(c, d, strength, parent) - 1) < 0.03


def literal_scan(rows, parent, discount, strength, rng):
    """One customer after another leaves and sits down again; rows: (restaurant, dish) to a list of table sizes."""
    for (u, w), own in rows.items():
        for _ in range(sum(own)):
            k = rng.choice(len(own), p=np.array(own) / sum(own))
            own[k] -= 1
            if not own[k]:
                del own[k]
            total = sum(len(x) for (v, _), x in rows.items() if v == u)
            weights = np.array([*(n - discount for n in own), (strength + discount * total) * parent[w]])
            k = rng.choice(len(weights), p=weights / weights.sum())
            if k == len(own):
                own.append(1)
            else:
                own[k] += 1


def test_gibbs_scans_agree_with_a_literal_sampler():
    """Restaurants with several dishes, which share their tables."""
    rng, counts, parent = np.random.default_rng(2), {(0, 0): 6, (0, 1): 2, (0, 2): 1, (1, 0): 3, (1, 2): 4}, [0.5, 0.3, 0.2]
    rows, want = {k: [n] for k, n in counts.items()}, np.zeros(len(counts))
    for scan in range(3000):
        literal_scan(rows, parent, 0.6, 0.8, rng)
        want += np.array([len(x) for x in rows.values()]) * (scan >= 100) / 2900
    copies = 1500
    c = np.tile(list(counts.values()), copies)
    group = np.tile([u for u, _ in counts], copies) + 2 * np.repeat(np.arange(copies), len(counts))
    base = np.tile([parent[w] for _, w in counts], copies)
    used, sizes = np.ones(len(c), np.int64), c.copy()
    tables, got = np.bincount(group), np.zeros(len(counts))
    for scan in range(60):
        used, sizes = seating.reseat(c, used, sizes, group, tables, base, 0.6, 0.8, rng)
        got += used.reshape(copies, -1).mean(axis=0) * (scan >= 20) / 40
    assert np.abs(got - want).max() < 0.06


def test_root_follows_its_customers():
    rng = np.random.default_rng(3)
    c, wanted = rng.integers(0, 9, 500), rng.integers(0, 40, 500)
    used = seating.first_tables(c, 0.5, 0.5, rng)
    used, sizes = seating.follow(c, used, seating.first_sizes(c, used), wanted, 0.5, 0.5, rng)
    assert sizes.min() > 0 and (np.bincount(np.repeat(np.arange(500), used), weights=sizes, minlength=500) == wanted).all()


def test_root_follows_many_customers_as_one_by_one(monkeypatch):
    """More moves than go one by one, up from none and from some, and down: as many tables and as large ones."""
    c, wanted, found = np.repeat([0, 5, 300, 400], 600), np.repeat([200, 300, 20, 399], 600), []
    for most in (64, 1000):
        monkeypatch.setattr(seating, "RESEATED", most)
        rng = np.random.default_rng(7)
        used = seating.first_tables(c, 0.5, 0.5, rng)
        used, sizes = seating.follow(c, used, seating.first_sizes(c, used), wanted, 0.5, 0.5, rng)
        dish = np.repeat(np.arange(len(c)), used)
        assert sizes.min() > 0 and (np.bincount(dish, weights=sizes, minlength=len(c)) == wanted).all()
        found.append([x.reshape(4, 600).mean(axis=1) for x in (used, np.bincount(dish, weights=sizes**2.0) / wanted**2)])
    assert np.allclose(*found, rtol=0.06), found


def test_likelihoods_and_log_gamma():
    x = np.array([0.02, 0.5, 1, 3.3, 1000, 1e9])
    assert np.allclose(seating.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-9)
    i, j = 20, 5
    d, s = seating.DISCOUNTS[i], seating.STRENGTHS[j]
    # two restaurants: tables of 3 and 1, and of 2
    want = sum(math.log(k - d) for k in (1, 2, 1)) + math.log(s + d) - sum(math.log(s + k) for k in (1, 2, 3)) - math.log(s + 1)
    got = seating.table_likelihood(np.array([3, 1, 2]))[i] + seating.restaurant_likelihood(np.array([4, 2]), np.array([2, 1])).reshape(len(seating.DISCOUNTS), -1)[i, j]
    assert got == pytest.approx(want)


def plain_base(rows, held):
    def tokens(t):
        return [*WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), "\0end"]

    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return {i: (len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows}


@pytest.mark.parametrize("bucket_tokens", [2_000_000, 3000])
def test_lm_counts_and_scores(spark, monkeypatch, bucket_tokens):
    monkeypatch.setattr(hpy_lm, "BUCKET_TOKENS", bucket_tokens)
    monkeypatch.setattr(hpy_lm, "UNIT_TOKENS", bucket_tokens * 3)
    monkeypatch.setattr(hpy_lm, "SAMPLED", 1)
    rows = [(i, t) for i, t in sf_texts(spark)] + [(5000, ""), (5001, None), (5002, "zzz unseen qqq"), (5003, "the " * 3000), (None, "no id"), (-7, "negative id")]

    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, kind string, `to` long")
    got = {r.doc_id: r for r in hpy_lm.score_texts(spark, df, F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))).collect()}
    assert len(got) == len(rows)
    for i, (n, known, total, base) in plain_base(rows, held).items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score <= 0
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert hpy_lm.score_texts(spark, df.where("doc_id < -10"), F.lit(False)).count() == 0


def test_lm_repeats_and_no_training(spark):
    df = spark.createDataFrame([(1, "a b a b"), (1, "a b a b"), (2, "a b")], "doc_id long, text string")
    got = hpy_lm.score_texts(spark, df, F.lit(False)).collect()
    same = [r for r in got if r.doc_id == 1]
    assert len(same) == 2 and same[0].score == pytest.approx(same[1].score) and same[0].n_known == 5
    none = hpy_lm.score_texts(spark, df, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == pytest.approx(0) and r.score == pytest.approx(0) for r in none)


def test_lm_is_a_distribution():
    """Over all words and one unknown, the probabilities of each context add up to one, large contexts in several buckets included."""
    rng = np.random.default_rng(2)
    names = np.sort(hpy_lm.mix(np.arange(1, 7, dtype=np.uint64)))
    words = hpy_lm.mix(np.arange(100, 150, dtype=np.uint64))
    buckets, out = [], []
    for number in range(3):
        ctx, w = names[rng.integers(0, 6, 300)], words[rng.integers(0, 50, 300)]
        pairs = {"a": ctx, "b": np.ones(300, np.int64), "c": w, "d": rng.integers(0, 4, 300), "e": np.array([1])}
        merged = hpy_lm._merge(hpy_lm.Inbox(hpy_lm._rows([("pairs", number, 9, pairs)])), names)
        inbox = hpy_lm.Inbox(hpy_lm._rows([r for r in merged if r[0] != "list"]))
        b = hpy_lm.Bucket(inbox)
        used = seating.first_tables(b.c[b.many], 0.5, 0.6, rng)
        b.seated(used, seating.first_sizes(b.c[b.many], used))
        buckets.append(b)
        out += b.out(number, 1, (inbox.one("names", "a"), inbox.one("names", "b")), inbox)
    inbox = hpy_lm.Inbox(hpy_lm._rows([r for r in out if r[0] == "sum"]))
    shard = hpy_lm.Shard(inbox)
    used = seating.first_tables(shard.c0, 0.5, 0.4, rng)
    s = {"d0": 0.4, "theta0": 2.0, "d1": 0.6, "theta1": 0.7}
    replies = shard.out(inbox, used, seating.first_sizes(shard.c0, used), s)
    count = next(unpacked["c"] for kind, *_, unpacked in replies if kind == "stat")
    s |= {"C0": count[0], "T0": count[1], "V": shard.words}
    s["base"] = (s["theta0"] + s["d0"] * s["T0"]) / (s["V"] + 1)
    unknown = s["base"] / (s["theta0"] + s["C0"])
    seen, below, tables, customers = np.zeros(6), np.zeros(6), None, None
    for number, b in enumerate(buckets):
        b.hear(hpy_lm.Inbox(hpy_lm._rows([r for r in replies if r[0] == "reply" and r[1] == number])))
        np.add.at(seen, b.ctx, b.probability(s))
        np.add.at(below, b.ctx, b.parent(s))
        tables, customers = b.tables, b.customers
    assert customers.tolist() == sum(x.by_context(x.c) for x in buckets).tolist() and tables.tolist() == sum(x.by_context(x.t) for x in buckets).tolist()
    total = sum((np.maximum(shard.c0 - s["d0"] * used, 0) + s["base"]) / (s["theta0"] + s["C0"])) + unknown
    assert total == pytest.approx(1)
    for u in range(6):
        new = (s["theta1"] + s["d1"] * tables[u]) / (s["theta1"] + customers[u])
        assert seen[u] - new * below[u] + new == pytest.approx(1)


def test_lm_words_of_one_class_have_own_restaurants(spark, monkeypatch):
    """Two words whose hashes share their first 16 bits; as one context, x and y would be as likely after both."""
    names = [f"w{i}" for i in range(3000)]
    _, ctx, _ = hpy_lm.tokens_of([f"{n} x" for n in names])
    top = (ctx.astype(np.uint64)[1::3] >> np.uint64(48)).tolist()
    a, b = next((names[top.index(t)], names[i]) for i, t in enumerate(top) if top.index(t) < i)
    texts = [f"{a} x"] * 60 + [f"{b} y"] * 60 + [f"c{i} d{i}" for i in range(50)] + [f"{a} x", f"{a} y", f"{b} x", f"{b} y"]
    rows = hpy_lm.score_texts(spark, docs_of(spark, texts), F.col("doc_id") >= 170).collect()
    ax, ay, bx, by = [r.score for r in sorted(rows, key=lambda r: r.doc_id)[170:]]
    assert ax - ay > 1 and by - bx > 1


def test_lm_refuses_texts_in_another_order(spark, monkeypatch):
    """Waves read the texts again; a table that deals them to other units in between is an error, not a wrong score."""
    real = hpy_lm._deal

    def shuffled(docs, large, buckets, wave):
        return real(docs.repartitionByRange(2, "text") if wave else docs.repartition(2, "text"), large, buckets, wave)

    monkeypatch.setattr(hpy_lm, "_deal", shuffled)
    df = docs_of(spark, [f"a{i} b{i % 7} c" for i in range(50)])
    with pytest.raises(Exception, match="another order"):
        hpy_lm.score_texts(spark, df, F.lit(False)).collect()


@pytest.mark.parametrize("texts", [["a"], ["b"], ["foo"], ["a", ""], ["b", None, "foo b"], ["x y", "y x", "x", "", "z"]])
def test_lm_tiny_tables(spark, texts):
    """Few words leave a wave without buckets of its own."""
    rows = hpy_lm.score_texts(spark, docs_of(spark, texts), F.col("doc_id") > 2).collect()
    train = [t or "" for t in texts[:3]]
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    assert all(r.train_tokens == sum(len(t.split()) + 1 for t in train) and r.n_tokens == len((texts[r.doc_id] or "").split()) + 1 and r.score <= 0 for r in rows)


# ---- pipeline


CLASHES = "score predicted n_hits n_lines n_dropped_lines slot block_no release deadline mix_position source_rank k q first lines hit host row others position deal grp node n g".split()


def test_pipeline_against_plain_code(spark, tmp_path):
    """Every stage over odd rows with columns of clashing names, held against plain code."""
    import corpus_pipeline

    rows = [(i, f"own words of page {i} are here and {i * i} more of them\nshared menu line", "big" if i % 3 else "small") for i in range(120)]
    rows += [(200 + i, f"you idiot fool number {i} " * 3, "big") for i in range(60)]
    rows += [(300, None, "big"), (301, "", None), (302, "", None), (303, "long " * 200_000, "big"), (5, rows[5][1], "small"), (None, "no id at all but words", None)]
    clash = {c: 0.125 for c in CLASHES}
    schema = "doc_id long, text string, source string, n_chars int, lang string, " + ", ".join(f"`{c}` double" for c in CLASHES)
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "en", *clash.values()) for r in rows], schema)
    spark.createDataFrame([(i, 1, int(200 <= i < 260)) for i in [*range(120), *range(200, 260)]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    order = lambda xs: sorted(xs, key=lambda r: tuple(map(str, r)))

    def through(stage, docs, name):
        out = stage(spark, docs, str(tmp_path))
        if name != "pack":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert stage(spark, docs.where("doc_id < 0"), str(tmp_path)).count() == 0
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "pack":
            assert all(out.where(f"`{c}` IS NULL OR `{c}` != 0.125").count() == 0 for c in ("score", "slot", "k"))
            assert out.where(" OR ".join(f"`{c}` != 0.125" for c in CLASHES)).count() == 0
        return out

    clean = through(corpus_pipeline.drop_toxic, docs, "tox")
    kept = [r for r in rows if not (r[1] or "").startswith("you idiot")]
    assert order((r.doc_id, r.text, r.source) for r in clean.collect()) == order(kept)

    lines = through(corpus_pipeline.drop_boilerplate, clean, "lines")
    kept = [(d, t.removesuffix("\nshared menu line") if t else t, s) for d, t, s in kept]
    assert order((r.doc_id, r.text, r.source) for r in lines.collect()) == order(kept)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in lines.collect())

    one = through(corpus_pipeline.drop_near_duplicates, lines, "near")
    words = {r[1] for r in kept if r[1]}
    assert len(words) == len(kept) - 4  # one copy, a null and two empty texts
    assert sorted(str(r.text) for r in one.collect()) == sorted(map(str, [*words, None, "", ""]))
    assert {r.source for r in one.where("doc_id = 5").collect()} <= {"big", "small"} and one.where("doc_id = 5").count() == 1

    mixed = through(corpus_pipeline.mix, one, "mix")
    assert order((r.doc_id, r.text) for r in mixed.collect()) == order((r.doc_id, r.text) for r in one.collect())

    packed = through(corpus_pipeline.pack, mixed, "pack").collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    whole = defaultdict(list)
    for r in packed:
        whole[r.position].append((r.start, r.ids))
    numbered = {r.position: r.text for r in corpus_pipeline.numbered(mixed.select("doc_id", "text"), "position").collect()}
    assert whole.keys() == numbered.keys()
    for p, parts in whole.items():
        assert sum((x for _, x in sorted(parts)), []) == [*tok.encode(numbered[p] or "", add_special_tokens=False).ids, 1]


def test_pipeline_runs(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "sequence_id").collect()
    assert {r.doc_id for r in packed} <= {r.doc_id for r in docs.select("doc_id").collect()} and packed


def test_packing_follows_the_mixture(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, f"text {i}", "en", "small" if i % 10 == 0 else "big", 9) for i in range(9000)]
    corpus_pipeline.mix(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "").write.parquet(f"{tmp_path}/mixed")
    got = corpus_pipeline.pack(spark, spark.read.parquet(f"{tmp_path}/mixed"), "").select("doc_id", "sequence_id").collect()
    runs = defaultdict(list)
    for r in got:
        runs[r.sequence_id >> 32].append(r.doc_id % 10 == 0)
    assert sorted(runs) == [0, 1, 2, 3, 4] and [len(runs[k]) for k in range(5)] == [2048] * 4 + [9000 - 4 * 2048]
    assert abs(np.mean(runs[0]) - 0.25) < 0.02  # weights are the roots of 8100 and 900; raw, it is 0.1


def test_pipeline_hands_texts_to_python_in_small_batches(spark):
    import corpus_pipeline
    import pyarrow as pa

    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 1000) AS text", "'a' AS source")
    before = spark.conf.get(key)
    try:
        for stage in (corpus_pipeline.drop_boilerplate, corpus_pipeline.pack):
            spark.conf.set(key, "64m")
            if stage is corpus_pipeline.drop_boilerplate:
                stage(spark, docs, SF)
            else:
                stage(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
            found = docs.mapInArrow(held, "n long, bytes long").agg(F.sum("n").alias("n"), F.max("bytes").alias("most")).first()
            assert found.n == 2000 and found.most < 5 << 20
            spark.conf.set(key, "1m")
            corpus_pipeline._aside(docs, lambda d: d)
            assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)
