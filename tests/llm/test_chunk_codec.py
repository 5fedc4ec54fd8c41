import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyfilm.llm import chunk_codec, queries
from skyfilm.llm.token_counts import ByteEncoder

SF = "/root/testdata/sf0.001"
PATH, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
SHARED = "A passage that many documents hold, " * 60


def odd_texts():
    rng = random.Random(8)
    letters = "abcde ABC 12 .,'\n\téß日本語\U0001f642́<|endoftext|>"
    texts = [None, "", " ", "a", "<|endoftext|>", "x <|endoftext|> y", SHARED, "one " + SHARED + " two", SHARED + "日" + SHARED, "日本語" * 9000, "x" * 50_000, " " * 40_000, "<|endoftext|>" * 3000, "0123456789abcdef" * 4000]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 3000))) for _ in range(60)]
    texts += ["".join(rng.choice("日本語 <|endoftext|>'s\n") for _ in range(20_000)) for _ in range(4)]
    return texts + ["word and more words " * 30_000] + ["same"] * 3


def library():
    tok = Tokenizer.from_file(PATH)
    tok.no_truncation()
    tok.no_padding()
    return tok


def test_documents_equal_the_library(spark):
    tok, texts = library(), odd_texts()
    rows = [(i % 70, t, 0.125) for i, t in enumerate(texts)] + [(None, "no id", 0.125)]
    df = spark.createDataFrame(rows, "doc_id long, text string, unit double").withColumns({c: F.lit(1) for c in ("to", "kind", "payload", "ids")})
    for unit, bucket in ((1 << 23, 1 << 24), (20_000, 50_000)):
        encoded = chunk_codec.encode_documents(df.repartition(3), PATH, RANKS, public_tokenizers.PATTERN, unit, bucket)
        got = chunk_codec.decode_documents(encoded, PATH).collect()
        want = Counter((d, np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes(), t or "") for d, t, _ in rows)
        assert Counter((r.doc_id, bytes(r.ids), r.text) for r in got) == want


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string").where("doc_id > 1")
    assert chunk_codec.decode_documents(chunk_codec.encode_documents(df, PATH), PATH).count() == 0


def test_shared_passages_are_cut_alike():
    passage = " ".join(f"word{i * i % 997}" for i in range(4000))
    texts = [passage, "", "Some other begin. " + passage, passage[:200] + "edited" + passage[200:] + " more", "日本語" * 9000, None, " "]
    cut = chunk_codec.Chunks(texts)
    sets = [[c for c, t in zip(cut.chunks, cut.text, strict=True) if t == i] for i in range(len(texts))]
    assert [b"".join(s).decode() for s in sets] == [t or "" for t in texts]
    assert len(sets[0]) > 20 and all(len(set(sets[0]) - set(sets[i])) <= 3 for i in (2, 3))
    assert max(map(len, cut.chunks)) <= chunk_codec.LONGEST


@pytest.mark.parametrize("seed", range(4))
def test_any_cut_is_repaired(seed):
    """Chunks cut anywhere, none of them known to be stable."""
    rng, tok = random.Random(seed), library()
    joiner = chunk_codec.Joiner(PATH, RANKS, public_tokenizers.PATTERN)
    for text in [t for t in odd_texts() if t and len(t) < 30_000]:
        at = sorted({0, len(text), *(rng.randrange(len(text)) for _ in range(rng.randint(1, 30)))})
        flat, begins = joiner.encoder().flat_ids([text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)])
        parts = [flat[a:b] for a, b in zip(begins[:-1], begins[1:], strict=True)]
        assert joiner.join(parts, [False] * len(parts)).tolist() == tok.encode(text, add_special_tokens=False).ids


def test_chunks_of_all_units_are_encoded_once(monkeypatch):
    """A bucket hands its encoder each chunk once, whoever asks."""
    seen = []
    real = ByteEncoder.flat_ids
    monkeypatch.setattr(ByteEncoder, "flat_ids", lambda self, texts: seen.extend(texts) or real(self, texts))
    import pyarrow as pa

    def row(unit, chunks):
        return (0, "ask", chunk_codec.asked({hashlib.blake2b(c, digest_size=16).digest(): (c, {unit}) for c in chunks}))

    table = pa.Table.from_batches([chunk_codec._rows([row(1, [b"a b", b"c d"]), row(2, [b"c d"]), row(3, [b"c d", b"e"])])])
    out = chunk_codec._encode(PATH, RANKS, public_tokenizers.PATTERN)(table)
    assert seen == ["a b", "c d", "e"] and sorted(out.column("to").to_pylist()) == [1, 2, 3]


def test_query_equals_the_library(spark):
    tok = library()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op11_chunk_codec(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ids = tok.encode(docs[r.doc_id], add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
