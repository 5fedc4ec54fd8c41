"""Token ids of whole texts from content-defined chunks that documents share, and texts back from ids.

Texts are cut where a rolling hash of the bytes before a place says so, so passages that documents share are cut alike
wherever they stand.  Chunks that batches of documents share go to the bucket of their digest, which encodes each
once and sends its ids to each unit of documents that holds it; all other chunks are encoded where they are.
Units put their documents together and repair the joins: a join between chunks agrees with the encoding of the whole
text if it is a stable boundary; around any other, the text between the nearest stable boundaries is encoded anew, further and
further out until its ends are boundaries of tokens in what is there already.

A boundary before a single space between two letters or digits is stable, as the tokenizer's split pattern never matches across it.

Which chunks are shared is told by a bitmap of fixed size.  Hashes that meet in it send some more chunks to buckets, where they are encoded
like others, so results do not hang on its size.  Documents find their unit by a hash of themselves, not by where they were read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect, bisect_left
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import bitmap, flat, maybe
from .token_counts import ByteEncoder, token_bytes, width_of
from .words import U64, sized, window_hashes

#: bytes before a place that its rolling hash covers; one stable boundary in so many cuts; chunks above a length are cut at one place in so many; longest chunk
WINDOW, STABLE_ONE_IN, LONG, OTHER_ONE_IN, LONGEST = 48, 64, 1 << 12, 1024, 1 << 14
#: bytes of text in a batch, in a unit and in a bucket, about
BATCH, UNIT, BUCKET = 1 << 21, 1 << 22, 1 << 24
_ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])
_BLOCK = 1 << 20
_DIGEST = 16
_ROW = "to long, kind string, payload binary"


class Chunks:
    """The chunks of a batch of texts: bytes, the text that each is of, and whether it begins at a stable boundary."""

    def __init__(self, texts: list[str | None]):
        raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        whole = b"".join(raws)
        buf = np.frombuffer(whole, np.uint8)
        edges = np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64)
        # several edges are equal where texts are empty; the last of them begins the text with the byte
        places, others = [edges[:-1][np.diff(edges) > 0]], [np.zeros(0, np.int64)]
        for at in range(0, len(buf), _BLOCK):
            lead = max(0, at - WINDOW)
            part = buf[lead : at + _BLOCK + 1]
            h = window_hashes(part, WINDOW) >> U64(32)
            middle = np.zeros(len(part), dtype=bool)
            middle[1:-1] = (part[1:-1] == 32) & _ALNUM[part[:-2]] & _ALNUM[part[2:]]
            for found, cuts in ((places, middle & (h % U64(STABLE_ONE_IN) == 0)), (others, (h % U64(OTHER_ONE_IN) == 1) & (part & 0xC0 != 0x80))):
                p = np.flatnonzero(cuts) + lead
                p = p[(p >= at) & (p < min(at + _BLOCK, len(buf)))]
                text = np.searchsorted(edges, p, side="right") - 1
                # the window and the byte behind the place lie inside the text
                found.append(p[(p - edges[text] >= WINDOW) & (p + 1 < edges[text + 1])])
        begins, others = np.sort(np.concatenate(places)), np.concatenate(others).tolist()
        text = (np.searchsorted(edges, begins, side="right") - 1).tolist()
        begins = begins.tolist()
        self.chunks: list[bytes] = []
        self.firm: list[bool] = []
        self.text: list[int] = []
        for a, b, t in zip(begins, [*begins[1:], len(whole)], text, strict=True):
            firm = True
            if b - a > LONG:
                for q in [*others[bisect(others, a) : bisect_left(others, b)], b]:
                    while q - a > LONGEST:
                        # far from any cut: at a fixed distance, at the begin of a character
                        near = a + LONGEST // 2
                        while whole[near] & 0xC0 == 0x80:
                            near += 1
                        self._add(whole[a:near], firm, t)
                        a, firm = near, False
                    if q < b:
                        self._add(whole[a:q], firm, t)
                        a, firm = q, False
            self._add(whole[a:b], firm, t)
        self.digests = [hashlib.blake2b(c, digest_size=_DIGEST).digest() for c in self.chunks]
        self.hashes = np.frombuffer(b"".join(self.digests), "<u8")[::2].astype(U64)

    def _add(self, chunk: bytes, firm: bool, text: int) -> None:
        self.chunks.append(chunk)
        self.firm.append(firm)
        self.text.append(text)


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays one after another, each with its length in bytes before it, compressed."""
    raws = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    return zstandard.compress(b"".join(x for r in raws for x in (len(r).to_bytes(8, "little"), r)))


def _unpack(payload: bytes, *kinds: str) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(payload), 0, []
    for kind in kinds:
        n = int.from_bytes(raw[at : at + 8], "little")
        out.append(np.frombuffer(raw[at + 8 : at + 8 + n], kind))
        at += 8 + n
    return out


def _pieces(raw: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    ends, whole = np.cumsum(sizes).tolist(), raw.tobytes()
    return [whole[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    to, kind, payload = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array(kind), pa.array(payload, pa.binary())], ["to", "kind", "payload"])


def _seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of a batch's distinct chunks."""
    for batch in sized(batches, "text", BATCH):
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(Chunks(batch.column("text").to_pylist()).hashes).view(np.int64))], ["h"])


def asked(chunks: dict[bytes, tuple[bytes, set[int]]]) -> bytes:
    """Chunks by digest with the units that hold them, as a payload."""
    units = [sorted(u) for _, u in chunks.values()]
    texts = [c for c, _ in chunks.values()]
    return _pack(b"".join(chunks), np.array([len(c) for c in texts], "<i4"), b"".join(texts), np.array([len(u) for u in units], "<i4"), np.array([x for u in units for x in u], "<i8"))


def _ask(buckets: int, shared) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A batch's chunks that others may hold, for the bucket of each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = flat(shared.value)
        for batch in sized(batches, "text", BATCH):
            cut, unit = Chunks(batch.column("text").to_pylist()), batch.column("unit").to_pylist()
            own: dict[int, dict[bytes, tuple[bytes, set[int]]]] = {}
            for i in np.flatnonzero(maybe(bits, cut.hashes)).tolist():
                d = cut.digests[i]
                own.setdefault(int.from_bytes(d[8:], "little") % buckets, {}).setdefault(d, (cut.chunks[i], set()))[1].add(unit[cut.text[i]])
            if own:
                yield _rows([(b, "ask", asked(chunks)) for b, chunks in own.items()])

    return run


def _encode(tokenizer: str, ranks: str | None, pattern: str | None) -> Callable[[pa.Table], pa.Table]:
    """A bucket's distinct chunks, encoded once each, for each unit that holds them."""

    def run(table: pa.Table) -> pa.Table:
        encoder = ByteEncoder(tokenizer, ranks, pattern)
        known: dict[bytes, int] = {}
        texts: list[bytes] = []
        wanted: dict[int, set[int]] = {}
        for payload in table.column("payload").to_pylist():
            digests, sizes, raw, counts, units = _unpack(payload, f"S{_DIGEST}", "<i4", "S1", "<i4", "<i8")
            digests = _pieces(digests, np.full(len(sizes), _DIGEST))
            at = 0
            for d, chunk, n in zip(digests, _pieces(raw, sizes), counts.tolist(), strict=True):
                k = known.setdefault(d, len(known))
                if k == len(texts):
                    texts.append(chunk)
                for u in units[at : at + n].tolist():
                    wanted.setdefault(u, set()).add(k)
                at += n
        ids, at = encoder.flat_ids([c.decode("utf-8", "surrogatepass") for c in texts])
        names, out = list(known), []
        for unit, own in wanted.items():
            own = np.array(sorted(own), np.int64)
            size = at[own + 1] - at[own]
            out.append((unit, "ids", _pack(b"".join(names[k] for k in own.tolist()), size.astype("<i4"), ids[_spread(at[own], size)].astype(encoder.width))))
        return pa.Table.from_batches([_rows(out)])

    return run


_SHARED, _FIRM = 1, 2


def _own(shared, tokenizer: str, ranks: str | None, pattern: str | None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each unit the documents of a batch: ids of the chunks that no other batch holds, digests of the others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bits = ByteEncoder(tokenizer, ranks, pattern), flat(shared.value)
        for batch in sized(batches, "text", BATCH):
            cut = Chunks(batch.column("text").to_pylist())
            away = maybe(bits, cut.hashes)
            known: dict[bytes, int] = {}
            number = [-1 if x else known.setdefault(c, len(known)) for c, x in zip(cut.chunks, away.tolist(), strict=True)]
            ids, at = encoder.flat_ids([c.decode("utf-8", "surrogatepass") for c in known])
            number, text = np.array(number, np.int64), np.array(cut.text, np.int64)
            kinds = (away * _SHARED + np.array(cut.firm, dtype=bool) * _FIRM).astype(np.uint8)
            many = np.bincount(text, minlength=batch.num_rows)
            doc = batch.column("doc_id")
            docs, missing, units = np.asarray(doc.fill_null(0)), np.asarray(doc.is_null()), np.asarray(batch.column("unit"))
            out = []
            for u in np.unique(units).tolist():
                rows = units == u
                mine = np.flatnonzero(rows[text]) if len(text) else text
                k = number[mine][~away[mine]]
                size = at[k + 1] - at[k]
                out.append((u, "own", _pack(docs[rows].astype("<i8"), missing[rows].astype("u1"), many[rows].astype("<i8"), kinds[mine], size.astype("<i4"), ids[_spread(at[k], size)].astype(encoder.width), b"".join(cut.digests[i] for i in mine[away[mine]].tolist()))))
            yield _rows(out)

    return run


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indexes of runs of given starts and sizes, one after another."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def decoded(pieces: list[bytes], ids: np.ndarray) -> bytes:
    """The bytes that ids stand for."""
    return b"".join([b"".join([pieces[i] for i in ids[k : k + _BLOCK].tolist()]) for k in range(0, len(ids), _BLOCK)])


def text_of(pieces: list[bytes], ids: bytes) -> str:
    """The text of packed ids, with the library's sign for bytes that are none."""
    return decoded(pieces, np.frombuffer(ids, "<u4")).decode("utf-8", "replace")


def _is_stable(text: str, p: int) -> bool:
    return p <= 0 or p >= len(text) or (text[p] == " " and p + 1 < len(text) and text[p - 1].isalnum() and text[p + 1].isalnum())


class Joiner:
    """Puts the ids of chunks together so that they are those of the whole text; the tokenizer is loaded once a join needs it."""

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        self.pieces = token_bytes(tokenizer)
        self.lengths = np.array([len(p) for p in self.pieces])
        self.width = width_of(self.pieces)
        self.encoder = cache(lambda: ByteEncoder(tokenizer, ranks, pattern))

    def join(self, parts: list[np.ndarray], firm: list[bool]) -> np.ndarray:
        """Ids of a text from those of its chunks; firm tells which chunks are known to begin at stable boundaries.

        The ids between two stable boundaries do not hang on what lies around them, so those around a join that
        is none are encoded anew between the nearest ones at which tokens begin.
        """
        ids = np.concatenate(parts)
        raw = decoded(self.pieces, ids)
        text = raw.decode("utf-8", "surrogatepass")
        begins = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80), len(raw))
        tokens = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        joins = np.searchsorted(begins, tokens[np.cumsum([len(p) for p in parts])])

        def agreed(p: int, step: int) -> tuple[int, int]:
            """The next stable boundary from p at which a token begins, and which."""
            while True:
                p += step
                while not _is_stable(text, p):
                    p += step
                i = int(np.searchsorted(tokens, begins[p]))
                if tokens[i] == begins[p]:
                    return p, i

        repairs: list[tuple[int, int, int, int]] = []
        for k in range(1, len(parts)):
            p = int(joins[k - 1])
            if firm[k] or _is_stable(text, p) or (repairs and p < repairs[-1][2]):
                continue
            low, i = agreed(p, -1)
            high, j = agreed(p, 1)
            if repairs and low < repairs[-1][2]:
                low, i, _, _ = repairs.pop()
            repairs.append((low, i, high, j))
        out, done = [], 0
        for low, i, high, j in repairs:
            out += [ids[done:i], self.encoder().flat_ids([text[low:high]])[0]]
            done = j
        return np.concatenate([*out, ids[done:]])


def _assemble(tokenizer: str, ranks: str | None, pattern: str | None, with_text: bool) -> Callable[[pa.Table], pa.Table]:
    """A unit's documents from their own chunks and the shared ones, and the texts that their ids stand for."""

    def run(table: pa.Table) -> pa.Table:
        joiner = Joiner(tokenizer, ranks, pattern)
        width = joiner.width
        shared: dict[bytes, np.ndarray] = {}
        own = []
        for kind, payload in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist(), strict=True):
            if kind == "own":
                own.append(payload)
                continue
            digests, sizes, ids = _unpack(payload, f"S{_DIGEST}", "<i4", width)
            ends = np.cumsum(sizes, dtype=np.int64)
            shared.update(zip(_pieces(digests, np.full(len(sizes), _DIGEST)), np.split(ids, ends[:-1]), strict=True))
        docs, missing, out = [], [], []
        for payload in own:
            doc, none, many, kinds, sizes, ids, digests = _unpack(payload, "<i8", "u1", "<i8", "u1", "<i4", width, f"S{_DIGEST}")
            docs.append(doc)
            missing.append(none)
            mine = iter(np.split(ids, np.cumsum(sizes, dtype=np.int64)[:-1]) if len(sizes) else [])
            others = iter(_pieces(digests, np.full(int((kinds & _SHARED).sum()), _DIGEST)) if len(digests) else [])
            parts = [shared[next(others)] if x & _SHARED else next(mine) for x in kinds.tolist()]
            firm = (kinds & _FIRM > 0).tolist()
            at = 0
            for n in many.tolist():
                own_parts = parts[at : at + n]
                whole = joiner.join(own_parts, firm[at : at + n]) if not all(firm[at : at + n]) else np.concatenate(own_parts) if n else ids[:0]
                out.append(whole.astype("<u4").tobytes())
                at += n
        table = pa.table({"doc_id": pa.array(np.concatenate(docs), mask=np.concatenate(missing).astype(bool)), "ids": pa.array(out, pa.binary())})
        return table.append_column("text", pa.array([text_of(joiner.pieces, raw) for raw in out], pa.string())) if with_text else table

    return run


def encode_documents(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, unit: int = UNIT, bucket: int = BUCKET, with_text: bool = False) -> DataFrame:
    """One row for each row of docs(doc_id, text): doc_id and ids, its token ids as little-endian unsigned 32-bit integers; with_text adds what decode_documents does.

    Null texts count as empty and have no ids.  Rows that repeat give a row each, from one unit; an empty table gives none; other columns are
    not looked at.  Units and buckets follow the size of the texts, so each holds about as much text at any size of the corpus; a chunk that most
    texts hold comes to its bucket once from each batch of documents and leaves it once for each unit.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    units, buckets = -(-size // unit) or 1, -(-size // bucket) or 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("unit", F.pmod(F.xxhash64("doc_id", "text"), F.lit(units)))
    hashes = texts.select("text").mapInArrow(_seen, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    shared = spark.sparkContext.broadcast(bitmap(hashes, "h"))
    sent = texts.select("unit", "text").mapInArrow(_ask(buckets, shared), _ROW).repartition(buckets, "to")
    told = sent.groupBy("to").applyInArrow(_encode(tokenizer, ranks, pattern), _ROW)
    own = texts.mapInArrow(_own(shared, tokenizer, ranks, pattern), _ROW)
    return told.union(own).repartition(units, "to").groupBy("to").applyInArrow(_assemble(tokenizer, ranks, pattern, with_text), "doc_id long, ids binary" + ", text string" * with_text)


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """Rows of encoded(doc_id, ids) with text, as the library decodes their ids with special tokens kept."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = token_bytes(tokenizer)
        for batch in sized(batches, "ids"):
            texts = [text_of(pieces, raw.as_py()) for raw in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
