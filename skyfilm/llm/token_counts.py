"""Token counts of whole texts; huge ones by overlapping chunks that are resynchronised.

A boundary before a single space between two alphanumeric characters is stable: the tokenizer's split
pattern never matches across it, whatever stands further left or right.  Chunk encodings that share such
a boundary in their overlap are spliced there and give the tokens of the whole text; where an overlap
has none, or the encodings differ next to it, the overlap is widened.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator, Sized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import byte_letters
from .words import sized

CHUNK = 1 << 15
OVERLAP = 256
_LONG_RUN = re.compile(r"\S{400}")
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")


def token_bytes(path: str) -> list[bytes]:
    """What each id of a byte-level BPE file stands for: added tokens their text, others the bytes that their letters write."""
    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    byte_of = {c: b for b, c in byte_letters().items()}
    known = {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t, i in settings["model"]["vocab"].items()}
    known |= {t["id"]: t["content"].encode() for t in settings["added_tokens"]}
    return [known.get(i, b"") for i in range(max(known) + 1)]


def width_of(ids: Sized) -> str:
    """The array type that holds every id."""
    return "<u2" if len(ids) <= 1 << 16 else "<u4"


class ByteEncoder:
    """Ids as the tokenizers library gives them for a byte-level BPE file.

    ranks, if given, holds the same vocabulary for a faster library.  It serves texts of Latin
    letters without very long words, where both split alike; all others go to the tokenizers library.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        self.width = width_of(range(max(self.slow.get_vocab().values()) + 1))
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            special = {t.content: i for i, t in self.slow.get_added_tokens_decoder().items() if t.content.encode() not in table}
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens=special)

    def _simple(self, text: str) -> bool:
        return self.fast is not None and not _BEYOND_LATIN.search(text) and not _LONG_RUN.search(text)

    def counts(self, texts: list[str]) -> list[int]:
        out: list[int | None] = [len(self.fast.encode(t, allowed_special="all")) if self._simple(t) else None for t in texts]
        rest = [i for i, n in enumerate(out) if n is None]
        for i, e in zip(rest, self.slow.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = len(e.ids)
        return out

    def flat_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin (one more entry than texts)."""
        parts: list[np.ndarray | None] = [self.fast.encode_to_numpy(t, allowed_special="all") if self._simple(t) else None for t in texts]
        rest = [i for i, p in enumerate(parts) if p is None]
        for k in range(0, len(rest), 256):
            some = rest[k : k + 256]
            for i, e in zip(some, self.slow.encode_batch_fast([texts[i] for i in some], add_special_tokens=False), strict=True):
                parts[i] = np.array(e.ids, np.uint32)
        return np.concatenate([np.zeros(0, np.uint32), *parts]).astype(np.uint32), np.cumsum([0, *map(len, parts)])

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the character at which each begins."""
        if self._simple(text):
            ids = self.fast.encode(text, allowed_special="all")
            ends = np.cumsum([len(b) for b in self.fast.decode_tokens_bytes(ids)]) if ids else np.zeros(0, np.int64)
            begins = np.concatenate([[0], ends[:-1]]) if ids else ends
            raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            chars = np.cumsum((raw & 0xC0) != 0x80) - 1
            return np.array(ids, np.int64), chars[begins] if ids else begins
        e = self.slow.encode(text, add_special_tokens=False)
        return np.array(e.ids, np.int64), np.array([a for a, _ in e.offsets], np.int64)


def _stable(text: str, low: int, high: int) -> Iterator[int]:
    """Stable boundaries in [low, high), from the middle of that range outwards to the right, then the left."""
    middle = (low + high) // 2
    for a, b, step in ((middle, high, 1), (middle - 1, low - 1, -1)):
        for p in range(a, b, step):
            if text[p] == " " and 0 < p < len(text) - 1 and text[p - 1].isalnum() and text[p + 1].isalnum():
                yield p


def count_by_chunks(text: str, encode: Callable[[str], tuple[np.ndarray, np.ndarray]], chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text of any length, from chunk encodings of about chunk characters each."""
    total, begin = 0, 0
    while len(text) - begin > chunk:
        width, spliced = overlap, None
        end = begin + chunk
        while spliced is None and end < len(text):
            ids, at = encode(text[begin:end])
            at = at + begin
            # the next chunk's view of the overlap, seen with as much text after it
            lead = max(begin + 1, end - width)
            ids2, at2 = encode(text[lead : min(len(text), end + width)])
            at2 = at2 + lead
            for p in _stable(text, lead + 1, end - 1):
                i, j = int(np.searchsorted(at, p)), int(np.searchsorted(at2, p))
                if i < len(at) - 1 and j < len(at2) - 1 and at[i] == p == at2[j] and ids[i] == ids2[j]:
                    spliced = (p, i)
                    break
            else:
                width *= 2
                end = min(len(text), max(end + width, begin + chunk))
        if spliced is None:
            break
        total += spliced[1]
        begin = spliced[0]
    return total + len(encode(text[begin:])[0])


def token_counts(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row for each row of docs(doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    Null texts count as empty: no bytes and no tokens.  Texts longer than chunk characters are counted
    by overlapping chunks, the others at once.  Other columns of docs are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder(tokenizer, ranks, pattern)
        for batch in sized(batches, "text", 1 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = iter(encoder.counts([t for t in texts if len(t) <= chunk]))
            tokens = pa.array([next(n) if len(t) <= chunk else count_by_chunks(t, encoder.encode, chunk, overlap) for t in texts], pa.int64())
            size = pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, tokens, pc.greater(tokens, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
