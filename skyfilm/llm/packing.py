"""First-fit-decreasing packing of tokenised documents, in randomised groups.

Documents are cut at multiples of the capacity, so only their last pieces are shorter than a
sequence.  Each group of documents is packed on its own: pieces in falling order of length go to the
first open sequence with room, found in a tournament tree over the room that is left.  Full pieces
need no search: those with the same number in their documents are numbered together, so that one long document does not fill a group.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import U64, joined, mix, sized, word_spans

_CACHED = 1 << 19
_ENCODED = 4096
#: letters that the tokenizer neither composes nor splits
_LETTERS = re.compile("[a-zß-öø-ÿ]{1,64}")
# fixed values: the settings of a tokenizer file under which a text's ids are those of its words
_WORD_END = "</w>"
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """Latin-1 characters to those that byte-level vocabularies write bytes with: printable ones are themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _of_words(settings: dict) -> bool:
    """Whether a tokenizer file lower-cases, splits and marks word ends in the way that the shortcuts rest on."""
    normal, split, model = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}, settings["model"]
    steps = split.get("pretokenizers", [])
    return (
        normal.get("normalizers") == _NORMAL
        and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
        and steps[0]["pattern"].get("Regex") == _SPLIT and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        and model.get("type") == "BPE" and model.get("end_of_word_suffix") == _WORD_END and not model.get("dropout") and not model.get("ignore_merges")
        and all(t["content"].startswith("<|") and not t["normalized"] and not t["single_word"] and not t["lstrip"] and not t["rstrip"] for t in settings["added_tokens"])
    )


_SMALL = np.zeros(256, dtype=bool)
_SMALL[ord("a") : ord("z") + 1] = True
#: second bytes of the letters from U+00DF on; 0xB7 is the division sign
_SECOND = np.zeros(256, dtype=bool)
_SECOND[[b for b in range(0x9F, 0xC0) if b != 0xB7]] = True
_MARK = np.isin(np.arange(256), list(b".,;:!?"))


def _letters_and_marks(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of small letters with marks behind them are cut between the two, as the tokenizer cuts there."""
    pair = (buf[:-1] == 0xC3) & _SECOND[buf[1:]]
    small, mark = _SMALL[buf], _MARK[buf]
    small[:-1] |= pair
    small[1:] |= pair
    letters = np.concatenate([[0], np.cumsum(small, dtype=np.int64)])
    marks = np.concatenate([[0], np.cumsum(mark, dtype=np.int64)])
    middle = start + letters[end] - letters[start]
    cut = (middle > start) & (middle < end) & (letters[middle] - letters[start] == middle - start) & (marks[end] - marks[middle] == end - middle)
    at = np.flatnonzero(cut)
    return np.insert(start, at + 1, middle[at]), np.insert(end, at, middle[at])


class WordEncoder:
    """Token ids of texts by a tokenizer file.

    A tokenizer whose tokens never span white space gives a text the ids of its words in order.  So the words of a
    batch are told apart by 64-bit hashes, words met before come from a bounded table, and ids are gathered in arrays.
    Plain letters and the marks behind them count as two words; letters go straight to the
    tokenizer's model, many in one call whose result is cut at word ends.  A-Z are lower-cased up front, but not in texts with the
    start of a special token, as those are matched first, nor in texts with combining marks (U+0300 to U+036F), as
    some compose with a small letter only and the library composes first.

    Files with other settings than these shortcuts rest on are left to the library, whole texts at a time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = _of_words(settings)
        if self.by_word:
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocabulary = settings["model"]["vocab"]
            self.is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.is_end[[i for t, i in vocabulary.items() if t.endswith(_WORD_END)]] = True
            self.table = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self._forget()

    def _forget(self) -> None:
        """known: sorted hashes; at and size: where each word's ids are in flat."""
        self.known, self.at, self.size, self.flat = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and how many each has."""
        parts = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _of_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.model.encode(" ".join(words).encode().decode("latin-1").translate(self.table | {32: " "}), add_special_tokens=False).ids, np.uint32)
        size = np.diff(np.flatnonzero(self.is_end[ids]), prepend=-1)
        return (ids, size) if len(size) == len(words) else self._plain(words)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        plain = np.array([_LETTERS.fullmatch(w) is not None for w in words])
        size = np.zeros(len(words), np.int64)
        at = np.zeros(len(words), np.int64)
        for own, encode in ((np.flatnonzero(plain), self._of_letters), (np.flatnonzero(~plain), self._plain)):
            if len(own):
                # the library's results are many times the size of their ids, so a few words at a time
                parts = [encode([words[i] for i in own[k : k + _ENCODED].tolist()]) for k in range(0, len(own), _ENCODED)]
                size[own] = np.concatenate([n for _, n in parts])
                at[own] = len(self.flat) + np.cumsum(size[own]) - size[own]
                self.flat = np.concatenate([self.flat, *(ids for ids, _ in parts)])
        where = np.searchsorted(self.known, hashes)
        self.known, self.at, self.size = np.insert(self.known, where, hashes), np.insert(self.at, where, at), np.insert(self.size, where, size)

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin (one more entry than texts)."""
        if not self.by_word:
            ids, size = self._plain([t or "" for t in texts]) if texts else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            return ids, np.cumsum([0, *size])
        raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        whole, begins = joined([r if b"<|" in r or b"\xcc" in r or b"\xcd" in r else r.lower() for r in raws])
        h, start, end = word_spans(whole, _letters_and_marks)
        u, first, back = np.unique(h, return_index=True, return_inverse=True)
        new = _lacks(self.known, u)
        if len(new) and len(self.known) + len(new) > _CACHED:
            self._forget()
            new = np.arange(len(u))
        if len(new):
            self._learn(u[new], [whole[a:b].decode("utf-8", "replace") for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
        place = np.searchsorted(self.known, u)[back]
        size = self.size[place]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(self.at[place] - (ends - size), size) + np.arange(total)]
        return flat, np.concatenate([[0], ends])[np.searchsorted(start, begins)]


def _lacks(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Positions of the values that a sorted list lacks."""
    if not len(known):
        return np.arange(len(values))
    return np.flatnonzero(known[np.minimum(np.searchsorted(known, values), len(known) - 1)] != values)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, with_ids: bool = True, position: str | None = None) -> DataFrame:
    """Pieces of docs(doc_id, text): doc_id, start, length, doc_tokens, ids_crc32, deal, and ids if asked for.

    A null text counts as empty and still has its end id.  deal is the document's number in the column
    ``position``, or a random one.
    """
    import os

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, row = WordEncoder(tokenizer), TaskContext.get().partitionId() << 40
        for batch in sized(batches, "text"):
            n = batch.num_rows
            flat, begins = encoder.ids(batch.column("text").to_pylist())
            # each document's end id goes behind its own
            flat, begins = np.insert(flat, begins[1:], end_id).astype("<u4"), begins + np.arange(n + 1)
            deal = np.asarray(batch.column("position")) if position else (mix(np.arange(row, row + n, dtype=U64)) >> U64(1)).astype(np.int64)
            row += n
            total = np.diff(begins)
            pieces = -(-total // capacity)
            doc = np.repeat(np.arange(n), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
            length = np.minimum(capacity, total[doc] - start)
            at = begins[doc] + start
            view = memoryview(flat.tobytes())
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            arrays = [batch.column("doc_id").take(pa.array(doc)), *(pa.array(x) for x in (start, length, total[doc], np.array(crc, np.int64), deal[doc]))]
            if with_ids:
                arrays.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(flat)).astype(np.int32)), pa.array(flat.view(np.int32))))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "deal", *(["ids"] if with_ids else [])])

    schema = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, deal long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *([F.col(position).cast("long").alias("position")] if position else [])).mapInArrow(run, schema)


class Bins:
    """Open sequences of one group: a tournament tree over the room of each, twice as wide whenever all are used."""

    def __init__(self, capacity: int):
        self.capacity, self.leaves, self.room = capacity, 1, [capacity] * 2

    def place(self, n: int) -> tuple[int, int]:
        """The first sequence with room for n tokens, and the offset there."""
        if self.room[1] < n:
            wide = [self.capacity] * (4 * self.leaves)
            level = 1
            while level <= self.leaves:
                wide[2 * level : 3 * level] = self.room[level : 2 * level]
                level *= 2
            self.leaves, self.room = 2 * self.leaves, wide
        room, at = self.room, 1
        while at < self.leaves:
            at = 2 * at if room[2 * at] >= n else 2 * at + 1
        found = at - self.leaves, self.capacity - room[at]
        room[at] -= n
        at >>= 1
        while at:
            left, right = room[2 * at], room[2 * at + 1]
            best = left if left > right else right
            if room[at] == best:
                break
            room[at] = best
            at >>= 1
        return found


def pack_pieces(pieces: DataFrame, documents: int | None, capacity: int = 2048, per_group: int = 2048) -> DataFrame:
    """pieces with sequence_id and offset; documents tells how many groups of about per_group to form.

    Groups are dealt at random, so that copies of a document or of an id spread over all of them.  Without
    documents, deal numbers them from 0 and each run of per_group numbers is a group, so sequence_id follows the runs.
    sequence_id is group * 2**32 + bin, and for full pieces group * 2**32 + 2**31 + number in the document * 2**12 + place, which is
    unique up to 2**19 full pieces of a document.  Equal lengths keep the order of doc_id and start.  A task holds at most one piece
    of each document of a group at a time.
    """
    group = F.expr(f"deal div {per_group}") if documents is None else F.pmod("deal", F.lit(max(1, -(-documents // per_group))))
    columns = [c for c in pieces.columns if c != "deal" or documents is None]

    def run(table: pa.Table) -> pa.Table:
        grp, part = table.column("grp")[0].as_py() << 32, table.column("part")[0].as_py()
        table = table.select(columns).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        if part:
            places = [((1 << 31) + ((part - 1) << 12) + i, 0) for i in range(table.num_rows)]
        else:
            bins = Bins(capacity)
            places = [bins.place(n) for n in table.column("length").to_pylist()]
        sequence, offset = [grp + x for x, _ in places], [x for _, x in places]
        return table.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in columns) + ", sequence_id long, offset long"
    part = F.when(F.col("length") == capacity, F.expr(f"1 + start div {capacity}")).otherwise(0)
    return pieces.withColumns({"grp": group, "part": part}).groupBy("grp", "part").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, per_group: int = 2048, with_ids: bool = True, position: str | None = None) -> DataFrame:
    """Pack all docs(doc_id, text): one row for each piece, with its ids if asked for.

    Null and empty texts are one piece, the end id.  Rows with the same doc_id are separate documents; other columns of docs are not looked at, whatever their names.
    An empty table gives no pieces.  position names a column that numbers the documents from 0: groups are then
    runs of that order, sequences are numbered along it, and each piece carries its document's number in ``position``.
    """
    packed = pack_pieces(token_pieces(docs, tokenizer, capacity, end_id, with_ids, position), None if position else docs.count(), capacity, per_group)
    return packed.withColumnRenamed("deal", "position") if position else packed
