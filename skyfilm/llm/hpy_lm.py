"""Hierarchical Pitman-Yor language model over all training texts, and its scores of all texts.

Every context (the word before, by its 64-bit hash) is a restaurant, and all of them share the root restaurant over words as their
parent, whose base is uniform over the training vocabulary and one unknown word.  The seating is sampled by
Gibbs: customers leave at random and sit down again given all others; tables of a context are customers of the
root, which come and go with them.  After each sweep discounts and strengths are drawn given the seating.
The predictive probabilities of the last sweeps are averaged.

Restaurants live in buckets of contexts, the root in shards of words.  A sweep is two steps: buckets reseat given
the root of the last sweep, and send the tables of each word; shards add them up, let the root follow, and
reply.  A context with more tokens than a part of a bucket is dealt by word to several buckets, and its
number of tables is then added up by the shards too.  So no list of words or contexts grows with the corpus in one place but that of
such contexts, at most ``8 * tokens / BUCKET_TOKENS`` of them.

Texts go through the model in units of about a million tokens.  A unit asks each bucket for the pairs that it holds there, once
each, and gets one probability for each back; which of its documents hold a pair stays in the unit's own row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import seating
from .scratch import Scratch
from .words import U64, mix, sized, word_hashes

UNIT_TOKENS = 1_000_000
BUCKET_TOKENS = 2_000_000
LEAST_BUCKETS = 24
SHARD_BUCKETS = 4
SAMPLED = 64
#: score waves are a multiple of deal waves, and each takes its buckets from one of them
DEAL_WAVES, SCORE_WAVES = 2, 4
SWEEPS, AVERAGED = 4, 2
END, BEGIN = U64(0x51A7C0DE0E0D0001), U64(0x51A7C0DE0E0D0002)


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, contexts, and the text that each token belongs to."""
    h, at = word_hashes(texts)
    w = np.insert(h, at[1:], END)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(at) + 1)
    before = np.empty_like(w)
    before[1:] = w[:-1]
    before[(at[:-1] + np.arange(len(texts)))] = BEGIN
    return w, mix(before), doc


def _units(batches: Iterable[pa.RecordBatch], tokens: int) -> Iterator[tuple]:
    """(w, ctx, doc, other columns) of about so many tokens at a time, whole texts only."""
    held, count = [], 0
    for batch in sized(batches, "text"):
        held.append((*tokens_of(batch.column("text").to_pylist()), batch.drop_columns(["text"])))
        count += len(held[-1][0])
        if count >= tokens:
            yield _joined(held)
            held, count = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple]) -> tuple:
    shift = np.cumsum([0, *(b.num_rows for *_, b in held[:-1])])
    return (*(np.concatenate([x[i] for x in held]) for i in (0, 1)), np.concatenate([x[2] + s for x, s in zip(held, shift, strict=True)]), pa.Table.from_batches([x[3] for x in held]))


# ---- messages: arrays in a row, addressed to a bucket, a shard or a unit

FIELDS = "abcdef"
_ROW = "kind string, to long, frm long, " + ", ".join(f"{f} binary" for f in FIELDS)
_ARROW = pa.schema([("kind", pa.string()), ("to", pa.int64()), ("frm", pa.int64()), *((f, pa.binary()) for f in FIELDS)])


def pack(x: np.ndarray) -> bytes:
    """An array as bytes, whole numbers in as few bytes each as they all need."""
    x = np.asarray(x)
    if x.dtype.kind in "bui":
        top = int(x.max(initial=0))
        x = x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))
    return x.dtype.char.encode() + x.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw[1:], raw[:1].decode())


def _rows(rows: list[tuple]) -> pa.Table:
    """Rows of (kind, to, frm, arrays by field)."""
    columns = [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], *([pack(r[3][f]) if f in r[3] else None for r in rows] for f in FIELDS)]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW.types, strict=True)], schema=_ARROW)


class Inbox:
    """The rows of one bucket, shard or unit, by kind, in the order of their senders."""

    def __init__(self, table: pa.Table):
        self.rows: dict[str, list[dict]] = {}
        for row in sorted(table.to_pylist(), key=lambda r: (r["frm"] is not None, r["frm"])):
            self.rows.setdefault(row["kind"], []).append(row)
        self.to = table.column("to")[0].as_py()

    def all(self, kind: str, field: str) -> np.ndarray:
        parts = [unpack(r[field]) for r in self.rows.get(kind, [])]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def one(self, kind: str, field: str) -> np.ndarray:
        return unpack(self.rows[kind][0][field])


def _kinds(table: DataFrame, *kinds: str) -> DataFrame:
    return table.where(F.col("kind").isin(*kinds)).select("kind", "to", "frm", *FIELDS)


def _step(scratch: Scratch, name: str, work: Callable[[Inbox], list[tuple]], *tables: DataFrame) -> DataFrame:
    """work over the rows of each address, written by kind."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.union(t)
    return scratch.keep(rows.groupBy("to").applyInArrow(lambda table: _rows(work(Inbox(table))), _ROW), name, by="kind")


def _totals(table: DataFrame) -> dict[str, np.ndarray]:
    """Sums of the arrays in rows of kind "stat", by field; their lengths are fixed."""

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in FIELDS:
                sums = [unpack(x).astype(np.float64) for x in batch.column(f).to_pylist() if x is not None]
                if sums:
                    total = np.sum(sums, axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array([f] * len(total)), pa.array(np.arange(len(total))), pa.array(total)], ["field", "at", "v"])

    found = _kinds(table, "stat").mapInArrow(spread, "field string, at long, v double").groupBy("field", "at").agg(F.sum("v").alias("v")).collect()
    out: dict[str, np.ndarray] = {}
    for r in sorted(found, key=lambda r: (r.field, r["at"])):
        out[r.field] = np.append(out.get(r.field, np.zeros(0)), r.v)
    return out


# ---- dealing


def _large_contexts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes of contexts that fill a part of a bucket, to how many buckets each is dealt, and about how many tokens there are.

    From a sample of the texts: it steers what lies where, and results are the same for any such list.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, "text"):
            u, n = np.unique(tokens_of(batch.column("text").to_pylist())[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n), pa.array([int(n.sum())] + [0] * (len(n) - 1))], ["ctx", "n", "all"])

    part = BUCKET_TOKENS // 8
    counts = docs.select("text").sample(1 / SAMPLED, seed=11).mapInArrow(run, "ctx long, n long, all long").groupBy("ctx").agg(F.sum("n").alias("n"), F.sum("all").alias("all"))
    total = F.sum("all").alias("all")
    large = F.array_sort(F.collect_list(F.when(F.col("n") * SAMPLED >= part, F.struct("ctx", "n")))).alias("large")
    found = counts.agg(total, large).first()
    pairs = sorted((np.int64(r.ctx).view(np.uint64), -(-r.n * SAMPLED // part)) for r in found["large"])
    return np.array([c for c, _ in pairs], np.uint64), np.array([n for _, n in pairs], np.uint64), int(found["all"] or 0) * SAMPLED


def _position(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Position in a sorted list, or -1."""
    if not len(known):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, at, -1)


def _bucket_of(w: np.ndarray, ctx: np.ndarray, large: tuple[np.ndarray, np.ndarray], buckets: int) -> np.ndarray:
    own = ctx % U64(buckets)
    at = _position(ctx, large[0])
    wide = np.flatnonzero(at >= 0)
    own[wide] = (own[wide] + mix(w[wide]) % large[1][at[wide]]) % U64(buckets)
    return own.astype(np.int64)


def _deal(docs: DataFrame, large, buckets: int, wave: int) -> DataFrame:
    """Rows "pairs" of a unit for each bucket of the wave, and in the first wave a row "unit" of what stays with it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for w, ctx, doc, rows in _units(batches, UNIT_TOKENS):
            number += 1
            bucket = _bucket_of(w, ctx, large.value, buckets)
            if buckets <= 1 << 16:
                bucket = bucket.astype(np.uint16)
            order = np.lexsort((w, ctx, bucket))
            w, ctx, bucket, doc = w[order], ctx[order], bucket[order], doc[order]
            check = int((w * np.arange(1, len(w) + 1, dtype=U64)).sum(dtype=np.uint64) >> U64(16))
            train = np.asarray(rows.column("train").to_numpy())
            new = np.ones(len(w), dtype=bool)
            new[1:] = (w[1:] != w[:-1]) | (ctx[1:] != ctx[:-1])
            first = np.flatnonzero(new)
            c = np.add.reduceat(train[doc].astype(np.int64), first)
            pw, pc, pb = w[first], ctx[first], bucket[first]
            cut = np.searchsorted(pb, np.arange(buckets + 1))
            out = []
            for b in range(wave, buckets, DEAL_WAVES):
                i, j = cut[b], cut[b + 1]
                if i < j:
                    starts = np.flatnonzero(np.diff(pc[i:j], prepend=~pc[i]))
                    out.append(("pairs", b, number, {"a": pc[i:j][starts], "b": np.diff(starts, append=j - i), "c": pw[i:j], "d": c[i:j], "e": np.array([check])}))
            if wave == 0:
                ids = rows.column("doc_id").combine_chunks()
                # ids travel as floats of the same bits, as whole numbers are packed without a sign
                out.append(("unit", -number, None, {
                    "a": np.asarray(ids.fill_null(0)).astype(np.int64).view(np.float64), "b": np.asarray(ids.is_null()) * 2 + ~train, "c": np.bincount(doc, minlength=len(train)),
                    "d": np.diff(first, append=len(w)), "e": doc, "f": np.append(np.diff(cut), check),
                }))
            yield from _rows(out).to_batches()

    return docs.mapInArrow(run, _ROW)


def _merge(inbox: Inbox, large: np.ndarray) -> list[tuple]:
    """A bucket's pairs of all units as one model row, the names of its words and large contexts, and for each unit the places of its pairs."""
    if "unit" in inbox.rows:
        r = inbox.rows["unit"][0]
        return [("unit", inbox.to, None, {f: unpack(r[f]) for f in FIELDS})]
    units = inbox.rows["pairs"]
    size = np.array([len(unpack(r["d"])) for r in units])
    ctx = np.repeat(inbox.all("pairs", "a"), inbox.all("pairs", "b").astype(np.int64))
    w, c = inbox.all("pairs", "c"), inbox.all("pairs", "d").astype(np.int64)
    order = np.lexsort((w, ctx))
    new = np.ones(len(w), dtype=bool)
    new[1:] = (np.diff(w[order]) != 0) | (np.diff(ctx[order]) != 0)
    first = np.flatnonzero(new)
    place = np.empty(len(w), np.int64)
    place[order] = np.cumsum(new) - 1
    w, ctx, c = w[order][first], ctx[order][first], np.add.reduceat(c[order], first)
    words, word = np.unique(w, return_inverse=True)
    starts = np.flatnonzero(np.diff(ctx, prepend=~ctx[0]))
    wide = np.flatnonzero(_position(ctx[starts], large) >= 0)
    out = [
        ("model", inbox.to, None, {"a": word, "b": np.diff(starts, append=len(w)), "c": c, "d": wide}),
        ("names", inbox.to, None, {"a": words, "b": ctx[starts][wide]}),
    ]
    ends = np.cumsum(size)
    for r, i, j in zip(units, (ends - size).tolist(), ends.tolist(), strict=True):
        own = place[i:j]
        out.append(("list", inbox.to, r["frm"], {"a": np.diff(own, prepend=0), "e": unpack(r["e"])}))
    return out


# ---- sweeps


class Bucket:
    """The restaurants of a bucket: pairs by context and word, c customers and t tables each."""

    def __init__(self, inbox: Inbox):
        self.word, runs, self.c, self.wide = (inbox.one("model", f).astype(np.int64) for f in "abcd")
        self.ctx = np.repeat(np.arange(len(runs)), runs)
        self.contexts, self.words = len(runs), int(self.word.max(initial=-1)) + 1
        self.many = np.flatnonzero(self.c > 1)
        self.t = (self.c > 0).astype(np.int64)

    def seated(self, used: np.ndarray, sizes: np.ndarray) -> None:
        self.t[self.many], self.sizes = used, sizes

    def by_context(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.ctx, weights=x, minlength=self.contexts).astype(np.int64)

    def hear(self, inbox: Inbox, kind: str = "reply") -> None:
        """Customers and tables of contexts, and the root's share of each word, from what shards reply."""
        self.customers, self.tables = self.by_context(self.c), self.by_context(self.t)
        self.customers[self.wide], self.tables[self.wide] = inbox.all(kind, "c"), inbox.all(kind, "b")
        self.share = inbox.all(kind, "a").astype(np.float64)

    def parent(self, s: dict) -> np.ndarray:
        return ((np.maximum(self.share, 0) + s["base"]) / (s["theta0"] + s["C0"]))[self.word]

    def sweep(self, s: dict, rng: np.random.Generator) -> None:
        own = self.many
        used, sizes = seating.reseat(self.c[own], self.t[own], self.sizes, self.ctx[own], self.tables, self.parent(s)[own], s["d1"], s["theta1"], rng)
        self.seated(used, sizes)

    def probability(self, s: dict) -> np.ndarray:
        p = (s["theta1"] + s["d1"] * self.tables)[self.ctx] * self.parent(s) + np.maximum(self.c - s["d1"] * self.t, 0)
        return p / (s["theta1"] + self.customers)[self.ctx]

    def out(self, number: int, shards: int, names: tuple[np.ndarray, np.ndarray] | None, links: Inbox) -> list[tuple]:
        """State, sums to shards, and likelihoods; names go along the first time, later how many of each shard is known."""
        t, c = np.bincount(self.word, weights=self.t, minlength=self.words), np.bincount(self.word, weights=self.c, minlength=self.words)
        own_t, own_c = self.by_context(self.t), self.by_context(self.c)
        if names:
            cut, wide_cut = (np.searchsorted(_shard(x, shards), np.arange(shards + 1)) for x in names)
            senders = [k for k in range(shards) if cut[k] < cut[k + 1] or wide_cut[k] < wide_cut[k + 1]]
            spans = [(cut[k], cut[k + 1], wide_cut[k], wide_cut[k + 1]) for k in senders]
        else:
            senders = [r["frm"] for r in links.rows["reply"]]
            ends, wide_ends = (np.cumsum([0, *(len(unpack(r[f])) for r in links.rows["reply"])]) for f in "ab")
            spans = list(zip(ends[:-1], ends[1:], wide_ends[:-1], wide_ends[1:], strict=True))
        rows = [("state", number, None, {"a": self.t[self.many], "b": self.sizes})]
        for k, (i, j, x, y) in zip(senders, spans, strict=True):
            fields = {"a": t[i:j].astype(np.int64), "b": own_t[self.wide][x:y]}
            if names:
                fields |= {"c": c[i:j].astype(np.int64), "d": own_c[self.wide][x:y], "e": names[0][i:j], "f": names[1][x:y]}
            rows.append(("sum", k, number, fields))
        narrow = np.ones(self.contexts, dtype=bool)
        narrow[self.wide] = False
        likelihood = seating.restaurant_likelihood(own_c[narrow], own_t[narrow])
        seen = np.array([self.c.sum(), (self.c == 1).sum(), (self.c == 2).sum()], np.float64)
        return [*rows, ("stat", -1, number, {"a": seating.table_likelihood(self.sizes), "b": likelihood, "c": seen})]


def _shard(names: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the hash, so that a bucket's sorted names are in the order of their shards."""
    return ((names >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)


class Shard:
    """A part of the root: its words, and the large contexts whose numbers it adds up."""

    def __init__(self, inbox: Inbox):
        self.senders = [r["frm"] for r in inbox.rows["sum"]]
        if "names" in inbox.rows:
            self.word, self.wide = ([unpack(r[f]).astype(np.int64) for r in inbox.rows["link"]] for f in "ab")
            self.words, self.contexts = (int(x) for x in inbox.one("names", "a"))
        else:
            self.word, self.words = self._numbers(inbox, "e")
            self.wide, self.contexts = self._numbers(inbox, "f")
        self.c0 = self._sum(inbox, "a", self.word, self.words)
        self.tables = self._sum(inbox, "b", self.wide, self.contexts)

    @staticmethod
    def _numbers(inbox: Inbox, field: str) -> tuple[list[np.ndarray], int]:
        parts = [unpack(r[field]) for r in inbox.rows["sum"]]
        names, at = np.unique(np.concatenate(parts), return_inverse=True)
        return np.split(at, np.cumsum([len(p) for p in parts])[:-1]), len(names)

    @staticmethod
    def _sum(inbox: Inbox, field: str, at: list[np.ndarray], size: int) -> np.ndarray:
        total = np.zeros(size, np.int64)
        for own, r in zip(at, inbox.rows["sum"], strict=True):
            total[own] += unpack(r[field]).astype(np.int64)
        return total

    def out(self, inbox: Inbox, used: np.ndarray, sizes: np.ndarray, s: dict) -> list[tuple]:
        first = "names" not in inbox.rows
        customers = self._sum(inbox, "d", self.wide, self.contexts) if first else inbox.one("names", "b").astype(np.int64)
        share = (self.c0 - s["d0"] * used).astype(np.float32)
        rows = [("root", inbox.to, None, {"a": self.c0, "b": used, "c": sizes})]
        if first:
            count = self._sum(inbox, "c", self.word, self.words)
            rows.append(("names", inbox.to, None, {"a": np.array([self.words, self.contexts]), "b": customers}))
            rows += [("link", inbox.to, b, {"a": w, "b": x}) for b, w, x in zip(self.senders, self.word, self.wide, strict=True)]
            rows += [("count", b, inbox.to, {"a": count[w]}) for b, w in zip(self.senders, self.word, strict=True)]
        rows += [("reply", b, inbox.to, {"a": share[w], "b": self.tables[x], "c": customers[x]}) for b, w, x in zip(self.senders, self.word, self.wide, strict=True)]
        words = (count > 0).sum() if first else 0
        stat = {"a": seating.table_likelihood(sizes), "b": seating.restaurant_likelihood(customers, self.tables), "c": np.array([self.c0.sum(), used.sum(), words], np.float64)}
        return [*rows, ("stat", -1, inbox.to, stat)]


def _settings(s: dict, from_buckets: dict, from_shards: dict, number: int, drawn: bool) -> dict:
    """Discounts and strengths given the seating, and the root's totals."""
    rng = np.random.default_rng([number, 7])
    s = dict(s)
    root = from_shards.get("c", np.zeros(3))
    s["C0"], s["T0"] = float(root[0]), float(root[1])
    if not number:
        s["V"], s["N"] = int(root[2]), int(from_buckets.get("c", np.zeros(3))[0])
    if drawn and s["C0"]:
        s["d1"], s["theta1"] = seating.draw(from_buckets["a"], from_buckets["b"] + from_shards["b"], rng)
        s["d0"], s["theta0"] = seating.draw(from_shards["a"], seating.restaurant_likelihood(np.array([s["C0"]]), np.array([s["T0"]])), rng)
    s["base"] = (s["theta0"] + s["d0"] * s["T0"]) / (s["V"] + 1)
    return s


def _train(scratch: Scratch, merged: DataFrame, buckets: int, sweeps: int, averaged: int) -> tuple[list[dict], list[DataFrame], list[DataFrame]]:
    """Settings, states of buckets and rows from shards after each sweep, the first of them where sampling starts.

    What is behind the last step and not averaged is dropped on the way.
    """
    spark = scratch.spark
    shards = -(-buckets // SHARD_BUCKETS)
    start = {"d1": 0.8, "theta1": 1.0, "d0": 0.8, "theta0": 1.0}

    def begin(inbox: Inbox) -> list[tuple]:
        b, rng = Bucket(inbox), np.random.default_rng([0, inbox.to])
        used = seating.first_tables(b.c[b.many], 0.2, start["d1"], rng)
        b.seated(used, seating.first_sizes(b.c[b.many], used))
        return b.out(inbox.to, shards, (inbox.one("names", "a"), inbox.one("names", "b")), inbox)

    def begin_root(inbox: Inbox) -> list[tuple]:
        shard = Shard(inbox)
        used = seating.first_tables(shard.c0, 0.5, start["d0"], np.random.default_rng([1, inbox.to]))
        return shard.out(inbox, used, seating.first_sizes(shard.c0, used), start)

    states = [_step(scratch, "state0", begin, _kinds(merged, "model", "names"))]
    roots = [_step(scratch, "root0", begin_root, _kinds(states[0], "sum"))]
    settings = [_settings(start, _totals(states[0]), _totals(roots[0]), 0, False)]
    scratch.drop("state0/kind=sum", *(f"merged{i}/kind=names" for i in range(DEAL_WAVES)))
    for number in range(1, sweeps + 1):
        known = spark.sparkContext.broadcast(settings[-1])

        def sweep(inbox: Inbox, number: int = number, known=known) -> list[tuple]:
            b = Bucket(inbox)
            b.seated(inbox.one("state", "a").astype(np.int64), inbox.one("state", "b").astype(np.int64))
            b.hear(inbox)
            b.sweep(known.value, np.random.default_rng([2 * number, inbox.to]))
            return b.out(inbox.to, shards, None, inbox)

        def root(inbox: Inbox, number: int = number, known=known) -> list[tuple]:
            shard, s, rng = Shard(inbox), known.value, np.random.default_rng([2 * number + 1, inbox.to])
            before, used, sizes = (inbox.one("root", f).astype(np.int64) for f in "abc")
            used, sizes = seating.follow(before, used, sizes, shard.c0, s["base"], s["d0"], rng)
            own = shard.c0 > 1
            total, uniform = np.array([int(s["T0"])]), np.full(own.sum(), 1 / (s["V"] + 1))
            new, more = seating.reseat(shard.c0[own], used[own], sizes[np.repeat(own, used)], np.zeros(own.sum(), np.int64), total, uniform, s["d0"], s["theta0"], rng)
            used[own] = new
            sizes = np.ones(int(used.sum()), np.int64)
            sizes[np.repeat(own, used)] = more
            return shard.out(inbox, used, sizes, s)

        states.append(_step(scratch, f"state{number}", sweep, _kinds(merged, "model"), _kinds(states[-1], "state"), _kinds(roots[-1], "reply")))
        roots.append(_step(scratch, f"root{number}", root, _kinds(roots[0], "names", "link"), _kinds(roots[-1], "root"), _kinds(states[-1], "sum")))
        settings.append(_settings(settings[-1], _totals(states[-1]), _totals(roots[-1]), number, True))
        known.unpersist()
        scratch.drop(f"state{number}/kind=sum", f"root{number - 1}/kind=root")
        if number <= sweeps - averaged + 1:
            scratch.drop(f"state{number - 1}", f"root{number - 1}/kind=reply")
    scratch.drop("root0/kind=link", "root0/kind=names", f"root{sweeps}/kind=root")
    return settings, states, roots


# ---- scores


def _scores(scratch: Scratch, merged: list[DataFrame], settings: list[dict], states: list[DataFrame], roots: list[DataFrame], averaged: int, wave: int) -> DataFrame:
    """(unit, at, doc_id, held_out, n_tokens, log_p, log_c, known): what the pairs of a wave's buckets add to each document."""
    last = range(len(settings) - 1, len(settings) - 1 - averaged, -1)
    known = scratch.spark.sparkContext.broadcast(settings)

    def probabilities(inbox: Inbox) -> list[tuple]:
        b = Bucket(inbox)
        mean = np.zeros(len(b.c))
        for n in last:
            b.seated(inbox.one(f"state{n}", "a").astype(np.int64), inbox.one(f"state{n}", "b"))
            b.hear(inbox, f"reply{n}")
            mean += b.probability(known.value[n]) / averaged
        log_p, count = np.log10(mean).astype(np.float32), inbox.all("count", "a")[b.word]
        out = []
        for r in inbox.rows["list"]:
            own = np.cumsum(unpack(r["a"]), dtype=np.int64)
            out.append(("score", -r["frm"], inbox.to, {"a": log_p[own], "b": count[own], "c": unpack(r["e"])}))
        return out

    def add(table: pa.Table) -> pa.Table:
        inbox = Inbox(table)
        unit = inbox.rows["unit"][0]
        ids, flags, n_tokens, m, doc, cut = (unpack(unit[f]) for f in FIELDS)
        n, m = len(ids), m.astype(np.int64)
        pairs, tokens = np.append(0, np.cumsum(cut[:-1], dtype=np.int64)), np.append(0, np.cumsum(m))
        sums = np.zeros((3, n))
        for r in inbox.rows.get("score", []):
            if unpack(r["c"])[0] != cut[-1]:
                raise ValueError("the texts came in another order than before: store them as a table first")
            i, j = pairs[r["frm"]], pairs[r["frm"] + 1]
            own, times, count = doc[tokens[i] : tokens[j]], m[i:j], unpack(r["b"]).astype(np.float64)
            for k, x in enumerate((unpack(r["a"]).astype(np.float64), np.log10(count + 1), count > 0)):
                sums[k] += np.bincount(own, weights=np.repeat(x, times), minlength=n)
        doc_id = pa.array(ids.view(np.int64), mask=flags >= 2)
        return pa.Table.from_arrays([pa.array([inbox.to] * n, pa.int64()), pa.array(np.arange(n)), doc_id, pa.array(flags % 2 == 1), pa.array(n_tokens.astype(np.int64)), *map(pa.array, sums)], ["unit", "at", "doc_id", "held_out", "n_tokens", "log_p", "log_c", "known"])

    def named(table: DataFrame, kind: str, n: int) -> DataFrame:
        return _kinds(table, kind).withColumn("kind", F.concat("kind", F.lit(str(n))))

    each = SCORE_WAVES // DEAL_WAVES
    rows = _kinds(merged[wave // each], "model", "list").union(_kinds(roots[0], "count"))
    for n in last:
        rows = rows.union(named(states[n], "state", n)).union(named(roots[n], "reply", n))
    own = F.pmod("to", F.lit(SCORE_WAVES)) == wave // each + DEAL_WAVES * (wave % each)
    found = rows.where(own).groupBy("to").applyInArrow(lambda table: _rows(probabilities(Inbox(table))), _ROW)
    schema = "unit long, at long, doc_id long, held_out boolean, n_tokens long, log_p double, log_c double, known double"
    return scratch.keep(found.union(_kinds(merged[0], "unit")).groupBy("to").applyInArrow(add, schema), f"scores{wave}")


def score_texts(spark: SparkSession, docs: DataFrame, held_out, sweeps: int = SWEEPS, averaged: int = AVERAGED) -> DataFrame:
    """One row for each row of docs(doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    held_out is a boolean column over docs: the model learns from all other rows.  Words are lower-cased
    (A-Z) runs of non-blanks; an end token follows each text, also an empty or null one.  Rows that repeat
    count each time in training and get equal scores; a null doc_id stays null; other columns of docs are not looked at.  Without training
    rows every probability is 1.  An empty table gives no rows.

    docs is read several times and has to deal its rows to the same units each time, as stored tables do; anything else raises an error.
    The order of rows inside a unit changes nothing.
    """
    scratch = Scratch(spark, "hpy-lm")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (~held_out).alias("train"))
    *large, total = _large_contexts(docs)
    sent = spark.sparkContext.broadcast(tuple(large))
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_TOKENS))
    parts = [_step(scratch, f"merged{wave}", lambda inbox: _merge(inbox, sent.value[0]), _deal(docs, sent, buckets, wave)) for wave in range(DEAL_WAVES)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    settings, states, roots = _train(scratch, merged, buckets, sweeps, averaged)
    waves = []
    for wave in range(SCORE_WAVES):
        waves.append(_scores(scratch, parts, settings, states, roots, averaged, wave))
        if wave % (SCORE_WAVES // DEAL_WAVES) == SCORE_WAVES // DEAL_WAVES - 1:
            scratch.drop(*(f"merged{wave // (SCORE_WAVES // DEAL_WAVES)}/kind={kind}" for kind in ("model", "list")))
    scratch.drop(*(f"merged{i}" for i in range(DEAL_WAVES)), *(f"{x}{i}" for x in ("state", "root") for i in range(sweeps + 1)))
    rows = waves[0]
    for more in waves[1:]:
        rows = rows.union(more)
    rows = rows.groupBy("unit", "at").agg(*(F.first(c).alias(c) for c in ("doc_id", "held_out", "n_tokens")), *(F.sum(c).alias(c) for c in ("log_p", "log_c", "known")))
    n, v = settings[0]["N"], settings[0]["V"]
    return rows.select(
        "doc_id", "held_out", "n_tokens", F.round("known").cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_c") - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"), F.col("log_p").alias("score"),
    )
