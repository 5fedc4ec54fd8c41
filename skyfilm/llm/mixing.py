"""Mixing sources to target weights by Pfair scheduling.

Source i has the whole number q_i of slots of a period of Q = sum(q).  Its k-th block, k from 0, may run from slot
floor(k Q / q_i), its release, and must run before slot ceil((k + 1) Q / q_i), its deadline.  Earliest deadline
first over released blocks keeps every source within one block of its share q_i / Q at every slot.  The
windows repeat after Q slots, so one period is scheduled and every block finds its slot from its number.

Given weights are taken exactly: they are read as decimal numbers and q is each divided by their greatest
common divisor.  Weights that follow from the sources' sizes are defined as whole numbers of slots to begin with.
"""

from __future__ import annotations

from fractions import Fraction
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 16
BUCKET = 1024
PERIOD = 1024
LONGEST_PERIOD = 1 << 18
CHUNK = 128
BROADCAST_SOURCES = 100_000
#: a row that makes up more than one part in so many of all rows is laid out by its count
REPEATED_PARTS = 1024


def whole_weights(weights: dict[str, float | int | str | Fraction]) -> tuple[dict[str, int], Fraction]:
    """The given weights as whole numbers of a common unit, exactly, and that unit."""
    exact = {k: Fraction(str(v)) for k, v in weights.items()}
    if any(v <= 0 for v in exact.values()):
        raise ValueError("weights must be greater than 0")
    below, above = 1, 0
    for v in exact.values():
        below = below * v.denominator // gcd(below, v.denominator)
    for v in exact.values():
        above = gcd(above, int(v * below))
    unit = Fraction(max(above, 1), below)
    return {k: int(v / unit) for k, v in exact.items()}, unit


def source_slots(sizes: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, period: int = PERIOD) -> DataFrame:
    """(source, rows) to (source, q): slots in each period.

    A source in ``weights`` gets its weight in whole units, exactly.  Any other source gets its
    rows ** power in those units, rounded, one at least; without weights the unit is such that all add up to about ``period``.
    """
    size = F.pow(F.col("rows").cast("double"), F.lit(power))
    given, unit = whole_weights(weights or {})
    share = size / F.lit(float(unit)) if given else size / F.sum(size).over(Window.partitionBy(F.lit(0))) * period
    q: Column = F.greatest(F.lit(1), F.round(share)).cast("long")
    for name, n in given.items():
        q = F.when(F.col("source") == name, F.lit(n).cast("long")).otherwise(q)
    return sizes.select("source", q.alias("q"))


def period_schedule(slots: DataFrame) -> DataFrame:
    """(source, q) to (source, q, period, k from 0, slot, release, deadline) of every block of one period, by EDF.

    The period's blocks are gathered by the slot of their release, in chunks of ``CHUNK`` slots.  A fold over the chunks carries the
    released blocks that wait, sorted by deadline, then smaller q, then source.  A chunk can run no more of those than it has slots, so its
    own fold, which takes the first of the queue at each slot, sees only that many and the chunk's releases: about period x (CHUNK +
    period / CHUNK) steps, however many sources there are.
    """
    total = slots.agg(F.sum("q").alias("period"))
    blocks = slots.crossJoin(F.broadcast(total)).select("source", "q", "period", F.explode(F.expr("sequence(0L, q - 1)")).alias("k"))  # one row on the right
    block = F.struct(F.expr("((k + 1) * period + q - 1) div q").alias("deadline"), "q", "source", "k")
    released = blocks.select("period", F.expr("k * period div q").alias("slot"), block.alias("b"))
    every = total.where("period > 0").select("period", F.explode(F.expr("sequence(0L, period - 1)")).alias("slot"))
    fresh = released.unionByName(every, allowMissingColumns=True).groupBy("period", "slot").agg(F.collect_list("b").alias("fresh"))
    chunks = fresh.groupBy("period", F.expr(f"slot div {CHUNK}").alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("slot", "fresh"))).alias("steps"))
    items = chunks.groupBy("period").agg(F.sort_array(F.collect_list(F.struct("chunk", "steps"))).alias("chunks"))
    kind = f"struct<deadline:bigint,q:bigint,source:{dict(slots.dtypes)['source']},k:bigint>"
    none, taken = f"cast(array() AS array<{kind}>)", f"cast(array() AS array<struct<slot:bigint,b:{kind}>>)"
    step = """(a, s) -> aggregate(array(CASE WHEN size(s.fresh) = 0 THEN a.queue ELSE sort_array(concat(a.queue, s.fresh)) END), a,
        (b, queue) -> named_struct('queue', slice(queue, 2, size(queue)), 'out', concat(b.out, array(named_struct('slot', s.slot, 'b', queue[0])))))"""
    plan = f"""aggregate(chunks, named_struct('queue', {none}, 'out', {taken}),
        (acc, c) -> aggregate(c.steps, named_struct('queue', slice(acc.queue, 1, {CHUNK}), 'out', {taken}), {step},
            own -> named_struct('queue', sort_array(concat(own.queue, slice(acc.queue, {CHUNK + 1}, size(acc.queue)))), 'out', concat(acc.out, own.out))),
        acc -> acc.out)"""
    flat = items.select("period", F.explode(F.expr(plan)).alias("o")).select("o.b.source", "o.b.q", "period", "o.b.k", "o.slot")
    return flat.selectExpr("source", "q", "period", "k", "slot", "k * period div q AS release", "((k + 1) * period + q - 1) div q AS deadline")


def _first_ranks(tally: DataFrame, starts: DataFrame) -> DataFrame:
    """tally with start, the rank of the first of each group of equal rows among its source's rows in the order of the hash."""
    before = Window.partitionBy("source", "bucket").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    return tally.withColumn("place", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long"))).join(starts, ["source", "bucket"]).withColumn("start", F.col("start") + F.col("place")).drop("place")


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, block: int = BLOCK, period: int = PERIOD, seed: int = 17) -> DataFrame:
    """docs with source_rank, block_no, slot, release, deadline and mix_position.

    weights gives target weights by source, held exactly; a source that it lacks, and every source without it, weighs its
    number of rows to ``power``, as ``source_slots`` says.  A period beyond ``LONGEST_PERIOD`` slots is refused, whatever the number of
    sources: weights need a common unit of at least that part of their sum.  A null source is a source of its own.  Rows of a source are
    shuffled by a hash of the row, dealt to blocks of ``block`` rows (the last may be shorter), and each block takes one
    slot; mix_position = slot * block + place in the block orders the whole mix, with gaps after a source
    has ended.  All rows are kept; equal rows get different positions; an empty table gives no rows.  Columns
    of docs named like new ones are replaced, all others are kept whatever their names; texts are not looked into.

    Ranks come from counts of hash buckets, so a source that holds most rows is spread over many tasks.  A row that repeats so often
    that it makes up more than 1 / ``REPEATED_PARTS`` of the table travels once, with its count, and is laid out again in pieces.
    """
    names = ("source_rank", "block_no", "slot", "release", "deadline", "mix_position")
    kept = [c for c in docs.columns if c not in names]
    key = F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit("")))
    order = F.md5(F.concat(F.lit(f"{seed} "), F.to_json(F.struct(*[F.col(f"`{c}`") for c in kept]))))
    # columns of docs travel as one, so that no name of theirs meets one of ours
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), key.alias("source"), order.alias("hash"))
    sizes = docs.select(key.alias("source")).groupBy("source").agg(F.count("*").alias("rows"))
    slots = source_slots(sizes, {"s" + k: v for k, v in weights.items()} if weights else None, power, period)
    total = slots.join(sizes, "source").agg(F.count("*").alias("n"), F.sum("q").alias("q"), F.sum("rows").alias("rows")).first()
    if (total["q"] or 0) > LONGEST_PERIOD:
        raise ValueError(f"{total['n']} sources and their weights need a period of {total['q']} slots, more than {LONGEST_PERIOD}")
    # a row for each source: small, and checked; a join dealt by source would put a hot one into one task
    each = F.broadcast if total["n"] <= BROADCAST_SOURCES else (lambda df: df)
    plan = period_schedule(slots)

    # as many buckets for a source as its rows fill, in the order of the hash, so that all are of one size
    buckets = each(sizes.select("source", F.ceil(F.col("rows") / BUCKET).alias("buckets")))
    bucket = F.floor(F.conv(F.substring("hash", 1, 13), 16, 10).cast("double") / float(1 << 52) * F.col("buckets")).cast("long")
    rows = rows.join(buckets, "source").withColumn("bucket", bucket).drop("buckets")
    tally = rows.groupBy("source", "bucket", "hash").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = tally.groupBy("source", "bucket").agg(F.sum("n").alias("n")).select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("start"))
    many = F.col("n") > max(BUCKET, (total["rows"] or 0) // REPEATED_PARTS)
    often = F.broadcast(tally.where(many).select("source", "bucket", "hash", "n"))  # at most REPEATED_PARTS rows

    # rows that are few of their kind: numbered in their bucket, in which a frequent one stands for its count
    own = ["source", "bucket", "hash"]
    few = rows.join(often, own, "left_anti").withColumn("n", F.lit(1).cast("long")).unionByName(often, allowMissingColumns=True).repartition("source", "bucket")
    few = _first_ranks(few, starts).where("row IS NOT NULL").select("row", "source", F.col("start").alias("source_rank"))
    # frequent ones: one of each, laid out in pieces
    ranks = _first_ranks(tally, starts).where(many).select(*own, "n", "start")
    kinds = rows.join(often.select(*own), own, "left_semi").groupBy(*own).agg(F.first("row").alias("row")).join(ranks, own)
    pieces = kinds.withColumn("piece", F.explode(F.expr(f"sequence(0L, (n - 1) div {BUCKET})"))).repartition("source", "hash", "piece")
    laid = pieces.select("row", "source", F.explode(F.expr(f"sequence(start + piece * {BUCKET}, start + least(n, (piece + 1) * {BUCKET}) - 1)")).alias("source_rank"))
    rows = few.unionByName(laid).withColumn("block_no", F.expr(f"source_rank div {block}"))
    rows = rows.join(each(slots), "source").select("row", "source", "source_rank", "block_no", F.expr("block_no % q").alias("k"), F.expr("block_no div q").alias("turn"))
    rows = rows.join(plan.drop("q"), ["source", "k"])
    turn = F.col("turn") * F.col("period")
    slot = turn + F.col("slot")
    return rows.select(
        *[F.col("row")[c].alias(c) for c in kept], "source_rank", "block_no", slot.alias("slot"), (turn + F.col("release")).alias("release"), (turn + F.col("deadline")).alias("deadline"),
        (slot * block + F.expr(f"source_rank % {block}")).alias("mix_position"),
    )
