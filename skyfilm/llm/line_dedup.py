"""Site-relative line frequency: lines on too large a share of a host's pages are boilerplate.

A page counts once for each distinct line.  A line goes from all pages of a host if at least
``least_pages`` of them hold it and they are more than ``ratio`` of the host's pages.  Where ``copies_once``
is set, pages of a host with equal texts count as one, so that copies of whole documents are no boilerplate.
Lines, and texts where copies count once, are told apart by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATIO = 0.05
LEAST_PAGES = 5
#: pages of one host that meet one copy of its boilerplate
PAGES_A_TASK = 1024
#: hosts that are dealt to several tasks, those with most pages
SPLIT_HOSTS = 1024


def _host(host: str):
    return F.concat(F.when(F.col(f"`{host}`").isNull(), "n").otherwise("s"), F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")))


def _line_hash(line):
    """A line is compared without surrounding blanks; a blank line has no hash and always stays."""
    bare = F.trim(F.regexp_replace(line, "[\t\r]", " "))
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate_lines(pages: DataFrame, host: str, text: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES, copies_once: bool = False) -> DataFrame:
    """(host, boilerplate): hashes of each host's boilerplate lines; at most its lines a page over ratio."""
    rows = pages.select(_host(host).alias("host"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("copy"))
    pages_of = F.count_distinct("copy") if copies_once else F.count("*")
    totals = rows.groupBy("host").agg(pages_of.alias("pages"))
    lines = rows.where("text IS NOT NULL").select("host", *(["copy"] if copies_once else []), F.explode(F.array_distinct(F.transform(F.split("text", "\n"), _line_hash))).alias("line")).where("line IS NOT NULL")
    found = lines.groupBy("host", "line").agg(pages_of.alias("with_line")).where(F.col("with_line") >= least_pages)
    found = found.join(totals, "host").where(F.col("with_line") > ratio * F.col("pages"))
    return found.groupBy("host").agg(F.array_sort(F.collect_list("line")).alias("boilerplate"))


def dedup_lines(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, copies_once: bool = False) -> DataFrame:
    """pages with the text cleaned, and with n_lines and n_dropped_lines.

    Null texts stay null with no lines; an empty text is one blank line; blank lines stay; a null host is a host of its own; rows that
    repeat are pages like others; a host with fewer than ``least_pages`` pages loses nothing; an empty
    table gives no rows.  Lines are compared without blanks around them.  Columns of pages named like new
    ones are replaced, all others are kept whatever their names.

    Only lines' hashes are shuffled and counted, a row for each page and distinct line.  The few lines over
    the ratio, fewer for each host than its lines a page divided by the ratio, then meet the pages; a host's
    pages are dealt row by row, so that copies of one text are dealt too, to one task for every ``PAGES_A_TASK`` of them.  That holds for the
    ``SPLIT_HOSTS`` hosts with most pages; any other has at most one in so many of all pages and is one task.
    """
    kept = [c for c in pages.columns if c not in ("n_lines", "n_dropped_lines")]
    sizes = pages.groupBy(_host(host).alias("host")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "host").limit(SPLIT_HOSTS)
    split = F.broadcast(sizes.select("host", F.ceil(F.col("n") / PAGES_A_TASK).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    drop = boilerplate_lines(pages, host, text, ratio, least_pages, copies_once).join(split, "host", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    # columns of pages travel as one, so that no name of theirs meets one of ours
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), _host(host).alias("host"), F.monotonically_increasing_id().alias("id"))
    rows = rows.join(split, "host", "left").withColumn("salt", F.pmod("id", salts).cast("int")).drop("id", "salts")
    rows = rows.join(drop, ["host", "salt"], "left")
    whole = F.col("row")[text]
    lines = F.split(whole, "\n")
    stays = F.filter(lines, lambda x: F.coalesce(~F.array_contains(F.col("boilerplate"), _line_hash(x)), F.lit(True)))
    rows = rows.withColumn("stays", F.when(F.col("boilerplate").isNull(), lines).otherwise(stays))
    return rows.select(
        *[F.when(F.col("boilerplate").isNull(), whole).otherwise(F.array_join("stays", "\n")).alias(c) if c == text else F.col("row")[c].alias(c) for c in kept],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"), (F.coalesce(F.size(lines), F.lit(0)) - F.coalesce(F.size("stays"), F.lit(0))).cast("long").alias("n_dropped_lines"),
    )
