"""URL prefix rules as a sort-merge range join on reversed-host keys.

A rule is a host and a path prefix.  With its labels reversed and a dot behind each, a host is a prefix of all its subdomains, so the
hosts of rules are intervals of the sorted hosts; under one host, the paths of rules are intervals of the
sorted paths.  Intervals nest or are disjoint.  A sweep sorts marks (the starts of intervals) and points together; each mark
passed puts its stack of enclosing marks in force, and a point takes those of the stack in force that it has not
left yet.  One sweep over hosts finds the rule hosts around each host, a second over paths the rules around each url.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: points of one part that a task sweeps, where the part has no more marks than that
POINTS_A_TASK = 1024
#: parts that are dealt to several tasks, those with most points
SPLIT_PARTS = 1024


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"(?s)^([^?#]*)", 1)
    known = F.coalesce(at > 0, F.lit(False))
    return F.when(known, F.translate(host, UPPER, LOWER)).otherwise(""), F.when(known, path).otherwise("")


def reversed_host(host: Column) -> Column:
    """Labels in reverse, a dot behind each."""
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit("."))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(rule, verdict) texts such as ("com/en/", "block") as a table of rule, verdict, rule_host, rule_path."""
    rows = [F.struct(*[F.lit(x) for x in (r, v, r.partition("/")[0], "/" + r.partition("/")[2])]) for r, v in rules]
    table = spark.range(1).select(F.inline(F.array(*rows))) if rows else spark.range(0).selectExpr("'' AS a", "'' AS b", "'' AS c", "'' AS d")
    return table.toDF("rule", "verdict", "rule_host", "rule_path")


def sweep(marks: DataFrame, points: DataFrame, points_a_task: int) -> DataFrame:
    """points(part, at, carry) with stack: the marks(part, at) of their part that their ``at`` starts with, innermost last.

    Points of a part are dealt to tasks by a hash, each with that part's marks: one task for every ``points_a_task`` points, or as many
    points as the part has marks if those are more, so that marks are never copied to more rows than there are points.  The
    ``SPLIT_PARTS`` parts with most points are dealt so; any other holds at most one in so many of all points and is one
    task.  Points with nothing around them are left out.
    """
    sizes = points.groupBy("part").agg(F.count("*").alias("points")).join(marks.groupBy("part").agg(F.count("*").alias("marks")), "part")
    split = F.ceil(F.col("points") / F.greatest(F.lit(points_a_task), F.col("marks"))).cast("int")
    split = F.broadcast(sizes.orderBy(F.desc("points"), "part").limit(SPLIT_PARTS).select("part", split.alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    ends = F.explode(F.sequence(F.lit(1), F.length("at")))
    starts = marks.select("part", "at", ends.alias("n")).withColumn("outer", F.expr("substring(at, 1, n)")).select("part", "at", "outer")
    starts = starts.union(marks.where("at = ''").selectExpr("part", "at", "''")).union(marks.where("at != ''").selectExpr("part", "at", "''"))
    stacks = starts.join(marks.select("part", F.col("at").alias("outer")), ["part", "outer"])
    stacks = stacks.groupBy("part", "at").agg(F.transform(F.array_sort(F.collect_set(F.struct(F.length("outer").alias("n"), "outer"))), lambda s: s["outer"]).alias("stack"))
    stacks = stacks.join(split, "part", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    points = points.join(split, "part", "left").withColumn("salt", F.pmod(F.xxhash64("at", "carry"), salts).cast("int"))
    merged = stacks.select("part", "salt", "at", F.lit(0).alias("kind"), F.lit(None).cast(points.schema["carry"].dataType).alias("carry"), "stack").unionByName(
        points.select("part", "salt", "at", F.lit(1).alias("kind"), "carry", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"))
    )
    passed = F.last("stack", ignorenulls=True).over(Window.partitionBy("part", "salt").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0))
    around = F.filter("passed", lambda s: F.startswith(F.col("at"), s))
    return merged.withColumn("passed", passed).where("kind = 1 AND passed IS NOT NULL").select("part", "at", "carry", around.alias("stack")).where("size(stack) > 0")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", points_a_task: int = POINTS_A_TASK) -> DataFrame:
    """pages with host, path, rule and verdict for the column url.

    rules: rule, verdict, rule_host, rule_path.  A rule fits its host and all subdomains if the path
    starts with rule_path.  The longest rule text wins; of equal texts, ``block`` before ``allow``.  Null urls and
    urls without ``://`` have an empty host and path, fit no rule and get the default.  Rows that repeat
    stay; an empty table gives no rows, and no rules give the default; columns of pages named like new ones are replaced, all others are kept whatever their names.

    Each distinct host is swept once, and each distinct host and path once for every rule host around it.
    """
    host, path = url_parts(F.col("url"))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    # columns of pages travel as one, so that no name of theirs meets one of ours
    pages = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), host.alias("host"), path.alias("path"))

    rules = rules.where("rule_host IS NOT NULL AND rule_path IS NOT NULL").select(reversed_host(F.col("rule_host")).alias("part"), F.col("rule_path").alias("at"), "rule", "verdict")
    rules = rules.groupBy("part", "at").agg(F.min_by(F.struct("rule", "verdict"), F.struct(F.col("verdict") != "block", "rule")).alias("r"))
    top = F.substring_index("at", ".", 1)
    urls = pages.where("host != ''").select("host", "path").distinct()
    rule_hosts = rules.select(F.col("part").alias("at")).distinct().select(top.alias("part"), "at")
    hosts = urls.select("host").distinct().select(reversed_host(F.col("host")).alias("at"), F.col("host").alias("carry")).select(top.alias("part"), "at", "carry")
    around = sweep(rule_hosts, hosts, points_a_task).select(F.col("carry").alias("host"), F.explode("stack").alias("part"))

    found = sweep(rules.select("part", "at"), urls.join(around, "host").select("part", F.col("path").alias("at"), F.col("host").alias("carry")), points_a_task)
    found = found.select("part", F.element_at("stack", -1).alias("inner"), F.col("carry").alias("host"), F.col("at").alias("path"))
    best = found.join(rules.withColumnRenamed("at", "inner"), ["part", "inner"])
    best = best.groupBy("host", "path").agg(F.max_by("r", F.struct(F.length("r.rule"), F.length("part"), F.col("r.verdict") == "block")).alias("hit"))
    return pages.join(best, ["host", "path"], "left").select(*[F.col("row")[c].alias(c) for c in kept], "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
