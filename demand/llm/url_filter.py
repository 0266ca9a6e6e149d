"""URL filters as a sort-merge range join, in DataFrame operations only.

A rule (host, path) fits its host and all subdomains when the url's path starts with the rule's path.
The canonical key of a rule is its host with the labels reversed, a zero byte and the path; as bytes, the
keys that start with it are the interval [key, key + 0xFF). A url is probed under each suffix of its host
that has no more labels than the longest rule host. Intervals of one host are nested or disjoint, so a
sweep in key order needs only the stack of active rules: an interval's start pushes its rule, its end pops
back to the enclosing rule (the *parent*, found once in the rule table), and a probe reads the top. The top
is a running ``last(..., ignorenulls)`` in a window; nothing is collected.

Scale: the sweep runs over distinct (host, path) pairs; hosts with many of them are dealt to salts
(their rules are repeated per salt), so no window partition grows with the input.

Defined results: a null url or one without ``://`` has empty host and path; rules with a null field are
ignored; of two rules with the same host and path but different verdicts ``block`` holds; the rule with the
longest host, then the longest path, wins; without a rule the verdict is ``default``. Rows of ``pages`` are
kept as they are (repeated rows stay), other columns are dropped.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(after, "^[^?#]*", 0)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit("")), F.coalesce(path, F.lit(""))


def _reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _with_parents(rules: DataFrame) -> DataFrame:
    """Each rule with the longest other rule of its host whose path is a proper prefix of its own (or null)."""
    sizes = rules.groupBy("rhost").agg(F.collect_set(F.length("path")).alias("sizes"))
    prefixes = (rules.join(sizes, "rhost")
                .select("rhost", "path", F.explode(F.filter("sizes", lambda n: n < F.length("path"))).alias("n"))
                .select("rhost", F.col("path").alias("child"), F.expr("substring(path, 1, n)").alias("path")))
    parent = (prefixes.join(rules, ["rhost", "path"])
              .groupBy("rhost", F.col("child").alias("path"))
              .agg(F.max(F.struct(F.length("path").alias("n"), "rule", "verdict")).alias("parent")))
    return rules.join(parent, ["rhost", "path"], "left")


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", keep: tuple[str, ...] = ("page_id",),
               default: str = "allow", rows_per_salt: int = 200_000) -> DataFrame:
    """``keep`` columns of every page with host, path, the winning rule (or null) and its verdict."""
    host, path = host_and_path(F.col("__url"))
    urls = (pages.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], F.col(url_col).alias("__url"))
            .withColumns({"host": host, "path": path}).drop("__url"))

    rules = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
             .groupBy(F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("host"), "path")
             .agg(F.max("verdict").alias("verdict"))
             .select(_reversed_host(F.col("host")).alias("rhost"), "path", F.concat("host", "path").alias("rule"), "verdict"))
    most_labels = rules.agg(F.max(F.size(F.split("rhost", r"\."))).alias("n")).first()["n"] or 0

    # probes: every distinct (host, path) under each suffix of its host that a rule could have
    labels = F.reverse(F.split("host", r"\."))
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(most_labels, 1)))),
                           lambda n: F.array_join(F.slice("labels", 1, n), "."))
    probes = (urls.select("host", "path").distinct()
              .select("host", "path", labels.alias("labels"))
              .select("host", "path", F.explode(suffixes).alias("rhost")))
    load = (probes.groupBy("rhost").agg(F.count("*").alias("n"))
            .join(rules.select("rhost").distinct(), "rhost")
            .select("rhost", F.ceil(F.col("n") / rows_per_salt).cast("int").alias("salts")))

    def key(col: Column, end: bool = False) -> Column:
        parts = [F.encode("rhost", "UTF-8"), F.unhex(F.lit("00")), F.encode(col, "UTF-8")]
        return F.concat(*parts, F.unhex(F.lit("FF"))) if end else F.concat(*parts)

    top = "struct<n:int,rule:string,verdict:string>"
    probing = (probes.join(load, "rhost")
               .select("rhost", F.pmod(F.xxhash64("host", "path"), F.col("salts")).cast("int").alias("salt"),
                       key(F.col("path")).alias("key"), F.lit(1).alias("ord"), F.lit(None).cast(top).alias("top"),
                       "host", "path"))
    own = F.struct(F.length("path").alias("n"), "rule", "verdict").cast(top)
    nothing = F.struct(F.lit(None).cast("int").alias("n"), F.lit(None).cast("string").alias("rule"),
                       F.lit(None).cast("string").alias("verdict"))
    enclosing = F.coalesce(F.col("parent").cast(top), nothing)
    events = (_with_parents(rules).join(load, "rhost")
              .select("*", F.explode(F.expr("sequence(0, salts - 1)")).alias("salt"))
              .select("rhost", "salt", F.inline(F.array(
                  F.struct(key(F.col("path")).alias("key"), F.lit(0).alias("ord"), own.alias("top")),
                  F.struct(key(F.col("path"), end=True).alias("key"), F.lit(2).alias("ord"), enclosing.alias("top")))))
              .withColumns({"host": F.lit(None).cast("string"), "path": F.lit(None).cast("string")}))
    sweep = (Window.partitionBy("rhost", "salt").orderBy("key", "ord")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    best = (events.unionByName(probing)
            .withColumn("active", F.last("top", ignorenulls=True).over(sweep))
            .where((F.col("ord") == 1) & F.col("active.rule").isNotNull())
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rhost").alias("h"), F.col("active.n").alias("n"),
                                F.col("active.rule").alias("rule"), F.col("active.verdict").alias("verdict"))).alias("best")))
    return (urls.join(best, ["host", "path"], "left")
            .select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], "host", "path",
                    F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
