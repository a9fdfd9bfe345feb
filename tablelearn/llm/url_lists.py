"""URL filters as a temporal list join: every capture against the list entries active when it was fetched.

Dated entries ``add`` and ``remove`` a pattern on a list.  An entry's days become validity
intervals [from, until).  A capture matches by its host, by each parent domain, and by host
plus leading path segments; an as-of join evaluates its keys against the intervals that hold
its fetch day.  A capture is blocked when a list with effect ``block`` matches and none with
effect ``allow`` does.

Days are the grain: entries are reduced to one row per list, pattern and day before they are
ordered, so an ordered group has at most one row per day.  Intervals are cut at months and
joined on (key, month), which spreads a key with many captures or many entries; the join
needs no group in one task and Spark may split its skewed keys.

Null and empty URLs, URLs without host, and null fetch days match nothing and are not blocked.
Entries with a null in a needed column are ignored; on one day a ``remove`` beats an ``add``;
a repeated ``add`` changes nothing.  Repeated captures each keep their row; null ids stay.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tablelearn.llm.common import pick, setup


def host(url):
    """Lower-case host without scheme, user, port and final dot."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    authority = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.regexp_replace(F.lower(bare), r"\.$", "")


def path_parts(url):
    """Path segments, without query and fragment."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    path = F.regexp_extract(rest, r"^[^/?#]*/([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda p: p != "")


def keys(depth: int):
    """Match keys of (h, parts): 'h:' host, 'd:' host and parents, 'p:' host with leading segments."""
    labels = F.split("h", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    most = F.least(F.size("parts"), F.lit(depth))
    paths = F.when(most > 0, F.transform(F.sequence(F.lit(1), most), lambda i: F.concat(
        F.lit("p:"), "h", F.lit("/"), F.array_join(F.slice("parts", 1, i), "/")))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(F.concat(F.lit("h:"), "h")), domains, paths))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, effect, key, since, until): until is null while the entry stands."""
    e = pick(entries, list="list", effect="effect", kind="kind", pattern="pattern", verb="verb", day="day")
    prefix = F.when(F.col("kind") == "host", "h:").when(F.col("kind") == "domain", "d:").when(F.col("kind") == "prefix", "p:")
    pattern = F.when(F.col("kind") == "prefix", F.regexp_replace("pattern", "/+$", "")).otherwise(F.lower("pattern"))
    e = (e.where(F.col("verb").isin("add", "remove") & F.col("effect").isin("block", "allow"))
         .select("list", "effect", F.concat(prefix, pattern).alias("key"), F.col("day").cast("date").alias("day"),
                 (F.col("verb") == "remove").alias("gone"))
         .dropna().groupBy("list", "effect", "key", "day").agg(F.max("gone").alias("gone")))
    w = W.partitionBy("list", "effect", "key").orderBy("day")
    turns = e.withColumn("before", F.coalesce(F.lag("gone").over(w), F.lit(True))).where(F.col("gone") != F.col("before"))
    return (turns.withColumn("until", F.lead("day").over(w)).where(~F.col("gone"))
            .select("list", "effect", "key", F.col("day").alias("since"), "until"))


def filter_captures(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    day_col: str = "fetched") -> DataFrame:
    """(id, fetched, blocked, n_matches, lists) of every capture; lists are sorted, comma-joined."""
    setup(captures.sparkSession)
    spans = intervals(entries)
    depth = spans.where(F.col("key").startswith("p:")).agg(F.max(F.size(F.split("key", "/")) - 1)).first()[0] or 0
    end = captures.select(F.max(F.col(day_col).cast("date"))).first()[0]
    c = pick(captures, id=id_col, url=url_col, day=day_col).withColumn("day", F.col("day").cast("date"))
    c = c.select("id", "day", host("url").alias("h"), path_parts("url").alias("parts"))
    # one evaluation per host, path and day, however often it was captured
    match = F.when((F.coalesce(F.length("h"), F.lit(0)) > 0) & F.col("day").isNotNull(), keys(depth))
    c = c.select("id", "day", F.array_sort(match).alias("ks")).withColumn(
        "what", F.md5(F.concat_ws("\n", F.col("day").cast("string"), F.array_join("ks", "\n")).cast("binary")))
    asked = c.where("ks IS NOT NULL").groupBy("what").agg(F.first("day").alias("day"), F.first("ks").alias("ks"))
    asked = asked.select("what", "day", F.explode("ks").alias("key"), F.trunc("day", "month").alias("month"))
    last = F.least(F.coalesce(F.date_sub("until", 1), F.lit(end)), F.lit(end))
    cut = (spans.where(F.col("since") <= last)
           .withColumn("month", F.explode(F.sequence(F.trunc("since", "month"), F.trunc(last, "month"), F.expr("interval 1 month")))))
    hit = asked.join(cut, ["key", "month"]).where((F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("day") < F.col("until"))))
    verdict = hit.groupBy("what").agg(
        (F.max(F.col("effect") == "block") & ~F.max(F.col("effect") == "allow")).alias("b"), F.count(F.lit(1)).alias("n"),
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("l"))
    return c.join(verdict, "what", "left").select(
        F.col("id").alias(id_col), F.col("day").alias("fetched"), F.coalesce("b", F.lit(False)).alias("blocked"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_matches"), F.coalesce("l", F.lit("")).alias("lists"))
