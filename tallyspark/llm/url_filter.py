"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes.

Everything is a DataFrame expression. Each URL is expanded into the expressions that could name it: its
host and every parent domain, times the path prefixes of the lengths that rules have. The expansion of
one URL is bounded by the labels of its host and by the distinct rule path lengths, whatever the table.
The expressions are joined with the rules on the first 32 bits of a SHA-256 digest; the whole digest
then confirms each hit, and the longest confirmed rule decides.

Rules of few shapes (a number of host labels and a path length) are joined shape by shape as broadcasts, so
each URL is judged where it lies and a host that holds a third of all rows moves nothing. With more shapes, or
more rules than are broadcast, each distinct host and path prefix is expanded, judged once, and joined back.

Defined results: a null URL, or one without ``://``, has an empty host and path; no rule fits an empty
host, and a URL that no rule fits is allowed. Of equally long rules, a block rule wins. Rule hosts are
compared in lower case; null rules are ignored. Repeated rows get equal verdicts. Extra columns of the input
are kept as they are, whatever their names; columns named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A rule list is broadcast up to this many rows; beyond that the join is left to shuffle.
BROADCAST_RULES = 100_000

#: Most rule shapes that are joined one by one.
SHAPES = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """A to Z in lower case, all else as it is; the slower exact way only for text with other letters."""
    return F.when(c.rlike("^[\\x00-\\x7F]*$"), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?`` or ``#``, lower case) and path (up to ``?`` or ``#``)."""
    has = url.contains("://")
    rest = F.substring_index(url, "://", 1)
    rest = F.when(has, url.substr(F.length(rest) + 4, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _suffix(host: Column, labels: int) -> Column:
    """The last ``labels`` labels of a host, null where it has fewer."""
    return F.when(F.size(F.split(host, "\\.")) >= labels, F.substring_index(host, ".", -labels))


def _confirmed(fits: Column, full: Column) -> Column:
    """The rules met by a hash prefix whose whole digest agrees; none where none was met."""
    none = F.array().cast("array<struct<digest:string,size:int,action:string,rule_host:string,rule_path:string>>")
    return F.coalesce(F.filter(fits, lambda x: x["digest"] == full), none)


def _in_place(named: DataFrame, rules: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """Add best: one broadcast join for each shape of rules."""
    fit = F.struct("digest", "size", "action", "rule_host", "rule_path")
    short = F.broadcast(rules.groupBy("key").agg(F.collect_list(fit).alias("fits")))
    found = []
    for i, (labels, length) in enumerate(shapes):
        suffix, lead = _suffix(F.col("host"), labels), F.substring("path", 1, length)
        full = F.when((F.col("host") != "") & (F.length(lead) == length), _digest(suffix, lead))
        named = named.withColumn(f"full_{i}", full)
        mine = short.select(F.col("key").alias(f"key_{i}"), F.col("fits").alias(f"fits_{i}"))
        named = named.join(mine, F.substring(f"full_{i}", 1, 8) == F.col(f"key_{i}"), "left")
        found.append(_confirmed(F.col(f"fits_{i}"), F.col(f"full_{i}")))
    best = F.array_max(F.transform(F.flatten(F.array(*found)), lambda x: F.struct(x["size"].alias("size"), x["action"].alias("action"), x["rule_host"].alias("h"), x["rule_path"].alias("p"))))
    return named.select("row", "host", "path", best.alias("best"))


def _joined_back(named: DataFrame, rules: DataFrame, lengths: list[int]) -> DataFrame:
    """Add best: each distinct host and path prefix is expanded and judged once."""
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), F.substring("lead", 1, n).alias("p")) for n in lengths]), lambda x: F.length(x["p"]) == x["n"])
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(h.alias("h"), p["p"].alias("p")))))
    named = named.withColumn("lead", F.substring("path", 1, max(lengths)))
    distinct = named.where("host <> ''").select("host", "lead").distinct()
    spread = distinct.select("host", "lead", F.explode(pairs).alias("e")).withColumn("full", _digest(F.col("e.h"), F.col("e.p"))).withColumn("key", F.substring("full", 1, 8))
    hits = spread.join(rules, "key").where("full = digest")
    fit = F.struct("size", "action", F.col("rule_host").alias("h"), F.col("rule_path").alias("p"))
    best = hits.groupBy("host", "lead").agg(F.max(fit).alias("best"))
    return named.join(best, ["host", "lead"], "left").select("row", "host", "path", "best")


def filter_urls(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add host, path, rule and verdict to each row of ``urls``.

    ``rules`` has host, path and action (allow or block). A rule fits its host and all subdomains if the
    URL's path starts with the rule's path; the longest rule (host and path together) wins.
    """
    rules = rules.where("host <> '' and action is not null").select(
        lower_ascii(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), F.col("action").alias("action")
    )
    # Equal rules: a block wins. One row per rule, so that a URL meets each rule once.
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))
    rules = rules.withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
    rules = rules.withColumns({"key": F.substring("digest", 1, 8), "size": F.length("rule_host") + F.length("rule_path")})
    shape = F.struct(F.size(F.split("rule_host", "\\.")), F.length("rule_path"))
    facts = rules.agg(F.count(F.lit(1)), F.collect_set(shape)).first()
    shapes = sorted(tuple(x) for x in facts[1])

    host, path = url_parts(F.col(url))
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    named = urls.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), host.alias("host"), path.alias("path"))
    if not shapes:
        judged = named.withColumn("best", F.lit(None).cast("struct<action:string,h:string,p:string>"))
    elif facts[0] <= BROADCAST_RULES and len(shapes) <= SHAPES:
        judged = _in_place(named, rules, shapes)
    else:
        few = F.broadcast(rules) if facts[0] <= BROADCAST_RULES else rules
        judged = _joined_back(named, few, sorted({n for _, n in shapes}))
    rule, verdict = F.concat("best.h", "best.p"), F.coalesce("best.action", F.lit("allow"))
    return judged.select("row.*", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
