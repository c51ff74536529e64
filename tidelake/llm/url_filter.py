"""URL filters: explicit rules, and a tree of path templates per host judged by the purity of its labelled pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.common import spread_join
from tidelake.session import checkpointed

#: (host suffix, path prefix) of each rule; the longest that fits decides.
ALLOW = (("org", "/"), ("com", "/fr/"))
BLOCK = (("example.org", "/es/"), ("example.org", "/en/1"), ("com", "/de/"))
#: Branches that hold at most this part of their parent's pages are values where there are more than SPREAD of them.
SPREAD = 20


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case, other letters as they are."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls. Of rules of one length, blocking ones come first, then by text."""
    every = [(f"{h}{p}", h, p, verdict) for verdict, rules in (("block", BLOCK), ("allow", ALLOW)) for h, p in rules]
    rule = verdict = F.lit(None).cast("string")
    for name, suffix, prefix, says in sorted(every, key=lambda r: (len(r[0]), r[3] == "block", r[0])):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def generalised(segment: Column) -> Column:
    """The template of a path segment: its variable parts as wildcards, its extension kept.

    Runs of digits, long hexadecimal strings, UUIDs and dates are variable by their form.
    """
    steps = ((r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", "{uuid}"), (r"^\d{4}-\d{2}-\d{2}", "{date}"),
             (r"(?i)^(?=[0-9a-f]*\d)[0-9a-f]{16,}", "{hex}"), (r"\d+", "{n}"))
    return reduce(lambda c, step: F.regexp_replace(c, *step), steps, segment)


def templates(path: Column) -> Column:
    """Segments of a path by their template, to the path's own depth. Empty segments and a closing slash do not count."""
    return F.transform(F.filter(F.split(path, "/", -1), lambda x: x != ""), generalised)


def merged(nodes: DataFrame, level: int, spread: int) -> DataFrame:
    """Branches of one level that are statistically alike, as a wildcard.

    ``nodes`` has host, source, t (segments), n, good, bad. Under one parent, branches with at most a ``spread``-th of its pages each
    are merged when there are over ``spread`` of them: so many small children are values, not names. A branch stays
    apart where the purity of its labelled templates differs from that of its siblings by more than two standard errors. Templates
    are the observations, not pages, and sizes are relative to the parent: the same site with ten times the pages merges alike.
    """
    here, parent, child = F.size("t") > level, F.slice("t", 1, level), F.get("t", F.lit(level))
    seen = F.col("good") + F.col("bad")
    leaf = nodes.where(here).groupBy("host", parent.alias("up"), child.alias("name")).agg(
        F.sum("n").alias("n"), F.count(F.when(seen > 0, 1)).alias("m"),
        F.sum(F.when(seen > 0, F.col("bad") / seen).otherwise(0.0)).alias("p"))
    leaf = checkpointed(leaf)
    family = leaf.groupBy(F.col("host").alias("fh"), F.col("up").alias("fu")).agg(
        F.sum("n").alias("pages"), F.sum("m").alias("every"), F.sum("p").alias("impure"))
    same = (F.col("host") == F.col("fh")) & (F.col("up") == F.col("fu"))
    small = leaf.join(family, same).where(F.col("n") * spread <= F.col("pages")).drop("fh", "fu")
    many = small.groupBy(F.col("host").alias("fh"), F.col("up").alias("fu")).count().where(F.col("count") > spread)
    mean = (F.col("impure") + 0.5) / (F.col("every") + 1)
    alike = F.abs(F.col("p") - mean * F.col("m")) <= 2 * F.sqrt(mean * (1 - mean) * F.col("m")) + 0.5
    gone = small.join(many, same).where(alike & ~F.col("name").startswith("{")).select(
        F.col("host").alias("h"), "up", "name", F.lit(True).alias("wild"))
    marked = nodes.join(gone, (F.col("host") == F.col("h")) & here & (parent == F.col("up")) & (child == F.col("name")), "left")
    wild = F.concat(F.slice("t", 1, level), F.array(F.lit("{*}")), F.slice("t", level + 2, F.size("t")))
    return marked.select("host", "source", F.when(F.col("wild"), wild).otherwise(F.col("t")).alias("t"), "n", "good", "bad")


def tree(pages: DataFrame, spread: int = SPREAD) -> DataFrame:
    """(host, source, t, n, good, bad): each template as found, with the template that the merged tree gives it.

    The tree works on templates, which partial aggregation counts before the exchange: a host with a third of all pages
    sends one row per template and task. One round a level, to the deepest path.
    """
    nodes = pages.groupBy("host", F.col("template").alias("source")).agg(
        F.count("*").alias("n"), F.sum((F.col("label") == "allow").cast("long")).alias("good"),
        F.sum((F.col("label") == "block").cast("long")).alias("bad"))
    nodes = checkpointed(nodes.select("host", "source", F.col("source").alias("t"), "n", F.coalesce("good", F.lit(0)).alias("good"),
                                      F.coalesce("bad", F.lit(0)).alias("bad")))
    deepest = nodes.agg(F.max(F.size("t"))).first()[0] or 0
    for level in range(deepest):
        nodes = checkpointed(merged(nodes, level, spread))
    return nodes


def judged(nodes: DataFrame, weight: float = 5.0, least_share: float = 0.5) -> DataFrame:
    """(host, source, verdict): a template is rejected where its smoothed share of blocked labels is over ``least_share``.

    Shares are smoothed towards that of the branch above with the weight of ``weight`` pages, from the whole table down
    over the first path segment (whatever the host), the host and its branches to the template.
    """
    overall = nodes.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).select(
        ((F.coalesce("bad", F.lit(0)) + 1) / (F.coalesce("good", F.lit(0)) + F.coalesce("bad", F.lit(0)) + 2)).alias("share")).first()[0]
    rows = nodes.select("host", "source", "t", "good", "bad", F.coalesce(F.get("t", F.lit(0)), F.lit("")).alias("top"),
                        F.lit(float(overall)).alias("share"))

    def smoothed(rows: DataFrame, keys: list[str]) -> DataFrame:
        counted = rows.groupBy(*keys).agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
        named = counted.select(*[F.col(k).alias(f"__{k}") for k in keys], "g", "b")
        same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in keys])
        share = (F.col("b") + weight * F.col("share")) / (F.col("g") + F.col("b") + weight)
        return rows.join(named, same).select("host", "source", "t", "good", "bad", "top", share.alias("share"))

    for keys in (["top"], ["host", "top"], ["host", "t"]):
        rows = smoothed(rows, keys)
    return rows.select("host", "source", F.when(F.col("share") > least_share, "block").otherwise("allow").alias("verdict"))


def filtered(pages: DataFrame, spread: int = SPREAD) -> DataFrame:
    """(page_id, host, path, template, rule, verdict) of every page.

    Pages that a rule fits have its verdict; those verdicts are the labels by which the templates are judged, which decide
    about all other pages. A null url, or one without ``://``, has an empty host and path, the template of no segments,
    and is judged like any other. Repeated rows repeat; an empty table gives no rows.
    """
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, label = ruled(F.col("host"), F.col("path"))
    rows = checkpointed(rows.select("*", rule.alias("rule"), label.alias("label"), templates(F.col("path")).alias("template")))
    verdicts = judged(tree(rows, spread))
    key = F.struct("host", "template")
    side = checkpointed(verdicts.select(F.struct("host", F.col("source").alias("template")).alias("of"), "verdict"))
    out = spread_join(rows.withColumn("key", key), side, "key", "of")
    return out.select("page_id", "host", "path", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "rule",
                      F.coalesce("label", "verdict").alias("verdict"))
