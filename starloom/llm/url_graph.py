"""URL filtering: rules by host and path, and trust spread over the graph of hosts.

Pages that a rule decides are the seeds. Trust starts at hosts with allowed pages and follows
links; distrust starts at hosts with blocked pages and goes back along links, to those
that point there. Both are personalised PageRanks, computed together as one table of (host,
kind, rank) that every step joins with the host edges, until no host's rank changes by more
than a small part of itself. A host is judged by which of the two reaches it more strongly, as
a ratio: ranks shrink with the number of pages, ratios do not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import ascii_lower, materialize, removing_intermediates

DAMPING = 0.85
#: Distrust has to exceed trust by this part of it.
MARGIN = 0.01
#: Ranks have settled once ``STORED`` steps raise none by more than this part of it. What further steps would
#: add is about as much, which is below ``MARGIN``.
SETTLED, STORED = 0.005, 4
#: Enough steps for graphs without circles and with at most so many links in a row, as tests have; not a limit.
STEPS = 8
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (size, rule, verdict) of the longest fitting rule, NULL without one."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    fits = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(len(r.name)).alias("size"), F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fits))


def host_edges(pages: DataFrame, host_col: str, html_col: str) -> DataFrame:
    """``src, dst, share`` of host edges: links of pages to other hosts, and host to parent domain.

    ``share`` is the part of a host's outgoing weight. A link counts as often as it occurs, a
    host and the domain directly above it are tied once in either direction.
    """
    target = host_of(F.concat(F.lit("x:"), F.regexp_replace("url", "^(?i)https?:", "")))
    links = (
        pages.select(F.col(host_col).alias("src"), F.explode(F.regexp_extract_all(html_col, F.lit(LINK), 1)).alias("url"))
        .select("src", target.alias("dst"))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("w"))
    )
    up = pages.select(F.col(host_col).alias("src")).distinct().select(
        "src", F.regexp_extract("src", r"^[^.]+\.([^.]+\..+)$", 1).alias("dst")
    )
    up = up.filter("dst <> ''").withColumn("w", F.lit(1.0))
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    every = links.unionByName(up).unionByName(down).filter("src <> '' AND dst <> '' AND src <> dst")
    every = every.groupBy("src", "dst").agg(F.sum("w").alias("w"))
    total = every.groupBy("src").agg(F.sum("w").alias("total"))
    return every.join(total, "src").select("src", "dst", (F.col("w") / F.col("total")).alias("share"))


def spread(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, steps: int | None = None) -> DataFrame:
    """``host, kind, rank`` of personalised PageRank for every kind of seed, after ``steps`` or when settled.

    ``seeds``: host, kind, start, summing to 1 per kind. ``edges``: kind, src, dst, share. What a
    host without edges would pass on is lost, alike for every kind. Ranks start at what the seeds get
    in every step, and only grow. A host that is reached for the first time counts as changed, so
    however far from a seed, it is reached.
    """
    with removing_intermediates(seeds.sparkSession):
        seeds = materialize(seeds, "seeds")
        edges = materialize(edges, "host-edges")
        back = seeds.select("host", "kind", (F.col("start") * (1 - damping)).alias("rank"))
        ranks, done = back, 0
        while steps is None or done < steps:
            before, ahead = ranks, STORED if steps is None else min(STORED, steps - done)
            for _ in range(ahead):
                passed = ranks.withColumnRenamed("host", "src").join(edges, ["src", "kind"]).select(
                    F.col("dst").alias("host"), "kind", (F.col("rank") * F.col("share") * damping).alias("rank")
                )
                ranks = passed.unionByName(back).groupBy("host", "kind").agg(F.sum("rank").alias("rank"))
            ranks, done = materialize(ranks, "ranks"), done + ahead
            old = before.withColumnRenamed("rank", "old")
            changed = ranks.join(old, ["host", "kind"], "left").filter(
                F.col("rank") - F.coalesce("old", F.lit(0.0)) > F.col("rank") * SETTLED
            )
            if changed.isEmpty():
                break
        return materialize(ranks, "ranks", keep=True)


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    steps: int | None = None,
) -> DataFrame:
    """``id_col, host, path, rule, verdict, trust, distrust`` for every page.

    The longest fitting rule decides (of equally long ones that with the greater name). Other
    pages are blocked if distrust reaches their host more strongly than trust, and allowed
    otherwise, also where neither does. ``steps`` bounds the steps along links; without it they
    go on until the ranks have settled.

    NULL urls and those without ``://`` have an empty host and path, fit no rule and are allowed.
    NULL html has no links. Repeated rows stay and are judged alike; NULL ids pass. Other columns
    are not read. An empty table gives an empty table.
    """
    url = F.col(f"`{url_col}`")
    parts = pages.select(
        F.col(f"`{id_col}`"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(f"`{html_col}`").alias("__html")
    )
    judged = parts.withColumn("__rule", matching_rule(F.col("host"), F.col("path"), rules))
    decided = (
        judged.filter("__rule IS NOT NULL AND host <> ''")
        .groupBy("host", F.when(F.col("__rule.verdict") == "allow", "trust").otherwise("distrust").alias("kind"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = decided.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = decided.join(F.broadcast(total), "kind").select("host", "kind", (F.col("n") / F.col("total")).alias("start"))
    links = host_edges(parts, "host", "__html")
    totals_in = links.groupBy("dst").agg(F.sum("share").alias("in"))
    reverse = links.join(totals_in, "dst").select(
        F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"),
        (F.col("share") / F.col("in")).alias("share"),
    )
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst", "share").unionByName(reverse)
    ranks = spread(seeds, edges, steps=steps)
    hosts = ranks.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("rank"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("rank"))), F.lit(0.0)).alias("distrust"),
    )
    seen = judged.drop("__html").join(hosts, "host", "left")
    stronger = (F.col("distrust") > 0) & (F.col("distrust") > F.col("trust") * (1 + MARGIN))
    by_graph = F.when(stronger, "block").otherwise("allow")
    return seen.select(
        F.col(f"`{id_col}`"), "host", "path", F.col("__rule.rule").alias("rule"),
        F.coalesce("__rule.verdict", by_graph).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
