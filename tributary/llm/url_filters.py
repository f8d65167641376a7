"""URL filters: path rules first, propagation over the host graph for what no rule decides.

Trust flows from the hosts that rules allow along the links between hosts; distrust flows from the
hosts that rules block against the direction of the links, to those that point at them. Both are
personalised PageRanks, iterated together on pre-aggregated host edges until they stand still and no
host is reached any more, however long the chain of links. A host is blocked if its distrust exceeds its
trust by more than the threshold.

Defined results: host and path are empty where the url is null or has no ``://``; such pages, and
hosts that no seed reaches, have neither trust nor distrust and are allowed; links to a page's own
host, and relative ones, make no edge; repeated rows of a page are judged alike; without rules there
are no seeds, and everything is allowed. Columns beyond those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, stored

#: (verdict, rule): host and all its subdomains, path from its first character on.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

_HREF = r"""(?i)href\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda item: len(item[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between different hosts, ``(source, target, links)``, one row per pair of hosts."""
    targets = F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))))
    links = pages.where(F.col("host") != "").select("host", targets.alias("link"))
    target = host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    return (
        links.select(F.col("host").alias("source"), target.alias("target"))
        .where((F.col("target") != "") & (F.col("source") != F.col("target")))
        .groupBy("source", "target")
        .agg(F.count("*").alias("links"))
    )


def propagate(
    edges: DataFrame, seeds: DataFrame, *, damping: float = 0.85, close: float = 1e-9, every: int = 5, patience: int = 10_000
) -> DataFrame:
    """Scores ``(kind, host, score)`` of random walks that restart at the seeds ``(kind, host, weight)``.

    Walks of kind "trust" follow the edges, those of kind "distrust" follow them backwards. The mass
    of a host without onward links goes back to the seeds, by leaving it out and scaling at the end.
    Every few rounds the scores are written and compared with those before: they are done when less than
    ``close`` of all mass has moved and no new host has a score. Scores that do not settle raise an error.
    """
    steps = edges.select(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("onto"), "links").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("onto"), "links")
    )
    out = steps.groupBy("kind", "host").agg(F.sum("links").alias("all"))
    steps = stored(
        steps.join(out, ["kind", "host"]).select("kind", "host", "onto", (F.col("links") / F.col("all")).alias("share")), "steps"
    )
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("all"))
    start = stored(
        seeds.join(total, "kind").select("kind", "host", (F.col("weight") / F.col("all")).alias("start")), "seeds"
    )
    restart = start.select("kind", "host", (F.col("start") * (1 - damping)).alias("score"))
    scores = start.select("kind", "host", F.col("start").alias("score"))
    hosts = 0
    for _ in range(0, patience, every):
        for _ in range(every):
            before = scores
            moved = scores.join(steps, ["kind", "host"]).select(
                "kind", F.col("onto").alias("host"), (F.col("score") * F.col("share") * damping).alias("score")
            )
            scores = moved.unionByName(restart).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        both = scores.withColumn("was", F.lit(0.0)).unionByName(before.select("kind", "host", F.lit(0.0).alias("score"), F.col("score").alias("was")))
        scores = stored(both.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("was").alias("was")), "scores")
        seen = scores.agg(F.sum(F.abs(F.col("score") - F.col("was"))).alias("change"), F.count("*").alias("hosts")).first()
        scores = scores.select("kind", "host", "score")
        if (seen["change"] or 0.0) < close and seen["hosts"] == hosts:
            break
        hosts = seen["hosts"]
    else:
        raise RuntimeError(f"scores did not settle in {patience} rounds")
    mass = scores.groupBy("kind").agg(F.sum("score").alias("all"))
    return scores.join(mass, "kind").select("kind", "host", (F.col("score") / F.col("all")).alias("score"))


def judge(
    pages: DataFrame,
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    rules: list[tuple[str, str]] = RULES,
    seed_share: float = 0.5,
    threshold: float = 0.0,
    damping: float = 0.85,
) -> DataFrame:
    """Per page ``(id, host, path, rule, verdict, trust, distrust)``.

    A host is a seed of what the rules say of at least ``seed_share`` of its pages (so that a rule for a
    small part of a large host does not speak for all of it); its weight is the number of those pages. Scores are shares of all trust and all distrust.
    """
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = rows.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    ruled = rows.select("id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("found"))
    seeds = (
        ruled.where(F.col("host") != "")
        .groupBy("host")
        .agg(
            F.count("*").alias("pages"),
            F.count_if(F.col("found.verdict") == "allow").alias("allowed"),
            F.count_if(F.col("found.verdict") == "block").alias("blocked"),
        )
        .select(
            "host",
            F.explode(
                F.filter(
                    F.array(
                        F.struct(F.lit("trust").alias("kind"), F.col("allowed").alias("weight"), "pages"),
                        F.struct(F.lit("distrust").alias("kind"), F.col("blocked").alias("weight"), "pages"),
                    ),
                    lambda seed: (seed["weight"] > 0) & (seed["weight"] >= seed["pages"] * F.lit(seed_share)),
                )
            ).alias("seed"),
        )
        .select("seed.kind", "host", "seed.weight")
    )
    scores = propagate(host_edges(rows), seeds, damping=damping)
    hosts = scores.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
    )
    judged = ruled.join(hosts, "host", "left")
    suspect = F.coalesce(F.col("distrust") - F.col("trust"), F.lit(0.0)) > F.lit(threshold)
    return judged.select(
        "id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(suspect, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
