"""URL filters: rules for hosts and paths, and trust propagated over links between hosts.

Rules decide first. Every other url gets the verdict of its host: trust is a personalised PageRank that restarts at
trusted hosts and follows links; distrust restarts at blocked hosts and follows links backwards, so that a host which
links to blocked hosts is distrusted. A host is blocked when distrust makes up more than ``threshold`` of the two; hosts
that neither reaches are allowed.

Edges come from links with a host in the pages' html (with a scheme, or beginning with ``//``), and from a host to the host it is part of and back
(``blog.a.example.com`` and ``a.example.com``, while three labels remain). Seeds are the hosts of the pages that rules
allow or block, weighed by their number of pages. Only DataFrame operations are used; each round of ranks is a join with
the edges and a sum, written to the shared folder every few rounds.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and is allowed; null html has
no links; links of a host to itself are dropped and repeated links add up; repeated pages get one row each; without
seeds all ranks are 0; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm.shared import ascii_lower, release, stage

#: (verdict, rule): the host, a slash, and the beginning of the path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
_LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def url_host(url: Column) -> Column:
    """From after the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """Add ``rule`` and ``ruled`` (its verdict) of the longest rule that fits ``host`` and ``path``."""
    fitting = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        site, _, rest = rule.partition("/")
        on_site = (F.col("host") == site) | F.col("host").endswith(f".{site}")
        fits = on_site & F.col("path").startswith(f"/{rest}")
        fitting.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    best = F.coalesce(*fitting) if fitting else F.lit(None).cast("struct<rule:string,verdict:string>")
    return pages.withColumn("_fit", best).withColumns({"rule": F.col("_fit.rule"), "ruled": F.col("_fit.verdict")}).drop("_fit")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): links between different hosts, summed per pair before and after the shuffle."""
    links = (
        pages.where("host <> ''")
        .select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), 1)).alias("dst"))
        .select("src", ascii_lower(F.col("dst")).alias("dst"))
    )
    parent = F.regexp_extract("host", r"^[^.]+\.([^.]+\.[^.]+\..+)$", 1)
    inside = pages.select("host").distinct().select(F.col("host").alias("src"), parent.alias("dst")).where("dst <> ''")
    back = inside.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return (
        links.unionByName(inside).unionByName(back).where("src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, tolerance: float = 1e-3, restart: float = 0.15, every: int = 4) -> DataFrame:
    """Ranks (kind, host, rank): rounds go on until the last ``every`` of them move less than ``tolerance`` in all.

    ``edges``: kind, src, dst, weight; ``seeds``: kind, host, share (shares of a kind sum to 1). What hosts without
    edges hold does not flow on, so ranks of a kind sum to 1 at most. Each round keeps 1 - ``restart`` of the movement, so
    the end comes within about 45 rounds on any graph.
    """
    outward = edges.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    steps = stage(
        edges.join(outward, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("share")), "steps"
    )
    base = seeds.select("kind", "host", (restart * F.col("share")).alias("rank"))
    ranks = stage(seeds.select("kind", "host", F.col("share").alias("rank")), "ranks")
    while True:
        before = ranks
        for _ in range(every):
            moved = ranks.withColumnRenamed("host", "src").join(steps, ["kind", "src"]).select(
                "kind", F.col("dst").alias("host"), ((1 - restart) * F.col("rank") * F.col("share")).alias("rank")
            )
            ranks = base.unionByName(moved).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        ranks = stage(ranks, "ranks")
        both = ranks.unionByName(before.withColumn("rank", -F.col("rank"))).groupBy("kind", "host").agg(F.sum("rank").alias("change"))
        change = both.agg(F.coalesce(F.sum(F.abs("change")), F.lit(0.0))).first()[0]
        release(before)
        if change < tolerance:
            release(steps)
            return ranks


def link_verdicts(
    pages: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    threshold: float = 0.7,
    url_col: str = "url",
    tolerance: float = 1e-3,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's trust and distrust for each page."""
    parsed = pages.select("page_id", url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"), "html")
    ruled = with_rule(parsed.drop("html"), rules)
    edges = host_edges(parsed)
    both = edges.select(
        F.explode(
            F.array(
                F.struct(F.lit("trust").alias("kind"), F.col("src"), F.col("dst"), F.col("weight")),
                F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("weight")),
            )
        ).alias("e")
    ).select("e.*")
    kind = F.when(F.col("ruled") == "allow", "trust").when(F.col("ruled") == "block", "distrust")
    counted = ruled.where("ruled is not null").groupBy(kind.alias("kind"), "host").agg(F.count("*").alias("n"))
    total = counted.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = stage(counted.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("share")), "seeds")
    ranks = (
        propagate(stage(both, "edges"), seeds, tolerance)
        .groupBy("host")
        .agg(
            F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0.0)).alias("trust"),
            F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0.0)).alias("distrust"),
        )
    )
    blocked = F.coalesce(F.col("distrust") > threshold * (F.col("trust") + F.col("distrust")), F.lit(False))
    return (
        ruled.join(stage(ranks, "host-ranks"), "host", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
            F.coalesce("trust", F.lit(0.0)).alias("trust"),
            F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
        )
    )
