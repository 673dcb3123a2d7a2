"""Verdicts on URLs: rules first, then trust and distrust that hosts pass on along links."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlake.llm.inputs import named
from appendlake.session import persist_counted, persist_table

# Fixed values of the task: verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
LINK = "(?i)\\b(?:href|src)\\s*=\\s*[\"']?\\s*(?:https?:)?//([^/?#\"'\\s>]+)"
STEPS_SCALE = 1_000_000_000
# An address is no chain of domains. Names longer than DNS allows have no parents.
ADDRESS = "^(?:[0-9.]+|\\[.*)(?::[0-9]*)?$"
LONGEST_NAME = 260
# Below a country code these labels are registries, so a registered domain has three labels.
REGISTRIES = ("ac", "co", "com", "edu", "go", "gov", "ne", "net", "or", "org")


@dataclass(frozen=True)
class Walk:
    """``damping`` of the walks; they end when all scores together move by less than
    ``tolerance`` times their sum, or after ``most_steps``, but never while a step still
    reaches new hosts.

    A host is blocked if its distrust is above ``threshold`` times its trust.
    """

    damping: float = 0.85
    tolerance: float = 1e-3
    most_steps: int = 50
    threshold: float = 1.0


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, ascii_uppercase, ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls where none does."""
    rule = verdict = F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, what).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """Distinct (``a``, ``b``): host a links to host b, or one is the other without its first label.

    ``pages`` has ``host`` and ``html``. A subdomain and its parent vouch for each other.
    The parents of a host, up to its registered domain, are nodes even if they have no
    page, so siblings reach each other; what lies above that only if it has a page.
    """
    links = pages.select(F.col("host").alias("a"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("b"))
    links = links.select("a", F.translate("b", ascii_uppercase, ascii_lowercase).alias("b"))
    kin = kinship(hosts)
    both = kin.union(kin.select("b", "a"))
    return links.union(both).filter("a <> b and a <> '' and b <> ''").distinct()


def kinship(hosts: DataFrame) -> DataFrame:
    """(``a``, ``b``): each host and each of its parents with the next parent, see ``host_edges``."""
    labels = F.split("host", "\\.")
    named_ = hosts.filter(~F.col("host").rlike(ADDRESS) & (F.length("host") <= LONGEST_NAME)).select(labels.alias("labels"))
    named_ = named_.filter(F.size("labels") > 1)
    country = F.regexp_replace(F.element_at("labels", -1), ":[0-9]*$", "").rlike("^[a-z]{2}$")
    registered = F.when(country & F.element_at("labels", -2).isin(*REGISTRIES), 3).otherwise(2)
    at = F.explode(F.sequence(F.lit(2), F.size("labels"))).alias("at")
    step = named_.select("labels", registered.alias("registered"), at)
    left = lambda k: F.concat_ws(".", F.slice("labels", k, F.size("labels"))).alias("left")
    step = step.select(left(F.col("at") - 1).alias("a"), left(F.col("at")).alias("b"), (F.size("labels") - F.col("at") + 1 >= F.col("registered")).alias("below"))
    step = step.filter("a <> '' and b <> ''").distinct()
    above = step.filter("not below").join(hosts.select(F.col("host").alias("b")), "b", "left_semi").select("a", "b")
    return step.filter("below").select("a", "b").union(above)


def propagated(edges: DataFrame, seeds: DataFrame, walk: Walk) -> DataFrame:
    """(``host``, ``trust``, ``distrust``): personalised PageRank from both kinds of seeds.

    ``seeds`` has ``kind`` (trust or distrust), ``host`` and ``weight``, which adds up to
    1 per kind. Trust walks along the edges, distrust against them, both in one table.
    Each step is a join of the scores with the edges and a sum, combined before its
    shuffle; it is written, so a lost executor costs one step.
    """
    steps = edges.select(F.lit("trust").alias("kind"), F.col("a").alias("host"), F.col("b").alias("to"))
    steps = steps.union(edges.select(F.lit("distrust"), "b", "a"))
    steps = persist_table(steps, "steps")
    degree = persist_table(steps.groupBy("kind", "host").agg(F.count(F.lit(1)).alias("degree")), "degrees")
    start = seeds.select("kind", "host", (F.col("weight") * (1 - walk.damping)).alias("start"))
    start = persist_table(start, "start")
    scores = start.withColumnRenamed("start", "score")
    step, reached = 0, -1
    while True:
        share = scores.join(degree, ["kind", "host"]).select("kind", "host", (F.col("score") / F.col("degree") * walk.damping).alias("share"))
        passed = steps.join(share, ["kind", "host"]).select("kind", F.col("to").alias("host"), F.col("share").alias("score"), F.lit(0.0).alias("was"))
        kept = start.select("kind", "host", F.col("start").alias("score"), F.lit(0.0).alias("was"))
        before = scores.select("kind", "host", F.lit(0.0).alias("score"), F.col("score").alias("was"))
        summed = passed.union(kept).union(before).groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("was").alias("was"))
        # Sums of doubles; only the two numbers that come out of them become integers.
        moved = (F.try_divide(F.sum(F.abs(F.col("score") - F.col("was"))), F.sum("score")) * STEPS_SCALE).cast("long")
        summed, seen = persist_counted(summed, "scores", moved=moved, hosts=F.count(F.lit(1)))
        scores = summed.select("kind", "host", "score")
        step += 1
        if seen["hosts"] == reached and (seen["moved"] < walk.tolerance * STEPS_SCALE or step >= walk.most_steps):
            break
        reached = seen["hosts"]
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)
    return scores.groupBy("host").agg(of("trust"), of("distrust"))


def judged(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, walk: Walk | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust``) of every row.

    A host with a page that the rules allow is a trusted seed, one with a page that they
    block a blocked one, and one with both is both, weighted by these pages. Pages
    without a rule get their host's verdict; a host that neither trust nor distrust
    reaches, and a page without a host, are allowed. Null urls and html are empty.
    """
    walk = walk or Walk()
    url = named(url_col)
    base = pages.select(named(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), named(html_col).alias("html"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = base.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    count = lambda v: F.count(F.when(F.col("verdict") == v, 1)).alias(v)
    hosts = ruled.filter("host <> ''").groupBy("host").agg(count("allow"), count("block"))
    hosts = persist_table(hosts, "hosts")
    kinds = F.explode(F.create_map(F.lit("trust"), "allow", F.lit("distrust"), "block")).alias("kind", "pages")
    seeds = hosts.select("host", kinds).filter("pages > 0")
    sums = {r["kind"]: r["pages"] for r in seeds.groupBy("kind").agg(F.sum("pages").alias("pages")).collect()}
    total = reduce(lambda c, k: F.when(F.col("kind") == k, float(sums[k])).otherwise(c), sums, F.lit(1.0))
    edges = persist_table(host_edges(base.select("host", "html"), hosts), "edges")
    found = persist_table(propagated(edges, seeds.select("kind", "host", (F.col("pages") / total).alias("weight")), walk), "host-scores")
    own = F.when(F.col("distrust") > F.col("trust") * walk.threshold, "block").otherwise("allow")
    score = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    joined = ruled.join(found, "host", "left")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), score("trust"), score("distrust"))
