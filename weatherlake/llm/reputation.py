"""URL filter: rules for hosts and paths, and reputation that spreads over links.

Rules decide the pages that they fit.  All other pages get the verdict of their
host, by two personalised PageRanks over the graph of host links:

- **trust** starts at hosts in proportion to the share of their pages that a
  rule allows, and follows links: who is linked from trusted hosts is trusted;
- **distrust** starts at the share of pages that a rule blocks, and follows
  links backwards: who links to blocked hosts is distrusted.

Both are linear in their seeds and start from shares of one host's own pages,
so they are on one scale: a host is blocked where its distrust exceeds
``threshold`` times its trust by at least ``least``.  Hosts that neither reaches are allowed.

One iteration is one equi-join of edges and scores and one keyed sum that is
combined before its shuffle, so a host that a third of all links point to costs
one row per task; a host with very many links of its own is a skewed join key
that adaptive execution splits.  Links are reduced to weighted edges between
hosts before.  No host, edge or score is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weatherlake.llm.shared import cut, stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: An absolute or scheme-relative link; group 1 is what names the host.  Possessive, so it
#: cannot be made to scan a page again and again.
LINK = r"(?i)href\s*+=\s*+[\"']?+\s*+(?:https?+:)?+//([^/?#\"'<>\s\\]++)"

DAMPING, ROUNDS = 0.85, 60
LEAST = 1e-6  # a smaller difference of the scores is no evidence


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and a path, like ``example.org/en/``; it fits the
    host and all its subdomains where the path of the URL starts with it."""

    verdict: str
    text: str

    def __post_init__(self):
        if self.verdict not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks: {self.verdict!r}")
        if not self.host:
            raise ValueError(f"a rule names a host: {self.text!r}")

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].translate(str.maketrans(UPPER, LOWER))

    @property
    def path(self) -> str:
        host, slash, rest = self.text.partition("/")
        return slash + rest


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased.  Path: then up to ``?``, ``#`` or the end.  Both are empty
    without a ``://``, and for null."""
    text = F.coalesce(url, F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*+", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*+([^?#]*+)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of text and verdict; null
    without one.  Of equally long ones that block first, then the smallest."""
    first = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    if not first:
        return F.lit(None).cast("struct<text:string,verdict:string>")

    def fits(r: Rule) -> Column:
        own = host == r.host
        return (own | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))

    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in reversed(first):
        out = F.when(fits(r), F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_links(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """Edges between different hosts: ``src``, ``dst``, ``n`` (pages of src
    that link to dst).  Relative links stay on the host and are no edges; a
    page without a host has none."""
    src, _ = host_and_path(F.col(url))
    targets = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)),
                                           lambda t: F.translate(t, UPPER, LOWER)))
    return (pages.select(src.alias("src"), F.explode(targets).alias("dst")).filter("src <> '' and dst <> src")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def propagate(edges: DataFrame, seeds: DataFrame, *, damping: float = DAMPING, rounds: int = ROUNDS,
              tolerance: float = 1e-9) -> DataFrame:
    """Personalised PageRanks: trust along the edges, distrust against them.

    ``edges``: src, dst, n (weights).  ``seeds``: host (distinct), trust,
    distrust.  Score = (1 - damping) * seed + damping * what comes in, where a
    host hands its score on in proportion to the weights of its edges; what
    arrives at a host without further edges stays there.  At most ``rounds``
    rounds, fewer when no score moves by more than ``tolerance``.  Returns
    host, trust, distrust for every host that either reaches, seeds included;
    hosts of score zero may be left out.
    """
    share_out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    share_in = edges.groupBy("dst").agg(F.sum("n").alias("total"))
    forward = edges.join(share_out, "src").select(F.col("src").alias("host"), F.lit(0).alias("kind"), F.col("dst").alias("to"),
                                                  (F.col("n") / F.col("total")).alias("w"))
    backward = edges.join(share_in, "dst").select(F.col("dst").alias("host"), F.lit(1).alias("kind"), F.col("src").alias("to"),
                                                  (F.col("n") / F.col("total")).alias("w"))
    steps = stored(forward.unionByName(backward))
    start = cut(seeds.select("host", F.posexplode(F.array(F.col("trust").cast("double"), F.col("distrust").cast("double"))).alias("kind", "seed"))
                .filter("seed > 0").select("host", "kind", "seed", ((1 - damping) * F.col("seed")).alias("score")))
    scores = start.select("host", "kind", "score")
    if not steps.isEmpty():
        given = start.select("host", "kind", F.col("score").alias("part"))
        for _ in range(rounds):
            come = scores.join(steps, ["host", "kind"]).select(F.col("to").alias("host"), "kind", (damping * F.col("score") * F.col("w")).alias("part"))
            now = cut(given.unionByName(come).groupBy("host", "kind").agg(F.sum("part").alias("score")))
            moved = now.unionByName(scores.select("host", "kind", (-F.col("score")).alias("score")))
            most = moved.groupBy("host", "kind").agg(F.abs(F.sum("score")).alias("by")).agg(F.max("by")).first()[0]
            scores = now
            if most is None or most <= tolerance:
                break
    one = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0))
    return scores.groupBy("host").agg(one(0).alias("trust"), one(1).alias("distrust"))


def judge_pages(pages: DataFrame, rules: Sequence[Rule], *, id: str = "page_id", url: str = "url", html: str = "html",
                threshold: float = 1.0, least: float = LEAST, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """A verdict for every row of ``pages``.

    Columns: the id, ``host``, ``path``, ``rule`` (the longest that fits, else
    null), ``verdict`` (the rule's, else by the host's reputation), ``trust``
    and ``distrust`` of the host (0 where nothing reaches it).  A null url, or
    one without ``://``, has an empty host and path, no rule, no reputation and is
    allowed; a null html has no links.  Rows that repeat are judged each, and
    count each in their host's shares.  Only the three named columns are read,
    so others cannot clash.  ``rules`` are a list of some thousands at most:
    they stand in the plan.
    """
    host, path = host_and_path(F.col(url))
    judged = (pages.select(F.col(id).alias("_id"), host.alias("host"), path.alias("path"))
              .withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
              .select("_id", "host", "path", F.col("r.text").alias("rule"), F.col("r.verdict").alias("ruled")))
    by_rule = lambda v: (F.count_if(F.col("ruled") == v) / F.count(F.lit(1)))
    seeds = (judged.filter("host <> ''").groupBy("host").agg(by_rule("allow").alias("trust"), by_rule("block").alias("distrust"))
             .filter("trust > 0 or distrust > 0"))
    scores = propagate(cut(host_links(pages, url=url, html=html)), seeds, damping=damping, rounds=rounds)
    distrusted = F.col("distrust") > threshold * F.col("trust") + least
    out = judged.join(scores, "host", "left")
    verdict = F.coalesce("ruled", F.when(F.coalesce(distrusted, F.lit(False)), F.lit("block")).otherwise(F.lit("allow")))
    return out.select(F.col("_id").alias(id), "host", "path", "rule", verdict.alias("verdict"),
                      F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


#: The rules of the registered query.
RULES = (Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
         Rule("allow", "com/fr/"), Rule("block", "com/de/"))


def op11_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def _fits_sql(r: Rule) -> str:
    return f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"


def _rules_sql(what: str) -> str:
    longest = sorted(RULES, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    return "CASE " + " ".join(f"WHEN {_fits_sql(r)} THEN '{getattr(r, what)}'" for r in longest) + " END"


_LOWER_SQL = f"translate({{x}}, '{UPPER}', '{LOWER}')"

SQL = f"""
WITH RECURSIVE u AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, html, {_LOWER_SQL.format(x="regexp_extract(rest, '^[^/?#]*', 0)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), j AS (
  SELECT *, {_rules_sql("text")} AS rule, {_rules_sql("verdict")} AS ruled FROM p
), l AS (
  SELECT DISTINCT page_id, html, host AS src, {_LOWER_SQL.format(x="t")} AS dst
  FROM (SELECT page_id, html, host, unnest(regexp_extract_all(html, 'href\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''<>\\s\\\\]+)', 1, 'i')) AS t
        FROM p WHERE host <> '')
), e AS (
  SELECT src, dst, count(*) AS n FROM l WHERE dst <> src GROUP BY src, dst
), w AS (
  SELECT 0 AS kind, src AS host, dst AS dest, n / sum(n) OVER (PARTITION BY src) AS w FROM e
  UNION ALL
  SELECT 1, dst, src, n / sum(n) OVER (PARTITION BY dst) FROM e
), s AS (
  SELECT host, 0 AS kind, count(*) FILTER (ruled = 'allow') / count(*) AS seed FROM j WHERE host <> '' GROUP BY host
  UNION ALL
  SELECT host, 1, count(*) FILTER (ruled = 'block') / count(*) FROM j WHERE host <> '' GROUP BY host
), r AS (
  -- what of the seeds has gone k steps; the score is the sum over all k
  SELECT 0 AS k, host, kind, {1 - DAMPING} * seed AS part FROM s WHERE seed > 0
  UNION ALL
  SELECT any_value(r.k) + 1, w.dest, r.kind, sum({DAMPING} * r.part * w.w)
  FROM r JOIN w ON w.host = r.host AND w.kind = r.kind WHERE r.k < {ROUNDS} GROUP BY w.dest, r.kind
), t AS (
  SELECT host, coalesce(sum(part) FILTER (kind = 0), 0) AS trust, coalesce(sum(part) FILTER (kind = 1), 0) AS distrust FROM r GROUP BY host
)
SELECT page_id, j.host, path, rule,
       coalesce(ruled, CASE WHEN distrust > trust + {LEAST} THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN t ON t.host = j.host
"""
