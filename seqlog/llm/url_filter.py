"""URL filter: rules first, then trust and distrust that flow over host links.

Host links come from the pages' hyperlinks; a host is also linked with its parent domain both ways, so
the hosts of one site share what is known of it. Trust is personalised PageRank from hosts with an
allowed page, along the links. Distrust is the same walk from hosts with a blocked page against the
links: linking to bad places is a sign. A page without a rule is blocked when its host's distrust
exceeds its trust times a threshold. Scores are whole numbers, so sums do not depend on their order.

Links are counted per host pair before they are shuffled, and a page meets its host's verdict in a
join that is broadcast only up to a counted size and salted beyond it: a host with a third of all
pages is no hot key.

A null url, or one without "://", has an empty host and path and no rule; no link starts or ends
at an empty host, so the method allows it. Null html has no links. Repeated pages change nothing but
the number of result rows; an empty table gives an empty result. Only the three columns are read.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlog.llm.common import drop_written, table, written
from seqlog.plans.staging import join_side

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HREF = r"""(?i)[\t\n\f\r "']href[\t\n\f\r ]*=[\t\n\f\r ]*["']?([^"'\t\n\f\r >#]+)"""
#: Total score of either kind, dealt equally to its seeds.
MASS = 10**15
#: Percent of a score that flows on, and the number of steps; what flows after ten is below a fifth.
DAMPING, STEPS = 85, 10
#: Steps between two written scores.
STEPS_PER_TABLE = 5


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def first_rule(rules, host: Column, path: Column, value) -> Column:
    """`value` of the longest rule that fits; of equally long ones the first in text order."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.lit(value(rule))).otherwise(chosen)
    return chosen


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct pairs (source, target) of different hosts; pages as from `read_pages`."""
    link = F.col("link")
    target = (
        F.when(link.contains("://"), host_of(link))
        .when(link.startswith("//"), host_of(F.concat(F.lit(":"), link)))
        .otherwise(F.col("host"))
    )
    by_page = pages.select(
        "host", F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("link")
    ).select(F.col("host").alias("source"), target.alias("target"))
    hosts = pages.select("host").union(by_page.select("target")).distinct()
    parent = F.regexp_extract("host", r"^[^.]*\.(.*\..*)$", 1)
    family = hosts.select("host", parent.alias("parent")).where("parent <> ''")
    return (
        by_page.union(family)
        .union(family.select("parent", "host"))
        .where("source <> target AND source <> '' AND target <> ''")
        .distinct()
    )


def propagate(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Scores (kind, host, score) after the walk; seeds are distinct (kind, host).

    `kind` 'trust' walks along the links, 'distrust' against them.
    """
    spark = links.sparkSession
    steps = links.select(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("to")).union(
        links.select(F.lit("distrust"), F.col("target"), F.col("source"))
    )
    degree = steps.groupBy("kind", "host").agg(F.count("*").alias("degree"))
    steps, steps_path = written(steps.join(degree, ["kind", "host"]), "host-steps")
    share = seeds.join(
        seeds.groupBy("kind").agg(F.count("*").alias("n")), "kind"
    ).select("kind", "host", F.expr(f"{MASS} div n").cast("long").alias("seed"))
    start, start_path = written(share, "host-seeds")
    kept = start.select("kind", "host", F.expr(f"seed * {100 - DAMPING} div 100").cast("long").alias("score"))
    scores, before = start.select("kind", "host", F.col("seed").alias("score")), ""
    for step in range(1, STEPS + 1):
        flow = steps.join(scores, ["kind", "host"]).select(
            "kind",
            F.col("to").alias("host"),
            F.expr(f"(score * {DAMPING} div 100) div degree").cast("long").alias("score"),
        )
        scores = flow.union(kept).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if step % STEPS_PER_TABLE == 0 or step == STEPS:
            scores, path = written(scores, "host-scores")
            if before:
                drop_written(spark, before)
            before = path
    drop_written(spark, steps_path, start_path)
    return scores


def filter_urls(pages: DataFrame, rules=RULES, threshold: float = 1.0) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        host_of(F.coalesce("url", F.lit(""))).alias("host"),
        path_of(F.coalesce("url", F.lit(""))).alias("path"),
        "html",
    )
    host, path = F.col("host"), F.col("path")
    judged = rows.select(
        "page_id",
        "host",
        "path",
        first_rule(rules, host, path, lambda r: r.text).alias("rule"),
        first_rule(rules, host, path, lambda r: r.verdict).alias("ruled"),
    )
    seeds = (
        judged.where("ruled IS NOT NULL")
        .select(F.when(F.col("ruled") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
        .distinct()
    )
    scores = propagate(host_links(rows), seeds)
    score = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0))
    by_host = scores.groupBy("host").agg(
        score("trust").alias("trust"), score("distrust").alias("distrust")
    )
    joined = join_side(judged, by_host, ["host"], "left", F.xxhash64("page_id", "path"))
    trust, distrust = F.coalesce("trust", F.lit(0)), F.coalesce("distrust", F.lit(0))
    by_method = F.when(distrust > trust * threshold, F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", by_method).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )


def op3_url_filter(spark, sf_dir) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def _sql() -> str:
    def cut(text: str, pattern: str, group: int) -> str:
        rest = f"CASE WHEN strpos({text}, '://') > 0 THEN substr({text}, strpos({text}, '://') + 3) ELSE '' END"
        return f"regexp_extract({rest}, '{pattern}', {group})"

    def host(text: str) -> str:
        return f"translate({cut(text, '^[^/?#]*', 0)}, '{UPPER}', '{LOWER}')"

    def ruled(value) -> str:
        cases = [
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'"
            for r in sorted(RULES, key=lambda r: (-len(r.text), r.text))
        ]
        return f"CASE {' '.join(cases)} END"

    href = HREF.replace("'", "''")
    steps = [
        f"""s{i} AS MATERIALIZED (SELECT kind, host, CAST(sum(score) AS BIGINT) AS score FROM (
              SELECT w.kind, w.towards AS host, (s.score * {DAMPING} // 100) // w.degree AS score
              FROM walk w JOIN s{i - 1} s ON w.kind = s.kind AND w.host = s.host
              UNION ALL SELECT kind, host, seed * {100 - DAMPING} // 100 FROM seeds) GROUP BY ALL)"""
        for i in range(1, STEPS + 1)
    ]
    return f"""
    WITH p AS MATERIALIZED (
      SELECT page_id, html, {host("coalesce(url, '')")} AS host,
             {cut("coalesce(url, '')", "^[^/?#]*([^?#]*)", 1)} AS path FROM pages),
    judged AS MATERIALIZED (
      SELECT page_id, host, path, {ruled(lambda r: r.text)} AS rule, {ruled(lambda r: r.verdict)} AS ruled FROM p),
    hrefs AS (SELECT host, unnest(regexp_extract_all(html, '{href}', 1)) AS link FROM p),
    by_page AS MATERIALIZED (
      SELECT DISTINCT host AS source, CASE WHEN contains(link, '://') THEN {host("link")}
        WHEN starts_with(link, '//') THEN {host("(':' || link)")} ELSE host END AS target FROM hrefs),
    hosts AS (SELECT host FROM p UNION SELECT target FROM by_page),
    family AS (SELECT host, regexp_extract(host, '^[^.]*\\.(.*\\..*)$', 1) AS parent FROM hosts),
    links AS MATERIALIZED (
      SELECT DISTINCT source, target FROM (
        SELECT source, target FROM by_page UNION ALL SELECT host, parent FROM family WHERE parent <> ''
        UNION ALL SELECT parent, host FROM family WHERE parent <> '')
      WHERE source <> target AND source <> '' AND target <> ''),
    walk AS MATERIALIZED (
      SELECT *, count(*) OVER (PARTITION BY kind, host) AS degree FROM (
        SELECT 'trust' AS kind, source AS host, target AS towards FROM links
        UNION ALL SELECT 'distrust', target, source FROM links)),
    marks AS (SELECT DISTINCT CASE ruled WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host
              FROM judged WHERE ruled IS NOT NULL),
    seeds AS MATERIALIZED (SELECT kind, host, {MASS} // count(*) OVER (PARTITION BY kind) AS seed FROM marks),
    s0 AS (SELECT kind, host, seed AS score FROM seeds),
    {", ".join(steps)},
    by_host AS (SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS trust,
                       coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS distrust FROM s{STEPS} GROUP BY host)
    SELECT page_id, j.host, path, rule,
           coalesce(ruled, CASE WHEN distrust > trust THEN 'block' ELSE 'allow' END) AS verdict,
           CAST(coalesce(trust, 0) AS BIGINT) AS trust, CAST(coalesce(distrust, 0) AS BIGINT) AS distrust
    FROM judged j LEFT JOIN by_host b ON j.host = b.host"""


OP3_SQL = _sql()
