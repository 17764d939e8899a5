"""URL verdicts by rules and by a path-template tree, in DataFrame operations alone.

The segments of each path are classed by their letters (numbers and hexadecimal strings
become wildcards). The paths of a host form a tree, which is generalised from the root down:
where a node has many children, those whose share of blocked pages doesn't differ
statistically from their siblings' are merged into one wildcard branch, and the children of
merged branches are the next level's children together. A template is rejected by its
smoothed purity: the share of blocked pages among its labelled ones (those with a rule),
drawn to the share of the same template over all hosts, and that to one half.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, checkpointed

#: (verdict, host, path): a rule holds for the host and its subdomains where the path starts so.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Children from which on a node's segment counts as variable.
MANY = 8
#: Levels of the tree; what follows in a longer path is one segment of the last level.
DEPTH = 8
#: Standard errors within which two shares of blocked pages count as equal.
ALIKE = 1.96
#: Weight of the prior share, in pages.
PRIOR = 4.0


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null. rules: a short list, as a parameter."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the last tested is the outermost
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def classed(path: Column) -> Column:
    """The path's segments with numbers and long hexadecimal strings as wildcards."""

    def kind(s: Column) -> Column:
        return (
            F.when(s.rlike(r"^[0-9]+$"), F.lit("{n}"))
            .when(s.rlike(r"^[0-9]+\.[A-Za-z]+$"), F.regexp_replace(s, r"^[0-9]+", "{n}"))
            .when(s.rlike(r"^[0-9A-Fa-f-]{16,}$"), F.lit("{h}"))
            .otherwise(s)
        )

    segs = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), kind)
    rest = F.array(F.array_join(F.slice(segs, F.lit(DEPTH), F.greatest(F.lit(0), F.size(segs))), "/"))
    return F.when(F.size(segs) > DEPTH, F.concat(F.slice(segs, F.lit(1), F.lit(DEPTH - 1)), rest)).otherwise(segs)


def alike() -> Column:
    """Whether the shares of blocked pages of a child (b, a) and of its siblings (all_b, all_a less its own) pass as equal.

    The two-proportion test with the pooled, smoothed variance. A side without labelled
    pages gives no evidence of a difference.
    """
    b, all_b = F.col("b"), F.col("all_b")
    n, others = b + F.col("a"), all_b + F.col("all_a") - b - F.col("a")
    pooled = (all_b + 1.0) / (all_b + F.col("all_a") + 2.0)
    error = F.sqrt(pooled * (1.0 - pooled) * (1.0 / n + 1.0 / others))
    return F.when((n == 0) | (others == 0), True).otherwise(F.abs(b / n - (all_b - b) / others) <= ALIKE * error)


def template_tree(counts: DataFrame) -> DataFrame:
    """host, segs, template, blocked, allowed of each row of counts(host, segs, blocked, allowed).

    One pass over the distinct paths for each level. What is joined is written first, so
    that the part of a node with very many children can be split.
    """
    paths = checkpointed(counts.select("host", "segs", F.lit("").alias("prefix"), "blocked", "allowed"))
    deepest = paths.agg(F.max(F.size("segs"))).first()[0] or 0
    for at in range(deepest):
        paths = paths.withColumn("seg", F.get("segs", F.lit(at)))
        kids = paths.where("seg IS NOT NULL").groupBy("host", "prefix", "seg").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
        nodes = kids.groupBy("host", "prefix").agg(F.count("*").alias("kids"), F.sum("b").alias("all_b"), F.sum("a").alias("all_a"))
        nodes = checkpointed(nodes.where(F.col("kids") >= MANY))
        out = F.col("seg")
        if not nodes.isEmpty():
            merged = checkpointed(kids.join(nodes, ["host", "prefix"]).where(alike()).select("host", "prefix", "seg", F.lit("*").alias("wild")))
            paths, out = paths.join(merged, ["host", "prefix", "seg"], "left"), F.coalesce("wild", "seg")
        grown = F.when(F.col("seg").isNull(), F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), out))
        paths = checkpointed(paths.select("host", "segs", grown.alias("prefix"), "blocked", "allowed"))
    return paths.select("host", "segs", F.when(F.col("prefix") == "", "/").otherwise(F.col("prefix")).alias("template"), "blocked", "allowed")


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """Each url's host, path, rule, verdict, template and the template's purity.

    Null urls and urls without :// have empty host and path, no rule and the template "/".
    Such hosts are one host like any other. Repeated rows and null keys give a row each, an
    empty table an empty table; other columns aren't read. A template without any labelled
    page on its host takes the share of the template elsewhere, and if there's none, one
    half; a purity over one half blocks, else the page is allowed. purity is rounded to 6.
    """
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u"))
    rows = rows.select("k", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    rows = rows.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)).withColumn("segs", classed(F.col("path")))
    blocked, allowed = (F.sum(F.when(F.col("hit.verdict") == v, 1).otherwise(0)) for v in ("block", "allow"))
    trees = template_tree(rows.groupBy("host", "segs").agg(blocked.alias("blocked"), allowed.alias("allowed")))
    on_host = trees.groupBy("host", "template").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
    anywhere = on_host.groupBy("template").agg(F.sum("b").alias("gb"), F.sum("a").alias("ga"))
    prior = (F.col("gb") + PRIOR * 0.5) / (F.col("gb") + F.col("ga") + PRIOR)
    purity = (F.col("b") + PRIOR * prior) / (F.col("b") + F.col("a") + PRIOR)
    judged = checkpointed(checkpointed(on_host).join(checkpointed(anywhere), "template").select("host", "template", purity.alias("purity")))
    verdicts = checkpointed(trees.select("host", "segs", "template").join(judged, ["host", "template"]))
    return rows.join(verdicts, ["host", "segs"]).select(
        F.col("k").alias(key),
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), F.when(F.col("purity") > 0.5, "block").otherwise("allow")).alias("verdict"),
        "template",
        F.round("purity", 6).alias("purity"),
    )




def oracle() -> str:
    """The SQL of url_verdicts() over pages, with the tree's levels written out."""
    levels = []
    for at in range(1, DEPTH + 1):
        levels.append(f"""
k{at} AS (SELECT host, prefix, segs[{at}] AS seg, sum(blocked) AS b, sum(allowed) AS a FROM p{at - 1} WHERE len(segs) >= {at} GROUP BY ALL),
n{at} AS (SELECT host, prefix, sum(b) AS all_b, sum(a) AS all_a FROM k{at} GROUP BY ALL HAVING count(*) >= {MANY}),
m{at} AS (SELECT k.host, k.prefix, k.seg FROM k{at} k JOIN n{at} n ON n.host = k.host AND n.prefix = k.prefix
  WHERE b + a = 0 OR all_b + all_a = b + a OR abs(b / (b + a)::DOUBLE - (all_b - b) / (all_b + all_a - b - a)::DOUBLE) <= {ALIKE}::DOUBLE *
    sqrt((all_b + 1.0::DOUBLE) / (all_b + all_a + 2.0::DOUBLE) * (1.0::DOUBLE - (all_b + 1.0::DOUBLE) / (all_b + all_a + 2.0::DOUBLE))
         * (1.0::DOUBLE / (b + a)::DOUBLE + 1.0::DOUBLE / (all_b + all_a - b - a)::DOUBLE))),
p{at} AS (SELECT p.host, p.segs, p.blocked, p.allowed, CASE WHEN len(p.segs) < {at} THEN p.prefix ELSE p.prefix || '/' || CASE WHEN m.seg IS NULL THEN p.segs[{at}] ELSE '*' END END AS prefix
  FROM p{at - 1} p LEFT JOIN m{at} m ON m.host = p.host AND m.prefix = p.prefix AND m.seg = p.segs[{at}]),""")
    return ORACLE.replace("{levels}", "".join(levels)).replace("{depth}", str(DEPTH))


ORACLE = r"""
WITH cut AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT *,
    CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule,
    list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s:
      CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '{n}'
           WHEN regexp_matches(s, '^[0-9]+\.[A-Za-z]+$') THEN regexp_replace(s, '^[0-9]+', '{n}')
           WHEN regexp_matches(s, '^[0-9A-Fa-f-]{16,}$') THEN '{h}' ELSE s END) AS whole
  FROM cut
), labelled AS (
  SELECT * EXCLUDE (whole), CASE WHEN len(whole) > {depth} THEN list_append(whole[1:{depth} - 1], array_to_string(whole[{depth}:], '/')) ELSE whole END AS segs,
    CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS said FROM ruled
), p0 AS (
  SELECT host, segs, '' AS prefix, count(*) FILTER (said = 'block') AS blocked, count(*) FILTER (said = 'allow') AS allowed
  FROM labelled GROUP BY ALL
), {levels}
trees AS (
  SELECT host, segs, blocked, allowed, CASE WHEN prefix = '' THEN '/' ELSE prefix END AS template FROM p{depth}
), on_host AS (
  SELECT host, template, sum(blocked) AS b, sum(allowed) AS a FROM trees GROUP BY ALL
), anywhere AS (
  SELECT template, sum(b) AS gb, sum(a) AS ga FROM on_host GROUP BY ALL
), judged AS (
  SELECT host, template, (b + 4.0::DOUBLE * ((gb + 2.0::DOUBLE) / (gb + ga + 4.0::DOUBLE))) / (b + a + 4.0::DOUBLE) AS purity
  FROM on_host JOIN anywhere USING (template)
)
SELECT l.page_id, l.host, l.path, l.rule,
       coalesce(l.said, CASE WHEN j.purity > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       t.template, round(j.purity, 6) AS purity
FROM labelled l JOIN trees t USING (host, segs) JOIN judged j ON j.host = t.host AND j.template = t.template
"""
