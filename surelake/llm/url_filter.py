"""URL verdicts from rules and, where no rule fits, from a tree of path templates. DataFrame functions only.

Labels are the verdicts of the rules. Below each host the tree grows segment by segment; a segment with a digit is the
wildcard ``{n}``. A node is parted while it holds labels and also urls without one, or labels of both kinds. Its
segments without any label are one branch, ``?``, on which labels elsewhere have no say. Labelled segments are merged by likeness to
their node: those blocked significantly more often than its urls are one branch, ``+``, significantly less often another, ``-``, and the
rest, ``=``. A template is rejected when its smoothed share of blocked urls is high.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surelake import session

#: Levels written out in the SQL; the operator itself has no such number.
SQL_LEVELS = 6


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule whose host is the url's or above it and whose path begins the url's."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def pattern(path: Column) -> Column:
    """The path's segments joined by ``/``, one with a digit as ``{n}``, empty ones left out."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.array_join(F.transform(parts, lambda s: F.when(s.rlike("[0-9]"), "{n}").otherwise(s)), "/")


def share(b: Column, a: Column) -> Column:
    """Smoothed share of blocked urls; without labels one quarter."""
    return (b + F.lit(1.0)) / (b + a + F.lit(4.0))


def undecided(n: Column, b: Column, a: Column) -> Column:
    """A node is parted if it has labels, and urls without one or labels of both kinds."""
    return (b + a > 0) & ((n > b + a) | ((b > 0) & (a > 0)))


def templates(paths: DataFrame, apart: float, deepest: int) -> DataFrame:
    """(host, pattern, template) of distinct patterns with their counts n, b (blocked), a (allowed).

    Counts are summed before they meet, so a host with a third of all urls arrives as its patterns, a node as its segments. Only urls of
    undecided nodes go on to the next level.
    """
    sums = [F.sum(c).alias(c) for c in ("n", "b", "a")]
    decided = F.col("open") == F.lit(False)

    def parted(rows: DataFrame, keys: list[str]) -> DataFrame:
        """Rows with whether their node is undecided."""
        node = rows.groupBy(*keys).agg(*sums)
        return rows.join(node.select(*keys, undecided(F.col("n"), F.col("b"), F.col("a")).alias("open")), keys)

    now = session.materialise(parted(paths.withColumn("template", F.lit("")), ["host"]), "url-paths")
    done = [now.where(decided).select("host", "pattern", F.lit("/**").alias("template"))]
    for level in range(deepest):
        now = now.where("open")
        if now.isEmpty():
            break
        seg = F.coalesce(F.get(F.split("pattern", "/"), F.lit(level)), F.lit(""))
        now = now.drop("open").withColumn("seg", seg)
        child = now.groupBy("host", "template", "seg").agg(*sums)
        node = child.groupBy("host", "template").agg(F.sum("b").cast("double").alias("nb"), F.sum("a").cast("double").alias("na"))
        b, m, nb, nm = F.col("b").cast("double"), (F.col("b") + F.col("a")).cast("double"), F.col("nb"), F.col("nb") + F.col("na")
        # squared difference of the two shares against ``apart`` times the variance of the segment's
        gap = b * nm - nb * m
        differs = gap * gap > F.lit(apart) * nb * F.col("na") * m
        kind = F.when(m == 0, "?").when(differs & (gap > 0), "+").when(differs, "-").otherwise("=")
        child = child.join(node, ["host", "template"]).withColumn("kind", F.when(F.col("seg") == "", "").otherwise(kind))
        name = child.groupBy("host", "template", "kind").agg(F.count(F.lit(1)).alias("many"), F.min("seg").alias("only"))
        name = name.select("host", "template", "kind", F.when(F.col("many") == 1, F.col("only")).otherwise(F.col("kind")).alias("name"))
        named = child.select("host", "template", "seg", "kind").join(name, ["host", "template", "kind"]).select("host", "template", "seg", "name")
        now = now.join(named, ["host", "template", "seg"]).withColumn("template", F.concat("template", F.lit("/"), "name"))
        now = parted(now.drop("name"), ["host", "template"])
        # a path that ends here cannot be parted further
        now = session.materialise(now.withColumn("open", F.col("open") & (F.col("seg") != "")), "url-paths")
        rest = F.when(F.col("seg") == "", "").otherwise("/**")
        done.append(now.where(decided).select("host", "pattern", F.concat("template", rest).alias("template")))
        now = now.drop("seg")
    else:
        done.append(now.where("open").select("host", "pattern", F.concat("template", F.lit("/**")).alias("template")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def judge(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id", url: str = "url", apart: float = 3.84, reject: float = 0.5, deepest: int = 64
) -> DataFrame:
    """page_id, host, path, rule (null if none fits), verdict, template.

    A labelled segment keeps apart from the rest of its node if its squared difference exceeds ``apart`` times its variance (3.84: one
    in twenty by chance); a template is blocked from a smoothed share of ``reject`` on, so never without blocked urls of its own. ``deepest`` bounds
    the levels for paths whose labels stay mixed. A null url has empty host and path. Repeated rows count each; long urls are read whole. An empty
    table gives no rows; other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    given = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = given.select("page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"), pattern(F.col("path")).alias("pattern"))
    counts = [F.count(F.lit(1)).alias("n")] + [F.count(F.when(F.col("ruled") == v, 1)).alias(c) for v, c in (("block", "b"), ("allow", "a"))]
    paths = session.materialise(ruled.groupBy("host", "pattern").agg(*counts), "url-patterns")
    tree = session.materialise(templates(paths, apart, deepest), "url-templates")
    judged = tree.join(paths, ["host", "pattern"]).groupBy("host", "template").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    judged = judged.select("host", "template", F.when(share(F.col("b"), F.col("a")) >= reject, "block").otherwise("allow").alias("learned"))
    out = ruled.join(tree.join(judged, ["host", "template"]), ["host", "pattern"])
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", "learned").alias("verdict"), "template")


def sql() -> str:
    """The query in SQL, the tree written out level by level."""
    cases = sorted(RULES, key=lambda r: (-len(r.name), r.name))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in cases]
    rule = " ".join(f"WHEN {f} THEN '{r.name}'" for f, r in zip(fits, cases))
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, cases))
    out = [f"""
WITH r AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM r
), u AS (
    SELECT *, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{{n}}' ELSE x END) AS parts,
        CASE {rule} END AS rule, CASE {verdict} END AS ruled FROM h
), p0 AS (
    SELECT host, parts, count(*) AS n, count(*) FILTER (ruled = 'block') AS b, count(*) FILTER (ruled = 'allow') AS a, '' AS t, '*' AS seg FROM u GROUP BY ALL
), o0 AS (
    SELECT *, {_UNDECIDED.format(node="host")} AS open FROM p0
)"""]
    for k in range(1, SQL_LEVELS + 1):
        out.append(f"""s{k} AS (
    SELECT * REPLACE (coalesce(parts[{k}], '') AS seg) FROM o{k - 1} WHERE open
), c{k} AS (
    SELECT host, t, seg, sum(b)::DOUBLE AS b, sum(b + a)::DOUBLE AS m FROM s{k} GROUP BY ALL
), d{k} AS (
    SELECT *, sum(b) OVER (PARTITION BY host, t) AS nb, sum(m) OVER (PARTITION BY host, t) AS nm FROM c{k}
), e{k} AS (
    SELECT host, t, seg, CASE WHEN seg = '' THEN '' WHEN m = 0 THEN '?' WHEN (b * nm - nb * m) * (b * nm - nb * m) > 3.84::DOUBLE * nb * (nm - nb) * m
        THEN CASE WHEN b * nm > nb * m THEN '+' ELSE '-' END ELSE '=' END AS kind FROM d{k}
), f{k} AS (
    SELECT host, t, seg, CASE WHEN count(*) OVER (PARTITION BY host, t, kind) = 1 THEN seg ELSE kind END AS name FROM e{k}
), p{k} AS (
    SELECT s.* EXCLUDE (open) REPLACE (s.t || '/' || f.name AS t) FROM s{k} s JOIN f{k} f USING (host, t, seg)
), o{k} AS (
    SELECT *, seg <> '' AND {_UNDECIDED.format(node="host, t")} AS open FROM p{k}
)""")
    ends = " UNION ALL ".join(f"SELECT host, parts, n, b, a, t || CASE WHEN seg = '' THEN '' ELSE '/**' END AS t FROM o{k}" + ("" if k == SQL_LEVELS else " WHERE NOT open") for k in range(SQL_LEVELS + 1))
    out.append(f"""x AS ({ends}), j AS (
    SELECT host, t, CASE WHEN (sum(b) + 1.0::DOUBLE) / (sum(b) + sum(a) + 4.0::DOUBLE) >= 0.5 THEN 'block' ELSE 'allow' END AS learned FROM x GROUP BY host, t
)
SELECT u.page_id, u.host, u.path, u.rule, coalesce(u.ruled, j.learned) AS verdict, x.t AS template
FROM u JOIN x ON u.host = x.host AND u.parts = x.parts JOIN j ON j.host = x.host AND j.t = x.t
""")
    return ", ".join(out)


_LABELS = "sum({c}) OVER (PARTITION BY {{node}})"
_UNDECIDED = "({b} + {a} > 0 AND ({n} > {b} + {a} OR ({b} > 0 AND {a} > 0)))".format(**{c: _LABELS.format(c=c) for c in "nba"})
