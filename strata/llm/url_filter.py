"""URL filters by redirect equivalence.

Rules name a host and a path prefix.  A page that a rule fits gets the verdict
of the longest such rule.  Redirects and canonical links make URLs aliases of
each other: their connected components spread block verdicts to every alias
that has no rule of its own.  A rule that allows a URL always wins for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, components, staged

#: Fixed values of the contract: (action, host + path), subdomains included.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

_TAGS = r"(?is)<(?:link|meta|base)\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"  # a quoted value may hold >
_HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_REL = r"(?is)\srel\s*=\s*(?:\"(?:[^\"]*\s)?canonical(?:\s[^\"]*)?\"|'(?:[^']*\s)?canonical(?:\s[^']*)?'|canonical(?=[\s/>]))"
_REFRESH = r"(?is)\bcontent\s*=\s*[\"']?\s*[0-9.]*\s*[;,]?\s*url\s*=\s*['\"]?([^\"'>]+)"
_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*://"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_key(url: Column) -> Column:
    """Identity of a URL as a node: scheme and host lower-cased, fragment removed; NULL without ``://``."""
    head = ascii_lower(F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1))
    return F.nullif(F.concat(head, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)), F.lit(""))


def _href(tag: Column) -> Column:
    """The tag's href, trimmed, with its ampersands decoded; empty without one."""
    return F.trim(F.replace(F.concat(*[F.regexp_extract(tag, _HREF, n) for n in (1, 2, 3)]), F.lit("&amp;"), F.lit("&")))


def _plain_path(path: Column) -> Column:
    """A path (from its first slash) without ``.`` and ``..`` segments."""
    def step(done: Column, x: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(x == ".", done).when(x == "..", up).otherwise(F.concat(done, F.array(x)))

    parts = F.split(F.substring(path, 2, 2**31 - 1), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    ends = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.concat(F.lit("/"), F.array_join(ends, "/"))


def resolved(ref: Column, base: Column) -> Column:
    """The URL that ``ref`` means on a page at ``base``: absolute, ``//host``, ``/path``, ``?query`` or relative.

    NULL for an empty reference, a mere fragment and schemes without ``://``.
    """
    origin = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    here = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    path, tail = F.regexp_extract(ref, r"(?s)^([^?#]*)", 1), F.regexp_extract(ref, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(here, r"(?s)^(.*/)", 1), F.lit("")), F.lit("/"))
    return (
        F.when((ref == "") | F.startswith(ref, F.lit("#")), None)
        .when(ref.rlike(_ABSOLUTE), ref)
        .when(ref.rlike(_SCHEME), None)
        .when(F.startswith(ref, F.lit("//")), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), ref))
        .when(F.startswith(ref, F.lit("?")), F.concat(origin, here, ref))
        .when(F.startswith(ref, F.lit("/")), F.concat(origin, _plain_path(path), tail))
        .otherwise(F.concat(origin, _plain_path(F.concat(folder, path)), tail))
    )


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (src, dst) of every page's canonical link and refresh redirect.

    Comments and scripts are left out.  Targets are resolved against the
    page's ``base href`` (the first one, itself relative to the page) or the
    page, dot segments removed.  Pages without such tags are passed over by
    one cheap test before any pattern runs on them.
    """
    h = F.regexp_replace(F.col(html), r"(?is)<!--.*?-->|<script\b.*?</script\s*>", " ")
    tag = F.col("tag")
    target = (
        F.when(tag.rlike(r"(?is)^<link") & tag.rlike(_REL), _href(tag))
        .when(tag.rlike(r"(?is)^<meta") & tag.rlike(r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"),
              F.trim(F.replace(F.regexp_extract(tag, _REFRESH, 1), F.lit("&amp;"), F.lit("&"))))
    )
    own = _href(F.get(F.filter("tags", lambda t: t.rlike(r"(?is)^<base") & t.rlike(_HREF)), F.lit(0)))
    once = lambda c, name: F.explode(F.array(c)).alias(name)  # noqa: E731 - evaluated once, here
    return (
        pages.filter(F.col(html).rlike("(?i)canonical|http-equiv") & (F.instr(F.col(url), "://") > 0))
        .select(F.col(url).alias("page"), once(F.regexp_extract_all(h, F.lit(_TAGS), F.lit(0)), "tags"))
        .select("page", once(F.coalesce(resolved(own, F.col("page")), F.col("page")), "base"), "tags")
        .select("page", "base", F.explode("tags").alias("tag"))
        .select("page", "base", once(target, "t")).filter(F.col("t").isNotNull())
        .select("page", once(resolved(F.col("t"), F.col("base")), "to"))
        .select(url_key(F.col("page")).alias("src"), url_key(F.col("to")).alias("dst"))
        .filter(F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
    )


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Longest fitting rule of each (host, path): rows host, path, rule, action; only pairs that one fits.

    Hosts explode into their label suffixes and meet the rules by an
    equi-join on the host, so the number of rules may be large.  Rules of
    equal length: allow wins.
    """
    r = rules.select(
        F.col("action"), F.col("rule"), F.regexp_extract("rule", r"^([^/]*)", 1).alias("r_host"),
        F.regexp_extract("rule", r"^[^/]*(.*)$", 1).alias("r_path"))
    depth = r.agg(F.max(F.size(F.split("r_host", r"\.")))).first()[0] or 0
    if not depth:
        return urls.select("host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(None).cast("string").alias("action")).limit(0)
    pairs = urls.select("host", "path").distinct().withColumn("labels", F.split("host", r"\."))
    n = F.least(F.size("labels"), F.lit(depth))
    hit = (
        pairs.filter(F.col("host") != "")
        .select("host", "path", F.explode(F.transform(
            F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(F.col("labels"), -i, i), "."))).alias("r_host"))
        .join(r, "r_host").filter(F.startswith("path", F.col("r_path")))
    )
    best = F.max(F.struct(F.length("rule").alias("n"), (F.col("action") == "allow").alias("ok"), "rule", "action"))
    return hit.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.action")


def judge(pages: DataFrame, rules: DataFrame, edges: DataFrame) -> DataFrame:
    """Verdict of every page: page_id, url, host, path, rule, verdict.

    ``pages`` has page_id and url, ``rules`` action and rule (``host/path``),
    ``edges`` src and dst (``url_key`` values).  A page that a rule fits has
    that rule's verdict.  Any other page is blocked if a URL of its alias
    component, crawled or only linked to, is blocked by a rule; else allowed.
    A NULL url has empty host and path, no alias, and is allowed.  Repeated
    rows are judged alike and all returned.
    """
    p = pages.select("page_id", "url").select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        url_key(F.col("url")).alias("key"))
    comp = components(staged(edges.select("src", "dst"), "url-edges"), "url-aliases")
    nodes = comp.select("node", "root").union(comp.select(F.col("root").alias("node"), "root")).distinct()
    nodes = nodes.withColumns({"host": host_of(F.col("node")), "path": path_of(F.col("node"))})
    rule = staged(match_rules(p.select("host", "path").union(nodes.select("host", "path")), rules), "url-rules")
    blocked = (
        nodes.join(rule, ["host", "path"]).filter(F.col("action") == "block").select("root").distinct()
    )
    alias = nodes.join(blocked, "root", "left_semi").select(F.col("node").alias("key")).distinct() \
        .withColumn("alias_blocked", F.lit(True))
    return (
        p.join(rule, ["host", "path"], "left").join(alias, "key", "left")
        .select("page_id", "url", "host", "path", "rule",
                F.coalesce("action", F.when(F.col("alias_blocked"), "block").otherwise("allow")).alias("verdict"))
    )
