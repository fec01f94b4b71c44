"""URL filtering: host/path rules, and block decisions that follow redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import LOWER, UPPER, written
from tidewright.llm.graph import connected_components

#: A rule table of up to so many rows is broadcast (a row is a host, a path and an action: under 0.3 KB); a larger one is joined by shuffle.
BROADCAST_RULES = 50_000


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_key(url: Column) -> Column:
    """The node of a url: scheme and fragment don't count, nor do A-Z in the host; null without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), F.when(rest == "", F.lit("/")).otherwise(rest)))


def resolved(base: Column, target: Column) -> Column:
    """The url that a link's target means on the page ``base``; null for targets of other schemes than those with ``://``.

    A target without a host is taken against the base's host, one without a leading slash against the base's folder, one of a query alone against
    its path; ``.`` and ``..`` are worked off.
    """
    place, rest = F.regexp_extract(target, r"(?s)^([^?#]*)(.*)$", 1), F.regexp_extract(target, r"(?s)^([^?#]*)(.*)$", 2)
    path = F.when(F.startswith(place, F.lit("/")), place).when(place == "", path_of(base)).otherwise(F.concat(F.regexp_replace(path_of(base), r"[^/]*$", ""), place))
    steps = F.split(F.concat(F.lit("/"), F.regexp_replace(path, "^/", "")), "/")
    step = lambda acc, x: F.when(x == "..", F.regexp_replace(acc, "/[^/]*$", "")).when(x == ".", acc).otherwise(F.concat(acc, F.lit("/"), x))
    walked = F.aggregate(F.slice(steps, F.lit(2), F.size(steps)), F.lit(""), step)
    walked = F.when(F.element_at(steps, -1).isin(".", ".."), F.concat(walked, F.lit("/"))).otherwise(walked)
    return (
        F.when(target.contains("://"), target).when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
        .when(~target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(F.lit("http://"), host_of(base), walked, rest))
    )


def html_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst): all canonical links and refresh targets that a page names, in whatever letter case, as url nodes; targets are ``resolved``.

    Pages that name none are dropped before any pattern runs.
    """
    named = pages.select(F.col(url_col).alias("_url"), F.col(html_col).alias("_html")).filter(F.lower("_html").contains("canonical") | F.lower("_html").contains("http-equiv"))
    tags = F.regexp_extract_all("_html", F.lit(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical[\"'\s/>][^>]*>|<link\b[^>]*\brel\s*=\s*[\"']?canonical[\"']?\s*>"), 0)
    canonical = F.transform(tags, lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    refresh = F.regexp_extract_all("_html", F.lit(r"(?is)<meta\b[^>]*http-equiv\s*=\s*[\"']?refresh[^>]*url\s*=\s*['\"]?([^\"'\s>]+)"), 1)
    targets = named.select("_url", F.explode(F.concat(canonical, refresh)).alias("_to")).filter("_to <> ''")
    return targets.select(url_key(F.col("_url")).alias("src"), url_key(resolved(F.col("_url"), F.col("_to"))).alias("dst")).dropna()


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action): the longest rule of ``rules`` (host, path, action) that fits each of the distinct ``places`` (host, path).

    A rule fits its host and all subdomains where the path starts with the rule's. Each place asks for its own host suffixes, with its own
    path prefixes of the lengths that rules of that host have: two equi-joins, however many rules there are.
    Of rules of one length, allow wins, then the smaller string. Rules with a null host or path are ignored.
    """
    rules = rules.filter("host is not null and path is not null").groupBy("host", "path").agg(F.min("action").alias("action"))
    small = rules.count() <= BROADCAST_RULES
    sent = lambda df: F.broadcast(df) if small else df
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = rules.groupBy(F.col("host").alias("r_host")).agg(F.collect_set(F.length("path")).alias("_lengths"))
    asked = places.select("host", "path", F.explode(suffixes).alias("r_host")).join(sent(lengths), "r_host")
    asked = asked.select("host", "path", "r_host", F.explode(F.filter("_lengths", lambda n: n <= F.length("path"))).alias("_n"))
    asked = asked.select("host", "path", "r_host", F.expr("substr(path, 1, _n)").alias("r_path"))
    known = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "action")
    hits = asked.join(sent(known), ["r_host", "r_path"])
    rule = F.concat("r_host", "r_path")
    best = F.min(F.struct((-F.length(rule)).alias("n"), F.col("action").alias("action"), rule.alias("rule"))).alias("b")
    return hits.groupBy("host", "path").agg(best).select("host", "path", F.col("b.rule").alias("rule"), F.col("b.action").alias("action"))


def filter_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, component.

    ``rules``: host, path, action ("allow" or "block"). ``redirects``: optional (src, dst) urls. Urls are nodes; redirects
    and the pages' own canonical and refresh links are edges. A page that a rule fits has the rule's verdict: explicit allow always stands.
    A page without a rule is blocked when some url of its component is blocked by a rule, else allowed.

    A url that is null or has no ``://`` has an empty host and path, is no node and fits only rules for those.
    Repeated rows are judged alike, each in a row of its own. Other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), url_key(F.col(url_col)).alias("_node"))
    edges = html_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(url_key(F.col("src")).alias("src"), url_key(F.col("dst")).alias("dst")).dropna())
    parts = connected_components(edges)
    # Aliases that are no page themselves are judged as well: a block may be known only for the target of a redirect.
    nodes = parts.select("node", "component", F.concat(F.lit("http://"), F.col("node")).alias("u")).select("node", "component", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    judged = written(match_rules(rows.select("host", "path").unionByName(nodes.select("host", "path")).distinct(), rules), "url-rules")
    blocked = nodes.join(judged.filter("action = 'block'"), ["host", "path"]).select("component").distinct().withColumn("_blocked", F.lit(True))
    aliases = parts.join(blocked, "component", "left").select(F.col("node").alias("_node"), "component", "_blocked")
    out = rows.join(judged, ["host", "path"], "left").join(aliases, "_node", "left")
    verdict = F.coalesce(F.col("action"), F.when(F.col("_blocked"), "block"), F.lit("allow"))
    return out.select(F.col("page_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), F.coalesce("component", "_node").alias("component"))
