"""URL block rules that follow redirects, on built-in functions only.

Pages are judged by the longest fitting (host, path) rule. A page without a
rule is blocked when a blocked page is among its aliases: pages connected by
redirects, canonical links, or by differing only in what a server usually
redirects away (scheme, ``www.``, default port, tracking parameters, trailing
slash, fragment).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, connected_components, materialize

ALLOW, BLOCK = "allow", "block"
# The rules of the registered query (action, host, path).
RULES = [
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
]
#: Query parameters that do not change the page.
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"

_HOST = r"^([^/?#]*)"
_PATH = r"^[^/?#]*([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), _HOST, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), _PATH, 1), F.lit(""))


def canonical_form(url: Column) -> Column:
    """The address that a URL's usual redirects lead to; null for no URL."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    kept = F.filter(F.split(F.regexp_extract(_rest(url), _QUERY, 1), "&"),
                    lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(kept, "&")
    return F.when(host != "", F.concat(F.lit("https://"), host, path,
                                       F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct ``(rule, action)`` of the longest rule that fits, or null.

    A rule fits its host and all subdomains if the path starts with the
    rule's. Of rules of equal length an allow rule wins, then the greater text.
    The rules are part of the expression: for lists of up to some hundreds.
    """
    found = [
        F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p),
               F.struct(F.lit(len(h + p)).alias("length"), F.lit(action == ALLOW).alias("allowed"),
                        F.lit(h + p).alias("rule"), F.lit(action).alias("action")))
        for action, h, p in rules
    ]
    return F.array_max(F.array(*found)) if found else F.lit(None).cast(
        "struct<length:int,allowed:boolean,rule:string,action:string>")


def link_targets(url: Column, html: Column) -> Column:
    """Absolute targets of canonical links and refresh redirects in a page."""
    tags = F.when(html.rlike(r"(?i)canonical|refresh"),
                  F.regexp_extract_all(html, F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), F.lit(1)))
    canonical = F.transform(
        F.filter(tags, lambda t: t.rlike(r"(?is)^<link\b.*\brel\s*=\s*[\"']?canonical\b")),
        lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    refresh = F.transform(
        F.filter(tags, lambda t: t.rlike(r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b")),
        lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1))
    scheme = F.regexp_extract(url, r"^([^:]*)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")

    def absolute(t: Column) -> Column:
        return (F.when(t.contains("://"), t)
                .when(t.startswith("//"), F.concat(scheme, F.lit(":"), t))
                .when(t.startswith("/"), F.concat(site, t))
                .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), t)))

    return F.transform(F.filter(F.concat(canonical, refresh), lambda t: t != ""), absolute)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = tuple(RULES),
          redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> DataFrame:
    """``(page_id, host, path, rule, verdict, decided_by)`` for every row of ``pages``.

    ``redirects`` may add known redirects (columns ``source``, ``target``).
    A page's own rule decides first, so an explicit allow holds against any
    alias; else the page is blocked if a page, link target or redirect of its
    component is blocked by a rule; else it is allowed. A null URL or one without ``://`` has empty host
    and path, no aliases and no rule. Repeated rows each keep theirs; an empty
    table gives no rows. ``html`` is read once and not shuffled.
    """
    url = F.col("url")
    rule = best_rule(host_of(url), path_of(url), rules)
    narrow = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                           F.col(html_col).alias("html"))
              .select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"),
                      rule.alias("best"), link_targets(url, F.col("html")).alias("targets")))
    judged = materialize(narrow.select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
                                       F.col("best.action").alias("action"), "targets"), "judged-urls")

    links = judged.where("host != ''").select(F.col("url").alias("a"), F.explode("targets").alias("b"))
    if redirects is not None:
        links = links.unionAll(redirects.select(F.col("source").alias("a"), F.col("target").alias("b")))
    usual = judged.select(F.col("url").alias("a")).unionAll(links.select("b")).unionAll(links.select("a"))
    edges = links.unionAll(usual.select("a", canonical_form(F.col("a")).alias("b"))).distinct()
    components = materialize(connected_components(edges, "a", "b", "url-aliases"), "url-components")

    # pages and the ends of their links are judged; the forms made up above are not
    ends = links.select("b").unionAll(links.select("a")).distinct()
    ends = ends.select(F.col("b").alias("node"), best_rule(host_of(F.col("b")), path_of(F.col("b")), rules).alias("best"))
    blocked_urls = judged.where(F.col("action") == BLOCK).select(F.col("url").alias("node")).unionAll(
        ends.where(F.col("best.action") == BLOCK).select("node")).distinct()
    bad = components.join(blocked_urls, "node", "left_semi").select("component").distinct()
    # two written tables under a merge join: a component of any size can be split
    bad = materialize(bad, "blocked-components").hint("merge")
    aliases = materialize(components.join(bad, "component", "left_semi")
                          .select(F.col("node").alias("url"), F.lit(True).alias("alias")), "blocked-aliases")
    out = judged.join(aliases, "url", "left")
    verdict = (F.when(F.col("action").isNotNull(), F.col("action"))
               .when(F.col("alias"), F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    decided = (F.when(F.col("action").isNotNull(), F.lit("rule"))
               .when(F.col("alias"), F.lit("alias")).otherwise(F.lit("default")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), decided.alias("decided_by"))


#: DuckDB SQL of the registered query.
SQL = r"""
with recursive rules(action, h, p) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
p0 as (select row_number() over () as r, page_id, url,
              case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest,
              html from pages),
p1 as (select *, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
              coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from p0),
fit as (select r, arg_max(rules, (length(h || p), action = 'allow', h || p)) as best
        from p1 join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by r),
p2 as (select p1.*, best.h || best.p as rule, best.action as action from p1 left join fit using (r)),
tags as (select url, unnest(regexp_extract_all(html, '(?is)(<(?:link|meta)\b[^>]*>)', 1)) as t
         from p2 where host <> '' and regexp_matches(html, '(?i)canonical|refresh')),
raw_links as (
  select url, regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) as target from tags
  where regexp_matches(t, '(?is)^<link\b.*\brel\s*=\s*["'']?canonical\b')
  union all
  select url, regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) from tags
  where regexp_matches(t, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b')),
links as (
  select url as a, case when contains(target, '://') then target
           when starts_with(target, '//') then scheme || ':' || target
           when starts_with(target, '/') then site || target
           else site || case when folder = '' then '/' else folder end || target end as b
  from (select distinct l.url, l.target, regexp_extract(l.url, '^([^:]*)://', 1) as scheme,
               regexp_extract(l.url, '^([^:]*)://', 1) || '://' || host as site,
               regexp_replace(path, '[^/]*$', '') as folder
        from raw_links l join p2 using (url) where target <> '')),
urls as (select url as u from p2 where host <> '' union select a from links union select b from links),
parts as (select u, substr(u, strpos(u, '://') + 3) as rest from urls where strpos(u, '://') > 0),
canon as (
  select u, 'https://' || regexp_replace(regexp_replace(translate(regexp_extract(rest, '^([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':(80|443)$', ''), '^www\.', '')
            || regexp_replace(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '/+$', '')
            || case when q <> '' then '?' || q else '' end as c
  from (select u, rest, array_to_string(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
                 lambda x: x <> '' and not regexp_matches(x, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)')), '&') as q
        from parts)),
edges as (select a, b from links union select u, c from canon),
both_ways as (select a, b from edges union select b, a from edges),
target_rules as (
  select b, arg_max(action, (length(h || p), action = 'allow', h || p)) as action
  from (select distinct b, translate(regexp_extract(substr(b, strpos(b, '://') + 3), '^([^/?#]*)', 1),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               regexp_extract(substr(b, strpos(b, '://') + 3), '^[^/?#]*([^?#]*)', 1) as path from links)
       join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by b),
blocked(u) as (
  select u from (select url as u from p2 where action = 'block'
                 union select b from target_rules where action = 'block')
  union
  select b from blocked join both_ways on a = u)
select page_id, host, path, rule,
       case when action is not null then action when u is not null then 'block' else 'allow' end as verdict,
       case when action is not null then 'rule' when u is not null then 'alias' else 'default' end as decided_by
from p2 left join blocked on u = url"""
