"""URL filters: host and path rules, carried over to aliases by redirects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.components import connected_components
from cabmeter.llm.scratch import cut


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains and the
    paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    host = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of name and verdict, else
    null. Of two equally long rules the one with the longer host wins, and of
    two for the same place the one that allows."""
    order = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict))
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in reversed(order):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def normal_url(url: Column) -> Column:
    """The form in which addresses are compared: scheme and host with A-Z
    lower-cased, no ``.`` or ``..`` in the path, ``/`` for an empty path, no
    fragment."""
    u = F.regexp_replace(url, r"#[\s\S]*$", "")
    site = F.regexp_extract(u, r"^(?i)([a-z][a-z0-9+.-]*://[^/?]*)", 1)
    rest = F.substring(u, F.length(site) + 1, F.length(u))
    path, query = F.regexp_extract(rest, r"^([^?]*)", 1), F.regexp_extract(rest, r"^[^?]*([\s\S]*)", 1)
    parts = F.split(path, "/", -1)
    # The first part is empty; a last "." or ".." leaves a slash.
    kept = F.aggregate(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == ".", done).otherwise(F.concat(done, F.array(part))))
    short = F.concat(F.lit("/"), F.array_join(kept, "/"),
                     F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise(""))
    path = F.when((site != "") & (path == ""), "/").when(
        (site != "") & path.rlike(r"/\.\.?(/|$)"), short).otherwise(path)
    return F.concat(F.translate(site, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path, query)


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): a url and another address of the same page, both in their
    normal form. Taken from the canonical link and the refresh redirect of the
    html; a url that is not in normal form gives an edge (a, a). An address may
    be whole, begin with ``//`` (same scheme), ``/`` (same scheme and host) or
    ``?`` (same path), or be relative to the directory of the url; those of
    other schemes, such as ``mailto:``, are left out."""
    u = F.col(url)
    bare = F.regexp_replace(u, r"#[\s\S]*$", "")
    scheme, site = F.regexp_extract(u, r"^([^:/?#]+):", 1), F.regexp_extract(u, r"^([^:/?#]+://[^/?#]*)", 1)
    page = F.regexp_extract(bare, r"^([^?]*)", 1)
    folder = F.concat(site, F.coalesce(F.nullif(F.regexp_extract(page, r"^[^:/]+://[^/]*(/(?:[\s\S]*/)?)", 1), F.lit("")),
                                       F.lit("/")))

    def whole(address: Column) -> Column:
        a = F.replace(address, F.lit("&amp;"), F.lit("&"))
        return (F.when(a.rlike(r"^(?i)[a-z][a-z0-9+.-]*://"), a)
                .when(a.startswith("//") & (scheme != ""), F.concat(scheme, F.lit(":"), a))
                .when((site == "") | (a == "") | a.startswith("//") | a.startswith("#")
                      | a.rlike(r"^(?i)[a-z][a-z0-9+.-]*:"), F.lit(None))
                .when(a.startswith("/"), F.concat(site, a))
                .when(a.startswith("?"), F.concat(page, a))
                .otherwise(F.concat(folder, a)))

    head = F.col(html)
    link = F.regexp_extract(head, r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    jump = F.regexp_extract(head, r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    targets = F.array(
        bare,
        whole(F.regexp_extract(link, r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]*)", 1)),
        whole(F.regexp_extract(jump, r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]*)", 1)))
    pairs = pages.where(u.isNotNull()).select(
        u.alias("u"), normal_url(u).alias("a"), F.explode(F.array_compact(targets)).alias("b"))
    return pairs.select("u", "a", normal_url(F.col("b")).alias("b")).where(
        (F.col("b") != "") & ((F.col("a") != F.col("b")) | (F.col("u") != F.col("a")))).select("a", "b")


def judge_urls(pages: DataFrame, rules: list[Rule], page: str = "page_id", url: str = "url",
               html: str = "html", edges: DataFrame | None = None) -> DataFrame:
    """One row per page: ``page``, host, path, rule, verdict, and component
    (the smallest address of its aliases; null if it has none, or a rule).

    A rule that fits a page decides for it: an explicit allow therefore holds
    also where an alias is blocked. A page without a rule is blocked if an
    address in its component is blocked by a rule, whether or not that address
    is a page here, and allowed otherwise. ``edges`` (a, b) may add redirects
    that a crawler has logged. Addresses are compared, and components named,
    in the form of ``normal_url``; hosts and paths are those of the url.

    A null url, or one without ``://``, has an empty host and path, fits no
    rule and has no aliases. Repeated rows each get their row; an empty table
    gives no rows; other columns are ignored. The html is read once, for the
    edges, and the url once, into a table of narrow rows. Only pages without a
    rule look up their component, by an equi-join on that table's address.
    """
    links = alias_edges(pages, url, html)
    if edges is not None:
        links = links.unionByName(edges.select(normal_url(F.col("a")).alias("a"), normal_url(F.col("b")).alias("b")))
    members = cut(connected_components(cut(links, "urls")), "urls")
    rule = best_rule(url_host(F.col("id")), url_path(F.col("id")), rules)
    # Both written, so that AQE can split a component with very many aliases.
    decided = cut(members.select("component", (rule["verdict"] == "block").alias("hit")).groupBy(
        "component").agg(F.coalesce(F.max("hit"), F.lit(False)).alias("blocked")), "urls")
    marked = cut(members.join(decided, "component").select(
        F.col("id").alias("address"), "component", "blocked"), "urls")
    own = pages.select(F.col(page).alias("page_id"), F.col(url).alias("__url")).select(
        "page_id", "__url", url_host(F.col("__url")).alias("host"), url_path(F.col("__url")).alias("path"))
    own = own.withColumn("r", best_rule(F.col("host"), F.col("path"), rules))
    own = cut(own.select("page_id", "host", "path", F.col("r")["name"].alias("rule"), F.col("r")["verdict"].alias("verdict"),
                         F.when(F.col("r").isNull(), normal_url(F.col("__url"))).alias("address")), "urls")
    # A null url has no address: it must not meet others in one task.
    known = F.col("rule").isNotNull() | F.col("address").isNull()
    plain = own.where(known).select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"),
        F.lit(None).cast("string").alias("component"))
    looked_up = own.where(~known).join(marked, "address", "left").select(
        "page_id", "host", "path", "rule", F.when(F.col("blocked"), "block").otherwise("allow").alias("verdict"),
        "component")
    return plain.unionByName(looked_up)
