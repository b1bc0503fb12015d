"""URL rules, and block decisions carried along redirects and canonical links.

Rules name a host and a path prefix; a rule fits the host and its subdomains, and the longest fitting
rule decides. Pages without a rule take the decision of their redirect equivalence class: redirect
and canonical-link edges form a graph whose connected components are aliases of one resource. A
component with a blocked member is blocked, unless another member is explicitly allowed.

Everything is built-in expressions and joins. The rule list is configuration: it is written into the
plan as one literal, so it should stay in the thousands.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and has
no aliases, so it is allowed. Fragments do not tell resources apart, nor does the scheme. Null html
has no links. Repeated pages get a row each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream.llm.common import hidden, settle
from rankstream.llm.components import connected_components

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"(?i)<(?:link|meta)\b[^>]*>"
_ATTRIBUTE = r"""(?i)\b{}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def resource_of(url: Column) -> Column:
    """Host, path and query: what aliases are nodes of; null without a host."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    host = host_of(url)
    path = path_of(url)
    return F.when(
        host != "", F.concat(host, F.when(path == "", "/").otherwise(path), F.coalesce(query, F.lit("")))
    )


def decision(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as a struct of ``rule`` and ``verdict``; null if none fits."""
    if not rules:
        return F.lit(None).cast("struct<rule: string, verdict: string>")
    hosts: dict[str, list[Rule]] = {}
    for rule in rules:
        hosts.setdefault(rule.host, []).append(rule)

    def entry(rule: Rule) -> Column:
        return F.struct(
            F.lit(len(rule.name)).alias("length"), F.lit(rule.path).alias("path"),
            F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"),
        )

    known = F.create_map(
        *[x for name, own in hosts.items() for x in (F.lit(name), F.array(*map(entry, own)))]
    )
    labels = max(name.count(".") + 1 for name in hosts)
    suffixes = F.array_distinct(
        F.array(*[F.substring_index(host, ".", -n) for n in range(1, labels + 1)])
    )
    candidates = F.flatten(
        F.filter(
            F.transform(suffixes, lambda s: F.try_element_at(known, s)), lambda r: r.isNotNull()
        )
    )
    best = F.array_max(F.filter(candidates, lambda r: path.startswith(r["path"])))
    return F.when(
        best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict"))
    )


def _attribute(tag: Column, name: str) -> Column:
    pattern = _ATTRIBUTE.format(name)
    return F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])


def _without_dots(path: Column) -> Column:
    """An absolute path with its ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        return (
            F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .when(part == ".", done).otherwise(F.concat(done, F.array(part)))
        )

    kept = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.array().cast("array<string>"), step)
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    folder = F.element_at(parts, -1).isin(".", "..") & ~joined.endswith("/")
    return F.when(folder, F.concat(joined, F.lit("/"))).otherwise(joined)


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target) urls of canonical links and immediate refreshes in the pages' markup."""
    content = F.col(f"`{html}`")
    tags = (
        pages.filter(content.rlike(r"(?i)canonical|http-equiv"))
        .select(F.col(f"`{url}`").alias("source"),
                F.explode(F.regexp_extract_all(content, F.lit(_LINK), F.lit(0))).alias("tag"))
    )
    rel, equiv = F.lower(_attribute(F.col("tag"), "rel")), F.lower(_attribute(F.col("tag"), "http-equiv"))
    refresh = F.trim(F.regexp_extract(_attribute(F.col("tag"), "content"), r"(?i)url\s*=\s*['\"]?([^'\"]*)", 1))
    target = F.when(F.array_contains(F.split(rel, r"\s+"), "canonical"),
                    F.trim(_attribute(F.col("tag"), "href"))).when(equiv == "refresh", refresh)
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract("source", r"(?s)^(.*?)://", 1)
    root = F.regexp_extract("source", r"(?s)^.*?://[^/?#]*", 0)
    way = F.regexp_extract("target", r"(?s)^[^?#]*", 0)
    rest = F.regexp_extract("target", r"(?s)[?#].*$", 0)
    path = path_of(F.col("source"))
    own = F.when(path == "", "/").otherwise(path)
    folder = F.regexp_extract(own, r"(?s)^.*/", 0)
    whole = (
        F.when(F.col("target").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("target"))
        .when(F.col("target").startswith("//"), F.concat(scheme, F.lit(":"), F.col("target")))
        .when(F.col("target").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))  # mailto: and the like
        .when(F.col("target").startswith("/"), F.concat(root, _without_dots(way), rest))
        .when(F.col("target").startswith("?"), F.concat(root, own, rest))
        .when(way != "", F.concat(root, _without_dots(F.concat(folder, way)), rest))
    )
    return tags.select("source", target.alias("target")).select("source", whole.alias("target")).filter(
        F.col("target").isNotNull() & F.col("source").isNotNull()
    )


def alias_verdicts(links: DataFrame, rules: list[Rule]) -> DataFrame:
    """(resource, verdict) of every resource that has an alias with a rule.

    ``links`` has the urls ``source`` and ``target``. Resources are joined by a 128-bit digest.
    """
    def ends(column: str) -> DataFrame:
        url = F.col(column)
        return links.select(
            F.md5(resource_of(url)).alias("node"),
            decision(host_of(url), path_of(url), rules)["verdict"].alias("verdict"),
        ).filter(F.col("node").isNotNull())

    edges = links.select(
        F.md5(resource_of(F.col("source"))).alias("a"), F.md5(resource_of(F.col("target"))).alias("b")
    )
    members = connected_components(edges)
    decided = ends("source").unionByName(ends("target")).filter("verdict is not null").distinct()
    spoken = (
        members.join(decided, "node")
        .groupBy("root")
        .agg(F.max((F.col("verdict") == ALLOW).cast("int")).alias("allowed"))
    )
    verdict = F.when(F.col("allowed") == 1, ALLOW).otherwise(BLOCK)
    return members.join(spoken, "root").select("node", verdict.alias("verdict"))


def judged(
    pages: DataFrame, rules: list[Rule], links: DataFrame | None = None,
    url: str = "url", html: str = "html",
) -> DataFrame:
    """``pages`` without ``html``, with host, path, rule and verdict.

    ``links`` adds (source, target) redirects, say from a crawl log, to those in the markup.
    """
    found = page_links(pages, url, html)
    if links is not None:
        found = found.unionByName(links.select("source", "target"))
    aliases = settle(alias_verdicts(settle(found, "links"), rules), "aliases")
    node, alias, own = hidden("node"), hidden("alias"), hidden("rule")
    aliases = aliases.select(F.col("node").alias(node), F.col("verdict").alias(alias))
    address = F.col(f"`{url}`")
    plain = pages.drop(html, "host", "path", "rule", "verdict")
    sited = plain.withColumns(
        {"host": host_of(address), "path": path_of(address), node: F.md5(resource_of(address))}
    ).withColumn(own, decision(F.col("host"), F.col("path"), rules))
    joined = sited.join(aliases, node, "left")
    verdict = F.coalesce(F.col(f"{own}.verdict"), F.col(alias), F.lit(ALLOW))
    return joined.withColumns({"rule": F.col(f"{own}.rule"), "verdict": verdict}).drop(node, alias, own)
