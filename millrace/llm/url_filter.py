"""URL filter: allow and block rules by host and path, extended to aliases by redirect and canonical links.

A rule's verdict holds for the urls it fits. A url without a rule is blocked if any alias of it, that is any url of its
connected component over redirect and canonical links, is blocked by a rule; else it is allowed. An explicit allow takes
precedence: a url that an allow rule fits stays allowed whatever its aliases are, and a component's block reaches only
members without a rule.

DataFrame functions only. Cases: a NULL url, or one without ``://``, has an empty host and path, fits no rule and is no
alias, hence allowed; repeated pages give one row each; pages without html have no links; an empty table gives an empty
table; further columns of the pages are dropped by ``judge_pages`` unless named in ``keep``; of equally long rules that
fit, allow wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected_components

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The links that make two urls one document, as (pattern of the tag, pattern of the address in it).
CANONICAL = (
    r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>",
    r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)",
)
REFRESH = (
    r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>",
    r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)",
)


class Rule(NamedTuple):
    """``verdict`` for urls of ``host`` and its subdomains whose path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for NULL or no ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for NULL or no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(url: Column) -> Column:
    """A url's identity: host, path and query, without scheme and fragment; NULL for no url."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(F.lit("//"), host_of(url), path_of(url), query))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Text of the longest rule that fits, else NULL."""
    order = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "allow", r.text))
    return F.coalesce(*[F.when(fits(r, host, path), F.lit(r.text)) for r in order], F.lit(None).cast("string"))


def verdict_of(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Verdict of the longest rule that fits, else NULL."""
    order = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "allow", r.text))
    return F.coalesce(*[F.when(fits(r, host, path), F.lit(r.verdict)) for r in order], F.lit(None).cast("string"))


def absolute(target: Column, url: Column) -> Column:
    """``target`` as seen from ``url``: absolute, or relative to its scheme, host or folder."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?):", 1)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    relative = F.concat(folder, F.when(folder.endswith("/"), F.lit("")).otherwise(F.lit("/")), target)
    return (
        F.when(F.instr(target, "://") > 0, target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(relative)
    )


def alias_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(url, target)`` for every redirect and canonical link; both are urls."""
    found = []
    for tag, address in (CANONICAL, REFRESH):
        target = F.regexp_extract(F.regexp_extract(F.col(html_col), tag, 0), address, 1)
        found.append(F.when(F.length(target) > 0, absolute(F.replace(target, F.lit("&amp;"), F.lit("&")), F.col(url_col))))
    links = pages.select(F.col(url_col).alias("url"), F.explode(F.array(*found)).alias("target"))
    return links.filter(F.col("url").contains("://") & F.col("target").isNotNull())


def judge_pages(
    pages: DataFrame,
    rules: Sequence[Rule],
    links: DataFrame | None = None,
    url_col: str = "url",
    html_col: str = "html",
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """The ``keep`` columns with ``host``, ``path``, ``rule`` (NULL if none fits), ``verdict`` and ``alias_of`` (the
    smallest key of the url's component, NULL if it has no link).

    ``links`` (url, target) default to those in the pages' html. Urls that are only named by a link are judged too: a
    blocked target blocks the pages that lead to it.
    """
    links = alias_links(pages, url_col, html_col) if links is None else links
    ends = links.select(key_of(F.col("url")).alias("a"), key_of(F.col("target")).alias("b"))
    classes = connected_components(ends, "a", "b")
    # A key has the host and path of its urls, so members are judged by it; one row per class with a blocked member.
    member = F.concat(F.lit("x:"), F.col("node"))
    verdict = verdict_of(rules, host_of(member), path_of(member))
    judged = classes.withColumn("_blocked", F.coalesce(verdict == "block", F.lit(False)))
    blocked = judged.groupBy("component").agg(F.max("_blocked").alias("_blocked"))
    aliases = classes.join(blocked, "component").select(
        F.col("node").alias("_key"), F.col("component").alias("alias_of"), "_blocked"
    )
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rows = pages.select(
        *[F.col(c) for c in keep], host.alias("host"), path.alias("path"), rule_of(rules, host, path).alias("rule"),
        verdict_of(rules, host, path).alias("_own"), key_of(F.col(url_col)).alias("_key"),
    )
    spread = F.when(F.col("_blocked"), F.lit("block")).otherwise(F.lit("allow"))
    joined = rows.join(aliases, "_key", "left")
    return joined.select(*keep, "host", "path", "rule", F.coalesce("_own", spread).alias("verdict"), "alias_of")
