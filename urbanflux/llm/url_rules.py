"""URL filters: rules indexed by their rarest literal token, regular expressions only for those fetched.

Every rule names tokens that any URL it fits must hold (runs of ``a-z0-9``). How often those tokens
occur is counted over all URLs; a rule is filed under its rarest one. The tokens of a URL fetch
the rules filed under them, and only these run their expression. All of it stays inside one row.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The index is a constant of the plan; more rules than this are refused.
MAX_RULES = 20_000


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` runs on host and path in one string (``host/path``); ``site`` marks prefix rules."""

    verdict: str
    name: str
    pattern: str
    literals: tuple[str, ...]
    site: bool = False

    def __post_init__(self):
        if not self.literals:
            raise ValueError(f"rule {self.name} holds no whole token")


def site_rule(verdict: str, site: str) -> UrlRule:
    """Fits the host before the first slash, all its subdomains, and paths that start with the rest."""
    literals = re.findall(r"[a-z0-9]+(?=[^a-z0-9])", site.lower())
    return UrlRule(verdict, site, rf"^(?:[^/]*\.)?{re.escape(site)}", tuple(dict.fromkeys(literals)), True)


def pattern_rule(verdict: str, name: str, pattern: str, *literals: str) -> UrlRule:
    """A regular expression; ``literals`` are whole tokens that every URL it fits holds."""
    return UrlRule(verdict, name, pattern, literals)


SITE_RULES = [
    site_rule("allow", "org/"),
    site_rule("block", "example.org/es/"),
    site_rule("block", "example.org/en/1"),
    site_rule("allow", "com/fr/"),
    site_rule("block", "com/de/"),
]
#: What decides where no site rule fits; the first that fits counts, and none means allow.
PATTERN_RULES = [
    pattern_rule("block", "spam farm", r"^(?:[^/]*[.-])?spam-farm\.", "spam", "farm"),
    pattern_rule("block", "ad server", r"^(?:[^/]*\.)?adserver\.", "adserver"),
    pattern_rule("block", "login page", r"^[^/]+/(?:[^/]+/)*login(?:[./]|$)", "login"),
    pattern_rule("block", "admin page", r"^[^/]+/(?:[^/]+/)*wp-admin(?:/|$)", "wp", "admin"),
    pattern_rule("block", "shopping cart", r"^[^/]+/(?:[^/]+/)*cart/(?:checkout|add)(?:/|$)", "cart"),
]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where ``://`` is missing."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    found = at > 0
    return F.when(found, ascii_lower(host)).otherwise(""), F.when(found, path).otherwise("")


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.split(ascii_lower(target), "[^a-z0-9]+"))


def _literal_counts(targets: DataFrame, literals: list[str]) -> dict[str, int]:
    """In how many URLs each literal occurs; a row per literal at most reaches the driver."""
    wanted = F.from_json(F.lit(json.dumps(literals)), "array<string>")
    found = targets.select(F.explode(F.array_intersect(_tokens(F.col("target")), wanted)).alias("token"))
    return {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}


def judge_urls(
    df: DataFrame, url: str = "url", rules: list[UrlRule] | None = None, prefix: str = ""
) -> DataFrame:
    """Adds ``host, path, rule, verdict, method_rule``, each behind ``prefix``.

    ``rule`` is the longest site rule that fits (ties: the smaller name), else null. ``verdict``
    is that rule's, else that of the first pattern rule that fits (``method_rule``), else allow. Null
    and malformed URLs have an empty host and path and no rule. Columns of these names are
    replaced; repeated rows get equal results.
    """
    rules = [*SITE_RULES, *PATTERN_RULES] if rules is None else rules
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    host, path = url_parts(F.col(url))
    target = F.concat(host, path)
    counts = _literal_counts(df.select(target.alias("target")), sorted({x for r in rules for x in r.literals}))
    size = max(1, len(rules))
    shelves: list[dict[str, list[int]]] = [{} for _ in range(size)]
    for number, rule in enumerate(rules):
        rarest = min(rule.literals, key=lambda x: (counts.get(x, 0), x))
        shelves[zlib.crc32(rarest.encode()) % size].setdefault(rarest, []).append(number)
    index = F.from_json(F.lit(json.dumps(shelves)), "array<map<string,array<int>>>")
    known = F.from_json(
        F.lit(json.dumps([{"o": n, "p": r.pattern, "n": r.name, "v": r.verdict, "s": r.site, "l": -len(r.name)} for n, r in enumerate(rules)])),
        "array<struct<o:int,p:string,n:string,v:string,s:boolean,l:int>>",
    )

    def fetched(token: Column) -> Column:
        shelf = F.element_at(index, (F.crc32(token.cast("binary")) % F.lit(size)).cast("int") + 1)
        return F.coalesce(F.element_at(shelf, token), F.array().cast("array<int>"))

    candidates = F.transform(F.flatten(F.transform(_tokens(target), fetched)), lambda n: F.element_at(known, n + 1))
    fits = F.filter(candidates, lambda r: F.rlike(F.concat(host, path), r["p"]))
    site = F.array_min(F.transform(F.filter(fits, lambda r: r["s"]), lambda r: F.struct(r["l"], r["n"], r["v"])))
    other = F.array_min(F.transform(F.filter(fits, lambda r: ~r["s"]), lambda r: F.struct(r["o"], r["n"], r["v"])))
    added = {
        "host": host,
        "path": path,
        "rule": site["n"],
        "verdict": F.coalesce(site["v"], other["v"], F.lit("allow")),
        "method_rule": other["n"],
    }
    return df.withColumns({f"{prefix}{k}": v for k, v in added.items()})
