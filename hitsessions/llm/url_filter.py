"""URL filter: host and path rules first, then a weighted vocabulary.

A rule names a host (with its subdomains) and the start of a path, and
blocks or allows; of the rules that fit a URL the longest decides. A URL
that no rule fits is judged by the terms in it: one Aho-Corasick pass over
the URL finds every term of the vocabulary, hits that are part of a longer
word are left out by a check of the characters around them, and a URL with
one strict term, or with ``soft_needed`` different soft terms, is blocked.

A ``*`` at an end of a term leaves that end unchecked: ``porn*`` is found
in ``pornsite``, ``bet`` isn't found in ``alphabet``.

Defined cases
-------------
* Null URL, or no ``://`` in it: host and path are empty, so that no rule
  fits. The terms of a URL without ``://`` count all the same; a null or
  empty URL has none and is allowed.
* The host keeps what stands before and after its name (user, port); a
  rule's host has to be all of it, or its end after a dot.
* Of two rules of one length that fit, the one that blocks decides.
* A term counts once, however often it occurs. Only A-Z are lower-cased,
  in hosts and for the search; paths are compared as they are.
* Repeated rows get equal results. Other columns, whatever their names,
  are carried in ``row``.

Scale: one pass without a shuffle. Only the URL, its host and its path go
to Python; the other columns stay in the JVM. The automaton is built once
per task from the vocabulary, a parameter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .line_dedup import UPPER, LOWER, lower_ascii
from .rows import name

#: (host, start of the path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))
STRICT = ("porn*", "xxx", "hentai*", "escort", "escorts", "viagra", "cialis", "casino", "casinos", "warez", "keygen",
          "adult-x", "spam-farm", "payday-loan*")
SOFT = ("ads", "adult", "bet", "bets", "betting", "bonus", "cheap", "click", "crack*", "deal", "deals", "farm", "free",
        "gamble*", "hot", "jackpot", "loan", "loans", "nude*", "pill", "pills", "poker", "sex", "slots", "spam",
        "torrent*", "track", "tracker", "win", "winner")
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_LOWER = str.maketrans(UPPER, LOWER)


@dataclass(frozen=True)
class Vocabulary:
    strict: tuple = STRICT
    soft: tuple = SOFT
    soft_needed: int = 2

    def __post_init__(self):
        for t in (*self.strict, *self.soft):
            if not t.strip("*") or "*" in t.strip("*") or t != t.translate(_LOWER):
                raise ValueError(f"not a term: {t!r} (lower case, a * only at its ends)")

    def automaton(self):
        """Every term's text, with what it says: (term, weight, left end checked, right end checked)."""
        found: dict[str, list] = {}
        for weight, terms in ((self.soft_needed, self.strict), (1, self.soft)):
            for t in terms:
                found.setdefault(t.strip("*"), []).append((t, weight, t[0] != "*", t[-1] != "*"))
        a = ahocorasick.Automaton()
        for text, says in found.items():
            a.add_word(text, (len(text), says))
        if found:
            a.make_automaton()
        return a

    def terms_in(self, url: str, automaton) -> dict[str, int]:
        """The terms of a URL and their weights."""
        hits: dict[str, int] = {}
        if not len(automaton):
            return hits
        url = url.translate(_LOWER)
        for end, (length, says) in automaton.iter(url):
            left = end - length < 0 or url[end - length] not in _WORD
            right = end + 1 == len(url) or url[end + 1] not in _WORD
            for term, weight, check_left, check_right in says:
                if (left or not check_left) and (right or not check_right):
                    hits[term] = max(weight, hits.get(term, 0))
        return hits


class Rules:
    """Host and path rules, looked up by the host and the domains it belongs to."""

    def __init__(self, rules):
        self.by_host: dict[str, list] = {}
        for host, path, verdict in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"a rule allows or blocks, not {verdict!r}")
            self.by_host.setdefault(host, []).append((len(host) + len(path), verdict == "block", path, f"{host}{path}"))

    def of(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The rule that decides, and its verdict."""
        best, at = None, 0
        while host and at >= 0:
            for rule in self.by_host.get(host[at:], ()):
                if path.startswith(rule[2]) and (best is None or rule[:2] > best[:2]):
                    best = rule
            dot = host.find(".", at)
            at = dot + 1 if dot >= 0 else -1
        return (None, None) if best is None else (best[3], "block" if best[1] else "allow")


def filter_urls(pages: DataFrame, url_col: str = "url", vocabulary: Vocabulary = Vocabulary(), rules=RULES) -> DataFrame:
    """Rows ``row, host, path, rule, verdict, strict_terms, soft_terms`` of every input row.

    ``rule`` is the text of the rule that decided (null: the vocabulary
    did); ``verdict`` is ``allow`` or ``block``. The terms, sorted, are
    given for every URL.
    """
    @F.pandas_udf("rule string, verdict string, strict_terms array<string>, soft_terms array<string>")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        automaton, table = vocabulary.automaton(), Rules(rules)
        for urls, hosts, paths in batches:
            out = []
            for url, host, path in zip(urls, hosts, paths):
                hits = vocabulary.terms_in(url, automaton)
                strict = sorted(t for t in hits if t in vocabulary.strict)
                soft = sorted(t for t in hits if t in vocabulary.soft)
                rule, verdict = table.of(host, path)
                if rule is None:
                    verdict = "block" if sum(hits.values()) >= vocabulary.soft_needed else "allow"
                out.append((rule, verdict, strict, soft))
            yield pd.DataFrame(out, columns=["rule", "verdict", "strict_terms", "soft_terms"])

    url = F.coalesce(pages[name(url_col)].cast("string"), F.lit(""))
    part = lambda n: F.regexp_extract("u", r"://([^/?#]*)([^?#]*)", n)
    rows = pages.select(F.struct(*[F.col(name(c)) for c in pages.columns]).alias("row"), url.alias("u"))
    rows = rows.select("row", "u", lower_ascii(part(1)).alias("host"), part(2).alias("path"))
    return rows.withColumn("j", judge("u", "host", "path")).select("row", "host", "path", "j.*")


def query(spark, sf_dir: str) -> DataFrame:
    out = filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))
    return out.select("row.page_id", "host", "path", "rule", "verdict",
                      F.size("strict_terms").cast("long").alias("n_strict"),
                      F.size("soft_terms").cast("long").alias("n_soft"))


def _count(terms: tuple) -> str:
    def hit(t):
        left, right = ("" if t[0] == "*" else "(^|[^a-z0-9])"), ("" if t[-1] == "*" else "($|[^a-z0-9])")
        return f"regexp_matches(u, '{left}{t.strip('*')}{right}')::BIGINT"
    return " + ".join(hit(t) for t in terms)


ORACLE = f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS u,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), rule(rhost, rpath, says) AS (VALUES {', '.join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
fits AS (
  SELECT page_id, arg_max({{'rule': rhost || rpath, 'says': says}}, 2 * length(rhost || rpath) + (says = 'block')::INT) AS r
  FROM (SELECT DISTINCT page_id, host, path FROM parts), rule
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id
), counts AS (
  SELECT *, {_count(STRICT)} AS n_strict, {_count(SOFT)} AS n_soft FROM parts
)
SELECT c.page_id, c.host, c.path, f.r.rule AS rule,
       coalesce(f.r.says, CASE WHEN n_strict > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END) AS verdict, n_strict, n_soft
FROM counts c LEFT JOIN fits f USING (page_id)
"""
