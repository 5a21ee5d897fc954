"""URL filters: a weighted vocabulary found with Aho-Corasick, after explicit host and path rules.

Every url is judged on its own, so the operator is one narrow projection: no shuffle, and only the url
column is read. Host, path and rules are column expressions; the vocabulary runs as one automaton per
Python worker over Arrow batches.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """``action`` is allow or block; ``host`` covers its subdomains; ``path`` is a prefix."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


class Vocabulary(NamedTuple):
    """Lower-case terms. One strict hit rejects. Soft hits reject when enough distinct terms are found
    and their weights add up to the limit."""

    strict: tuple[str, ...]
    soft: tuple[tuple[str, float], ...]
    min_soft: int = 2
    soft_limit: float = 2.0


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

# Soft terms by weight. Any two of the heaviest or of the middle reach the limit, three of the lightest do.
SOFT_TERMS = {
    1.25: "bets betting bitcoin gambling jackpot lottery payday pharmacy pills poker replica roulette slots sexy torrent",
    0.75: "ads adserver affiliate banner clicks coupons credit crypto dating diet download earn forex giveaway loans "
          "lucky mortgage popup prizes promo refinance rewards singles supplements track tracker weightloss",
    0.5: "bargain bonus cash cheap click deals discount free gift hot instant money now offer online sale save win winner",
}

VOCABULARY = Vocabulary(
    strict=("adult", "camgirls", "casino", "cialis", "escorts", "hentai", "keygen", "malware", "onlyfans", "phishing", "porn",
            "porno", "sexcam", "spam", "viagra", "warez", "xxx"),
    soft=tuple((term, weight) for weight, terms in SOFT_TERMS.items() for term in terms.split()),
    min_soft=2, soft_limit=1.5)

# Terms that a vocabulary may have: it goes to every task.
MAX_TERMS = 1_000_000


def vocabulary_from(terms: DataFrame, min_soft: int = 2, soft_limit: float = 1.5, max_terms: int = MAX_TERMS) -> Vocabulary:
    """A vocabulary from rows of ``term`` and ``weight``: strict where the weight is null.

    Terms are lower-cased (A-Z); null and empty ones are left out. A repeated term takes its largest weight, or is
    strict if one of its rows is. A weight that is not a finite, positive number is refused, as are more than
    ``max_terms`` terms.
    """
    low = F.translate("term", UPPER, LOWER)
    rows = (terms.where(F.length("term") > 0).groupBy(low.alias("term"))
            .agg(F.max("weight").cast("double").alias("weight"), F.min("weight").cast("double").alias("least"),
                 F.max(F.col("weight").isNull()).alias("strict"))
            .orderBy("term").limit(max_terms + 1).collect())
    if len(rows) > max_terms:
        raise ValueError(f"a vocabulary has at most {max_terms} terms")
    for r in rows:
        if not r.strict and not 0 < r.least <= r.weight < float("inf"):
            raise ValueError(f"the weight of {r.term!r} must be a positive number")
    return Vocabulary(strict=tuple(r.term for r in rows if r.strict),
                      soft=tuple((r.term, r.weight) for r in rows if not r.strict), min_soft=min_soft, soft_limit=soft_limit)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def longest_rule(rules: tuple[Rule, ...], host: Column, path: Column, field: str) -> Column:
    """``field`` (name or action) of the longest fitting rule, ties to the earlier name; null if none fits."""
    expr = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits, value = _fits(rule, host, path), F.lit(getattr(rule, field))
        expr = F.when(fits, value) if expr is None else expr.when(fits, value)
    return F.lit(None).cast("string") if expr is None else expr


@lru_cache(maxsize=8)
def _automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton | None:
    """One automaton for all terms; a term's value is (term, weight), the weight null for strict terms."""
    found = ahocorasick.Automaton()
    for term, weight in vocabulary.soft:
        found.add_word(term, (term, weight))
    for term in vocabulary.strict:
        found.add_word(term, (term, None))
    if not len(found):
        return None
    found.make_automaton()
    return found


def _word_like(text: str, at: int) -> bool:
    return 0 <= at < len(text) and text[at].isascii() and text[at].isalnum()


def count_hits(url: str | None, vocabulary: Vocabulary) -> tuple[int, int, float]:
    """Strict hits, distinct soft terms and the sum of their weights. A hit must not continue an ASCII
    letter or digit on either side."""
    automaton = _automaton(vocabulary)
    if not url or automaton is None:
        return 0, 0, 0.0
    text = url.translate(str.maketrans(UPPER, LOWER))
    strict, soft = 0, {}
    for last, (term, weight) in automaton.iter(text):
        if _word_like(text, last + 1) or _word_like(text, last - len(term)):
            continue
        if weight is None:
            strict += 1
        else:
            soft[term] = weight
    return strict, len(soft), float(sum(soft.values()))


def filter_urls(pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES,
                vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """Judge every row's url.

    Adds ``host``, ``path``, ``rule``, ``n_strict``, ``n_soft``, ``soft_weight`` and ``verdict`` (allow or
    block); input columns of those names are replaced. A fitting rule decides, the longest one if several
    fit. Otherwise one strict hit, or ``min_soft`` distinct soft terms weighing ``soft_limit``, block.
    A null, empty or relative url has an empty host and path and is judged by the vocabulary alone. A term
    listed as strict and soft counts as strict. Repeated rows are judged alike and all kept; an empty table
    gives an empty result.
    """

    @F.pandas_udf("n_strict int, n_soft int, soft_weight double")
    def hits(urls: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([count_hits(u, vocabulary) for u in urls], columns=["n_strict", "n_soft", "soft_weight"])

    added = ("host", "path", "rule", "n_strict", "n_soft", "soft_weight", "verdict")
    kept = [pages[c] for c in pages.columns if c not in added]
    host, path, hit = F.col("host"), F.col("path"), F.col("_hits")
    by_words = F.when((hit["n_strict"] > 0) | ((hit["n_soft"] >= vocabulary.min_soft)
                                               & (hit["soft_weight"] >= vocabulary.soft_limit)), "block").otherwise("allow")
    judged = pages.select(*kept, host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"),
                          hits(pages[url]).alias("_hits"))
    return judged.select(
        *[c for c in judged.columns if c != "_hits"], longest_rule(rules, host, path, "name").alias("rule"),
        hit["n_strict"].alias("n_strict"), hit["n_soft"].alias("n_soft"), hit["soft_weight"].alias("soft_weight"),
        F.coalesce(longest_rule(rules, host, path, "action"), by_words).alias("verdict"))
