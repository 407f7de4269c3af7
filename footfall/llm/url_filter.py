"""URL filter: a weighted vocabulary found by an Aho-Corasick automaton, and site rules.

Null urls and urls without `://` have an empty host and path. Such a url is judged by
its vocabulary alone. Equal urls get equal verdicts; every input row gives one row.
"""

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: One of these as a whole word is enough to reject a url.
STRICT_TERMS = ["casino", "porn", "xxx", "viagra", "warez", "adult", "escort", "gambling", "malware", "phishing"]
#: A url is rejected for this many different soft terms.
SOFT_TERMS = [
    "bet", "bets", "bonus", "cheap", "deal", "deals", "discount", "free", "jackpot", "loan", "loans", "lottery",
    "pills", "poker", "prize", "promo", "replica", "slots", "win", "winner",
]
SOFT_HITS = 2


@dataclass(frozen=True)
class Rule:
    """`site` is host and path, such as `example.org/en/`; verdict is allow or block."""

    site: str
    verdict: str


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return tuple(F.coalesce(c, F.lit("")) for c in (F.translate(host, upper, lower), path))


def site_rule(host: Column, path: Column, rules: list[Rule], field: str) -> Column:
    """`site` or `verdict` of the longest rule that fits, null when none does."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.site), r.site)):
        name, slash, below = rule.site.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + below)
        value = F.lit(getattr(rule, field))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("string") if out is None else out


def term_hits(strict: list[str], soft: list[str]):
    """A UDF: the distinct strict and the distinct soft terms that a url has as whole words.

    A hit counts where no ASCII letter or digit stands on either side of it.
    """
    terms = [*((t, True) for t in strict), *((t, False) for t in soft)]

    @F.arrow_udf("strict int, soft int")
    def hits(urls: pa.Array) -> pa.Array:
        automaton = ahocorasick.Automaton()
        for term, is_strict in terms:
            automaton.add_word(term, (term, is_strict))
        if terms:
            automaton.make_automaton()
        edge = re.compile(r"[0-9a-z]")
        counts = []
        for url in urls.to_pylist():
            text, found = (url or "").encode().lower().decode(), set()  # A-Z only
            for end, (term, is_strict) in automaton.iter(text) if terms else ():
                begin = end - len(term) + 1
                before, after = text[begin - 1 : begin] if begin else "", text[end + 1 : end + 2]
                if not (edge.match(before) or edge.match(after)):
                    found.add((term, is_strict))
            n = sum(s for _, s in found)
            counts.append({"strict": n, "soft": len(found) - n})
        return pa.array(counts, pa.struct([("strict", pa.int32()), ("soft", pa.int32())]))

    return hits


def filter_urls(
    pages: DataFrame, rules: list[Rule] | None = None, strict: list[str] = STRICT_TERMS,
    soft: list[str] = SOFT_TERMS, soft_hits: int = SOFT_HITS,
) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_hits for each row of `pages`.

    The verdict is that of the longest rule that fits the site; without one a url is
    blocked for one strict term or `soft_hits` different soft terms. Other columns of
    `pages` are not read.
    """
    host, path = url_parts(F.col("url"))
    hits = term_hits(strict, soft)
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path"), hits("url").alias("hits"))
    by_terms = F.when((F.col("hits.strict") > 0) | (F.col("hits.soft") >= soft_hits), "block").otherwise("allow")
    given = (F.col("host"), F.col("path"), rules or [])
    return judged.select(
        "page_id",
        "host",
        "path",
        site_rule(*given, "site").alias("rule"),
        F.coalesce(site_rule(*given, "verdict"), by_terms).alias("verdict"),
        F.col("hits.strict").alias("strict_hits"),
        F.col("hits.soft").alias("soft_hits"),
    )
