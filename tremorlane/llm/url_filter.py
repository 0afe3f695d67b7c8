"""URL verdicts: host and path rules, then a weighted vocabulary."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of the query, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: One of these in a URL is enough to block it.
STRICT = ("porn", "xxx", "hentai", "escort", "warez", "keygen", "jackpot", "viagra", "cialis")
#: So many different ones of these are.
SOFT = (
    "adult", "bet", "bonus", "casino", "cheap", "crack", "dating", "free", "gambling", "hack",
    "loan", "nude", "pharma", "pills", "poker", "sex", "slots", "torrent",
)
SOFT_HITS = 2

_BOUND = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty where the URL is null or has no `://`."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null where none does.

    A rule fits its host, every subdomain, and paths that start with its own.
    """
    ordered = sorted(rules, key=lambda rule: (-len(rule[1] + rule[2]), rule))
    choice = None
    for verdict, name, start in ordered:
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        value = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        choice = F.when(fits, value) if choice is None else choice.when(fits, value)
    return choice if choice is not None else F.lit(None).cast("struct<rule: string, verdict: string>")


def vocabulary(strict: Sequence[str], soft: Sequence[str]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for term in soft:
        machine.add_word(term, (term, False))
    for term in strict:
        machine.add_word(term, (term, True))
    machine.make_automaton()
    return machine


def term_hits(url: str, machine: ahocorasick.Automaton) -> tuple[set[str], set[str]]:
    """Strict and soft terms in a lower-cased URL that no letter or digit adjoins."""
    strict, soft = set(), set()
    if not len(machine):
        return strict, soft
    for last, (term, is_strict) in machine.iter(url):
        first = last - len(term) + 1
        if first and url[first - 1] in _BOUND:
            continue
        if last + 1 < len(url) and url[last + 1] in _BOUND:
            continue
        (strict if is_strict else soft).add(term)
    return strict, soft


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_hits: int = SOFT_HITS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, strict_terms, soft_terms) for every row of `pages`.

    The longest fitting rule decides. Where none fits, a URL is blocked if it
    holds a strict term, or `soft_hits` different soft ones; terms are found
    by one automaton, after A-Z were lower-cased, and count only where neither
    side is a letter a-z or a digit. A term in both lists is strict. A null or
    empty URL has no host, no path and no terms and is allowed. Repeated rows
    are returned as often as they come; only `page_id` and `url` are read; an
    empty table gives no rows.
    """
    listed = pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = vocabulary(strict, soft)
        for batch in batches:
            found = [term_hits(url, machine) for url in batch.column("plain").to_pylist()]
            columns = [batch.column(name) for name in ("page_id", "host", "path", "fit")]
            for kind in (0, 1):
                columns.append(pa.array([sorted(terms[kind]) for terms in found], listed))
            names = ["page_id", "host", "path", "fit", "strict_terms", "soft_terms"]
            yield pa.RecordBatch.from_arrays(columns, names)

    host, path = url_parts(F.col("url"))
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        host.alias("host"),
        path.alias("path"),
        ascii_lower(F.coalesce("url", F.lit(""))).alias("plain"),
    ).withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    found = source.mapInArrow(
        run,
        "page_id long, host string, path string, fit struct<rule: string, verdict: string>,"
        " strict_terms array<string>, soft_terms array<string>",
    )
    bad = (F.size("strict_terms") > 0) | (F.size("soft_terms") >= soft_hits)
    own = F.when(bad, F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", own).alias("verdict"),
        "strict_terms",
        "soft_terms",
    )
