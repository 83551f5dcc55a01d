"""URL filter: a weighted vocabulary of strict and soft terms, counted in one
Aho-Corasick pass per URL, behind allow / block rules on host and path.

Defined results: a NULL URL, or one without ``://``, has empty host and path,
fits no rule and holds no term (``allow``); rows are judged one by one, so
repeated rows repeat their verdict; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.llm.common import ascii_lower

STRICT = ("adult-x", "casino-win", "cheap-pills", "spam-farm", "porn", "viagra", "xxx")
SOFT = ("ads", "adult", "bet", "bets", "casino", "cheap", "free", "pills", "poker", "spam", "track", "win")
#: (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

HITS = T.StructType([T.StructField("strict", T.IntegerType()), T.StructField("soft", T.IntegerType())])


def parts(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased.
    Path: what follows, up to ``? #`` or the end.  Without ``://`` both empty."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(at > 0, host).otherwise(""), F.when(at > 0, path).otherwise("")


def term_hits(strict: Sequence[str], soft: Sequence[str]):
    """Pandas UDF: distinct strict and distinct soft terms of a lower-cased URL.
    A term counts only between characters other than a-z and 0-9; without terms
    there are no hits."""
    vocabulary = [(t, True) for t in strict] + [(t, False) for t in soft]

    @F.pandas_udf(HITS)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for k, (term, _) in enumerate(vocabulary):
            automaton.add_word(term, k)
        automaton.make_automaton()
        word = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

        def one(url: str) -> tuple[int, int]:
            found = set()
            for end, k in automaton.iter(url):
                start = end - len(vocabulary[k][0]) + 1
                if (start == 0 or url[start - 1] not in word) and (end + 1 == len(url) or url[end + 1] not in word):
                    found.add(k)
            n = sum(vocabulary[k][1] for k in found)
            return n, len(found) - n

        for urls in batches:
            yield pd.DataFrame([one(u) if vocabulary else (0, 0) for u in urls], columns=["strict", "soft"], dtype="int32")

    return count


def judge_urls(
    pages: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = 2,
) -> DataFrame:
    """``pages`` plus host, path, strict_hits, soft_hits, rule and verdict.

    A rule fits its host and all subdomains where the path starts with the
    rule's; the longest rule decides.  Without a rule a URL is blocked on one
    strict term or ``soft_limit`` distinct soft ones.  Columns of these names
    in ``pages`` are replaced."""
    pages = pages.drop("host", "path", "strict_hits", "soft_hits", "rule", "verdict")
    df = pages.withColumn("__u", F.coalesce(F.col(url), F.lit("")))
    host, path = parts(F.col("__u"))
    df = df.withColumns({"host": host, "path": path, "__hits": term_hits(strict, soft)(ascii_lower(F.col("__u")))})
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))

    def fits(h: str, p: str) -> Column:
        return ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)

    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, h, p in reversed(longest_first):
        rule = F.when(fits(h, p), F.lit(h + p)).otherwise(rule)
        said = F.when(fits(h, p), F.lit(verdict)).otherwise(said)
    by_terms = F.when((F.col("strict_hits") >= 1) | (F.col("soft_hits") >= soft_limit), "block").otherwise("allow")
    df = df.withColumns({"strict_hits": F.col("__hits.strict"), "soft_hits": F.col("__hits.soft")})
    df = df.withColumns({"rule": rule, "verdict": F.coalesce(said, by_terms)})
    return df.drop("__u", "__hits")


def _sql() -> str:
    def held(term: str) -> str:
        return f"CAST(regexp_matches(u, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') AS INT)"

    longest = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r))

    def case(value) -> str:
        return " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(v, h, p)}'" for v, h, p in longest)

    return f"""
WITH a AS (SELECT page_id, coalesce(url, '') url, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') u FROM pages),
b AS (SELECT page_id, u,
        CASE WHEN contains(u, '://') THEN regexp_extract(substr(u, strpos(u, '://') + 3), '^[^/?#]*') ELSE '' END host,
        CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
      FROM a),
c AS (SELECT *, {' + '.join(map(held, STRICT))} strict_hits, {' + '.join(map(held, SOFT))} soft_hits FROM b)
SELECT page_id, host, path, CASE {case(lambda v, h, p: h + p)} ELSE NULL END AS rule,
       CASE {case(lambda v, h, p: v)} WHEN strict_hits >= 1 OR soft_hits >= 2 THEN 'block' ELSE 'allow' END AS verdict,
       strict_hits, soft_hits
FROM c"""


SQL = _sql()
