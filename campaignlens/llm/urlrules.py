"""URL filter: rules indexed by their rarest literal token (DataFrame functions only).

A rule is a regular expression over ``host + path`` with the literal tokens
that every match must contain.  Each rule is filed under the one of its tokens
that fewest URLs hold; the distinct tokens of a URL fetch the rules filed under
them, and only those rules' expressions run on it.  Work is per distinct
address; pages then look their address up.

Host rules (``host/path``) fit the host and all its subdomains when the URL's
path starts with the rule's path; the longest wins.  Pattern rules come second,
by their number; a URL that nothing matches gets the default verdict.

Defined cases: a null URL or one without ``://`` has an empty host and path
and gets the default verdict; an empty table gives an empty result; an empty
rule list gives the default everywhere; repeated pages are judged alike.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaignlens.llm.common import col

# The host rules of the contract.
HOST_RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
# Default pattern rules: (expression over host + path, its literal tokens, verdict).
PATTERN_RULES = (
    (r"(^|[./-])casino([./-]|$)", ("casino",), "block"),
    (r"(^|[./-])porn([./-]|$)", ("porn",), "block"),
    (r"/wp-login[.]php$", ("wp", "login", "php"), "block"),
)
DEFAULT_VERDICT = "allow"
# A rule index up to this many rules is broadcast (a rule is a few hundred bytes).
BROADCAST_RULES = 10_000
_TOKEN = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Rule:
    rule: str | None  # the host rule's text; null for a pattern rule
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int  # the highest rank that matches wins


def _tokens(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(t for t in re.split(r"[\W_]+", text) if t))


def host_rule(rule: str, verdict: str) -> Rule:
    """A host rule as a pattern rule.  ``tokens`` leaves out the path's open last token."""
    host, slash, path = rule.partition("/")
    closed = path if path.endswith("/") or not path else path.rpartition("/")[0]
    pattern = r"^(?:[^/]*\.)?" + _quoted(host) + _quoted(slash + path)
    return Rule(rule, pattern, _tokens(host) + _tokens(closed), verdict, (1 << 32) + len(rule))


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/_" else "\\" + c for c in text)


def compile_rules(
    hosts: Sequence[tuple[str, str]] = HOST_RULES,
    patterns: Sequence[tuple[str, Sequence[str], str]] = PATTERN_RULES,
) -> list[Rule]:
    rules = [host_rule(r, v) for r, v in hosts]
    rules += [Rule(None, p, tuple(t), v, len(patterns) - i) for i, (p, t, v) in enumerate(patterns)]
    for r in rules:
        if not r.tokens:
            raise ValueError(f"rule without a literal token: {r.pattern}")
    return rules


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    none = F.lit("")
    return F.coalesce(F.translate(host, upper, lower), none), F.coalesce(path, none)


def judge(
    pages: DataFrame,
    url_col: str = "url",
    rules: Sequence[Rule] | None = None,
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """Every row of ``pages`` with ``host, path, rule, verdict`` added after its columns.

    Columns of ``pages`` with those names are left out of the result.
    """
    spark = pages.sparkSession
    rules = compile_rules() if rules is None else list(rules)
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    host, path = split_url(col(url_col))
    # The pages' own columns go by number, so none can clash with a column made here.
    own = [f"c{i}" for i in range(len(kept))]
    base = pages.select(*[col(c).alias(n) for c, n in zip(kept, own)], host.alias("host"), path.alias("path"))
    # Pattern rules apply to lower-cased tokens of an address; a distinct address is judged once.
    address = base.select("host", "path").where(F.concat("host", "path") != "").distinct()
    tokens = address.select(
        "host", "path", F.explode(F.array_distinct(F.split(F.concat_ws("/", "host", "path"), _TOKEN))).alias("token")
    )
    schema = T.StructType(
        [
            T.StructField("token", T.StringType()),
            T.StructField("rule_no", T.IntegerType()),
            T.StructField("rule", T.StringType()),
            T.StructField("pattern", T.StringType()),
            T.StructField("rule_verdict", T.StringType()),
            T.StructField("rank", T.LongType()),
        ]
    )
    listed = spark.createDataFrame(
        [(t, i, r.rule, r.pattern, r.verdict, r.rank) for i, r in enumerate(rules) for t in r.tokens], schema
    )
    hint = F.broadcast if len(rules) <= BROADCAST_RULES else (lambda df: df)
    wanted = listed.select("token").distinct()
    held = tokens.join(hint(wanted), "token")
    frequency = held.groupBy("token").agg(F.count(F.lit(1)).alias("held_by"))
    index = (
        listed.join(frequency, "token", "left")
        .groupBy("rule_no")
        .agg(
            F.min_by(
                F.struct("token", "rule", "pattern", "rule_verdict", "rank"),
                F.struct(F.coalesce("held_by", F.lit(0)), F.col("token")),
            ).alias("r")
        )
        .select("r.*")
    )
    matched = (
        held.join(hint(index), "token")
        .where(F.rlike(F.concat("host", "path"), F.col("pattern")))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "rule_verdict"), F.struct("rank", "rule", "pattern")).alias("best"))
    )
    m = matched.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "best")
    return base.join(m, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left").select(
        *[col(n).alias(c) for c, n in zip(kept, own)],
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )


def oracle() -> str:
    """DuckDB SQL for the judged ``pages`` with the default rules."""
    host_cases = [
        (r, v) for r, v in sorted(HOST_RULES, key=lambda x: -len(x[0]))
    ]
    fits = []
    for r, v in host_cases:
        h, _, p = r.partition("/")
        fits.append((f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')", r, v))
    rule = " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits)
    verdict = " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)
    verdict += " " + " ".join(f"WHEN regexp_matches(host || path, '{p}') THEN '{v}'" for p, _, v in PATTERN_RULES)
    return f"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
b AS (SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} ELSE '{DEFAULT_VERDICT}' END AS verdict FROM b"""
