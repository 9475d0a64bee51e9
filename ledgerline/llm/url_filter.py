"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens that every match of
it contains.  Each rule is filed under the one of its tokens that is rarest
in the URLs at hand; a URL's own tokens fetch the rules filed under them, and
only those run their expression.  Rules without a token run on every URL.

Host rules (a host and the beginning of a path) decide before the general
patterns, the longest first; a URL that no host rule fits is blocked if a
general pattern fits it, or if it has no host, else allowed.

Defined cases: null URLs and URLs without ``://`` have an empty host and path
and are blocked without a rule; rows are judged one by one, so repeated rows
get equal verdicts; an empty table gives an empty result; other columns are
not read; a very long URL is read whole.  The rules are a parameter held by the driver program, and go to
the executors whole; what is read of the corpus is one count per rule token.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.licenses import LOWER, UPPER

TOKEN = "[a-z0-9]+"
_TOKEN = re.compile(TOKEN)
#: A-Z alone: other case pairs must not join a token to its neighbours.
_FOLD = str.maketrans(UPPER, LOWER)

# The host rules of the query.
HOST_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
              ("block", "net/es/"), ("block", "net/fr/"))
# Words that stand for unwanted pages, as whole tokens of a URL.
BLOCKED_WORDS = ("casino", "gambling", "malware", "phishing", "poker", "porn", "torrent",
                 "viagra", "xxx")
# Endings of program files, and a numeric host.
BLOCKED_ENDINGS = ("apk", "exe", "msi", "scr")
NUMERIC_HOST = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}(:[0-9]+)?(/|\Z)"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host + path; ``tokens`` are in every match."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    host: bool = False


def host_rule(verdict: str, name: str) -> Rule:
    """A rule for a host, its subdomains, and paths that begin like the rule's.

    The tokens of the host stand between dots; of the path, all but a last
    one that the URL could continue.
    """
    host, slash, path = name.partition("/")
    tokens = _TOKEN.findall(host.lower())
    tail = _TOKEN.findall((slash + path).lower())
    if tail and re.search(f"{TOKEN}$", path.lower()):
        tail = tail[:-1]
    pattern = r"^(?:[^/]*\.)?" + re.escape(host.lower()) + re.escape(slash + path)
    return Rule(name, verdict, pattern, tuple(dict.fromkeys(tokens + tail)), True)


def default_rules() -> list[Rule]:
    return [
        *(host_rule(v, n) for v, n in HOST_RULES),
        *(Rule(w, "block", rf"(^|[^a-zA-Z0-9]){w}([^a-zA-Z0-9]|\Z)", (w,)) for w in BLOCKED_WORDS),
        *(Rule(f".{e}", "block", rf"\.{e}\Z", (e,)) for e in BLOCKED_ENDINGS),
        Rule("numeric host", "block", NUMERIC_HOST, ()),
    ]


def index_rules(rules: Sequence[Rule], counts: Mapping[str, int]) -> dict[str | None, list[int]]:
    """Rule numbers by the token that files them; None: rules without one."""
    index: dict[str | None, list[int]] = {}
    for i, rule in enumerate(rules):
        token = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=None)
        index.setdefault(token, []).append(i)
    return index


def _judge(rules: Sequence[Rule], index: Mapping[str | None, list[int]]):
    patterns = [re.compile(r.pattern) for r in rules]
    facts = [(r.name, r.verdict, r.host) for r in rules]

    def verdict(host: str, path: str) -> tuple[str | None, str]:
        if not host:
            return None, "block"
        url = host + path
        numbers = set(index.get(None, ()))
        for token in set(_TOKEN.findall(url.translate(_FOLD))):
            numbers.update(index.get(token, ()))
        fitting = [facts[i] for i in numbers if patterns[i].search(url)]
        hosts = [(len(name), name, what) for name, what, is_host in fitting if is_host]
        if hosts:
            _, name, what = max(hosts)
            return name, what
        return None, "block" if any(what == "block" for _, what, _ in fitting) else "allow"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [verdict(h, p) for h, p in zip(
                batch.column("u_host").to_pylist(), batch.column("u_path").to_pylist(),
                strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r for r, _ in rows], pa.string()),
                 pa.array([v for _, v in rows], pa.string())],
                names=[*batch.schema.names, "u_rule", "u_verdict"])
    return run


def split_url(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with u_host (A-Z lower-cased) and u_path, empty without ``://``."""
    part = lambda n: F.coalesce(F.regexp_extract(
        url, r"(?s)^.*?://([^/?#]*)([^?#]*)", n), F.lit(""))
    return pages.withColumns({"u_host": F.translate(part(1), UPPER, LOWER), "u_path": part(2)})


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url",
          carry: Sequence[str] = ("page_id",)) -> DataFrame:
    """``carry`` columns with u_host, u_path, u_rule (a host rule's name or
    null) and u_verdict."""
    split = split_url(pages.select(*carry, F.col(url).alias("u_url")), "u_url").drop("u_url")
    spark = pages.sparkSession
    wanted = sorted({t for r in rules for t in r.tokens})
    tokens = split.select(F.explode(F.array_distinct(F.regexp_extract_all(
        F.translate(F.concat("u_host", "u_path"), UPPER, LOWER), F.lit(f"({TOKEN})"), F.lit(1)))).alias("token"))
    rare = (tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
            .join(spark.createDataFrame([(t,) for t in wanted], "token string"), "token"))
    counts = {r["token"]: r["n"] for r in rare.collect()}  # one row per rule token at most
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in split.schema)
    return split.mapInArrow(_judge(rules, index_rules(rules, counts)),
                            f"{schema}, u_rule string, u_verdict string")


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    judged = judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), default_rules())
    return judged.select("page_id", *(F.col(f"u_{c}").alias(c) for c in (
        "host", "path", "rule", "verdict")))


OP2_SQL = rf"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1) AS raw,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), h AS (
  SELECT page_id, row_number() OVER () AS rid, path,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM u
), rules(rule, what, rhost, rpath) AS (
  VALUES {", ".join(f"('{n}', '{v}', '{n.partition('/')[0]}', '/{n.partition('/')[2]}')" for v, n in HOST_RULES)}
), fit AS (
  SELECT rid, arg_max(rule, length(rule)) AS rule, arg_max(what, length(rule)) AS what
  FROM h JOIN rules ON (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY rid
)
SELECT page_id, host, path, rule,
       CASE WHEN host = '' THEN 'block' WHEN rule IS NOT NULL THEN what
            WHEN regexp_matches(host || path,
              '(^|[^a-zA-Z0-9])({"|".join(BLOCKED_WORDS)})([^a-zA-Z0-9]|$)')
              OR regexp_matches(host || path, '\.({"|".join(BLOCKED_ENDINGS)})$')
              OR regexp_matches(host || path, '{NUMERIC_HOST.replace(chr(92) + "Z", "$")}') THEN 'block'
            ELSE 'allow' END AS verdict
FROM h LEFT JOIN fit USING (rid)
"""
