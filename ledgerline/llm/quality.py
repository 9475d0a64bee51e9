"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document is measured by itself; rule failures are then added up by host
(the ``source`` a document came from), the host's failure rate is shrunk
towards the rates of all hosts by an empirical beta prior, and the host's
verdict joins back: a document stays if it passes the rules itself and its
host is not one that fails throughout.

Defined cases: null text counts as no words (and fails); a null host is a
host of its own; repeated rows are judged row by row; an empty table gives an
empty result; other columns of the input are carried or ignored, never read;
a very long text is counted whole within its row, which its windows of words
multiply some threefold in memory.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import WHITE, WORD, cut

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    """Bounds of the rules; a document fails if any is broken."""

    min_words: int = 50
    max_repeat_percent: int = 50      # words in repeated 3-word windows
    max_symbols_per_100_words: int = 10
    max_dup_lines_percent: int = 50   # of the lines that hold a word
    min_mean_word: int = 2            # code points a word
    max_mean_word: int = 15
    host_reject_rate: float = 0.5     # shrunk failure rate of a host


def _repeated_words(windows: Column, ordered: Column) -> Column:
    """Words covered by windows that occur twice or more.

    ``windows``: one hash per 3-word window, by position; ``ordered``: the
    (hash, position) pairs sorted, so equal windows are neighbours.
    """
    def twin(e: Column, i: Column) -> Column:
        return (F.get(ordered, i - 1)["h"].eqNullSafe(e["h"])
                | F.get(ordered, i + 1)["h"].eqNullSafe(e["h"]))

    starts = F.sort_array(F.transform(F.filter(ordered, twin), lambda e: e["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    step = lambda a, p: F.struct(
        (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
    return F.aggregate(starts, start, step, lambda a: a["n"])


def measure(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and
    n_repeat_words, each named with ``prefix``."""
    t = F.coalesce(F.col(text), F.lit(""))
    name = lambda c: f"{prefix}{c}"
    words, lines, windows, ordered = (name(f"_{c}") for c in
                                      ("words", "lines", "windows", "ordered"))
    w, n = F.col(words), F.size(words)
    keep = docs.columns
    out = docs.withColumns({
        words: F.regexp_extract_all(t, F.lit(WORD), F.lit(0)),
        lines: F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        name("word_chars"): F.char_length(F.translate(t, WHITE, "")).cast("long"),
        name("n_symbols"): (F.char_length(t)
                            - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long"),
    })
    out = out.withColumns({
        name("n_words"): n.cast("long"),
        name("n_lines"): F.size(lines).cast("long"),
        name("n_dup_lines"): (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        windows: F.when(n >= 3, F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))),
    })
    h = F.col(windows)
    # Only texts with some window twice pay for sorting them with positions.
    out = out.withColumn(ordered, F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    out = out.withColumn(name("n_repeat_words"), F.coalesce(
        _repeated_words(h, F.col(ordered)), F.lit(0)).cast("long"))
    measures = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                "n_repeat_words")
    return out.select(*keep, *(name(c) for c in measures))


def failures(rules: Rules, prefix: str = "") -> tuple[Column, Column]:
    """(base_failed, any rule failed) over the measures."""
    m = {c: F.col(f"{prefix}{c}") for c in (
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")}
    base = ((m["n_words"] < rules.min_words)
            | (100 * m["n_repeat_words"] > rules.max_repeat_percent * m["n_words"]))
    other = ((100 * m["n_symbols"] > rules.max_symbols_per_100_words * m["n_words"])
             | (100 * m["n_dup_lines"] > rules.max_dup_lines_percent * m["n_lines"])
             | (m["word_chars"] < rules.min_mean_word * m["n_words"])
             | (m["word_chars"] > rules.max_mean_word * m["n_words"]))
    return base, base | other


def host_verdicts(measured: DataFrame, host: str, failed: str, rules: Rules) -> DataFrame:
    """(``_host``, ``_rate``, ``_host_rejected``) per host.

    The beta prior has the mean and variance of the hosts' raw rates (method
    of moments); without spread between hosts it weighs as one document.
    """
    hosts = measured.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(failed).cast("long")).alias("_f"))
    hosts = cut(hosts, "hosts")
    rate = F.col("_f") / F.col("_n")
    mean, square = hosts.agg(F.avg(rate), F.avg(rate * rate)).first()
    alpha, beta = beta_prior(mean or 0.0, (square or 0.0) - (mean or 0.0) ** 2)
    shrunk = (F.col("_f") + F.lit(alpha)) / (F.col("_n") + F.lit(alpha + beta))
    return hosts.select("_host", shrunk.alias("_rate"),
                        (shrunk > rules.host_reject_rate).alias("_host_rejected"))


def beta_prior(mean: float, variance: float) -> tuple[float, float]:
    """Beta parameters of that mean and variance, weighing 1 to 1e6 documents."""
    spread = mean * (1 - mean)
    weight = spread / variance - 1 if variance > 1e-12 else 1.0
    weight = min(1e6, max(1.0, weight))
    return mean * weight, (1 - mean) * weight


def judge(docs: DataFrame, host: str = "source", text: str = "text",
          rules: Rules | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns with the measures, ``base_failed``, ``host_rate`` and
    ``kept``, one row per row of ``docs``; measure names get the prefix
    ``q_`` so that carried columns may have any other name."""
    rules = rules or Rules()
    narrow = docs.select(*carry, F.col(host).alias("q_host"), F.col(text).alias("q_text"))
    measured = measure(narrow, "q_text", "q_").drop("q_text")
    base, failed = failures(rules, "q_")
    measured = cut(measured.withColumns({"q_base_failed": base, "q_failed": failed}),
                   "quality")
    verdict = host_verdicts(measured, "q_host", "q_failed", rules)
    joined = measured.join(verdict, measured["q_host"].eqNullSafe(verdict["_host"]), "left")
    kept = ~F.col("q_failed") & ~F.coalesce(F.col("_host_rejected"), F.lit(False))
    return (joined.withColumns({"q_kept": kept, "q_host_rate": F.col("_rate")})
            .drop("_host", "_rate", "_host_rejected"))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document's measures and verdict."""
    from ledgerline.llm.common import documents

    judged = judge(documents(spark, sf_dir))
    return judged.select(
        "doc_id", *(F.col(f"q_{c}").alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept")))


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, source, row_number() OVER () AS rid, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         [x FOR x IN string_split(coalesce(text, ''), chr(10))
          IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
), win AS (
  SELECT rid, i, (words[i], words[i + 1], words[i + 2]) AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (
  SELECT rid, i FROM win
  QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), reach AS (
  SELECT rid, sum(least(3, coalesce(i - lag_i, 3))) AS n
  FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS lag_i FROM twice)
  GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, source, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(reach.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN reach ON w.rid = reach.rid
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 50 * n_lines
         OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS other
  FROM m
), h AS (
  SELECT source, count(*) AS n, sum((base_failed OR other)::INT) AS f
  FROM f GROUP BY source
), p AS (
  SELECT avg(f / n) AS mu, avg((f / n) * (f / n)) - avg(f / n) * avg(f / n) AS v FROM h
), k AS (
  SELECT mu, least(1e6, greatest(1.0,
           CASE WHEN v > 1e-12 THEN mu * (1 - mu) / v - 1 ELSE 1.0 END)) AS s FROM p
), hv AS (
  SELECT source, (f + mu * s) / (n + s) > 0.5 AS rejected FROM h, k
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR other) AND NOT rejected AS kept
FROM f JOIN hv ON f.source IS NOT DISTINCT FROM hv.source
"""
