"""Personal data: exact base patterns, and more spans by weak supervision.

Base spans (e-mail, ip, card, phone) follow fixed patterns and always stay.
Looser candidates (spelled-out addresses, national phone numbers, IPv6,
other card separators) are judged by labelers that vote or abstain: a checksum
or range check, a gazetteer, and words in the context for and against.
Expectation-maximisation over the votes of all candidates of the corpus
estimates each labeler's reliability per kind (a Dawid-Skene model); the base
spans are its anchors, known to be true.  Its posteriors then train a logistic
span classifier over votes and shape, and candidates that it accepts, and that
at least one labeler votes for, become spans.

Votes and shapes are categories, so what the models need of the corpus is
one count per combination: at most ``2 * kinds * 3 ** labelers * shapes`` rows,
however many documents there are.

Offsets are code points, ends exclusive.  Defined cases: null text is empty;
rows are judged row by row, so repeated rows get equal spans; without
candidates, or in an empty table, no span is added; other columns are not
read; every pattern, and the search for spans apart from others, runs in time
linear in the text, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline.llm.common import cut, documents

KINDS = ("email", "ip", "card", "phone")

# --- base spans -------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Runs of digits are matched whole, from their first digit: a match that
# starts within a run exists only if the one from its start does.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn checksum."""
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
               for p in text.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match holds exactly one ``@``: its start is as far left as the local
    characters before the ``@`` reach, but not into the match before."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end), sorted."""
    spans = [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m[0])]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGITS.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        spans += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                  if 9 <= len(_NOT_DIGITS.sub("", m[0])) <= 15]
    return sorted(spans)


# --- candidates and labelers ------------------------------------------------------

_LOOSE = (
    (0, re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64} ?[\[(] ?at ?[\])] ?[\w-]{1,63}"
                   r"(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z][\w-]{0,62}){1,5}", re.I | re.A)),
    (1, re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")),
    (2, re.compile(r"(?<![\w.-])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![\w.-])")),
    (3, re.compile(r"(?<![\w+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
                   r"(?![\w.-])")),
)
# Words that speak for a kind just before a span, and against.
CONTEXT = (
    ("adresse", "at", "contact", "contacto", "correo", "courriel", "email", "e-mail", "from",
     "inbox", "kontakt", "mail", "mailto", "message", "reach", "reply", "send", "to", "write"),
    ("address", "adresse", "client", "direccion", "dns", "from", "gateway", "host", "hostname",
     "ip", "ipv", "login", "peer", "port", "proxy", "remote", "router", "server", "serveur",
     "servidor", "subnet"),
    ("amex", "bank", "billing", "card", "carta", "carte", "charge", "charged", "credit", "debit",
     "discover", "karte", "kreditkarte", "mastercard", "paid", "pay", "payment", "tarjeta",
     "visa"),
    ("anruf", "appelez", "call", "called", "cell", "contact", "dial", "fax", "handy", "hotline",
     "llama", "mobile", "movil", "phone", "portable", "reach", "ring", "sms", "tel", "telefon",
     "telefono", "telephone", "text", "whatsapp"),
)
AGAINST = ("article", "batch", "build", "case", "catalog", "chapter", "doi", "figure", "id",
           "invoice", "isbn", "issn", "item", "lot", "model", "no", "order", "page", "part",
           "patent", "ref", "reference", "release", "rev", "revision", "rfc", "section",
           "serial", "sku", "table", "ticket", "tracking", "version", "volume")
# Generic top-level domains; every two letters are a country's.
DOMAINS = frozenset(
    "academy agency app art asia bank biz blog care cat center cloud club codes com community "
    "company coop design dev digital edu email events expert fund gov group health help host "
    "info int jobs law life live ltd media mil mobi museum name net network news one online org "
    "page pro school science services shop site social software solutions space store studio "
    "systems team tech tel today tools top travel university video website wiki work world xyz "
    "zone".split())
# First and last prefix of the ranges that card issuers use.
ISSUERS = (("2221", "2720"), ("300", "305"), ("34", "34"), ("3528", "3589"), ("36", "39"),
           ("37", "37"), ("4", "4"), ("50", "59"), ("60", "65"), ("67", "67"))
_WORD_BEFORE = re.compile(r"[A-Za-z-]+")
NEAR = 40  # code points before a span that count as its context

#: Labelers in the order of their votes.
LABELERS = ("check", "gazetteer", "context", "against")


def _issued(digits: str) -> bool:
    return any(lo <= digits[:len(lo)] <= hi for lo, hi in ISSUERS)


def _votes(kind: int, text: str, start: int, end: int) -> tuple[int, ...]:
    span = text[start:end]
    digits = _NOT_DIGITS.sub("", span)
    before = {w.lower() for w in _WORD_BEFORE.findall(text, max(0, start - NEAR), start)}
    if kind == 0:
        check = 0
        top = re.split(r"[^A-Za-z]+", span.rstrip(")]"))[-1].lower()
        gazetteer = 1 if len(top) == 2 or top in DOMAINS else 0
    elif kind == 1:
        # Eight groups of at most four hexadecimal digits are in range as they stand.
        check = 1 if ":" in span or _octets(span) else -1
        gazetteer = (-1 if span.startswith(("0.", "127.", "255.", "0:0:0:0:0:0:0:")) else
                     1 if re.match(r"(?:2[0-9a-fA-F]{3}|f[cdCD][0-9a-fA-F]{2}|fe80):", span) else 0)
    elif kind == 2:
        check = 1 if luhn(digits) else -1
        gazetteer = 1 if _issued(digits) else -1
    else:
        bare = digits[-10:]
        check = -1 if len(set(bare)) <= 2 else 0
        # An area code and an exchange begin with 2 to 9; N11 is a service.
        gazetteer = 1 if re.match(r"[2-9](?!11)[0-8][0-9][2-9](?!11)[0-9]{2}", bare) else -1
    context = before & set(CONTEXT[kind])
    against = before & set(AGAINST) - ({"no"} if context else set())   # "phone no."
    return (check, gazetteer, 1 if context else 0, -1 if against else 0)


def _key(kind: int, text: str, start: int, end: int, base: bool) -> str:
    """Kind, votes, shape (digits in four classes, separators), whether a base span."""
    digits = sum(c.isdigit() for c in text[start:end])
    shape = (min(digits // 5, 3), int(" " in text[start:end]), int("(" in text[start:end]))
    return "|".join((KINDS[kind], ",".join(map(str, _votes(kind, text, start, end))),
                     ",".join(map(str, shape)), "base" if base else "loose"))


def _free(found: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of ``found`` that overlap none of ``taken``; both rising and disjoint."""
    out, i = [], 0
    for s, e in found:
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if i == len(taken) or taken[i][0] >= e:
            out.append((s, e))
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, key) of loose matches apart from base spans and from
    each other."""
    if "(" not in text and "[" not in text and not _DIGIT.search(text):
        return []
    taken: list[tuple[int, int]] = []
    for s, _, e in base:      # base spans of different kinds may overlap: their union
        if taken and s < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
        else:
            taken.append((s, e))
    out = []
    for kind, pattern in _LOOSE:
        fresh = _free([m.span() for m in pattern.finditer(text)], taken)
        out += [(s, kind, e, _key(kind, text, s, e, False)) for s, e in fresh]
        taken = sorted(taken + fresh)      # two rising runs: a merge
    return sorted(out)


SPANS = "array<struct<kind string, start int, end int, key string, added boolean>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                             ("key", pa.string()), ("added", pa.bool_())]))


def _find(text: str | None) -> list[dict]:
    if not text:
        return []
    base = base_spans(text)
    rows = [(s, k, e, _key(k, text, s, e, True), False) for s, k, e in base]
    rows += [(*c, True) for c in candidates(text, base)]
    return [{"kind": KINDS[k], "start": s, "end": e, "key": key, "added": added}
            for s, k, e, key, added in sorted(rows)]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = pa.array([_find(t.as_py()) for t in batch.column("p_text")], _SPANS)
        columns = [(n, batch.column(n)) for n in batch.schema.names if n != "p_text"]
        yield pa.RecordBatch.from_arrays([*(c for _, c in columns), spans],
                                         names=[*(n for n, _ in columns), "p_found"])


# --- the label model and the span classifier --------------------------------------


def label_model(votes: np.ndarray, counts: np.ndarray, anchors: np.ndarray | None = None,
                rounds: int = 50) -> np.ndarray:
    """Posterior that each vote pattern is of true spans, by EM.

    ``votes``: patterns by labelers, -1, 0 or 1; ``counts``: how often each
    pattern occurs; ``anchors``: patterns of base spans, which are true and stay
    so: from them the model learns how often a labeler errs or objects.
    Starts from the share of votes for; no vote at all starts as untrue.
    """
    anchors = np.zeros(len(votes), bool) if anchors is None else anchors
    q = np.where(anchors, 1.0, np.clip(0.35 + 0.3 * votes.sum(axis=1), 0.05, 0.95))
    onehot = votes[:, :, None] == np.array([-1, 0, 1])
    for _ in range(rounds):
        log = np.zeros((len(q), 2))
        for z, weight in enumerate((counts * (1 - q), counts * q)):
            seen = 1.0 + (onehot * weight[:, None, None]).sum(axis=0)
            p = np.log(seen / seen.sum(axis=1, keepdims=True))
            # The share of true spans among those that are not known to be.
            log[:, z] = (np.log(1.0 + weight[~anchors].sum()) + (onehot * p).sum(axis=(1, 2)))
        q = np.where(anchors, 1.0,
                     1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50))))
    return q


def span_classifier(features: np.ndarray, target: np.ndarray, counts: np.ndarray,
                    rounds: int = 300, rate: float = 0.5, decay: float = 1e-3) -> np.ndarray:
    """Probabilities of a logistic model fitted to soft targets."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w, share = np.zeros(x.shape[1]), counts / counts.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        w -= rate * (x.T @ (share * (p - target)) + decay * w)
    return 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))


def accepted_keys(counts: dict[str, int], threshold: float = 0.5) -> list[str]:
    """Keys of candidates that the classifier takes for personal data."""
    accepted = []
    for kind in KINDS:
        keys = sorted(k for k in counts if k.startswith(f"{kind}|"))
        if not keys:
            continue
        parts = [k.split("|") for k in keys]
        votes = np.array([[int(v) for v in p[1].split(",")] for p in parts])
        n = np.array([counts[k] for k in keys], float)
        anchors = np.array([p[3] == "base" for p in parts])
        posterior = label_model(votes, n, anchors)
        shapes = np.array([[int(v) for v in p[2].split(",")] for p in parts], float)
        onehot = (votes[:, :, None] == np.array([-1, 0, 1])).reshape(len(keys), -1)
        p = span_classifier(np.hstack([onehot, shapes]), posterior, n)
        # Two rules besides: a span that no labeler speaks for is none, and what
        # fails its checksum or range is not of the kind, as for base spans.  All
        # other objections weigh as much as the classifier gives them.
        accepted += [k for k, v, q in zip(keys, votes, p, strict=True)
                     if q >= threshold and v.max() > 0 and v[LABELERS.index("check")] >= 0]
    return accepted


def find_spans(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",),
               threshold: float = 0.5) -> DataFrame:
    """``carry`` columns with ``p_spans``: kind, start, end, key, and whether
    the method added the span; by start, then kind as listed."""
    given = docs.select(*carry, F.col(text).alias("p_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                       for f in given.schema if f.name != "p_text")
    found = cut(given.mapInArrow(_search, f"{schema}, p_found {SPANS}"), "spans")
    keys = found.select(F.explode("p_found").alias("s")).groupBy(F.col("s.key").alias("key"))
    counts = {r["key"]: r["n"] for r in keys.agg(F.count(F.lit(1)).alias("n")).collect()}
    accepted = F.array(*map(F.lit, accepted_keys(counts, threshold))).cast("array<string>")
    return found.withColumn("p_spans", F.filter(
        "p_found", lambda s: ~s["added"] | F.array_contains(accepted, s["key"]))).drop("p_found")


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_pii(spark, sf_dir: str) -> DataFrame:
    """Every document's personal data."""
    found = find_spans(documents(spark, sf_dir)).withColumn(
        "p_base", F.filter("p_spans", lambda s: ~s["added"]))
    n = lambda kind: F.size(F.filter(
        "p_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(n, KINDS),
                        F.sha2(_joined("p_base"), 256).alias("base_sha256"),
                        _joined("p_spans").alias("spans"))


@F.pandas_udf(StringType())
def _mask(text: pd.Series, spans: pd.Series) -> pd.Series:
    def one(t, found):
        out, at = [], 0
        for s in found:  # by start: a span that overlaps the last one extends it
            if s["start"] >= at:
                out += [t[at:s["start"]], f"<{s['kind'].upper()}>"]
            at = max(at, s["end"])
        return "".join([*out, t[at:]])
    return pd.Series([one(t, f) for t, f in zip(text, spans, strict=True)])


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind's name in angle brackets;
    a text without spans is untouched."""
    return F.coalesce(F.when(F.size(spans) > 0, _mask(text, spans)), text)
