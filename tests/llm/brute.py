"""The operators' definitions, stated as plainly as possible, for small data."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def shingles(text: str | None, size: int = 3) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def one_of_each(rows: list[tuple], percent: int = 80, size: int = 5) -> set[int]:
    """Positions of the rows that stay: in every component of (doc_id, text) rows
    the smallest id (null last), of equal rows any one."""
    sets = [shingles(t, size) for _, t in rows]
    group = list(range(len(rows)))

    def find(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(
                    sets[a] | sets[b]):
                group[max(find(a), find(b))] = min(find(a), find(b))
    best: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        key = (doc_id is None, doc_id or 0)
        root = find(i)
        if root not in best or key < best[root][0]:
            best[root] = (key, i)
    return {i for _, i in best.values()}


def components(rows: list[tuple], percent: int = 85) -> list[tuple]:
    """(doc_id, set size, smallest reachable id) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    label = [i for i, _ in rows]
    changed = True
    links = [(a, b) for a in range(len(rows)) for b in range(a)
             if sets[a] and sets[b] and None not in (label[a], label[b])
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return [(i, len(s), c) for (i, _), s, c in zip(rows, sets, label, strict=True)]


KINDS = ("email", "ip", "card", "phone")


def personal(text: str) -> str:
    """Base spans as kind:start:end, by start and kind."""
    out = []
    for k, pattern in enumerate((
            r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
            if (k == 0 or k == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or k == 2 and 12 <= len(digits) <= 19
                    and sum(d // 10 + d % 10 for d in double) % 10 == 0
                    or k == 3 and 9 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def remainder(doc_id, modulus: int, value: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == value


def base_scores(rows: list[tuple]) -> list[tuple]:
    """(doc_id, held out, tokens, known, training tokens, base score)."""
    counts: Counter = Counter()
    for i, t in rows:
        if not remainder(i, 7, 2):
            counts.update([*words(t), b""])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*words(t), b""]
        out.append((i, remainder(i, 7, 2), len(tokens), sum(counts[w] > 0 for w in tokens), n,
                    sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)))
    return out


def bm25(rows: list[tuple], query: str | None, k: int) -> list[tuple]:
    """(score, doc_id), best first."""
    rows = [r for r in rows if r[0] is not None]
    bags = [Counter(words(t)) for _, t in rows]
    length = [sum(b.values()) for b in bags]
    mean = sum(length) / len(rows)
    scores = np.zeros(len(rows))
    for w in set(words(query)):
        df = sum(w in b for b in bags)
        idf = math.log(1 + (len(rows) - df + 0.5) / (df + 0.5))
        scores += [idf * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * n / mean)) if w in b else 0.0
                   for b, n in zip(bags, length, strict=True)]
    best = sorted((-s, i) for s, (i, _) in zip(scores.tolist(), rows, strict=True) if s > 0)
    return [(-s, i) for s, i in best[:k]]


def pieces(rows: list[tuple], tokenizer, capacity: int = 4096) -> list[tuple]:
    """(doc_id, piece, start, length, checksum)."""
    out = []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out += [(i, p, at, len(ids[at:at + capacity]),
                 zlib.crc32(ids[at:at + capacity].tobytes()))
                for p, at in enumerate(range(0, len(ids), capacity))]
    return out


def token_files(rows: list[tuple], tokenizer, end_id: int = 2) -> list[tuple]:
    """(doc_id, n_tokens, crc32 of the ids) of (doc_id, text) rows."""
    out = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def whitening(rows: list[tuple], components: int = 16) -> tuple[dict, np.ndarray]:
    """{vec_id: [(deviation, whitened by component)]} of (vec_id, x) rows by a plain
    eigensolver, and the eigenvalues' shares."""
    fit = np.array(sorted({tuple(x) for _, x in rows}), np.int64)
    n, total = len(fit), fit.sum(axis=0)
    centred = (n * fit - total) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    out: dict = {}
    for vec_id, x in rows:
        d = n * np.array(x, np.int64) - total
        w = (d / n) @ directions[:, :components] / np.sqrt(values[:components])
        out.setdefault(vec_id, []).append((int((d * d).sum()), w))
    return out, values[:components] / values.sum()


def alignment(rows: list[tuple], path_a: str, path_b: str) -> list[tuple]:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    import sentencepiece
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path_a)
    coder.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def bytes_a(i: int) -> bytes:
        return bytes(byte[c] for c in coder.id_to_token(i))

    def bytes_b(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else \
            piece.replace("\u2581", " ").encode()

    def spans(pieces: list[bytes]) -> list[tuple[int, int]]:
        ends = np.cumsum([len(p) for p in pieces]).tolist()
        return list(zip([0, *ends], ends, strict=False))

    found = []
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        if any(b"".join(map(f, x)) != whole for f, x in ((bytes_a, a), (bytes_b, b))):
            a, b = [], []
        at_a, at_b = spans([bytes_a(i) for i in a]), spans([bytes_b(i) for i in b])
        groups, begin = [], 0
        for end in sorted({e for _, e in at_a} & {e for _, e in at_b}):
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, at, strict=True)
                                            if begin <= s and e <= end)
                                   for ids, at in ((a, at_a), (b, at_b))))
            begin = end
        links, j = [], 0
        for i, (s, e) in zip(a, at_a, strict=True):
            while j and at_b[j - 1][1] > s:
                j -= 1
            while j < len(b) and at_b[j][0] < e:
                if at_b[j][1] > s:
                    links.append((i, b[j]))
                j += 1
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        found.append((doc_id, len(a), len(b), len(groups), links, sha))
    counts = Counter(p for *_, links, _ in found for p in links)
    best: dict = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(d, n_a, n_b, g, len(links), sum(counts[p] == best[p[1]] for p in links),
             sum(counts[p] for p in links), sha) for d, n_a, n_b, g, links, sha in found]
