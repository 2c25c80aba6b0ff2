"""Plain versions of the operators that SQL cannot express, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def repeated_passages(rows: list[tuple[int, str | None]], length: int = 100) -> dict[int, tuple]:
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256); doc_ids are unique."""
    seen: set[bytes] = set()
    out = {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            part = raw[i : i + length]
            if part in seen:
                gone[i : i + length] = b"\1" * length
            else:
                seen.add(part)
        left = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(raw), len(raw) - len(left), spans, hashlib.sha256(left).hexdigest())
    return out


def shingles(text: str | None) -> frozenset:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in SPACE.split(lowered) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_duplicates(rows: list[tuple[int, str | None]], percent: int = 85) -> dict[int, tuple]:
    """doc_id -> (n_shingles, component_id, kept); doc_ids are unique."""
    sets = {doc_id: shingles(text) for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    holders: dict = {}
    for doc_id, own in sets.items():
        for shingle in own:
            holders.setdefault(shingle, []).append(doc_id)
    tried = set()
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                if (a, b) in tried:
                    continue
                tried.add((a, b))
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


_BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str | None) -> tuple:
    """(n_email, n_ip, n_card, n_phone, base_sha256)."""
    counts, parts = [], []
    for kind, pattern in _BASE.items():
        n = 0
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and _luhn(digits) if kind == "card" else True,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                n += 1
                parts.append(f"{kind}:{m.start()}:{m.end()}")
        counts.append(n)
    return (*counts, hashlib.sha256(",".join(parts).encode()).hexdigest())


def near_vectors(rows: list[tuple], threshold: float = 0.93) -> list[tuple]:
    """(vec_id, n_links, component_id, kept) of (vec_id, embedding, label) rows, sorted as text."""
    units = []
    for _, vector, label in rows:
        good = vector and label is not None and all(x is not None and math.isfinite(x) for x in vector) and any(vector)
        scaled = np.array(vector, float) / max(abs(x) for x in vector) if good else None
        units.append(scaled / np.linalg.norm(scaled) if good else None)
    parent = list(range(len(rows)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    classes: dict = {}
    for i, unit in enumerate(units):
        if unit is not None:
            classes.setdefault((rows[i][2], len(unit)), []).append(i)
    links = [0] * len(rows)
    for group in classes.values():
        near = np.stack([units[i] for i in group]) @ np.stack([units[i] for i in group]).T >= threshold
        for a, i in enumerate(group):
            links[i] = int(near[a].sum()) - 1
            for b in np.flatnonzero(near[a]):
                x, y = sorted((root(i), root(group[b])))
                parent[y] = x
    least: dict = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least[root(i)] = min(least.get(root(i), vec_id), vec_id)
    found = [(r[0], links[i], least.get(root(i))) for i, r in enumerate(rows)]
    return sorted([(*f, f[0] == f[2]) for f in found], key=str)


def aligned(text: str | None, slow, pieces, letters: dict[str, int]) -> tuple:
    """(n_a, n_b, n_groups, groups_sha256, links as id pairs) of one text, token by token."""
    nothing = (0, 0, 0, "", [])
    if not text:
        return nothing
    a, b, raw = slow.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text), (" " + text).encode()
    bytes_a = [bytes(letters[c] for c in slow.id_to_token(i)) for i in a]
    names = [(i, pieces.id_to_piece(i)) for i in b]
    bytes_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in names]
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return nothing
    ends_a, ends_b = ([sum(map(len, own[: k + 1])) for k in range(len(own))] for own in (bytes_a, bytes_b))
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        links.append((a[x - 1], b[y - 1]))
        i, j = x, y
    return len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def token_alignment(rows: list[tuple], slow, pieces, letters: dict[str, int]) -> list[tuple]:
    """The rows of the alignment query, of (doc_id, text) rows, sorted as text."""
    found = [(doc_id, aligned(text, slow, pieces, letters)) for doc_id, text in rows]
    counts = Counter(pair for _, f in found for pair in f[4])
    highest: dict[int, int] = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    out = []
    for doc_id, (n_a, n_b, n_groups, digest, links) in found:
        best = sum(counts[p] == highest[p[1]] for p in links)
        out.append((doc_id, n_a, n_b, n_groups, len(links), best, sum(counts[p] for p in links), digest))
    return sorted(out, key=str)


def best_products(vectors, ids, every, k):
    """{query id: [(score, id)]} of the k best others, by Python's whole numbers, no score beyond a long."""
    rows = [(int(i), [int(x) for x in v]) for i, v in zip(ids, vectors)]
    out = {}
    for own, q in rows:
        if own % every == 0:
            scores = [(min(max(sum(a * b for a, b in zip(q, v)), -(2**63)), 2**63 - 1), i) for i, v in rows if i != own]
            out[own] = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
    return out
