"""What the operators must give, worked out the plain way on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = b" \t\n\x0b\x0c\r"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    w = words(text)
    n = min(size, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def near_duplicates(docs: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, tuple[int, int]]:
    """id -> (shingles, component); rows of one id are one document."""
    sets = [(i, shingles(t, size)) for i, t in docs if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: (len(s), root(i)) for i, s in sets}


def contained(docs, items, size: int = 5, percent: int = 80) -> set[tuple]:
    out = set()
    for item, text in items:
        w = words(text)
        need = shingles(text, size)
        n = min(size, len(w))
        for doc, body in docs:
            v = words(body)
            have = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            if need and 100 * len(need & have) >= percent * len(need):
                out.add((doc, item, len(need), len(need & have)))
    return out


def without_repeats(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        rest = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(rest).hexdigest()))
    return out


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, limit=2.0) -> dict:
    """Sources and their targets: what is above a limit is shared again until nothing is."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[n] for n in open_)
        over = {n for n in open_ if left * weight[n] / total >= limit * sizes[n]}
        if not over:
            return out | {n: left * weight[n] / total for n in open_}
        for n in over:
            out[n] = limit * sizes[n]
        left -= sum(out[n] for n in over)
        open_ -= over
    return out


def top(vectors: list[tuple[int, list[int]]], k: int, every: int) -> set[tuple]:
    out = set()
    for i, v in vectors:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in vectors if j != i)[:k]
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(best, 1)}
    return out


def url_parts(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_for(host: str, path: str, rules) -> tuple[str | None, str | None]:
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def templates(shapes: dict[tuple[str, str], tuple[int, int, int]], depth=4, min_share=0.02, min_rows=20, z=1.96) -> dict:
    """The template of each (host, shape), level by level as the operator says."""
    out = {key: "" for key in shapes}
    for level in range(depth):
        counts, alls = defaultdict(lambda: [0, 0, 0]), defaultdict(lambda: [0, 0, 0])
        for (host, shape), numbers in shapes.items():
            parts = shape.split("/")
            if level < len(parts):
                for table, key in ((counts, (host, out[host, shape], parts[level])), (alls, (host, out[host, shape]))):
                    for i in range(3):
                        table[key][i] += numbers[i]
        new = dict(out)
        for host, shape in shapes:
            parts = shape.split("/")
            if level < len(parts):
                n, l, b = counts[host, out[host, shape], parts[level]]
                an, al, ab = alls[host, out[host, shape]]
                rest = al - l
                pooled = (ab + 1) / (al + 2)
                gap = abs((b + 1) / (l + 2) - (ab - b + 1) / (rest + 2))
                error = (pooled * (1 - pooled) * (1 / (l + 2) + 1 / (rest + 2))) ** 0.5
                stays = n == an or (n >= min_rows and n >= min_share * an and gap > z * error)
                new[host, shape] = out[host, shape] + ("/" if level else "") + (parts[level] if stays else "*")
        out = new
    return {(h, s): t + ("/**" if len(s.split("/")) > depth else "") for (h, s), t in out.items()}
