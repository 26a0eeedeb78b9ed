"""Plain single-process versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def spaced(t: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def alnum(t: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))


def fold(doc_id, of: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % of


def shingles(t: str | None, width: int) -> frozenset:
    w = spaced(lower(t or ""))
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))


def components(texts: dict, width: int, percent: int) -> dict:
    sets = {i: shingles(t, width) for i, t in texts.items()}
    holders, root = defaultdict(list), {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        met = Counter(j for g in sets[i] for j in holders[g])
        for j, n in met.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for g in sets[i]:
            holders[g].append(i)
    return {i: (len(sets[i]), find(i)) for i in texts}


def repeats(texts: list[bytes], length: int, keep_first: bool) -> list[list[bool]]:
    """Which bytes are covered by a string that starts anywhere else (or, to keep the first, anywhere before)."""
    places = defaultdict(list)
    for d, t in enumerate(texts):
        for k in range(len(t) - length + 1):
            places[t[k : k + length]].append((d, k))
    out = [[False] * len(t) for t in texts]
    for where in places.values():
        for d, k in where if len(where) > 1 and not keep_first else where[1:]:
            out[d][k : k + length] = [True] * length
    return out


def cut(t: bytes, gone: list[bool]) -> tuple[int, int, str]:
    spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
    return sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()


def benchmark_windows(items: list[tuple[str, str]], window: int) -> dict[tuple, list]:
    """Each window with where it stands: the item's name, its words and the place in them."""
    out = defaultdict(list)
    for name, item in items:
        b = alnum(item)
        n = min(window, len(b))
        for i in range(max(0, len(b) - n + 1) if b else 0):
            out[tuple(b[i : i + n])].append((name, b, i))
    return out


def benchmark_hits(t: str | None, windows: dict[tuple, list]) -> tuple[int, int, set, int]:
    w, hit, found, longest = alnum(t), set(), set(), 0
    for n in {len(k) for k in windows}:
        for k in range(len(w) - n + 1):
            for name, b, i in windows.get(tuple(w[k : k + n]), ()):
                found.add(name)
                hit.update(range(k, k + n))
                m = n
                while k + m < len(w) and i + m < len(b) and w[k + m] == b[i + m]:
                    m += 1
                longest = max(longest, m)
    return len(w), len(hit), found, longest


def quality_counts(t: str | None) -> tuple:
    t = t or ""
    w = spaced(t)
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    many, mark = Counter(grams), [0] * len(w)
    for k, g in enumerate(grams):
        if many[g] > 1:
            mark[k] = mark[k + 1] = mark[k + 2] = 1
    lines = [x for x in t.split("\n") if spaced(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), sum(mark)


def base_scores(texts: dict, learn) -> tuple[dict, int]:
    words = {i: [*spaced(lower(t or "")), "\0end"] for i, t in texts.items()}
    c = Counter(w for i in words if learn(i) for w in words[i])
    n, v = sum(c.values()), len(c)
    return {
        i: (len(ws), sum(c[w] > 0 for w in ws), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in words.items()
    }, n


def line_key(line: str) -> str:
    return lower(line.strip(" \t\n\x0b\x0c\r"))


def repeated_lines(rows: list[tuple], least: int, min_chars: int = 1, keep_first: bool = False) -> list[tuple]:
    """(text, n_lines, n_dropped) of each (doc_id, text) row."""
    split = [(t or "").split("\n") for _, t in rows]
    count = Counter(k for x in split for k in {line_key(y) for y in x} if len(k) >= max(1, min_chars))
    gone = {k for k, n in count.items() if n >= least}
    first: dict = {}
    for (i, _), x in zip(rows, split):
        for n, y in enumerate(x):
            place = (i is None, i if i is not None else 0, n)
            if line_key(y) in gone and place < first.get(line_key(y), (True, float("inf"), 0)):
                first[line_key(y)] = place
    out = []
    for (i, t), x in zip(rows, split):
        kept = [
            y for n, y in enumerate(x)
            if line_key(y) not in gone or (keep_first and first[line_key(y)] == (i is None, i if i is not None else 0, n))
        ]
        out.append((None if t is None else "\n".join(kept), len(x), len(x) - len(kept)))
    return out


def hard_negatives(rows: list[tuple], anchors: set, positives: int, negatives: int, low: int, high: int) -> set[tuple]:
    """(anchor, positive, rank, negative, positive score, negative score) of (id, label, whole vector) rows."""
    out = set()
    for a, label, v in rows:
        if a not in anchors:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, _, w in rows}
        near = sorted((-score[i], i) for i, other, _ in rows if other == label and i != a)[:positives]
        far = sorted((-score[i], i) for i, other, _ in rows if other != label)
        for s, p in near:
            fit = [(t, i) for t, i in far if low * -s <= 100 * -t <= high * -s][:negatives]
            out |= {(a, p, k, i, -s, -t) for k, (t, i) in enumerate(fit, 1)}
    return out


def prefix_trie(rows: list[tuple], head, base_of) -> set[tuple]:
    """All columns of each node, from (conv_id, turn, role, text) rows, rebuilding every conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    members = defaultdict(list)
    for c, t in own.items():
        path = own.get(base_of(c), [])[: head(c)] + t[head(c) :]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, len(path) == d))
    children = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(who) - 1) * (len(p[-1][1]) if p else 0)
            leaves[p[:d]] += not children[p]
    least = {p: min(c for c, _ in who) for p, who in members.items()}
    return {
        (
            least[p], len(p), least[p[:-1]] if p else None, len(who), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c, end in sorted(who) if end).encode()).hexdigest(),
        )
        for p, who in members.items()
    }
