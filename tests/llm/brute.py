"""The operators' results the plain way, on small inputs."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def groups(rows):
    """Of (doc_id, text): a group number for each row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                parent[find(parent, a)] = find(parent, b)
    return [find(parent, x) for x in range(len(rows))], [len(s) for s in sets]


def near(rows):
    group, sizes = groups(rows)
    ids = defaultdict(list)
    for g, (i, _) in zip(group, rows, strict=True):
        if i is not None:
            ids[g].append(i)
    return [(i, n, min(ids[g]) if ids[g] else None) for g, n, (i, _) in zip(group, sizes, rows, strict=True)]


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
PATTERNS = [("assign", ASSIGN, 2, 8), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32)]


def secrets(rows):
    """Of (doc_id, text): the base numbers and digest."""
    out = []
    for i, text in rows:
        spans, counts = [], Counter()
        for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
            for m in pattern.finditer(text or ""):
                if len(m.group(group)) >= least:
                    spans.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
                    counts[kind] += 1
        base = ",".join(s for *_, s in sorted(spans))
        out.append((i, counts["assign"], counts["access"], counts["hex"], hashlib.sha256(base.encode()).hexdigest()))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def exact(rows):
    """Of (doc_id, text): (doc_id, keep_id, group_size, kept, text_sha256)."""
    content = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    best, size = {}, Counter(content)
    for place, (c, (i, t)) in enumerate(zip(content, rows, strict=True)):
        rank = (-len(t or ""), i is None, i or 0, place)
        best[c] = min(best.get(c, rank), rank)
    return [
        (i, rows[best[c][3]][0], size[c], best[c][3] == place, hashlib.sha256(c.encode()).hexdigest())
        for place, (c, (i, _)) in enumerate(zip(content, rows, strict=True))
    ]


def substrings(rows, least=13):
    """Of (doc_id, text): (doc_id, n_words, n_removed, kept_sha256)."""
    words = [WORD.findall(t or "") for _, t in rows]
    rank = [(i is None, i or 0) for i, _ in rows]
    first = {}
    for k, w in zip(rank, words, strict=True):
        for i in range(len(w) - least + 1):
            x = tuple(w[i : i + least])
            first[x] = min(first.get(x, k), k)
    out = []
    for (i, _), k, w in zip(rows, rank, words, strict=True):
        gone = {q for j in range(len(w) - least + 1) if first[tuple(w[j : j + least])] < k for q in range(j, j + least)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def targets(sizes, weights, epochs=3):
    """Round by round: clamp what is above its cap, share the rest by weight."""
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in held]
        left = total - sum(held.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        above = [s for s in free if share[s] > epochs * sizes[s]]
        if not above:
            return {**held, **share}
        held |= {s: epochs * sizes[s] for s in above}


def viterbi(lattice, text):
    """All positions at once."""
    best, came = [0] + [None] * len(text), [None] * (len(text) + 1)
    for i, c in enumerate(text):
        steps = [(n, lattice.pieces[text[i : i + n]]) for n in range(1, lattice.longest + 1) if i + n <= len(text) and text[i : i + n] in lattice.pieces]
        if c not in lattice.pieces:
            raw = c.encode()
            steps.append((1, ([lattice.byte_ids[b] for b in raw], lattice.byte_score * len(raw))))
        for n, (ids, score) in steps:
            if best[i + n] is None or best[i] + score > best[i + n]:
                best[i + n], came[i + n] = best[i] + score, (i, ids if isinstance(ids, list) else [ids])
    out, at = [], len(text)
    while at:
        out.append(came[at][1])
        at = came[at][0]
    return [x for ids in reversed(out) for x in ids]


def warc(rows):
    """Of (page_id, html): (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    best = {}
    for i, h in rows:
        best[h or ""] = max(best.get(h or "", -math.inf), -math.inf if i is None else i)
    out = []
    for i, h in rows:
        data, b = (h or "").encode(), best[h or ""]
        again = b != -math.inf and b != i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if again else "response", b if again else None))
    return out


def negatives(rows, positives=5, negatives=10):
    """Of (vec_id, vector, label) without repeated ids, labels as they count: the rows of op11."""
    own = []
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            own.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for a, q, label in own:
        if a is None or a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(q, w, strict=True)), i is None, i or 0, i, m) for i, w, m in own if i != a and len(w) == len(q)]
        scored.sort(key=lambda r: r[:3])
        for p, _, _, positive, _ in [r for r in scored if r[4] == label][:positives]:
            good = [r for r in scored if r[4] != label and -30 * p <= -100 * r[0] <= -90 * p][:negatives]
            out += [(a, positive, rank, r[3], -p, -r[0]) for rank, r in enumerate(good, 1)]
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leaks(docs, items, n=10, span=12):
    """Of (doc_id, text) and (item_id, text): (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items)."""
    asked = set()
    for item, text in items:
        own = TERM.findall((text or "").translate(LOWER))
        size = min(n, len(own))
        asked |= {(str(item) if item is not None else "", tuple(own[i : i + size])) for i in range(len(own) - size + 1) if own}
    by_window = defaultdict(set)
    for item, window in asked:
        by_window[window].add(item)
    sizes = {len(w) for w in by_window}
    out = []
    for i, text in docs:
        own = TERM.findall((text or "").translate(LOWER))
        hit, found, near = set(), set(), set()
        for size in sizes:
            for j in range(len(own) - size + 1):
                if named := by_window.get(tuple(own[j : j + size])):
                    hit |= set(range(j, j + size))
                    found |= named
        there = [set(own[j : j + span]) for j in range(len(own))]
        for window, named in by_window.items():
            if not named <= near and any(set(window) <= x for x in there):
                near |= named
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(own), len(hit), len(found), digest, bool(hit), len(near)))
    return out


def secret_spans(rows, most=(2, 4, 50)):
    """Of (doc_id, text, owner, repo): all spans, joined."""
    bare = re.compile("[A-Za-z0-9+/_-]{20,}")
    found, held = [], defaultdict(lambda: (set(), set(), set()))
    for place, (i, text, owner, repo) in enumerate(rows):
        own = []
        for rank, (kind, pattern, group, least) in enumerate([*PATTERNS, ("bare", bare, 0, 20)]):
            for m in pattern.finditer(text or ""):
                if len(m.group(group)) >= least:
                    own.append((m.start(), rank, m.end(), kind, m.group(group)))
                    for known, x in zip(held[m.group(group)], (owner, (owner, repo), place), strict=True):
                        known.add(x)
        found.append((i, own))

    def live(value):
        return re.search("[A-Za-z]", value) and re.search("[0-9]", value) and len(set(value)) >= 8 and not re.search("(?i)example|sample|dummy|placeholder|changeme|xxxx", value)

    out = []
    for i, own in found:
        spans = {(start, rank, end, kind) for start, rank, end, kind, _ in own if rank < 3}
        for _, _, end, _, value in own:
            if live(value) and all(len(x) <= limit for x, limit in zip(held[value], most, strict=True)):
                spans.add((end - len(value), 3, end, "owned"))
        out.append((i, ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))))
    return out
