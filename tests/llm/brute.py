"""Plain restatements of the contracts, for small inputs."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def bag(text):
    w = WORD.findall(text or "")
    return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def near_classes(docs, least=0.8):
    """doc_id -> least id of its class; docs of (id, text)."""
    docs = [(i, t) for i, t in docs if i is not None]
    ids = sorted({i for i, _ in docs})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    bags = [(i, bag(t)) for i, t in docs]
    for k, (i, a) in enumerate(bags):
        for j, b in bags[:k]:
            if a and b and jaccard(a, b) >= least:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def repeated_bytes(docs, length=50):
    """Per document (id, bytes, removed, spans, digest of the rest)."""
    least = {}
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        if i is not None:
            for k in range(len(b) - length + 1):
                w = b[k : k + length]
                least[w] = min(least.get(w, i), i)
    out = []
    for i, b in raw:
        cut = [False] * len(b)
        if i is not None:
            for k in range(len(b) - length + 1):
                if least[b[k : k + length]] < i:
                    cut[k : k + length] = [True] * length
        spans = sum(c and not (k and cut[k - 1]) for k, c in enumerate(cut))
        out.append((i, len(b), sum(cut), spans, sha(bytes(x for x, c in zip(b, cut) if not c))))
    return out


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(tri)
    hit = set()
    for i, x in enumerate(tri):
        if n[x] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w))


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def contamination(docs, items, window=10):
    win, sizes = collections.defaultdict(set), set()
    for item, text in items:
        w = ALNUM.findall(lower(text or ""))
        k = min(window, len(w))
        if k:
            sizes.add(k)
            for j in range(len(w) - k + 1):
                win[tuple(w[j : j + k])].add(item)
    out = []
    for i, text in docs:
        w = ALNUM.findall(lower(text or ""))
        hit, found = set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in win:
                    found |= win[tuple(w[j : j + k])]
                    hit |= set(range(j, j + k))
        found -= {None}
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def pii(text):
    t = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return {
        "email": [m.span() for m in EMAIL.finditer(t)],
        "ip": [m.span() for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15],
    }


def targets(sizes, weights=(3, 1, 2), share=1.5):
    """source -> target by repeated filling."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out, free = share * sum(sizes.values()), {}, set(order)
    while free:
        level = (total - sum(out.values())) / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > 2 * sizes[s]]
        if not over:
            return out | {s: level * w[s] for s in free}
        for s in over:
            out[s] = 2 * sizes[s]
            free.discard(s)
    return out


def toxicity_score(folded, weights, exceptions, coef):
    """Score of a folded text under a lexicon: words within an exception phrase don't count."""
    import math

    ws = folded.split()
    shaded = [False] * len(ws)
    for e in exceptions:
        parts = e.split()
        for i in range(len(ws) - len(parts) + 1):
            if ws[i : i + len(parts)] == parts:
                shaded[i : i + len(parts)] = [True] * len(parts)
    hits = [w for w, s in zip(ws, shaded) if w in weights and not s]
    if hits:
        a, b = math.log1p(100 * sum(weights[w] for w in hits) / (len(ws) + 20)), math.log1p(200 * len(set(hits)) / (len(ws) + 50))
    else:
        a = b = 0.0
    z = coef[0] * a + coef[1] * b + coef[2] * math.log1p(len(hits)) + coef[3]
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def licence_lines(text, templates, least=0.6):
    """Families of the lines that hold enough of a template's word pairs, each by the template it holds most of."""
    pairs = lambda t: set(zip(ws, ws[1:])) if len(ws := ALNUM.findall(t.lower())) > 1 else set(ws)
    out = set()
    for line in re.split("[\n\r]", text or ""):
        have = pairs(line)
        share, family = max((len(have & pairs(t)) / len(pairs(t)), f) for f, ts in templates.items() for t in ts)
        if have and share >= least:
            out.add(family)
    return out
