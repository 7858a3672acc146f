"""Plain Python versions of the contracts, for small tables."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
NORMAL = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def raw(text):
    return (text or "").encode()


def substring(rows, length=20):
    seen, out = set(), {}
    for d, t in sorted(rows):
        w = WORD.findall(raw(t))
        gone = set()
        for i in range(len(w) - length + 1):
            k = tuple(w[i:i + length])
            if k in seen:
                gone.update(range(i, i + length))
            seen.add(k)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def near(rows, percent=75):
    sets = {}
    for d, t in rows:
        w = WORD.findall(raw(t).translate(LOW))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def repeats(rows, length=200):
    count = Counter(raw(t)[i:i + length] for _, t in rows for i in range(len(raw(t)) - length + 1))
    out = {}
    for d, t in rows:
        b = raw(t)
        gone = set()
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone.update(range(i, i + length))
        kept = bytes(x for i, x in enumerate(b) if i not in gone)
        out[d] = (len(b), len(gone), sum(i - 1 not in gone for i in gone), hashlib.sha256(kept).hexdigest())
    return out


def kept_bytes(rows, length=200):
    count = Counter(raw(t)[i:i + length] for _, t in rows for i in range(len(raw(t)) - length + 1))
    out = {}
    for d, t in rows:
        b, gone = raw(t), set()
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone.update(range(i, i + length))
        out[d] = bytes(x for i, x in enumerate(b) if i not in gone)
    return out


def contaminated(rows, items, window=13):
    found = defaultdict(set)
    for i, t in items:
        w = NORMAL.findall(raw(t).translate(LOW))
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            found[tuple(w[k:k + m])].add(i)
    out = {}
    for d, t in rows:
        w = NORMAL.findall(raw(t).translate(LOW))
        hit, names = set(), set()
        for m in {len(k) for k in found}:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in found:
                    hit.update(range(i, i + m))
                    names |= found[tuple(w[i:i + m])]
        digest = hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        out[d] = (len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def rules(rows):
    out = {}
    for d, t in rows:
        t = t or ""
        w = [x.decode() for x in WORD.findall(t.encode())]
        lines = [x for x in t.split("\n") if WORD.search(x.encode())]
        count = Counter(zip(w, w[1:], w[2:]))
        rep = {i + j for i, k in enumerate(zip(w, w[1:], w[2:])) if count[k] > 1 for j in range(3)}
        out[d] = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep),
                  len(w) < 50 or 100 * len(rep) > 50 * len(w))
    return out


def warc(pages):
    first = {}
    for i, _, h in pages:
        first[raw(h)] = min(i, first.get(raw(h), i))
    return {i: (len(raw(h)), base64.b32encode(hashlib.sha1(raw(h)).digest()).decode(),
                "response" if first[raw(h)] == i else "revisit", None if first[raw(h)] == i else first[raw(h)])
            for i, _, h in pages}


def lines(rows):
    owner = {}
    key = lambda x: x.strip(b" \t\n\x0b\x0c\r").translate(LOW)
    for d, t in sorted(rows, key=lambda r: r[0]):
        for x in raw(t).split(b"\n"):
            if len(key(x).decode()) >= 10:
                owner.setdefault(key(x), d)
    out = {}
    for d, t in rows:
        own = raw(t).split(b"\n")
        kept = [x for x in own if owner.get(key(x), d) == d]
        out[d] = (len(own), len(own) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest())
    return out


def trie(turns):
    """Nodes {(conv_id, depth): ...} of (conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for c, t, r, x in turns:
        if c is not None:
            own[c].append((t is not None, t or 0, len(x or ""), r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    members = defaultdict(set)
    ends = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        s = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:])
        ends[s].append(c)
        for d in range(len(s) + 1):
            members[s[:d]].add(c)
    kids = defaultdict(set)
    for s in members:
        if s:
            kids[s[:-1]].add(s)
    out = {}
    for s, m in members.items():
        below = [x for x in members if x[:len(s)] == s]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(s, [])))).encode()).hexdigest()
        out[min(m), len(s)] = (min(members[s[:-1]]) if s else None, len(m), len(kids[s]), sum(not kids[x] for x in below), saved, digest)
    return out


TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search(rows, items, k=10):
    docs = [(d, Counter(TERM.findall(raw(t).translate(LOW)))) for d, t in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, total = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for i, text in items:
        found = []
        for d, c, n in docs:
            m = 10 + (90 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(TERM.findall(raw(text).translate(LOW))) if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:k])]
    return out
