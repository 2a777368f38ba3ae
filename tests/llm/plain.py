"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from math import log10

import xxhash

SF = "/root/testdata/sf0.001"


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def repeats(rows, length=100):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha)}"""
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for s in range(len(t) - length + 1):
            w = t[s : s + length]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = {}
    for i, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if first[t[s : s + length]] < (i, s):
                gone[s : s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out[i, t] = (len(t), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), sha(kept))
    return out


def fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def shingles(text, n=5):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def components(fps):
    """{doc_id: smallest doc_id reachable} from {doc_id: fingerprint}."""
    parent = {i: i for i in fps}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(fps)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    out = [(m.start(), n, k, m.end()) for n, (k, (p, ok)) in enumerate(kinds.items()) for m in re.finditer(p, text or "") if ok(m[0])]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def base_scores(rows):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}"""
    tokens = {i: [*re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(ws), sum(c[w] > 0 for w in ws), n, sum(log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in tokens.items()}


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(docs, items, width=10):
    """{doc_id: (n_words, n_hit, sorted item ids)}"""
    windows = {}
    for i, t in items:
        ws = words(t)
        for s in range(max(1, len(ws) - width + 1)) if ws else ():
            windows.setdefault(tuple(ws[s : s + width]), set()).add(str(i))
    sizes = {len(w) for w in windows}
    out = {}
    for i, t in docs:
        ws, hit, found = words(t), set(), set()
        for n in sizes:
            for s in range(len(ws) - n + 1):
                if (w := tuple(ws[s : s + n])) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[w]
        out[i] = (len(ws), len(hit), sorted(found))
    return out
