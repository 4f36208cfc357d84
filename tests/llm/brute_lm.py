"""A plain-Python suffix-tree model of the same definition, for tests."""
import math, re, zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

def toks(text):
    return WORD.findall((text or "").translate(LOW)) + [""]

def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 1

def brute_pst(docs, depth=3, min_count=3, divergence=2.0, beta=1.0):
    """docs: (doc_id, text) -> list of (doc_id, held_out, n_tokens, n_known, N, base, score)."""
    c = defaultdict(Counter)  # context tuple -> next token counts
    for d, t in docs:
        if held(d):
            continue
        ts = toks(t)
        for i, w in enumerate(ts):
            for j in range(0, min(depth, i) + 1):
                c[tuple(ts[i - j:i])][w] += 1
    root = c[()]
    n, v = sum(root.values()), len(root)
    den = n + 0.5 * (v + 1)
    kept = {()}
    for k in range(1, depth + 1):
        for s in [s for s in c if len(s) == k]:
            p = s[1:]
            if p not in kept:
                continue
            cs, cp = sum(c[s].values()), sum(c[p].values())
            if cs < min_count:
                continue
            g = sum(x * math.log((x / cs) / (c[p][w] / cp)) for w, x in c[s].items())
            if g >= divergence:
                kept.add(s)

    def prob(w, s):
        if s == ():
            return (root.get(w, 0) + 0.5) / den
        cs, u = sum(c[s].values()), beta * len(c[s])
        return (c[s].get(w, 0) + u * prob(w, s[1:])) / (cs + u)

    out = []
    for d, t in docs:
        ts = toks(t)
        base = score = 0.0
        known = 0
        for i, w in enumerate(ts):
            base += math.log10((root.get(w, 0) + 0.5) / den)
            known += root.get(w, 0) > 0
            s = ()
            for j in range(1, min(depth, i) + 1):
                if tuple(ts[i - j:i]) in kept:
                    s = tuple(ts[i - j:i])
                else:
                    break
            score += math.log10(prob(w, s))
        out.append((d, held(d), len(ts), known, n, base, score))
    return out
