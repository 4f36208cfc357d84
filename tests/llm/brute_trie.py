"""A plain-Python prefix trie of the same definition, for tests."""
import hashlib, zlib, re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")

def brute_trie(rows):
    """rows: (conv_id, turn, role, text) tuples -> {(conv_id, depth): row dict} by brute force."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is None:
            continue
        convs[c].append((turn is not None, turn if turn is not None else 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = own.get(c - (c % 20 if c >= 0 else -((-c) % 20)), [])
        rebuilt[c] = head[:h] + ts[h:]
    nodes = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            key = tuple(ts[:d])
            n = nodes.setdefault(key, {"members": [], "ends": []})
            n["members"].append(c)
            if d == len(ts):
                n["ends"].append(c)
    children = defaultdict(int)
    for key in nodes:
        if key:
            children[key[:-1]] += 1
    out = {}
    for key, n in nodes.items():
        sub = [k for k in nodes if k[:len(key)] == key]
        leaves = sum(1 for k in sub if children[k] == 0)
        saved = sum((len(nodes[k]["members"]) - 1) * (len(WORD.findall(k[-1][1])) if k else 0) for k in sub)
        cid = min(n["members"])
        out[(cid, len(key))] = dict(
            conv_id=cid, depth=len(key), parent_conv_id=min(nodes[key[:-1]]["members"]) if key else None,
            n_convs=len(n["members"]), n_children=children[key], n_leaves=leaves, saved_tokens=saved,
            ends_sha256=hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest())
    return out
