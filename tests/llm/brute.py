"""The operators' results in plain Python, over rows in memory."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def components(n, links):
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            changed |= root[a] != least or root[b] != least
            root[a] = root[b] = least
        root = [root[r] for r in root]
    return root


def contamination(documents, items, window=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(lambda: defaultdict(set))
    for name, text in items:
        words = word.findall(low(text))
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[n][tuple(words[k: k + n])].add(str(name))
    out = []
    for doc, text in documents:
        words = word.findall(low(text))
        hit, found = [0] * len(words), set()
        for n, grams in windows.items():
            for k in range(len(words) - n + 1):
                if owners := grams.get(tuple(words[k: k + n])):
                    found |= owners
                    hit[k: k + n] = [1] * n
        out.append((doc, len(words), sum(hit), len(found), sha(",".join(sorted(found))), sum(hit) > 0))
    return out


def near_groups(documents, shingle, percent=80):
    """``(doc_id, set size, least id reachable, kept)``; ids must differ and ascend."""
    sets = []
    for _, text in documents:
        words = low(text).encode().split()
        n = min(shingle, len(words))
        sets.append({tuple(words[k: k + n]) for k in range(len(words) - n + 1)} if n else set())
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                links.append((i, j))
    root = components(len(sets), links)
    return [(d, len(s), documents[r][0], documents[r][0] == d) for (d, _), s, r in zip(documents, sets, root, strict=True)]


def repeats(documents, length=200):
    seen = defaultdict(list)
    raws = [(text or "").encode() for _, text in documents]
    for d, raw in enumerate(raws):
        for p in range(len(raw) - length + 1):
            seen[raw[p: p + length]].append((d, p))
    cover = [np.zeros(len(raw) + 1, int) for raw in raws]
    for places in seen.values():
        if len(places) > 1:
            for d, p in places:
                cover[d][p] += 1
                cover[d][p + length] -= 1
    out = []
    for (doc, _), raw, c in zip(documents, raws, cover, strict=True):
        gone = np.cumsum(c)[:-1] > 0
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc, len(raw), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return out


def vector_links(vectors, cosine=0.95):
    """``(vec_id, links, least id reachable, kept)``; ids must differ and ascend."""
    usable = [i for i, (_, v) in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for a in usable:
        for b in usable:
            if b < a and len(vectors[a][1]) == len(vectors[b][1]):
                x, y = (np.array(vectors[k][1], float) for k in (a, b))
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                    links.append((a, b))
    root = components(len(vectors), links)
    return [(v, sum(i in pair for pair in links), vectors[r][0], r == i) for i, ((v, _), r) in enumerate(zip(vectors, root, strict=True))]


def secrets(documents):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
    out = []
    for doc, text in documents:
        found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text or "") if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
        found.sort()
        kinds = [f[3] for f in found]
        out.append((doc, *[kinds.count(k) for k in ("assign", "access", "hex")], sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in found))))
    return out


def token_pieces(documents, tokenizer, tokens=2048):
    out = []
    for doc, text in documents:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), tokens):
            part = ids[k: k + tokens]
            out.append((doc, k // tokens, k, len(part), zlib.crc32(part.tobytes())))
    return out
