"""Plain, slow versions of the operators, for comparison on small tables."""

import collections
import hashlib
import re
import zlib

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contamination(docs, items):
    wins = collections.defaultdict(set)
    for item, text in items:
        w = ALNUM_WORD.findall(lower(text))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wins[tuple(w[i:i + n])].add(str(item))
    sizes = {len(k) for k in wins}
    out = []
    for d, text in docs:
        w = ALNUM_WORD.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i:i + n])) in wins:
                    hit.update(range(i, i + n))
                    found |= wins[k]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def near_duplicates(docs):
    """doc_id -> (set size, smallest reachable id)."""
    sets = {}
    for d, t in docs:
        w = SPACE_WORD.findall(lower(t))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    ids = sorted(sets)
    near = collections.defaultdict(set)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                near[a].add(b)
                near[b].add(a)
    out = {}
    for a in ids:
        if a not in out:
            part, todo = {a}, [a]
            while todo:
                for b in near[todo.pop()] - part:
                    part.add(b)
                    todo.append(b)
            for b in part:
                out[b] = (len(sets[b]), min(part))
    return out


def base_scores(docs):
    import math

    tokens = {d: SPACE_WORD.findall(lower(t)) + ["\n"] for d, t in docs}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    c = collections.Counter(w for d, v in tokens.items() if not held[d] for w in v)
    n, v = sum(c.values()), len(c)
    return {d: (held[d], len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) for d, t in tokens.items()}


def quality(text):
    t = text or ""
    w = SPACE_WORD.findall(t)
    lines = [x for x in t.split("\n") if SPACE_WORD.search(x)]
    at = collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    repeat = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeat)
