"""Plain-Python versions of what the contract's queries return."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall(t or "")


# -- personal data ---------------------------------------------------------
RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def _valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(t):
    return [(k, m.start(), m.end()) for k, r in RULES.items() for m in re.finditer(r, t or "") if _valid(k, m.group())]


# -- near duplicates -------------------------------------------------------
def shingles(t, k=5):
    w = words((t or "").translate(LOWER))
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near_components(docs):
    """{id: (n_shingles, component)} for distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


# -- repeated substrings ---------------------------------------------------
def without_repeats(texts, length=400):
    """Per text: (n_bytes, n_removed, n_spans, sha256 of what stays)."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k:k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        covered = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                covered[k:k + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, covered) if not c)
        runs = sum(1 for k in range(len(b)) if covered[k] and (k == 0 or not covered[k - 1]))
        out.append((len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return out


# -- quality rules ---------------------------------------------------------
def rule_counts(t):
    t = t or ""
    w = words(t)
    grams = Counter(zip(w, w[1:], w[2:]))
    repeat = {k + d for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeat)


# -- mixing ----------------------------------------------------------------
def mix_targets(sizes, weights=(5, 2, 1), budget=1.5, most=2):
    """{source: target}; the excess of capped sources is reshared until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, excess, open_ = dict.fromkeys(sizes, 0.0), budget * sum(sizes.values()), set(sizes)
    while excess > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += excess * weight[s] / total
        excess = 0.0
        for s in list(open_):
            if target[s] > most * sizes[s]:
                excess += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


# -- sharding --------------------------------------------------------------
def smallest_capacity(sizes, shards):
    """Minimax contiguous partition by dynamic programming."""
    ends = [0]
    for s in sizes:
        ends.append(ends[-1] + s)
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [min([best[n]] + [max(best[k], ends[n] - ends[k]) for k in range(n)]) for n in range(len(sizes) + 1)]
    return best[-1]


def library_tokens(path, texts):
    """Token counts by the tokenizers library itself."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def trie(rows):
    """Nodes of the rebuilt conversations, from (conv_id, turn, role, text)."""
    import hashlib
    import zlib
    from collections import defaultdict
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in convs.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(int(c / 100) * 100, [])[:h] + turns[h:]
    members, kids = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        below = kids[k] if k in kids else []
        leaves[k] = sum(leaves[c] for c in below) if below else 1
        saved[k] = sum(saved[c] for c in below) + ((len(members[k]) - 1) * len(k[-1][1]) if k else 0)
        ended = ",".join(str(c) for c in sorted(members[k]) if len(rebuilt[c]) == len(k))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(below), leaves[k],
                    saved[k], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def lexical_search(docs, items, top=20):
    """(item_id, rank, doc_id, score) from (id, text) rows; a null id comes last."""
    import math
    import re
    from collections import Counter
    term = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def bag(text):
        return Counter(x.translate(low) for x in term.findall(text or ""))

    bags = [(d, b) for d, b in ((d, bag(t)) for d, t in docs) if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in dict.fromkeys((i, t or "") for i, t in items):
        scores = []
        for d, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // n_terms
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    * ((1_000_000_000 * b[x]) // (1000 * b[x] + 12 * m)) for x, r in bag(text).items() if x in b)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)
