"""Plain versions of the operators, text by text, for tests."""

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER)) if w]
    if len(words) >= 5:
        return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return frozenset([tuple(words)]) if words else frozenset()


def components(ids, texts):
    """[(set size, smallest id linked)] per document."""
    sets, parent, having = [shingles(t) for t in texts], list(range(len(texts))), defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in enumerate(sets):
        shared = Counter()
        for gram in own:
            shared.update(having[gram])
            having[gram].append(i)
        for j, both in shared.items():
            if 100 * both >= 80 * (len(own) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    groups = defaultdict(list)
    for i, doc_id in enumerate(ids):
        groups[root(i)].append(doc_id)
    least = {r: min((x for x in own if x is not None), default=None) for r, own in groups.items()}
    return [(len(s), least[root(i)]) for i, s in enumerate(sets)]


def kept_bytes(rows):
    """{(id, text): (bytes, removed, spans, digest)} after removing 50-byte repeats."""
    starts = defaultdict(set)
    for doc_id, text in rows:
        raw = (text or "").encode()
        if doc_id is not None:
            for k in range(len(raw) - 49):
                starts[raw[k : k + 50]].add(doc_id)
    least = {k: min(v) for k, v in starts.items()}
    out = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for k in range(len(raw) - 49) if doc_id is not None else ():
            if least[raw[k : k + 50]] < doc_id:
                covered[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, m in zip(raw, covered) if not m)
        spans = sum(1 for k, m in enumerate(covered) if m and (k == 0 or not covered[k - 1]))
        out[doc_id, text] = (len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


SECRETS = {
    "assign": (r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
               r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}


def secrets(text):
    """(counts, digest) of the base findings."""
    found, counts = [], []
    for order, (kind, (pattern, group, least)) in enumerate(SECRETS.items()):
        own = [m for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
        counts.append(len(own))
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in own]
    return *counts, hashlib.sha256(",".join(x[2] for x in sorted(found)).encode()).hexdigest()


def damaged(rows):
    """{conv_id: [(turn, role, text)]} in order, of (conv_id, turn, role, text) rows."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * ({0: 0, 3: 2}.get(kind, 1))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {conv: sorted(own, key=key) for conv, own in out.items()}


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of messages in order.

    All edits are tried from the least cost on, the least audit first.
    """
    faults, seen = [], set()
    for _, role, text in rows:
        marks = re.sub(r"[\x20\x09-\x0D]+", "", text)
        fault = "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    best, heap = None, [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, at, initials, kept = heapq.heappop(heap)
        state = initials[-1:] if len(initials) < 2 or initials[-1] != "u" else "u"
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            best = cost, audit, kept
            break
        if (at, state) in done:
            continue
        done.add((at, state))

        def go(price, letter, to, message=None):
            new = initials + (message[0][:1] if message else "")
            if re.fullmatch("s?(ua)*u?", new):
                heapq.heappush(heap, (cost + price, audit + letter, to, new, (*kept, message) if message else kept))

        for role in ("user", "assistant"):
            go(2, "I", at, (role, ""))
        if at < len(rows):
            go(3, "D", at + 1)
            if faults[at] not in ("blank", "duplicate"):
                more = faults[at] == "truncated"
                go(more, "K", at + 1, rows[at][1:])
                for role in ("user", "assistant"):
                    go(2 + more, "R", at + 1, (role, rows[at][2]))
    cost, audit, kept = best
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def lexical_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def ranked(rows, items, k):
    """[(item id, rank, document id, score)]: every document scored for every item."""
    own = [(i, Counter(lexical_terms(t))) for i, t in rows]
    sizes = [sum(c.values()) for _, c in own]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(term for _, c in own for term in c)
    out = []
    for item, text in items:
        scores = []
        for (doc_id, counts), size in zip(own, sizes):
            m = 50 + (50 * size * n_docs) // max(n_terms, 1)
            score = 0
            for term in set(lexical_terms(text)) & counts.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * ((10**9 * counts[term]) // (1000 * counts[term] + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return out
