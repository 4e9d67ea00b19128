"""Plain versions of the operators' contracts, row by row, for small tables only."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def op1(docs):
    def luhn(d):
        s = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            s += v - 9 * (v > 9)
        return s % 10 == 0

    def card(m):
        d = re.sub("[^0-9]", "", m)
        return 12 <= len(d) <= 19 and luhn(d)

    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", card),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)]
    return _spans(docs, kinds)


def op4(docs):
    kinds = [("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", None),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m) >= 24)]
    return _spans(docs, kinds)


def _spans(docs, kinds):
    out = []
    for doc_id, text in docs:
        spans = [(m.start(), i, m.end(), k) for i, (k, pattern, good) in enumerate(kinds)
                 for m in re.finditer(pattern, text or "") if (len(m[2]) >= 6 if good is None else good(m[0]))]
        out.append((doc_id, *[sum(s[3] == k for s in spans) for k, _, _ in kinds], sha(joined(spans))))
    return out


def words13(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def op2(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words13(text)
        for i in range(max(1, len(w) - 12)) if w else ():
            windows[tuple(w[i:i + 13])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w = words13(text)
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if (x := tuple(w[i:i + k])) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[x]
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def op2_clean(docs, items):
    """(doc_id, text without its marked runs of words and what stands between their words)."""
    windows = {tuple(w[i:i + 13]) for _, t in items if (w := words13(t)) for i in range(max(1, len(w) - 12))}
    out = []
    for doc_id, text in docs:
        text = text or ""
        w = [m.span() for m in re.finditer("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))]
        x = words13(text)
        spans = {(i, i + k) for k in {len(v) for v in windows} for i in range(len(x) - k + 1) if tuple(x[i:i + k]) in windows}
        gone = bytearray(len(text))
        for a, b in spans:
            gone[w[a][0]:w[b - 1][1]] = b"\1" * (w[b - 1][1] - w[a][0])
        # runs that touch leave nothing of what stands between them
        for i in range(len(w) - 1):
            if any(b == i + 1 for _, b in spans) and any(a == i + 1 for a, _ in spans):
                gone[w[i][1]:w[i + 1][0]] = b"\1" * (w[i + 1][0] - w[i][1])
        out.append((doc_id, "".join(c for c, g in zip(text, gone) if not g)))
    return out


def op3(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[(text or "").translate(LOWER)].append(doc_id)
    best = {t: max((d for d in ids if d is not None), default=None) for t, ids in groups.items()}
    out, seen = [], set()
    for doc_id, text in docs:
        t = (text or "").translate(LOWER)
        kept = doc_id == best[t] and t not in seen
        if kept:
            seen.add(t)
        out.append((doc_id, best[t], len(groups[t]), kept, sha(t)))
    return out


def fingerprint(text):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i:i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def op6_roots(docs, bits=2):
    """For each fingerprint one fingerprint of its component."""
    keys = sorted({fingerprint(t) for _, t in docs})
    at = {f: f for f in keys}

    def root(f):
        while at[f] != f:
            f = at[f]
        return f

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= bits:
                at[root(a)] = root(b)
    return {f: root(f) for f in keys}


def op6(docs, bits=2):
    root = op6_roots(docs, bits)
    fps = [(d, fingerprint(t)) for d, t in docs]
    low = defaultdict(list)
    for d, f in fps:
        low[root[f]].append(d)
    low = {r: min((d for d in ids if d is not None), default=None) for r, ids in low.items()}
    return [(d, f"{f:016x}", low[root[f]]) for d, f in fps]


def op7(docs, least=50):
    first = {}
    order = lambda d: (d is None, d or 0)
    for d, t in docs:
        raw = (t or "").encode()
        for i in range(len(raw) - least + 1):
            x = raw[i:i + least]
            if x not in first or order(d) < order(first[x]):
                first[x] = d
    out = []
    for d, t in docs:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - least + 1):
            if order(first[raw[i:i + least]]) < order(d):
                gone[i:i + least] = b"\1" * least
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(raw), len(raw) - len(kept), runs, sha(kept)))
    return out


def targets(docs, weights=(5, 2, 1), share=1.5, cap=2):
    """{source: (size, target)} by sharing the excess again and again."""
    size = defaultdict(int)
    for _, text, source in docs:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, budget = set(), share * sum(size.values())
    while True:
        open_ = [s for s in names if s not in full]
        left = budget - sum(cap * size[s] for s in full)
        target = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_} if open_ else {}
        over = {s for s in open_ if target[s] >= cap * size[s]}
        if not over:
            return {s: (size[s], float(cap * size[s]) if s in full else target[s]) for s in names}
        full |= over


def op8(docs, cap=2):
    """Source by source, documents in order of their key."""
    out, of = [], targets(docs, cap=cap)
    for source, (source_size, target) in of.items():
        rows = [(hashlib.md5((str(d) if d is not None else t or "").encode()).hexdigest(), d is not None, d or 0,
                 len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), d) for d, t, s in docs if s == source]
        start = 0
        for _, _, _, size, d in sorted(rows, key=lambda r: r[:4]):
            taken = sum(max(0, min(size, int(target) - copy * source_size - start)) for copy in range(cap))
            out.append((d, source, size, source_size, target, (start + size) / target if target else None, taken))
            start += size
    return out


def op9(turns):
    convs = defaultdict(list)
    for conv, turn, role, text in turns:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, rows in convs.items():
        rows.sort()
        loss = "".join(t for _, _, r, t in rows if r == "assistant")
        out.append((conv, len(rows), sha("".join(f"{r}\n{t}\n" for _, _, r, t in rows)), len(loss), sha(loss)))
    return out


def collocations(rows, least=10, max_words=3, top=2000, inside=50):
    """Phrases of (lang, text) rows, counted and ranked by plain loops: lang, rank, phrase, a, l, r, n, score."""
    counts: dict = {}
    for lang, text in rows:
        f = counts.setdefault("und" if lang is None else lang, {})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    key = tuple(words[i:i + k])
                    f[key] = f.get(key, 0) + 1
    out = []
    for lang, f in counts.items():
        n = sum(x for w, x in f.items() if len(w) == 1)
        found = {w: x for w, x in f.items() if len(w) > 1 and x >= least}
        scored = []
        for w, a in found.items():
            longer = [x for v, x in found.items() if len(v) > len(w)
                      and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))]
            if any(100 * x >= inside * a for x in longer):
                continue
            score, _, left, right = min((1000000 * a * a // (f[w[:k]] * f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
            scored.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def repairs(rows):
    """The contract of operator 11 for (conv_id, turn, role, text) rows: one tuple per conv_id."""
    import zlib

    step = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    blank = lambda x: not x.strip(" \t\n\x0b\x0c\r")
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        by_conv[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by_conv[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, turns in by_conv.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in turns:
            cut = not blank(text) and text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?"
            faults.append(1 if blank(text) else 2 if (role, text) in seen else 3 if cut else 0)
            seen.add((role, text))
        wanted = "uuau"
        best = {0: (0, "", []), 3: (0, "", [])}  # from the end: state -> cost, audit, lines

        def inserted(column):
            for _ in range(4):
                for q in range(4):
                    to = step[q][wanted[q]]
                    if to in column:
                        role = {"u": "user", "a": "assistant"}[wanted[q]]
                        c, a, lines = column[to]
                        column[q] = min(column.get(q, (10**9, "", [])), (c + 3, "I" + a, [role + ":"] + lines))
            return column

        best = inserted(best)
        for (_, role, text), fault in reversed(list(zip(turns, faults))):
            now = {}
            for q in range(4):
                ways = [(best[q][0] + 4, "D" + best[q][1], best[q][2])]
                if fault not in (1, 2):
                    extra = 3 if fault == 3 else 0
                    if role[:1] in step[q]:
                        c, a, lines = best[step[q][role[:1]]]
                        ways.append((c + extra, "K" + a, [f"{role}:{text}"] + lines))
                    c, a, lines = best[step[q][wanted[q]]]
                    ways.append((c + 3 + extra, "R" + a, [{"u": "user", "a": "assistant"}[wanted[q]] + f":{text}"] + lines))
                now[q] = min(ways)
            best = inserted(now)
        cost, audit, lines = best[0]
        numbers = [t for t, _, _ in turns if t is not None]
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults.count(1), faults.count(2),
                    faults.count(3), illegal, cost, audit, sha("\n".join(lines))))
    return out


def quality_base(doc_id, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i:i + 8])].append(i)
    hit = {j for starts in places.values() if len(starts) > 1 for i in starts for j in range(i, i + 8)}
    return (doc_id, len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(hit), len(words) < 20 or 100 * len(hit) > 30 * len(words))


def quality_distances(Q, rows, least_rows):
    """Squared distances by doc_id: the same starts and steps over whole arrays, with the h nearest rows picked by sorting."""
    import numpy as np

    good = []
    for doc, text, lang, source in rows:
        base = quality_base(doc, text)
        if not base[6]:
            counts = Q.plain_counts((text or "").encode())
            good.append((doc, lang, source, np.array(Q.vector(base[1], base[5], counts)) / 1024))
    own = defaultdict(list)
    for r in good:
        own[r[1], r[2]].append(r)
    groups, rest = [g for g in own.values() if len(g) >= least_rows], defaultdict(list)
    for (lang, _), g in own.items():
        if len(g) < least_rows:
            rest[lang] += g
    groups += [g for g in rest.values() if len(g) >= least_rows]
    last = [r for g in rest.values() if len(g) < least_rows for r in g]
    out = {r[0]: None for r in last}
    groups += [last] if len(last) >= least_rows else []
    floor = np.diag(np.square(Q.FLOOR))

    def far(x, mean, scatter):
        return np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(scatter), x - mean)

    def fit(x, share):
        return x.mean(0), np.cov(x.T, bias=True) * Q.consistency(share) + floor

    for g in groups:
        x = np.array([r[3] for r in g])
        h = int(0.75 * len(x))
        middle = np.sort(x, 0)[(len(x) - 1) // 2]
        mad = np.maximum(1.4826 * np.sort(abs(x - middle), 0)[(len(x) - 1) // 2], Q.FLOOR)
        best = None
        for start in ((middle, np.diag(mad ** 2) + floor), fit(x, 1)):
            for _ in range(30):
                start = fit(x[np.argsort(far(x, *start), kind="stable")[:h]], 0.75)
            det = np.linalg.det(start[1])
            if best is None or det < best[0]:
                best = det, start
        near = x[far(x, *best[1]) <= Q.chi2_quantile(0.975, Q.P)]
        out |= dict(zip((r[0] for r in g), far(x, *fit(near, 0.975)).tolist()))
    return out
