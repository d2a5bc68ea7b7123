"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def fold(doc_id, by):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % by


def base_scores(rows):
    """(held_out, n_tokens, n_known, N, base score) of each (doc_id, text)."""
    seen, ends = Counter(), 0
    for i, t in rows:
        if fold(i, 5) != 1:
            seen.update(words(t, True))
            ends += 1
    n, v = sum(seen.values()) + ends, len(seen) + (ends > 0)
    below = math.log10(n + 0.5 * (v + 1))
    out = []
    for i, t in rows:
        w = words(t, True)
        out.append((fold(i, 5) == 1, len(w) + 1, sum(seen[x] > 0 for x in w) + (ends > 0), n,
                    sum(math.log10(seen[x] + 0.5) - below for x in w)
                    + math.log10(ends + 0.5) - below))
    return out


def lattice_scores(rows, ranks, rounds, smoothing):
    """log10 marginal probability of each (doc_id, text), one dict step at a time."""
    seen, ends = Counter(), 0
    for i, t in rows:
        if fold(i, 5) != 1:
            seen.update(words(t, True))
            ends += 1
    top, longest = max(ranks.values()), max(map(len, ranks))
    start = {p: 1 / (1 + top - r) for p, r in ranks.items()}
    scale = max(sum(seen.values()), 1) / sum(start.values())

    def fitted(counts):
        end = ends + smoothing
        every = {**{p: counts.get(p, 0) + smoothing for p in ranks},
                 **{b: counts.get(b, 0) + smoothing for b in range(256)}}
        total = sum(every.values()) + end
        return {k: math.log(v / total) for k, v in every.items()}, math.log(end / total)

    def arcs(w):
        for a in range(len(w)):
            if w[a] not in ranks:
                yield a, a + 1, list(w[a].encode())
            for b in range(a + 1, min(len(w), a + longest) + 1):
                if w[a:b] in ranks:
                    yield a, b, [w[a:b]]

    def add(table, at, x):
        old = table[at]
        m = max(old, x)
        table[at] = x if old == -math.inf else m + math.log(math.exp(old - m) + math.exp(x - m))

    def forward(w, logp):
        alpha = [0.0] + [-math.inf] * len(w)
        for a, b, used in arcs(w):
            add(alpha, b, alpha[a] + sum(logp[u] for u in used))
        return alpha

    logp, end = fitted({p: x * scale for p, x in start.items()})
    for _ in range(rounds if seen else 0):
        counts = defaultdict(float)
        for word, n in seen.items():
            w = "\u2581" + word
            alpha, beta = forward(w, logp), [-math.inf] * len(w) + [0.0]
            for a, b, used in sorted(arcs(w), key=lambda x: -x[0]):
                add(beta, a, beta[b] + sum(logp[u] for u in used))
            for a, b, used in arcs(w):
                share = n * math.exp(alpha[a] + sum(logp[u] for u in used) + beta[b] - alpha[-1])
                for u in used:
                    counts[u] += share
        logp, end = fitted(counts)
    known = {w: forward("\u2581" + w, logp)[-1] for _, t in rows for w in set(words(t, True))}
    return [(sum(known[w] for w in words(t, True)) + end) / math.log(10) for _, t in rows]


def shingle_sets(texts, size=5):
    out = []
    for t in texts:
        w = words(t, True)
        out.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or
                   ({tuple(w)} if w else set()))
    return out


def components(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    members = defaultdict(list)
    for i in range(n):
        members[root(i)].append(i)
    return [members[root(i)] for i in range(n)]


def near(rows, num=75, den=100):
    """(set size, component id) of each (doc_id, text)."""
    sets = shingle_sets([t for _, t in rows])
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    named = components(len(rows), links)
    return [(len(s), min((rows[j][0] for j in m if rows[j][0] is not None), default=None))
            for s, m in zip(sets, named)]


def without_repeats(texts, window=35):
    """(words, removed, kept words) of each text."""
    cut = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in cut for i in range(len(w) - window + 1))
    out = []
    for w in cut:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


KEYS = "|".join("".join(f"[{c.upper()}{c}]" for c in k)
                for k in ("password", "passwd", "secret", "token"))
SECRETS = [
    ("assign", re.compile(rf"""({KEYS}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
                          r"([A-Za-z0-9+/_.=-]+)"), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def base_spans(text):
    found = [(m.start(), k, m.end(), name) for k, (name, p, g, least) in enumerate(SECRETS)
             for m in p.finditer(text or "") if len(m.group(g)) >= least]
    return sorted(found)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def best_fit_decreasing(lengths, capacity):
    """Number of bins of document-by-document best fit decreasing."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= n
        else:
            room.append(capacity - n)
    return len(room)


def marginal(word, scores):
    """Summed weight of all segmentations of ``word`` by recursion."""
    if not word:
        return 1.0
    return sum(math.exp(scores[word[:k]]) * marginal(word[k:], scores)
               for k in range(1, len(word) + 1) if word[:k] in scores)


def best(word, scores):
    if not word:
        return 0.0
    return max((scores[word[:k]] + best(word[k:], scores)
                for k in range(1, len(word) + 1) if word[:k] in scores), default=-math.inf)


def fill_in_middle(doc_id, text, fim=100, spm=50, seed=7):
    """(n, form, prefix characters, middle characters, output)."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def alignments(texts, byte_ids, byte_of, piece_ids, piece_of):
    """(A tokens, B tokens, groups, links, best links, summed counts, groups text) of each
    text, and the links of every (B, A) pair; tokens by the tokenizers on whole texts."""
    rows, total = [], Counter()
    for t in texts:
        a, b = (byte_ids(" " + t), piece_ids(t)) if t else ([], [])
        x, y = [byte_of(i) for i in a], [piece_of(i) for i in b]
        if not t or b"".join(x) != (" " + t).encode() or b"".join(y) != (" " + t).encode():
            rows.append(None)
            continue
        links, groups, i, j, at, to = Counter(), [], 0, 0, 0, 0
        left, right = [], []
        while i < len(a):
            links[b[j], a[i]] += 1
            end_a, end_b = at + len(x[i]), to + len(y[j])
            if end_a <= end_b:
                left.append(str(a[i]))
            if end_b <= end_a:
                right.append(str(b[j]))
            if end_a == end_b:
                groups.append(f"{','.join(left)}|{','.join(right)}")
                left, right = [], []
            if end_a <= end_b:
                i, at = i + 1, end_a
            if end_b <= end_a:
                j, to = j + 1, end_b
        total += links
        rows.append((len(a), len(b), groups, links))
    top = Counter()
    for (b, _), n in total.items():
        top[b] = max(top[b], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = r
        out.append((n_a, n_b, len(groups), sum(links.values()),
                    sum(m for p, m in links.items() if total[p] == top[p[0]]),
                    sum(m * total[p] for p, m in links.items()), ";".join(groups)))
    return out, total


def nearest(rows, k=5, every=50):
    """Of (id, vector) rows, (query id, rank, id, cosine) of every query, exactly."""
    def fine(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(x, y):
        m, n = max(map(abs, x)), max(map(abs, y))
        x, y = [a / m for a in x], [a / n for a in y]
        return (math.fsum(a * b for a, b in zip(x, y))
                / math.sqrt(math.fsum(a * a for a in x) * math.fsum(b * b for b in y)))

    out = []
    for n, (i, v) in enumerate(rows):
        if i is None or i % every or not fine(v):
            continue
        near = sorted((-round(cosine(v, w), 12), j is None, j or 0) for m, (j, w) in enumerate(rows)
                      if m != n and fine(w) and len(w) == len(v))
        out += [(i, r + 1, None if none else j, -c) for r, (c, none, j) in enumerate(near[:k])]
    return out
