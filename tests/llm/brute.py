"""Plain restatements of the contracts over lists of rows, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def simhash(text, k=3):
    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    parts = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def connected(n, linked):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            if find(i) != find(j) and linked(i, j):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(n)]


def simhash_rows(rows):
    fp = [simhash(t) for _, t in rows]
    group = connected(len(rows), lambda i, j: bin(fp[i] ^ fp[j]).count("1") <= 2)
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return Counter((i, f"{f:016x}", least.get(g)) for (i, _), f, g in zip(rows, fp, group))


def quality(text, window=8):
    w = words(text)
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    places = defaultdict(list)
    for i in range(len(w) - window + 1):
        places[tuple(w[i:i + window])].append(i)
    hit = {k for p in places.values() if len(p) > 1 for i in p for k in range(i, i + window)}
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(hit), failed)


def contamination(rows, items, size=13):
    windows = defaultdict(set)
    for name, text in items:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if w and name is not None else 0):
            windows[tuple(w[i:i + k])].add(str(name))
    sizes = {len(k) for k in windows}
    out = []
    for i, text in rows:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for k in sizes:
            for at in range(len(w) - k + 1):
                if (t := tuple(w[at:at + k])) in windows:
                    hit |= set(range(at, at + k))
                    found |= windows[t]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(out)


def longest(rows, items, size=13):
    """(id, words, item, word, item word) of the longest match of a window or more, by
    the word-by-word table of common runs."""
    items = [(str(n), ITEM_WORD.findall((t or "").translate(LOWER))) for n, t in items if n is not None]
    out = []
    for i, text in rows:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        best = None
        for name, v in items:
            if not v or not set(v) & set(w):
                continue
            before = {}
            for a in range(len(w)):
                now = {}
                for b in range(len(v)):
                    if w[a] == v[b]:
                        now[b] = n = before.get(b - 1, 0) + 1
                        if n >= min(size, len(v)):
                            key = (-n, name, a - n + 1, b - n + 1)
                            best = min(best, key) if best else key
                before = now
        out.append((i, -best[0], *best[1:]) if best else (i, 0, None, None, None))
    return Counter(out)


def substrings(rows, order, size=20):
    """``order``: position of each row; rows of equal position are one document."""
    first = {}
    for at in sorted(range(len(rows)), key=order.__getitem__):
        w = words(rows[at][1])
        for s in range(len(w) - size + 1):
            first.setdefault(tuple(w[s:s + size]), (order[at], s))
    out = []
    for at, (i, text) in enumerate(rows):
        w = words(text)
        gone = {k for s in range(len(w) - size + 1) if first[tuple(w[s:s + size])] < (order[at], s)
                for k in range(s, s + size)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), kept))
    return Counter(out)


def framed(text, order):
    w = (text or "").translate(LOWER).encode().split()
    return b"\n" * (order - 1) + b" ".join(w) + b"\n"


def ppm(rows, order):
    """rows (id, text) -> (id, held_out, n_tokens, n_known, train_tokens, base, score) of each."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    count, nodes = Counter(), [defaultdict(Counter) for _ in range(order)]
    for (_, t), h in zip(rows, held):
        if not h:
            count.update([*words((t or "").translate(LOWER)), ""])
            b = framed(t, order)
            for at in range(order - 1, len(b)):
                nodes[-1][b[at - order + 1:at]][b[at]] += 1
    for k in reversed(range(order - 1)):
        for context, seen in nodes[k + 1].items():
            for x in seen:
                nodes[k][context[1:]][x] += 1
    total, distinct = sum(count.values()), len(count)

    def code(b, at):
        out, p = set(), 0.0
        for k in reversed(range(order)):
            seen = nodes[k].get(b[at - k:at], {})
            live = {x: n for x, n in seen.items() if x not in out}
            if live:
                n = 2 * sum(live.values())
                if b[at] in live:
                    return p + math.log10((2 * live[b[at]] - 1) / n)
                p += math.log10(len(live) / n)
                out = set(seen)
        return p - math.log10(256 - len(out))

    result = []
    for (i, t), h in zip(rows, held):
        w = [*words((t or "").translate(LOWER)), ""]
        base = sum(math.log10((count[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        b = framed(t, order)
        score = sum(code(b, at) for at in range(order - 1, len(b)))
        result.append((i, h, len(w), sum(count[x] > 0 for x in w), total, base, score))
    return result


def kneser_ney(rows, order):
    """rows (group, text) -> perplexity per character of each text (None without words)
    in its group's modified Kneser-Ney model over the bytes of the words."""
    frames = [b"\n" * (order - 1) + b" ".join(w) + b"\n" if (w := (t or "").encode().split()) else b"" for _, t in rows]
    models = {}
    for name in {g for g, _ in rows}:
        counts = [Counter() for _ in range(order + 1)]
        for (g, _), b in zip(rows, frames):
            if g == name:
                counts[order].update(b[i:i + order] for i in range(len(b) - order + 1))
        for k in range(order - 1, 0, -1):
            counts[k].update(gram[1:] for gram in counts[k + 1])
        models[name] = [None]
        for k in range(1, order + 1):
            n = [sum(c == i for c in counts[k].values()) for i in range(5)]
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else None
            cut = []
            for i, default in ((1, 0.5), (2, 1.0), (3, 1.5)):
                d = i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] else -1
                cut.append(d if 0 <= d <= i else default)
            total, mass = Counter(), Counter()
            for gram, c in counts[k].items():
                total[gram[:-1]] += c
                mass[gram[:-1]] += cut[min(c, 3) - 1]
            models[name].append((counts[k], cut, total, mass))

    def p(model, gram):
        if not gram:
            return 1 / 256
        counts, cut, total, mass = model[len(gram)]
        lower = p(model, gram[1:])
        if gram[:-1] not in total:
            return lower
        c, n = counts.get(gram, 0), total[gram[:-1]]
        return (c - cut[min(c, 3) - 1] if c else 0) / n + mass[gram[:-1]] / n * lower

    out = []
    for (g, t), b in zip(rows, frames):
        lp = sum(math.log10(p(models[g], b[i:i + order])) for i in range(len(b) - order + 1))
        chars = sum(len(w) + 1 for w in words(t))
        out.append(10 ** (-lp / chars) if b else None)
    return out


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
