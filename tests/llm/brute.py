"""Plain versions of the operators, to compare with."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def documents(seed=3):
    """(doc_id, text, lang, source, n_chars) with copies, near copies, shared passages, nulls, empty and long texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(400)]
    common = "the of and to a in is that it for".split()

    def prose(n):
        out = [r.choice(common) if r.random() < 0.4 else r.choice(vocabulary) for _ in range(n)]
        return "".join(w + ("\n" if i % 12 == 11 else " ") for i, w in enumerate(out)).strip()

    passage = prose(60)
    texts = [None, "", " \n\t ", "word", "two words", "Two Words", "the the the " * 40, "###$$$ %%% " * 60, "A\r\nb\x0bc é ü 😀 " * 30]
    base = [prose(r.randint(60, 220)) for _ in range(30)]
    texts += base + base[:6]
    for b in base[:12]:
        w = b.split(" ")
        for k in r.sample(range(len(w)), 1 + len(w) // 60):
            w[k] = "edit"
        texts.append(" ".join(w))
    texts += [prose(30) + "\n" + passage + "\n" + prose(40) for _ in range(8)]
    texts += [prose(3000), "aaaa" * 200, "aaaa" * 300, "x | y | z\n" * 30]
    order = list(range(len(texts)))
    r.shuffle(order)
    rows = []
    for i, k in enumerate(order):
        source = None if i % 9 == 0 else r.choice(["web", "web", "web", "news", "été", ""])
        lang = None if i % 17 == 0 else r.choice(["en", "en", "fr", "xx"])
        rows.append((i, texts[k], lang, source, None if texts[k] is None else len(texts[k])))
    return rows + rows[5:7]  # rows that repeat in full


def line_dedup(rows):
    """{(doc_id, text): (text, n_lines, n_removed)}"""
    seen, out = {}, {}
    ordered = sorted({(i, t) for i, t in rows}, key=lambda x: (x[0], x[1] or ""))
    for i, text in ordered:
        lines = [] if text is None else text.split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            window = tuple(lines[p:p + 3])
            if words("\n".join(window)) and seen.setdefault(window, (i, text, p)) != (i, text, p):
                gone |= {p, p + 1, p + 2}
        left = text if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone)
        out[i, text] = (left, len(lines), len(gone))
    return out


def _distance(p, q):
    total_p, total_q, d = sum(p), sum(q), 0.0
    if not total_p or not total_q:
        return None
    for a, b in zip(p, q):
        a, b = a / total_p, b / total_q
        for x, y in ((a, b), (b, a)):
            d += x * math.log2(2 * x / (x + y)) / 2 if x else 0
    return math.sqrt(max(d, 0))


def quality(rows):
    """A tuple per row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    from mendlake.llm import quality as q

    counts, reference = [], {}
    for _, text, lang in rows:
        text = text or ""
        w = words(text)
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if words(x)]
        classes = [len(re.sub(p, "", text)) for p in q.CLASSES]
        known = q.COMMON_WORDS[lang].split() if lang in q.COMMON_WORDS else q.OTHER
        commons = [w.count(k) for k in known]
        classes.append(len(text) - sum(classes))
        commons.append(len(w) - sum(commons))
        counts.append((len(text), len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
                       len(covered), classes, commons))
        a, b = reference.setdefault(lang, ([0] * len(classes), [0] * len(commons)))
        a[:] = [x + y for x, y in zip(a, classes)]
        b[:] = [x + y for x, y in zip(b, commons)]
    out = []
    for (_, _, lang), (n, nw, wc, ns, nd, nr, classes, commons) in zip(rows, counts):
        failed = nw < 50 or 100 * nr > 50 * nw
        odd = n >= 200 and _distance(classes, reference[lang][0]) > q.MAX_CHAR_DISTANCE
        odd = odd or nw >= 100 and _distance(commons, reference[lang][1]) > q.MAX_WORD_DISTANCE
        out.append((nw, wc, ns, nd, nr, failed, not (failed or odd)))
    return out


def shingles(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def components(rows):
    """{doc_id: (sizes of its sets, component)}"""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def repeats(rows):
    """{doc_id: {(n_bytes, n_removed, n_spans, sha256)}}; rows of one id don't remove from each other."""
    seen, out = set(), {}
    ids = sorted({i for i, _ in rows})
    for i in ids:
        mine = {(t or "").encode() for j, t in rows if j == i}
        for data in mine:
            gone = bytearray(len(data))
            for p in range(len(data) - 49):
                if data[p:p + 50] in seen:
                    gone[p:p + 50] = b"\1" * 50
            spans = sum(1 for p in range(len(data)) if gone[p] and not (p and gone[p - 1]))
            kept = bytes(c for c, g in zip(data, gone) if not g)
            out.setdefault(i, set()).add((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
        for data in mine:
            seen.update(data[p:p + 50] for p in range(len(data) - 49))
    return out


def targets(sizes):
    """{source: target} by repeated resharing; ``sizes`` maps sources, None last, to words."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        share = (total - sum(3 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        over = {s for s in rest if weight[s] * share > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * share for s in order}
        full |= over


def with_planted_runs(rows):
    """{(doc_id, text): words}; every tenth text, by checksum of its id, repeats a stretch of its words."""
    out = {}
    for i, text in rows:
        w, h = words(text), zlib.crc32(str(i).encode()) if i is not None else 1
        g = h // 10
        if h % 10 == 0 and w:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        out[i, text] = w
    return out


def runs(w, shortest=12):
    """Sorted (start, period, length) of all runs of a list, by comparing it with itself at every distance."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        j = 0
        while j + q < len(w):
            s = j
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - s + q >= max(shortest, 2 * q):
                found.setdefault((s, j - s + q), q)
            j += 1
    return sorted((s, q, n) for (s, n), q in found.items())


def run_row(w):
    """n_runs, start, length, period, exponent_milli, runs_sha256 and collapsed_sha256 of a list of words."""
    found, gone = runs(w), set()
    for s, q, n in found:
        gone |= set(range(s + q, s + n))
    best = min(((-n, s, q) for s, q, n in found), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, q, n in found)
    left = " ".join(x for k, x in enumerate(w) if k not in gone)
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return (len(found), *top, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, left)))


def clusters(rows, k=8, rounds=10):
    """Sorted (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of integer vectors."""
    if not rows:
        return []
    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    points = [list(v) for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points)) for _, v in rows]

    for _ in range(rounds):
        near = [c for _, c in assign()]
        for c in set(near):
            own = [v for (_, v), x in zip(rows, near) if x == c]
            points[c] = [sum(x) // len(own) for x in zip(*own)]
    near, sums = assign(), Counter()
    for d, c in near:
        sums[c] += d
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, c, d, sums[c], sum(sums.values()), digest[c]) for (i, _), (d, c) in zip(rows, near)), key=repr)
