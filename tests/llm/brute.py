"""Plain Python versions of the operators, and small inputs with every odd case."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACES = re.compile(r"[\x20\x09-\x0D]")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower_ascii(text))


def odd_documents():
    """Nulls in every column, empty and white texts, ties, repeated rows, long texts."""
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
    body = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix potions. "
    near = body * 3 + "Then they all went home and slept until the early morning came again."
    rows = [
        (1, None, "en", "a", 0),
        (2, "", None, None, None),
        (3, " \t\r\n", "en", "a", 4),
        (4, "one", "en", "a", 3),
        (5, "one", "en", "b", 3),
        (5, "one", "en", "b", 3),
        (6, "o n e", "en", "b", 5),
        (7, "Straße naïve ÀÉ 中文 words", "de", "c", 9),
        (8, long, "en", "a", None),
        (9, long + " end", "en", "a", None),
        (10, near, "en", "hot", 1),
        (11, near.replace("early", "late"), "en", "hot", 1),
        (12, near, "en", "hot", 1),
        (12, near, "en", "hot", 1),
        (None, near, "en", "hot", 1),
        (None, None, None, None, None),
        (13, "x\x1fy \x85 z\u3000q\u00a0r <|endoftext|> \U0001f600", "en", "a", 1),
        (14, "!!! --- ...", "en", "a", 1),
    ]
    return rows


def exact_groups(rows):
    """(doc_id, keep_id, group_size, kept, sha) per row of (doc_id, text)."""
    groups = {}
    for doc_id, text in rows:
        norm = SPACES.sub("", text or "")
        groups.setdefault(norm, []).append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        kept = False
        for m in members:
            mine = not kept and m[0] == best[0] and len(m[1]) == len(best[1])
            kept |= mine
            out.append((m[0], best[0], len(members), mine, sha))
    return out


def shingles(text):
    ws = words(text)
    n = min(5, len(ws))
    return Counter(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)) if ws else Counter()


def weighted_jaccard(a, b):
    low = sum((a & b).values())
    return low / (sum(a.values()) + sum(b.values()) - low)


def near_classes(rows, similarity=0.8):
    """{doc_id: class id} by comparing all pairs."""
    docs = {i: shingles(t) for i, t in rows if i is not None}
    full = sorted(i for i, s in docs.items() if s)
    parent = {i: i for i in docs}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, a in enumerate(full):
        for b in full[x + 1 :]:
            if weighted_jaccard(docs[a], docs[b]) >= similarity:
                i, j = find(a), find(b)
                parent[max(i, j)] = min(i, j)
    return {i: find(i) for i in docs}


def contamination(text, items, window=10):
    ws = words(text)
    hits, found = set(), set()
    for item_id, item in items:
        iw = words(item)
        n = min(window, len(iw))
        windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(ws) - n + 1):
            if tuple(ws[i : i + n]) in windows:
                hits.update(range(i, i + n))
                found.add(item_id)
    ids = sorted(str(i) for i in found if i is not None)
    digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
    return len(ws), len(hits), len(ids), digest, bool(hits)


def check_packing(rows, packed, tokenizer_path, capacity=1024):
    """Every piece is right, sequences are gapless and within the capacity. rows: (id, text)."""
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path)
    want = Counter()
    for doc_id, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    assert got == want
    places = {}
    for r in packed:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in packed)
    return len(places), -(-total // capacity)


def merkle_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> per row (doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified)."""
    import zlib

    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf_of(values):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            at = levels[-1]
            levels.append([h(*at[i : i + 3]) for i in range(0, len(at), 3)])
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            run = i // 3 * 3
            out.append((level[run:i], level[i + 1 : run + 3]))
            i //= 3
        return out

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: x[:3])
        trees[s] = tree([x[2] for x in groups[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, _, leaf, row) in enumerate(groups[s]):
            proof = path(trees[s], i) + path(top, k)
            folded = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                folded = leaf_of((*row[:4], row[4].replace("\n", "")))
            for a, b in proof:
                folded = h(*a, folded, *b)
            sides = h(*(x for a, b in proof for x in a + b))
            out.append((row[0], leaf, trees[s][-1][0], top[-1][0], sides, folded, folded == top[-1][0]))
    return out


def vector_codes(rows, entries=256, rounds=4):
    """rows: (vec_id, vector, label) -> per kept row (vec_id, code, error, label_error, digest)."""
    import math

    import numpy as np

    kept = [r for r in rows if r[1] and len(r[1]) % 4 == 0 and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return []
    whole = np.array([[math.floor(1024 * x) for x in r[1]] for r in kept], dtype=object)
    parts = [whole[:, k * whole.shape[1] // 4 : (k + 1) * whole.shape[1] // 4] for k in range(4)]
    books = [p[:entries].copy() for p in parts]

    def nearest(k):
        out = []
        for x in parts[k]:
            d = [int(((x - c) ** 2).sum()) for c in books[k]]
            out.append((min(d), d.index(min(d))))
        return out

    for _ in range(rounds):
        for k in range(4):
            at = [i for _, i in nearest(k)]
            for e in set(at):
                own = parts[k][[i for i, a in enumerate(at) if a == e]]
                books[k][e] = own.sum(axis=0) // len(own)
    found = [nearest(k) for k in range(4)]
    codes = ["".join(f"{found[k][i][1]:02x}" for k in range(4)) for i in range(len(kept))]
    errors = [sum(found[k][i][0] for k in range(4)) for i in range(len(kept))]
    total = Counter()
    for r, e in zip(kept, errors, strict=True):
        total[r[2]] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()
    return [(r[0], c, e, total[r[2]], sha) for r, c, e in zip(kept, codes, errors, strict=True)]


def sketch(text, k=128):
    ws = words(text)
    runs = {" ".join(ws[i : i + 5]) for i in range(max(len(ws) - 4, min(len(ws), 1)))}
    return sorted({hashlib.md5(r.encode()).hexdigest()[:16] for r in runs})[:k]


def compared_fingerprints(rows):
    """rows: (doc_id, text) -> (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) per row."""

    def near(a, b):
        both = sorted({*a, *b})[:128]
        return sum(h in a and h in b for h in both) / len(both) if both else 1.0

    first = {}
    for i, t in rows:
        sha = hashlib.sha256((t or "").encode()).hexdigest()
        first[i] = min(first.get(i, (sha, t or "")), (sha, t or ""))
    order = sorted(first, key=lambda i: (i is not None, i or 0))
    after = {a: first[b][1] for a, b in zip(order, order[1:] + order[:1], strict=True)}
    out = []
    for i, t in rows:
        t, nxt = t or "", after[i]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        own, other = sketch(t), sketch(edited)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(t), sha, "".join(own), "".join(other), near(own, other), near(own, sketch(nxt))))
    return out


def languages(rows, texts):
    """Training rows (lang, text) and texts -> (lang, score) of each text, word by word with plain
    dictionaries and the full Viterbi recursion."""
    import math

    from souk.llm import language_id as lid

    def grams(w):
        return [int(x) for x in lid.trigrams([w])]

    names = sorted({lang for lang, _ in rows if lang is not None})
    counts, scripts = {n: Counter() for n in names}, {n: Counter() for n in names}
    for lang, text in rows:
        if lang is not None:
            for w in lid.letters(text):
                counts[lang].update(grams(w))
                scripts[lang][lid.script(w)] += 1

    def cost(lang, g):
        total = sum(counts[lang].values())
        return math.log((counts[lang][g] + lid.SMOOTHING) / (total + lid.SMOOTHING * lid.BUCKETS))

    def home(lang, script):
        return scripts[lang][script] >= max(lid.SCRIPT_SHARE * sum(scripts[lang].values()), 1)

    def word(w):
        s = lid.script(w)
        if not any(home(n, s) for n in names):
            return [0.0] * len(names)
        return [sum(cost(n, g) for g in grams(w)) + (0 if home(n, s) else lid.OUTSIDE) for n in names]

    out, known = [], {}
    for text in texts:
        ws = lid.letters(text)
        if not ws or not names:
            out.append(("und", 0.0))
            continue
        score = [known.setdefault(w, None) or known.update({w: word(w)}) or known[w] for w in ws]
        value, came = list(score[0]), []
        for s in score[1:]:
            top = max(range(len(names)), key=lambda k: value[k])
            back = [top if value[top] - lid.PENALTY > value[k] else k for k in range(len(names))]
            value = [max(value[top] - lid.PENALTY, value[k]) + s[k] for k in range(len(names))]
            came.append(back)
        k = max(range(len(names)), key=lambda k: value[k])
        labels = [k]
        for back in reversed(came):
            k = back[k]
            labels.append(k)
        held = [0] * len(names)
        for w, k in zip(ws, reversed(labels), strict=True):
            held[k] += len(w)
        best = max(range(len(names)), key=lambda k: held[k])
        out.append((names[best], held[best] / sum(held)))
    return out
