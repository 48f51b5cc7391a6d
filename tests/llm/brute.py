"""Small-fixture builders and brute-force versions that the operators are held against."""
import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def texts(seed=1, n=40):
    """Documents with shared passages, exact and near copies, repeated passages inside one text, and odd ones."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéñß") for _ in range(r.randint(1, 7))) for _ in range(200)]
    passage = [" ".join(r.choice(vocab) for _ in range(r.randint(20, 60))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [" ".join(r.choice(vocab) for _ in range(r.randint(0, 60))) for _ in range(r.randint(1, 4))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passage)
            if r.random() < 0.4:
                p = p[r.randint(0, 30):len(p) - r.randint(0, 30)]
            parts.insert(r.randint(0, len(parts)), p)
        out.append(r.choice(["\n", " ", "  "]).join(parts))
    out += [out[3], out[3], out[5] + " tail", "x " + out[5], passage[0] + "\n" + passage[0], "a" * 700, "ab" * 400,
            ("one two " * 90).strip(), "", None, " \n\t ", "short", "\x00" * 150 + "end", "z" * 99, "z" * 100, "z" * 101]
    return out


def byte_dedup(rows, length=100):
    """rows: (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for did, text in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        b = (text or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = [True] * length
            seen.add(w)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[did] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def word_dedup(rows, length=35):
    from collections import Counter
    words = {did: WORD.findall(text or "") for did, text in rows}
    count = Counter(tuple(w[i:i + length]) for w in words.values() for i in range(len(w) - length + 1))
    out = {}
    for did, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if count[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        out[did] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode()))
    return out


def quality_counts(text):
    from collections import Counter
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = [False] * len(w)
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            rep[i:i + 8] = [True] * 8
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(rep),
            sum(a == b for a, b in zip(w, w[1:])))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items, width=10):
    windows = []
    for item, text in items:
        w = BENCH_WORD.findall(lower(text))
        if w:
            windows.append((item, {tuple(w[i:i + width]) for i in range(max(len(w) - width, 0) + 1)}))
    out = {}
    for did, text in docs:
        w = BENCH_WORD.findall(lower(text))
        hit, names = [False] * len(w), set()
        for item, wins in windows:
            for win in wins:
                for i in range(len(w) - len(win) + 1):
                    if tuple(w[i:i + len(win)]) == win:
                        hit[i:i + len(win)] = [True] * len(win)
                        if item is not None:
                            names.add(str(item))
        out[did] = (len(w), sum(hit), len(names), sha(",".join(sorted(names)).encode()), any(hit))
    return out


def jaccard_groups(rows, width=5, percent=80):
    """rows: (doc_id, text) with distinct ids; {doc_id: (n_shingles, component_id)}."""
    sets = {}
    for did, text in rows:
        w = WORD.findall(lower(text))
        sets[did] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}
