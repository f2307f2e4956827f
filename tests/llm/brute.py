"""Plain versions of the operators' contracts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 63
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def suffix_dedup(rows, length=100):
    """Ids must be distinct, or rows with one id equal."""
    seen, result = set(), []
    for doc, text in sorted(rows, key=lambda r: LAST if r[0] is None else r[0]):
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = [True] * length
            else:
                seen.add(s)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        result.append((doc, len(data), len(data) - len(kept), runs, sha(kept)))
    return sorted(result, key=str)


def word_windows(rows, length=35):
    texts = [words(t) for _, t in rows]
    count = Counter(tuple(w[i : i + length]) for w in texts for i in range(len(w) - length + 1))
    result = []
    for (doc, _), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if count[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        result.append((doc, len(w), len(w) - len(kept), sha(" ".join(kept).encode())))
    return sorted(result, key=str)


def shingles(text, k=5):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near_duplicates(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for t in s:
            lists[t].append(i)
    for i, s in enumerate(sets):
        for j, shared in Counter(j for t in s for j in lists[t] if j < i).items():
            if 100 * shared >= 80 * (len(s) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), LAST), LAST if doc is None else doc)
    return sorted(((d, len(sets[i]), None if least[find(i)] == LAST else least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def base_counts(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = set()
    for i in range(len(w) - 7):
        if count[tuple(w[i : i + 8])] > 1:
            again.update(range(i, i + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def line_dedup(rows, min_chars=40, min_docs=5):
    def key(line):
        return line.strip(" \t\n\v\f\r").translate(LOWER)

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    result = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = holders[key(line)]
            last = max(ids, key=lambda d: -LAST if d is None else d)
            if len(key(line)) < min_chars or len(ids) < min_docs or doc == last:
                kept.append(line)
        result.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return sorted(result, key=str)


def spelling(rows):
    """``word, form, root, n, n_near, form_n`` by comparing every two words."""
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
        return a[i + (len(a) == len(b)) :] == b[i + 1 :]

    form, result = {}, []
    links = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)] for w in words}
    for w, n in words.items():
        best = min(links[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        result.append((w, form[w], root, n, len(links[w]), words.get(form[w])))
    return sorted(result, key=str)
