"""Plain Python versions of the operators, for small tables."""

import collections
import math
import re
import zlib

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = "id long, key string, batch int, row string, `text key` string, words array<string>"


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def contamination(docs, items, size=10):
    grams = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[i:i + n])].add(item)
    lengths = {len(g) for g in grams}
    out = {}
    for doc, text in docs:
        w = words(text)
        hit, found = [False] * len(w), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    found |= grams[tuple(w[i:i + n])]
                    hit[i:i + n] = [True] * n
        out[doc, text] = (len(w), sum(hit), sorted(str(x) for x in found if x is not None))
    return out


def repeats(docs, window=20):
    """docs: (place, text) in order of place; equal places are equal rows."""
    first, out = {}, {}
    for place, text in docs:
        w = TOKEN.findall(text or "")
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), (place, i))
    for place, text in docs:
        w = TOKEN.findall(text or "")
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] != (place, i):
                gone[i:i + window] = [True] * window
        out[place] = (" ".join(x for x, g in zip(w, gone) if not g), len(w), sum(gone))
    return out


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def links(docs, threshold=0.8):
    """(number of links, least id reached) by id."""
    sets = {i: shingles(t) for i, t in docs}
    near = collections.defaultdict(set)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            inter = len(x & y)
            if x and y and inter >= threshold * (len(x) + len(y) - inter) - 1e-9:
                near[a].add(b)
                near[b].add(a)
    least = {}
    for i in ids:
        if i not in least:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in least:
                    least[x] = i
                    todo += near[x]
    return {i: (len(near[i]), least[i]) for i in ids}


def bm25(docs, queries, k=10, k1=1.2, b=0.75):
    bags = {i: collections.Counter(words(t)) for i, t in docs}
    n, size = len(bags), {i: sum(c.values()) for i, c in bags.items()}
    mean = sum(size.values()) / max(1, n)
    df = collections.Counter(w for c in bags.values() for w in c)
    out = {}
    for q in queries:
        scored = []
        for i, c in bags.items():
            s = sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (k1 + 1) / (c[w] + k1 * (1 - b + b * size[i] / mean))
                    for w in bags[q] if w in c)
            if s:
                scored.append((-round(s, 6), i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(words):
    """Words one edit apart."""
    out, less = collections.defaultdict(set), collections.defaultdict(set)
    known = set(words)
    for w in known:
        for i in range(len(w)):
            less[i, w[:i] + "?" + w[i + 1:]].add(w)
            short = w[:i] + w[i + 1:]
            if short in known:
                out[w].add(short)
                out[short].add(w)
    for group in less.values():
        for w in group:
            out[w] |= group - {w}
    return out


def variants(docs, ratio=10):
    n = collections.Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    close = near(n)
    form = {}
    for w in n:
        if close[w]:
            best = min(close[w], key=lambda v: (-n[v], v))
            if n[best] >= ratio * n[w]:
                form[w] = best
    root = {}
    for w in n:
        at = w
        while at in form:
            at = form[at]
        root[w] = at
    return [(w, form.get(w), root[w], n[w], len(close[w]), n[form[w]] if w in form else None) for w in n]
