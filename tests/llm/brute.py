"""Plain-Python versions of the operators, as slow and direct as they can be."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def low_words(text):
    return WORD.findall((text or "").translate(LOW))


def normal(line):
    return SPACES.sub(" ", line.lower()).strip(" ")


def shingles(text, n):
    w = low_words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components(docs, n, percent):
    """doc_id -> smallest doc_id reachable, from {doc_id: text}."""
    sets = {i: shingles(t, n) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b]:
                m = len(sets[a] & sets[b])
                if 100 * m >= percent * (len(sets[a]) + len(sets[b]) - m):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: root(i) for i in docs}


def repeated_words(text):
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)})


def flagged_lines(docs, most=20, share=0.005):
    """(source, line) over the limits; docs: (doc_id, text, source)."""
    holders, texts = defaultdict(set), defaultdict(set)
    for _, text, source in docs:
        texts[source].add(text)
        for line in (text or "").split("\n"):
            if normal(line):
                holders[source, normal(line)].add(text)
    return {k for k, v in holders.items() if len(v) > most and len(v) > share * len(texts[k[0]])}


def quality_clean(docs):
    gone, out = flagged_lines(docs), []
    for doc_id, text, source in docs:
        n = len(words(text))
        lines = (text or "").split("\n")
        removed = sum(len(words(x)) for x in lines if (source, normal(x)) in gone)
        if n < 50 or 100 * repeated_words(text) > 50 * n or n - removed < 0.3 * n:
            continue
        out.append((doc_id, "\n".join(x for x in lines if (source, normal(x)) not in gone), source))
    return out


def spread_clean(docs, sites=10):
    held, first = defaultdict(set), {}
    for doc_id, text, source in docs:
        for line in {normal(x) for x in (text or "").split("\n")} - {""}:
            held[line].add(source)
            first[line] = min(first.get(line, doc_id), doc_id)
    gone = {x for x, s in held.items() if len(s) >= sites}
    return [(i, "\n".join(x for x in t.split("\n") if normal(x) not in gone or first[normal(x)] == i), s) for i, t, s in docs]


def leaks(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    joined = f" {' '.join(split(text))} "
    for item in items:
        w = split(item)
        if w and any(f" {' '.join(w[i : i + 8])} " in joined for i in range(max(1, len(w) - 7))):
            return True
    return False


def turns_digest(turns):
    return hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest()


class Backoff:
    """The discounted backoff model from dictionaries of word tuples."""

    def __init__(self, texts, order=3, least=2, discount=0.75):
        streams = [[*low_words(t), "</s>"] for t in texts]
        self.unigrams = Counter(w for s in streams for w in s)
        self.total, self.distinct = sum(self.unigrams.values()), len(self.unigrams)
        self.order, self.kept = order, {(w,): n for w, n in self.unigrams.items() if n >= least}
        for k in range(2, order + 1):
            grams = Counter(tuple(s[i : i + k]) for s in streams for i in range(len(s) - k + 1))
            self.kept |= {g: n for g, n in grams.items() if n >= least and g[:-1] in self.kept and g[1:] in self.kept}
        self.after = defaultdict(list)
        for g in self.kept:
            self.after[g[:-1]].append(g[-1])
        self.discount = discount

    def base(self, w):
        return (self.unigrams[w] + 0.5) / (self.total + 0.5 * (self.distinct + 1))

    def p(self, context, w):
        if not context:
            return self.base(w)
        if (*context, w) in self.kept:
            return (self.kept[*context, w] - self.discount) / self.kept[context]
        own = self.after[context] if context in self.kept else []
        left = 1 - sum((self.kept[*context, x] - self.discount) / self.kept[context] for x in own)
        below = 1 - sum(self.p(context[1:], x) for x in own)
        return left / below * self.p(context[1:], w)

    def score(self, text):
        stream, total = [*low_words(text), "</s>"], 0.0
        for i, w in enumerate(stream):
            context = tuple(stream[max(0, i - self.order + 1) : i])
            while context and context not in self.kept:
                context = context[1:]
            total += math.log10(self.p(context, w))
        return total


def ngram_frequencies(text):
    """How many of a thousand character n-grams each place has."""
    from quernel.llm import toxicity

    low = f" {(text or '').lower()} "
    found = Counter()
    for k in toxicity.SIZES:
        for i in range(len(low) - k + 1):
            h = 0
            for c in low[i : i + k]:
                h = (h * 0x100000001B3 + ord(c)) % 2**64
            h = (h + k - 1) % 2**64
            h = ((h ^ (h >> 29)) * 0xFF51AFD7ED558CCD) % 2**64
            found[h >> (64 - toxicity.BITS)] += 1
    total = sum(found.values())
    return {x: n * 1000 / max(1, total) for x, n in found.items()}


def naive_bayes_logistic(rows, steps=150):
    """(weight of each place, intercept) from (text, label), one number at a time."""
    from quernel.llm.toxicity import MIN_DOCS, MIN_RATIO, PENALTY, TRUST

    held = [ngram_frequencies(t) for t, _ in rows]
    labels = [y for _, y in rows]
    n1, n = sum(labels), len(labels)
    ratio = {}
    for x in {x for f in held for x in f}:
        if sum(x in f for f in held) < MIN_DOCS:
            continue
        one = sum(f.get(x, 0) for f, y in zip(held, labels, strict=True) if y)
        two = sum(f.get(x, 0) for f, y in zip(held, labels, strict=True) if not y)
        rate = (one + two) / n
        value = math.log((one + TRUST * rate + 1e-3) / (n1 + TRUST)) - math.log((two + TRUST * rate + 1e-3) / (n - n1 + TRUST))
        if abs(value) >= MIN_RATIO:
            ratio[x] = value
    inputs = [{x: ratio[x] * math.sqrt(v) for x, v in f.items() if x in ratio} for f in held]
    w, m, v = dict.fromkeys(ratio, 0.0), dict.fromkeys(ratio, 0.0), dict.fromkeys(ratio, 0.0)
    b = mb = vb = 0.0
    for t in range(1, steps + 1):
        off = [(1 / (1 + math.exp(-(sum(w[x] * u for x, u in f.items()) + b))) - y) / n for f, y in zip(inputs, labels, strict=True)]
        slope = {x: PENALTY * w[x] for x in w}
        for f, e in zip(inputs, off, strict=True):
            for x, u in f.items():
                slope[x] += e * u
        for x, g in slope.items():
            m[x], v[x] = 0.9 * m[x] + 0.1 * g, 0.99 * v[x] + 0.01 * g * g
            w[x] -= 0.02 * (m[x] / (1 - 0.9**t)) / (math.sqrt(v[x] / (1 - 0.99**t)) + 1e-9)
        g = sum(off)
        mb, vb = 0.9 * mb + 0.1 * g, 0.99 * vb + 0.01 * g * g
        b -= 0.02 * (mb / (1 - 0.9**t)) / (math.sqrt(vb / (1 - 0.99**t)) + 1e-9)
    prior, share = (n1 + 1) / (n + 2), n1 / n
    return {x: w[x] * ratio[x] for x in w}, b + math.log(prior / (1 - prior)) - math.log(share / (1 - share))


def logistic_score(text, weights, base):
    return 1 / (1 + math.exp(-(base + sum(weights.get(x, 0) * math.sqrt(v) for x, v in ngram_frequencies(text).items()))))
