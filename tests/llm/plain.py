"""Plain versions of the operators, one row after the other, to compare with."""

import hashlib
import re
import unicodedata
from collections import Counter, defaultdict

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text, shingle=3):
    words = SPACED.findall(lower(text))
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
    if words and len(words) < shingle:
        grams = [" ".join(words)]
    counts = [0] * 64
    for gram in grams:
        value = xxhash.xxh64_intdigest(gram.encode(), seed=42)
        for bit in range(64):
            counts[bit] += value >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(grams))


def groups(values, linked):
    """Component number of each value, comparing all pairs."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def near_duplicates(rows):
    """``(doc_id, fingerprint, component_id)`` of ``(doc_id, text)`` rows."""
    prints = [fingerprint(text) for _, text in rows]
    distinct = sorted(set(prints))
    of = dict(zip(distinct, groups(distinct, lambda a, b: (a ^ b).bit_count() <= 2)))
    members = defaultdict(list)
    for (doc_id, _), value in zip(rows, prints):
        if doc_id is not None:
            members[of[value]].append(doc_id)
    return [
        (doc_id, f"{value:016x}", min(members[of[value]], default=None))
        for (doc_id, _), value in zip(rows, prints)
    ]


def contamination(text, items, window=13):
    """``n_words, n_hit, items`` of a text, against ``(item_id, text)`` rows."""
    words = ALNUM.findall(lower(text))
    hit, found = set(), set()
    for item_id, item in items:
        sought = ALNUM.findall(lower(item))
        width = min(window, len(sought))
        for i in range(len(sought) - width + 1 if width else 0):
            for at in range(len(words) - width + 1):
                if words[at : at + width] == sought[i : i + width]:
                    hit.update(range(at, at + width))
                    if item_id is not None:
                        found.add(item_id)
    return len(words), len(hit), found


_PHRASES = (
    "cookie|cookies|privacy policy|terms of use|terms of service|all rights reserved|javascript"
    "|subscribe|sign in|sign up|log in|login|newsletter|click here|read more|share on|share this"
    "|lorem ipsum|copyright"
)


def failed_line(line):
    words = SPACED.findall(line)
    if not words:
        return False
    separators = sum(line.count(c) for c in "|»›•")
    if separators >= 3 and len(words) <= 4 * separators + 4:
        return True
    if len(words) <= 30 and re.search(rf"\b({_PHRASES})\b", line, re.IGNORECASE | re.ASCII):
        return True
    symbols = sum(line.count(c) for c in "#*$%&<>")
    if symbols >= 3 and symbols * 10 > len(words):
        return True
    shouts = sum(bool(re.search(r"[!?]{2,}$", w)) for w in words)
    if shouts >= 2 and shouts * 5 >= len(words):
        return True
    last = words[-1][-1]
    closed = last in ".!?:;,)]}\"'" or (last > "\x7f" and unicodedata.category(last) in ("Po", "Pe", "Pf"))
    letters = sum(unicodedata.category(c)[0] in "LM" for c in line)
    unspaced = letters >= 10 and not re.search("[A-Za-z]", line)
    return len(words) < 3 and not closed and not unspaced


def quality(text):
    """Contract measures, verdicts and the cleaned text."""
    text = text or ""
    words = SPACED.findall(text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = text.split("\n")
    filled = [line for line in lines if SPACED.search(line)]
    failed = [line for line in lines if failed_line(line)]
    chars = sum(map(len, words))
    lost = sum(len("".join(SPACED.findall(line))) for line in failed)
    base_failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    measures = (
        len(words), chars, len(re.findall(r"[#*$%&|<>]", text)),
        len(filled) - len(set(filled)), len(covered),
    )
    kept = not base_failed and 100 * lost <= 50 * chars
    return measures, base_failed, kept, "\n".join(line for line in lines if not failed_line(line))


def targets(sizes, weights=(1, 2, 3), most=3):
    """Target of each source by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    share = dict.fromkeys(order, 0.0)
    rest, open_ = float(sum(sizes.values())), set(order)
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            share[s] += rest * weight[s] / total
        rest = 0.0
        for s in list(open_):
            if share[s] >= most * sizes[s]:
                rest += share[s] - most * sizes[s]
                share[s] = float(most * sizes[s])
                open_.discard(s)
    return share, weight


def readings(rows, schedules=((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))):
    """``(row number, reading, position)`` of ``(doc_id, text, source)`` rows."""
    sizes, members = Counter(), defaultdict(list)
    for n, (doc_id, text, source) in enumerate(rows):
        size = len(SPACED.findall(text or ""))
        sizes[source] += size
        draw = hashlib.sha256(str("" if doc_id is None else doc_id).encode()).hexdigest()
        members[source].append((draw, size, n))
    share, weight = targets(sizes)
    found = []
    for source, own in members.items():
        start = 0
        a, b = schedules[weight[source] - 1]
        for _, size, n in sorted(own):
            for reading in range(3):
                middle = reading * sizes[source] + start + size / 2
                if size and middle <= share[source] + 1e-6:
                    low, high = 0.0, 1.0
                    for _ in range(60):  # invert the integral of the rate
                        t = (low + high) / 2
                        low, high = (t, high) if a * t + (b - a) * t * t / 2 < middle / share[source] else (low, t)
                    found.append((n, reading, low))
            start += size
    return sorted(found, key=lambda r: r[2]), share
