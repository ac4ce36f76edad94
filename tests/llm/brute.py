"""Plain versions of the operators for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text):
    found = words(text)
    if len(found) >= 5:
        return {tuple(found[k : k + 5]) for k in range(len(found) - 4)}
    return {tuple(found)} if found else set()


def components(docs, percent=80):
    """doc_id -> (number of shingles, smallest linked doc_id), for distinct doc_ids."""
    sets = {doc: shingles(text) for doc, text in docs}
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for doc, own in sets.items():
        for s in own:
            lists[s].append(doc)
    for doc, own in sets.items():
        for other, common in Counter(o for s in own for o in lists[s] if o < doc).items():
            if 100 * common >= percent * (len(own) + len(sets[other]) - common):
                a, b = root(doc), root(other)
                parent[max(a, b)] = min(a, b)
    return {doc: (len(own), root(doc)) for doc, own in sets.items()}


def without_repeats(docs, window=50):
    """doc_id -> (bytes, removed, runs, digest of what is left), in the order of doc_id."""
    seen, result = {}, {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        strings = [data[k : k + window] for k in range(len(data) - window + 1)]
        for k, string in enumerate(strings):
            if seen.get(string, doc) < doc:
                gone[k : k + window] = b"\1" * window
        for string in strings:
            seen.setdefault(string, doc)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        result[doc] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return result


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], start, end) for start, k, end in sorted(found)]


def nearest(vectors, queries, k):
    result = {}
    for q in queries:
        scored = []
        for other, x in vectors.items():
            if other != q:
                total = 0.0
                for a, b in zip(vectors[q], x):
                    total += (a - b) * (a - b)
                scored.append((total**0.5, other))
        result[q] = sorted(scored)[:k]
    return result


def prefix_trie(turns):
    """The nodes of the trie of (conv_id, turn, role, text) rows rebuilt on shared heads, as tuples."""
    plain = re.compile(r"[^\x20\x09-\x0D]+")
    convs = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [t[1:] for t in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        head = zlib.crc32(str(c).encode()) % 4
        base = abs(c) // 20 * 20 * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(convs.get(base, [])[:head] + own[head:])
    under = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            under[rebuilt[c][:d]].append(c)
    children = Counter(p[:-1] for p in under if p)
    leaves, saved = Counter(), Counter()
    for p, ms in under.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(ms) - 1) * len(plain.findall(p[-1][1])) if p else 0
    ends = {p: ",".join(str(c) for c in ms if rebuilt[c] == p) for p, ms in under.items()}
    return {
        (ms[0], len(p), under[p[:-1]][0] if p else None, len(ms), children[p], leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest())
        for p, ms in under.items()
    }


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence(docs, least=30, most=50):
    """The rows of the audit of (text, lang, source) documents, every source compared with every other term by term."""
    docs = [tuple(x or "" for x in doc) for doc in docs]
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        found = TERM.findall(text.translate(LOWER))
        counts[lang, source].update(found)
        seen[lang].update(set(found))
    result = set()
    for lang in seen:
        kept = [t for t, n in seen[lang].items() if n >= least]
        sources = sorted({s for _, g, s in docs if g == lang}, key=str.encode)

        def shares(own):
            total = sum(own[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (own[t] + 5) // total for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, len(pairs)), ("term", terms, most)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                result |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)}
    return result


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def license_words(text):
    return LICENSE_WORD.findall((text or "").translate(LOWER))


def phrase_places(text, phrases):
    """label -> starts of all places where a phrase's words stand consecutively."""
    found = license_words(text)
    places = defaultdict(list)
    for label, phrase in phrases:
        own = phrase.split()
        for k in range(len(found) - len(own) + 1):
            if found[k : k + len(own)] == own:
                places[label].append(k)
    return places


def license_chains(text, templates, least_words, least_covered, most_gap):
    """Spans (label, start, end, covered) of chained long matches, and the best share, by comparing all substrings."""
    found = license_words(text)
    coded = [license_words(t.text) for t in templates]
    inside = {tuple(c[i:j]) for c in coded for i in range(len(c)) for j in range(i + 1, len(c) + 1)}
    reach = []
    for end in range(1, len(found) + 1):
        reach.append(max((n for n in range(end + 1) if n == 0 or tuple(found[end - n : end]) in inside), default=0))
    spans, best = [], 0.0
    for k, (template, own) in enumerate(zip(templates, coded)):
        if template.phrase:
            continue
        chains = []
        for end, n in enumerate(reach, 1):
            if n < least_words or (end < len(found) and reach[end] == n + 1):
                continue
            for high in range(n, len(own) + 1):
                if own[high - n : high] != found[end - n : end]:
                    continue
                start, low, most, onto = end - n, high - n, n, None
                for c in chains:
                    near = start - c["end"] <= most_gap and low - c["high"] <= most_gap
                    if near and c["end"] < end and c["high"] < high:
                        covered = c["covered"] + n - max(0, c["end"] - start, c["high"] - low)
                        if covered > max(most, c["covered"]):
                            most, onto = covered, c
                if onto:
                    onto["extended"] = True
                chains.append({"start": onto["start"] if onto else start, "end": end, "high": high, "covered": most, "extended": False})
        kept = []
        for c in [c for c in chains if not c["extended"]]:
            best = max(best, c["covered"] / len(own))
            if c["covered"] < least_covered * len(own):
                continue
            if kept and c["start"] < kept[-1][1]:
                if c["covered"] > kept[-1][2]:
                    kept[-1] = (c["start"], c["end"], c["covered"])
            else:
                kept.append((c["start"], c["end"], c["covered"]))
        spans += [(s, e, n, k) for s, e, n in kept]
    outer = [x for x in spans if not any(y[0] <= x[0] and y[1] >= x[1] and y[2] > x[2] for y in spans)]
    return sorted((templates[k].label, s, e, n / len(coded[k])) for s, e, n, k in outer), best


def grams(text):
    """dimension -> count of hashed n-grams of one to three bytes."""
    data, spaced = text.lower().encode(), bytearray()
    for byte in data:
        byte = byte if byte >= 128 or chr(byte).isalpha() else 32
        if byte != 32 or not spaced or spaced[-1] != 32:
            spaced.append(byte)
    found = Counter()
    for n in (1, 2, 3):
        for k in range(len(spaced) - n + 1):
            code = int.from_bytes(spaced[k : k + n], "big") + (n << 24)
            found[(code * 2654435761 % 2**32) >> 20] += 1
    return found


def vector(counts, idf):
    raw = {d: (1 + math.log(c)) * idf(d) for d, c in counts.items()}
    norm = math.sqrt(sum(v * v for v in raw.values())) or 1
    return {d: v / norm for d, v in raw.items()}


def water_level(sizes, most=3):
    """Targets of a mix by sharing again and again what is over."""
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, free, target = sum(sizes.values()), set(sizes), {}
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return target | share
        target |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return target
