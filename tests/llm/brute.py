"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def id_key(doc_id):
    return (doc_id is not None, doc_id or 0)


def near_duplicates(rows, threshold=(4, 5)):
    """[(doc_id, text)] -> {row number: (class_id, n_links, copy_of)}"""
    copy = {}
    for i, t in rows:
        known = copy.get(t or "", "none")
        copy[t or ""] = i if known == "none" or known is None or (i is not None and i < known) else known
    texts = sorted(copy)
    sets = [shingles(t) for t in texts]
    parent, links = list(range(len(texts))), [0] * len(texts)

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both * threshold[1] >= threshold[0] * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                parent[top(a)] = top(b)
    first = {}
    for k, t in enumerate(texts):
        r, i = top(k), copy[t]
        if i is not None and (r not in first or i < first[r]):
            first[r] = i
    at = {t: k for k, t in enumerate(texts)}
    return [(first.get(top(at[t or ""])), links[at[t or ""]], copy[t or ""]) for _, t in rows]


def contained(docs, items, threshold=(4, 5), short=True):
    """[(doc_id, text)], [(item_id, text)] -> {(doc_id, text, item_id, item text): (shared, size)};
    ``short``: items below five words are looked for as runs of their own length"""
    out = {}
    for item, it in set(items):
        s = shingles(it)
        for doc, t in set(docs):
            w, m = words(t or ""), len(words(it or ""))
            runs = {" ".join(w[i:i + m]) for i in range(len(w) - m + 1)} if short and 0 < m < 5 else set()
            n = len(s & shingles(t)) if not runs else len({" ".join(words(it))} & runs)
            if s and n * threshold[1] >= threshold[0] * len(s):
                out[doc, t or "", item, it or ""] = (n, len(s))
    return out


def base_counts(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def cut_repeats(rows, length=100):
    """[(doc_id, text)] of distinct ids -> {doc_id: (n_bytes, n_removed, n_spans, sha256)}"""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: id_key(r[0])):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def line_repeats(rows, run=2, long_words=10):
    """[(doc_id, text)] of distinct ids -> {doc_id: kept text}"""
    seen, alone, out = set(), set(), {}
    for i, t in sorted(rows, key=lambda r: id_key(r[0])):
        lines = (t or "").split("\n")
        full = [k for k, x in enumerate(lines) if words(x)]
        gone = set()
        for p in range(len(full) - run + 1):
            key = tuple(lines[k] for k in full[p:p + run])
            if key in seen:
                gone |= set(full[p:p + run])
            seen.add(key)
        for k in full:
            if len(words(lines[k])) >= long_words:
                if ("alone", lines[k]) in alone:
                    gone.add(k)
                alone.add(("alone", lines[k]))
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out
