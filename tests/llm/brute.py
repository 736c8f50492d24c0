"""Plain versions of the operators for small tables, and the rows that every operator must take."""

import hashlib
import itertools
import re
from collections import Counter

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"wort{k % 997} der {k}" for k in range(40_000))
COMMON = "the cat sat on the mat and the dog lay by the door of the old house in the rain"

#: nulls in every column, empty and very long texts, repeated rows, ties, words of other scripts
ODD = [
    (1, None, "en", "src1", 0),
    (2, "", "en", None, 0),
    (3, " \t\n", None, "src0", 3),
    (4, COMMON, "en", "src0", None),
    (4, COMMON, "en", "src0", None),
    (5, COMMON.replace(" ", "\n"), "en", "src0", 5),
    (None, COMMON, None, None, None),
    (None, None, None, None, None),
    (6, LONG, "de", "src4", 1),
    (7, LONG + " ende", "de", "src4", 1),
    (8, "日本語の文 🙂 und ein Ü x", "ja", "src2", 9),
    (9, "12 -- !! ??", "en", "src2", 9),
    (10, "x" * 5000, "", "", 9),
    (11, "All rights reserved. Licensed under CC BY-NC 4.0.\nAll rights reserved.", "en", "src7", 9),
]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(WORD, text or "")


def base_measures(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def normal(text):
    return re.sub(SPACE + "+", " ", text or "")


def components(rows, size, percent):
    """{row number: (size of its set, smallest id reachable)}; rows: (id, text), ids may be None."""
    sets = []
    for _, text in rows:
        w = words(lower(text))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()})
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y:
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                parent[top(a)] = top(b)
    ids: dict[int, list] = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            ids.setdefault(top(k), []).append(doc)
    return [(doc, len(sets[k]), min(ids.get(top(k), [None]))) for k, (doc, _) in enumerate(rows)]


def passages(rows, length=100):
    """[(id, bytes, removed, spans, digest)] by remembering every window."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def by_text(rows):
    return sorted(rows, key=str)
