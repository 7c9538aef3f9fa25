"""Plain Python versions of the corpus operators."""

import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return SPACE.findall(text or "")


def plain_words(text):
    return PLAIN.findall(ascii_lower(text))


def grams(text, k):
    w = SPACE.findall(ascii_lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1)))


def components(texts, k, percent):
    """texts: {id: text}. Smallest id reachable by links."""
    sets = {i: grams(t, k) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            one, two = sets[a], sets[b]
            if one and two and 100 * len(one & two) >= percent * len(one | two):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


def without_repeats(texts, window):
    """{id: (n_words, kept words)}."""
    first = {}
    for i in sorted(texts):
        w = words(texts[i])
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p : p + window]), i)
    out = {}
    for i, t in texts.items():
        w, gone = words(t), set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        out[i] = len(w), [x for p, x in enumerate(w) if p not in gone]
    return out


def hits(text, items, window):
    """(n_words, n_hit, item ids) of one text against {item_id: text}."""
    w, covered, found = plain_words(text), set(), set()
    for item, phrase in items:
        v = plain_words(phrase)
        for s in range(max(len(v) - window + 1, 1) if v else 0):
            part = v[s : s + window]
            for p in range(len(w) - len(part) + 1):
                if w[p : p + len(part)] == part:
                    covered.update(range(p, p + len(part)))
                    found.add(item)
    return len(w), len(covered), found


def text_statistics(text):
    text = text or ""
    w = words(text)
    triples = {}
    for i in range(len(w) - 2):
        triples.setdefault(tuple(w[i : i + 3]), []).append(i)
    repeated = {j for places in triples.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": again,
        "n_repeat_words": len(repeated),
    }
