"""Plain versions of the operators, for small inputs, and awkward documents."""

import re
from collections import Counter, defaultdict

import numpy as np

BLANK = re.compile(r"[\x20\x09-\x0D]+")
AWKWARD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _doc string, doc int, scores int, gone int, dropped int, _key int, n int, uid int"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(120_000))


def awkward_documents():
    """Nulls in every column, empty, blank and very long texts, repeated rows, one id with two texts, extra names."""
    extra = ("x", 1, 2, 3, 4, 5, 6, 7)
    shared = " ".join(f"shared{i}" for i in range(60))
    rows = [
        (1, f"first line\n{shared}\nlast line", "en", "a", 10),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, " \n\t\n ", "en", None, 5),
        (5, LONG, "en", "a", len(LONG)),
        (6, f"other words here\n{shared}\nand an end", "en", "b", 10),
        (6, f"other words here\n{shared}\nand an end", "en", "b", 10),
        (7, "one text of an id", "en", "c", 3),
        (7, "quite another text of it", "en", "c", 3),
        (None, shared, None, None, None),
        (None, None, None, None, None),
        (8, "word", "en", "c", 4),
        (9, "WORD", "en", "c", 4),
    ]
    return [row + extra for row in rows]


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def words(text):
    return [w for w in BLANK.split(text or "") if w]


def shingle_set(text, width):
    own = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words(text)]
    width = min(width, len(own))
    return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)} if own else set()


def near_components(texts, width):
    """texts: {doc_id: text}. Component of each."""
    sets = {k: shingle_set(v, width) for k, v in texts.items()}
    places = defaultdict(list)
    for k, own in sets.items():
        for shingle in own:
            places[shingle].append(k)
    shared = Counter((a, b) for own in places.values() for i, a in enumerate(own) for b in own[i + 1 :])
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    return roots(texts, links), {k: len(v) for k, v in sets.items()}


def without_repeats(texts, least=50):
    """texts: list of (doc_id, text) in order, ids and texts distinct. The texts without later repeated runs."""
    lines = [text.split("\n") for _, text in texts]
    solid = [[(i, line, len(words(line))) for i, line in enumerate(own) if words(line)] for own in lines]
    runs = defaultdict(list)
    for d, own in enumerate(solid):
        for a in range(len(own)):
            total = 0
            for b in range(a, len(own)):
                total += own[b][2]
                if total >= least:
                    runs[tuple(line for _, line, _ in own[a : b + 1])].append((d, own[a][0], own[b][0]))
                if total - own[a][2] >= least:  # the run without its first line is one as well
                    break
    gone = [set() for _ in texts]
    for found in runs.values():
        for d, a, b in sorted(found)[1:]:
            gone[d].update(range(a, b + 1))
    return ["\n".join(line for i, line in enumerate(own) if i not in out) for own, out in zip(lines, gone, strict=True)]


def vector_links(rows, cosine):
    """rows: list of (vec_id, vector, label), ids distinct. n_links and component of each."""

    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v, label in rows if label is not None and usable(v)}
    labels = {i: label for i, _, label in rows}
    links = [
        (a, b)
        for a in units
        for b in units
        if a < b and labels[a] == labels[b] and len(units[a]) == len(units[b]) and float(units[a] @ units[b]) >= cosine
    ]
    counts = Counter(x for link in links for x in link)
    found = roots([i for i, _, _ in rows], links)
    return {i: (counts[i], found[i]) for i, _, _ in rows}
