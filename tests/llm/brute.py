"""Plain Python versions of the contracts, for small inputs."""

import itertools
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return set()
    if len(w) < 5:
        return {tuple(w)}
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near(rows):
    """doc_id -> (n_shingles, component) for (doc_id, text) rows with unique ids."""
    sets = {d: shingles(t) for d, t in rows}
    index = {}
    for d, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(d)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = set()
    for ds in index.values():
        for a, b in itertools.combinations(ds, 2):
            if (a, b) not in seen:
                seen.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def quality_counts(text):
    text = text or ""
    words = [m.group() for m in WORD.finditer(text)]
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
    }


def chunk_lines(text):
    """First and last line (exclusive) of every chunk."""
    from hashlib import md5

    h = lambda x: md5(x.encode()).hexdigest()
    lines = text.split("\n")
    at = [i for i, line in enumerate(lines) if WORD.search(line)]
    r = ["~"] + [h(h(lines[a]) + h(lines[b])) for a, b in zip(at, at[1:])]
    ends = [at[k + 1] for k in range(1, len(at) - 2) if r[k] < r[k - 1] and r[k] <= r[k + 1]]
    ends.append(len(lines))
    return lines, len(at), list(zip([0, *ends], ends))


def line_chunks(rows):
    """Cleaned texts of (doc_id, text) rows with unique ids."""
    docs = {d: None if t is None else chunk_lines(t) for d, t in rows}
    places = {}
    for d, found in docs.items():
        if found and found[1] >= 2:
            for a, b in found[2]:
                places.setdefault(tuple(found[0][a:b]), []).append((d, a, b))
    gone = {d: set() for d in docs}
    for at in places.values():
        (f, fa, fb), *others = sorted(at)
        theirs, chunks = docs[f][0], docs[f][2]
        f_low = max([a for a, b in chunks if b == fa], default=fa)
        f_high = min([b for a, b in chunks if a == fb], default=fb)
        for d, a, b in others:
            own, mine = docs[d][0], docs[d][2]
            low = max([x for x, y in mine if y == a], default=a)
            high = min([y for x, y in mine if x == b], default=b)
            i, j = a, fa
            while i > low and j > f_low and own[i - 1] == theirs[j - 1]:
                i, j = i - 1, j - 1
            k, m = b, fb
            while k < high and m < f_high and own[k] == theirs[m]:
                k, m = k + 1, m + 1
            gone[d].update(range(i, k))
    return {
        d: None if c is None else "\n".join(x for i, x in enumerate(c[0]) if i not in gone[d]) for d, c in docs.items()
    }
