"""Plain single-process versions of the operators, written from the contracts alone."""

import hashlib
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def licenses(text):
    w = words(text)
    at, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def contamination(text, items):
    w = words(text)
    hit, found = set(), set()
    for item_id, item in items:
        v = words(item)
        n = min(10, len(v))
        for windows in ({tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else (),):
            for i in range(len(w) - n + 1):
                if windows and tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(str(item_id))
    return len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def shingle_set(text, size):
    w = space_words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1))


def near_duplicates(rows, size=3, percent=85):
    """{doc_id: (number of shingles, component)} by comparing all pairs that share a shingle."""
    sets = {d: shingle_set(t, size) for d, t in rows}
    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    both = defaultdict(int)
    for docs in by.values():
        for i, a in enumerate(docs):
            for b in docs[i + 1 :]:
                both[a, b] += 1
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def chat(turns):
    """Digests of one conversation from its (role, text) turns."""
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(loss), sha(loss)


def one_edit(a, b):
    """Whether exactly one inserted, deleted or replaced code point makes a into b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(counts):
    """{word: (form, root, n, n_near, form_n)} by comparing all pairs of words."""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    best = {w: min(((-counts[v], v) for v in vs), default=None) for w, vs in near.items()}
    form = {w: b[1] if b and -b[0] >= 2 * counts[w] else None for w, b in best.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def leaf(fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(hashes):
    """The root of a list of hashes, and for each its proof: (left, right) of every level."""
    proofs, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for proof, i in zip(proofs, at):
            run = hashes[i // 3 * 3 : i // 3 * 3 + 3]
            proof.append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        hashes = [sha("".join(hashes[i : i + 3])) for i in range(0, len(hashes), 3)]
        at = [i // 3 for i in at]
    return hashes[0], proofs


def manifest(rows):
    """[(key, group, leaf, subroot, root, proof)] of rows (key, group, leaf), sorted."""
    groups = defaultdict(list)
    for key, group, h in rows:
        groups[group].append((key is not None, key, h))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([h for *_, h in sorted(groups[g])]) for g in names}
    root, tops = tree([trees[g][0] for g in names])
    return sorted(
        ((key, g, h, trees[g][0], root, proof + top) for g, top in zip(names, tops) for (_, key, h), proof in zip(sorted(groups[g]), trees[g][1])), key=repr
    )
