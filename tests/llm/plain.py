"""Plain versions of the operators, for small tables."""

import hashlib
import math
import re
from collections import Counter

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return [w for w in re.split("[ \t\n\x0b\x0c\r]+", text or "") if w]


def components(nodes, linked):
    """Smallest reachable node of each node."""
    label = {n: n for n in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                moved = True
    return label


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lower)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def jaccard_components(docs):
    """{doc_id: (n, component)} from {doc_id: text}."""
    sets = {i: shingles(t) for i, t in docs.items()}
    ids = sorted(sets)
    linked = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    label = components(ids, linked)
    return {i: (len(sets[i]), label[i]) for i in ids}


def substring_dedup(docs, width=13):
    first = {}
    for i in sorted(docs):
        w = words(docs[i])
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), i)
    out = {}
    for i, text in docs.items():
        w = words(text)
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    repeated = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return (
        len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(repeated),
    )


def norm_line(line):
    return " ".join(words(line)).lower()


def frequent_lines(rows, host, text, max_docs, max_share):
    """The normal forms of the lines of `text` that are frequent on its host and that
    another text keeps."""
    texts = {}
    for i, h, t in rows:
        if h == host and words(t):
            texts[t] = min(i, texts.get(t, i))
    lines = {t: {norm_line(x) for x in t.split("\n") if words(x)} for t in texts}
    out = set()
    for line in lines.get(text, ()):
        holders = [t for t in texts if line in lines[t]]
        if len(holders) > max_docs and len(holders) > max_share * len(texts):
            if min(holders, key=texts.get) != text:
                out.add(line)
    return out


def line_verdicts(rows, max_docs, max_share, max_removed):
    """{doc_id: kept} of (doc_id, host, text) rows with distinct ids."""
    kept = {}
    for i, host, text in rows:
        n = base_counts(text)
        if n[0] < 50 or 100 * n[4] > 50 * n[0]:
            kept[i] = False
            continue
        gone = frequent_lines(rows, host, text, max_docs, max_share)
        removed = sum(len(words(x)) for x in text.split("\n") if norm_line(x) in gone)
        kept[i] = n[0] - removed >= n[0] * (1 - max_removed)
    return kept


def without_lines(rows, doc_id, max_docs, max_share):
    """The text of a document without the lines that are frequent on its host."""
    host, text = next((h, t) for i, h, t in rows if i == doc_id)
    gone = frequent_lines(rows, host, text, max_docs, max_share)
    return "\n".join(x for x in text.split("\n") if norm_line(x) not in gone)


def vector_links(vectors, cosine=0.95):
    """{vec_id: (n_links, component)} of {vec_id: list or None}."""
    def usable(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ids = sorted(vectors)
    linked = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            u, v = vectors[a], vectors[b]
            if usable(u) and usable(v) and len(u) == len(v):
                dot = math.fsum(x * y for x, y in zip(u, v))
                norm = math.sqrt(math.fsum(x * x for x in u)) * math.sqrt(math.fsum(x * x for x in v))
                if dot / norm >= cosine:
                    linked.append((a, b))
    label = components(ids, linked)
    counts = Counter(x for pair in linked for x in pair)
    return {i: (counts[i], label[i]) for i in ids}


def rebuilt(rows):
    """{conv_id: ((role, text), ...)} of (conv_id, turn, role, text) rows."""
    import zlib

    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            text = text or ""
            digest = hashlib.sha256(text.encode()).hexdigest()
            key = (turn is not None, turn or 0, role or "", digest)
            own.setdefault(c, []).append((key, (role or "", text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        head = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        out[c] = tuple(own.get(base, [])[:head] + turns[head:])
    return out


def prefix_trie(rows):
    """Rows of the trie's nodes, sorted."""
    members, ends = {}, {}
    for c, path in sorted(rebuilt(rows).items()):
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(str(c))
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[p] for p in below) or 1
        saved[path] = sum(saved[p] for p in below) + (
            (len(members[path]) - 1) * len(words(path[-1][1])) if path else 0
        )
    return sorted((
        (
            members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]),
            len(children.get(p, [])), leaves[p], saved[p],
            hashlib.sha256(",".join(ends.get(p, [])).encode()).hexdigest(),
        ) for p in members
    ), key=repr)


def search(docs, items, top):
    """{item: [(doc_id, score), ...]} of (doc_id, text) rows and (item, text) rows."""
    def terms(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = {}
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * len(counts)) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if c[t]
            )
            if score > 0:
                scores.append((i, score))
        scores.sort(key=lambda s: (-s[1], s[0] is None, s[0] or 0))
        out[item] = scores[:top]
    return out
