"""Plain Python versions of what the queries must return, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter
from math import log10

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def warc(pages):
    """pages: (page_id, html)."""
    top: dict = {}
    for page_id, html in pages:
        top[html or ""] = max(top.get(html or "", -1), page_id)
    out = []
    for page_id, html in pages:
        data = (html or "").encode()
        response = top[html or ""]
        revisit = page_id != response
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", response if revisit else None))
    return sorted(out)


def edited(docs):
    """docs: (doc_id, text) with distinct ids; (doc_id, n_chars, sha256 of edited text)."""
    docs = sorted(((i, t or "") for i, t in docs), reverse=True)
    out = []
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        cut = len(text) // 3
        out.append((i, len(text), sha256(text[: len(text) - cut] + after[:cut])))
    return sorted(out)


def shingles(text, k=4):
    w = words(lower(text))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def jaccard_components(docs, k=4, percent=85):
    """docs: (doc_id, text); (doc_id, set size, smallest id reachable)."""
    sets = [(i, shingles(t, k)) for i, t in docs]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    low, high = sorted((root(i), root(j)))
                    parent[high] = low
    return sorted((i, len(s), root(i)) for i, s in sets)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def describe(spans):
    kinds = ("assign", "access", "hex")
    return ",".join(f"{kinds[kind]}:{start}:{end}" for start, kind, end in spans)


def quality(text):
    text = text or ""
    w = words(text)
    symbols = sum(c in "#*$%&|<>" for c in text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    covered = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, dups, len(covered), failed


END = ("end",)


def unigrams(docs):
    """docs: (doc_id, text); (doc_id, held_out, n_tokens, n_known, train_tokens, base_score)."""
    counts: Counter = Counter()
    for i, text in docs:
        if fold(i) != 1:
            counts.update([*words(lower(text)), END])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, text in docs:
        tokens = [*words(lower(text)), END]
        score = sum(log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        out.append((i, fold(i) == 1, len(tokens), sum(counts[t] > 0 for t in tokens), total, score))
    return sorted(out)


OWNED = re.compile(r"[A-Za-z0-9+/_-]{20,}", re.A)


def candidates(text):
    """(start, kind, end, value) of base spans and of key-like ones that touch none."""
    text = text or ""
    found = []
    for start, kind, end in base_spans(text):
        value = ASSIGN.match(text, start)[2] if kind == 0 else text[start:end]
        found.append((start, kind, end, value))
    for m in OWNED.finditer(text):
        free = all(m.end() <= start or end <= m.start() for start, _, end, _ in found)
        mixed = all(any(c in kind for c in m[0]) for kind in ("0123456789", LOWER, LOWER.upper()))
        if free and mixed:
            found.append((m.start(), 3, m.end(), m[0]))
    return found


LOWER = "abcdefghijklmnopqrstuvwxyz"


def judged_secrets(docs, min_owners=3, min_repos=8):
    """docs: (doc_id, owner, text); (start, kind, end, owners, repos, live) of each id.
    Equal texts count once, for the least owner and id."""
    of_text = {}
    for i, owner, text in docs:
        of_text[text] = min((owner, i), of_text.get(text, (owner, i)))
    owners, repos = {}, {}
    for text, (owner, i) in of_text.items():
        for *_, value in candidates(text):
            owners.setdefault(value, set()).add(owner)
            repos.setdefault(value, set()).add((owner, i))
    judged = {}
    for i, _, text in docs:
        for start, kind, end, value in candidates(text):
            n, m = len(owners[value]), len(repos[value])
            judged.setdefault(i, set()).add((start, kind, end, n, m, n < min_owners and m < min_repos))
    return {i: sorted(found) for i, found in judged.items()}


def live_secrets(docs, min_owners=3, min_repos=8):
    """Live spans of each id."""
    live = {i: [c[:3] for c in found if c[5]] for i, found in judged_secrets(docs, min_owners, min_repos).items()}
    return {i: spans for i, spans in live.items() if spans}


def masked(text, spans, mask="[secret]"):
    limit = len(text)
    for start, _, end in reversed(spans):
        text = text[:start] + mask + text[min(end, limit) :]
        limit = start
    return text


def mixed(docs, quality, cycle=(5, 2, 1), most=3, seed=7):
    """docs: (doc_id, source, text), quality by id; repeats of each id."""
    from math import floor, log

    sizes, rows = {}, {}
    for i, source, text in docs:
        n = len(words(text))
        u = (int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        weight = {1: 2.0, 0: 0.5}.get(quality.get(i), 1.0)
        rows.setdefault(source, []).append((-log(u) / weight, i, n))
        sizes[source] = sizes.get(source, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= most * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.remove(s)
    target |= share
    repeats = {}
    for s, members in rows.items():
        epochs = floor(target[s] / sizes[s]) if sizes[s] else 0
        rest, gone = target[s] - epochs * sizes[s], 0
        for _, i, n in sorted(members):
            repeats[i] = (epochs + (gone + n / 2 <= rest)) if n else 0
            gone += n
    return repeats
