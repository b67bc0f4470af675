"""Plain Python versions of the alignment, chat and trie queries, for small tables."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from brute import sha256


def by_conversation(turns):
    """turns: (conv_id, turn, role, text), in the order of the queries."""
    found = defaultdict(list)
    for conv, turn, role, text in turns:
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(rows)] for c, rows in found.items()}


def replay(log):
    """log: (conv_id, msg, seq, kind, role, at, cut, text); turns (role, text) by conversation."""
    messages = defaultdict(list)
    for conv, msg, seq, kind, role, at, cut, text in log:
        messages[conv, msg].append((seq, kind, text or "", role, at, cut))
    found = defaultdict(list)
    for (conv, _), events in messages.items():
        events.sort(key=lambda e: e[:3])
        said, roles = "", [e[3] or "" for e in events if e[1] == "open"]
        for _, kind, text, _, at, cut in events:
            if kind == "delta":
                said += text
            elif kind == "regenerate":
                said = ""
            elif kind == "edit":
                at, cut = max(at or 0, 0), max(cut or 0, 0)
                said = said[:at] + text + said[at + cut :]
        found[conv].append((events[0][0], roles[0] if roles else "", said))
    return {c: [m[1:] for m in sorted(ms)] for c, ms in found.items()}


def chat_rows(conversations):
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256) of conversations."""
    out = []
    for conv, turns in conversations.items():
        learnt = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        out.append((conv, len(turns), sha256(whole), len(learnt), sha256(learnt)))
    return out


def trie_rows(turns):
    own = by_conversation([t for t in turns if t[0] is not None])
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - c % 5, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append(
            (min(convs), len(path), parent, len(convs), children[path], leaves[path], saved[path], sha256(ends))
        )
    return out


def alignment_rows(docs, a_file, b_file):
    """docs: (doc_id, text). Links by comparing all byte ranges of a text, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_lib, b_lib = Tokenizer.from_file(a_file), sentencepiece.SentencePieceProcessor(model_file=b_file)
    a_lib.encode_special_tokens = True
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in keep}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)}

    def ranges(pieces):
        at, out = 0, []
        for p in pieces:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    texts = {}
    for k, (doc_id, text) in enumerate(docs):
        a = a_lib.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        a_bytes = [bytes(byte_of[c] for c in a_lib.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        whole = f" {text}".encode() if text else b""
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        ra, rb = ranges(a_bytes), ranges(b_bytes)
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        left, right, groups = list(zip(a, ra)), list(zip(b, rb)), []
        left.reverse(), right.reverse()
        for cut in cuts:
            groups.append(([], []))
            for tokens, group in zip((left, right), groups[-1]):
                while tokens and tokens[-1][1][1] <= cut:
                    group.append(tokens.pop()[0])
        links, j0 = [], 0
        for i, (s1, e1) in zip(a, ra):
            while j0 < len(rb) and rb[j0][1] <= s1:
                j0 += 1
            j = j0
            while j < len(rb) and rb[j][0] < e1:
                links.append((i, b[j]))
                j += 1
        texts[k] = doc_id, a, b, groups, links
    counts = Counter(pair for *_, links in texts.values() for pair in set(links))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    out = []
    for doc_id, a, b, groups, links in texts.values():
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append(
            (doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[0]] for p in links),
             sum(counts[p] for p in links), sha256(said) if said else "", sum(len(x) * len(y) for x, y in groups))
        )
    return out
