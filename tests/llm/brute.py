"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", low(text).encode())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> k & 1 for h in hashes) > len(hashes)) << k for k in range(64))


def components(rows):
    """rows: (doc_id, fingerprint). Lowest doc_id that links of two bits or fewer lead to."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, x in rows:
        for b, y in rows:
            if (x ^ y).bit_count() <= 2:
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {a: find(a) for a, _ in rows}


def contamination(docs, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    owners = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            owners.setdefault(tuple(w[s : s + window]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in owners}:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s : s + n])) in owners:
                    hit.update(range(s, s + n))
                    found |= owners[k]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def repeats(docs, width=200):
    seen = Counter(t[i : i + width] for _, t in docs for i in range(len(t) - width + 1))
    out = []
    for d, t in docs:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(bool(gone[i]) and (i == 0 or not gone[i - 1]) for i in range(len(t)))
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def lines(docs, least=20, least_docs=3):
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(d)
    out = []
    for d, t in docs:
        every = (t or "").split("\n")
        drop = lambda line: len(holders.get(key(line), ())) >= least_docs and d != max((h for h in holders[key(line)] if h is not None), default=None)
        kept = [line for line in every if not drop(line)]
        out.append((d, len(every), len(every) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def phrases(docs: list[tuple], longest: int, least: int, share: int, most: int) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of documents (text, lang)."""
    import re
    from collections import Counter

    f: Counter = Counter()
    for text, lang in docs:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            f.update((lang or "und", *w[i : i + d]) for d in range(1, longest + 1) for i in range(len(w) - d + 1))
    out = []
    for lang in {p[0] for p in f}:
        own = {p[1:]: a for p, a in f.items() if p[0] == lang}
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, _, x, y = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), a, x, y, score))
        n = sum(a for p, a in own.items() if len(p) == 1)
        out += [(lang, i + 1, p.decode(), a, x, y, n, score) for i, (_, _, p, a, x, y, score) in enumerate(sorted(rows)[:most])]
    return out


def alignment(docs: list[tuple], tokenizer, pieces) -> list[tuple]:
    """The rows of the token alignment of documents (doc_id, text), token by token."""
    import hashlib
    from collections import Counter, defaultdict
    from itertools import accumulate

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    tokenizer.encode_special_tokens = True
    rows, links, count = [], [], Counter()
    for doc, text in docs:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        of_a = [bytes(byte[c] for c in tokenizer.id_to_token(i)) for i in a]
        of_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [pieces.id_to_piece(i)]]
        if not text or b"".join(of_a) != b" " + text.encode() or b"".join(of_b) != b" " + text.encode():
            a, b, of_a, of_b = [], [], [], []
        ends = [list(accumulate(map(len, x))) for x in (of_a, of_b)]
        groups: dict = defaultdict(lambda: ([], []))
        cuts = sorted(set(ends[0]) & set(ends[1]))
        for side, ids in enumerate((a, b)):
            at = 0
            for i, e in zip(ids, ends[side]):
                while cuts[at] < e:
                    at += 1
                groups[cuts[at]][side].append(i)
        own = [(x, y) for c in cuts for x in groups[c][0] for y in groups[c][1]]
        count.update(set(own))
        links.append(own)
        spelled = ";".join(",".join(map(str, groups[c][0])) + "|" + ",".join(map(str, groups[c][1])) for c in cuts)
        rows.append([doc, len(a), len(b), len(cuts), len(own), hashlib.sha256(spelled.encode()).hexdigest() if a else ""])
    most: Counter = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [(*r[:5], sum(count[p] == most[p[0]] for p in own), sum(count[p] for p in own), r[5]) for r, own in zip(rows, links)]
