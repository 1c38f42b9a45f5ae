"""Brute-force versions of the operators: plain Python over all rows, no shared code with the library."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_id(row):
    return (row[0] is None, row[0] or 0)


def repeated_words(docs, length=20):
    """(doc_id, n_words, n_removed, sha256) by document; a window goes if the same starts earlier."""
    first, texts = {}, [(d, SPACE.findall(t or "")) for d, t in docs]
    for d, words in sorted(texts, key=by_id):
        for i in range(len(words) - length + 1):
            first.setdefault(tuple(words[i : i + length]), (by_id((d,)), i))
    out = []
    for d, words in texts:
        gone = set()
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < (by_id((d,)), i):
                gone.update(range(i, i + length))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def repeated_bytes(docs, length=400):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) by document; a string goes if the same starts elsewhere."""
    texts = [(d, (t or "").encode()) for d, t in docs]
    counts = Counter(hashlib.md5(t[i : i + length]).digest() for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if counts[hashlib.md5(t[i : i + length]).digest()] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(t) else 0
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text, n=3):
    words = SPACE.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def simhash_components(docs, n=3, distance=2):
    """(doc_id, fingerprint, component_id) by document."""
    prints = [(d, simhash(t, n)) for d, t in docs]
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= distance:
                label[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(prints):
        least[root(i)].append(d)
    names = {r: min((d for d in ds if d is not None), default=None) for r, ds in least.items()}
    return [(d, f"{p:016x}", names[root(i)]) for i, (d, p) in enumerate(prints)]


def gram_set(words, n):
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}


def leaks(docs, items, threshold=0.8, n=5):
    """(doc_id, item_id, shared) of every document and item it holds; a short item is one shingle of its own length."""
    sets = [(i, w, min(n, len(w))) for i, t in items if (w := ALNUM.findall((t or "").translate(LOWER)))]
    out = []
    for d, t in docs:
        words = ALNUM.findall((t or "").translate(LOWER))
        own = {m: gram_set(words, m) for m in {m for *_, m in sets}}
        for i, w, m in sets:
            s = gram_set(w, m)
            if len(s & own[m]) >= math.ceil(threshold * len(s) - 1e-9):
                out.append((d, i, len(s & own[m])))
    return out


def draws(key, tree):
    """The shard of a key by a tree of (region, rack, shard, weight)."""

    def signed(v):
        return v - (1 << 64) if v >= 1 << 63 else v

    def draw(path, weight):
        h = xxhash.xxh64_intdigest(key.encode(), xxhash.xxh64_intdigest(path.encode(), 42))
        return math.log(((h >> 11) + 0.5) / 2**53) / weight

    regions, racks = defaultdict(float), defaultdict(float)
    for region, rack, _, w in tree:
        regions[region] += w
        racks[region, rack] += w
    region = max(regions, key=lambda r: (draw(f"/{r}", regions[r]), r))
    of = [k for r, k in racks if r == region]
    rack = max(of, key=lambda k: (draw(f"{region}/{region}/{k}", racks[region, k]), k))
    path = f"{region}/{rack}"
    return max((draw(f"{path}/{s}", w), str(s), s) for r, k, s, w in tree if (r, k) == (region, rack))[2]


def phrase_places(words, phrases):
    return [(i, p) for p in phrases for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]


def signed_hash(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >= 1 << 63 else h


def in_fifth(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


def secrets(text, known_only=False, ratio=1.8, vocabulary="/opt/tokenizers/byte_bpe_50k.tiktoken"):
    """(start, end, kind) of the spans of one text, by scanning from every place."""
    text, found = text or "", []
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    value, key = set(letters + "0123456789+/_.=-"), set(letters + "0123456789+/_=-")
    low = text.translate(LOWER)

    def run(at, of):
        end = at
        while end < len(text) and text[end] in of:
            end += 1
        return end

    at = 0
    while at < len(text):
        word = next((w for w in ("password", "passwd", "secret", "token", "apikey", "api_key") if low.startswith(w, at)), None)
        end = None
        if word:
            i = at + len(word)
            i += i < len(text) and text[i] in "\"'"
            while i < len(text) and text[i] == " ":
                i += 1
            if i < len(text) and text[i] in ":=":
                i += 1
                while i < len(text) and text[i] == " ":
                    i += 1
                i += i < len(text) and text[i] in "\"'"
                end = run(i, value)
                if end - i >= 6:
                    found.append((at, end, "assign"))
                end = end if end > i else None
        at = end or at + 1
    for kind, start, of, least in (("access", "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20), ("hex", "", set("0123456789abcdef"), 24)):
        at = 0
        while at < len(text):
            end = run(at + len(start), of) if text.startswith(start, at) else at
            if end > at + len(start):
                if end - at >= least:
                    found.append((at, end, kind))
                at = end
            else:
                at += 1
    order = ["assign", "access", "hex", "token"]
    if not known_only:
        import base64

        import tiktoken

        with open(vocabulary, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding("brute", pat_str=r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+", mergeable_ranks=ranks, special_tokens={})
        base, at = list(found), 0
        while at < len(text):
            end = run(at, key)
            core = text[at:end].strip("+/_=-")
            start = at + len(text[at:end]) - len(text[at:end].lstrip("+/_=-"))
            at = max(end, at + 1)
            if len(core) < 20 or any(a <= start and start + len(core) <= b for a, b, _ in base):
                continue
            hexes = core.strip("0123456789abcdef") == "" or core.strip("0123456789ABCDEF") == ""
            if hexes and len(core) in (32, 40, 56, 64, 96, 128):
                continue
            if re.fullmatch(r"[0-9][0-9/_-]*", core) or re.fullmatch(r"sha(256|384|512)-[A-Za-z0-9+/]+", core):
                continue
            if re.fullmatch("-".join(f"[0-9A-Fa-f]{{{n}}}" for n in (8, 4, 4, 4, 12)), core):
                continue
            tokens = sum(len(encoding.encode(core[i : i + 256])) for i in range(0, len(core), 256))
            if len(core) / tokens < ratio:
                found.append((start, start + len(core), "token"))
    return sorted(found, key=lambda s: (s[0], order.index(s[2]), s[1]))


def collocations(docs, least=100, longest=5, covered=100, most=2000):
    """(lang, rank, phrase, a, l, r, n, score) of the phrases of (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang or "und", tuple(words[i : i + m])] += 1
    out = defaultdict(list)
    inside = defaultdict(int)
    for (lang, words), a in f.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                part = lang, words[i : i + m]
                inside[part] = max(inside[part], a if a >= least else 0)
    for (lang, words), a in f.items():
        if len(words) < 2 or a < least or (inside[lang, words] and 100 * inside[lang, words] >= covered * a):
            continue
        cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((1000 * a * n[lang] // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return [
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:most], 1)
    ]


def vector_codes(rows, entries=16, rounds=6, parts=8, scale=4096):
    """(vec_id, code, error, label_error) of (vec_id, vector, label), and the codebooks; vectors are of one length."""
    kept = [
        (i, [math.floor(scale * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = len(kept[0][1]) if kept else 0
    cuts = [(width * p // parts, width * (p + 1) // parts) for p in range(parts)]
    least = {}
    for i, v, _ in kept:
        least[by_id((i,))] = min(least.get(by_id((i,)), v), v)
    first = [v for _, v in sorted(least.items())][:entries]
    books = [[v[a:b] for v in first] for a, b in cuts]

    def nearest(p, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds if kept else 0):
        for p, (a, b) in enumerate(cuts):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[nearest(p, v[a:b])[1]].append(v[a:b])
            for e, members in groups.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out, errors = [], defaultdict(int)
    for i, v, label in kept:
        best = [nearest(p, v[a:b]) for p, (a, b) in enumerate(cuts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
        errors[label] += out[-1][2]
    return [(i, code, error, errors[label]) for i, code, error, label in out], books
