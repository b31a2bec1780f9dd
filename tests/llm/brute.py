"""Plain single-process versions of the contracts, to hold the Spark operators against."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
sha = lambda b: hashlib.sha256(b).hexdigest()


def words(text):
    return WORD.findall((text or "").encode())


def tokens(docs, tokenizer_path):
    """op2: docs is a list of (doc_id, text) in input order."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path)
    out, start = [], 0
    for key, text in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def decontaminate(docs, items, n=10):
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = defaultdict(set)
    for item, text in items:
        w = cut(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            wins[tuple(w[i:i + size])].add(item)
    sizes = {len(k) for k in wins}
    out = []
    for key, text in docs:
        w, hit, found = cut(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in wins:
                    hit.update(range(i, i + size))
                    found |= wins[tuple(w[i:i + size])]
        names = sorted(str(i) for i in found if i is not None)
        out.append((key, len(w), len(hit), len(names), sha(",".join(names).encode()), bool(hit)))
    return out


def repeats(docs, n=35):
    split = [(k, words(t)) for k, t in docs]
    count = Counter(tuple(w[i:i + n]) for _, w in split for i in range(len(w) - n + 1))
    out = []
    for key, w in split:
        gone = set()
        for i in range(len(w) - n + 1):
            if count[tuple(w[i:i + n])] > 1:
                gone.update(range(i, i + n))
        out.append((key, len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def base_counts(docs):
    """op7 without the method's verdict."""
    out = []
    for key, text in docs:
        w, text = words(text), text or ""
        lines = [x for x in text.split("\n") if words(x)]
        grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        rep = {i + j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(5)}
        failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
        out.append((key, len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(rep), failed))
    return out


def simhash(text):
    w = [x for x in WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))]
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, radius=3):
    """rows: (id, fingerprint); the smallest id linked to each row."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[root(i)] = min(low.get(root(i), key), key)
    return [low.get(root(i)) for i in range(len(rows))]


def simhash_groups(docs):
    rows = [(k, simhash(t)) for k, t in docs]
    return [(k, f"{f:016x}", c) for (k, f), c in zip(rows, components(rows), strict=True)]


def bpe(docs, path):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for key, text in docs:
        ids = enc.encode_ordinary(text or "")
        out.append((key, len(ids), sha(",".join(map(str, ids)).encode()), sha(enc.decode_bytes(ids))))
    return out


def warc(pages, least=1000):
    """pages: (page_id, html) in input order; of equal ids the first row is the response."""
    best, data = {}, [(k, (h or "").encode()) for k, h in pages]
    for n, (k, h) in enumerate(data):
        if len(h) >= least:
            best[h] = max(best.get(h, (-1, 0)), (-1 if k is None else k, -n))
    out = []
    for n, (k, h) in enumerate(data):
        other = h in best and best[h] != (-1 if k is None else k, -n)
        out.append((k, len(h), hashlib.sha1(h).hexdigest(), "revisit" if other else "response", best[h][0] if other and best[h][0] >= 0 else None))
    return out


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def url_rule(host, path, rules):
    fits = [(len(h) + len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def rules_from(baskets, support, confidence):
    """baskets: (tokens, verdict); every token set with its verdict, by plain counting."""
    from itertools import combinations
    every, labelled = Counter(), Counter()
    for toks, verdict in baskets:
        for size in range(1, len(toks) + 1):
            for c in combinations(sorted(toks), size):
                every[c] += 1
                labelled[c, verdict] += 1
    n = len(baskets)
    return {(c, v): (m / every[c], m / n) for (c, v), m in labelled.items() if m >= support * n and m / every[c] >= confidence}


def sentencepiece_ids(docs, path):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for key, text in docs:
        ids = lib.encode(text or "", add_bos=True, add_eos=True)
        out.append((key, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(lib.decode(ids).encode())))
    return out


def divergence(docs, documents=3, ranks=200):
    """op12 over dense tables: docs is a list of (lang, source, text)."""
    split = [(a or "", b or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for a, b, t in docs]
    out = []
    for lang in {a for a, _, _ in split}:
        mine = [(b, w) for a, b, w in split if a == lang]
        df = Counter(t for _, w in mine for t in set(w))
        kept = [t for t, n in df.items() if n >= documents]
        count = {b: Counter() for b, _ in mine}
        for b, w in mine:
            count[b].update(t for t in w if df[t] >= documents)
        every = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (c.total() + len(kept)) for t in kept}  # noqa: E731, B023
        p, q = {b: share(c) for b, c in count.items()}, share(every)
        f = lambda x, y: (x - y) ** 2 // y
        for b in count:
            pair = [(sum(f(p[b][t], p[o][t]) for t in kept), o) for o in count if o != b]
            term = [(f(p[b][t], q[t]), t) for t in kept if count[b][t] and p[b][t] > q[t]]
            for part, rows, most in (("pair", pair, None), ("term", term, ranks)):
                for rank, (v, item) in enumerate(sorted(rows, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.append((lang, b, part, item, v, rank))
    return out


def collocations(docs, least=30, longest=4, share=80, top=2000):
    """op13 by counting every phrase: docs is a list of (lang, text)."""
    count, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            count[lang].update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        found = [c for c, n in f.items() if len(c) > 1 and n >= least]
        rows = []
        for c in found:
            inside = [x for x in found if len(x) > len(c) and any(x[i:i + len(c)] == c for i in range(len(x) - len(c) + 1))]
            if any(100 * f[x] >= share * f[c] for x in inside):
                continue
            score, k = min((2_000_000 * f[c] // (f[c[:k]] + f[c[k:]]), k) for k in range(1, len(c)))
            rows.append((-score, -f[c], " ".join(c).encode(), f[c[:k]], f[c[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return out


def pipeline(docs, items, path, rules_keep):
    """docs: (doc_id, text) with distinct ids; rules_keep: ids that the quality rules keep."""
    docs = [d for d in docs if d[0] in rules_keep]
    docs = [(k, t) for (k, t), (_, _, c) in zip(docs, simhash_groups(docs), strict=True) if k == c]
    split = [(k, t, words(t)) for k, t in docs]
    count = Counter(tuple(w[i:i + 35]) for _, _, w in split for i in range(len(w) - 34))
    cut = []
    for k, t, w in split:
        gone = {i + j for i in range(len(w) - 34) if count[tuple(w[i:i + 35])] > 1 for j in range(35)}
        cut.append((k, b" ".join(x for i, x in enumerate(w) if i not in gone).decode() if gone else t))
    clean = [d for d, r in zip(cut, decontaminate(cut, items), strict=True) if not r[5]]
    return bpe(clean, path)
