"""Plain versions of the operators for small inputs, and awkward documents."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Score double, n_removed string"


def awkward(spark):
    """Nulls in every column, empty, white and very long texts, repeated rows, columns that clash with results."""
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    base = " ".join(f"w{i % 97}x{i % 13}" for i in range(60))
    texts = [None, "", " \t\n", "a", "Ä ß\u2003ü", passage, passage, f"start {passage} end", base, base.replace("w5x5", "zz"), base.upper(), "aaaa " * 400, " ".join(f"n{i}" for i in range(9000)), "x" * 120, "x" * 120, "The  end.\r\nNext\x0bline\x0cis <|endoftext|> here. "]
    rows = [(i * 3 % 47, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", None if t is None else len(t), 0.5, "old") for i, t in enumerate(texts)]
    rows += [rows[7], (None, passage, None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def shingles(text: str | None) -> set:
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(docs: list[tuple], percent: int) -> dict:
    """(id, text), ids distinct: smallest id reachable."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


LAST = np.iinfo(np.int64).max


def repeats(docs: list[tuple], length: int = 50) -> list[tuple]:
    """(id, text): id, bytes, removed, spans, sha256 of the rest."""
    docs = [(i, (t or "").encode()) for i, t in docs]
    least: dict[bytes, int] = {}
    for i, t in docs:
        k = LAST if i is None else i
        for s in range(len(t) - length + 1):
            least[t[s : s + length]] = min(k, least.get(t[s : s + length], k))
    out = []
    for i, t in docs:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if least[t[s : s + length]] < (LAST if i is None else i):
                gone[s : s + length] = True
        n = int(gone.sum())
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0]) if n else 0
        out.append((i, len(t), n, spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def katz(docs: list[tuple], cutoff: int = 5):
    """(text, train): the probability function, the vocabulary and the token lists."""
    from txnlake.llm.katz import Discount

    tokens = [[*words(t), b" end"] for t, _ in docs]
    train = [t for t, (_, learn) in zip(tokens, docs, strict=True) if learn]
    one = collections.Counter(w for t in train for w in t)
    two = collections.Counter(p for t in train for p in zip([b" start", *t], t, strict=False))
    of = lambda c: [sum(v == r for v in c.values()) for r in range(1, cutoff + 2)]
    d1, d2 = Discount(sum(one.values()), of(one)), Discount(sum(two.values()), of(two))
    after = collections.defaultdict(dict)
    for (h, w), n in two.items():
        after[h][w] = n

    def single(w):
        return float(d1.unigram(np.array([one[w]]))[0])

    def p(h, w):
        if h not in after:
            return single(w)
        total = sum(after[h].values())
        seen = {x: float(d2(np.array([n]))[0]) / total for x, n in after[h].items()}
        left, free = 1 - sum(seen.values()), 1 - sum(map(single, after[h]))
        if left <= 1e-9:
            return after[h][w] / (total + 1) if w in after[h] else single(w) / (total + 1) / free
        return seen[w] if w in seen else left / free * single(w)

    return p, one, tokens


def katz_score(p, tokens: list[bytes]) -> float:
    return sum(math.log10(p(h, w)) for h, w in zip([b" start", *tokens], tokens, strict=False))


def held(doc_id, remainder: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == remainder
