"""What several tests compare with: fingerprints and their components by all pairs, the tokenizer's own library."""

import base64
import re

import public_tokenizers
import tiktoken
import xxhash

from tillwise.llm import queries

WHERE = public_tokenizers.path(queries.RANKS)
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(WHERE, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    parts = [" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(docs, radius=2):
    """doc id -> (hex fingerprint, smallest id reachable), by comparing all pairs."""
    marks = [(i, fingerprint(t)) for i, t in docs]
    root = list(range(len(marks)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(marks)):
        for b in range(a):
            if bin(marks[a][1] ^ marks[b][1]).count("1") <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (i, _) in enumerate(marks):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i is None, i or 0, format(m, "016x"), least.get(find(k))) for k, (i, m) in enumerate(marks))
