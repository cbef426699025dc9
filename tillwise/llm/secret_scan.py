"""Secret scan: patterns propose candidates, a random forest removes false positives.

Candidates are values assigned to a credential word, strings in well-known key formats, passwords in
links, and long mixed strings.  Their features are lengths and character classes, how likely their
character transitions are in the corpus's own words, how much of them corpus words cover,
whether they look like a path or link, and the words around them.  A random forest learns
from labelled findings (candidate, text before, text after, label) and scores every
candidate; the driver fits it on at most ``TRAIN_ROWS`` findings, and tasks score with the
broadcast trees.

The corpus has no table of labelled findings, so :func:`labelled_findings` makes them with
Spark: for a bounded hash-chosen set of documents it sets key-like values, derived from the
document by digests, into credential contexts (label 1), and digests, identifiers, paths,
numbers and placeholders into harmless ones (label 0), between words of that document.
Labelled findings of one's own go to :func:`fit` in the same form.

Defined cases: null and empty texts have no findings; overlapping candidates count once (known
formats before assigned values before mixed strings, of which the parts outside them remain); equal findings in one text are findings of their own; without
labelled findings every candidate scores 0.5 and is kept as a secret; empty tables give no rows;
columns that have the name of a result are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import as_texts, hash_sample, map_arrow, most_frequent, slices, stored
from tillwise.llm.lm import count_words

#: Labelled findings that a fit uses at most; trees; depth; smallest node; score from which a candidate is a secret.
TRAIN_ROWS, TREES, DEPTH, LEAF, THRESHOLD = 6000, 30, 10, 2, 0.5
#: Words of the dictionary and their lengths; characters of context on either side; shortest value.
DICTIONARY, SHORT, LONG, CONTEXT, SHORTEST = 20_000, 3, 24, 48, 8
MASK = "[secret]"

# Words that name credentials, words that name harmless strings, and key formats.
CREDENTIAL_WORDS = (
    "token secret password passwd pwd passphrase apikey api_key api-key access_key access-key accesskey secret_key secretkey private_key "
    "auth authorization bearer credential credentials client_secret access_token auth_token"
).split()
HARMLESS_WORDS = "commit sha sha1 sha256 md5 checksum digest hash etag uuid guid id revision build version example sample placeholder image src href path file url isbn order invoice".split()
KEY_FORMATS = {
    "cloud_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "forge_token": r"\bgh[opsur]_[A-Za-z0-9]{36,}",
    "chat_token": r"\bxox[abprs]-[A-Za-z0-9-]{10,}",
    "payment_key": r"\b[rs]k_(?:live|test)_[A-Za-z0-9]{16,}",
    "map_key": r"\bAIza[0-9A-Za-z_-]{35}",
    "web_token": r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}",
}

# A password in a link: scheme, name, colon, password, at sign.
_LOGIN = re.compile(r"\b[a-zA-Z][a-zA-Z0-9+.-]{1,20}://[^\s:/@\"'`<>]{0,64}:([^\s:/@\"'`<>]{4,})@")
_FORMATS = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern in KEY_FORMATS.items()))
_KEY_LINE = re.compile(r"-----(BEGIN|END) [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
_KEY_BODY = re.compile(r"(?:[ \t]*+(?:[\r\n]|\\[nr])++[A-Za-z][A-Za-z-]{0,30}+:(?:(?!\\[nr])[^\r\n])*+)*+(?:[A-Za-z0-9+/=\s]++|\\[nrt])*+")
_ASSIGNED = re.compile(r"[=:][ \t]{0,3}[\"'`]?(?=[^\s\"'`<>(),;]{8})")
_VALUE = re.compile(r"[^\s\"'`<>(),;]+")
_NAMED = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*=(?=[^=])")
_MIXED = re.compile(r"[A-Za-z0-9+/_=.~-]{20,}")
_BEFORE = re.compile(r"([A-Za-z][A-Za-z_-]*)[\"'`]?\s{0,3}$")
_WORDS = re.compile(r"[A-Za-z0-9_-]+")
_DIGEST = re.compile(r"(?i)(?:sha-?\d*|md5|base64|etag|hash|blob)\W{1,4}$")
_KNOWN = frozenset(("private_key", *KEY_FORMATS))
_CREDENTIAL, _HARMLESS = frozenset(CREDENTIAL_WORDS), frozenset(HARMLESS_WORDS)


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(begin, end, kind) of the candidates of a text, in order and without overlap."""
    found = _private_keys(text) if "PRIVATE KEY" in text else []
    if _may_hold_key(text):
        found = sorted(found + [(m.start(), m.end(), m.lastgroup) for a, b in _outside(found, 0, len(text)) for m in _FORMATS.finditer(text, a, b)])
    if "://" in text:
        found = sorted(found + [(begin, end, "login") for m in _LOGIN.finditer(text) for begin, end in _outside(found, m.start(1), m.end(1)) if end - begin >= 4])
    found = sorted(found + [(begin, end, "assigned") for a, b in _assigned(text) for begin, end in _outside(found, a, b) if end - begin >= SHORTEST])
    mixed = []
    for a, b in _outside(found, 0, len(text)):
        for m in _MIXED.finditer(text, a, b):
            begin = _value_of(text, m.start(), m.end())
            if any(c.isdigit() for c in text[begin : m.end()]) and any(c.isalpha() for c in text[begin : m.end()]):
                mixed.append((begin, m.end(), "mixed"))
    return sorted(found + mixed)


def _private_keys(text: str) -> list[tuple[int, int, str]]:
    """Each BEGIN line to its END line; without one, as far as header lines, key characters and line breaks go."""
    out: list[tuple[int, int, str]] = []
    open_ = None
    for m in _KEY_LINE.finditer(text):
        if m[1] == "END":
            if open_:
                out.append((open_.start(), m.end(), "private_key"))
            open_ = None
        else:
            if open_:
                out.append((open_.start(), min(m.start(), _KEY_BODY.match(text, open_.end()).end()), "private_key"))
            open_ = m
    if open_:
        out.append((open_.start(), _KEY_BODY.match(text, open_.end()).end(), "private_key"))
    return out


def _assigned(text: str) -> list[tuple[int, int]]:
    """(begin, end) of the values that stand behind a credential word, in order and without overlap."""
    out: list[tuple[int, int]] = []
    run = 0  # end of the last value, sentence marks included
    for m in _ASSIGNED.finditer(text):
        before = _BEFORE.search(text, max(0, m.start() - CONTEXT), m.start())
        if before and any(w in _CREDENTIAL for w in _parts(before[1])):
            if m.end() >= run:
                run = _VALUE.match(text, m.end()).end()
            elif before.start(1) > out[-1][0]:
                continue  # inside a value that does not open with this name
            else:
                out.pop()
            out.append((m.end(), _trim(text, m.end(), run)))
    return out


def _outside(taken: list[tuple[int, int, str]], begin: int, end: int) -> Iterator[tuple[int, int]]:
    """The parts of a span that no candidate (in order, without overlap) takes."""
    for k in range(bisect_left(taken, begin, key=lambda t: t[1]), len(taken)):
        a, b, _ = taken[k]
        if a >= end:
            break
        if begin < a:
            yield begin, a
        begin = max(begin, b)
    if begin < end:
        yield begin, end


def _value_of(text: str, begin: int, end: int) -> int:
    """Where the value of NAME=value begins; a name is no part of it unless the value is too short to be one."""
    while (m := _NAMED.match(text, begin, end)) and end - m.end() >= SHORTEST:
        begin = m.end()
    return begin


def _may_hold_key(text: str) -> bool:
    return any(mark in text for mark in ("AKIA", "ASIA", "gh", "xox", "k_live_", "k_test_", "AIza", "eyJ"))


def _trim(text: str, begin: int, end: int) -> int:
    """Sentence marks at the end of an unquoted value are not part of it."""
    while end > begin + 1 and text[end - 1] in ".!?#$%&*|":
        end -= 1
    return end


def _parts(word: str) -> list[str]:
    low = word.lower()
    return [low, *re.split(r"[_-]", low)]


# features -----------------------------------------------------------------------------------

_CLASSES = 38  # letters, digits, other


def _codes(text: str) -> np.ndarray:
    low = np.frombuffer(text.lower().encode("ascii", "replace"), dtype=np.uint8)
    return np.where((low >= 97) & (low <= 122), low - 97, np.where((low >= 48) & (low <= 57), low - 48 + 26, 36)).astype(np.int64)


@dataclass(frozen=True)
class Language:
    """What the corpus's words look like: a dictionary and the log-probability of character transitions."""

    words: frozenset[str]
    transitions: np.ndarray

    @classmethod
    def of(cls, docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> Language:
        """From the most frequent plain words of all documents; their number and length bound what the driver gets."""
        words = count_words(docs, text).select(F.col("word").cast("string").alias("word"), "n").where(F.col("word").rlike(f"^[a-z]{{{SHORT},{LONG}}}$"))
        top = most_frequent(stored(words), size)
        counts = np.full((_CLASSES, _CLASSES), 0.5)
        for word, n in top:
            codes = np.concatenate(([37], _codes(word), [37]))
            np.add.at(counts, (codes[:-1], codes[1:]), float(n))
        return cls(frozenset(word for word, _ in top), np.log(counts / counts.sum(axis=1, keepdims=True)))

    @cached_property
    def longest(self) -> dict[str, int]:
        """Length of the longest word behind each beginning of ``SHORT`` letters."""
        out: dict[str, int] = {}
        for word in self.words:
            out[word[:SHORT]] = max(out.get(word[:SHORT], 0), len(word))
        return out

    def covered(self, text: str) -> float:
        """Share of the characters that dictionary words cover, longest word first from each place."""
        low, at, inside = text.lower(), 0, 0
        while at < len(low):
            for size in range(min(self.longest.get(low[at : at + SHORT], 0), len(low) - at), SHORT - 1, -1):
                if low[at : at + size] in self.words:
                    inside += size
                    at += size
                    break
            else:
                at += 1
        return inside / max(1, len(low))


FEATURES = (
    "length digits uppers lowers others entropy hex transition worst_transition changes covered path dots repeats "
    "credential_before harmless_before credential_near harmless_near quoted assigned known_format login words digest_before"
).split()


def features(language: Language, candidate: str, before: str, after: str, kind: str) -> np.ndarray:
    """The features of one candidate between the text before and after it."""
    own = candidate
    n = max(1, len(own))
    chars = np.frombuffer(own.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    _, counts = np.unique(chars, return_counts=True)
    share = counts / n
    digit, upper, lower = ((chars >= a) & (chars <= b) for a, b in ((48, 57), (65, 90), (97, 122)))
    codes = _codes(own)
    steps = language.transitions[codes[:-1], codes[1:]] if len(codes) > 1 else np.zeros(1)
    klass = digit * 1 + upper * 2 + lower * 3
    near_before = [p for w in _WORDS.findall(before)[-4:] for p in _parts(w)]
    near_after = [p for w in _WORDS.findall(after)[:3] for p in _parts(w)]
    last = _WORDS.findall(before)[-1:]
    directly = _parts(last[0]) if last else []
    return np.array(
        [
            np.log1p(n), digit.sum() / n, upper.sum() / n, lower.sum() / n, 1 - (digit | upper | lower).sum() / n,
            float(-(share * np.log2(share)).sum()), float(re.fullmatch(r"[0-9a-fA-F]+", own) is not None), float(steps.mean()), float(np.sort(steps)[: max(1, n // 4)].mean()),
            (klass[1:] != klass[:-1]).sum() / n, language.covered(own), float("/" in own or before.endswith(("/", "\\", "@")) or "://" in before[-24:]), own.count(".") / n, counts.max() / n,
            float(any(w in _CREDENTIAL for w in directly)), float(any(w in _HARMLESS for w in directly)), float(any(w in _CREDENTIAL for w in near_before)), float(any(w in _HARMLESS for w in near_before + near_after)),
            float(before[-1:] in "\"'`" and before != ""), float(kind == "assigned"), float(kind in _KNOWN),
            float(kind == "login"), float(len(re.findall(r"[A-Za-z]{3,}", own))), float(_DIGEST.search(before) is not None),
        ],
        dtype=np.float64,
    )


# the forest ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature (-1: leaf), threshold, children, share of label 1."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trees or not len(x):
            return np.full(len(x), 0.5)
        total = np.zeros(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while (inner := feature[at] >= 0).any():
                rows = np.flatnonzero(inner)
                node = at[rows]
                at[rows] = np.where(x[rows, feature[node]] <= threshold[node], left[node], right[node])
            total += share[at]
        return total / len(self.trees)


def _best_split(x: np.ndarray, y: np.ndarray, picked: np.ndarray, leaf: int) -> tuple[float, int, float]:
    """(impurity after it, feature, threshold) of the best split on the picked features."""
    best = (np.inf, -1, 0.0)
    n, ones = len(y), y.sum()
    for k in picked:
        order = np.argsort(x[:, k], kind="stable")
        value, label = x[order, k], np.cumsum(y[order])
        cut = np.flatnonzero(value[1:] > value[:-1]) + 1
        cut = cut[(cut >= leaf) & (cut <= n - leaf)]
        if len(cut):
            low, high = label[cut - 1], ones - label[cut - 1]
            impurity = low * (cut - low) / cut + high * (n - cut - high) / (n - cut)
            at = int(impurity.argmin())
            if impurity[at] < best[0]:
                below, above = float(value[cut[at] - 1]), float(value[cut[at]])
                middle = (below + above) / 2
                best = (float(impurity[at]), int(k), middle if middle < above else below)  # neighbouring numbers have no middle
    return best


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF, seed: int = 42) -> Forest:
    """Trees on bootstrap samples, each node splitting on the best of a random choice of features."""
    out = []
    for t in range(trees if len(y) else 0):
        rng = np.random.default_rng(seed + t)
        nodes: list[list] = []

        def node(rows: np.ndarray, level: int, nodes=nodes, rng=rng) -> int:
            at = len(nodes)
            own = y[rows]
            nodes.append([-1, 0.0, 0, 0, own.mean()])
            if level < depth and 0 < own.sum() < len(own):
                picked = rng.choice(x.shape[1], max(1, int(np.sqrt(x.shape[1]))), replace=False)
                gini, feature, threshold = _best_split(x[rows], own, picked, leaf)
                if feature >= 0 and gini < own.sum() * (len(own) - own.sum()) / len(own):
                    low = x[rows, feature] <= threshold
                    nodes[at][:2] = feature, threshold
                    nodes[at][2] = node(rows[low], level + 1)
                    nodes[at][3] = node(rows[~low], level + 1)
            return at

        node(rng.integers(0, len(y), len(y)), 0)
        feature, threshold, left, right, share = zip(*nodes, strict=True)
        out.append((np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(share)))
    return Forest(out)


@dataclass(frozen=True)
class Scanner:
    language: Language
    forest: Forest
    threshold: float = THRESHOLD

    def scan(self, text: str) -> list[tuple[int, int, str, float]]:
        """(begin, end, kind, score) of every candidate; those at or over the threshold are secrets."""
        found = candidates(text)
        if not found:
            return []
        x = np.stack([features(self.language, text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT], kind) for a, b, kind in found])
        return [(*f, float(s)) for f, s in zip(found, self.forest.score(x), strict=True)]


# labelled findings --------------------------------------------------------------------------

FINDING_SCHEMA = "candidate string, before string, after string, kind string, label int"


# What stands before a value ({w}: a word, in lower or upper case), and what closes it.
CREDENTIAL_CONTEXTS = [
    ('{w} = "', '"'), ("{w}: ", ""), ("{w}=", ""), ('"{w}": "', '",'), ("'{w}': '", "'"), ("export {W}=", ""), ("--{w}=", ""), ("--{w} ", ""),
    ("{W}=", " "), ("the {w} is ", "."), ("X-{w}: ", ""), ("<{w}>", "</{w}>"), ("my {w}: ", ""), ("{w} => '", "'"), ("https://example.org/?{w}=", ""), ("Authorization: Bearer ", ""),
    ('{w} := "', '"'), ("  {w}:  ", ""), ("set {w} to ", ","), ("SET_{W}=", ""), ("({w}=", ")"), ("curl -H '{w}: ", "'"), ("{W}: ", ""), ("{w} `", "`"),
]
HARMLESS_CONTEXTS = [
    ("{w} ", ""), ("{w}: ", ""), ("{w}=", ""), ('"{w}": "', '",'), ('{w} = "', '"'), ("({w} ", ")"), ('integrity="sha384-', '"'), ("data:image/png;base64,", '"'),
    ("{W}: ", ""), ("https://example.org/{w}/", ""), ("/usr/share/{w}/", ".so"), ("the {w} is ", "."), ("{w} `", "`"), ("at {w} ", ","), ('<img src="/', '.png"'), ("git checkout ", ""),
    ("sha256:", ""), ("v1.4.2-", ""), ("{w}/", ""), ("<{w}>", "</{w}>"), ("blob ", ""), ("index ", "..0"), ("ETag: W/", ""), ("{w}#", ""),
]
HOLDERS = "your_api_key_here changeme ${TOKEN} process.env.SECRET xxxxxxxxxxxxxxxx <your-token> EXAMPLE-KEY-1 REPLACE_ME os.environ[KEY] placeholder undefined my-secret-name {{secret}} ********".split()


def _made(seed: str, said: list[str], contexts: tuple[int, int] | None = None) -> tuple[str, str, str, str, int]:
    """One finding (candidate, before, after, kind, label) from a seed and the words of a document.

    A value is set into a context between words, and the candidate is what the scan itself finds there.  ``contexts`` as (step, rest)
    takes only contexts whose number leaves that rest, or with a rest below zero all others: findings for fitting and for testing.
    """
    hex_ = hashlib.sha256(seed.encode()).hexdigest()
    other = hashlib.sha256(hex_.encode()).hexdigest()
    base = re.sub("[^A-Za-z0-9]", "x", base64.b64encode(bytes.fromhex(other)).decode().rstrip("="))
    at, pick = int(hex_[:8], 16), int(other[:12], 16)
    word = lambda k: said[(at + k) % len(said)] if said else ""
    some = [w for w in (re.sub("[^A-Za-z]", "", word(k)).lower() for k in (3, 5, 7, 9)) if w] or ["plain", "words"]
    plain, number, year = "_".join(some), str(at % 9973), 1970 + at % 60
    dashed = "-".join((hex_[:8], hex_[8:12], hex_[12:16], hex_[16:20], hex_[20:32]))
    wrap = ("\n", "\\n")[at % 2]
    pem = lambda kind, *lines: wrap.join((f"-----BEGIN {kind}PRIVATE KEY-----", *lines, f"-----END {kind}PRIVATE KEY-----"))

    def choose(options: list, k: int):
        if contexts and options in (CREDENTIAL_CONTEXTS, HARMLESS_CONTEXTS):
            step, rest = contexts
            options = [o for n, o in enumerate(options) if (n % step == rest if rest >= 0 else n % step != -1 - rest)]
        return options[pick // 97**k % len(options)]

    word_of = lambda words: choose(words, 3).replace("_", ("_", "-", "")[pick % 3])
    family, label = choose(["value", "value", "value", "login", "format", "format", "pem", "passphrase", "hash", "hash", "hash", "name", "holder", "plain", "date"], 0), 1
    credential, (before, after) = word_of(CREDENTIAL_WORDS), choose(CREDENTIAL_CONTEXTS, 2)
    if family == "value":
        value = choose([hex_[:32], hex_[:40], other, base[:24], base, base[:14] + "_" + base[14:30], some[0][:6] + number + "!", some[0].title() + "#" + base[:6], base[:12], some[0][:7] + some[0][:7] + number[:1], dashed], 1)
    elif family == "passphrase":
        value = "-".join(w[:7] for w in some) + "-" + number
    elif family == "login":
        value, (before, after) = choose([base[:14], some[0].title() + number + "xY", base[:20], hex_[:24]], 1), (choose(["postgres", "https", "redis", "amqp", "mongodb+srv", "ftp"], 2) + f"://{some[-1][:8]}:", f"@{choose(['db', 'host.example.org', 'localhost:5432'], 4)}/x")
    elif family == "format":
        value = choose(["AKIA" + base[:16].upper(), "ghp_" + base[:36], "sk_live_" + base[:24], "xoxb-" + number + "-" + base[:20], "AIza" + base[:35]], 1)
        before, after = choose([(before, after), ("", ""), choose(HARMLESS_CONTEXTS, 2), ("export AWS_ACCESS_KEY_ID=", "")], 4)  # they are keys wherever they stand
    elif family == "pem":
        value = pem("RSA ", *(base[k:] + base[:k] for k in range(at % 40 + 2))) if at % 3 else pem("", base, base[:20])
        before, after = ('key = "', '"')
    else:
        label, (before, after), credential = 0, choose(HARMLESS_CONTEXTS, 2), word_of(HARMLESS_WORDS)
        if family == "hash":
            value = choose([hex_[:40], hex_, hex_[:32], dashed, base64.b64encode(bytes.fromhex(hex_ + other[:32])).decode(), base, base[:22]], 1)
        elif family == "name":
            value = choose([f"{plain}_{number}", f"{plain}.v2.tar.gz", f"https://example.org/{plain}/{hex_[:12]}", f"{some[0]}-{some[-1]}-{year}-{number}", f"{plain}/{hex_[:10]}/index.html"], 1)
        elif family == "date":
            value = choose([f"{year}-01-31T12:00:00.{number}", f"{year}0131120000000000x", f"978-3-16-{number}10-0-{year}x"], 1)
        else:  # in the place of a credential, and none
            value = choose(HOLDERS, 1) if family == "holder" else plain
            credential, (before, after) = word_of(CREDENTIAL_WORDS), choose(CREDENTIAL_CONTEXTS, 2)
            if family == "holder" and at % 4 == 0:
                value, before, after = choose(["password", "passwd", "secret", "xxxx"], 1), "https://user:", "@example.org"
    fill = lambda part: part.replace("{w}", credential).replace("{W}", credential.upper())
    head = f"{word(0)} {word(1)} {fill(before)}"
    whole = f"{head}{value}{fill(after)} {word(2)}"
    inside = [c for c in candidates(whole) if c[0] < len(head) + len(value) and c[1] > len(head)]
    if not inside:  # such a string is no candidate, so it teaches nothing but its own look
        return value, head, f"{fill(after)} {word(2)}", "mixed", label
    begin, end, kind = max(inside, key=lambda c: min(c[1], len(head) + len(value)) - max(c[0], len(head)))
    return whole[begin:end], whole[:begin], whole[end:], kind, label


def labelled_findings(docs: DataFrame, text: str = "text", id_column: str = "doc_id", rows: int = TRAIN_ROWS, contexts: tuple[int, int] | None = None) -> DataFrame:
    """At most ``rows`` findings between words of the documents chosen by id hash; ``contexts`` as in ``_made``.

    Few documents give several findings each, so that a small corpus teaches as much as a large one.
    """
    chosen = hash_sample(docs.select(F.xxhash64(id_column).alias("h"), id_column).where(F.col(id_column).isNotNull()), ["h"], rows).select(id_column, "h")
    known = chosen.collect()  # ids only, a bounded number
    each = max(1, rows // max(1, len(known)))
    ids = docs.sparkSession.createDataFrame(known, chosen.schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_made(f"{h}/{k}", t.split(), contexts) for h, t in zip(batch.column("h").to_pylist(), as_texts(batch.column("text")), strict=True) for k in range(each)]
            columns = zip(*made, strict=True) if made else [[]] * 5
            kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in FINDING_SCHEMA.split(", ")])

    some = docs.select(id_column, F.col(text).cast("string").alias("text")).join(F.broadcast(ids), id_column)
    return map_arrow(some.select("h", "text"), apply, FINDING_SCHEMA).limit(rows)


def fit(findings: DataFrame, language: Language, rows: int = TRAIN_ROWS, trees: int = TREES, threshold: float = THRESHOLD) -> Scanner:
    """A scanner whose forest learnt from at most ``rows`` labelled findings (chosen by hash)."""
    columns = ["candidate", "before", "after", "kind", "label"]
    some = hash_sample(findings.select(*columns).where("candidate IS NOT NULL AND label IN (0, 1)"), columns, rows).collect()
    some.sort(key=str)  # the forest must not follow the order in which rows arrive
    x = np.array([features(language, r["candidate"], r["before"] or "", r["after"] or "", r["kind"] or "") for r in some]).reshape(-1, len(FEATURES))
    return Scanner(language, grow(x, np.array([r["label"] for r in some], dtype=np.float64), trees), threshold)


# scanning -----------------------------------------------------------------------------------


def scan(docs: DataFrame, scanner: Scanner, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row a candidate: the columns ``keep`` (default: all others), begin, end (characters), kind, candidate, score, is_secret."""
    results = ("begin", "end", "kind", "candidate", "score", "is_secret")
    keep = [c for c in (docs.columns if keep is None else keep) if c != text and c not in results]
    shared = docs.sparkSession.sparkContext.broadcast(scanner)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own, found, values = [], [], []
                for k, one in enumerate(as_texts(part.column("text"))):
                    for f in shared.value.scan(one):
                        own.append(k)
                        found.append(f)
                        values.append(one[f[0] : f[1]])
                if own:
                    begin, end, kind, score = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(f"kept{k}").take(pa.array(own)) for k in range(len(keep))), pa.array(begin, pa.int32()), pa.array(end, pa.int32()), pa.array(kind), pa.array(values), pa.array(score), pa.array([s >= shared.value.threshold for s in score])],
                        [*keep, "begin", "end", "kind", "candidate", "score", "is_secret"],
                    )

    source = docs.select(*(F.col(c).alias(f"kept{k}") for k, c in enumerate(keep)), F.col(text).cast("string").alias("text"))
    schema = T.StructType([*(docs.schema[c] for c in keep), *T._parse_datatype_string("begin int, end int, kind string, candidate string, score double, is_secret boolean").fields])
    return map_arrow(source, apply, schema)


def masked(text: str, found: list[tuple[int, int, str, float]], threshold: float, mask: str = MASK) -> str:
    out, at = [], 0
    for begin, end, _, score in found:
        if score >= threshold:
            out += (text[at:begin], mask)
            at = end
    return "".join((*out, text[at:])) if at else text


def mask_secrets(docs: DataFrame, scanner: Scanner, text: str = "text", length: str = "n_chars", mask: str = MASK) -> DataFrame:
    """All documents, with each secret replaced by ``mask``; a column ``length`` follows changed texts (null stays null)."""
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    names, place = docs.columns, docs.columns.index(text)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                told = part.column(text).to_pylist()
                now = [t and masked(t, shared.value.scan(t), shared.value.threshold, mask) for t in told]
                columns = list(part.columns)
                columns[place] = pa.array(now, part.schema.field(text).type)
                if length in names:
                    at = names.index(length)
                    kept = columns[at].to_pylist()
                    columns[at] = pa.array([k if k is None or new == old else len(new) for k, new, old in zip(kept, now, told, strict=True)], columns[at].type)
                yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(docs, apply, docs.schema)


def default_scanner(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> Scanner:
    """A scanner with the corpus's own language and the labelled findings made from it."""
    return fit(labelled_findings(docs, text, id_column), Language.of(docs, text))
