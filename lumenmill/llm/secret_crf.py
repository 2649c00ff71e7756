"""Secret scan: fixed base patterns, and a linear-chain conditional random field for the rest.

The field tags the white-space tokens of a line as begin, inside or outside of a secret from a token's shape,
its neighbours and features of the file; Viterbi gives the best tags. A line whose tokens cannot lift any
tag above outside, by a bound on all transitions, is outside as a whole, and the recursion is skipped there
without changing its result. Base spans always stay; spans of the field that overlap one are left out.

Training takes at most ``max_train_docs`` documents (smallest id hashes), whole; the base patterns label them. Every window of ``WIDTH`` tokens with a base span counts,
``CLEAN`` windows without one, and ``PLANTED`` more with a synthetic secret, from a fixed seed.
Scanning covers every whole text; null and empty texts have no spans;
repeated rows are scanned each; an empty table gives none. Extra columns are ignored. A task holds ``BATCH`` bytes of texts, or one longer text, and the scores of ``TOKENS`` tokens."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import string
import zlib
from bisect import bisect_left, bisect_right
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage

KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX24 = re.compile(r"[0-9a-f]{24,}")
_HEXMAP = bytes(120 if c in b"0123456789abcdef" else 32 for c in range(256))
_KEYS = (b"passw", b"secret", b"token", b"api")
KEYWORD = re.compile(r"pass|pwd|secret|token|key|auth|bearer|credential|private|access", re.I | re.A)
URL_PASSWORD = re.compile(r"://[^/@:\s]*:([^@/\s]{6,})@")
OUT, BEGIN, INSIDE = 0, 1, 2
SLOTS = 1 << 14
BATCH, TOKENS = 1 << 20, 300_000


def base_spans(raw: bytes, text: str | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in code points, by start, then kind. The byte tests before each pattern are necessary for a match."""
    out = []
    low = raw.lower()
    if any(k in low for k in _KEYS):
        text = raw.decode() if text is None else text
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        text = raw.decode() if text is None else text
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if b"x" * 24 in raw.translate(_HEXMAP):
        text = raw.decode() if text is None else text
        out += [(m.start(), 2, m.end()) for m in _HEX24.finditer(text)]
    return sorted(out)


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % SLOTS


def value_part(token: str) -> tuple[int, int]:
    """Where the secret would stand in a token: between user and host of a URL, else after the last = or : that is followed by a value, without quotes and closing marks."""
    lo, hi = 0, len(token)
    if found := URL_PASSWORD.search(token):
        return found.span(1)
    while hi > lo and token[hi - 1] in "\"'`.,;:!?)]}>*|%$#&":
        hi -= 1
    for i in range(hi - 7, lo - 1, -1):
        if token[i] in "=:" and KEYWORD.search(token[lo:i]):
            lo = i + 1
            break
    while lo < hi and token[lo] in "\"'`([{<":
        lo += 1
    return lo, hi


_PLAIN: dict[str, dict[str, list[int]]] = {}


def plain_word(token: str) -> str:
    """The class of a word of fewer than 20 letters, without a key word, between marks; nothing for other tokens."""
    core = token.strip("\"'`.,;:!?()[]{}<>*|%$#&=-")
    if not core.isalpha() or len(core) >= 20 or KEYWORD.search(core):
        return ""
    return f"{len(core) // 4}{'l' if core.islower() else 'u' if core.isupper() else 't' if core.istitle() else 'm'}{'e' if token[-1] in '=:' else 'n'}"


def token_features(token: str) -> dict[str, list[int]]:
    """Slots of what a token says about itself, about the next token (seen as previous) and about the one before."""
    if name := plain_word(token):
        return _PLAIN.setdefault(name, {"own": [_slot(f"w:{name}")], "before": [_slot(f"bw:{name[-1]}")], "after": [_slot("aw:")]})
    lo, hi = value_part(token)
    v = token[lo:hi]
    digits, lower, upper = sum(c.isdigit() for c in v), sum("a" <= c <= "z" for c in v), sum("A" <= c <= "Z" for c in v)
    n = len(v)
    mix = f"{digits > 0:d}{lower > 0:d}{upper > 0:d}{digits + lower + upper < n:d}"
    kind = "hex" if n and re.fullmatch("[0-9a-f]+", v) and digits and lower else "b64" if n and re.fullmatch(r"[A-Za-z0-9+/_.=-]+", v) else "other"
    size = min(n, 64) // 4 if n < 16 else 4 + min(n, 64) // 8
    swaps = sum((a.isdigit() != b.isdigit()) or (a.isupper() != b.isupper()) for a, b in zip(v, v[1:], strict=False))
    turn = min(9, 20 * swaps // max(1, n)) if n >= 8 else -1
    shape = f"{mix}{kind}"
    key = bool(KEYWORD.search(token[:lo] if lo else token))
    own = [f"s:{shape}", f"l:{size}", f"sl:{shape}{size}", f"t:{turn}", f"tl:{turn},{size},{mix}", f"k:{key},{lo > 0}", f"q:{token[:1] in chr(34) + chr(39)},{lo > 0}", f"u:{bool(URL_PASSWORD.search(token))},{turn > 2}", f"p:{token[:4] if kind != 'hex' and n >= 16 and digits else ''}"]
    mark = "=" if token in ("=", ":", ":=") else "e" if token[-1:] in ("=", ":") else "n"
    word = KEYWORD.search(token)
    before = [f"b:{mark},{word[0].lower() if word and n < 24 else ''}", f"bm:{mark}", f"bs:{mix}"]
    after = [f"a:{mix}", f"a:{mark}"]
    return {"own": [_slot(x) for x in own], "before": [_slot(x) for x in before], "after": [_slot(x) for x in after]}


def file_features(raw: bytes) -> list[int]:
    n = max(1, len(raw))
    digits = sum(map(raw.count, (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9")))
    return [_slot(f"f:d{min(9, 100 * digits // n)}"), _slot(f"f:c{any(c in raw for c in (b'{', b'};', b'():'))}"), _slot(f"f:k{any(k in raw for k in (b'=', b'://'))}")]


class Field:
    """Weights by slot and tag, and transitions; inside follows begin or inside only."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.w, self.moves = weights, moves
        self.reset()

    def reset(self) -> None:
        self.ids: dict[bytes, int] = {b"\x01": 0}
        self.plain: dict[str, int] = {}
        self.size = 1
        self.table = np.zeros((1 << 12, 3, 3), np.float32)  # own, as previous, as next
        self.table[0] = [[0, 0, 0], self.w[_slot("b:<s>")], self.w[_slot("a:<s>")]]

    def id(self, token: bytes) -> int:
        text = token.decode("utf-8")
        name = plain_word(text)
        if name and name in self.plain:
            self.ids[token] = self.plain[name]
            return self.plain[name]
        f = token_features(text)
        if self.size == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[self.size] = [self.w[f["own"]].sum(0), self.w[f["before"]].sum(0), self.w[f["after"]].sum(0)]
        self.ids[token] = self.size
        if name:
            self.plain[name] = self.size
        self.size += 1
        return self.size - 1

    def look_up(self, words: list[bytes]) -> np.ndarray:
        if len(self.ids) > TOKENS:
            self.reset()
        for w in set(words).difference(self.ids):
            self.id(w)
        return np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))

    def lines_of_interest(self, docs: list[bytes]) -> dict[int, list[tuple[int, list[bytes], np.ndarray]]]:
        """By document: (byte offset, tokens, emission scores) of every line that is not outside throughout by the bound."""
        words: list[bytes] = [b"\x01"]
        place: list[tuple[int, int, int]] = []  # document, line, first token
        for d, raw in enumerate(docs):
            for k, line in enumerate(raw.replace(b"\x01", b"\x02").split(b"\n")):
                got = line.split()
                if got:
                    place.append((d, k, len(words)))
                    words += got
                    words.append(b"\x01")
        ids = self.look_up(words)
        e = self.table[ids, 0].copy()
        e[1:] += self.table[ids[:-1], 1]
        e[:-1] += self.table[ids[1:], 2]
        starts = np.array([p[2] for p in place], np.int64)
        docs_of = np.array([p[0] for p in place], np.int64)
        per_doc = np.array([self.w[file_features(x)].sum(0) for x in docs], np.float32).reshape(-1, 3)
        gain = np.maximum(e[:, 1], e[:, 2]) - e[:, 0]
        lift = np.maximum(per_doc[:, 1], per_doc[:, 2]) - per_doc[:, 0]
        best = np.maximum.reduceat(gain, starts) if len(starts) else np.zeros(0)
        out: dict[int, list] = {}
        offsets: dict[int, list[int]] = {}
        for i in np.flatnonzero(best + lift[docs_of] + self.bound() > 0).tolist():
            d, k, at = place[i]
            if d not in offsets:
                sizes = [len(x) + 1 for x in docs[d].split(b"\n")]
                offsets[d] = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            end = place[i + 1][2] - 1 if i + 1 < len(place) else len(words) - 1
            out.setdefault(d, []).append((offsets[d][k], words[at:end], e[at:end] + per_doc[d]))
        return out

    def bound(self) -> float:
        """No token in a secret can gain more from the moves around it than this."""
        m = self.moves
        gains = [m[OUT, BEGIN] - m[OUT, OUT], m[BEGIN, OUT] - m[OUT, OUT], m[INSIDE, OUT] - m[OUT, OUT], m[BEGIN, INSIDE] - m[OUT, OUT], m[INSIDE, INSIDE] - m[OUT, OUT], m[BEGIN, BEGIN] - m[OUT, OUT], m[INSIDE, BEGIN] - m[OUT, OUT], 0.0]
        return 2 * float(max(gains))

    def viterbi(self, e: np.ndarray) -> list[int]:
        score = e[0] + np.array([0, 0, -1e9])
        back = np.zeros((len(e), 3), np.int8)
        for t in range(1, len(e)):
            step = score[:, None] + self.moves
            back[t] = step.argmax(0)
            score = step.max(0) + e[t]
        tags = [int(score.argmax())]
        for t in range(len(e) - 1, 0, -1):
            tags.append(int(back[t, tags[-1]]))
        return tags[::-1]

    def spans(self, raw: bytes, lines: list[tuple[int, list[bytes], np.ndarray]]) -> list[tuple[int, int]]:
        out, held = [], raw.replace(b"\x01", b"\x02")
        seen = points = 0

        def point(at: int) -> int:
            """Code points before a byte; bytes are asked for in rising order."""
            nonlocal seen, points
            points += len(raw[seen:at].decode())
            seen = at
            return points

        for at, tokens, e in lines:
            tags = self.viterbi(e)
            if not any(tags):
                continue
            places, p = [], at
            for t in tokens:
                p = held.index(t, p)
                places.append(p)
                p += len(t)
            i = 0
            while i < len(tags):
                if tags[i] != BEGIN:
                    i += 1
                    continue
                j = i + 1
                while j < len(tags) and tags[j] == INSIDE:
                    j += 1
                first, last = tokens[i].decode(), tokens[j - 1].decode()
                lo, hi = value_part(first)
                start = point(places[i]) + lo
                end = start - lo + hi if j == i + 1 else point(places[j - 1]) + value_part(last)[1]
                if end > start:
                    out.append((start, end))
                i = j
        return out


def synthetic_secrets(rng: random.Random) -> list[str]:
    """Tokens of one planted secret."""
    alnum, b64 = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"

    def some(chars: str, lo: int, hi: int) -> str:
        return "".join(rng.choice(chars) for _ in range(rng.randint(lo, hi)))

    value = rng.choice([some(alnum, 20, 44), some(b64, 32, 64) + "==", some("0123456789abcdef", 32, 64), "AKIA" + some(string.ascii_uppercase + string.digits, 16, 16), "ghp_" + some(alnum, 36, 36), "sk-" + some(alnum, 32, 48), "eyJ" + some(alnum, 30, 60) + "." + some(alnum, 30, 60)])
    if (form := rng.random()) < 0.08:  # a password in a URL
        return [f"{some(string.ascii_lowercase, 3, 8)}://{some(string.ascii_lowercase, 3, 8)}:{some(alnum + '!#%', 8, 20)}@{some(string.ascii_lowercase, 4, 9)}.{rng.choice(['com', 'net', 'local'])}:{rng.randint(80, 9999)}/{some(string.ascii_lowercase, 2, 6)}"]
    if form < 0.2:  # a password by its name, with marks in it
        return [rng.choice(["pwd", "pass", "Password", "login password", "passphrase"]) + rng.choice(":="), some(alnum + "!#%$*+-", 8, 18)]
    if form < 0.35:  # groups behind a prefix
        return [some(string.ascii_lowercase, 2, 6) + "-" + "-".join(some(rng.choice([alnum, string.digits, alnum + "_"]), 10, 24) for _ in range(rng.randint(1, 3)))]
    name = rng.choice(["auth", "bearer", "access_key", "client_secret", "private_key", "credential", "key", "password", "token", "api_key"])
    quote = rng.choice(['"', "'", ""])
    return rng.choice([[f"{name}", rng.choice("=:"), f"{quote}{value}{quote}"], [f"{name}=" + quote + value + quote], [f"{name}:", quote + value + quote], [value], [name, value]])


WIDTH, CLEAN, PLANTED = 24, 1200, 600
_TOKEN = re.compile(r"[^ \t\r\x0b\x0c]+")


def windows(raw: bytes, number: int | None, width: int = WIDTH) -> tuple[list[tuple[list[str], list[int]]], list[tuple[int, int, int]]]:
    """Of a whole document: the windows of ``width`` tokens that hold a tagged secret, with their tags; and (order, first and last code point) of those of lines without any, which are drawn by that order, a hash of document and place."""
    text = raw.decode()
    spans, tagged, clean, at = [(s, e) for s, _, e in base_spans(raw, text)], [], [], 0
    ends = list(accumulate((e for _, e in spans), max))  # the furthest end so far: spans of kinds may overlap
    for line in text.split("\n"):
        tokens, tags, places, free = [], [], [], True
        inside = False
        for m in _TOKEN.finditer(line):
            lo, hi = value_part(m[0])
            a, b = at + m.start() + lo, at + m.start() + hi
            k = bisect_right(ends, a)  # the first span that ends behind the token's start
            hit = spans[k] if k < len(spans) and spans[k][0] < b else None
            last_of = hit and (b >= hit[1] or at + m.end() >= hit[1])
            secret = bool(hit and last_of and b - a >= 6)
            tokens.append(m[0])
            places.append((at + m.start(), at + m.end()))
            tags.append((INSIDE if inside else BEGIN) if secret else OUT)
            inside, free = secret, free and not secret
        at += len(line) + 1
        for i in range(0, len(tokens), width):
            if any(tags[i : i + width]):
                tagged.append((tokens[i : i + width], tags[i : i + width]))
            elif free:
                lo, hi = places[i][0], places[min(i + width, len(places)) - 1][1]
                clean.append((int.from_bytes(hashlib.blake2b(f"{number}:{lo}".encode(), digest_size=7).digest(), "big"), lo, hi))
    return tagged, clean


def lowest(held: list, more: list, most: int = CLEAN + PLANTED) -> list:
    """The ``most`` first of two lists by their order."""
    return heapq.nsmallest(most, chain(held, more), key=lambda x: x[:2])


def train(docs: list[bytes], **options) -> Field:
    """A field from documents in memory: what :func:`fit` does with a table."""
    tagged, clean = [], []
    for number, raw in enumerate(docs):
        own, free = windows(raw, number)
        of_file, text = file_features(raw), raw.decode()
        tagged += [(tokens, tags, of_file) for tokens, tags in own]
        clean = lowest(clean, [(k, number, _TOKEN.findall(text[lo:hi]), of_file) for k, lo, hi in heapq.nsmallest(CLEAN + PLANTED, free)])
    return learn(tagged, [(tokens, of_file) for *_, tokens, of_file in clean], **options)


def learn(tagged: list[tuple], clean: list[tuple], rounds: int = 80, rate: float = 0.1, l2: float = 1e-4, width: int = WIDTH) -> Field:
    """Full-batch Adam on the conditional likelihood of padded windows: all that are tagged, ``CLEAN`` clean ones, and ``PLANTED`` into which secrets are put."""
    rng = random.Random(10)
    seqs = tagged + [(t, [OUT] * len(t), of_file) for t, of_file in clean[:CLEAN]]
    drawn = clean[-PLANTED:]
    for tokens, of_file in (drawn * (1 + PLANTED // max(1, len(drawn))))[-PLANTED:]:
        put = synthetic_secrets(rng)
        k = rng.randint(0, len(tokens))
        row = tokens[:k] + put + tokens[k:]
        tags = [OUT] * k + [OUT] * (len(put) - 1) + [BEGIN] + [OUT] * (len(tokens) - k)
        if rng.random() < 0.15 and len(put[-1]) > 30:  # a secret wrapped over two tokens
            half = len(put[-1]) // 2
            row[k + len(put) - 1 : k + len(put)] = [put[-1][:half], put[-1][half:]]
            tags[k + len(put) - 1 : k + len(put)] = [BEGIN, INSIDE]
        seqs.append((row[: width + 4], tags[: width + 4], of_file))
    n, length = len(seqs), width + 4
    weights, moves = np.zeros((SLOTS, 3)), np.zeros((3, 3))
    ban = np.zeros((3, 3))
    ban[OUT, INSIDE] = -1e4
    if not n:
        return Field(weights, moves + ban)
    slot, cell = [], []
    gold = np.zeros((n, length), np.int64)
    mask = np.zeros((n, length), bool)
    for i, (tokens, tags, of_file) in enumerate(seqs):
        own = [token_features(t) for t in tokens]
        gold[i, : len(tags)], mask[i, : len(tags)] = tags, True
        for t in range(len(tokens)):
            f = own[t]["own"] + (own[t - 1]["before"] if t else [_slot("b:<s>")]) + (own[t + 1]["after"] if t + 1 < len(tokens) else [_slot("a:<s>")]) + of_file
            slot += f
            cell += [i * length + t] * len(f)
    slot, cell = np.array(slot), np.array(cell)
    used, slot = np.unique(slot, return_inverse=True)
    w = np.zeros((len(used), 3))
    m = [np.zeros_like(w), np.zeros_like(moves)]
    v = [np.zeros_like(w), np.zeros_like(moves)]
    onehot = np.eye(3)[gold] * mask[:, :, None]
    both = mask[:, :-1] & mask[:, 1:]
    seen = np.zeros((3, 3))
    np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), 1)

    def lse(x, axis):
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    for k in range(1, rounds + 1):
        e = np.stack([np.bincount(cell, w[slot, y], n * length) for y in range(3)], -1).reshape(n, length, 3)
        go = moves + ban
        a = np.zeros((n, length, 3))
        a[:, 0] = e[:, 0] + np.array([0, 0, -1e4])
        for t in range(1, length):
            a[:, t] = np.where(mask[:, t, None], lse(a[:, t - 1, :, None] + go, 1) + e[:, t], a[:, t - 1])
        z = lse(a[:, -1], 1)
        b = np.zeros((n, length, 3))
        expect = np.zeros((3, 3))
        for t in range(length - 2, -1, -1):
            to = e[:, t + 1] + b[:, t + 1]
            b[:, t] = np.where(mask[:, t + 1, None], lse(go + to[:, None, :], 2), b[:, t + 1])
            pair = np.exp(a[:, t, :, None] + go + to[:, None, :] - z[:, None, None])
            expect += (pair * both[:, t, None, None]).sum(0)
        p = np.exp(a + b - z[:, None, None]) * mask[:, :, None]
        diff = (p - onehot).reshape(-1, 3)
        grads = (np.stack([np.bincount(slot, diff[cell, y], len(used)) for y in range(3)], -1) / n + l2 * w, (expect - seen) / n + l2 * moves)
        for i, grad in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad * grad
            step = rate * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.999**k)) + 1e-9)
            if i == 0:
                w -= step
            else:
                moves -= step
    weights[used] = w
    return Field(weights, moves + ban)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train_docs: int = 4000) -> Field:
    """Train on the ``max_train_docs`` documents whose ids have the smallest hashes, each of them whole; of an id with several texts, the greatest. Base secrets label them. Tasks part the texts into windows: the driver gets those
    with a secret and ``CLEAN + PLANTED`` of the others, not texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    ids = rows.select("doc_id").filter("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_docs)
    schema = "place long, doc_id long, tokens array<string>, tags array<int>, of_file array<int>"

    def parted(batches):
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32())]

        def told(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * len(kinds), kinds, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

        clean: list[tuple] = []
        for whole in batches:
            for b in storage.bounded(whole, 1, BATCH):
                out = []
                for doc, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    own, free = windows(text or b"", doc)
                    of_file, chars = file_features(text or b""), (text or b"").decode()
                    out += [(-1, doc, tokens, tags, of_file) for tokens, tags in own]
                    clean = lowest(clean, [(k, doc, _TOKEN.findall(chars[lo:hi]), None, of_file) for k, lo, hi in heapq.nsmallest(CLEAN + PLANTED, free)])
                yield told(out)
        yield told(clean)

    found = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text")).mapInArrow(parted, schema)  # at most max_train_docs ids
    found = storage.staged(found, f"{storage.workspace(docs.sparkSession, 'secrets')}/windows")
    tagged = found.filter("place < 0").orderBy("doc_id", "tokens", "tags").select("tokens", "tags", "of_file").toArrow().to_pylist()
    clean = found.filter("place >= 0").orderBy("place", "doc_id").limit(CLEAN + PLANTED).select("tokens", "of_file").collect()
    return learn([(r["tokens"], r["tags"], r["of_file"]) for r in tagged], [(list(r[0]), list(r[1])) for r in clean])


def _scan(field: Field, docs: list[bytes]) -> list[list[tuple[int, int, int]]]:
    """All spans (start, kind, end) of every document."""
    base = [base_spans(x) for x in docs]
    lines = field.lines_of_interest(docs)
    for d, found in lines.items():
        starts, ends = [], []  # base spans, joined where they overlap
        for s, _, e in base[d]:
            if starts and s < ends[-1]:
                ends[-1] = max(ends[-1], e)
            else:
                starts.append(s)
                ends.append(e)
        for s, e in field.spans(docs[d], found):
            k = bisect_left(starts, e) - 1
            if k < 0 or ends[k] <= s:
                base[d].append((s, 3, e))
        base[d].sort()
    return base


_field: dict[str, Field] = {}


def _shared_field(key: str, value: tuple) -> Field:
    if key not in _field:
        _field.clear()
        _field[key] = Field(*value)
    return _field[key]


def _key(field: Field) -> str:
    return hashlib.sha256(field.w.tobytes() + field.moves.tobytes()).hexdigest()


def _named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf."""
    key, shared = _key(field), docs.sparkSession.sparkContext.broadcast((field.w, field.moves))  # SLOTS x 3 numbers

    def run(batches):
        f = _shared_field(key, shared.value)
        for b in batches:
            for part in storage.bounded(b, 1, BATCH):
                found = _scan(f, [t or b"" for t in part.column(1).to_pylist()])
                count = [[sum(k == kind for _, k, _ in x) for x in found] for kind in range(4)]
                shas = [hashlib.sha256(_named([s for s in x if s[1] < 3]).encode()).hexdigest() for x in found]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in count[:3]), pa.array(shas), pa.array([_named(x) for x in found]), pa.array(count[3], pa.int64())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long")


def redact_text(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, every span of a secret replaced in the text; null texts stay null."""
    key, shared = _key(field), docs.sparkSession.sparkContext.broadcast((field.w, field.moves))
    schema, place = docs.schema, docs.columns.index(text_col)

    def run(batches):
        f = _shared_field(key, shared.value)
        for b in batches:
            for part in storage.bounded(b, place, BATCH):
                texts = part.column(place).to_pylist()
                found = _scan(f, [(t or "").encode() for t in texts])
                out = [redact_text(t, x, mask) if t and x else t for t, x in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if i == place else c for i, c in enumerate(part.columns)], names=part.schema.names)

    return docs.mapInArrow(run, schema)
