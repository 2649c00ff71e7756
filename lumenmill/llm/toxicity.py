"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has the chance sigmoid(bias + weights of its words and of their beginnings, ``PREFIXES`` letters long, so
that inflected forms of a word count without having been seen); the document's is their noisy-or with
a leak, 1 - (1 - e) prod(1 - p); the leak takes labels that no sentence explains. Weights come from document labels alone,
so the sentences that carry a label are found on the way (``worst_sentence``).

``fit`` uses a sample of at most ``max_train_docs`` labelled documents, those whose id has the smallest hash, each of them whole; the driver holds numbers of their known words, not texts;
a document with several labels counts as toxic if any says so, one with several texts by the greatest. ``score`` reads every
whole text: null and empty texts have one empty sentence and the bias' chance; rows are judged each on its own; an empty
table gives none. Without labels of both kinds all weights are zero. Extra columns are ignored. A task holds ``BATCH`` bytes of texts, or one longer text,
and the values of ``CACHE`` words."""

from __future__ import annotations

from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage

# Sentence ends become a new line, letters and digits stay, the rest parts words.
_TABLE = bytes(10 if c in b".!?\n" else c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_END = b"\x01"
PREFIXES = (4, 5, 6, 7)
BATCH, CACHE = 1 << 20, 200_000


def beginnings(word: bytes) -> list[bytes]:
    """Its first letters, marked as such."""
    text = word if word.isascii() else word.decode("utf-8", "replace")
    return [b"\x02" + (x if text is word else x.encode()) for x in (text[:k] for k in PREFIXES if k < len(text))]


def stems(values) -> set[bytes]:
    """The first bytes of the beginnings among some words: a word that begins otherwise has none of them."""
    return {x[1 : 1 + PREFIXES[0]] for x in values if x[:1] == b"\x02"}


class Model:
    def __init__(self, values: dict[bytes, float], bias: float, leak: float):
        """``values``: the weights of words and beginnings that are not zero."""
        self.values, self.bias, self.leak = values, bias, leak
        self.known: dict[bytes, float] = {_END: np.nan}
        self.stems = stems(values)

    def _value(self, word: bytes) -> float:
        v = self.values
        return v.get(word, 0.0) + (sum(v.get(x, 0.0) for x in beginnings(word)) if word[: PREFIXES[0]] in self.stems else 0.0)

    def score(self, texts: list[bytes | None]) -> tuple[np.ndarray, list[int]]:
        """Chance of each text, and the number of its likeliest sentence, which is that of the ends (. ! ? and new lines) before it."""
        words, ends = [], []
        for t in texts:
            words += (t or b"").translate(_TABLE).replace(b"\n", b" \x01 ").split()
            words.append(_END)
            ends.append(len(words))
        if len(self.known) > CACHE:
            self.known = {_END: np.nan}
        for w in set(words).difference(self.known):
            self.known[w] = self._value(w)
        value = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
        stops = np.flatnonzero(np.isnan(value))  # ends of sentences
        value[stops] = 0.0
        begins = np.concatenate([[0], stops[:-1] + 1])
        sums = np.concatenate([[0.0], np.cumsum(value)])
        z = self.bias + sums[stops] - sums[begins]
        full = (stops > begins) | np.isin(stops, np.array(ends) - 1)  # runs of ends are no sentences
        logq = np.where(full, -np.logaddexp(0, z), 0.0)
        last = np.searchsorted(stops, np.array(ends) - 1)
        first = np.concatenate([[0], last[:-1] + 1])
        run = np.concatenate([[0.0], np.cumsum(logq)])
        total = run[last + 1] - run[first] - np.logaddexp(0, self.leak)
        worst = [int(np.argmin(logq[i : j + 1])) for i, j in zip(first.tolist(), last.tolist(), strict=True)]
        return np.clip(-np.expm1(total), 0.0, 1.0), worst


MIN_DOCS, MAX_WORDS = 5, 30_000
_BIAS, _LEAK = -7.0, -4.0


def parts_of(text: bytes | None, first: set[bytes] | None) -> set[bytes]:
    """The words of a text and the beginnings of those whose stems are in ``first``; without ``first`` the stems alone."""
    words, stem = set((text or b"").translate(_TABLE).split()), PREFIXES[0]
    if first is None:
        return {w[:stem] for w in words if len(w) > stem}
    return words | {x for w in words if w[:stem] in first for x in beginnings(w)}


def sentences(text: bytes | None, vocab: dict[bytes, int], first: set[bytes]) -> tuple[array, array]:
    """The known words and beginnings of every sentence that has some, and their number in each; last a sentence without, which has the bias alone."""
    stem, word, size = PREFIXES[0], array("i"), array("i")
    for line in (text or b"").translate(_TABLE).split(b"\n"):
        own = set(line.split())
        own.update([x for w in own if w[:stem] in first for x in beginnings(w)])
        if got := {vocab[x] for x in own if x in vocab}:
            word.extend(got)
            size.append(len(got))
    size.append(0)
    return word, size


def start(counts: list[tuple[bytes, int, float]], begun: list[tuple[bytes, float]]) -> tuple[dict[bytes, int], np.ndarray]:
    """Places of the words (word, documents, excess) and beginnings (beginning, excess) that are kept, and first weights: a start among words that toxic documents have far above
    chance; the likelihood is not convex."""
    vocab = {w: i for i, w in enumerate([w for w, *_ in counts] + [w for w, _ in begun])}
    weights = np.zeros(len(vocab))
    for w, x, up in [(w, x, 6.0) for w, _, x in counts] + [(w, x, 3.0) for w, x in begun]:
        if x > 4:
            weights[vocab[w]] = up
    return vocab, weights


def train(texts: list[bytes], labels: list[int], **options) -> Model:
    """A model from texts in memory: what :func:`fit` does with a table."""
    y = np.array(labels, bool)
    if not y.any() or y.all():
        return Model({}, _BIAS, _LEAK)
    base = y.mean()

    def counted(first) -> dict[bytes, tuple[int, float]]:
        df, seen = Counter(), Counter()
        for t, toxic in zip(texts, y.tolist(), strict=True):
            own = parts_of(t, first)
            df.update(own)
            if toxic:
                seen.update(own)
        return {w: (n, (seen[w] - n * base) / np.sqrt(n * base * (1 - base))) for w, n in df.items() if n >= MIN_DOCS}

    first = {w for w, (_, x) in counted(None).items() if x > 2}
    every = counted(first)
    kept = sorted(((w, n, x) for w, (n, x) in every.items() if w[0] != 2), key=lambda r: (-r[1], r[0]))[:MAX_WORDS]
    begun = sorted(((w, x) for w, (_, x) in every.items() if w[0] == 2 and x > 3), key=lambda r: (-r[1], r[0]))[:MAX_WORDS]
    vocab, weights = start(kept, begun)
    return learn([sentences(t, vocab, stems(vocab)) for t in texts], y, vocab, weights, **options)


def learn(docs: list[tuple], y: np.ndarray, vocab: dict[bytes, int], weights: np.ndarray, rounds: int = 120, rate: float = 0.1, l1: float = 1.5e-4) -> Model:
    """Full-batch Adam on the noisy-or's likelihood, with a soft threshold ``l1`` that leaves words without evidence at zero. ``docs``: words and sizes as :func:`sentences` gives them."""
    bias, leak = _BIAS, _LEAK
    word, size = (np.concatenate([np.frombuffer(d[k], np.int32) for d in docs]) for k in (0, 1))
    doc_of = np.repeat(np.arange(len(docs), dtype=np.int32), [len(d[1]) // (4 if isinstance(d[1], bytes) else 1) for d in docs])
    stops = np.cumsum(size, dtype=np.int64)
    cuts = np.unique(np.append(np.searchsorted(stops, np.arange(0, len(word), 1 << 18), "right"), len(size)))
    blocks = [(lo, hi, int(stops[lo] - size[lo]), int(stops[hi - 1])) for lo, hi in zip([0, *cuts.tolist()], cuts.tolist(), strict=False) if lo < hi]  # sentences and their words, so that no array of all words is made in a round
    m = [np.zeros(len(weights)), 0.0, 0.0]
    v = [np.zeros(len(weights)), 0.0, 0.0]
    for k in range(1, rounds + 1):
        z = np.full(len(doc_of), bias)
        for lo, hi, i, j in blocks:
            z[lo:hi] += np.bincount(np.repeat(np.arange(hi - lo), size[lo:hi]), weights[word[i:j]], hi - lo)
        p = 1 / (1 + np.exp(-z))
        e = 1 / (1 + np.exp(-leak))
        s = np.minimum(np.bincount(doc_of, -np.logaddexp(0, z), len(y)) + np.log1p(-e), -1e-9)
        up = np.where(y, -np.exp(s) / -np.expm1(s), 1.0)  # of the loss by -log of the chance that no sentence is toxic
        g = p * up[doc_of] / len(y)
        of_word = np.zeros(len(weights))
        for lo, hi, i, j in blocks:
            of_word += np.bincount(word[i:j], np.repeat(g[lo:hi], size[lo:hi]), len(weights))
        grads = (of_word, g.sum(), e * up.sum() / len(y))
        step = []
        for i, grad in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad * grad
            pace = rate / (np.sqrt(v[i] / (1 - 0.999**k)) + 1e-9)
            step.append(pace * m[i] / (1 - 0.9**k))
            if i == 0:
                shrink = l1 * pace
        weights, bias, leak = weights - step[0], bias - step[1], leak - step[2]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - shrink, 0)
    return Model({w: float(weights[i]) for w, i in vocab.items() if weights[i]}, float(bias), float(leak))


def held_out(id_col) -> F.Column:
    return F.crc32(id_col.cast("string")) % 5 == 0


def counted(rows: DataFrame, first: set[bytes] | None, base: float, held: int = 300_000) -> DataFrame:
    """(part, n, x) of rows (y, text): in how many documents each part of :func:`parts_of` stands, ``MIN_DOCS`` at least, and how far toxic ones exceed chance, in standard deviations."""

    def run(batches):
        df, seen = Counter(), Counter()

        def told():
            parts = list(df)
            out = pa.RecordBatch.from_arrays([pa.array(parts, pa.binary()), pa.array([df[w] for w in parts], pa.int64()), pa.array([seen[w] for w in parts], pa.int64())], names=["part", "n", "seen"])
            df.clear()
            seen.clear()
            return out

        for whole in batches:
            for b in storage.bounded(whole, 1, BATCH):
                for toxic, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    own = parts_of(text, first)
                    df.update(own)
                    if toxic:
                        seen.update(own)
                    if len(df) > held:
                        yield told()
        yield told()

    sums = rows.select("y", "text").mapInArrow(run, "part binary, n long, seen long").groupBy("part").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    n = F.col("n")
    return sums.filter(n >= MIN_DOCS).select("part", "n", ((F.col("seen") - n * base) / F.sqrt(n * base * (1 - base))).alias("x"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_train_docs: int = 12_000) -> Model:
    """Learn from labels of rows that are not held out, of at most ``max_train_docs`` documents, each of them whole. Texts stay in shared storage: tasks count their words and part them into sentences; the driver
    gets ``MAX_WORDS`` words and as many beginnings at most, and the numbers of those in each sentence."""
    spark, folder = docs.sparkSession, storage.workspace(docs.sparkSession, "toxicity")
    ids = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)").filter(~held_out(F.col("doc_id")))
    ids = ids.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_docs)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).join(F.broadcast(ids), "doc_id")  # at most max_train_docs ids
    rows = storage.staged(rows.groupBy("doc_id", "y").agg(F.max("text").alias("text")), f"{folder}/drawn")
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < toxic < n:
        return Model({}, _BIAS, _LEAK)
    first = {bytes(r[0]) for r in counted(rows, None, toxic / n).filter("x > 2").select("part").collect()}  # stems of PREFIXES[0] bytes in MIN_DOCS documents each
    every, mark = storage.staged(counted(rows, first, toxic / n), f"{folder}/counts"), F.substring("part", 1, 1) == F.lit(b"\x02")
    kept = [(bytes(w), m, x) for w, m, x in every.filter(~mark).orderBy(F.desc("n"), "part").limit(MAX_WORDS).collect()]
    begun = [(bytes(w), x) for w, x in every.filter(mark & (F.col("x") > 3)).orderBy(F.desc("x"), "part").limit(MAX_WORDS).select("part", "x").collect()]
    vocab, weights = start(kept, begun)
    shared = spark.sparkContext.broadcast(vocab)

    def run(batches):
        own = shared.value
        mine = stems(own)
        for whole in batches:
            for b in storage.bounded(whole, 2, BATCH):
                got = [sentences(t, own, mine) for t in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([x[k].tobytes() for x in got], pa.binary()) for k in (0, 1))], names=["doc_id", "y", "words", "sizes"])

    got = rows.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, words binary, sizes binary").orderBy("doc_id").toArrow()
    return learn(list(zip(got.column("words").to_pylist(), got.column("sizes").to_pylist(), strict=True)), np.array(got.column("y").to_pylist(), bool), vocab, weights)


def _scored(docs: DataFrame, model: Model, place: int, answer, schema) -> DataFrame:
    """``answer(rows, chances, worst sentences)`` of parts of every batch whose column ``place`` holds the text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.values, model.bias, model.leak))  # twice max_words words at most

    def run(batches):
        m = Model(*shared.value)
        for whole in batches:
            for b in storage.bounded(whole, place, BATCH):
                p, worst = m.score([t.encode() if isinstance(t, str) else t for t in b.column(place).to_pylist()])
                yield answer(b, p, worst)

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, worst_sentence."""

    def answer(b, p, worst):
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(worst, pa.int32())], names=["doc_id", "held_out", "score", "predicted", "worst_sentence"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out(F.col(id_col).cast("long")), F.lit(False)).alias("held_out"), F.col(text_col).cast("binary").alias("text"))
    return _scored(rows, model, 2, answer, "doc_id long, held_out boolean, score double, predicted int, worst_sentence int")


def keep(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose score is below ``threshold``."""
    return _scored(docs, model, docs.columns.index(text_col), lambda b, p, _: b.filter(pa.array(p < threshold)), docs.schema)
