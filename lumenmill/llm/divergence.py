"""Divergence audit of sources: within a language, how far apart each two sources' word use is, and which terms set a source apart.

A term is a run of letters (A-Z lower-cased) and characters beyond ASCII. A language keeps the ``V`` terms that at least ``LEAST`` of its documents
have. A group is a source of a language, or all of the language; with ``N`` occurrences of kept terms in it, a term with ``count`` of them
has p = 1 + floor(10^9 (count + 2) / (N + 2 V)) there. Two groups differ by f = floor((p - q)^2 / (p + q)) in a term, by the sum over
all kept terms as a pair. All of it is exact, in whole numbers: up to 9 * 10^15 occurrences of a language.

Kept terms are numbered by their bytes and parted in bands of ``BAND``. A group's vector of a band, compressed, has the terms that it
uses; one value stands for all others. Sources of a language sit in tiles of ``TILE``. Of two tiles that meet in a round of the tournament (round-robin, one
seat fixed) one is at home: its vectors of a band stay in a task, as a matrix, and those of its guests come by in order of the rounds,
each tile turning past the one at home until all have met. A meeting gives the value in both directions. Guests of ``WAVE`` rounds are sent at a
time, so what is dealt out is bounded by that many copies of the vectors. At home, each source also meets its language, and a heap keeps its ``TOP`` terms of the band.

Null texts, languages and sources are empty ones. Repeated rows are documents each. A language of one source has no pairs; without kept terms every value is 0.
An empty table gives no rows; extra columns are ignored. A task counts in tables of ``HELD`` entries at most, and then holds two tiles' vectors of a band."""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import storage
from .ordering import ranked

LEAST, TOP, SCALE = 10, 10, 1_000_000_000
BAND, TILE, WAVE, HELD = 1 << 14, 8, 64, 300_000
BATCH = 4 << 20
_LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def shares(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """p of counts, exact: three steps of a long division, each below 2^63."""
    over = total + 2 * kept
    out, rest = np.zeros(len(count), np.int64), count.astype(np.int64) + 2
    out, rest = rest // over, rest % over
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // over, rest % over
    return out + 1


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def counted(docs: DataFrame, id_cols: tuple[str, str, str] = ("lang", "source", "text"), held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in every group."""

    def run(batches):
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

        def told():
            for (lang, source), (n, docs) in found.items():
                if n:
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.repeat(pa.scalar(source, pa.string()), len(n)), pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())], schema=schema)
            found.clear()

        entries = 0
        for whole in batches:
            for b in storage.bounded(whole, 2, BATCH):
                for lang, source, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    n, docs = found.setdefault((lang, source), (Counter(), Counter()))
                    entries -= len(n)
                    words = terms(text)
                    n.update(words)
                    docs.update(set(words))
                    entries += len(n)
                    if entries > held:
                        yield from told()
                        entries = 0
        yield from told()

    lang, source, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in id_cols)
    rows = docs.select(lang.alias("lang"), source.alias("source"), text.cast("binary").alias("text"))
    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _vector(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Steps between numbers in a band, and counts."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(ids, prepend=0).astype("<u4").tobytes() + counts.astype("<i8").tobytes())


def _opened(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(raw)
    n = len(data) // 12
    return np.cumsum(np.frombuffer(data, "<u4", n)).astype(np.int64), np.frombuffer(data, "<i8", n, 4 * n)


def vectors(groups: DataFrame, entries: DataFrame, band: int) -> DataFrame:
    """A row for every group (lang, place, total, kept) and band with its compressed vector, of entries (lang, place, id, n)."""
    bands = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("kept") / band) - 1, F.lit(0)).cast("long")))
    heads = groups.select("lang", "place", bands.alias("band"), F.lit(-1).cast("long").alias("id"), F.lit(0).cast("long").alias("n"), "total", "kept")
    none = F.lit(0).cast("long")
    rows = heads.union(entries.select("lang", "place", F.floor(F.col("id") / band).alias("band"), F.pmod("id", F.lit(band)).alias("id"), "n", none.alias("total"), none.alias("kept")))
    rows = rows.repartition("lang", "place", "band").sortWithinPartitions("lang", "place", "band", "id")
    schema = pa.schema([("lang", pa.string()), ("place", pa.int64()), ("band", pa.int64()), ("total", pa.int64()), ("kept", pa.int64()), ("vector", pa.binary())])

    def run(batches):
        head, ids, counts = None, [], []

        def row():
            raw = _vector(np.concatenate(ids), np.concatenate(counts)) if ids else _vector(np.zeros(0, np.int64), np.zeros(0, np.int64))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*head, raw), schema, strict=True)], schema=schema)

        for b in batches:
            number, n = b.column(3).to_numpy(), b.column(4).to_numpy()
            starts = np.flatnonzero(number < 0)
            cuts = [0, *starts.tolist(), len(number)]
            for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if k:
                    if head is not None:
                        yield row()
                    head, ids, counts = tuple(b.column(i)[lo].as_py() for i in (0, 1, 2, 5, 6)), [], []
                    lo += 1
                if hi > lo:
                    ids.append(number[lo:hi])
                    counts.append(n[lo:hi])
        if head is not None:
            yield row()

    return rows.mapInArrow(run, "lang string, place long, band long, total long, kept long, vector binary")


def rounds(tile: Column, tiles: Column) -> Column:
    """An array of (round, home) of the meetings in which a tile is the guest. Seats are made even; the last one is fixed, the others turn; a tile that meets the empty seat rests."""
    seats = tiles + F.pmod(tiles, F.lit(2))
    turn = seats - 1

    def meeting(r: Column) -> Column:
        other = F.pmod(2 * r - tile + turn, turn)
        other = F.when(tile == turn, r).when(other == tile, turn).otherwise(other)
        return F.struct(r.alias("round"), other.alias("home"))

    def guest(m: Column) -> Column:
        lower_home = F.pmod(m["home"] + tile, F.lit(2)) == 1  # of an odd sum the lower tile is at home, else the higher one
        return (m["home"] < tiles) & F.when(m["home"] < tile, lower_home).otherwise(~lower_home)

    met = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), seats - 2), meeting), guest)
    return F.when(tiles > 1, met).otherwise(F.array().cast("array<struct<round:long,home:long>>"))


_LANG = -1  # place and round of a language's own vector
FOUND = "part string, lang string, place long, item long, value long"


def _play(batches, band: int, tile: int, top: int):
    """Rows of FOUND: pairs of places with their value in a band, and top terms of the sources at home. Rows come by (lang, home, band, round, place)."""
    schema = pa.schema([("part", pa.string()), ("lang", pa.string()), ("place", pa.int64()), ("item", pa.int64()), ("value", pa.int64())])
    key, home, guests, ours, at_round = None, [], [], None, None

    def row_of(total, kept, width, raw):
        ids, counts = _opened(raw)
        p = np.broadcast_to(shares(np.zeros(1, np.int64), total, kept), width).copy() if kept else np.zeros(width, np.int64)
        if len(ids):
            p[ids] = shares(counts, total, kept)
        return p, ids

    def told(part, lang, rows):
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(part, pa.string()), len(rows)), pa.repeat(pa.scalar(lang, pa.string()), len(rows)), *(pa.array(c, pa.int64()) for c in cols)], schema=schema)

    def met(lang):
        """The guests turn past those at home; without guests, those at home past themselves."""
        out, own = [], not guests
        others = home if own else guests
        a = np.stack([p for _, p in home])
        b = np.stack([p for _, p in others])
        for turn in range(1, len(others) // 2 + 1) if own else range(max(len(home), len(others))):
            for i in range(len(home)):
                j = (i + turn) % (len(others) if own else max(len(home), len(others)))
                if j >= len(others) or own and 2 * turn == len(others) and i > j:
                    continue
                value = int(differences(a[i], b[j]).sum())
                out += [(home[i][0], others[j][0], value), (others[j][0], home[i][0], value)]
        return told("pair", lang, out) if out else None

    def best(lang, number):
        out = []
        for (place, p), ids in zip(home, used, strict=True):
            ids = ids[p[ids] > ours[ids]]
            value = differences(p[ids], ours[ids])
            first = number * band
            heap = heapq.nsmallest(top, zip((-value).tolist(), (ids + first).tolist(), strict=True))
            out += [(place, i, -v) for v, i in heap]
        return told("term", lang, out) if out else None

    used: list[np.ndarray] = []
    for b in batches:
        for lang, at, number, rnd, place, total, kept, raw in (row for part in storage.bounded(b, 7, BATCH) for row in zip(*(c.to_pylist() for c in part.columns), strict=True)):
            if (lang, at, number) != key:
                if guests or (home and at_round == 0):
                    yield from filter(None, [*([best(key[0], key[2])] if at_round == 0 and ours is not None else []), met(key[0])])
                key, home, guests, ours, used, at_round = (lang, at, number), [], [], None, [], None
            if at_round is not None and rnd != at_round:
                if at_round == 0:
                    yield from filter(None, [best(lang, number) if ours is not None else None, met(lang)])
                elif guests:
                    yield from filter(None, [met(lang)])
                guests = []
            p, ids = row_of(total, kept, max(0, min(band, kept - number * band)), raw)
            if rnd == _LANG and place == _LANG:
                ours = p
                continue
            if rnd == _LANG:  # at home again in a later wave: its own meetings are over
                home.append((place, p))
                continue
            at_round = rnd
            if rnd == 0:
                home.append((place, p))
                used.append(ids)
            else:
                guests.append((place, p))
    if guests or (home and at_round == 0):
        yield from filter(None, [*([best(key[0], key[2])] if at_round == 0 and ours is not None else []), met(key[0])])


def audit(docs: DataFrame, folder: str, least: int = LEAST, top: int = TOP, band: int = BAND, tile: int = TILE, wave: int = WAVE, columns: tuple[str, str, str] = ("lang", "source", "text")) -> DataFrame:
    """lang, source, part, item, value, rank: for every source of a language all others by how far they are, and its ``top`` terms."""
    counts = storage.staged(counted(docs, columns), f"{folder}/counts")
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns[:2])
    occurring = docs.select(lang.alias("lang"), source.alias("source")).distinct()
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
    kept = storage.staged(ranked(storage.staged(whole.select("lang", "term", "n"), f"{folder}/whole"), ["lang"], ["term"], f"{folder}/terms").withColumnRenamed("rank", "id").withColumnRenamed("total", "kept"), f"{folder}/kept")
    places = storage.staged(ranked(storage.staged(occurring, f"{folder}/sources"), ["lang"], ["source"], f"{folder}/seats").withColumnRenamed("rank", "place").withColumnRenamed("total", "sources"), f"{folder}/places")
    entries = counts.select("lang", "source", "term", "n").join(kept.select("lang", "term", "id"), ["lang", "term"]).join(places, ["lang", "source"]).select("lang", "place", "id", "n")
    entries = storage.staged(entries.union(kept.select("lang", F.lit(_LANG).cast("long"), "id", "n")), f"{folder}/entries")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    sums = entries.groupBy("lang", "place").agg(F.sum("n").alias("total"))
    everyone = places.select("lang", "place").union(places.select("lang", F.lit(_LANG).cast("long")).distinct())
    groups = everyone.join(langs, "lang", "left").join(sums, ["lang", "place"], "left").select("lang", "place", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"))
    tiles = places.groupBy("lang").agg(F.ceil(F.max("sources") / tile).alias("tiles"))
    made = storage.staged(vectors(groups, entries, band), f"{folder}/vectors").join(tiles, "lang").withColumn("tile", F.floor(F.col("place") / tile))
    most = made.agg(F.max("tiles")).first()[0] or 1
    fields = ("band", "round", "place", "total", "kept", "vector")
    own = made.filter(F.col("place") != _LANG)
    tour = own.select("lang", "band", "place", "total", "kept", "vector", F.explode(rounds(F.col("tile"), F.col("tiles"))).alias("m")).select("lang", F.col("m.home").alias("home"), "band", (F.col("m.round") + 1).alias("round"), "place", "total", "kept", "vector")
    parts = []
    for k, first in enumerate(range(0, most, wave)):
        at_home = own.withColumn("round", F.lit(_LANG if k else 0).cast("long")).select("lang", F.col("tile").alias("home"), *fields)
        rows = at_home.union(tour.filter(F.col("round").between(first + 1, first + wave)).select("lang", "home", *fields))
        if not k:
            every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
            rows = rows.union(made.filter(F.col("place") == _LANG).select("lang", every.alias("home"), "band", F.lit(_LANG).cast("long").alias("round"), "place", "total", "kept", "vector"))
        dealt = rows.repartition("lang", "home", "band").sortWithinPartitions("lang", "home", "band", "round", "place")
        parts.append(storage.staged(dealt.mapInArrow(lambda batches: _play(batches, band, tile, top), FOUND), f"{folder}/wave-{k}"))
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    pairs = found.filter("part = 'pair'").groupBy("lang", "place", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.join(places.select("lang", F.col("place").alias("item"), F.col("source").alias("name")), ["lang", "item"])
    best = F.row_number().over(Window.partitionBy("lang", "place").orderBy(F.desc("value"), "item"))
    tops = found.filter("part = 'term'").withColumn("rank", best).filter(F.col("rank") <= top)
    tops = tops.join(kept.select("lang", F.col("id").alias("item"), F.col("term").alias("name")), ["lang", "item"])
    far = F.row_number().over(Window.partitionBy("lang", "place").orderBy(F.desc("value"), "name"))
    rows = pairs.select("lang", "place", F.lit("pair").alias("part"), "name", "value", far.alias("rank")).union(tops.select("lang", "place", F.lit("term"), "name", "value", "rank"))
    return rows.join(places.select("lang", "place", "source"), ["lang", "place"]).select("lang", "source", "part", F.col("name").alias("item"), "value", F.col("rank").cast("int").alias("rank"))
