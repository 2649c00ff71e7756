"""The five stages, each on its own input against a plain version, and the whole run, on rows with nulls, repeats and clashing columns."""

import hashlib
import math
import random
import zlib
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as cp
from lumenmill.llm import secret_crf, storage, toxicity

from .test_llm import judged, library

RNG = random.Random(11)
WORDS = "the river of stone and a quiet light over seven hills where birds gather in early spring rain with old maps".split()
PASSAGE = " ".join(RNG.choice(WORDS) + str(k) for k in range(40))
BENCH = [(1, PASSAGE), (2, "zebra quagga okapi"), (None, None), (3, "")]
SECRET = "api_key = 'Zk3jQ9xT7LmN2pR8vW4yB6cD'"


def prose(n):
    return " ".join(RNG.choice(WORDS) + (f"{RNG.randint(0, 400)}" if RNG.random() < 0.4 else "") for _ in range(n))


def make_rows():
    out = []
    for i in range(300):
        text = f"{prose(12)}. {prose(10)}{' lumphead' if i % 7 == 0 else ''}. {prose(14)}"
        out.append((i, text))
    copy, near = out[10][1], out[11][1]
    out += [(400, copy), (10, copy), (None, copy), (401, near.replace(".", " .", 1)), (11, prose(30)), (402, f"{prose(5)} {PASSAGE} {prose(5)}"), (403, prose(4) + " Zebra, QUAGGA okapi " + prose(300))]
    out += [(404, f"{prose(20)}\n{SECRET}\n{prose(20)}"), (405, None), (406, ""), (None, ""), (None, f"alone {prose(20)}"), (407, "<|endoftext|> é"), (11, out[12][1])]
    return [(i, t, "en", None if i == 3 else "src", None if t is None else len(t)) for i, t in out]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    storage.workers_find_package(spark)
    folder = str(tmp_path_factory.mktemp("sf"))
    rows = make_rows()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 0, int(i % 7 == 0)) for i in range(300)] + [(None, 0, 1), (5, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module")
def docs(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet").withColumn("fp", F.lit(1)).withColumn("score", F.lit("clash"))


def key(r):
    return (r is None, tuple((x is None, x if x is not None else 0) for x in r))


def rows_of(df):
    return sorted((tuple(r[c] for c in cp.COLUMNS) for r in df.collect()), key=key)


def words_by_sentence(text):
    table = {c: " " for c in range(128) if not chr(c).isalnum()}
    for c in ".!?\n":
        table[ord(c)] = "\n"
    low = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return [s.split() for s in low.translate(table).split("\n")]


def chance(model, text):
    safe = 1 - 1 / (1 + math.exp(-model.leak))
    sentences = words_by_sentence(text)
    for k, s in enumerate(sentences):
        if s or k == len(sentences) - 1:
            z = model.bias + sum(model.values.get(x.encode(), 0.0) + sum(model.values.get(b"\x02" + x[:n].encode(), 0.0) for n in toxicity.PREFIXES if n < len(x)) for x in s)
            safe *= 1 - 1 / (1 + math.exp(-z))
    return 1 - safe


def plain_toxic(rows, model):
    return [r for r in rows if chance(model, r[1]) < 0.5]


def plain_dedup(rows):
    def fp(t):
        w = "".join(c.lower() if c < "\x80" else c for c in t or "").encode().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fp(r[1]) for r in rows]
    comp = list(range(len(rows)))
    changed = True
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    while changed:
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            changed |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(comp[k], []).append(r)
    return groups


def test_toxicity(spark, docs, tables):
    model = toxicity.fit(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    want = sorted(plain_toxic(rows_of(docs), model), key=key)
    out = cp.toxic_filter(spark, docs, tables)
    assert out.columns == list(cp.COLUMNS) and rows_of(out) == want
    gone = [r for r in rows_of(docs) if r not in want]
    assert len(gone) >= 40 and all("lumphead" in r[1] for r in gone)
    assert cp.toxic_filter(spark, docs.limit(0), tables).count() == 0


def check_dedup(before, after):
    groups = plain_dedup(before)
    assert len(after) == len(groups)
    for rows in groups.values():
        ids = [r[0] for r in rows if r[0] is not None]
        kept = [r for r in after if r in rows]
        assert len(kept) == 1 and kept[0][0] == (min(ids) if ids else None)


def test_near_dedup(spark, docs, tables):
    out = cp.near_dedup(spark, docs, tables)
    assert out.columns == list(cp.COLUMNS)
    kept = rows_of(out)
    check_dedup(rows_of(docs), kept)
    assert sum(r[0] == 10 for r in kept) == 1 and sum(r[0] == 11 for r in kept) == 3 and not [r for r in kept if r[0] in (12, 400)] and any(r[1] and r[1].startswith("alone") for r in kept)
    assert cp.near_dedup(spark, docs.limit(0), tables).count() == 0


def test_decontamination(spark, docs, tables):
    want = [r for r in rows_of(docs) if not judged(r[1], BENCH)[0][4]]
    out = cp.decontamination(spark, docs, tables)
    assert out.columns == list(cp.COLUMNS) and rows_of(out) == want
    assert {402} == {r[0] for r in rows_of(docs) if r not in want}
    assert cp.decontamination(spark, docs.limit(0), tables).count() == 0


def plain_redact(rows, field):
    out = []
    for r in rows:
        if r[1] is None:
            out.append(r)
            continue
        spans = secret_crf._scan(field, [r[1].encode()])[0]
        text, at = "", 0
        for s, _, e in spans:
            if s >= at:
                text += r[1][at:s] + "[SECRET]"
            at = max(at, e)
        text += r[1][at:]
        out.append((*r[:1], text, *r[2:4], len(text)))
    return out


def test_secrets(spark, docs, tables):
    field = secret_crf.fit(docs)
    out = cp.secret_redaction(spark, docs, tables)
    assert out.columns == list(cp.COLUMNS)
    assert rows_of(out) == sorted(plain_redact(rows_of(docs), field), key=key)
    hidden = next(r[1] for r in rows_of(out) if r[0] == 404)
    assert "Zk3jQ9" not in hidden and "[SECRET]" in hidden and out.filter("doc_id = 405").first()["text"] is None
    assert cp.secret_redaction(spark, docs.limit(0), tables).count() == 0


def plain_encode(rows):
    from tokenizers import Tokenizer

    from lumenmill.llm import bpe

    tok = Tokenizer.from_file(bpe.DEFAULT_PATH)
    out = []
    for r in rows:
        ids = library(r[1])
        out.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=key)


def encoded(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) for r in df.collect()), key=key)


def test_encoding(spark, docs, tables):
    assert encoded(cp.encoding(spark, docs, tables)) == plain_encode(rows_of(docs))
    assert cp.encoding(spark, docs.limit(0), tables).count() == 0


def test_run_is_its_stages_in_order(spark, tables):
    assert [name for name, _ in cp.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "bpe"]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = plain_toxic(rows_of(docs), toxicity.fit(docs, spark.read.parquet(f"{tables}/labels.parquet")))
    kept = [min(g, key=lambda r: (r[0] is None, r[0] or 0, signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)), r)) for g in plain_dedup(rows).values()]
    rows = [r for r in kept if not judged(r[1], BENCH)[0][4]]
    left = spark.createDataFrame(rows, docs.schema)
    want = plain_encode(plain_redact(rows, secret_crf.fit(left)))
    assert encoded(cp.run(spark, tables)) == want


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_run_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_held_out_rule():
    assert [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0]
