"""Splitting by places against a plain pass, and of a very long document."""

import random
import re

from pyspark.sql import functions as F

from lumenmill.operators import split


def plain(text, least=800, target=8000, most=15_000):
    parts, now = [], []
    for line in text.split("\n"):
        head = line.split(" ", 1)
        if head[0] in ("#", "##", "###", "####") and len(head) == 2 and head[1].strip() and now:
            parts.append("\n".join(now))
            now = []
        now.append(line)
    parts = [x.strip() for x in [*parts, "\n".join(now)] if x.strip()]
    pieces = []
    for x in parts:
        if pieces and len(x) < least:
            pieces[-1] += "\n\n" + x
        else:
            pieces.append(x)
    out = []
    for x in pieces:
        if len(x) <= most:
            out.append(x)
            continue
        now = ""
        for y in re.split(r"\n{2,}", x):
            if y.strip():
                if now and len(now) + len(y) + 2 > target:
                    out.append(now)
                    now = ""
                now = f"{now}\n\n{y}" if now else y
        out += [now] if now else []
    return out


def test_equals_a_plain_pass(spark):
    rng, docs = random.Random(4), []
    for k in range(40):
        parts = [("## Part" if rng.random() < 0.5 else "") + "\n" * rng.randint(1, 3) + "We compute $x$. " * rng.choice([1, 5, 60, 700]) for _ in range(rng.randint(1, 25))]
        docs.append((k, "\n".join(parts)))
    docs.append((99, "\n".join(f"## Part {k}\n\n" + "We compute $x$ and $y = 2$ here. " * (28 if k % 3 else 3) for k in range(20_000))))
    got = split.split_documents(spark.createDataFrame(docs, "doc_id long, text string"), min_chunk=1, min_math=0.0).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["chunk_index"])):
        found.setdefault(r["doc_id"], []).append(r["text"])
    assert found == {k: plain(t, 1) for k, t in docs}
    whole = split.split_documents(spark.createDataFrame(docs, "doc_id long, text string"), min_math=0.0).collect()
    assert {r["doc_id"]: r["chunk_total"] for r in whole} == {k: len(plain(t)) for k, t in docs if any(len(x) >= 800 for x in plain(t))}


def test_a_bare_heading_takes_the_next_line_as_its_title(spark):
    text = "before\n\n## \n\n## Part three\nshort\n\n# \n# \n# last\nend\n## more\nx"
    got = spark.createDataFrame([(text,)], "c string").select(split.heading_sections(F.col("c")).alias("x")).collect()[0]["x"]
    starts = [m.start() for m in re.finditer(r"(?m)^(#{1,4})\s+(.+)", text)]
    assert got == [text[a:b] for a, b in zip([0, *starts], [*starts, len(text)], strict=True)] == ["before\n\n", "## \n\n## Part three\nshort\n\n", "# \n# \n", "# last\nend\n", "## more\nx"]
    chunk = split.split_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), min_chunk=1, min_math=0.0).orderBy("chunk_index").collect()
    assert chunk[1]["text"] == "## \n\n## Part three\nshort"
