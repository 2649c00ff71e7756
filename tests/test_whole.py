"""Whole texts and rows: what earlier forms cut or lost."""

from lumenmill.plans import fixture


def test_mathdocs_hold_the_whole_text(spark, tmp_path):
    text = "first line " * 20 + "\n" + "word " * 2000 + "end"
    spark.createDataFrame([(i, "en", text) for i in range(8)], "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = fixture.mathdocs(spark, str(tmp_path)).collect()
    assert len(rows) == 8 and all(text in r.text for r in rows)
    head = {r.k: r.text.split("\n\n## Solution" if r.k == 0 else "\n\n## Answer")[0] for r in rows if r.k < 2}
    assert head[0].endswith("$. " + text.split("\n")[0]) and head[1].endswith(text)
