"""Bounds of single tasks and of what lies on disk at once."""

import contextlib
import io
import re

from framewright.llm import line_dedup, token_align


def test_alignment_weighs_few_chunks_per_task(spark, monkeypatch):
    df = spark.range(48).selectExpr("id as doc_id", "concat('the cat sat on mat ', id % 5) as text").repartition(24)
    want = sorted(token_align.align(df).collect())
    monkeypatch.setattr(token_align, "PER_TASK", 2)
    got = token_align.align(df)
    assert got.rdd.getNumPartitions() > 8  # about 24 chunks; they met in the 8 shuffle partitions at most
    assert sorted(got.collect()) == want and len(want) == 48


def test_line_dedup_shuffles_texts_once(spark):
    rows = [(1, "a first line\nsome second line", "en"), (2, "a first line\n--\nnothing like the others", "de"), (3, None, "fr"),
            (4, "", "it"), (5, "--\n\n", None), (6, "some second line", "en"), (None, "a first line\nof no id", "en")]
    out = line_dedup.apply(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        out.explain()
    assert not re.search(r"hashpartitioning\(row#\d+L?, line_no", plan.getvalue())
    got = sorted(map(tuple, out.collect()), key=lambda r: (r[0] is None, r[0]))
    assert got == [(1, "some second line", "en"), (2, "--\nnothing like the others", "de"), (3, None, "fr"), (4, "", "it"),
                   (5, "--\n\n", None), (None, "a first line\nof no id", "en")]
