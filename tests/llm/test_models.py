"""Piece codec, quality classifier and the pipeline."""

import random
import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from framewright.llm import mil_quality, piece_codec
from framewright.llm.queries import ORACLE, QUERIES

TEXTS = [None, "", " ", "   two  runs ", "hello world\n\tñ é 😀 a", "to be, or not to be." * 50, "<s> </s> <0x41> ▁ ▁▁x", "naïve façade 東京", "x" * 5000, "0123456789" * 20, "\n\n", "a", "a"]


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=piece_codec.MODEL)


def test_ids_and_texts_equal_the_library(spark, sp):
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choice("abcdehilnorst  ▁\nABÉñß日😀1.,-'") for _ in range(r.randint(0, 60))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(3)
    got = {x.doc_id: x for x in piece_codec.decode(piece_codec.encode(df), out="back").collect()}
    for i, t in enumerate(texts):
        want = None if t is None else sp.encode(t)
        assert (None if got[i].ids is None else list(got[i].ids)) == want
        assert got[i].back == (None if t is None else sp.decode(want))
    assert piece_codec.encode(df.limit(0)).count() == 0


def test_documents_round_trip(spark, sp):
    got = QUERIES["op4_piece_codec"](spark, "/root/testdata/sf0.01").collect()
    texts = {x.doc_id: x.text for x in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(got) == len(texts) and all(x.round_trip for x in got)
    assert all(list(x.ids) == sp.encode(texts[x.doc_id]) for x in got)


def test_unigram_paths_score_best(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    m.ParseFromString(open(piece_codec.MODEL, "rb").read())
    m.trainer_spec.model_type = 1
    (tmp_path / "uni.model").write_bytes(m.SerializeToString())
    ours, sp = piece_codec.Pieces(str(tmp_path / "uni.model")), sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "uni.model"))
    for t in ("hello world of unigram pieces", "internationalisation", "abcabcabc def"):
        ids, _ = ours.encode([t])
        text, best = "▁" + t.replace(" ", "▁"), [0.0]
        for end in range(1, len(text) + 1):
            best.append(max((best[a] + ours.rank[text[a:end]] for a in range(end) if text[a:end] in ours.rank), default=-np.inf))
        assert sum(ours.score[ids]) == best[-1] >= sum(sp.get_score(i) for i in sp.encode(t))
        assert ours.decode(ids, np.array([0, len(ids)])) == [t]


def test_gradients_match_differences():
    r = np.random.default_rng(0)
    x, before, y = r.normal(size=(9, mil_quality.WIDTH)), np.array([0, 2, 3, 9]), np.array([1.0, 0, 1])
    model = mil_quality.Model(np.zeros(mil_quality.WIDTH), np.ones(mil_quality.WIDTH), 5, 4, 1)
    model.p["c"] = r.normal(size=5)
    g = model.gradients(model.forward(x, before), y)

    def loss():
        s = model.forward(x, before)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))
    for k in ("w", "v", "u", "a", "c", "d", "b"):
        at = tuple(0 for _ in model.p[k].shape)
        old = model.p[k][at]
        model.p[k][at] = old + 1e-5
        up = loss()
        model.p[k][at] = old - 1e-5
        assert (up - loss()) / 2e-5 == pytest.approx(g[k][at], abs=1e-6)
        model.p[k][at] = old


def test_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = QUERIES["op8_mil_quality"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    held = [x for x in got if x.held_out]
    assert len(held) > 30 and sum(x.predicted == x.quality for x in held) >= 0.95 * len(held)
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got)


def test_scores_of_odd_rows(spark):
    good, bad = "the cat sat on the mat and it was of the " * 8, "!!! ### $$$ x%%% " * 30
    rows = [(i, good if i % 2 else bad, None) for i in range(60)] + [(100, None, "x"), (101, "", "x"), (None, good, "x"), (7, good, "x"), (102, good * 2000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 1), (None, 1), (4, None), (5, 7)], "doc_id long, quality int")
    got = mil_quality.score(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 for x in got)
    assert all((x.predicted == 1) == (x.text.startswith("the")) for x in got if x.text)
    assert len({x.score for x in got if not x.text}) == 1
    assert {x.score for x in mil_quality.score(df, labels.limit(0)).collect()} == {0.5}
    assert mil_quality.score(df.limit(0), labels).count() == 0


def test_queries_are_registered_under_their_numbers():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries()) and set(ORACLE) <= set(QUERIES)


def test_pipeline_stages_on_a_small_corpus(spark, tmp_path, sp):
    r = random.Random(9)
    words = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 8))) for _ in range(400)]
    text = lambda n: "\n".join(" ".join(r.choice(words) for _ in range(12)) + "." for _ in range(n))
    clean = [(i, text(r.randint(3, 9)), "en", f"s{i % 3}", 0) for i in range(60)]
    junk = [(100 + i, " ".join(w.upper() + "!!" for w in text(4).split()), "en", "s0", 0) for i in range(40)]
    copies = [(200 + i, clean[0][1], "en", "s1", 0) for i in range(30)]
    near = [(300, clean[1][1].replace(" ", "  ").upper().lower(), "en", "s2", 0)]
    odd = [(400, None, None, None, None), (401, "", "en", None, 0)]
    sf = str(tmp_path)
    spark.createDataFrame(clean + junk + copies + near + odd, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    labels = [(d, 1, 0) for d, *_ in clean] + [(d, 0, 0) for d, *_ in junk]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/{name}")
        docs = spark.read.parquet(f"{sf}/{name}")
        seen.append(docs.collect())
    ids = [{x.doc_id for x in rows} for rows in seen]
    assert not ids[0] & {d for d, *_ in junk} and {d for d, *_ in clean + copies + near} <= ids[0]
    assert {d for d, *_ in clean} <= ids[1] and not ids[1] & {d for d, *_ in copies + near}
    assert all(x.n_chars == len(x.text) for x in seen[1] if x.text is not None and x.doc_id < 400)
    assert {d for d, *_ in clean} <= ids[2] and len(seen[2]) == len(ids[2])
    assert ids[3] <= ids[2] and max(map(list(x.doc_id for x in seen[3]).count, ids[3])) <= 2
    texts = {x.doc_id: x.text for x in seen[2]}
    assert all(x.round_trip and list(x.ids) == sp.encode(texts[x.doc_id]) for x in seen[4])
    assert sorted((x.doc_id, tuple(x.ids)) for x in corpus_pipeline.run(spark, sf).collect()) == sorted((x.doc_id, tuple(x.ids)) for x in seen[4])


def test_near_duplicates_are_rows_not_ids(spark):
    text = lambda c: " ".join(f"{c}{i}" for i in range(60))
    docs = [(1, text("a")), (1, text("b")), (2, text("a") + " more"), (None, text("c")), (None, text("c")), (None, text("b")), (None, text("d")), (3, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.jaccard_join(spark, df, "").collect()
    assert sorted((x.doc_id or 0, x.text or "") for x in got) == [(0, text("c")), (0, text("d")), (1, text("a")), (1, text("b")), (3, "")]


def test_sample_is_bounded_after_the_join_and_names_may_clash(spark):
    from framewright.llm import mil_quality
    docs = spark.createDataFrame([(1, f"text {i} words", i) for i in range(60)] + [(7, "other", 0)], "doc_id long, text string, __y int")
    labels = spark.createDataFrame([(1, 1), (7, 0)], "doc_id long, quality int")
    got = mil_quality.score(docs, labels, sample=5)
    assert got.count() == 61 and "__y" in got.columns


def test_pipeline_stages_with_clashing_names_and_empty(spark):
    import corpus_pipeline
    names = ["score", "held_out", "predicted", "size", "times", "target", "taken", "row", "rest", "whole", "lane"]
    cols = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([(i, f"some words number {i} of a text\nand a line {i * 7}", "en", f"s{i % 3}", 5, *names) for i in range(40)], cols)
    for docs in (df, df.limit(0)):
        for stage in (corpus_pipeline.quality_classifier, corpus_pipeline.mix_sources):
            got = stage(spark, docs, "/root/testdata/sf0.001")
            assert got.columns == df.columns
            assert all(r[n] == n for r in got.collect() for n in names)
