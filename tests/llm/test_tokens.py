"""Source divergence audit, cross-tokenizer alignment and packing against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from framewright.llm import difference_packing, source_audit, token_align

TEXTS = [None, "", " ", "a", "  two  blanks ", "line\nfeed\n\n next\tTab", "x▁y", "plain <|endoftext|> <s> text", "Ünïcödé ΣΊΣΥΦΟΣ naïve 東京都", "a\x00b \x01", "can't we'll 123 4567",
         "\U0001F600 smile \U0001F600\U0001F600", "a b a b a b", "a b a b a b", "nb sp em \u0085 x", "é ́ combining", "x" * 3000, "y z " * 2500, "tail "]


def frame(spark, texts, parts=3):
    rows = [(i // 2 if i else None, t, f"c{i}") for i, t in enumerate(texts)]  # ids repeat, one is null
    return spark.createDataFrame(rows, "doc_id long, text string, n_a string").repartition(parts)


# --- source divergence audit ---

def plain_audit(rows, least, top):
    groups, langs, docs = {}, {}, {}
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        lang, source = lang or "", source or ""
        groups.setdefault((lang, source), Counter()).update(terms)
        langs.setdefault(lang, Counter()).update(terms)
        docs.setdefault(lang, Counter()).update(set(terms))
    out = []
    for (lang, source), mine in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def share(c):
            whole = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // whole for t in kept}

        p, q = share(mine), share(langs[lang])
        pair = [(sum(abs(p[t] - o[t]) for t in kept), s) for (lg, s), c in groups.items() if lg == lang and s != source for o in [share(c)]]
        term = [(p[t] - q[t], t) for t in kept if mine[t] and p[t] > q[t]]
        for part, found, most in (("pair", pair, None), ("term", term, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, v, i + 1) for i, (v, item) in enumerate(found[:most])]
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_audit_equals_plain(spark, seed):
    r = random.Random(seed)
    words = [f"w{i}".replace("0", "Zé") for i in range(40)] + ["Ünï", "x_y", "ABC", "don't", "\x7f", "東京"]
    rows = [(" ".join(r.choices(words, k=r.randint(0, 30))), r.choice(["en", "de", "", None, "rare"]), r.choice(["s1", "s2", "S3", "é", None, ""])) for _ in range(120)]
    rows += [(None, "en", "only null"), ("", "xx", "empty"), ("", "xx", "empty2"), ("lone words", "yy", "one"), *[("hot Hot hOt", "en", "hot")] * 40]
    df = spark.createDataFrame([(*x, i, "c") for i, x in enumerate(rows)], "text string, lang string, source string, value long, item string").repartition(4)
    got = sorted(tuple(x) for x in source_audit.audit(df, least=5, top=7).collect())
    assert got == plain_audit(rows, 5, 7)


def test_audit_of_an_empty_table_and_without_kept_terms(spark):
    df = spark.createDataFrame([("a b", "en", "s"), ("a", "en", "t")], "text string, lang string, source string")
    assert source_audit.audit(df.limit(0)).count() == 0
    assert sorted(tuple(x) for x in source_audit.audit(df).collect()) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_shares_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_123
    got = spark.range(1).select(source_audit.share(source_audit.F.lit(big), source_audit.F.lit(big + 12345)).alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (big + 5) // (big + 12345)


def test_the_tree_adds_up_what_all_terms_would():
    r = np.random.default_rng(0)
    rows = r.integers(0, 3, (200, 5))
    p = lambda c: 100 + 7 * c
    has = [np.flatnonzero(x) for x in rows]
    parent, source, count, many = source_audit.tree([x[h] for x, h in zip(rows, has, strict=True)], has, np.ones(200, dtype=np.int64))
    assert len(parent) < sum(map(len, has)) and many[parent < 0].sum() == sum(len(h) > 0 for h in has)
    z = np.full(len(source), 90)
    got = source_audit.corrections(parent, source, p(count), z, many, 5)
    for a in range(5):
        for b in range(a + 1, 5):
            on = rows[(rows[:, a] > 0) & (rows[:, b] > 0)]
            x, y = p(on[:, a]), p(on[:, b])
            assert got[a, b] == (abs(x - y) - abs(x - 90) - abs(90 - y)).sum()


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(source_audit, "SLICE", 7)
    text = "abcdefghijkl mn  op qrstuvwxyzé ab"
    assert [w for x in source_audit.terms_of(text) for w in x] == text.encode().split()


# --- cross-tokenizer alignment ---

def plain_align(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(token_align.MODEL_A), SentencePieceProcessor(model_file=token_align.MODEL_B)
    a.encode_special_tokens = True
    alphabet = token_align.byte_alphabet()
    docs, counts = [], Counter()
    for t in texts:
        groups, links, ids_a, ids_b = [], [], [], []
        if t:
            ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
                ids_a, ids_b = [], []
            else:
                ends_a, ends_b = (list(np.cumsum([len(x) for x in one])) for one in (bytes_a, bytes_b))
                at_a, at_b, i, j = {e: n for n, e in enumerate(ends_a)}, {e: n for n, e in enumerate(ends_b)}, 0, 0
                for end in ends_a:
                    if end in at_b:
                        groups.append((ids_a[i:at_a[end] + 1], ids_b[j:at_b[end] + 1]))
                        i, j = at_a[end] + 1, at_b[end] + 1
                        links.append((ids_a[i - 1], ids_b[j - 1]))
        counts.update(links)
        docs.append((len(ids_a), len(ids_b), groups, links))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for na, nb, groups, links in docs:
        s = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((na, nb, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(s.encode()).hexdigest() if s else "", s))
    return out


def test_alignment_equals_plain(spark):
    df = frame(spark, TEXTS)
    got = sorted(((r.doc_id is None, r.doc_id), *r[1:]) for r in token_align.align(df, with_groups=True).collect())
    want = sorted((((i == 0), None if i == 0 else i // 2), *x) for i, x in enumerate(plain_align(TEXTS)))
    assert got == want
    assert token_align.align(df.limit(0)).count() == 0
    assert "groups" not in token_align.align(df).columns


def test_alignment_of_given_documents_equals_plain(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    df = spark.createDataFrame(rows).repartition(5)
    got = {r[0]: tuple(r[1:]) for r in token_align.align(df, with_groups=True).collect()}
    for row, want in zip(rows, plain_align([r.text for r in rows]), strict=True):
        assert got[row.doc_id] == want


def test_coalescing_joins_what_overlaps():
    starts, ends = np.array([0, 2, 0, 3, 5, 5]), np.array([2, 5, 3, 5, 6, 6])
    order, group = token_align.coalesce(starts, ends)
    of = np.empty(6, dtype=int)
    of[order] = group
    assert of.tolist() == [0, 0, 0, 0, 1, 1]


def test_cache_is_forgotten_without_effect():
    aligner = token_align.Aligner(token_align.MODEL_A, token_align.MODEL_B, most=0)
    texts = ["one two three", "two three four", "x" * 500 + " two"]
    first = aligner.align(texts)
    assert first == aligner.align(texts) == token_align.Aligner(token_align.MODEL_A, token_align.MODEL_B).align(texts)


# --- packing ---

def check_pieces(rows, texts, capacity):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(difference_packing.TOKENIZER)
    whole = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4") for t in texts]
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == list(range(len(texts)))
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(whole[doc])
            assert r.ids_crc32 == zlib.crc32(whole[doc][at:at + r.length].tobytes())
            assert not hasattr(r, "ids") or r.ids == whole[doc][at:at + r.length].tolist()
            at += r.length
        assert at == len(whole[doc])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and at & (at - 1) == 0  # full, or a smaller power of two
    return by_sequence


def test_packing_keeps_every_id_once_and_pads_nothing(spark):
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, length string, offset int").repartition(3)
    for capacity, ids in ((4096, False), (64, True)):
        check_pieces(difference_packing.pack(df, capacity=capacity, with_ids=ids).collect(), TEXTS, capacity)
    assert difference_packing.pack(df.limit(0)).count() == 0


def test_packing_of_given_documents_in_several_lanes(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    texts = [r.text for r in rows] + ["", None] * 200
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = check_pieces(difference_packing.pack(df, lane_windows_most=20, lane_items=100).collect(), texts, 4096)
    full = [x for x in found.values() if sum(r.length for r in x) == 4096]
    lanes = {s >> 32 for s in found}
    assert len(lanes) > 3 and len(found) - len(full) <= 12 * len(lanes)
    assert sum(len(x) for x in found.values()) < len(texts) + 2 * len(full) + 13 * len(lanes)  # few cuts


def test_null_and_repeated_ids_pack(spark):
    big = (1 << 60) + 1
    df = spark.createDataFrame([(None, "a b"), (big, "c"), (big, "c")], "doc_id long, text string")
    got = difference_packing.pack(df).collect()
    assert {r.doc_id for r in got} == {None, big}
    assert sum(r.length for r in got) == 7


def spread(sizes, window, k):
    sums = np.bincount(window, weights=sizes, minlength=k)
    return sums.max() - sums.min()


def test_differencing_beats_greedy_spread():
    r = np.random.default_rng(3)
    better = 0
    for _ in range(20):
        sizes, k = r.integers(1, 4096, 200), int(r.integers(2, 30))
        window = difference_packing.differencing(sizes, k)
        assert window.shape == (200,) and set(window) <= set(range(k))
        greedy, sums = np.zeros(200, dtype=int), np.zeros(k)
        for i in np.argsort(-sizes):
            greedy[i] = np.argmin(sums)
            sums[greedy[i]] += sizes[i]
        better += spread(sizes, window, k) <= spread(sizes, greedy, k)
    assert better >= 18
    assert spread(np.array([8, 7, 6, 5, 4]), difference_packing.differencing(np.array([8, 7, 6, 5, 4]), 2), 2) == 2  # the published example


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_windows_hold_everything_within_capacity(sizes):
    sizes = np.array(sizes, dtype=np.int64)
    for found, rest in ((difference_packing.windows(sizes, 64), None), (difference_packing.lane_windows(sizes, 64), int(sizes.sum()) % 64)):
        cells = sorted((i, s + j) for w in found for i, s, n in w for j in range(n))
        assert cells == [(i, j) for i, n in enumerate(sizes) for j in range(n)]
        fill = [sum(n for _, _, n in w) for w in found]
        assert all(0 < f <= 64 for f in fill)
        if rest is None:
            assert len(found) == -(-int(sizes.sum()) // 64)  # the count rises only as far as it must
        else:
            assert sorted(f for f in fill if f < 64) == [1 << b for b in range(6) if rest >> b & 1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abZé ΣİßǺ̸,.<|>'-_!1²\t\n\x1c\x85\xa0東ａ﷐endoftxs")), max_size=30), max_size=4))
def test_ids_of_words_equal_those_of_whole_texts(texts):
    words, aligner = difference_packing.words_of(difference_packing.TOKENIZER), token_align.aligner_of(token_align.MODEL_A, token_align.MODEL_B)
    texts = [*texts, "<|ENDOFTEXT|> a", "x<|endoftext|>,y <|startoftext|>'s don't, Don'T."]
    want = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in words.encode(pa.array(texts, pa.string()))] == want
    for t, (n_a, n_b, groups, _) in zip(texts, aligner.align(texts), strict=True):
        a, b = aligner.a.encode(" " + t, add_special_tokens=False).ids, aligner.b.encode(t)
        if n_a:
            assert [int(x) for g in groups.split(";") for x in g.split("|")[0].split(",")] == a
            assert [int(x) for g in groups.split(";") for x in g.split("|")[1].split(",")] == b
        else:
            assert not t or "".join(aligner.b.id_to_piece(b)).replace("▁", " ") != " " + t


def test_forgotten_words_and_long_ones():
    words = difference_packing.Words(difference_packing.TOKENIZER, most=0)
    texts = pa.array(["one two, three l'eau", None, "two ... a" + "b" * 200, "", "çà ÇÀ 12x3 don't can''t 's ''", "aaaaaaaa aaaa abababab"])
    want = [words.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    for _ in range(2):
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in words.encode(texts)] == want


def test_align_moves_a_chunk_at_a_time_and_its_links_as_bytes(spark):
    df = frame(spark, TEXTS)
    doc = token_align.aligned(df, "doc_id", "text", token_align.MODEL_A, token_align.MODEL_B, False).schema["docs"].dataType.elementType
    assert doc["links"].dataType.typeName() == "binary"
    plan = token_align.align(df)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan


@pytest.mark.parametrize("pairs", [1, 1 << 16, (1 << 16) + 1, 200_000])
def test_links_are_looked_up_by_as_many_bytes_as_the_pairs_need(pairs):
    r = np.random.default_rng(pairs)
    places = [r.integers(0, pairs, n) for n in (3, 0, 500, 1)] + [np.array([pairs - 1, 0])]
    links = pa.array([x.astype(token_align.wide(pairs)).tobytes() for x in places], pa.binary())
    found = pa.table({"pair": np.arange(pairs), "count": r.integers(1, 1 << 40, pairs), "best": r.random(pairs) < 0.5})
    for lo, hi in ((0, 5), (1, 4), (1, 2)):
        got = [x.to_pylist() for x in token_align.looked_up(links.slice(lo, hi - lo), found)]
        assert got == [[int(f(x)) for x in places[lo:hi]] for f in (len, lambda x: found["count"].to_numpy()[x].sum(), lambda x: found["best"].to_numpy()[x].sum())]
    assert token_align.wide(pairs).itemsize == (2 if pairs <= 1 << 16 else 4)


def test_align_deals_its_long_rows_out_to_files(spark, monkeypatch, tmp_path):
    made, plain = [], token_align.written
    monkeypatch.setattr(token_align, "PER_TASK", 2)
    monkeypatch.setattr(token_align, "written", lambda *args: made.append(plain(*args)) or made[-1])
    df = spark.createDataFrame([(i, "word " * 300_000) for i in range(5)], "doc_id long, text string").coalesce(1)
    assert token_align.align(df).count() == 5
    assert made[0].count() == 5 and len(made[0].inputFiles()) == 3  # a text longer than a chunk is one of its own
