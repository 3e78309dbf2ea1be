"""Byte helpers, components, line dedup and the n-gram join against plain Python."""

import contextlib
import hashlib
import io
import itertools
import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from framewright.llm import frames, line_dedup, set_join, textkit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", "  \n", "one", "One two", "a\tb c\nd e", "é ñ A B", "x" * 3000, "to be or not to be or not to be", " lead and trail ", "a b c"]


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def root(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


@pytest.mark.parametrize("size", [1, 8, 1 << 20])
def test_words_and_shingles_of_slices(size):
    col, counts, sets = pa.array(TEXTS), [], []
    for _, data, offsets in textkit.slices(col, size):
        counts += np.diff(textkit.spans(data, offsets)[2]).tolist()
        sets += [len(s) for s in textkit.shingle_sets(data, offsets, 4)]
    words = [WORD.findall(lower(t)) for t in TEXTS]
    assert counts == [len(w) for w in words]
    assert sets == [len({tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))}) if w else 0 for w in words]
    assert textkit.word_counts(col.slice(4, 3)).tolist() == counts[4:7]


def test_equal_words_hash_equally_anywhere():
    data = np.frombuffer("abc x abc abd".encode(), dtype=np.uint8)
    s, e, _ = textkit.spans(data, np.array([0, len(data)]))
    h = textkit.span_hashes(data, s, e)
    assert h[0] == h[2] and len(set(h.tolist())) == 3


def test_components_match_union_find(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(900, n) for n in range(800, 899)]
    u = Union(range(1000))
    for a, b in edges:
        u.link(a, b)
    got = {x.node: x.root for x in frames.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {n: u.root(n) for n in got} and set(got) == {n for e in edges for n in e if e[0] != e[1]}
    assert frames.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def blocks_of(norm):
    words, bits = list(dict.fromkeys(norm.split(" "))), []
    for i in range(line_dedup.HASHES):
        hashes = [xxhash.xxh64_intdigest(struct.pack("<i", i), xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
        bits += [2 * sum(h >> b & 1 for h in hashes) > len(words) for b in range(64)]
    return [tuple(bits[b:b + line_dedup.BITS]) for b in range(0, len(bits), line_dedup.BITS)]


def brute_lines(docs, similarity=0.8, far=48):
    lines = [(d is not None, d, n, line) for d, t in docs if t is not None for n, line in enumerate(t.split("\n"))]
    norm = [re.sub("[\x00-/:-@\\[-`{-\xbf\xd7\xf7]+", " ", line.lower()).strip(" ") for *_, line in lines]
    names = sorted({x for x in norm if x})
    u, sig = Union(names), {x: blocks_of(x) for x in names}
    for a, b in itertools.combinations(names, 2):
        apart = sum(p != q for x, y in zip(sig[a], sig[b]) for p, q in zip(x, y))
        if apart <= far and any(x == y for x, y in zip(sig[a], sig[b])) and levenshtein(a, b) <= (1 - similarity) * max(len(a), len(b)) + 1e-9:
            u.link(a, b)
    first, kept = {}, {}
    for i in sorted(range(len(lines)), key=lambda i: (lines[i][0], lines[i][1] or 0, lines[i][2])):
        root = u.root(norm[i]) if norm[i] else None
        kept[i] = root is None or root not in first
        first.setdefault(root, i)
    return sorted([(str(lines[i][1]), lines[i][2], kept[i]) for i in kept])


def line_docs():
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(300)]
    line = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    base = [line(40) for _ in range(3)]
    docs = [(i, "\n".join([line(r.randint(1, 30)), "The End.", base[i % 3]])) for i in range(10)]
    for i in range(10, 40):  # near copies of the three lines: one or two words differ
        w = base[i % 3].split(" ")
        for _ in range(r.randint(1, 2)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        docs.append((i, "\n".join(["the end", " ".join(w).upper() + "!", ""])))
    return [*docs, (3, docs[3][1]), (3, docs[3][1]), (50, None), (51, ""), (52, "--\n\n..."), (53, "w " * 3000 + "\n" + line(5)), (54, " ".join(f"w{i}" for i in range(700))), (55, " ".join(f"w{i}" for i in range(701))), (None, base[0])]


def test_line_dedup_matches_brute_force(spark):
    docs = line_docs()
    got = line_dedup.mark(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    want = brute_lines(docs)
    assert sorted((str(x.doc_id), x.line_no, x.kept) for x in got) == want
    assert sum(not k for *_, k in want) > 60
    assert all((x.group is None) <= x.kept for x in got)


@pytest.mark.parametrize(("words", "least"), [((6, 10), 0.6), ((11, 20), 0.8), ((21, 40), 0.7), ((41, 80), 0.6)])
def test_line_dedup_recall_by_length(spark, words, least):
    r = random.Random(words[0])
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(4, 8))) for _ in range(3000)]
    docs = []
    for i in range(200):  # pairs of lines of edit similarity 0.8 or more; a tenth of the words differ, at least one
        a = [r.choice(vocabulary) for _ in range(r.randint(*words))]
        b = list(a)
        for at in r.sample(range(len(a)), max(1, len(a) // 10)):
            b[at] = r.choice([w for w in vocabulary[:200] if len(w) == len(a[at])])
        x, y = " ".join(a), " ".join(b)
        if x != y and levenshtein(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9:
            docs += [(2 * i, x), (2 * i + 1, y)]
    got = line_dedup.mark(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(docs) > 200 and all(x.kept for x in got if x.doc_id % 2 == 0)
    assert sum(not x.kept for x in got) >= least * len(docs) / 2


def changed(words, vocabulary, share, r):
    words = list(words)
    for _ in range(max(1, int(len(words) * share))):
        at, how = r.randrange(len(words)), r.random()
        if how < 0.3:
            words.insert(at, r.choice(vocabulary))
        elif how < 0.6 and len(words) > 1:
            words.pop(at)
        else:
            words[at] = r.choice(vocabulary)
    return words


def test_verified_pairs_are_exact(spark):
    r = random.Random(1)
    vocabulary = ["".join(r.choice("abcdefghijkl") for _ in range(r.randint(3, 8))) for _ in range(5000)]
    lines, want = [], set()
    for i in range(0, 400, 2):
        a = [r.choice(vocabulary[:40] if i % 4 else vocabulary) for _ in range(r.randint(1, 25))]
        x, y = " ".join(a), " ".join(changed(a, vocabulary, r.random() * 0.5, r))
        lines += [(i, x), (i + 1, y)]
        if x != y and levenshtein(x, y) <= int(max(len(x), len(y)) * 0.2 + 1e-9):
            want.add((i, i + 1))

    def links(lines):
        key = {n: int.from_bytes(hashlib.md5(x.encode()).digest()[:8], "big", signed=True) for n, x in lines}
        occ = spark.createDataFrame(lines, "n long, norm string").withColumn("key", F.unhex(F.md5("norm")))
        pairs = [(key[n], key[n + 1]) for n, _ in lines[::2] if key[n] != key[n + 1]]
        name = {v: n for n, v in key.items()}
        return {(name[x.a] // 2 * 2, name[x.a] // 2 * 2 + 1) for x in line_dedup.verified(spark.createDataFrame(pairs, "a long, b long"), occ, 0.8).collect()}

    assert links(lines) == want and 50 < len(want) < 150
    long = [r.choice(vocabulary) for _ in range(10000)]
    pair = [(0, " ".join(long)), (1, " ".join(changed(long, vocabulary, 0.05, r)))]
    assert links(pair) == {(0, 1)}


def test_line_dedup_rebuilds_documents(spark):
    docs = [(1, "Alpha beta\n\ngamma delta", "x"), (2, "ALPHA, beta\nnew line here", "y"), (3, "gamma   delta", "z"), (4, None, "n"), (5, "", "e"), (6, "..", "d"), (7, "alpha beta", "all gone")]
    df = spark.createDataFrame(docs, "doc_id long, text string, `group` string").withColumn("kept", F.lit(1)).withColumn("line no", F.lit(2))
    got = line_dedup.apply(df)
    assert got.columns == df.columns
    assert {x.doc_id: x.text for x in got.collect()} == {1: "Alpha beta\n\ngamma delta", 2: "new line here", 4: None, 5: "", 6: ".."}
    assert line_dedup.apply(df.limit(0)).count() == 0 and line_dedup.mark(df.limit(0)).count() == 0


def brute_sets(docs, k, num):
    sets = {}
    for d, t in docs:
        w = WORD.findall(lower(t))
        sets.setdefault(d, []).append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    u = Union(sets)
    for a, b in itertools.combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b]):
            u.link(a, b)
    return sorted((d, len(s), u.root(d)) for d in sets for s in sets[d])


@pytest.mark.parametrize(("k", "num"), [(4, 85), (2, 50)])
def test_set_join_matches_brute_force(spark, k, num):
    r = random.Random(k)
    words = ["w%d" % i for i in range(60)]
    passage = [r.choice(words) for _ in range(25)]
    docs = []
    for i in range(12):
        body = passage + [r.choice(words) for _ in range(r.randint(3, 60))]
        for j in range(8):  # drifting copies: neighbours link, the ends may not
            docs.append((10 * i + j, " ".join(body)))
            body = list(body)
            body[r.randrange(len(body))] = r.choice(words).upper()
    docs += [(200 + i, t) for i, t in enumerate(["", None, " \n", "a b", "A b", "a b c", "tail " * 5000])]
    docs += [docs[0], docs[0], (5000, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("clash")).repartition(5)
    got = set_join.join(df, k=k, num=num)
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got.collect()) == brute_sets(docs, k, num)
    assert {x.doc_id: x.class_size for x in got.collect()}[5000] >= 4


def test_set_join_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (None, "z")], "doc_id long, text string")
    assert sorted((x.doc_id or -1, x.component_id or -1) for x in set_join.join(df).collect()) == [(-1, -1), (-1, 7), (7, 7)]
    assert set_join.join(df.limit(0)).count() == 0


@pytest.mark.parametrize(("k", "num", "own", "more", "sizes"), [(4, 85, 0.08, 0.1, (300, 600, 1000)), (5, 80, 0.13, 0.14, (500, 1000))])
def test_set_join_links_copies_with_an_added_passage(spark, k, num, own, more, sizes):
    docs, new = [], itertools.count()
    words = lambda n: ["w%d" % next(new) for _ in range(n)]
    for g, n in enumerate(sizes):
        body, passage = words(n), words(int(n * more))
        group = [body + words(int(n * own))]  # first of all lists of the body; too far from the copies with the passage
        group += [body + words(1) for _ in range(3)] + [body + passage + words(1) for _ in range(3)]
        docs += [(100 * g + i, " ".join(w)) for i, w in enumerate(group)]
    want = brute_sets(docs, k, num)
    assert {c for *_, c in want} == {100 * g for g in range(len(sizes))}
    got = set_join.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), k=k, num=num).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == want


def test_small_tables_are_joined_in_one_pass_with_the_same_rows(spark, monkeypatch):
    rng, tables, written = random.Random(11), [], line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, name: tables.append(name) or written(df, name))
    words = [f"word{i}" for i in range(60)]
    base = [" ".join(rng.choices(words, k=rng.randint(3, 25))) for _ in range(30)]
    lines = base + [line.replace("word1", "ward1", 1) for line in base] + [f"{line} more" for line in base]
    rng.shuffle(lines)
    df = spark.createDataFrame([(i, "\n".join(lines[3 * i:3 * i + 3])) for i in range(30)], "doc_id long, text string")
    rows = lambda: sorted(map(tuple, line_dedup.mark(df).collect()))
    one = rows()
    assert tables.count("pairs") == 3  # one of either search and what is left to verify
    monkeypatch.setattr(line_dedup, "ONE_PASS", 0)
    assert rows() == one and tables.count("pairs") == 3 + 2 * line_dedup.PASSES + 1
    assert len({group for _, _, group, _ in one}) < 60


def test_crowded_blocks_give_the_same_rows(spark, monkeypatch):
    docs = line_docs()
    want, tables, written = brute_lines(docs), [], line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, name: tables.append(name) or written(df, name))
    rows = lambda: sorted((str(x.doc_id), x.line_no, x.kept) for x in line_dedup.mark(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect())
    assert rows() == want and tables.count("simhash") == 1  # no block is crowded, so none is joined a second time
    for crowd in (2, 1):
        monkeypatch.setattr(line_dedup, "CROWD", crowd)
        assert rows() == want
    assert tables.count("simhash") == 5


def test_line_dedup_joins_the_blocks_of_few_lines_in_one_small_plan(spark, monkeypatch):
    plans, written = [], line_dedup.written

    def seen(df, name):
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain()
        plans.append(plan.getvalue())
        return written(df, name)

    monkeypatch.setattr(line_dedup, "written", seen)
    assert line_dedup.mark(spark.createDataFrame(line_docs(), "doc_id long, text string")).count() > 100
    of_blocks = [p for p in plans if "Generate explode(concat(" in p]
    assert len(of_blocks) == 1 and len(re.findall(r"Join \[", of_blocks[0])) == 1  # every join costs the driver threads and memory


def test_simhash_is_code_that_the_jvm_compiles(spark):
    lines = [(1, "a b c"), (2, " ".join(f"w{i}" for i in range(200)))]
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows no code before it runs
    try:
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            line_dedup.simhash(spark.createDataFrame(lines, "node long, norm string").repartition("node")).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", plan.getvalue())]
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize("n", [1, 6, 7, 8, 126, 127, 128, 133, 134, 254, 255, 900])
def test_simhash_counts_the_votes_of_all_words(spark, n):
    norm = " ".join(f"w{i}" for i in range(n))
    row = line_dedup.simhash(spark.createDataFrame([(1, norm)], "node long, norm string").repartition("node")).first()
    bits = [bit for block in blocks_of(norm) for bit in block]
    assert [bool(row[f"s{b // 64}"] >> b % 64 & 1) for b in range(len(bits))] == bits and row.size == len(norm)
