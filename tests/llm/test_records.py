"""URL filters, pseudonyms, sharding and mixing."""

import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from framewright.llm import budget_mix, feistel_pii, url_boosting, vector_packing

URLS = [None, "", "no scheme.com/en/", "http://example.com", "https://example.com/en/1", "https://WWW.Example.COM/en/1?a=b&c=d#x", "http://a.www.example.com/en/",
        "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/fr", "http://x.net/fr/", "ftp://net/es/?x", "://com/", "http://com#frag/", "http://x.org/a?u=http://y.com/", "http://ÉX.com/en/é"]


def plain_judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [(r, v) for r, v in url_boosting.RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return (host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None)))


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = sorted(url_boosting.judge(df).collect())
    for row, url in zip(got, URLS, strict=True):
        host, path, rule, verdict = plain_judge(url)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict or rule is None and row.verdict in ("allow", "block")
    assert url_boosting.judge(df.limit(0)).count() == 0
    assert {r.verdict for r in url_boosting.judge(df.where("page_id in (0, 1, 14)")).collect()} == {"allow"}


def test_trees_learn_what_the_rules_mark(spark):
    r = random.Random(1)
    ruled = [("net/spam/", "block"), ("org/", "allow")]
    urls = ["http://h%d.net/spam/%s" % (i, "x" * r.randint(20, 40) + "9" * 12) for i in range(80)] + ["http://h%d.org/a" % i for i in range(80)]
    rest = ["http://z%d.info/spam/%s" % (i, "x" * 30 + "9" * 12) for i in range(10)] + ["http://y%d.info/a" % i for i in range(10)]
    df = spark.createDataFrame(list(enumerate(urls + rest)), "page_id long, url string").repartition(3)
    verdict = {x.page_id: x.verdict for x in url_boosting.judge(df, rules=ruled).collect()}
    assert [verdict[160 + i] for i in range(20)] == ["block"] * 10 + ["allow"] * 10


def test_suffix_statistics_come_from_all_labelled_urls(spark):
    urls = [f"http://h{i}.net/spam/{i}" for i in range(60)] + [f"http://h{i}.org/a{i % 3}/{i}" for i in range(90)]
    rows = spark.createDataFrame([(u, *u[7:].split("/", 1), float("spam" in u)) for u in urls], "url string, host string, path string, label double")
    known = url_boosting.with_suffixes(rows.withColumn("path", F.concat(F.lit("/"), "path"))).withColumn("fold", F.length("url") % 3)
    stats = {}
    for x in url_boosting.suffix_counts(known).collect():
        a, b = stats.get((x.kind, x.value), (0, 0))
        stats[x.kind, x.value] = (a + x.blocked, b + x.n)
    assert stats["tld", "net"] == (60.0, 60) and stats["tld", "org"] == (0.0, 90) and stats["segment", "/spam"] == (60.0, 60)
    assert stats["segment", "/a0"] == (0.0, 30) and len([k for k in stats if k[0] == "domain"]) == 150
    one = url_boosting.with_rates(known, url_boosting.suffix_counts(known), 0.4, 4.0, apart=True).where("url = 'http://h7.net/spam/7'").first()
    others = sum("net" in u and len(u) % 3 != one.fold for u in urls)  # all but its own fold
    assert 0 < others < 60 and abs(one.tld_rate - (others + 1.6) / (others + 4)) < 1e-12 and abs(one.tld_count - np.log1p(others)) < 1e-12
    assert abs(one.domain_rate - 0.4) < 1e-12 and one.domain_count == 0
    every = url_boosting.with_rates(known, url_boosting.suffix_counts(known), 0.4, 4.0).where("url = 'http://h7.net/spam/7'").first()
    assert abs(every.tld_rate - 61.6 / 64) < 1e-12 and abs(every.domain_rate - 2.6 / 5) < 1e-12
    # the verdict of a row without a rule hangs on its segment, also where the sample has no URL of it
    ruled = [(f"com/s{i:02d}/", ("block", "allow")[i % 2]) for i in range(40)]
    urls = [f"http://h{j:02d}{i:02d}.com/s{i:02d}/q" for j in range(12) for i in range(40)] + [f"http://h99{i:02d}.info/s{i:02d}/q" for i in range(40)]
    verdict = {x.page_id: x.verdict for x in url_boosting.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules=ruled, sample=60).collect()}
    assert [verdict[480 + i] for i in range(40)] == ["block", "allow"] * 20


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def iban(x):
    x = x.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def card(r):
    body = "".join(r.choice("0123456789") for _ in range(15))
    return next(body + c for c in "0123456789" if luhn(body + c))


def run_pii(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("m", F.lit("clash")).withColumn("k", F.lit(1))
    out = feistel_pii.pseudonymise(df.repartition(3))
    assert out.columns == ["doc_id", "text", "m", "k", "n_private"]
    return {r.doc_id: (r.text, r.n_private) for r in out.collect()}


def test_pseudonyms_keep_formats_and_links(spark):
    r = random.Random(5)
    cards = [card(r) for _ in range(40)]
    got = run_pii(spark, [f"pay {c[:4]} {c[4:8]}-{c[8:12]} {c[12:]}." for c in cards] + cards)
    plain = [got[40 + i][0] for i in range(40)]
    assert all(luhn(p) and p != c for p, c in zip(plain, cards)) and len(set(plain)) == 40
    assert [re.sub(r"\D", "", got[i][0]) for i in range(40)] == plain
    assert all(re.fullmatch(r"pay \d{4} \d{4}-\d{4} \d{4}\.", got[i][0]) and got[i][1] == 1 for i in range(40))


def test_every_kind_and_invalid_candidates(spark):
    keep = ["4111111111111112 is no card", "999.1.1.1 and 1.2.3.4.5", "000-12-1234 666-01-0001", "1985-02-30 31/31/1999 1850-01-01", "GB00WEST12345698765432", "order 1234567 of 2024", "a@b", "", "plain\nlines"]
    move = {"ip": "42.144.35.254", "date": "1985-02-28", "us": "02/29/2000", "eu": "31.12.1999", "ssn": "123-45-6789", "phone": "+1 (555) 123-4567",
            "mail": "jo.doe42@mail8.example.com", "iban": "DE89 3704 0044 0532 0130 00", "gb": "GB82WEST12345698765432"}
    texts = [*keep, None, *[f"see {v}, then {v}" for v in move.values()], "x" * 200_000 + " 42.144.35.254"]
    got = run_pii(spark, texts)
    assert [got[i] for i in range(len(keep) + 1)] == [(t, 0) for t in [*keep, None]]
    new = {}
    for i, (k, v) in enumerate(move.items(), len(keep) + 1):
        text, n = got[i]
        a, b = re.fullmatch(r"see (.*), then (.*)", text).groups()
        assert a == b != v and n == 2
        assert [c if not c.isalnum() else "x" for c in a.ljust(20)][:5] == [c if not c.isalnum() else "x" for c in v.ljust(20)][:5] or k == "ip"
        new[k] = a
    assert all(0 <= int(o) <= 255 for o in new["ip"].split(".")) and iban(new["iban"]) and iban(new["gb"]) and new["gb"][4:8].isalpha()
    assert new["phone"].startswith("+1 (") and new["mail"].endswith("@mail8.example.com") and 1900 <= int(new["date"][:4]) <= 2099
    assert got[len(texts) - 1][0] == "x" * 200_000 + " " + new["ip"]


def test_cards_and_ibans_beside_other_digits_and_capitals(spark):
    c, e, x, i = "4111 1111 1111 1111", "3782 822463 10005", "4111111111111111", "DE89 3704 0044 0532 0130 00"
    y, other = "DE89370400440532013000", next(o for n in range(100) if iban(o := f"XX{n:02d} 1234 5678 9012 345"))
    texts = [c, e, i, f"{c} 12/27", f"{x} 123", f"pay 4242 {c} 123.", f"{e} {c}", f"{x}-5500000000000004 {c}", f"{c} 12/05/2027", f"{c} 10.0.0.1", f"{c} 2027-05-01",
             f"{y} EUR", f"{i} BIC COBADEFFXXX", f"IBAN {i} {y} {c}", f"ABC {y} 12", f"{other} EUR", "4111 1111 1111 1112 123", f"{y}X", f"9{c}", "DE90 3704 0044 0532 0130 00 EUR"]
    got = run_pii(spark, texts)
    card, amex, bank = (got[n][0] for n in range(3))
    assert luhn(card.replace(" ", "")) and luhn(amex.replace(" ", "")) and iban(bank) and (card, amex, bank) != (c, e, i)
    plain, bare = card.replace(" ", ""), bank.replace(" ", "")
    assert [got[n] for n in range(3, 8)] == [(f"{card} 12/27", 1), (f"{plain} 123", 1), (f"pay 4242 {card} 123.", 1), (f"{amex} {card}", 2), (f"{plain}-{got[7][0][17:33]} {card}", 3)]
    assert luhn(got[7][0][17:33]) and got[7][0][17:33] != "5500000000000004"
    for n, rest in ((8, "12/05/2027"), (9, "10.0.0.1"), (10, "2027-05-01")):
        assert got[n][0].startswith(card + " ") and rest not in got[n][0] and got[n][1] == 2
    assert [got[n] for n in range(11, 15)] == [(f"{bare} EUR", 1), (f"{bank} BIC COBADEFFXXX", 1), (f"IBAN {bank} {bare} {card}", 3), (f"ABC {bare} 12", 1)]
    assert iban(got[15][0][:-4]) and got[15][0] != texts[15] and got[15][0].endswith(" EUR") and got[15][1] == 1
    assert [got[n] for n in range(16, len(texts))] == [(t, 0) for t in texts[16:]]


def test_permutations_are_one_to_one(spark):
    days = [f"{1900 + i // 336}-{i // 28 % 12 + 1:02d}-{i % 28 + 1:02d}" for i in range(0, 200 * 336, 37)]
    got = run_pii(spark, days)
    assert len({got[i][0] for i in range(len(days))}) == len(days)
    assert all(re.fullmatch(r"(19|20)\d\d-\d\d-\d\d", got[i][0]) for i in range(len(days)))


def document_rows():
    r = random.Random(2)
    texts = [" ".join("w" * r.randint(1, 9) for _ in range(r.randint(0, 200))) for _ in range(300)]
    rows = [(i, t, f"s{i % 5}") for i, t in enumerate(texts)] + [(1000 + i, texts[0] + " hot", "s0") for i in range(250)]
    return [*rows, (2000, None, None), (2001, "", None), (None, "é ü", "s1"), (5, texts[5], "s0"), (5, texts[5], "s0"), (3000, "big " * 5000, "z")]


def test_shards_balance_and_number_every_row(spark):
    rows = document_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").withColumn("size", F.lit("clash")).repartition(4)
    got = vector_packing.shard(df).collect()
    assert sorted((str(x.doc_id), x.size, str(x.text_crc32)) for x in got) == sorted(
        (str(d), len((t or "").encode()) + 1, str(None if t is None else zlib.crc32(t.encode()))) for d, t, _ in rows)
    load = [sum(x.size for x in got if x.shard == s) for s in range(8)]
    assert max(load) - min(load) < 0.02 * sum(load)
    for s in range(8):
        assert sorted(x.slot for x in got if x.shard == s) == list(range(sum(x.shard == s for x in got)))
    where = {}
    for x in got:
        where.setdefault((x.text_crc32, x.size), set()).add(x.shard)
    assert sum(len(w) > 1 for w in where.values()) <= 1  # only the group that exceeds half a shard is cut
    again = vector_packing.shard(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert vector_packing.shard(df.limit(0)).count() == 0


def test_place_prefers_residual_capacity():
    v = np.array([[8.0, 1], [8, 1], [1, 8], [1, 8]])
    assert sorted(vector_packing.place(v, 2)[:2].tolist()) == [0, 1] and sorted(vector_packing.place(v, 2)[2:].tolist()) == [0, 1]
    assert vector_packing.place(np.zeros((0, 3)), 4).tolist() == []


def test_fit_reaches_the_best_sum():
    r = np.random.default_rng(0)
    for _ in range(60):
        lengths = np.unique(r.integers(0, 40, 6))
        counts = r.integers(1, 5, len(lengths))
        budget = int(r.integers(0, int((lengths * counts).sum()) + 5))
        take = budget_mix.fit(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        got = int((take * lengths).sum())
        fixed = counts * budget // max(int((lengths * counts).sum()), 1) if budget < (lengths * counts).sum() else counts
        sums = {int((fixed * lengths).sum())}
        for size, n in zip(lengths, counts - fixed):
            sums = {s + int(size) * k for s in sums for k in range(n + 1)}
        assert abs(got - budget) == min(abs(s - budget) for s in sums) or budget >= (lengths * counts).sum()
    big = budget_mix.fit(np.array([3, 50_000]), np.array([10_000, 100]), 4_000_003)
    assert 0 <= 4_000_003 - int((big * [3, 50_000]).sum()) < 50_000  # proportional shares first: never off by the longest length
    big = budget_mix.fit(np.arange(1, 3000), np.full(2999, 400), 900_000_001)
    assert int((big * np.arange(1, 3000)).sum()) == 900_000_001


def test_targets_share_and_stop_at_the_cap():
    t = budget_mix.targets([100, 1000, 1000], [5, 2, 1])
    assert t[0] == 200 and abs(sum(t) - 3150) < 1e-9 and t[1] <= 2000 and abs(t[1] - 2 * t[2]) < 1e-9 or t[1] == 2000
    assert budget_mix.targets([], []) == [] and budget_mix.targets([0, 0], [5, 2]) == [0.0, 0.0]


def test_mix_takes_each_target(spark):
    rows = document_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).repartition(3)
    got = budget_mix.mix(df, "doc_id", "source", "text").collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for s in {x[2] for x in rows}:
        mine = [x for x in got if x.source == s]
        whole = sum(size(t) for _, t, q in rows if q == s)
        assert {x.source_size for x in mine} == {whole}
        assert abs(sum(x.taken for x in mine) - mine[0].target) <= max(1, 0.1 * whole)
        assert all(0 <= x.times <= 2 and x.taken == x.times * x["size"] for x in mine)
    order = sorted({x[2] for x in rows if x[2] is not None}) + [None]
    want = budget_mix.targets([sum(size(t) for _, t, q in rows if q == s) for s in order], [budget_mix.WEIGHTS[i % 3] for i in range(len(order))])
    assert {x.source: x.target for x in got} == dict(zip(order, want))
    key = lambda x: (str(x.doc_id), x.taken)
    assert sorted(map(key, got)) == sorted(map(key, budget_mix.mix(df.repartition(6), "doc_id", "source", "text").collect()))
    assert budget_mix.mix(df.limit(0), "doc_id", "source", "text").count() == 0
