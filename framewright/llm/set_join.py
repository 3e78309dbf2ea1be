"""N-gram Jaccard join with set-relation skipping, for documents as sets of word shingles.

Exact prefix filter: under one global order of shingles, rare first, two sets of the wanted
similarity share a shingle of their prefixes. Two skips keep the index lists cheap (after Wang,
Qin, Lin, Zhang and Chang, "Leveraging set relations in exact set similarity join", 2017):

* index lists are cut into blocks by set size and position; a whole block is passed over when no
  set in it can still overlap enough;
* a set's answers are derived from those of a highly similar set: first every set of a list is
  compared with the list's smallest one only. Sets that link with it need no comparison among
  each other; what remains are pairs of a list that lie in different components so far.

Every set pair of the wanted similarity thus ends in one component. Equal sets are one node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import components, written
from .textkit import shingle_sets, slices

SKETCH = 1 << 20  # counters for the global order
BITS = 512  # parity bits of a set's signature
NEED = 1 << 22  # bits of the filter for the texts that are needed


def least_overlap(x: Column, y: Column, num: int) -> Column:
    """Fewest common elements of sets of sizes x and y with 100 * intersection >= num * union."""
    return F.ceil((x + y) * F.lit(num) / F.lit(100.0 + num) - 1e-9)


def parity(hashes: np.ndarray) -> np.ndarray:
    """One bit per hash bucket: the parity of the set's elements in it. Two sets differ in at least
    as many elements as their signatures differ in bits."""
    odd = np.bincount((hashes % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def may_link(a: str, b: str, num: int) -> Column:
    """Whether sets (columns with prefixes a and b: n, bits) of these sizes and signatures may link."""
    x, y = F.col(f"{a}n"), F.col(f"{b}n")
    apart = sum((F.bit_count(F.get(f"{a}bits", F.lit(i)).bitwiseXOR(F.get(f"{b}bits", F.lit(i)))) for i in range(BITS // 64)), F.lit(0))
    return apart <= x + y - 2 * least_overlap(x, y, num)


def sizes_and_sketch(docs: DataFrame, k: int) -> DataFrame:
    """Rows (id, n, digest) of every document, and rows (part, counters): how often a task's
    documents hit each of the ``SKETCH`` hash buckets, 1024 counters to a row."""
    def run(batches):
        total = np.zeros(SKETCH, dtype=np.int64)
        for batch in batches:
            n, digest = [], []
            for _, data, offsets in slices(batch.column("text")):
                sets = shingle_sets(data, offsets, k)
                n += [len(s) for s in sets]
                digest += [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                if sets:
                    total += np.bincount((np.concatenate(sets) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.nulls(len(n), pa.int32()),
                                              pa.nulls(len(n), pa.binary())], ["id", "n", "digest", "part", "counters"])
        if total.any():
            rows = total.astype(np.uint32).reshape(-1, 1024)
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.nulls(len(rows), pa.binary()), pa.array(np.arange(len(rows), dtype=np.int32)),
                                              pa.array([r.tobytes() for r in rows], pa.binary())], ["id", "n", "digest", "part", "counters"])

    return docs.mapInArrow(run, "id long, n long, digest binary, part int, counters binary")


def summed(counters: DataFrame) -> np.ndarray:
    """The counters of all tasks added up, in two levels, so no task reads more than a share; ``SKETCH`` sums come back."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        width = len(pdf["counters"].iloc[0]) // 1024
        total = sum(np.frombuffer(c, dtype=f"u{width}").astype(np.uint64) for c in pdf["counters"])
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "counters": [total.tobytes()]})

    salted = counters.groupBy("part", F.spark_partition_id() % 64).applyInPandas(add, "part int, counters binary")
    out = np.zeros((SKETCH // 1024, 1024), dtype=np.uint64)
    for r in salted.groupBy("part").applyInPandas(add, "part int, counters binary").collect():
        out[r["part"]] = np.frombuffer(bytes(r["counters"]), dtype=np.uint64)
    return np.minimum(out.reshape(-1), 2**31 - 1).astype(np.int32)


def prefixes(docs: DataFrame, k: int, num: int, order: np.ndarray) -> DataFrame:
    """(id, n, digest, bits, prefix) of every document with words; the prefix is in global order."""
    def run(batches):
        for batch in batches:
            for lo, data, offsets in slices(batch.column("text")):
                out = {"id": [], "n": [], "digest": [], "bits": [], "prefix": []}
                ids = batch.column("id").slice(lo, len(offsets) - 1).to_pylist()
                for key, s in zip(ids, shingle_sets(data, offsets, k), strict=True):
                    if len(s) and key is not None:
                        by = np.argsort(order[(s % np.uint64(SKETCH)).astype(np.int64)], kind="stable")
                        keep = len(s) - (num * len(s) + 99) // 100 + 1
                        for c, v in zip(out, (key, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), parity(s), s[by[:keep]].view(np.int64)), strict=True):
                            out[c].append(v)
                yield pa.RecordBatch.from_arrays([pa.array(out["id"], pa.int64()), pa.array(out["n"], pa.int64()), pa.array(out["digest"], pa.binary()),
                                                  pa.array(out["bits"], pa.list_(pa.int64())), pa.array(out["prefix"], pa.list_(pa.int64()))], list(out))

    return docs.mapInArrow(run, "id long, n long, digest binary, bits array<long>, prefix array<long>")


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, k: int, num: int) -> DataFrame:
    """The pairs (a, b) that link. Signatures sort out most of the others without their texts; only
    the texts of the rest travel, picked by a bit filter of fixed size."""
    side = lambda c: sets.select(F.col("id").alias(c), F.col("n").alias(f"{c}n"), F.col("bits").alias(f"{c}bits"))
    near = written(pairs.join(side("a"), "a").join(side("b"), "b").where(may_link("a", "b", num)).select("a", "b").distinct(), "pairs")
    bit = F.pmod(F.xxhash64("id"), F.lit(NEED))
    needed = near.select(F.explode(F.array("a", "b")).alias("id")).select((bit + 1).alias("bit"))  # bitmaps count from 1
    filled = needed.groupBy(F.bitmap_bucket_number("bit").alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    parts = np.zeros((NEED // 32768, 4096), dtype=np.uint8)  # NEED bits, whatever the corpus
    for r in filled:
        parts[r["at"] - 1] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    flat = parts.reshape(-1)

    def wanted(batches):
        for batch in batches:
            bit = np.asarray(batch.column("bit"))
            yield batch.select(["id", "text"]).filter(pa.array((flat[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1))

    texts = docs.where(F.col("id").isNotNull()).withColumn("bit", bit).mapInArrow(wanted, "id long, text string")
    text_of = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"{c}t"))

    def linked(batches):
        for batch in batches:
            keep, last = np.zeros(batch.num_rows, dtype=bool), (None, None)
            a, b = batch.column("at"), batch.column("bt")
            for i in range(batch.num_rows):
                one, two = a.slice(i, 1), b.slice(i, 1)
                if last[0] is None or last[0] != two:
                    last = (two, _set(two, k))
                s = _set(one, k)
                both = len(np.intersect1d(s, last[1], assume_unique=True))
                keep[i] = len(s) > 0 and 100 * both >= num * (len(s) + len(last[1]) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return near.join(text_of("a"), "a").join(text_of("b"), "b").select("a", "b", "at", "bt").mapInArrow(linked, "a long, b long").distinct()


def _set(text: pa.Array, k: int) -> np.ndarray:
    (_, data, offsets), = slices(text)
    return shingle_sets(data, offsets, k)[0]


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, num: int = 85) -> DataFrame:
    """(id, n_shingles, component_id, class_size), one row per row of ``df``.

    A-Z are lower-cased; words are runs of other than ASCII white space; a set holds the distinct
    ``k``-word shingles of the whole text, or the whole sequence where it is shorter. Sets link
    when 100 * intersection >= ``num`` * union. Null, empty and blank texts have the empty set and
    link with nothing. Shingles are compared by 64-bit hash. ``class_size`` counts the rows with
    the same set. Rows that repeat an id are one node in the links. A null id gets the component
    of its class, null where no row of it has an id. An empty table gives no rows. Other columns
    aren't read, so their names can't clash."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    both = written(sizes_and_sketch(docs, k), "sketch")
    base = both.where("part is null").select("id", "n", "digest")
    order = summed(both.where("part is not null").select("part", "counters"))
    classes = base.where("digest is not null").groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("class_size"))
    sets = prefixes(docs, k, num, order).groupBy("digest").agg(F.min_by(F.struct("id", "n", "bits", "prefix"), "id").alias("s")).select("s.*")
    sets = written(sets, "sets")

    # The index lists: one row per prefix shingle and set. Lists of one set are dropped at once.
    size = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / num))).cast("int")
    lists = sets.select(F.posexplode("prefix").alias("pos", "token"), "id", "n").repartition("token")
    first = lists.groupBy("token").agg(F.min(F.struct("id", "n", "pos")).alias("hub"), F.count("*").alias("c")).where("c > 1").select("token", "hub")
    lists = written(lists.join(first, "token").withColumn("block", F.struct(size.alias("size"), (F.col("pos") / 16).cast("int").alias("pos"))), "lists")
    bound = lambda n, p, m, q: F.least(p, q) + 1 + F.least(n - p, m - q) - 1  # noqa: E731  most elements that can still be common
    n, p, hub = F.col("n"), F.col("pos"), F.col("hub")
    star = lists.where((F.col("id") != hub["id"]) & (bound(n, p, hub["n"], hub["pos"]) >= least_overlap(n, hub["n"], num)))
    links = written(verified(star.select(F.col("id").alias("a"), hub["id"].alias("b")).distinct(), sets, docs, k, num), "links")

    # Lists that still span components: blocks of (component, size, position) against each other, then their sets.
    done = components(links, "a", "b").select(F.col("node").alias("id"), "root")
    left = lists.join(done, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = left.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token")
    left = left.join(mixed, "token").select("token", "id", "n", "pos", "root", "block", F.col("hub.id").alias("hub"))
    left = left.withColumn("alone", F.expr("count(*) over (partition by token, root) = 1"))
    left = written(left.join(sets.select("id", "bits"), "id"), "lists").repartition("token")  # one exchange for all joins below
    # Of a list, sets that are alone in their component meet each other, and those of larger components, one by
    # one; larger components meet as blocks first. So no component's own sets are paired, and only pairs that
    # their sizes, positions and signatures allow leave a join.
    side = lambda c: [F.col("id").alias(c), F.col("n").alias(f"{c}n"), F.col("pos").alias(f"{c}p"), F.col("hub").alias(f"{c}hub"), F.col("bits").alias(f"{c}bits")]
    fits = (F.col("a") != F.col("bhub")) & (F.col("b") != F.col("ahub")) & (bound(F.col("an"), F.col("ap"), F.col("bn"), F.col("bp")) >= least_overlap(F.col("an"), F.col("bn"), num)) & may_link("a", "b", num)
    one, many = left.where("alone"), left.where("not alone")
    single = one.select("token", *side("b"))
    singles = one.select("token", *side("a")).join(single, "token").where((F.col("a") < F.col("b")) & fits).select("a", "b")
    uneven = many.select("token", *side("a")).join(single, "token").where(fits).select("a", "b")
    blocks = many.groupBy("token", "root", "block").agg(F.max("n").alias("n"), F.min("n").alias("low"), F.min("pos").alias("pos"))
    other = blocks.toDF("token", "root2", "block2", "n2", "low2", "pos2")
    # no pair of two blocks has more in common: before its place at most the nearer block end, from it on at most what the larger sets have left
    can = F.least(n - p, F.col("n2") - F.col("pos2")) + F.least((F.col("block.pos") + 1) * 16, (F.col("block2.pos") + 1) * 16)
    pairs = blocks.join(other, "token").where((F.col("root") < F.col("root2")) & (F.abs(F.col("block.size") - F.col("block2.size")) <= 1)
                                              & (can >= least_overlap(F.col("low"), F.col("low2"), num))).select("token", "root", "block", "root2", "block2")
    again = many.select("token", F.col("root").alias("root2"), F.col("block").alias("block2"), *side("b"))
    several = pairs.join(many.select("token", "root", "block", *side("a")), ["token", "root", "block"]).join(again, ["token", "root2", "block2"]).where(fits).select("a", "b")
    rest = singles.unionByName(uneven).unionByName(several).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = written(rest.distinct(), "pairs")
    if not rest.isEmpty():
        more = verified(rest, sets, docs, k, num)
        done = components(links.unionByName(more), "a", "b").select(F.col("node").alias("id"), "root")
    roots = classes.join(done.withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("root", "rep").alias("root"), "class_size")
    return base.join(roots, "digest", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id"),
                                                     F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))
