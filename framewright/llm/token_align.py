"""Cross-tokenizer alignment by interval coalescing.

All tokens of two tokenizers A and B are byte intervals on one axis. Lexsorted by start, with a running
maximum (``maximum.accumulate``) of their ends, a group breaks where a start reaches the running maximum: there
tokens of A and B both end. A and B tokens of a group that end together are linked, which the
corpus-wide counts of linked id pairs then weigh.

Neither tokenizer joins bytes across a blank between two characters other than white space, so a text is cut there
into units, the distinct units of a chunk of texts are encoded and coalesced together, and a text's groups are
its units' groups one after the other. The counts are looked up once per chunk and distinct pair, not
once per link: a chunk's texts travel as one row with its distinct pairs, whatever the corpus holds.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import hashlib
import itertools
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import chunks_of, written
from .textkit import byte_alphabet

MODEL_A = "/opt/tokenizers/byte_bpe_50k.json"
MODEL_B = "/opt/tokenizers/piece_bpe_32k.model"
#: The published pattern that splits text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CUT = re.compile(r"(?<=\S)(?= \S)")
PER_TASK = 8  # chunks of about 1 MB of text


def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): intervals by start, and the number of the group that each of them lies in."""
    order = np.lexsort((ends, starts))
    top = np.maximum.accumulate(ends[order])
    breaks = np.concatenate([[0], starts[order][1:] >= top[:-1]]).astype(np.int64)
    return order, np.cumsum(breaks)


def ranks_of(file: str) -> dict[bytes, int] | None:
    """Bytes and ids of a byte-level BPE file whose merges rank by id and that splits text by ``PATTERN``; None for other files."""
    with open(file, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = {k: v for k, v in model.items() if k not in ("type", "vocab", "merges") and v}
    if model["type"] != "BPE" or plain or spec["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
        return None
    special = {t["content"] for t in spec["added_tokens"]}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [model["vocab"].get(x + y, -1) for x, y in pairs]
    if made != sorted(set(made)) or made and made[0] < 256:
        return None
    of = byte_alphabet()
    return {bytes(of[c] for c in k): i for k, i in model["vocab"].items() if k not in special}


class Aligner:
    """Both tokenizers, and what is known of units: (A tokens, B tokens, groups as text, linked pairs), or None where bytes differ.

    Where A's file allows it, units of Latin letters (those that every Unicode version classes alike) are encoded
    by the faster of the two libraries that read such vocabularies; the ids are the same."""

    def __init__(self, file_a: str, file_b: str, most: int = 40_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor

        self.file, self.b, self.fast = file_a, SentencePieceProcessor(model_file=file_b), None
        if ranks := ranks_of(file_a):
            import tiktoken
            self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.bytes_a = [b""] * (max(ranks.values()) + 1)
            for data, i in ranks.items():
                self.bytes_a[i] = data
        else:
            of = byte_alphabet()
            self.bytes_a = [bytes(of.get(c, 0x3F) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size(with_added_tokens=False))]
        size = len(self.bytes_a)
        piece = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(piece)]
        self.size_a, self.size_b = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.bytes_a, self.bytes_b))
        # an id as text with what follows it: "," inside a group, "|" after its last A token, ";" after its last B token
        self.text_a, self.text_b = (np.array([f"{i}{c}" for i in range(n) for c in "," + last], dtype=object) for n, last in ((size, "|"), (len(piece), ";")))
        self.most, self.known = most, {}

    @functools.cached_property
    def a(self):
        """The tokenizers library's reader of A's file, loaded where it is needed."""
        from tokenizers import Tokenizer

        a = Tokenizer.from_file(self.file)
        a.encode_special_tokens = True
        return a

    def units(self, text: str) -> list[str]:
        return CUT.split(" " + text)

    def encode_a(self, units: list[str]) -> list[list[int]]:
        quick = [self.fast is not None and (u.isascii() or max(u) < "\u0250") for u in units]
        rest = [u for u, q in zip(units, quick, strict=True) if not q]
        slow = iter(self.a.encode_batch(rest, add_special_tokens=False) if rest else [])
        return [self.fast.encode_ordinary(u) if q else next(slow).ids for u, q in zip(units, quick, strict=True)]

    def learn(self, units: list[str]) -> None:
        """Encode and coalesce new units, about 256 KB on one axis at a time."""
        lo, ends = 0, np.cumsum([len(u) for u in units])
        while lo < len(units):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + (1 << 18))))
            some = units[lo:hi]
            self.put(some, self.encode_a(some), self.b.encode([x[1:] for x in some], num_threads=1))
            lo = hi

    def put(self, units: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> None:
        a, b = (np.array(list(itertools.chain.from_iterable(x)), dtype=np.int64) for x in (ids_a, ids_b))
        n_a, n_b = (np.array(list(map(len, x)), dtype=np.int64) for x in (ids_a, ids_b))
        data = [u.encode() for u in units]
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        cut, cut_a, cut_b = np.cumsum([len(x) for x in data]), np.cumsum(n_a), np.cumsum(n_b)
        spelled = [b"".join(map(table.__getitem__, x.tolist())) for table, x in ((self.bytes_a, a), (self.bytes_b, b))]
        whole = b"".join(data)
        if not (spelled[0] == spelled[1] == whole and n_a.all() and n_b.all() and (end_a[cut_a - 1] == cut).all() and (end_b[cut_b - 1] == cut).all()):
            spells = lambda x, table, want: b"".join(map(table.__getitem__, x)) == want
            good = [i for i, x in enumerate(data) if spells(ids_a[i], self.bytes_a, x) and spells(ids_b[i], self.bytes_b, x)]
            self.known.update(dict.fromkeys(units))
            if good:
                self.put(*([x[i] for i in good] for x in (units, ids_a, ids_b)))
            return
        starts = np.concatenate([end_a - self.size_a[a], end_b - self.size_b[b]])
        order, group = coalesce(starts, np.concatenate([end_a, end_b]))
        of = np.empty(len(order), dtype=np.int64)
        of[order] = group
        of_a, of_b = of[:len(a)], of[len(a):]
        # tokens of a group that end together: its last ones, as the group breaks at every end in common
        is_a, is_b = np.diff(of_a, append=-1) != 0, np.diff(of_b, append=-1) != 0
        last_a, last_b = np.flatnonzero(is_a), np.flatnonzero(is_b)
        pairs = (b[last_b] << 32 | a[last_a]).tobytes()
        texts = np.empty(len(order), dtype=object)
        texts[np.arange(len(a)) + np.concatenate([[0], last_b + 1])[of_a]] = self.text_a[2 * a + is_a]
        texts[np.arange(len(b)) + (last_a + 1)[of_b]] = self.text_b[2 * b + is_b]
        texts, ends, groups = texts.tolist(), (cut_a + cut_b).tolist(), (8 * (of_a[cut_a - 1] + 1)).tolist()
        lo = g = 0
        for unit, x, y, hi, h in zip(units, n_a.tolist(), n_b.tolist(), ends, groups, strict=True):
            self.known[unit] = (x, y, "".join(texts[lo:hi]), pairs[g:h])
            lo, g = hi, h

    def align(self, texts: list[str | None]) -> list[tuple[int, int, str, bytes]]:
        """(A tokens, B tokens, groups as text, pairs as 64-bit numbers ``b << 32 | a``) of every text."""
        units = [self.units(t) if t else [] for t in texts]
        every = dict.fromkeys(itertools.chain.from_iterable(units))
        self.learn([u for u in every if u not in self.known])
        out = []
        for one in units:
            got = list(map(self.known.__getitem__, one))
            if not got or None in got:
                out.append((0, 0, "", b""))
            else:
                n_a, n_b, groups, pairs = zip(*got, strict=True)
                out.append((sum(n_a), sum(n_b), "".join(groups)[:-1], b"".join(pairs)))
        if len(self.known) > self.most:
            self.known = {u: self.known[u] for u in every if len(u) <= 64}
        return out


@functools.lru_cache(maxsize=1)
def aligner_of(file_a: str, file_b: str) -> Aligner:
    return Aligner(file_a, file_b)


def wide(pairs: int) -> np.dtype:
    """The numbers that tell so many pairs apart."""
    return np.dtype(np.uint16 if pairs <= 1 << 16 else np.uint32)


def release() -> None:
    """Give back the memory of the tokenizers, which a worker keeps from task to task, and with them what it has set aside."""
    if aligner_of.cache_info().currsize:
        aligner_of.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)


def aligned(df: DataFrame, id_col: str, text_col: str, file_a: str, file_b: str, with_groups: bool) -> DataFrame:
    """A row per chunk of texts: (chunk, docs, pairs, times). ``docs`` refers to the chunk's distinct pairs by place, as numbers
    of ``wide(pairs)`` in one run of bytes: Parquet's reader holds a whole file's rows of arrays at once, at several numbers a value."""
    some = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    doc = some.drop("text").schema.add("n_a", "long").add("n_b", "long").add("sha", "string").add("groups", "string").add("links", "binary")
    schema = T.StructType().add("docs", T.ArrayType(doc)).add("pairs", T.ArrayType(T.LongType())).add("times", T.ArrayType(T.LongType()))
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        aligner = aligner_of(file_a, file_b)
        for batch in batches:
            for part in chunks_of(batch, 1):
                n_a, n_b, groups, links = zip(*aligner.align(part.column(1).to_pylist()), strict=True)
                sha = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in groups]
                codes, place, times = np.unique(np.frombuffer(b"".join(links), dtype=np.int64), return_inverse=True, return_counts=True)
                place, ends = place.astype(wide(len(codes))), np.cumsum([0] + [len(x) // 8 for x in links])
                place = pa.array([place[a:b].tobytes() for a, b in itertools.pairwise(ends.tolist())], pa.binary())
                cols = [part.column(0), *(pa.array(x, t) for x, t in zip((n_a, n_b, sha, groups if with_groups else [None] * len(sha)), types, strict=False)), place]
                docs = pa.StructArray.from_arrays(cols, ["id", "n_a", "n_b", "sha", "groups", "links"])
                one = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (docs, pa.array(codes, pa.int64()), pa.array(times, pa.int64()))]
                yield pa.RecordBatch.from_arrays(one, ["docs", "pairs", "times"])
        aligner.known = {}  # the worker goes on to other stages

    return some.mapInArrow(run, schema)


def looked_up(links: pa.Array, found: pa.Table) -> list[pa.Array]:
    """The number of every text's links, and the sums of their pairs' ``count`` and ``best`` in ``found``, which is sorted by pair."""
    links, number = links.cast(pa.large_binary()), wide(found.num_rows)
    ends = np.frombuffer(links.buffers()[1], dtype=np.int64)[links.offset:links.offset + len(links) + 1]
    place = np.frombuffer(links.buffers()[2] or b"", dtype=np.uint8)[ends[0]:ends[-1]].view(number)
    ends, out = (ends - ends[0]) // number.itemsize, []
    for x in (np.ones(found.num_rows, dtype=np.int64), *(found.column(c).cast(pa.int64()).to_numpy() for c in ("count", "best"))):
        run = np.concatenate([[0], np.cumsum(x[place])])
        out.append(pa.array(run[ends[1:]] - run[ends[:-1]]))
    return out


def align(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", file_a: str = MODEL_A, file_b: str = MODEL_B, with_groups: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per row of ``df``; with
    ``with_groups`` also the groups themselves as text (``a1,a2|b1;a3|b2,b3``).

    A encodes a blank and the text, B the text (it adds the blank itself). Null and empty texts, and those whose
    tokens don't spell blank and text, have no tokens: zeros and an empty string. ``n_best`` counts the
    links whose pair is the commonest one, ties included, of its B id in the table, ``count_sum`` adds up the counts of the
    links' pairs. Repeated rows, equal and null ids are texts of their own; an empty table gives no rows. Input columns
    other than the two named aren't read. A chunk holds about 1 MB of text, so a very common pair is one row per chunk."""
    table = written(aligned(df, id_col, text_col, file_a, file_b, with_groups).withColumn("chunk", F.monotonically_increasing_id()), "links", PER_TASK)
    each = table.select("chunk", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("chunk", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts = each.groupBy("pair").agg(F.sum("times").alias("count"))
    counts = written(counts.withColumn("b", F.shiftright("pair", 32)), "pairs")
    best = counts.groupBy("b").agg(F.max("count").alias("most"))
    counts = counts.join(best, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    # a task takes about PER_TASK chunks, of which Python and the buffers on the way there hold one at a time
    chunks = table.count()
    parts = max(1, -(-chunks // PER_TASK), min(chunks, df.sparkSession.sparkContext.defaultParallelism))
    found = each.join(counts, "pair").select(F.col("chunk").alias("of"), "pair", "count", "best").repartition(parts, "of")
    docs = table.select("chunk", "docs").repartition(parts, "chunk")
    schema = df.select(F.col(f"`{id_col}`")).schema
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string")
    schema = schema.add("groups", "string") if with_groups else schema

    def weigh(chunk: pa.Table, found: pa.Table) -> pa.Table:
        release()
        found, parts = found.sort_by("pair"), []
        for docs in chunk.column("docs").chunks:
            docs = docs.flatten()
            n, count, best = looked_up(docs.field(5), found)
            cols = [docs.field(0), docs.field(1), docs.field(2), n, n, best, count, docs.field(3)]
            parts.append(pa.RecordBatch.from_arrays([*cols, docs.field(4)] if with_groups else cols, schema.names))
        return pa.Table.from_batches(parts)

    return docs.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(weigh, schema)
