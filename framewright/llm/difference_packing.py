"""Packing tokenised documents into sequences by Karmarkar-Karp multiway differencing.

A document's ids fill whole sequences first; what is left (less than a sequence) is an item. Items are dealt
into lanes of bounded size. In a lane, every item starts as a partial partition of its own, and the two
partial partitions with the largest spread are merged with opposing imbalances, the largest window of one onto
the smallest of the other, until one partition is left: windows of nearly equal sizes. As documents may be
cut, the few ids by which a window exceeds a sequence move to windows with room; while all the room is less than what
is over, the window count rises. A lane's ids beyond whole sequences become short sequences at powers of two.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import chunks_of, written
from .textkit import LOWER, byte_alphabet, slices, span_hashes, spans

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
END = 2
CAPACITY = 4096
#: Words of ASCII and Latin-1 lower-case letters alone, which no normaliser changes, and their pieces by the
#: tokenizer's published pattern.
SIMPLE = re.compile("[!-~ß-öø-ÿ]{1,64}")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class Merges:
    """The merges of a byte-level BPE file with a word-end suffix, applied to many pieces at once."""

    NONE = np.int64(1 << 40)

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        alphabet = {b: c for c, b in byte_alphabet().items()}
        self.byte, self.last = (np.array([vocab[alphabet[b] + x] for b in range(256)], dtype=np.int64) for x in ("", end))
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        code = np.array([vocab[x] << 32 | vocab[y] for x, y in pairs], dtype=np.int64)
        order = np.argsort(code)
        self.code, self.rank, self.made = code[order], order, np.array([vocab[x + y] for x, y in pairs], dtype=np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left << 32 | right
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where((self.code[at] == code) & (right >= 0), self.rank[at], self.NONE)

    def apply(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size): every piece's ids. In a round, every piece that can still be merged does its first merge of lowest rank."""
        flat_ids, done, start, many = [], 0, np.zeros(len(pieces), dtype=np.int64), np.zeros(len(pieces), dtype=np.int64)
        size = np.array(list(map(len, pieces)), dtype=np.int64)
        order, lo = np.argsort(size, kind="stable"), 0
        while lo < len(order):
            hi = min(int(np.searchsorted(size[order], max(8, 2 * size[order[lo]]), side="right")), lo + 16384)
            row, width = order[lo:hi], int(size[order[hi - 1]])
            flat = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in row), dtype=np.uint8).reshape(len(row), width)
            col, last = np.arange(width), (size[row] - 1)[:, None]
            ids = np.where(col < last, self.byte[flat], np.where(col == last, self.last[flat], -1))
            rank = np.concatenate([self.ranks(ids[:, :-1], ids[:, 1:]), np.full((len(row), 1), self.NONE)], axis=1)
            while len(row):
                at = rank.argmin(axis=1)
                best = rank[np.arange(len(row)), at]
                on = best < self.NONE
                if not on.all():
                    full = ids[~on] >= 0
                    n = full.sum(axis=1)
                    flat_ids.append(ids[~on][full].astype("<u4"))
                    many[row[~on]], start[row[~on]], done = n, done + np.cumsum(n) - n, done + int(n.sum())
                row, ids, rank, at, best = row[on], ids[on], rank[on], at[on], best[on]
                here, shift = np.arange(len(row)), np.minimum(col + (col > at[:, None]), width - 1)
                ids, rank = np.take_along_axis(ids, shift, 1), np.take_along_axis(rank, shift, 1)
                ids[:, -1], rank[:, -1] = np.where(at == width - 1, ids[:, -1], -1), self.NONE
                ids[here, at] = self.made[best]
                after = np.where(at + 1 < width, ids[here, np.minimum(at + 1, width - 1)], -1)
                rank[here, at] = self.ranks(ids[here, at], after)
                some = here[at > 0]
                rank[some, at[some] - 1] = self.ranks(ids[some, at[some] - 1], ids[some, at[some]])
            lo = hi
        return np.concatenate(flat_ids) if flat_ids else np.zeros(0, "<u4"), start, many


def ragged(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the stretches of ``flat`` one after the other, where each of them begins, with the end)."""
    before = np.concatenate([[0], np.cumsum(size)])
    return flat[np.repeat(start - before[:-1], size) + np.arange(before[-1])], before


class Words:
    """Ids of words as unsigned 32-bit numbers, learned once per worker and found again by the words' 64-bit hashes.

    The tokenizer drops white space and lowers letters, so the ids of a text are those of its lower-case words
    (A-Z alone are lowered here). Words of simple letters are merged together in numpy, others go to the tokenizers
    library. A text that could hold a special token goes there by its words as they are. When more than ``most``
    words are known, those of the current texts stay."""

    def __init__(self, file: str, most: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(file), most
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merges = Merges(file) if self.fits(file) else None
        self.keys, self.start, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    @staticmethod
    def fits(file: str) -> bool:
        """Whether the file splits and normalises as ``PIECES`` and ``SIMPLE`` take for granted."""
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        steps, split, model = (spec["normalizer"] or {}).get("normalizers", []), (spec["pre_tokenizer"] or {}).get("pretokenizers", []), spec["model"]
        return ([x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in split] == ["Split", "ByteLevel"]
                and split[0]["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"} and not split[1]["add_prefix_space"]
                and model["type"] == "BPE" and bool(model["end_of_word_suffix"]) and not model["dropout"] and not model["continuing_subword_prefix"])

    def library(self, words: list[str]) -> list[np.ndarray]:
        out = []
        for lo in range(0, len(words), 4096):
            out += [np.array(x.ids, dtype="<u4") for x in self.tokenizer.encode_batch(words[lo:lo + 4096], add_special_tokens=False)]
        return out

    def learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each word's begin, with the end)."""
        cut = [PIECES.findall(w) if self.merges is not None and SIMPLE.fullmatch(w) else None for w in words]
        simple = list(dict.fromkeys(itertools.chain.from_iterable(c for c in cut if c)))
        rest = [w for w, c in zip(words, cut, strict=True) if c is None]
        number = {p: i for i, p in enumerate(itertools.chain(simple, rest))}
        flat, start, size = self.merges.apply([p.encode() for p in simple]) if simple else (np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64))
        other = self.library(rest)
        more = np.array(list(map(len, other)), dtype=np.int64)
        flat, start, size = np.concatenate([flat, *other]).astype("<u4"), np.concatenate([start, len(flat) + np.cumsum(more) - more]), np.concatenate([size, more])
        pieces = np.array([number[p] for w, c in zip(words, cut, strict=True) for p in c or (w,)], dtype=np.int64)
        ids, before = ragged(flat, start[pieces], size[pieces])
        return ids, before[np.concatenate([[0], np.cumsum([len(c) if c else 1 for c in cut])])]

    def encode(self, column: pa.Array) -> list[bytes]:
        """Ids of every text as little-endian bytes. Nulls count as empty."""
        out = []
        for lo, data, offsets in slices(column):
            data = LOWER[data]
            starts, ends, first = spans(data, offsets)
            keys, at, of = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
            place = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
            new = np.flatnonzero(self.keys[place] != keys) if len(self.keys) else np.arange(len(keys))
            whole = data.tobytes()
            if len(new):
                got, before = self.learn([whole[i:j].decode() for i, j in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)])
                size = np.diff(before)
                every = np.concatenate([self.keys, keys[new]])
                order = np.argsort(every, kind="stable")  # mostly sorted already
                self.start = np.concatenate([self.start, len(self.flat) + before[:-1]])[order]
                self.size, self.flat, self.keys = np.concatenate([self.size, size])[order], np.concatenate([self.flat, got]).astype("<u4"), every[order]
                place = np.searchsorted(self.keys, keys)
            ids, before = ragged(self.flat, self.start[place][of], self.size[place][of])
            ids = ids.tobytes()
            cut = (4 * before[first]).tolist()
            out += [ids[i:j] for i, j in itertools.pairwise(cut)]
            if any(s in whole for s in self.special):
                for i in range(len(offsets) - 1):
                    if any(s in whole[offsets[i]:offsets[i + 1]] for s in self.special):
                        out[lo + i] = b"".join(x.tobytes() for x in self.library([w.decode() for w in column[lo + i].as_py().encode().split()]))
            if len(self.keys) > self.most:
                self.flat, before = ragged(self.flat, self.start[place], self.size[place])
                self.keys, self.start, self.size = keys, before[:-1], np.diff(before)
        return out


@functools.lru_cache(maxsize=2)
def words_of(file: str) -> Words:
    return Words(file)


def tokenised(df: DataFrame, id_col: str, text_col: str, file: str, capacity: int, with_ids: bool) -> DataFrame:
    """(row, id, tokens, crcs, full, tail): checksums (and ids, if asked for) of a document's whole sequences, and the ids left."""
    some = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = some.drop("text").schema.add("tokens", "long").add("crcs", T.ArrayType(T.LongType())).add("full", T.ArrayType(T.BinaryType())).add("tail", "binary")
    width, end = 4 * capacity, np.array([END], dtype="<u4").tobytes()

    def run(batches):
        words = words_of(file)
        for batch in batches:
            for part in chunks_of(batch, 2, 2 << 20):
                tokens, crcs, full, tail = [], [], [], []
                for ids in words.encode(part.column(2)):
                    ids += end
                    whole = len(ids) - len(ids) % width
                    pieces = [ids[i:i + width] for i in range(0, whole, width)]
                    tokens.append(len(ids) // 4)
                    crcs.append([zlib.crc32(x) for x in pieces])
                    full.append(pieces if with_ids else None)
                    tail.append(ids[whole:])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(tokens, pa.int64()), pa.array(crcs, pa.list_(pa.int64())),
                                                  pa.array(full, pa.list_(pa.binary())), pa.array(tail, pa.binary())], ["row", "id", "tokens", "crcs", "full", "tail"])

    return some.mapInArrow(run, schema)


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0 to k - 1) of every item, by multiway differencing.

    A partial partition is its windows' sums, largest first, and their nodes; windows not listed are empty. A
    node is an item, or two nodes that came into one window."""
    n = len(sizes)
    heap = [(-int(s), i, np.array([s], dtype=np.int64), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    made, joined = n, []
    while len(heap) > 1:
        (_, i, sums, nodes), (_, _, more, others) = heapq.heappop(heap), heapq.heappop(heap)
        meet = len(sums) + len(more) - k
        if meet <= 0:
            sums, nodes = np.concatenate([sums, more]), np.concatenate([nodes, others])
        else:
            # the smallest windows of one, emptiest last, meet the largest of the other; the rest stand alone
            at = slice(len(sums) - meet, len(sums))
            new = np.arange(made, made + meet)
            joined.append((new, nodes[at], others[::-1][:meet]))
            made += meet
            sums = np.concatenate([sums[:at.start], sums[at] + more[::-1][:meet], more[::-1][meet:]])
            nodes = np.concatenate([nodes[:at.start], new, others[::-1][meet:]])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        heapq.heappush(heap, (-int(sums[0] - (sums[-1] if len(sums) == k else 0)), i, sums, nodes))
    window = np.zeros(made, dtype=np.int64)
    window[heap[0][3]] = np.arange(len(heap[0][3]))
    for new, left, right in reversed(joined):
        window[left] = window[right] = window[new]
    return window[:n]


def windows(sizes: np.ndarray, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of at most ``capacity``, as lists of (item, start, length)."""
    if not len(sizes):
        return []
    k = max(1, int(sizes.sum()) // capacity)
    while True:
        window = differencing(sizes, k)
        sums = np.bincount(window, weights=sizes, minlength=k).astype(np.int64)
        if np.maximum(sums - capacity, 0).sum() <= np.maximum(capacity - sums, 0).sum():
            break
        k += 1
    out, over = [[] for _ in range(k)], []
    for i in np.argsort(window, kind="stable").tolist():
        mine, size = out[window[i]], int(sizes[i])
        room = capacity - sum(x[2] for x in mine)
        if room > 0:
            mine.append((i, 0, min(size, room)))
        if size > room:
            over.append((i, max(room, 0), size - max(room, 0)))
    for mine in out:
        room = capacity - sum(x[2] for x in mine)
        while over and room > 0:
            i, start, size = over.pop()
            mine.append((i, start, min(size, room)))
            if size > room:
                over.append((i, start + room, size - room))
            room -= min(size, room)
    return [x for x in out if x]


def lane_windows(sizes: np.ndarray, capacity: int) -> list[list[tuple[int, int, int]]]:
    """``windows`` of whole sequences, and the ids beyond them (of the smallest items) at powers of two."""
    rest = int(sizes.sum()) % capacity
    short, left, start = [], sizes.copy(), np.zeros(len(sizes), dtype=np.int64)
    order = iter(np.argsort(sizes, kind="stable").tolist())
    i = next(order, None)
    for size in (1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1):
        mine, room = [], size
        while room:
            n = min(room, int(left[i]))
            if n:
                mine.append((i, int(start[i]), n))
                left[i], start[i], room = left[i] - n, start[i] + n, room - n
            if not left[i]:
                i = next(order, None)
        short.append(mine)
    items = np.flatnonzero(left)
    return [[(int(items[j]), int(start[items[j]]) + at, n) for j, at, n in x] for x in windows(left[items], capacity)] + short


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", file: str = TOKENIZER, capacity: int = CAPACITY,
         lane_windows_most: int = 512, lane_items: int = 8192, with_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset), a row per piece; with ``with_ids`` also the ids.

    A null or empty text is the one id ``END``. Every id lies in one piece; pieces fill sequences of ``capacity`` ids
    (a power of two) without gaps, and a lane's last sequences are powers of two long, so nothing is padded. The
    number of lanes follows from counts of the whole table, so a lane holds about ``lane_windows_most`` windows and ``lane_items``
    items however large the table is, and rows go to lanes by the hash of their own number: repeated rows, equal or null ids are
    documents of their own. An empty table gives no rows. Input columns other than the two named aren't read."""
    docs = written(tokenised(df, id_col, text_col, file, capacity, with_ids), "tokens")
    left = F.octet_length("tail") / 4
    ids, items = docs.agg(F.coalesce(F.sum(left), F.lit(0)), F.count("*")).first()
    lanes = max(1, int(-(-ids // (capacity * lane_windows_most))), -(-items // lane_items))
    schema = docs.select("id").schema.add("start", "long").add("length", "long").add("ids_crc32", "long").add("doc_tokens", "long").add("sequence_id", "long").add("offset", "long")
    schema = schema.add("ids", T.ArrayType(T.IntegerType())) if with_ids else schema

    def pieces(group: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        tail, tokens, crcs, full = (group[c].to_pylist() for c in ("tail", "tokens", "crcs", "full"))
        sizes = np.array([len(x) // 4 for x in tail], dtype=np.int64)
        number, out = group["lane"][0].as_py() << 32, []
        for i, whole in enumerate(crcs):
            for j, crc in enumerate(whole):
                out.append((i, j * capacity, capacity, crc, number, 0, full[i][j] if with_ids else b""))
                number += 1
        for window in lane_windows(sizes, capacity):
            offset = 0
            for i, start, n in window:
                data = tail[i][4 * start:4 * (start + n)]
                out.append((i, tokens[i] - int(sizes[i]) + start, n, zlib.crc32(data), number, offset, data))
                offset += n
            number += 1
        i, start, length, crc, number, offset, data = zip(*out, strict=True)
        cols = [group["id"].take(pa.array(i)), start, length, crc, [tokens[x] for x in i], number, offset]
        if with_ids:
            cols.append(pa.array([np.frombuffer(x, dtype="<u4").astype(np.int32) for x in data], pa.list_(pa.int32())))
        return pa.table([c if isinstance(c, pa.Array | pa.ChunkedArray) else pa.array(c, pa.int64()) for c in cols], names=schema.names)

    lane = F.pmod(F.xxhash64("row"), F.lit(lanes)).alias("lane")
    return docs.select("*", lane).groupBy("lane").applyInArrow(pieces, schema).withColumnRenamed("id", id_col)
