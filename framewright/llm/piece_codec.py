"""SentencePiece encoding and decoding by batched numpy Viterbi.

A text's words are de-duplicated per batch, and words of equal length advance together: for every
end position, the hashes of all substrings that end there probe the sorted keys of the piece table
at once, and the best predecessor of every word, a vectorised maximum, is stored as its backpointer.

For a unigram model the maximum is over sums of piece scores. For a merge (BPE) model the last piece
of every prefix is unique: it is the one candidate that, after the last piece of the prefix before
it, is what merging that pair of pieces' text gives. (No merge crosses a boundary of a longer text
that it doesn't cross in the two pieces beside it, as merges elsewhere don't change the order of those.)
So the maximum is over the same candidates, where all but valid successors score minus infinity, and the
pieces equal those of the sentencepiece library for this model.
"""

from __future__ import annotations

import heapq
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .textkit import mix64

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = 0x2581
_P = np.uint64(0x9E3779B97F4A7C15)
_UNK = -2


class Pieces:
    """The piece table of a model file: keys (sorted hashes), ids, scores, byte ids, kind."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        sp, proto = SentencePieceProcessor(model_file=model_file), pb.ModelProto()
        with open(model_file, "rb") as f:
            proto.ParseFromString(f.read())
        self.merging = proto.trainer_spec.model_type == 2
        rules = proto.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or proto.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models with the identity normaliser are supported")
        self.prefix = rules.add_dummy_prefix
        n = sp.vocab_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.score = np.array([sp.get_score(i) for i in range(n)])
        self.bytes = np.full(256, sp.unk_id(), dtype=np.int32)
        self.byte_of = np.full(n, -1, dtype=np.int16)
        for i in range(n):
            if sp.is_byte(i):
                b = int(self.text[i][1:-1], 16)
                self.bytes[b], self.byte_of[i] = i, b
        self.fallback = bool((self.byte_of >= 0).any())
        self.unk = sp.unk_id()
        self.plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        normal = [i for i in range(n) if self.plain[i]]
        self.longest = max(len(self.text[i]) for i in normal)
        hashes = np.array([self.hash_of(self.text[i]) for i in normal], dtype=np.uint64)
        by = np.argsort(hashes)
        self.keys, self.ids = hashes[by], np.array(normal, dtype=np.int32)[by]
        self.maybe = np.zeros(1 << 20, dtype=bool)  # low bits of the keys: spares most probes that would miss
        self.maybe[hashes & np.uint64(len(self.maybe) - 1)] = True
        self.bare_feed = not any("\n" in self.text[i] for i in normal)
        self.rank = {self.text[i]: self.score[i] for i in normal}
        # pairs of pieces looked at so far (sorted), and words encoded so far
        self.pairs, self.valid = np.array([np.iinfo(np.int64).max]), np.array([False])
        self.forget()
        # single bytes and blanks as they are decoded
        spelled = [bytes([self.byte_of[i]]) if self.byte_of[i] >= 0 else (self.text[i].replace("▁", " ") if self.plain[i] else " ⁇ " if i == self.unk else "").encode()
                   for i in range(n)]
        self.ends = np.concatenate([[0], np.cumsum([len(x) for x in spelled])])
        self.spelling = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        # words are cut before a blank, which no piece may hold after another character
        if any("▁" in t.lstrip("▁") for t in self.rank):
            raise ValueError("a piece holds a blank inside")

    @staticmethod
    def hash_of(text: str) -> np.uint64:
        h = np.zeros(1, dtype=np.uint64)
        for c in text:
            h = h * _P + np.uint64(ord(c) + 1)
        return mix64(h + np.uint64(len(text)))[0]

    def merged(self, text: str) -> list[str]:
        """Greedy merging as the model defines it: best score first, then leftmost."""
        part, nxt, prv = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap = []

        def offer(i):
            if i >= 0 and nxt[i] < len(part) and (whole := part[i] + part[nxt[i]]) in self.rank:
                heapq.heappush(heap, (-self.rank[whole], i, whole))
        for i in range(len(part)):
            offer(i)
        while heap:
            _, i, whole = heapq.heappop(heap)
            if not part[i] or nxt[i] >= len(part) or part[i] + part[nxt[i]] != whole:
                continue
            j = nxt[i]
            part[i], part[j], nxt[i] = whole, "", nxt[j]
            if nxt[i] < len(part):
                prv[nxt[i]] = i
            offer(prv[i])
            offer(i)
        return [p for p in part if p]

    def follows(self, last: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Whether merging keeps piece ``new`` apart after piece ``last`` (negative: none before it)."""
        key = (np.maximum(last, -1).astype(np.int64) + 1) << 32 | new.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        fresh = np.unique(key[self.pairs[at] != key])
        if len(fresh):
            good = []
            for k in fresh.tolist():
                head, piece = [self.text[(k >> 32) - 1]] if k >> 32 else [], self.text[k & 0xFFFFFFFF]
                good.append(self.merged("".join(head) + piece) == [*head, piece])
            into = np.searchsorted(self.pairs, fresh)
            self.pairs, self.valid = np.insert(self.pairs, into, fresh), np.insert(self.valid, into, good)
            at = np.searchsorted(self.pairs, key)
        return self.valid[at]

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece ids, pieces of each word) of words of equal length, given as code points (words x length); -2 for unknown characters."""
        n, size = codes.shape
        score = np.full((n, size + 1), -np.inf)
        last = np.full((n, size + 1), -1, dtype=np.int32)
        back = np.zeros((n, size + 1), dtype=np.int32)
        score[:, 0] = 0
        hashes = np.zeros((n, size), dtype=np.uint64)  # of the substring that starts at each place
        worst = self.score.min() - 10
        for end in range(1, size + 1):
            first = max(0, end - self.longest)
            hashes[:, first:end] = hashes[:, first:end] * _P + (codes[:, end - 1:end].astype(np.uint64) + np.uint64(1))
            span = np.arange(end - first, 0, -1).astype(np.uint64)
            key = mix64(hashes[:, first:end] + span)
            row, col = np.nonzero(self.maybe[key & np.uint64(len(self.maybe) - 1)])
            probe = key[row, col]
            at = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            hit = self.keys[at] == probe
            row, col, piece = row[hit], col[hit], self.ids[at[hit]]
            cand = np.full(key.shape, -1, dtype=np.int32)
            cand[row, col] = piece
            value = np.full(key.shape, -np.inf)
            if self.merging:
                good = self.follows(last[row, first + col], piece)
                value[row[good], col[good]] = 0.0
            else:
                value[row, col] = score[row, first + col] + self.score[piece]
            unknown = cand[:, -1] < 0  # a character that is no piece stands alone
            if self.merging:
                value[unknown] = -np.inf
                value[unknown, -1] = 0.0
            else:
                value[unknown, -1] = score[unknown, end - 1] + worst
            cand[unknown, -1] = _UNK
            best = value.argmax(axis=1)
            rows = np.arange(n)
            score[:, end], back[:, end], last[:, end] = value[rows, best], first + best, cand[rows, best]
        ends = np.zeros((n, size + 1), dtype=bool)  # where the pieces of the best path end
        place, todo = np.full(n, size), np.arange(n)
        while len(todo):
            ends[todo, place[todo]] = True
            place[todo] = back[todo, place[todo]]
            todo = todo[place[todo] > 0]
        return last[ends], ends.sum(axis=1)

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.starts, self.flat = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int32)

    def learn(self, words: list[str], cells: int = 1 << 16) -> None:
        """Encodes words not met so far; those of one length are a batch, cut to ``cells`` characters."""
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by.setdefault(len(w), []).append(i)
        order, ids, counts = [], [], []
        for size, members in by.items():
            step = max(1, cells // size)
            for a in range(0, len(members), step):
                some = members[a:a + step]
                codes = np.frombuffer("".join([words[i] for i in some]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(some), size)
                got, n = self.viterbi(codes)
                if _UNK in got:
                    parts = [self.spelled(p.tolist(), row) for p, row in zip(np.split(got, np.cumsum(n)[:-1]), codes, strict=True)]
                    got, n = np.concatenate(parts), np.array([len(p) for p in parts])
                order += some
                ids.append(got)
                counts.append(n)
        ids, counts, back = np.concatenate(ids), np.concatenate(counts), np.argsort(order)
        begin = np.cumsum(counts) - counts
        counts, begin = counts[back], begin[back]
        ends = np.cumsum(counts)
        self.flat = np.concatenate([self.flat, ids[np.arange(ends[-1]) + np.repeat(begin - (ends - counts), counts)]])
        self.starts = np.concatenate([self.starts, self.starts[-1] + ends])

    def spelled(self, ids: list[int], codes: np.ndarray) -> np.ndarray:
        """Unknown characters as byte pieces; one unknown id per run where the model has none."""
        out, at = [], 0
        for i in ids:
            if i == _UNK:
                if self.fallback:
                    out += self.bytes[list(chr(codes[at]).encode("utf-8", "replace"))].tolist()
                elif not (out and out[-1] == self.unk):
                    out.append(self.unk)
                at += 1
            else:
                out.append(i)
                at += len(self.text[i])
        return np.array(out, dtype=np.int32)

    def encode(self, texts: list[str | None], most: int = 250_000) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin). At most ``most`` words are remembered between calls."""
        if len(self.index) > most:
            self.forget()
        index, fresh, place, counts = self.index, [], [], []
        for t in texts:
            words = self.split(t) if t else ()
            for w in words:
                if (i := index.get(w)) is None:
                    i = index[w] = len(index)
                    fresh.append(w)
                place.append(i)
            counts.append(len(words))
        if fresh:
            self.learn(fresh)
        at = np.array(place, dtype=np.int64)
        sizes = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.starts[at] - ends[:-1], sizes)]
        return ids, ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]

    def split(self, text: str) -> list[str]:
        """Words that no piece spans: cut before runs of blanks and around line feeds that are no piece."""
        text = ("▁" if self.prefix else "") + text.replace(" ", "▁")
        if self.bare_feed:
            text = text.replace("\n", " \n ")
        if "▁▁" in text:
            return [w for part in text.split(" ") if part for w in _runs(part)]
        return [w for w in text.replace("▁", " ▁").split(" ") if w]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """Texts of ids. Blanks come back as spaces, the blank before the first word goes, bytes become characters."""
        sizes = self.ends[ids + 1] - self.ends[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = self.spelling[np.arange(ends[-1]) + np.repeat(self.ends[ids] - ends[:-1], sizes)].tobytes()
        cut = ends[starts]
        skip = 1 if self.prefix else 0
        return [str(data[a + skip * (data[a:a + 1] == b" "):b], "utf-8", "replace") for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def pieces_of(model_file: str) -> Pieces:
    """The worker process's table of a model, with what it has learned in earlier tasks."""
    held = sys.modules.setdefault("_held_pieces", types.ModuleType("_held_pieces")).__dict__
    if model_file not in held:
        held[model_file] = Pieces(model_file)
    return held[model_file]


def _runs(text: str) -> list[str]:
    """Words that each begin with a whole run of blanks."""
    out, start = [], 0
    for i in range(1, len(text)):
        if text[i] == "▁" and text[i - 1] != "▁":
            out.append(text[start:i])
            start = i
    return [*out, text[start:]]


def _chunks(column: pa.Array, size: int = 2 << 20):
    """Rows of a batch in runs of about ``size`` bytes."""
    start, held = 0, 0
    lengths = pa.compute.binary_length(column).fill_null(0).to_pylist()
    for i, n in enumerate(lengths):
        held += n
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def encode(df: DataFrame, text_col: str = "text", out: str = "ids", model_file: str = MODEL, check: str | None = None) -> DataFrame:
    """``df`` with ``out``: the piece ids of the whole text; and, if named, ``check``: whether decoding the ids gives the text back.

    A null text has null ids, an empty one none. The model file must be readable on the executors; it
    is a parameter and never copied. A task holds one run of texts (about 2 MB, or one longer text) at
    a time. Equal texts get equal ids. A column named ``out`` is replaced. An empty table gives no rows."""
    df = df.drop(out, *([check] if check else []))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType())), *([T.StructField(check, T.BooleanType())] if check else [])])

    def run(batches):
        pieces = pieces_of(model_file)
        for batch in batches:
            for a, b in _chunks(batch.column(text_col)):
                part = batch.slice(a, b - a)
                texts = part.column(text_col).to_pylist()
                ids, starts = pieces.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids), mask=part.column(text_col).is_null())
                same = [pa.array([t is None or t == back for t, back in zip(texts, pieces.decode(ids, starts), strict=True)], pa.bool_())] if check else []
                yield pa.RecordBatch.from_arrays([*part.columns, lists, *same], schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids_col: str = "ids", out: str = "text", model_file: str = MODEL) -> DataFrame:
    """``df`` with ``out``: the text of the piece ids; null for null ids. A column named ``out`` is replaced."""
    df = df.drop(out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        pieces = pieces_of(model_file)
        for batch in batches:
            ids = batch.column(ids_col)
            sizes = np.asarray(ids.value_lengths().fill_null(0))
            texts = pieces.decode(np.asarray(ids.flatten(), dtype=np.int64), np.concatenate([[0], np.cumsum(sizes)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string(), mask=np.asarray(ids.is_null()))], [*batch.schema.names, out])

    return df.mapInArrow(run, schema)
