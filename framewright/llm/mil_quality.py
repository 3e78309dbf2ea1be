"""Quality classifier: gated-attention multiple-instance learning over passages.

A document is a bag of passages of 64 words. Every passage is encoded: byte-class shares, word
statistics and hashed letter pairs, then a learned tanh layer. Gated attention weights (tanh times
sigmoid, softmax over the bag) are learned from document labels alone, and the weighted passage
representation is scored by a logistic output (Ilse, Tomczak and Welling, 2018).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import LOWER, slices, span_hashes, spans

PASSAGE = 64  # words
PAIRS = 64  # buckets of letter pairs
#: Byte classes counted in every passage; bytes of no class are the last.
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!", "?", "#", "%", "$", "&", "*", "|",
           ":;", "'\"", "()[]{}<>", "@", "/\\", "_-~=+^`")
WORDS = 6
WIDTH = len(CLASSES) + 2 + WORDS + PAIRS


def _class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES) + 1, dtype=np.uint8)
    table[128:] = len(CLASSES)
    for i, chars in enumerate(CLASSES):
        table[[ord(c) for c in chars]] = i
    return table


CLASS = _class_table()


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, passages before each row). A row without words is one passage of zeros."""
    starts, ends, first = spans(data, offsets)
    counts = np.diff(first)
    bags = np.maximum(-(-counts // PASSAGE), 1)
    before = np.concatenate([[0], np.cumsum(bags)])
    n = int(before[-1])
    row = np.repeat(np.arange(len(counts)), counts)
    place = before[row] + (np.arange(len(starts)) - first[row]) // PASSAGE  # the passage of each word
    out = np.zeros((n, WIDTH), dtype=np.float32)
    if not len(starts):
        return out, before
    words = np.bincount(place, minlength=n)
    have = np.maximum(words, 1)
    sizes = ends - starts
    inside = np.repeat(place, sizes)  # the passage of each word byte
    at = np.arange(int(sizes.sum())) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    body = data[at]
    chars = np.maximum(np.bincount(inside, minlength=n), 1)
    kinds = len(CLASSES) + 2
    out[:, :kinds] = np.bincount(inside * kinds + CLASS[body], minlength=n * kinds).reshape(n, kinds) / chars[:, None]
    low = LOWER[data]
    hashes = span_hashes(low, starts, ends)
    pair = np.lexsort((hashes, place))
    fresh = np.ones(len(pair), dtype=bool)
    fresh[1:] = (hashes[pair][1:] != hashes[pair][:-1]) | (place[pair][1:] != place[pair][:-1])
    same = np.zeros(len(starts), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (place[1:] == place[:-1])
    mean = np.bincount(place, sizes, minlength=n) / have
    marked = CLASS[data[ends - 1]] > 2
    stats = (np.bincount(place[pair][fresh], minlength=n) / have, np.bincount(place, same, minlength=n) / have, mean / 10,
             np.sqrt(np.maximum(np.bincount(place, sizes.astype(float) ** 2, minlength=n) / have - mean**2, 0)) / 10,
             np.bincount(place, marked, minlength=n) / have, words / PASSAGE)
    out[:, kinds:kinds + WORDS] = np.stack(stats, axis=1)
    two = at[:-1][(at[1:] == at[:-1] + 1)]
    bucket = (low[two].astype(np.int64) * 31 + low[two + 1]) * 40503 % 65521 % PAIRS
    out[:, kinds + WORDS:] = np.bincount(inside[:-1][at[1:] == at[:-1] + 1] * PAIRS + bucket, minlength=n * PAIRS).reshape(n, PAIRS) / chars[:, None] * 4
    return out, before


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """The network: encoder (w, b), gates (v, u), attention (a), output (c, d)."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, hidden: int, gates: int, seed: int):
        r = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.p = {"w": r.normal(0, WIDTH**-0.5, (WIDTH, hidden)), "b": np.zeros(hidden), "v": r.normal(0, hidden**-0.5, (hidden, gates)),
                  "u": r.normal(0, hidden**-0.5, (hidden, gates)), "a": r.normal(0, 0.1, gates), "c": np.zeros(hidden), "d": np.zeros(1)}

    def forward(self, x: np.ndarray, before: np.ndarray) -> dict:
        p, first, bag = self.p, before[:-1], np.repeat(np.arange(len(before) - 1), np.diff(before))
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        e = (t * s) @ p["a"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        weight = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(h * weight[:, None], first, axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "weight": weight, "z": z, "bag": bag, "first": first, "score": sigmoid(z @ p["c"] + p["d"])}

    def gradients(self, f: dict, y: np.ndarray) -> dict:
        p, bag = self.p, f["bag"]
        miss = (f["score"] - y) / len(y)
        dz = miss[:, None] * p["c"]
        dweight = (f["h"] * dz[bag]).sum(axis=1)
        de = f["weight"] * (dweight - np.add.reduceat(f["weight"] * dweight, f["first"])[bag])
        gate = de[:, None] * p["a"]
        dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
        dh = f["weight"][:, None] * dz[bag] + dt @ p["v"].T + ds @ p["u"].T
        dx = dh * (1 - f["h"] ** 2)
        return {"w": f["x"].T @ dx, "b": dx.sum(axis=0), "v": f["h"].T @ dt, "u": f["h"].T @ ds, "a": de @ (f["t"] * f["s"]),
                "c": f["z"].T @ miss, "d": np.array([miss.sum()])}


def train(x: np.ndarray, before: np.ndarray, y: np.ndarray, hidden: int = 24, gates: int = 12, steps: int = 160, rate: float = 0.02,
          decay: float = 1e-4, seed: int = 3) -> Model:
    """Full-batch Adam on the cross-entropy of the document labels."""
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-3, hidden, gates, seed)
    m, v = ({k: np.zeros_like(q) for k, q in model.p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        for k, g in model.gradients(model.forward(x, before), y).items():
            g = g + decay * model.p[k]
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            model.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 3000,
          longest: int = 1 << 17, threshold: float = 0.3) -> DataFrame:
    """``df`` with held_out, score and predicted; every whole text is scored.

    The model learns from at most ``sample`` documents of at most ``longest`` bytes each: those
    labelled 0 or 1 whose crc32(id as text) mod 5 is not 0, of the smallest id hash. The sample's
    features reach the driver, nothing else does. Only the text is an input of a score. Null and
    empty texts are one passage of zeros, so they get one score like any other; a null id is never
    held out. Without usable labels every score is 0.5; if all labels agree they are learned as they
    are. Rows of equal texts get equal scores; repeated labels of a document count repeatedly.
    Existing columns held_out, score and predicted are replaced. An empty table gives no rows."""
    fold = F.crc32(F.col(id_col).cast("string")) % 5
    chosen = (labels.select(id_col, F.col(label_col).cast("double").alias("__y")).where(F.col("__y").isin(0.0, 1.0) & (fold != 0))
              .orderBy(F.xxhash64(id_col), id_col, "__y").limit(sample))

    def encode(batches):
        for batch in batches:
            text, y = batch.column(0), batch.column(1)
            for lo, data, offsets in slices(text):
                x, before = passages(data, offsets)
                rows = [x[a:b].tobytes() for a, b in zip(before[:-1], before[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), y.slice(lo, len(rows))], ["x", "y"])

    bounded = F.coalesce(F.octet_length(text_col), F.lit(0)) <= longest
    known = df.where(bounded & (fold != 0)).select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(chosen.toDF("i", "y")), "i")
    # an id may repeat in either table, so the bound holds for what is joined
    train_rows = known.orderBy(F.xxhash64("i"), "i", F.xxhash64("t"), "y").limit(sample).select("t", "y").mapInArrow(encode, "x binary, y double")
    got = sorted((r.y, bytes(r.x)) for r in train_rows.collect())  # sorted: the same sums in any order of arrival
    model = None
    if got:
        bags = [np.frombuffer(x, dtype=np.float32).reshape(-1, WIDTH) for _, x in got]
        before = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
        model = train(np.concatenate(bags).astype(np.float64), before, np.array([y for y, _ in got]))
    drop = [c for c in ("held_out", "score", "predicted") if c in df.columns]
    base = df.drop(*drop)
    at = base.columns.index(text_col)
    schema = base.limit(0).withColumn("score", F.lit(0.0)).schema

    def scored(batches):
        for batch in batches:
            parts = [np.zeros(0)]
            for _, data, offsets in slices(batch.column(at)):
                if model is None:
                    parts.append(np.full(len(offsets) - 1, 0.5))
                else:
                    x, before = passages(data, offsets)
                    parts.append(model.forward(x.astype(np.float64), before)["score"])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts))], [*batch.schema.names, "score"])

    return base.mapInArrow(scored, schema).withColumns({"held_out": fold == 0, "predicted": (F.col("score") >= threshold).cast("int")})
