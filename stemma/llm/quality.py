"""Quality classifier: gated attention over passages, learned from labels of whole documents.

A text is cut into passages of ``PASSAGE`` words, and every passage is encoded: shares of character classes and of
pairs of classes, repeated words, word lengths, through one learned layer. A gated attention weighs the passages, and the
weighted mean of their codes gives the score of the document. Only the text is read, never language, source or id.

Training takes at most ``TRAIN_DOCS`` labelled documents, chosen by a hash of their id among those whose crc32 of the id
modulo 5 is not 0, one row for each id, and at most ``TRAIN_PASSAGES`` evenly spaced passages of each: 72 MB on the driver,
however long the texts are. The model is some ten thousand numbers. Scoring is one pass over all rows and whole texts,
without a shuffle.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words in a passage.
PASSAGE = 64
#: Most labelled documents that the model is fitted on.
TRAIN_DOCS = 3000
#: Most passages of a document that the model is fitted on.
TRAIN_PASSAGES = 32
#: A document is predicted good from this score.
THRESHOLD = 0.3
CODE, GATE, EPOCHS, BATCH, RATE, DECAY, SEED = 24, 12, 40, 64, 0.01, 1e-4, 7

#: Character classes of bytes: space, lower, upper, digit, sentence ends, commas, quotes and brackets, dashes, bars,
#: signs that prose rarely has, control, and bytes of characters beyond ASCII.
_CLASSES = [b" ", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".?", b",;:", b"'\"()[]", b"-_/", b"|", b"!", b"#$%&*+<=>@\\^`{}~", bytes(range(32)) + b"\x7f", bytes(range(128, 256))]
_TABLE = np.zeros(256, np.int64)
for _i, _members in enumerate(_CLASSES):
    _TABLE[list(_members)] = _i
_C = len(_CLASSES)
WIDTH = _C + _C * _C + 5


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def encode(text: bytes | None) -> np.ndarray:
    """One row of features for each passage; a text without words is one passage of zeros."""
    words = (text or b"").split()
    if not words:
        return np.zeros((1, WIDTH), np.float32)
    starts = np.arange(0, len(words), PASSAGE)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    buf = b" ".join(words)
    sizes = np.add.reduceat(lengths + 1, starts)
    sizes[-1] -= 1
    cls = _TABLE[np.frombuffer(buf, np.uint8)]
    of = np.repeat(np.arange(len(starts)), sizes)
    one = np.bincount(of * _C + cls, minlength=len(starts) * _C).reshape(-1, _C)
    two = np.bincount((of[1:] * _C + cls[:-1]) * _C + cls[1:], minlength=len(starts) * _C * _C).reshape(-1, _C * _C)
    rest = []
    for at in starts.tolist():
        own = words[at : at + PASSAGE]
        n, kinds = len(own), len(set(own))
        again = sum(map(operator.eq, own, own[1:]))
        capital = sum(map(bytes.istitle, own))
        rest.append((kinds / n, again / n, capital / n, sum(map(len, own)) / n / 10, n / PASSAGE))
    return np.concatenate([one / sizes[:, None], two / sizes[:, None], np.array(rest)], axis=1).astype(np.float32)


def spaced(passages: np.ndarray, most: int = TRAIN_PASSAGES) -> np.ndarray:
    """At most ``most`` of the passages, evenly spaced from the first to the last."""
    if len(passages) <= most:
        return passages
    return passages[np.linspace(0, len(passages) - 1, most).round().astype(int)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Attention:
    """Encoder (w, b), gate (v, u, g), head (c, d), and the scaling of the features."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    g: np.ndarray
    c: np.ndarray
    d: np.ndarray

    @classmethod
    def new(cls, x: np.ndarray, prior: float) -> Attention:
        rng = np.random.default_rng(SEED)
        draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        spread = x.std(axis=0, dtype=np.float64)
        bias = np.array([np.log(prior / (1 - prior))])
        return cls(x.mean(axis=0, dtype=np.float64), np.where(spread > 1e-4, spread, 1), draw(x.shape[1], CODE), np.zeros(CODE), draw(CODE, GATE), draw(CODE, GATE), draw(GATE), np.zeros(CODE), bias)

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        """Scores of bags whose passages are consecutive rows of ``x``, from ``starts`` on; and what backward needs."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(z @ self.w + self.b)
        t, s = np.tanh(h @ self.v), _sigmoid(h @ self.u)
        level = (t * s) @ self.g
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        e = np.exp(level - np.maximum.reduceat(level, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        pooled = np.add.reduceat(a[:, None] * h, starts)
        return _sigmoid(pooled @ self.c + self.d), {"z": z, "h": h, "t": t, "s": s, "a": a, "bag": bag, "pooled": pooled}

    def gradients(self, k: dict, starts: np.ndarray, out: np.ndarray) -> dict[str, np.ndarray]:
        """``out``: the loss by the logit of each bag."""
        up = np.outer(out, self.c)[k["bag"]]
        by_a = (k["h"] * up).sum(axis=1)
        by_level = k["a"] * (by_a - np.add.reduceat(k["a"] * by_a, starts)[k["bag"]])
        gated = np.outer(by_level, self.g)
        by_t, by_s = gated * k["s"] * (1 - k["t"] ** 2), gated * k["t"] * k["s"] * (1 - k["s"])
        by_h = (k["a"][:, None] * up + by_t @ self.v.T + by_s @ self.u.T) * (1 - k["h"] ** 2)
        return {"w": k["z"].T @ by_h, "b": by_h.sum(axis=0), "v": k["h"].T @ by_t, "u": k["h"].T @ by_s, "g": (k["t"] * k["s"]).T @ by_level, "c": k["pooled"].T @ out, "d": np.array([out.sum()])}

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        starts = np.cumsum([0, *map(len, bags[:-1])])
        return self.forward(np.concatenate(bags), starts)[0]


def fit(bags: list[np.ndarray], labels: np.ndarray) -> Attention:
    """Adam over batches of whole documents; both classes weigh alike in the loss."""
    prior = float(np.clip(labels.mean(), 0.05, 0.95))
    model = Attention.new(np.concatenate(bags), prior)
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3)) if 0 < share < 1 else np.ones(len(labels))
    rng, step = np.random.default_rng(SEED), 0
    first = {n: np.zeros_like(getattr(model, n)) for n in "wbvugcd"}
    second = {n: np.zeros_like(getattr(model, n)) for n in "wbvugcd"}
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            x, starts = np.concatenate([bags[i] for i in own]), np.cumsum([0, *(len(bags[i]) for i in own[:-1])])
            p, kept = model.forward(x, starts)
            step += 1
            for n, grad in model.gradients(kept, starts, (p - labels[own]) * weight[own] / len(own)).items():
                value = getattr(model, n)
                full = grad + DECAY * value
                first[n] = 0.9 * first[n] + 0.1 * full
                second[n] = 0.999 * second[n] + 0.001 * full**2
                setattr(model, n, value - RATE * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8))
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS) -> Attention | None:
    """The model, or None if no labelled document may be learned from.

    Labels without document, without id or without value don't count; several of one id count as their majority. Of rows that
    repeat an id one counts, the least by its passages.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    chosen = known.groupBy(F.col(id_col).alias("_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("_label"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(most)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), "_id")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [spaced(encode(t)).tobytes() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), pa.array(made, pa.binary()), b.column(2)], ["_id", "passages", "_label"])

    made = rows.select("_id", "_text", "_label").mapInArrow(of, "_id string, passages binary, _label int")
    seen = sorted(made.groupBy("_id", "_label").agg(F.min("passages").alias("passages")).collect(), key=lambda r: r["_id"])
    if not seen:
        return None
    bags = [np.frombuffer(r["passages"], np.float32).reshape(-1, WIDTH) for r in seen]
    return fit(bags, np.array([r["_label"] for r in seen], float))


def score(docs: DataFrame, model: Attention | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row. Null and empty texts are scored as a passage without words; without a model all get 1."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [1.0 if model is None else float(model.score([encode(t)])[0]) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], ["_id", "score"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(of, f"_id {rows.schema['_id'].dataType.simpleString()}, score double").withColumnRenamed("_id", id_col)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score, predicted. A null id is held out of nothing (false)."""
    scored = score(docs, train(docs, labels, id_col, text_col), id_col, text_col)
    return scored.select(id_col, F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that the classifier accepts, with all their columns.

    Null and empty texts are scored as a passage without words, and stay or go by that. Rows without identifier are judged
    like others, rows that repeat one each by its own text. Without a model (no labels) all rows stay.
    """
    model = train(docs, labels, id_col, text_col)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
            yield b.filter(pa.array([model is None or float(model.score([encode(t)])[0]) >= THRESHOLD for t in texts], pa.bool_()))

    return docs.mapInArrow(of, docs.schema)
