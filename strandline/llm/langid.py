"""Language identification by a byte convolutional network, in numpy.

Bytes are embedded, filters of widths two, three and four run over each fixed-length window, the largest response
of each filter in the window goes through a softmax layer. A text's windows are scored in batches and averaged by
their length, so whole texts count. For prediction, embedding and filters are folded into two tables of byte
pairs, which is the same sum in another order.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices, table
from strandline.llm.nets import Adam, bounded, remainder

WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4), (8, 12, 12), 8
REACH = max(WIDTHS)
UNKNOWN = "und"


class Network:
    """params: e (256 x EMBEDDING, byte 0 pads and is zero), w (REACH x EMBEDDING x filters), b, d (filters x classes), c."""

    def __init__(self, classes: list[str], params: dict[str, np.ndarray]):
        self.classes, self.params = classes, params

    @classmethod
    def new(cls, classes: list[str], seed: int = 7) -> Network:
        rng, k = np.random.default_rng(seed), sum(FILTERS)
        e = rng.normal(0, 0.5, (256, EMBEDDING))
        e[0] = 0
        w = rng.normal(0, 0.3, (REACH, EMBEDDING, k)) * cls.shape()
        return cls(classes, {n: x.astype(np.float32) for n, x in {"e": e, "w": w, "b": np.zeros(k), "d": rng.normal(0, 0.2, (k, len(classes))), "c": np.zeros(len(classes))}.items()})

    @staticmethod
    def shape() -> np.ndarray:
        """1 where a filter of its width has a weight."""
        at = np.repeat(WIDTHS, FILTERS)
        return (np.arange(REACH)[:, None, None] < at[None, None, :]).astype(np.float32)

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients over windows x (n x WINDOW bytes) of classes y."""
        p, n = self.params, len(x)
        spans = np.lib.stride_tricks.sliding_window_view(x, REACH, axis=1)  # n x positions x REACH
        full = p["e"][spans].reshape(n, spans.shape[1], -1)
        flat = p["w"].reshape(REACH * EMBEDDING, -1)
        pre = full @ flat
        best = pre.argmax(1)  # n x filters
        top = np.take_along_axis(pre, best[:, None], 1)[:, 0] + p["b"]
        h = np.maximum(top, 0)
        z = h @ p["d"] + p["c"]
        q = np.exp(z - z.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        loss = -float(np.log(q[np.arange(n), y] + 1e-9).mean())
        q[np.arange(n), y] -= 1
        q /= n
        back = (q @ p["d"].T) * (top > 0)
        rows = np.arange(n)[:, None]
        seen = full[rows, best]  # n x filters x REACH*EMBEDDING
        grad_w = np.einsum("nk,nki->ik", back, seen).reshape(p["w"].shape) * self.shape()
        grad_full = back[:, :, None] * flat.T[None]  # n x filters x REACH*EMBEDDING
        grad_e = np.zeros_like(p["e"])
        np.add.at(grad_e, spans[rows, best].reshape(-1), grad_full.reshape(-1, EMBEDDING))
        grad_e[0] = 0
        return loss, {"d": h.T @ q, "c": q.sum(0), "b": back.sum(0), "w": grad_w, "e": grad_e}

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses of the filters' first two places, and of the last two, for each pair of bytes."""
        own = np.einsum("be,rek->rbk", self.params["e"], self.params["w"])
        return tuple(np.ascontiguousarray((own[r][:, None] + own[r + 1][None]).reshape(65536, -1)) for r in (0, 2))

    def score(self, x: np.ndarray, tables: tuple[np.ndarray, np.ndarray], part: int = 32) -> np.ndarray:
        """Class probabilities of each window."""
        p, tops = self.params, []
        for k in range(0, len(x), part):
            some = x[k : k + part].astype(np.int32)
            pair = some[:, :-1] * 256 + some[:, 1:]
            pre = tables[0][pair[:, : WINDOW - REACH + 1]]
            pre += tables[1][pair[:, 2:]]
            tops.append(pre.max(1))
        z = np.maximum(np.concatenate(tops) + p["b"], 0) @ p["d"] + p["c"]
        q = np.exp(z - z.max(1, keepdims=True))
        return q / q.sum(1, keepdims=True)


def windows(data: bytes) -> np.ndarray:
    """All of a text, in windows; the last is padded with zeros."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), dtype=np.uint8).reshape(n, WINDOW)


def train(texts: list[bytes], labels: list[str], steps: int = 600, batch: int = 96, seed: int = 7) -> Network:
    """From windows at random places of the whole texts, short ones included, so that short texts are like what it has seen."""
    classes = sorted(set(labels))
    net, rng = Network.new(classes, seed), np.random.default_rng(seed)
    y_all = np.array([classes.index(x) for x in labels])
    weight = 1 / np.bincount(y_all, minlength=max(1, len(classes)))
    chance = weight[y_all] / weight[y_all].sum()
    optimiser = Adam(net.params, 0.01)
    for s in range(steps):
        optimiser.rate = 0.01 * (1 - s / steps) + 0.0005
        chosen = rng.choice(len(texts), batch, p=chance)
        x = np.zeros((batch, WINDOW), dtype=np.uint8)
        for row, k in enumerate(chosen):
            size = WINDOW if rng.random() < 0.6 else int(rng.integers(8, WINDOW))
            at = int(rng.integers(0, max(1, len(texts[k]) - size + 1)))
            cut = texts[k][at : at + size]
            x[row, : len(cut)] = np.frombuffer(cut, dtype=np.uint8)
        optimiser.step(net.step(x, y_all[chosen])[1])
    return net


@functools.lru_cache(maxsize=4)
def _tables(key: bytes, shapes: int) -> tuple[np.ndarray, np.ndarray]:
    e, w = np.frombuffer(key[:shapes], dtype=np.float32).reshape(256, EMBEDDING), np.frombuffer(key[shapes:], dtype=np.float32).reshape(REACH, EMBEDDING, -1)
    return Network([], {"e": e, "w": w}).tables()


def predict(texts: list[str | None], net: Network) -> tuple[list[str], np.ndarray]:
    """Language and probability of each text; UNKNOWN and 0 for null and for texts without a letter."""
    key = (net.params["e"].tobytes(), net.params["w"].tobytes())
    tables = _tables(b"".join(key), len(key[0]))
    languages, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    at, held, size = [], [], 0

    def flush() -> None:
        nonlocal at, held, size
        if not held:
            return
        x = np.concatenate([windows(d) for d in held])
        counts = np.array([max(1, -(-len(d) // WINDOW)) for d in held])
        ends = np.cumsum(counts)
        length = np.full(len(x), float(WINDOW))
        length[ends - 1] = [max(1, len(d)) - (c - 1) * WINDOW for d, c in zip(held, counts, strict=True)]
        q = np.add.reduceat(net.score(x, tables) * length[:, None], ends - counts) / np.add.reduceat(length, ends - counts)[:, None]
        for k, row in zip(at, q, strict=True):
            languages[k], scores[k] = net.classes[int(row.argmax())], float(row.max())
        at, held, size = [], [], 0

    for k, t in enumerate(texts):
        if t and any(map(str.isalpha, t)):
            at.append(k)
            held.append(t.encode())
            size += len(held[-1])
            if size > 1 << 18:
                flush()
    flush()
    return languages, scores


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_out: int = 2, per_language: int = 600, most_bytes: int = 64 << 20, longest: int = 1 << 20, most_languages: int = 200) -> Network | None:
    """From ``per_language`` documents of each language at most, whole, none of the held-out fold; None where none is labelled.

    Documents of more than ``longest`` bytes aren't learned from, nor those beyond ``most_bytes`` in all, nor languages beyond
    the ``most_languages`` most frequent (see :func:`nets.bounded`). Null and empty texts have nothing to learn from.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("body"), F.col(lang_col).alias("lang"))
    labelled = rows.filter(F.col("lang").isNotNull() & (F.octet_length("body") > 0) & (remainder("id", folds) != held_out))
    found = bounded(labelled, "lang", ["id", "body"], per_language, "body", most_bytes, longest, most_languages).select("lang", "body").collect()
    found.sort(key=lambda r: (r.lang, bytes(r.body)))
    return train([bytes(r.body) for r in found], [r.lang for r in found]) if found else None


def identify(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held_out: int = 2) -> DataFrame:
    """One row for each document: id, held_out, lang_pred and score.

    Null texts and those without a letter are UNKNOWN with score 0, as is every text where no row has a label to learn from.
    A text of any length counts whole, window by window; of equally likely languages the first in order of names is taken.
    Repeated rows stay; other columns are ignored. An empty table gives no rows.
    """
    net = net or fit(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), (remainder(id_col, folds) == held_out).alias("held_out"), F.col(text_col).alias("body"))
    schema = rows.select("id", "held_out", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches):
        for b in slices(batches):
            languages, scores = predict(b.column("body").to_pylist(), net) if net else ([UNKNOWN] * b.num_rows, np.zeros(b.num_rows))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("held_out"), pa.array(languages, pa.string()), pa.array(scores)], ["id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def keep(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text", least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of at least ``least``, with all their columns.

    Null texts and those without a letter go, and every row where none has a label to learn from. Repeated rows stay or go
    together, whatever their other columns hold. An empty table gives no rows.
    """
    net = net or fit(docs, id_col, text_col)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in slices(batches):
            languages, scores = predict(b.column(at).to_pylist(), net) if net else ([UNKNOWN] * b.num_rows, np.zeros(b.num_rows))
            yield b.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(languages, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10_langid(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
