"""Quality classifier by attention-based multiple-instance learning, in numpy.

A document is a bag of passages; only documents have labels. Every passage is encoded: byte-pair frequencies
hashed to a fixed number of buckets and a few shares, then a dense layer. Gated attention (tanh times sigmoid)
gives each passage a weight, weights of a document sum to one, and the weighted sum of its passages' codes is
scored. All parameters are learned together from document labels; a document's score reads its whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import table
from strandline.llm.nets import Adam, bounded, remainder

PASSAGE, BUCKETS, GRAMS, CODE, GATE = 512, 256, 4096, 32, 16
#: Byte classes whose shares are features: capitals, small letters, digits, blanks, sentence marks, other marks, beyond ASCII.
KINDS = np.zeros(256, dtype=np.uint8)
for _k, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), (9, 10, 11, 12, 13, 32), b".,;:?'\"()-", b"!#$%&*+/<=>@[\\]^_`{|}~", range(128, 256))):
    KINDS[list(_bytes)] = _k + 1
FEATURES = BUCKETS + 8 + 2


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(passages x FEATURES, passages of each text); an empty text is one empty passage."""
    counts = np.array([max(1, -(-len(t) // PASSAGE)) for t in texts], dtype=np.int64)
    x = np.zeros((int(counts.sum()), PASSAGE), dtype=np.uint8)
    at = 0
    for t, n in zip(texts, counts.tolist(), strict=True):
        x[at : at + n].reshape(-1)[: len(t)] = np.frombuffer(t, dtype=np.uint8)
        at += n
    out = np.empty((len(x), FEATURES), dtype=np.float32)
    for k in range(0, len(x), 512):
        p = x[k : k + 512]
        row = np.arange(len(p))[:, None]
        size = np.maximum((p > 0).sum(1), 1)[:, None].astype(np.float32)
        pair = p[:, :-1].astype(np.uint32) * 256 + p[:, 1:]
        bucket = (pair * np.uint32(2654435761) >> np.uint32(24)) + (row * BUCKETS).astype(np.uint32)
        n = np.bincount(bucket.reshape(-1), minlength=len(p) * BUCKETS).reshape(len(p), BUCKETS)
        n[:, 0] -= (pair == 0).sum(1)  # padding
        out[k : k + 512, :BUCKETS] = np.sqrt(n / size)
        kind = np.bincount((KINDS[p] + row * 8).reshape(-1), minlength=len(p) * 8).reshape(len(p), 8)
        kind[:, 0] -= (p == 0).sum(1)
        out[k : k + 512, BUCKETS : BUCKETS + 8] = kind / size
        quad = (pair[:, :-2] << np.uint32(16) | pair[:, 2:]) * np.uint32(2246822519) >> np.uint32(20)
        seen = np.zeros((len(p), GRAMS), dtype=bool)
        seen[row, quad] = True
        out[k : k + 512, BUCKETS + 8] = seen.sum(1) / size[:, 0]
        out[k : k + 512, BUCKETS + 9] = np.log1p(size[:, 0]) / 6
    return out, counts


class Network:
    """params: w, b (dense layer), v, u (the gate's two halves), a (attention), c, d (score), mean and scale of features."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.params = params

    @classmethod
    def new(cls, x: np.ndarray, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        n = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        zero = lambda *s: np.zeros(s, dtype=np.float32)
        net = cls({"w": n(FEATURES, CODE), "b": zero(CODE), "v": n(CODE, GATE), "u": n(CODE, GATE), "a": n(GATE, 1)[:, 0], "c": n(CODE, 1)[:, 0], "d": zero(1)})
        net.mean, net.scale = x.mean(0), 1 / (x.std(0) + 0.01)
        return net

    def forward(self, x: np.ndarray, counts: np.ndarray) -> tuple:
        """Scores' logits, and what the gradients need."""
        p = self.params
        x = (x - self.mean) * self.scale
        starts = np.cumsum(counts) - counts
        h = np.maximum(x @ p["w"] + p["b"], 0)
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-np.clip(h @ p["u"], -30, 30)))
        e = (t * g) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
        a = e / np.repeat(np.add.reduceat(e, starts), counts)
        z = np.add.reduceat(a[:, None] * h, starts)
        return z @ p["c"] + p["d"][0], (x, starts, h, t, g, a, z)

    def score(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x, counts)[0].astype(np.float64), -50, 50)))

    def step(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        p = self.params
        logit, (x, starts, h, t, g, a, z) = self.forward(x, counts)
        q = 1 / (1 + np.exp(-logit))
        loss = -float(np.where(y > 0, np.log(q + 1e-9), np.log(1 - q + 1e-9)).mean())
        up = ((q - y) / len(y)).astype(np.float32)
        grads = {"c": z.T @ up, "d": np.array([up.sum()], dtype=np.float32)}
        back = np.repeat(up, counts)[:, None] * p["c"]  # by z of each passage's document
        da = (back * h).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), counts))
        dh = a[:, None] * back
        gate = de[:, None] * p["a"]
        grads["a"] = (t * g).T @ de
        dt, dg = gate * g * (1 - t * t), gate * t * g * (1 - g)
        grads["v"], grads["u"] = h.T @ dt, h.T @ dg
        dh = (dh + dt @ p["v"].T + dg @ p["u"].T) * (h > 0)
        grads["w"], grads["b"] = x.T @ dh, dh.sum(0)
        return loss, grads


def train(x: np.ndarray, counts: np.ndarray, y: np.ndarray, epochs: int = 25, batch: int = 64, seed: int = 11) -> Network:
    net, rng = Network.new(x, seed), np.random.default_rng(seed)
    optimiser, starts = Adam(net.params, 0.004, 0.02), np.cumsum(counts) - counts
    for k in range(epochs):
        optimiser.rate = 0.004 * (1 - k / epochs) + 0.0003
        order = rng.permutation(len(y))
        for s in range(0, len(order), batch):
            some = order[s : s + batch]
            rows = np.concatenate([np.arange(starts[i], starts[i] + counts[i]) for i in some])
            optimiser.step(net.step(x[rows], counts[some], y[some])[1])
    return net


def _in_parts(texts: list[bytes], size: int = 1 << 18):
    """Slices of ``texts`` of about ``size`` bytes."""
    at = held = 0
    for k, t in enumerate(texts):
        held += len(t)
        if held > size:
            yield at, k + 1
            at, held = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5, held_out: int = 0, per_class: int = 1500, most_bytes: int = 64 << 20, longest: int = 1 << 20) -> Network | None:
    """From ``per_class`` labelled documents of either class at most, none of the held-out fold; every passage of each counts.

    Documents of more than ``longest`` bytes aren't learned from, nor those beyond ``most_bytes`` in all (see
    :func:`nets.bounded`); what is learned from is whole. Passages are encoded where the documents are. A document that is
    labelled twice, differently, counts as either. Null ids have no label. None without labels.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & (remainder("id", folds) != held_out))
    ids = bounded(known, "label", ["id"], per_class)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    # the sampled ids have a fixed bound; rows with one id may be many, so they are bounded once more
    rows = bounded(texts.join(F.broadcast(ids), "id"), "label", ["id", "body"], per_class, "body", most_bytes, longest).select("label", "id", "body")

    def run(batches):
        for b in batches:
            body = b.column("body").to_pylist()
            for lo, hi in _in_parts(body):
                x, counts = features(body[lo:hi])
                x, ends = x.astype(np.float16), np.cumsum(counts)
                data = [x[e - n : e].tobytes() for n, e in zip(counts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("label").slice(lo, hi - lo), b.column("id").slice(lo, hi - lo), pa.array(data, pa.binary())], ["label", "id", "x"])

    found = rows.mapInArrow(run, rows.select("label", "id", F.lit(b"").alias("x")).schema).collect()
    if not found:
        return None
    found.sort(key=lambda r: (str(r.id), r.x))
    x = [np.frombuffer(r.x, dtype=np.float16).reshape(-1, FEATURES) for r in found]
    return train(np.concatenate(x).astype(np.float32), np.array([len(m) for m in x]), np.array([r.label for r in found], dtype=np.float32))


def classify(docs: DataFrame, labels: DataFrame | None = None, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 0, least: float = 0.3) -> DataFrame:
    """One row for each document: id, held_out, score and predicted (1 where the score is ``least`` or more).

    Null and empty texts are one empty passage and get its score; without any label all scores are 0.5. A text of any length is
    scored by all its passages. Repeated rows stay, equal texts get equal scores, other columns are ignored. An empty table
    gives no rows.
    """
    net = net or (fit(docs, labels, id_col, text_col, folds=folds, held_out=held_out) if labels is not None else None)
    rows = docs.select(F.col(id_col).alias("id"), (remainder(id_col, folds) == held_out).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    schema = rows.select("id", "held_out", F.lit(0.0).alias("score")).schema

    def run(batches):
        for b in batches:
            body = b.column("body").to_pylist()
            for lo, hi in _in_parts(body):
                score = net.score(*features(body[lo:hi])) if net else np.full(hi - lo, 0.5)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(score)], ["id", "held_out", "score"])

    scored = rows.mapInArrow(run, schema)
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op7_mil(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
