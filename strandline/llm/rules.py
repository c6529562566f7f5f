"""Quality rules by weak supervision.

Each rule looks at counts of a whole text and votes good or bad, or abstains. Rules are touchy: each also votes bad on some
good documents. Votes of all documents are counted by pattern (at most three to the power of the number of rules), and
expectation-maximisation over these counts estimates, without labels, how often each rule votes bad on good documents and on
each of a few kinds of bad ones. The posterior probability that a document is good given all its votes then decides, in place
of a filter that all rules must pass: a lone vote of a rule that is often wrong drops nothing, votes that agree do. The model
sees every document; what reaches the driver is bounded by the number of rules.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices, table, written

GOOD, BAD, ABSTAIN = 1, 0, 2
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#*$%&|<>"
#: What isn't a letter; bytes beyond ASCII count as letters.
OTHERS = bytes(b for b in range(128) if not chr(b).isalpha())
MARKED = bytes(1 if b in SYMBOLS else b for b in range(256))
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Counts:
    """What rules look at, of one text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int
    n_upper: int
    n_lower: int
    n_shouts: int
    n_ended: int
    n_distinct: int
    n_marked: int
    n_letters: int
    n_others: int


def repeated(words: list[bytes], n: int = 5) -> int:
    """Words in windows of n words that are found twice or more, the first included."""
    if len(words) <= n:
        return 0
    grams = list(zip(*(words[i:] for i in range(n)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    often = {g for g, c in Counter(grams).items() if c > 1}
    covered, total = 0, 0  # covered: the first word that no window has counted yet
    for i, g in enumerate(grams):
        if g in often:
            total += i + n - max(i, covered)
            covered = i + n
    return total


def counts(text: str) -> Counts:
    data = text.encode()
    words = data.split()
    joined = b"".join(words)
    seen: set[bytes] = set()
    dup = full = ended = 0
    for line in data.split(b"\n"):
        if last := line.rstrip():
            full += 1
            ended += last[-1] in b".!?\"':;)"
            dup += line in seen
            seen.add(line)
    upper = len(joined) - len(joined.translate(None, UPPER))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    return Counts(
        n_words=len(words),
        word_chars=len(joined) if joined.isascii() else len(joined.decode()),
        n_symbols=symbols,
        n_dup_lines=dup,
        n_repeat_words=repeated(words),
        n_lines=full,
        n_upper=upper,
        n_lower=len(joined) - len(joined.translate(None, UPPER.lower())),
        n_shouts=joined.count(b"!!"),
        n_ended=ended,
        n_distinct=len(set(words)),
        n_marked=sum(w.translate(MARKED) != w for w in words) if symbols else 0,
        n_letters=(letters := len(joined.translate(None, OTHERS))),
        n_others=len(joined) - letters,
    )


def between(value: Callable[[Counts], float | None], good: Callable[[float], bool], bad: Callable[[float], bool]) -> Callable[[Counts], int]:
    def vote(c: Counts) -> int:
        x = value(c)
        return ABSTAIN if x is None else BAD if bad(x) else GOOD if good(x) else ABSTAIN

    return vote


def share(over: str, under: str, least: int = 1) -> Callable[[Counts], float | None]:
    return lambda c: getattr(c, over) / getattr(c, under) if getattr(c, under) >= least else None


RULES: dict[str, Callable[[Counts], int]] = {
    "length": between(lambda c: c.n_words, lambda x: x >= 40, lambda x: x < 20),
    "word_length": between(share("word_chars", "n_words", 10), lambda x: 3.5 <= x <= 6.5, lambda x: x < 2.5 or x > 7),
    "symbols": between(share("n_symbols", "n_words", 5), lambda x: x <= 0.02, lambda x: x > 0.1),
    "marked": between(share("n_marked", "n_words", 5), lambda x: x <= 0.02, lambda x: x > 0.1),
    "letters": between(lambda c: c.n_letters / (c.n_letters + c.n_others) if c.n_letters + c.n_others >= 100 else None, lambda x: x >= 0.92, lambda x: x < 0.85),
    "repeats": between(share("n_repeat_words", "n_words", 10), lambda x: x <= 0.05, lambda x: x > 0.1),
    "lines": between(share("n_dup_lines", "n_lines", 4), lambda x: x <= 0.1, lambda x: x > 0.3),
    "capitals": between(lambda c: c.n_upper / (c.n_upper + c.n_lower) if c.n_upper + c.n_lower >= 20 else None, lambda x: x <= 0.05, lambda x: x > 0.1),
    "shouts": between(share("n_shouts", "n_words", 10), lambda x: x <= 0.01, lambda x: x > 0.05),
    "endings": between(share("n_ended", "n_lines", 4), lambda x: x >= 0.8, lambda x: x < 0.6),
    "variety": between(share("n_distinct", "n_words", 50), lambda x: x >= 0.4, lambda x: x < 0.3),
}


def pattern(c: Counts) -> int:
    """All votes as one number, three to the power of a rule's place."""
    return sum(rule(c) * 3**j for j, rule in enumerate(RULES.values()))


def votes(code: np.ndarray, rules: int = len(RULES)) -> np.ndarray:
    return code[:, None] // 3 ** np.arange(rules) % 3


class Model:
    """A class of good documents and some kinds of bad ones; a rule that doesn't abstain votes bad with a probability of its own on each.

    ``share``: of the classes among documents, the good one first; ``bad``: classes x rules, the rates of bad votes.
    """

    def __init__(self, share: np.ndarray, bad: np.ndarray):
        self.share, self.bad = share, bad

    @classmethod
    def fit(cls, code: np.ndarray, n: np.ndarray, kinds: int = 3, rounds: int = 2000, tolerance: float = 1e-9, rules: int = len(RULES)) -> Model:
        """By EM over patterns of votes and how many documents have each.

        Rates have weak priors (a rate of 0.02 on good documents with the weight of 20 votes, of 0.3 on bad ones with that of
        10); all else is estimated. A kind of bad documents starts from a frequent pattern in which two rules or more agree, each
        next one from a pattern unlike those before; documents that one rule alone votes against may be good ones. A bad vote
        never speaks for a document: no kind's rate is below that on good ones.
        """
        v, w = votes(code, rules), n.astype(float)
        is_bad, said = (v == BAD).astype(float), (v != ABSTAIN).astype(float)
        several, seeds = is_bad.sum(1) >= 2, []
        worth = np.where(several, w, 0.0)
        while len(seeds) < kinds and worth.max(initial=0) > 0:
            at = int(np.lexsort((code, -worth))[0])
            seeds.append(is_bad[at])
            both = is_bad @ is_bad[at]
            worth = worth * (1 - both / np.maximum(is_bad.sum(1) + is_bad[at].sum() - both, 1))
        seeds = np.array(seeds) if seeds else np.full((1, rules), 0.4)
        model = cls(np.append(0.9, np.full(len(seeds), 0.1 / len(seeds))), np.concatenate([np.full((1, rules), 0.02), 0.1 + 0.6 * seeds]))
        weight, mean = np.append(20.0, np.full(len(seeds), 10.0))[:, None], np.append(0.02, np.full(len(seeds), 0.3))[:, None]
        was = np.zeros(len(v))
        for _ in range(rounds):
            each = w * model.classes(code).T  # classes x patterns
            bad = (each @ is_bad + weight * mean) / (each @ said + weight)
            bad[1:] = np.maximum(bad[1:], bad[0])
            share = (each.sum(1) + 1) / (w.sum() + len(bad))
            model = cls(share, bad)
            good = model.posterior(code)
            if np.abs(was - good).max(initial=0) < tolerance:
                break
            was = good
        return model

    def classes(self, code: np.ndarray) -> np.ndarray:
        """Probability of each class, by pattern."""
        v = votes(code, self.bad.shape[1])
        logs = np.log(self.share) + (v == BAD) @ np.log(self.bad).T + (v == GOOD) @ np.log1p(-self.bad).T
        p = np.exp(logs - logs.max(1, initial=-np.inf, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def posterior(self, code: np.ndarray) -> np.ndarray:
        """Probability of good, by pattern."""
        return self.classes(code)[:, 0]


def _counted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, the counts of BASE and ``code``, the pattern of votes."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    schema = rows.select("id", *(F.lit(0).cast("long").alias(k) for k in (*BASE, "code"))).schema
    names = [f.name for f in schema]

    def run(batches):
        for b in slices(batches):
            c = [counts(t) for t in b.column("body").to_pylist()]
            cols = [pa.array([getattr(x, k) for x in c], pa.int64()) for k in BASE]
            yield pa.RecordBatch.from_arrays([b.column("id"), *cols, pa.array([pattern(x) for x in c], pa.int64())], names)

    return rows.mapInArrow(run, schema)


def _model(coded: DataFrame) -> tuple[Model, np.ndarray]:
    """The model and the patterns that it has seen, from a table with ``code``; 3 ** len(RULES) patterns at most."""
    found = sorted(map(tuple, coded.groupBy("code").agg(F.count("*")).collect()))
    code = np.array([r[0] for r in found], dtype=np.int64)
    return Model.fit(code, np.array([r[1] for r in found], dtype=np.int64)), code


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """The rules' rates, from the votes on every document; null and empty texts count as texts without words."""
    body = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("body"))

    def run(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([pattern(counts(t)) for t in b.column("body").to_pylist()], pa.int64())], ["code"])

    return _model(body.mapInArrow(run, "code long"))[0]


FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row for each document: id, the counts of BASE, base_failed, ``quality`` (the posterior) and kept.

    Texts are counted once, whole whatever their length, into a written table; the model is fitted to and applied to that.
    Null and empty texts have no words, so they fail. Repeated rows stay, equal texts get equal rows but for the id. Other
    columns are ignored, so their names can't clash. An empty table gives no rows.
    """
    coded = written(_counted(docs, id_col, text_col), "rules-counts")
    model, code = _model(coded)
    known = docs.sparkSession.createDataFrame(list(zip(code.tolist(), model.posterior(code).tolist(), strict=True)), "code long, quality double")
    rows = coded.join(F.broadcast(known), "code")  # a row for each pattern of votes: bounded by the number of rules
    failed = F.expr(FAILED)
    return rows.select(F.col("id").alias(id_col), *BASE, failed.alias("base_failed"), "quality", (~failed & (F.col("quality") >= least)).alias("kept"))


def keep(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that :func:`score` keeps, with all their columns.

    Null, empty and blank texts go. Repeated rows stay or go together, whatever their other columns hold. An empty table gives
    no rows. Texts are counted twice, as rows with their texts would cost more to write than to read again.
    """
    model = fit(docs, text_col)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in slices(batches):
            c = [counts(t or "") for t in b.column(at).to_pylist()]
            good = model.posterior(np.array([pattern(x) for x in c], dtype=np.int64)) >= least
            failed = np.array([x.n_words < 10 or 100 * x.n_repeat_words > 20 * x.n_words for x in c], dtype=bool)
            yield b.filter(pa.array(good & ~failed))

    return docs.mapInArrow(run, docs.schema)


def op5_rules(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
