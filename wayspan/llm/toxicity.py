"""Toxicity: a learned weighted lexicon matched by Aho-Corasick on folded text.

Folding maps homoglyphs, digit substitutions and stretched letters onto plain
lower-case words.  Weights are log odds of a word among labelled rows; a text's
evidence is the weight of its matches outside exception phrases, normalised by
length, and a logistic curve turns it into a score.  Exception phrases are a few given
ones, and pairs of words with a lexicon word that lean to harmless labelled rows.

Defined cases: null and empty texts have no matches and get the score of no
evidence; a very long text is one row, folded and matched whole; a null or clashing
label is not learned from; a null doc_id is not held out; of words of equal weight the
later in order comes first; repeated rows are scored alike, each by itself; without
labels of both kinds the lexicon is empty and every text gets the same low score; an
empty table gives an empty result; extra columns of any name and type are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample
from .pii import FOLD, INVISIBLE

#: At most so many labelled rows are learned from (those of least hash).
TRAIN_ROWS = 40_000
LEXICON = 400
MIN_DOCS = 4
MIN_ODDS = 1.5
THRESHOLD = 0.7
#: Pairs of words learned as exceptions: at most so many, each in so many harmless rows at least.
PHRASES, MIN_HARMLESS = 200, 4
#: Harmless phrases that hold lexicon words; words within them don't count.
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "clown fish", "scum line", "pond scum", "loser bracket")
#: Digits and signs written for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_FOLD = FOLD | {ord(c): None for c in INVISIBLE}
_LEET = {ord(k): v for k, v in LEET.items()}
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_matches long"


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def fold(text: str) -> str:
    """Lower case with homoglyphs, and digits next to letters, made plain; words set apart by one space."""
    if not text.isascii():
        text = text.translate(_FOLD)
    out = []
    for w in text.lower().split():
        if not w.isalpha():
            core = w.strip(".,;:!?()[]{}<>|\"'*_~`-")
            if any(c in LEET for c in core) and any(c.isalpha() for c in core):
                core = core.translate(_LEET)
            w = core if core.isalpha() else "".join(c if c.isalpha() else " " for c in core)
        out.append(w)
    return " " + " ".join(" ".join(out).split()) + " "


@dataclass
class Model:
    weights: dict[str, float]
    coef: tuple[float, ...]  # of the features, then the intercept
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for w, x in self.weights.items():
            a.add_word(f" {w} ", (len(w), x))
        for p in self.exceptions:
            a.add_word(f" {p} ", (len(p), None))
        if len(a):
            a.make_automaton()
        return a

    def features(self, folded: str, automaton) -> tuple[float, float, int]:
        """Evidence by length, distinct matches by length, matches."""
        hits, shade = [], []
        if len(automaton):
            for end, (n, x) in automaton.iter(folded):
                (shade if x is None else hits).append((end - n, end, x))
        if shade:  # both in order of their ends
            inside = np.zeros(len(folded) + 1, np.int32)
            for a, z, _ in shade:
                inside[a] += 1
                inside[z] -= 1
            inside = np.cumsum(inside)
            hits = [h for h in hits if not inside[h[0]]]
        words = folded.count(" ") - 1
        if not hits:
            return 0.0, 0.0, 0
        kinds = len({folded[a:z] for a, z, _ in hits})
        return math.log1p(100 * sum(x for *_, x in hits) / (words + 20)), math.log1p(200 * kinds / (words + 50)), len(hits)

    def score(self, f: tuple[float, float, int]) -> float:
        z = self.coef[0] * f[0] + self.coef[1] * f[1] + self.coef[2] * math.log1p(f[2]) + self.coef[3]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Newton's method on the penalised log likelihood; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w, reg = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + reg, x.T @ (y - p) - reg @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _train_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(folded words, toxic) of the sample; its ids are few enough to broadcast."""
    ids = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = ids.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("__hi")).where("toxic = __hi").drop("__hi")
    ids = hash_sample(ids, most, "doc_id")
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def _word_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic documents, others) for each word of a batch, and one row of totals under a null word."""
    for b in batches:
        seen: dict[str | None, list[int]] = {None: [0, 0]}
        for text, toxic in zip(b.column("text"), b.column("toxic").to_pylist(), strict=True):
            for w in {None, *fold(text.as_py() or "").split()}:
                seen.setdefault(w, [0, 0])[1 - toxic] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([x[0] for x in seen.values()], pa.int64()), pa.array([x[1] for x in seen.values()], pa.int64())], ["word", "bad", "good"])


def _phrase_docs(lexicon: frozenset):
    """(phrase, toxic documents, others) for each pair of words with one of the lexicon."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(b.column("text"), b.column("toxic").to_pylist(), strict=True):
                ws = fold(text.as_py() or "").split()
                for phrase in {f"{x} {y}" for x, y in zip(ws, ws[1:], strict=False) if x in lexicon or y in lexicon}:
                    seen.setdefault(phrase, [0, 0])[1 - toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([x[0] for x in seen.values()], pa.int64()), pa.array([x[1] for x in seen.values()], pa.int64())], ["phrase", "bad", "good"])

    return run


def harmless_phrases(rows: DataFrame, weights: dict[str, float], bad: int, good: int) -> tuple[str, ...]:
    """Pairs of words that hold a lexicon word, and are no more frequent among the toxic rows than among the others."""
    n = rows.mapInArrow(_phrase_docs(frozenset(weights)), "phrase string, bad long, good long").groupBy("phrase").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    lean = (F.col("bad") + 0.5) / F.lit(bad + 1.0) <= (F.col("good") + 0.5) / F.lit(good + 1.0)
    top = n.where((F.col("good") >= MIN_HARMLESS) & lean).orderBy(F.desc("good"), "phrase").limit(PHRASES)
    return tuple(sorted(r["phrase"] for r in top.collect()))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, lexicon: int = LEXICON, exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """Lexicon and curve from labelled rows that are not held out."""
    rows = _train_rows(docs, labels, train_rows)
    sums = rows.mapInArrow(_word_docs, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    # the labelled sample bounds the totals row and the words; only LEXICON of them come to the driver
    top = sums.where(F.col("word").isNull() | (F.col("bad") >= MIN_DOCS)).orderBy(F.col("word").isNotNull(), F.desc(F.col("bad") / (F.col("good") + 1)), F.desc("bad"), "word").limit(3 * lexicon + 1).collect()
    total = next((r for r in top if r["word"] is None), None)
    if total is None or not total["bad"] or not total["good"]:
        return Model({}, (0.0, 0.0, 0.0, -4.0), exceptions)
    odds = {r["word"]: math.log((r["bad"] + 0.5) / (total["bad"] + 1)) - math.log((r["good"] + 0.5) / (total["good"] + 1)) for r in top if r["word"] is not None}
    best = sorted(((x, w) for w, x in odds.items() if x >= MIN_ODDS), reverse=True)[:lexicon]
    weights = {w: round(x, 6) for x, w in best}
    exceptions = tuple(sorted({*exceptions, *harmless_phrases(rows, weights, total["bad"], total["good"])}))
    model = Model(weights, (0.0, 0.0, 0.0, 0.0), exceptions)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for b in batches:
            f = [shared.value.features(fold(t.as_py() or ""), automaton) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array([round(x[0], 2) for x in f], pa.float64()), pa.array([round(x[1], 2) for x in f], pa.float64()), pa.array([min(x[2], 50) for x in f], pa.int64()), b.column("toxic")], ["a", "b", "c", "y"])

    # at most train_rows points
    got = rows.mapInArrow(run, "a double, b double, c long, y int").groupBy("a", "b", "c", "y").count().orderBy("a", "b", "c", "y").toPandas()
    n = got["count"].to_numpy()
    x = np.column_stack([got["a"], got["b"], np.log1p(got["c"])]).repeat(n, axis=0)
    w = logistic(x, got["y"].to_numpy().repeat(n).astype(float))
    return Model(model.weights, tuple(float(v) for v in w), exceptions)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every document's score; its inputs are the text and the model alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for b in batches:
            f = [shared.value.features(fold(t.as_py() or ""), automaton) for t in b.column("text")]
            s = np.array([shared.value.score(x) for x in f])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32)), pa.array([x[2] for x in f], pa.int64())], ["doc_id", "held_out", "score", "predicted", "n_matches"])

    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(held_out(doc_id), F.lit(False)).alias("held_out"), "text").mapInArrow(run, SCHEMA)
