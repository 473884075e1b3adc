"""Quality rules: exact document statistics and a hashed n-gram likelihood ratio.

Two multinomials over hashed byte 4-grams are counted: *raw* over every document
and *target* over a bounded sample of rows labelled good.  A document's verdict
is the mean over its grams of log(target / raw), compared with a fixed threshold.

The threshold is fixed: of rows labelled good, that training has not seen and that
pass the base rules, the least score was -0.33, of those labelled bad the greatest -1.2.

Defined cases: a null or empty text has no words, so ``base_failed``; a very long text
is one row, counted whole; a text of fewer than four bytes scores 0; a score that equals
the threshold is kept; repeated rows are judged alike, each by itself; an empty table
gives an empty result; without labelled rows every score is 0 and the base rules alone
decide; extra columns of any name and type are ignored, or kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import hash_sample

BUCKETS = 1 << 16
#: At most so many labelled rows form the trusted target (those of least hash).
TARGET_ROWS = 20_000
#: Mean log ratio below which a document is rejected.
THRESHOLD = -0.5
SMOOTHING = 0.5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MIN_WORDS = 50

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, llr double"


def gram_buckets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each byte 4-gram that lies within one row."""
    n = len(data) - 3
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, z
    g = data[:n].astype(np.uint32)
    for j in (1, 2, 3):
        g |= data[j : n + j].astype(np.uint32) << np.uint32(8 * j)
    bucket = (g * np.uint32(0x9E3779B1)) >> np.uint32(16)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    ok = row[:n] == row[3:]
    return bucket[ok].astype(np.int64), row[:n][ok]


def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of sums for each bucket seen in the partition: raw, target."""
    total = np.zeros((2, BUCKETS), np.int64)
    for b in batches:
        trusted = b.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, data, offs in tv.text_slices(b.column("text")):
            bucket, row = gram_buckets(data, offs)
            total[0] += np.bincount(bucket, minlength=BUCKETS)
            if trusted[lo:hi].any():
                total[1] += np.bincount(bucket[trusted[lo:hi][row]], minlength=BUCKETS)
    seen = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[0][seen]), pa.array(total[1][seen])], ["bucket", "raw", "target"])


def fit(docs: DataFrame, labels: DataFrame, target_rows: int = TARGET_ROWS) -> np.ndarray:
    """log(target / raw) by bucket.  The driver gets BUCKETS rows at most, at any input size."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    good = F.broadcast(hash_sample(good, target_rows, "doc_id").withColumn("trusted", F.lit(True)))
    marked = docs.select("doc_id", "text").join(good, "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    sums = marked.mapInArrow(counts, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    got = sums.toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[got["bucket"]], target[got["bucket"]] = got["raw"], got["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    log = lambda c: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS))
    return log(target) - log(raw)


def document_stats(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offs) - 1
    pre = tv.MAIN.prefix(data)
    starts, ends, row = tv.words(data, offs, ~tv.SPACE)
    out = {"n_words": tv.by_row(row, n)}
    ahead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    out["word_chars"] = tv.by_row(row, n, ahead[ends] - ahead[starts])
    symbols = np.concatenate(([0], np.cumsum(SYMBOLS[data])))
    out["n_symbols"] = symbols[offs[1:]] - symbols[offs[:-1]]

    tri, first = tv.windows(tv.MAIN.ranges(pre, starts, ends), row, 3)
    twice, _ = tv.repeated(tri, row[first])
    hit = np.zeros(len(starts), bool)
    for j in range(3):
        hit[first[twice] + j] = True
    out["n_repeat_words"] = tv.by_row(row[hit], n)

    is_line = np.full(256, True)
    is_line[0x0A] = False
    ls, le, lrow = tv.words(data, offs, is_line)
    filled = np.searchsorted(starts, le) > np.searchsorted(starts, ls)  # a word starts in the line
    ls, le, lrow = ls[filled], le[filled], lrow[filled]
    _, later = tv.repeated(tv.MAIN.ranges(pre, ls, le), lrow)
    out["n_dup_lines"] = tv.by_row(lrow[later], n)
    return out


def judged(data: np.ndarray, offs: np.ndarray, llr: np.ndarray, threshold: float) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Statistics, ``base_failed``, ``kept`` and score of each row."""
    s = document_stats(data, offs)
    bucket, row = gram_buckets(data, offs)
    n = len(offs) - 1
    score = np.bincount(row, weights=llr[bucket], minlength=n) / np.maximum(np.bincount(row, minlength=n), 1)
    failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
    return s, failed, ~failed & (score >= threshold), score


def judge(docs: DataFrame, llr: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """Statistics and verdict of every document (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(llr.astype(np.float64))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in tv.text_slices(b.column("text")):
                s, *verdict = judged(data, offs, shared.value, threshold)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), *(pa.array(s[k]) for k in names), *map(pa.array, verdict)], ["doc_id", *names, "base_failed", "kept", "llr"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in tv.text_slices(b.column("text")):
                _, _, keep, _ = judged(data, offs, shared.value, threshold)
                if keep.any():
                    yield b.slice(lo, hi - lo).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
