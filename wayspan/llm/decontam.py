"""Benchmark decontamination with a generalised suffix automaton over words.

The normalised items build automata of bounded size; documents stream their words
through one after the other, keeping the longest suffix that is a factor of some
item.  Where that match is as long as a window (10 words, or a whole shorter item),
the window's words are hit.  Only runs of words whose neighbours are neighbours in
some item can hold a match; runs are found by hash first, their words are compared
with the items', and then they are walked.

Items are cut into pieces that share a window but one word, so no window is lost, and
dealt to automata of about ``MAX_WORDS`` words, which executors build and keep as files
in the shared folder.  A task holds one of them at a time, and reads the next for some
``HELD_BYTES`` of texts together.

Defined cases: a null text has no words; a very long text is one row, scanned whole;
items without words are ignored; an item with a null id marks words but is not
counted; equal items each count, repeated ones once; repeated rows are judged alike,
each by itself; no items: nothing is hit; an empty table gives an empty result; extra
columns of any name and type are ignored, or kept by ``remove_spans``.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..tables import scope, scratch, settled
from . import textvec as tv

WINDOW = 10
#: Words of items in one automaton (some 35 MB), about; a piece of an item has an eighth of it at most.
MAX_WORDS = 100_000
#: Bytes of texts that are scanned by one automaton before the next is read, where there are several.
HELD_BYTES = 1 << 25
#: ``remove_spans`` drops a document of which a larger share than this is hit.
MAX_COVERAGE = 0.5


def item_words(text: str | None) -> list[bytes]:
    raw = (text or "").encode().translate(bytes(tv.LOWER))
    data = np.frombuffer(raw, np.uint8)
    s, e, _ = tv.words(data, np.array([0, len(data)]), tv.ALNUM)
    return [raw[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)]


class Automaton:
    """Suffix automaton of several word sequences; states know the windows that end in them."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.ids: dict[bytes, int] = {}
        seqs = [(item, [self.ids.setdefault(w, len(self.ids)) for w in ws]) for item, ws in items if ws]
        for _, seq in seqs:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        # marks[state]: length of a window -> items; only substrings of that state
        self.marks: dict[int, dict[int, set]] = {}
        for item, seq in seqs:
            k = min(window, len(seq))
            state, length = 0, 0
            for i, c in enumerate(seq):
                state, length = self.next[state][c], length + 1
                while self.len[self.link[state]] >= k:
                    state = self.link[state]
                length = min(length, k)
                if i >= k - 1:
                    self.marks.setdefault(state, {}).setdefault(k, set()).add(item)
        # chain[state]: states at and above it that hold marks, longest first
        order = sorted(range(len(self.len)), key=self.len.__getitem__)
        self.chain: list[tuple[int, ...]] = [()] * len(order)
        for s in order[1:]:
            up = self.chain[self.link[s]]
            self.chain[s] = (s, *up) if s in self.marks else up
        self.words = words = list(self.ids)
        hashes = hash_words(words)
        by = np.argsort(hashes)
        self.word_hash, self.word_id = hashes[by], by
        pairs = [tv.windows(hashes[np.array(seq)], np.zeros(len(seq), np.int64), 2)[0] for _, seq in seqs if len(seq) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)
        self.shortest = min((min(window, len(seq)) for _, seq in seqs), default=0)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, ln = self.next, self.link, self.len
        if c in nxt[last]:
            q = nxt[last][c]
            return q if ln[q] == ln[last] + 1 else self._split(last, c, q)
        cur = len(ln)
        nxt.append({})
        ln.append(ln[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if ln[q] == ln[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        clone = len(self.len)
        self.next.append(dict(self.next[q]))
        self.len.append(self.len[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def walk(self, seq: list[int]) -> Iterator[tuple[int, int, set]]:
        """(end, length, items) of each window that occurs in the sequence."""
        nxt, link, ln, chain, marks = self.next, self.link, self.len, self.chain, self.marks
        state, length = 0, 0
        for i, c in enumerate(seq):
            while state and c not in nxt[state]:
                state = link[state]
                length = ln[state]
            state = nxt[state].get(c, 0)
            length = length + 1 if state else 0
            for s in chain[state]:
                for k, items in marks[s].items():
                    if k <= length:
                        yield i + 1, k, items


def hash_words(ws: list[bytes]) -> np.ndarray:
    offs = np.concatenate(([0], np.cumsum([len(w) for w in ws]))).astype(np.int64)
    pre = tv.MAIN.prefix(np.frombuffer(b"".join(ws), np.uint8))
    return tv.MAIN.ranges(pre, offs[:-1], offs[1:])


def _member(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return sorted_keys[at] == keys


_TOP = 1 << 16


def _mask(sorted_keys: np.ndarray) -> np.ndarray:
    """Which top 16 bits occur: most other words are ruled out by one look-up."""
    out = np.zeros(_TOP, bool)
    out[(sorted_keys >> tv.U(48)).astype(np.int64)] = True
    return out


def scan(auto: Automaton, data: np.ndarray, offs: np.ndarray):
    """Words of each row, and the hit word numbers and items found in rows that hold any."""
    low = tv.LOWER[data]
    starts, ends, row = tv.words(low, offs, tv.ALNUM)
    found: dict[int, tuple[np.ndarray, set]] = {}
    if len(starts) and auto.shortest:
        if not hasattr(auto, "mask"):
            auto.mask = _mask(auto.word_hash)
        h = tv.MAIN.ranges(tv.MAIN.prefix(low), starts, ends)
        near = np.flatnonzero(auto.mask[(h >> tv.U(48)).astype(np.int64)])
        known = np.zeros(len(h), bool)
        known[near] = _member(auto.word_hash, h[near])
        # joined[i]: words i and i + 1 stand next to each other in some item
        both = np.flatnonzero(known[:-1] & known[1:] & (row[:-1] == row[1:]))
        joined = np.zeros(len(h), bool)
        pair = h[both] * tv.U(0xF1357AEA2E62A9C5) + (h[both + 1] ^ (h[both + 1] >> tv.U(23)))
        joined[both] = _member(auto.pairs, tv.mix(pair))
        head = known.copy()
        head[1:] &= ~joined[:-1]
        tail = known & ~joined
        a, z = np.flatnonzero(head), np.flatnonzero(tail) + 1
        long = z - a >= auto.shortest
        begin = np.searchsorted(row, np.arange(len(offs)))
        for lo, hi in zip(a[long].tolist(), z[long].tolist(), strict=True):
            ids = auto.word_id[np.searchsorted(auto.word_hash, h[lo:hi])].tolist()
            raw = low[starts[lo] : ends[hi - 1]].tobytes()
            # equal hashes are not enough: a word that differs from the item's ends a match
            ids = [k if auto.words[k] == raw[x:y] else -1 for k, x, y in zip(ids, (starts[lo:hi] - starts[lo]).tolist(), (ends[lo:hi] - starts[lo]).tolist(), strict=True)]
            for end, k, items in auto.walk(ids):
                r = int(row[lo])
                if r not in found:
                    found[r] = (np.zeros(begin[r + 1] - begin[r], bool), set())
                at = lo + end - int(begin[r])
                found[r][0][at - k : at] = True
                found[r][1].update(items)
    return starts, ends, row, found


def _pieces(window: int, most: int):
    """Items as normalised pieces of ``most`` words, the next beginning ``window - 1`` before the last's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text in enumerate(b.column("text")):
                ws = item_words(text.as_py())
                for at in range(0, max(1, len(ws) - window + 1) if ws else 0, most):
                    part = ws[at : at + most + window - 1]
                    rows.append((i, b" ".join(part).decode(), len(part)))
            if rows:
                which, words, n = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([b.column("item_id").take(pa.array(which)), pa.array(words, pa.string()), pa.array(n, pa.int64())], ["item_id", "words", "n"])

    return run


def _build(folder: str, window: int):
    """Rows sorted by part: one automaton each, written under its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tag = TaskContext.get().taskAttemptId()
        last, items = None, []

        def write() -> pa.RecordBatch:
            store, base = fs.FileSystem.from_uri(folder)
            store.create_dir(base)
            with store.open_output_stream(f"{base}/.{last}-{tag}", compression=None) as out:
                out.write(pickle.dumps(Automaton(items, window), protocol=5))
            store.move(f"{base}/.{last}-{tag}", f"{base}/{last}")
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{last}"]})

        for b in batches:
            for part, item, words in zip(*(b.column(c).to_pylist() for c in ("part", "item_id", "words")), strict=True):
                if part != last and items:
                    yield write()
                    items = []
                last = part
                items.append((item, words.encode().split(b" ")))
        if items:
            yield write()

    return run


def automata(benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> list[str]:
    """Files of the automata; the driver gets their names alone."""
    spark = benchmark.sparkSession
    folder = scratch(spark, "automata")
    schema = StructType([StructField("item_id", benchmark.schema["item_id"].dataType), StructField("words", StringType()), StructField("n", LongType())])
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    with scope():
        pieces = settled(items.mapInArrow(_pieces(window, max(1, max_words // 8)), schema).distinct())
        parts = -(-(pieces.agg(F.sum("n")).first()[0] or 0) // max_words)
        if not parts:
            return []
        dealt = pieces.withColumn("part", F.pmod(F.xxhash64("item_id", "words"), F.lit(parts))).repartition(parts, "part").sortWithinPartitions("part")
        built = dealt.select("part", "item_id", "words").mapInArrow(_build(folder, window), "path string")
        return sorted(r[0] for r in built.collect())


_loaded: dict[str, Automaton] = {}


def load(path: str) -> Automaton:
    """The automaton of a file; the process keeps the last one."""
    if path not in _loaded:
        _loaded.clear()
        store, name = fs.FileSystem.from_uri(path)
        with store.open_input_stream(name, compression=None) as f:
            _loaded[path] = pickle.loads(f.read())
    return _loaded[path]


def marks(batches: Iterator[pa.RecordBatch], paths: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, tuple[np.ndarray, set]]]]:
    """Slices of the batches with their bytes, borders and words, and, by row, the hit words and items found in it."""

    def flush(held: list[tuple]):
        found: list[dict] = [{} for _ in held]
        words: list[tuple] = [()] * len(held)
        for path in paths or (None,):
            auto = load(path) if path else Automaton([])
            for k, (_, data, offs) in enumerate(held):
                *words[k], new = scan(auto, data, offs)
                for r, (marked, items) in new.items():
                    if r in found[k]:
                        found[k][r] = (found[k][r][0] | marked, found[k][r][1] | items)
                    else:
                        found[k][r] = (marked, items)
        return [(part, data, offs, *words[k], found[k]) for k, (part, data, offs) in enumerate(held)]

    held, size = [], 0
    for b in batches:
        for lo, hi, data, offs in tv.text_slices(b.column("text")):
            held.append((b.slice(lo, hi - lo), data, offs))
            size += len(data)
            if len(paths) < 2 or size >= HELD_BYTES:
                yield from flush(held)
                held, size = [], 0
    yield from flush(held)


def _digest(items: set) -> str:
    return hashlib.sha256(",".join(sorted(str(i) for i in items)).encode()).hexdigest()


SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """Per document: words, hit words, items found."""
    paths = automata(benchmark, window, max_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = _digest(set())
        for part, _, _, _, _, row, found in marks(batches, paths):
            n = part.num_rows
            n_hit, n_items, digests = np.zeros(n, np.int64), np.zeros(n, np.int64), [none] * n
            for r, (marked, ids) in found.items():
                ids = ids - {None}
                n_hit[r], n_items[r], digests[r] = marked.sum(), len(ids), _digest(ids)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, (tv.by_row(row, n), n_hit, n_items, digests, n_hit > 0))], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def cut(raw: bytes, starts: np.ndarray, ends: np.ndarray, marked: np.ndarray) -> bytes:
    """The text without its marked words; what lies between two marked words goes with them."""
    out, at = [], 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    for a, z in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        out.append(raw[at : int(starts[a])])
        at = int(ends[z - 1])
    return b"".join([*out, raw[at:]])


def remove_spans(docs: DataFrame, benchmark: DataFrame, max_coverage: float = MAX_COVERAGE, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """All rows with hit spans cut from the text; a row hit beyond ``max_coverage`` of its words goes.

    ``n_chars``, if there, is set to the new length of a changed text.
    """
    paths = automata(benchmark, window, max_words)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs, starts, ends, row, found in marks(batches, paths):
            if not found:
                yield part
                continue
            n = part.num_rows
            keep = np.ones(n, bool)
            texts, begin = part.column("text").to_pylist(), np.searchsorted(row, np.arange(n + 1))
            sizes = part.column("n_chars").to_pylist() if "n_chars" in names else []
            for r, (marked, _) in found.items():
                if marked.sum() > max_coverage * len(marked):
                    keep[r] = False
                    continue
                s = slice(int(begin[r]), int(begin[r + 1]))
                texts[r] = cut(data[offs[r] : offs[r + 1]].tobytes(), starts[s] - offs[r], ends[s] - offs[r], marked).decode()
                if sizes:
                    sizes[r] = len(texts[r])
            cols = list(part.columns)
            cols[names.index("text")] = pa.array(texts, part.column("text").type)
            if sizes:
                cols[names.index("n_chars")] = pa.array(sizes, part.column("n_chars").type)
            yield pa.RecordBatch.from_arrays(cols, names).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
