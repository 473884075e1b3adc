import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from samples import corpus

from wayspan.llm import neardup, substrings
from wayspan.llm import textvec as tv


def key(r):
    return tuple((v is None, v if v is not None else 0) for v in r)


def test_suffix_dedup(docs, docs_rows):
    got = [tuple(r) for r in substrings.dedup(docs).collect()]
    assert sorted(got, key=key) == sorted(brute.repeated_bytes(docs_rows), key=key)


def test_suffix_dedup_large_buckets(docs, docs_rows):
    """Windows of buckets that are too large for a block are dealt one by one: the same result."""
    got = [tuple(r) for r in substrings.dedup(docs, bucket_entries=0).collect()]
    assert sorted(got, key=key) == sorted(brute.repeated_bytes(docs_rows), key=key)


def _large(monkeypatch):
    """How many buckets each run deals by window."""
    seen, settled = [], substrings.settled

    def spy(df):
        out = settled(df)
        if df.columns == ["gram", "large"]:
            seen.append(out.count())
        return out

    monkeypatch.setattr(substrings, "settled", spy)
    return seen


def test_suffix_dedup_bucket_of_many_small_entries(frame, monkeypatch):
    """5,000 entries under one gram that fit into a block are sorted there, not dealt by window."""
    rng = random.Random(2)
    some = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    gram = min((some(18) for _ in range(5_000)), key=lambda g: substrings.PLAIN(np.frombuffer(g.encode(), np.uint8))[0])
    texts = [some(40) + gram + some(40) for _ in range(5_000)]
    texts[4_321] = texts[17][:70] + some(28)
    seen = _large(monkeypatch)
    out = substrings.dedup(frame(list(enumerate(texts))), sample_texts=0)
    assert {r.doc_id: r.n_removed for r in out.where("n_removed > 0").collect()} == {4_321: 70}
    assert seen == [0]


def test_suffix_dedup_bucket_of_long_entries(frame, monkeypatch):
    """400 entries of over 3,000 bytes under one gram exceed a block: their windows are dealt one by one."""
    rng = random.Random(4)
    some = lambda n: "".join(rng.choices("bcdefghijklmnopqrstuvwxyz", k=n))
    texts = [some(60) + "a" * (3_000 + i) + some(60) for i in range(400)]
    seen = _large(monkeypatch)
    out = substrings.dedup(frame(list(enumerate(texts))), sample_texts=0)
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted(brute.repeated_bytes(list(enumerate(texts))), key=key)
    assert seen == [1]


def test_suffix_dedup_of_inner_repeats(frame):
    """A passage that its own document repeats is cut in both places where an earlier document shares part of it."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = " ".join(word() for _ in range(30))
    rows = [(1, word() + passage[:90] + word()), (2, "".join(word() * 4 + passage + word() * 4 for _ in range(3))), (3, (passage[20:90] + "|") * 5)]
    rows += [(4, "ab" * 300), (5, "ba" * 40 + "x" + "ab" * 40)]
    got = sorted(tuple(r) for r in substrings.dedup(frame(rows)).collect())
    assert got == sorted(brute.repeated_bytes(rows))


def test_suffix_dedup_of_nothing(frame):
    assert substrings.dedup(frame([])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_sort_suffixes(seed):
    rng = random.Random(seed)
    raw = bytes(rng.choices(b"ab", k=900)) + b"abcabcabc" * 60 + b"a" * 300
    data = np.frombuffer(raw, np.uint8)
    starts = np.array(sorted(rng.sample(range(len(raw) - 50), 600)))
    order = substrings.sort_suffixes(data, starts)
    assert sorted(order.tolist()) == starts.tolist()
    windows = [raw[i : i + 50] for i in order]
    assert windows == sorted(windows)
    name = substrings.same_strings(data, starts)
    want = {}
    for s, n in zip(starts.tolist(), name.tolist(), strict=True):
        assert want.setdefault(raw[s : s + 50], n) == n
    assert len(set(want.values())) == len(want)


def test_cover_reaches_every_pair():
    p, cover = substrings.PERIOD, substrings.COVER
    assert all((i + substrings.STEP[i, j]) % p in cover and (j + substrings.STEP[i, j]) % p in cover for i in range(p) for j in range(p))


def test_meet_across_batches():
    """The same decisions whatever the batches are cut to."""
    rng = random.Random(3)
    rows = sorted((rng.randint(0, 60), rng.choice((0, 0, 0, 1, 2)), rng.randint(0, 9), i) for i in range(200))
    rows += [(1000 + i, 5, 5, ~i) for i in range(9)]  # settled before, each under a gram of its own

    def run(size):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i : i + size]], pa.int64()) for k in range(4)], ["gram", "doc", "tid", "place"]) for i in range(0, len(rows), size)]
        return sorted(tuple(x) for b in substrings._meet(iter(batches)) for x in zip(*(b.column(c).to_pylist() for c in ("tid", "place", "gram", "fine")), strict=True))

    docs = {}
    for g, doc, _, _ in rows:
        docs.setdefault(g, set()).add(doc)
    want = [(t, p, g, True) for g, _, t, p in rows if len(docs[g]) > 1] + [(t, ~p, g, False) for g, _, t, p in rows if p < 0]
    for size in (1, 2, 3, 7, 50, 300):
        assert run(size) == sorted(want)


@pytest.mark.parametrize("common", [False, True])
def test_entries_cover_every_window(common):
    """Each window is in one entry, and equal windows are under one gram, whichever grams are common."""
    rng = random.Random(4)
    passage = "".join(rng.choices("abc ", k=400))
    texts = [passage[rng.randrange(200) :] + "".join(rng.choices("abc ", k=rng.randrange(80))) + passage[: rng.randrange(300)] for _ in range(20)] + ["x" * 9000, "", "y" * 49, "z" * 50]
    order = substrings.Order(tv.grams(np.frombuffer(passage.encode(), np.uint8), substrings.GRAM)) if common else substrings.PLAIN
    gram_of, seen = {}, set()
    (_, _, data, offs), = tv.text_slices(pa.array(texts))
    raw = data.tobytes()
    for g, r, at, n in zip(*(c.tolist() for c in substrings.entries(data, offs, order)), strict=True):
        assert n <= substrings.MOST_WINDOWS
        for k in range(at, at + n):
            assert k not in seen and k + 50 <= offs[r + 1]
            seen.add(k)
            assert gram_of.setdefault(raw[k : k + 50], g) == g
    assert len(seen) == sum(max(0, len(t) - 49) for t in texts)


def test_common_grams_leave_small_buckets(frame):
    """A run that many texts hold between words of their own gathers none of them under one gram."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=60))
    texts = [word() + " " * 20 + word() for _ in range(400)]
    common = substrings.common_grams(frame(list(enumerate(texts))))
    sizes = []
    for order in (substrings.PLAIN, substrings.Order(common)):
        (_, _, data, offs), = tv.text_slices(pa.array(texts))
        g = substrings.entries(data, offs, order)[0]
        sizes.append(np.unique(g, return_counts=True)[1].max())
    assert sizes[0] > 100 and sizes[1] < substrings.SAMPLE_SHARED


def test_suffix_dedup_of_many_texts_under_one_id(frame):
    """More texts share a doc_id than any tag of a few bits could tell apart; each loses its own span."""
    rng = random.Random(10)
    word = lambda n: "".join(rng.choices("abcdefghij", k=n))
    passage = word(70)
    rows = [(1, passage)] + [(2, word(rng.randrange(60)) + passage + word(rng.randrange(60))) for _ in range(4200)]
    got = sorted(tuple(r) for r in substrings.dedup(frame(rows)).collect())
    assert got == sorted(brute.repeated_bytes(rows))


def thue_morse(n, letters="ab"):
    s = "".join(letters[bin(i).count("1") & 1] for i in range(n))
    return s, s.translate(str.maketrans(letters, letters[::-1]))


@pytest.mark.parametrize("n", [1024, 2048, 8192])
def test_texts_that_weak_hashes_confuse(frame, n):
    """Thue-Morse strings and their complements, as letters and as words."""
    a, b = thue_morse(n)
    x, y = (" ".join({"a": "left", "b": "right"}[c] for c in s) for s in (a, b))
    rows = [(1, a), (2, b), (3, a + " end"), (4, b + " end"), (5, x + " one two three four five"), (6, y + " six seven eight nine ten")]
    got = {r.doc_id: (r.class_id, r.copy_of) for r in neardup.classes(frame(rows)).collect()}
    assert {i: c for i, (c, _) in got.items()} == brute.near_classes(rows)
    assert all(copy == i for i, (_, copy) in got.items())
    assert sorted(tuple(r) for r in substrings.dedup(frame(rows[:4])).collect()) == sorted(brute.repeated_bytes(rows[:4]))


@pytest.mark.parametrize("seed", range(3))
def test_range_hashes(seed):
    """Equal bytes have equal hashes wherever they lie, beyond the tabled powers too."""
    rng = np.random.default_rng(seed)
    data = rng.integers(0, 256, tv.SPAN * 2 + 5000, np.uint8).astype(np.uint8)
    piece = data[100:1100].copy()
    places = np.array([100, tv.STEP - 500, tv.SPAN - 300, tv.SPAN + 2007, 2 * tv.SPAN + 3000])
    for at in places:
        data[at : at + 1000] = piece
    pre = tv.MAIN.prefix(data)
    h = tv.MAIN.ranges(pre, places, places + 1000)
    assert len(set(h.tolist())) == 1
    alone = tv.MAIN.ranges(tv.MAIN.prefix(piece), np.array([0]), np.array([1000]))
    assert alone[0] == h[0]
    p, want = int(tv.P), 0
    for i, v in enumerate(piece.tolist()):
        want = (want + (v + 1) * pow(tv.MAIN.base, i, p)) % p
    assert h[0] == tv.mix(np.array([(want + 1000 * 0xD1342543DE82EF95) % 2**64], np.uint64))[0]


def test_block_links_join_what_all_pairs_join():
    """The classes of a block are those of all similar pairs, though fewer pairs are compared."""
    rng = np.random.default_rng(5)
    base = np.sort(rng.integers(0, 2**48, 60).astype(np.uint64))
    bags = []
    for _ in range(60):
        b = base.copy()
        b[rng.integers(0, 60, rng.integers(0, 14))] = rng.integers(0, 2**48, 1).astype(np.uint64)
        bags.append(np.unique(b))
    block = neardup._Block(0, True)
    block.rows = [(0, i, i, [i], b) for i, b in enumerate(bags)]
    root = list(range(60))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    found = list(block.links())
    for a, b in found:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = [find(i) for i in range(60)]
    root = list(range(60))
    similar = [(i, j) for i in range(60) for j in range(i) if neardup.similarity(bags[i], bags[j]) >= 0.8]
    for i, j in similar:
        root[max(find(i), find(j))] = min(find(i), find(j))
    assert got == [find(i) for i in range(60)] and len(found) < len(similar)


def test_near_classes(docs, docs_rows):
    got = {(r.doc_id, r.class_id) for r in neardup.classes(docs).collect()}
    want = set(brute.near_classes(docs_rows).items())
    assert {x for x in got if x[0] is not None} == want
    assert (None, None) in got


@pytest.mark.parametrize("block", [neardup.BLOCK, 30])
def test_near_classes_large_group(frame, monkeypatch, block):
    """A group of near copies around a text, beyond the small buckets: no link between classes is lost, in one block or several."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(260):
        w = list(words)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(80)] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.class_id for r in neardup.classes(frame(rows)).collect()}
    assert got == brute.near_classes(rows)


def test_keep_one(docs, docs_rows):
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    want = brute.near_classes(docs_rows)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(want.values()))
    assert kept.where("doc_id is null").count() == 2


def test_near_classes_of_a_chain(frame):
    """A text edited in small steps, version by version, the least ids in the middle: one class."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(200)]
    versions = []
    for _ in range(40):
        versions.append(" ".join(words))
        for _ in range(4):
            words[rng.randrange(200)] = f"v{rng.randrange(10**6)}"
    ids = [0] + [140 - i for i in range(39)]
    rows = list(zip(ids, versions, strict=True))
    got = {r.doc_id: r.class_id for r in neardup.classes(frame(rows)).collect()}
    assert got == brute.near_classes(rows)


def test_keep_one_with_any_columns(spark):
    """Columns without an order, and names that the operator might use itself."""
    rows = [(1, "a b c", {"x": 1}, 1, 2), (1, "a b d", {"y": 2}, 1, 2), (2, "a b d", None, 1, 2), (None, "z", None, 1, 2), (3, None, {"k": 0}, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a map` map<string,int>, __first int, row int")
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(1, "a b d"), (3, None), (None, "z")]


def test_near_nothing(frame):
    assert neardup.classes(frame([])).count() == 0
    assert neardup.keep_one(frame([(1, None), (2, "")])).count() == 2


@pytest.mark.parametrize("top", [1, 3, 9])
def test_signatures_are_unbiased(top):
    """Registers agree as often as the weighted Jaccard similarity says."""
    rng = np.random.default_rng(top)
    agree, want = [], []
    for trial in range(60):
        items = rng.integers(1, 2**47, 40, dtype=np.int64).astype(np.uint64)
        wa, wb = rng.integers(0, top + 1, 40), rng.integers(0, top + 1, 40)
        wa[:12] = wb[:12] = rng.integers(1, top + 1, 12)
        sig = []
        for w in (wa, wb):
            on = np.flatnonzero(w)
            sig.append(neardup.bag_minhash(items[on], np.zeros(len(on), np.int64), w[on], 1)[0])
        agree.append((sig[0] == sig[1]).mean())
        want.append(np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum())
    assert abs(np.mean(agree) - np.mean(want)) < 0.02


def test_signature_does_not_depend_on_neighbours():
    texts = [t for _, t in corpus(2) if t]
    together = []
    for lo, hi, data, offs in tv.text_slices(pa.array(texts)):
        s, row = neardup.shingles(data, offs)
        together.append(neardup.bag_minhash(*neardup.weighted(s, row), hi - lo))
    together = np.vstack(together)
    for i in (0, 5, len(texts) - 1):
        (_, _, data, offs), = tv.text_slices(pa.array([texts[i]]))
        s, row = neardup.shingles(data, offs)
        assert np.array_equal(neardup.bag_minhash(*neardup.weighted(s, row), 1)[0], together[i])


def _peak(run):
    """MB of arrays at once, and what ``run`` gives."""
    import tracemalloc

    tracemalloc.start()
    try:
        out = run()
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_entries_of_a_batch_in_bounded_memory():
    """A task's memory does not grow with the bytes of a batch (F1); a passage repeats across the stretches."""
    rng = np.random.default_rng(1)
    shared = "".join(map(chr, rng.integers(97, 123, 400)))
    texts = ["".join(map(chr, rng.integers(97, 123, 500_000))) + shared for _ in range(80)]
    b = pa.RecordBatch.from_pydict({"doc": pa.array(range(80), pa.int64()), "tid": pa.array(range(80), pa.int64()), "text": texts})
    run = substrings._entries(type("Value", (), {"value": substrings.PLAIN}))
    tv.MAIN._tabled()

    def windows():
        n = 0
        for out in run(iter([b])):
            place = out.column("place").to_numpy()
            n += int((np.where(place < 0, ~place, place) & 0x1FFF).sum())
        return n

    peak, n = _peak(windows)
    assert n == sum(len(t) - substrings.LENGTH + 1 for t in texts)
    assert peak < 600


def test_a_bucket_of_one_window_in_bounded_memory():
    """Any number of documents may hold one 50-byte string (F1)."""
    n, text = 120_000, b"a string of fifty bytes, held by many documents ...."[:50]
    docs = np.random.default_rng(2).permutation(n) + 1

    def batches():
        for lo in range(0, n, 10_000):
            doc = pa.array(docs[lo : lo + 10_000], pa.int64())
            same = lambda v, t: pa.array([v] * 10_000, t)
            yield pa.RecordBatch.from_arrays([same(7, pa.int64()), doc, doc, same(3, pa.int32()), same(1, pa.int32()), same(text, pa.binary()), same([], pa.list_(pa.int32()))], ["bucket", "doc", "tid", "at", "n", "bytes", "also"])

    peak, found = _peak(lambda: np.concatenate([b.column("tid").to_numpy() for b in substrings._sort_buckets(batches())]))
    assert sorted(set(found.tolist())) == list(range(2, n + 1)) and len(found) == n - 1
    assert peak < 300
