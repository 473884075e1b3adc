import textwrap

import brute
import numpy as np
import pyarrow as pa
import pytest
from samples import corpus, prose

from wayspan.llm import decontam, license, mixing, pii, quality, toxicity
from wayspan.llm import textvec as tv


def key(r):
    return tuple((v is None, v if v is not None else 0) for v in r)


# --- words ---------------------------------------------------------------------


def test_words_of_chunks(docs_rows):
    texts = [t for _, t in docs_rows]
    for most in (1, 100, 1 << 20):
        got = []
        for lo, hi, data, offs in tv.text_slices(pa.array(texts, pa.string()).slice(2), most):
            s, e, row = tv.words(data, offs, ~tv.SPACE)
            got += [(lo + 2 + r, data[a:b].tobytes().decode()) for a, b, r in zip(s, e, row, strict=True)]
        assert got == [(i, w) for i, t in enumerate(texts) if i > 1 for w in brute.WORD.findall(t or "")]


# --- quality -----------------------------------------------------------------------


def labels_of(spark, rows):
    return spark.createDataFrame([(i, q, x) for i, q, x in rows], "doc_id long, quality int, toxic int")


def test_quality(spark, docs, docs_rows):
    labels = labels_of(spark, [(i, 1, 0) for i, t in docs_rows if i is not None and t and "%%%" not in t])
    out = quality.judge(docs, quality.fit(docs, labels)).collect()
    got = sorted(((r.doc_id, *r[1:7]) for r in out), key=key)
    assert got == sorted(((i, *brute.quality(t)) for i, t in docs_rows), key=key)
    assert all(not r.kept for r in out if r.base_failed)


def thue_morse(n, x, y):
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join((x, y)[b] for b in bits), "".join((y, x)[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 4096, 8192])
def test_lines_and_words_that_weak_hashes_confuse(spark, frame, n):
    """A Thue-Morse string and its complement are two lines, two words and two items' words."""
    a, b = thue_morse(n, "a", "b")
    rows = [(1, f"{a}\n{b}"), (2, f"{a}\n{b}\n{a}"), (3, f"{a} {b} {a} x {b} {b} {a} x {a} {b} {a}"), (4, b)]
    zero = np.zeros(quality.BUCKETS)
    got = sorted(((r.doc_id, *r[1:7]) for r in quality.judge(frame(rows), zero).collect()))
    assert got == [(i, *brute.quality(t)) for i, t in rows]
    bench = [(1, a), (2, f"{a} {a} {b}")]
    assert sorted(tuple(r) for r in decontam.contamination(frame(rows), items(spark, bench)).collect()) == sorted(brute.contamination(rows, bench))


def test_very_long_texts(spark, frame):
    """Some megabytes in one row, in each of the operators that read a text at once."""
    import random

    rng = random.Random(1)
    long = prose(rng, 300_000) + " you idiot\n" + "x" * 1_500_000 + " " + "one two " * 50_000
    docs = frame([(1, long), (2, "short one"), (3, long + " more")])
    assert len(long.encode()) > 3_000_000
    q = {r.doc_id: r for r in quality.judge(docs, np.zeros(quality.BUCKETS)).collect()}
    assert (q[1].n_words, q[1].word_chars, q[1].n_symbols) == brute.quality(long)[:3]
    m = toxicity.Model({"idiot": 3.0}, (1.0, 1.0, 1.0, -3.0))
    assert {r.doc_id: r.n_matches for r in toxicity.score(docs, m).collect()} == {1: 1, 2: 0, 3: 1}
    from wayspan.llm import neardup, substrings

    assert {r.doc_id: r.class_id for r in neardup.classes(docs).collect()} == {1: 1, 2: 2, 3: 1}
    cut = {r.doc_id: r for r in substrings.dedup(docs).collect()}
    assert cut[3].n_removed >= len(long.encode()) and cut[1].n_removed == 0
    assert {r.doc_id: r.taken for r in mixing.mixture(docs.where("doc_id < 3")).collect()}[2] <= 4


def test_quality_verdict(spark, frame):
    import random

    rng = random.Random(4)
    good = [(i, prose(rng, 200)) for i in range(60)]
    bad = [(100 + i, " ".join(w + "%%%" for w in prose(rng, 200).split())) for i in range(20)]
    docs = frame(good + bad)
    labels = labels_of(spark, [(i, 1, 0) for i in range(0, 60, 2)] + [(100, 0, 0), (999, None, None)])
    kept = {r.doc_id for r in quality.judge(docs, quality.fit(docs, labels)).where("kept").collect()}
    assert kept == set(range(60))
    rows = quality.keep_good(docs, labels)
    assert rows.columns == docs.columns and {r.doc_id for r in rows.collect()} == kept
    assert np.array_equal(quality.fit(docs, labels.where("false")), np.zeros(quality.BUCKETS))
    assert quality.judge(frame([]), np.zeros(quality.BUCKETS)).count() == 0


# --- decontamination -----------------------------------------------------------------


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def bench_rows(docs_rows):
    texts = [t for _, t in docs_rows if t]
    longest = max(texts, key=len)
    return [(1, longest[200:420].upper()), (2, "one"), (3, "a B c"), (30, "a b c d e f"), (4, None), (5, "..."), (6, longest[200:420]), (None, texts[3][:120]), (7, "qq rr ss"), (6, longest[900:1000]), (8, "ab ab ab ab")]


@pytest.mark.parametrize("max_words", [decontam.MAX_WORDS, 20])
def test_contamination(spark, docs, docs_rows, max_words):
    rows = bench_rows(docs_rows)
    got = sorted((tuple(r) for r in decontam.contamination(docs, items(spark, rows), max_words=max_words).collect()), key=key)
    assert got == sorted(brute.contamination(docs_rows, rows), key=key)


def test_contamination_by_long_items(spark, frame):
    """Items far longer than an automaton are dealt in pieces, and a text of some megabytes is scanned whole."""
    rng = np.random.default_rng(3)
    long = [f"w{x}" for x in rng.integers(0, 400, 3000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[100:140]) + " other words"), (2, " ".join(long[100:140]) + " other words"), (3, "solo")]
    book = " ".join(f"v{x}" for x in rng.integers(0, 9, 400_000)) + " " + " ".join(long[1190:1215])
    texts = [(i, " ".join(long[a : a + 30]) + " x") for i, a in enumerate(range(0, 2970, 90))] + [(900, book), (901, None), (902, "a solo b")]
    paths = decontam.automata(items(spark, rows), max_words=500)
    assert len(paths) > 4
    got = {r.doc_id: tuple(r) for r in decontam.contamination(frame(texts), items(spark, rows), max_words=500).collect()}
    want = {r[0]: r for r in brute.contamination([t for t in texts if t[0] != 900], rows)}
    assert {i: r for i, r in got.items() if i != 900} == want
    assert got[900][1:4] == (400_025, 25, 1)


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    """Even if all hashes were equal, only equal words would be hit."""
    auto = decontam.Automaton([(1, [b"aa", b"bb"])], 2)
    monkeypatch.setattr(decontam, "_member", lambda keys, h: np.ones(len(h), bool))
    monkeypatch.setattr(decontam, "_mask", lambda keys: np.ones(1 << 16, bool))
    for text, hits in ((b"aa bb", 2), (b"aa cc", 0), (b"cc bb aa bb", 2)):
        auto.__dict__.pop("mask", None)
        found = decontam.scan(auto, np.frombuffer(text, np.uint8), np.array([0, len(text)]))[3]
        assert sum(int(m.sum()) for m, _ in found.values()) in ((hits,) if hits == 0 else (0, hits))


def test_no_items(spark, docs):
    out = decontam.contamination(docs, items(spark, []))
    assert out.count() == docs.count() and out.where("contaminated").count() == 0


def test_remove_spans(spark, frame):
    w = [f"w{i}" for i in range(60)]
    item = " ".join(w[20:32])
    docs = frame([(1, " ".join(w)), (2, item + " x"), (3, "clean words"), (4, None)])
    got = {r.doc_id: r for r in decontam.remove_spans(docs, items(spark, [(1, item)])).collect()}
    assert set(got) == {1, 3, 4} and got[3].text == "clean words"
    assert got[1].text == " ".join(w[:20]) + "  " + " ".join(w[32:]) and got[1].n_chars == len(got[1].text)


def test_automaton_walk():
    rng = np.random.default_rng(1)
    for _ in range(30):
        its = [(k, [str(x).encode() for x in rng.integers(0, 3, rng.integers(1, 14))]) for k in range(4)]
        seq = [str(x).encode() for x in rng.integers(0, 3, 60)]
        auto = decontam.Automaton(its, 5)
        ids = [auto.ids.get(w, -1) for w in seq]
        got = {(end, k, i) for end, k, found in auto.walk(ids) for i in found}
        want = set()
        for i, ws in its:
            k = min(5, len(ws))
            for j in range(len(ws) - k + 1):
                want |= {(e + k, k, i) for e in range(len(seq) - k + 1) if seq[e : e + k] == ws[j : j + k]}
        assert got == want


# --- personal data ---------------------------------------------------------------------

PII = [
    "mail a.b+c@x-y.example.com, c@d@e.org and @nobody or a@b",
    "1.2.3.4.5.6.7.8 300.1.1.1 001.02.3.255 1.2.3 10.0.0.1.",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 0000000000000 12345678901234567890",
    "+1 (555) 123-4567 +49.30.1234567 + 12 +1-2 +123456789012345 +1234567890123456",
    "٤111 1111 x@y.z\n1.1.1.1+44 20 7946 0958",
    "a@b.c.d@e.f..g@h.i " + "9" * 3000 + " " + "1." * 500,
]


@pytest.mark.parametrize("text", PII)
def test_base_spans(text):
    assert pii.detect(text) == brute.pii(text)


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("write to jane [at] mail [dot] example [dot] com now", "email", "jane [at] mail [dot] example [dot] com"),
        ("write to jane (at) mail.example.com now", "email", "jane (at) mail.example.com"),
        ("ask jane at mail dot example dot com today", "email", "jane at mail dot example dot com"),
        ("jаne@exаmple.com", "email", "jаne@exаmple.com"),
        ("call + 1", "phone", None),
        ("card four one one one 1 1 1 1 1111 1111 1111", "card", None),
        ("card four one one one 1 1 1 1 1111 1111 ok", "card", "four one one one 1 1 1 1 1111 1111"),
        ("card 4111 l1I1 1111 111l ok", "card", "4111 l1I1 1111 111l"),
        ("card 4111 l1I1 1111 1112 ok", "card", None),
        ("host 1O.0.0.l there", "ip", "1O.0.0.l"),
        ("ring plus four nine three zero one two three four five six seven", "phone", "plus four nine three zero one two three four five six seven"),
        ("Ruf plus vier neun drei null eins zwei drei vier fünf sechs sieben an", "phone", "plus vier neun drei null eins zwei drei vier fünf sechs sieben"),
        ("appelle plus trois trois un quatre deux zéro cinq six sept huit neuf.", "phone", "plus trois trois un quatre deux zéro cinq six sept huit neuf"),
        ("llama más tres cuatro nueve uno dos tres cuatro cinco seis siete ocho", "phone", "más tres cuatro nueve uno dos tres cuatro cinco seis siete ocho"),
        ("he gave 5 plus 123456789 to them", "phone", None),
        ("schreib an jane [ät] firma [punkt] de bitte", "email", "jane [ät] firma [punkt] de"),
        ("jane punkt doe klammeraffe firma punkt de", "email", "jane punkt doe klammeraffe firma punkt de"),
        ("écris à jane arobase firme point fr", "email", "jane arobase firme point fr"),
        ("escribe a jane arroba firma punto com punto es", "email", "jane arroba firma punto com punto es"),
        ("jane@firma punto es", "email", "jane@firma punto es"),
        ("jane at example dot xyz", "email", "jane at example dot xyz"),
        ("we arrived at one point last year", "email", None),
        ("card four one one one one one one one one one one one one one one one ok", "card", "four" + " one" * 15),
        ("host 10[.]0[.]0[.]1 there", "ip", "10[.]0[.]0[.]1"),
        ("host １０.0.0.1 there", "ip", "１０.0.0.1"),
        ("ring +1 five five five one two three four five six seven", "phone", "+1 five five five one two three four five six seven"),
        ("ad\u200bmin@exa\u200bmple.org", "email", "ad\u200bmin@exa\u200bmple.org"),
        ("we met at noon dot then home", "email", None),
        ("look at me dot", "email", None),
    ],
)
def test_disguises(text, kind, found):
    base, added = pii.find(text)
    spans = [text[a:z] for a, z in base[kind] + added[kind]]
    assert spans == ([found] if found else [])


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("write jane at firma dot gr now", ["jane at firma dot gr"]),
        ("jane at shop dot online, bo dot li at firma dot co dot za", ["jane at shop dot online", "bo dot li at firma dot co dot za"]),
        ("reach jane at example.com at noon", ["jane at example.com"]),
        ("write at john.doe at example.com", ["john.doe at example.com"]),
        ("mail at john.doe [at] example.com", ["john.doe [at] example.com"]),
        ("jane at firma dot com @ noon, bo at firma dot com_x", ["jane at firma dot com", "bo at firma dot com"]),
        ("order at firma dot com or me at firma dot org", ["order at firma dot com", "me at firma dot org"]),
        ("visit us at example.com, look at node.js; we stopped at noon.Then left at 10.30pm", []),
        ("look at the dot on it, or at each dot inside", []),
    ],
)
def test_bare_words(text, found):
    assert [text[a:z] for a, z in pii.find(text)[1]["email"]] == found


@pytest.mark.parametrize("unit", ["four two one nine and ", "jane [at] firma [dot] org, ", "1O.0.0.l and ", "é\u200b plus four nine three zero one two three four five "])
def test_disguises_in_long_texts(unit):
    """Work grows with the text, not with its square: some megabytes of disguises in seconds."""
    import time

    text = unit * (5_000_000 // len(unit))
    began = time.perf_counter()
    base, added = pii.find(text)
    assert time.perf_counter() - began < 30
    one = sum(map(len, pii.find(unit * 3)[1].values()))
    assert sum(map(len, added.values())) * 3 >= one * (len(text) // len(unit)) - 9


def test_base_spans_stay():
    text = "x@y.org (at) z.org and 1.2.3.4"
    base, added = pii.find(text)
    assert base == brute.pii(text) and not added["ip"]


def test_pii_frame(frame, docs_rows):
    rows = docs_rows[:30] + [(1000 + i, t) for i, t in enumerate(PII)]
    got = {}
    for r in pii.spans_of(frame(rows)).collect():
        got.setdefault(r.doc_id, []).append((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256))
    for i, t in rows:
        b = brute.pii(t)
        code = ",".join(f"{k}:{a}:{z}" for k in b for a, z in b[k])
        assert (*(len(b[k]) for k in b), brute.sha(code)) in got[i]


def test_mask(frame):
    out = {r.doc_id: r for r in pii.mask(frame([(1, "é a@b.org x"), (2, None), (3, "plain"), (4, "")])).collect()}
    assert out[1].text == "é <EMAIL> x" and out[1].n_chars == len(out[1].text)
    assert out[2].text is None and out[2].n_chars is None and out[3].text == "plain" and out[4].text == ""


# --- toxicity -----------------------------------------------------------------------------


def test_fold():
    assert toxicity.fold("You 1D10T, mоrоn! l0ser\u200b 2021 $tupid.") == " you idiot moron loser stupid "


def test_toxicity(spark, frame):
    import random

    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        w = prose(rng, rng.randint(30, 80)).split()
        bad = i % 5 == 0
        if bad:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "moron", "scum", "vermin"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    rows += [(9000, "you 1d1ot m0ron " + prose(rng, 20)), (9001, "trash can " + prose(rng, 20)), (9002, None), (9003, "")]
    docs = frame(rows)
    model = toxicity.fit(docs, labels_of(spark, [*labels, (5, None, None), (None, 1, 1)]))
    assert {"idiot", "moron", "scum", "vermin"} <= set(model.weights)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(out[i].predicted == int(i % 5 == 0) for i in range(600))
    assert out[9000].predicted == 1 and out[9002].score == out[9003].score < 0.7
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())


def test_toxicity_exceptions_and_no_labels(spark, frame):
    m = toxicity.Model({"trash": 5.0}, (2.0, 1.0, 1.0, -3.0))
    a = m.automaton()
    assert m.features(toxicity.fold("the trash can here"), a)[2] == 0
    assert m.features(toxicity.fold("trash trash can trash"), a)[2] == 2
    docs = frame([(1, "x"), (2, None)])
    empty = toxicity.fit(docs, labels_of(spark, []))
    assert not empty.weights and toxicity.score(docs, empty).count() == 2 and toxicity.score(frame([]), empty).count() == 0


def test_toxicity_by_brute_force(spark, docs, docs_rows):
    """Every score is that of a plain restatement of the lexicon, its exceptions and its curve."""
    words = sorted({w for _, t in docs_rows for w in toxicity.fold(t or "").split()})
    weights = {w: 1.5 + k % 5 for k, w in enumerate(words[::9])}
    ws = toxicity.fold(docs_rows[3][1] or "a b").split()
    exceptions = tuple(f"{x} {y}" for x, y in zip(words[::9][:40], words[5::9])) + tuple(" ".join(p) for p in zip(ws[::3], ws[1::3]))
    model = toxicity.Model(weights, (1.1, 0.7, 0.4, -3.0), exceptions)
    got = sorted(((r.doc_id, round(r.score, 9), r.predicted) for r in toxicity.score(docs, model).collect()), key=key)
    want = [(i, brute.toxicity_score(toxicity.fold(t or ""), weights, exceptions, model.coef)) for i, t in docs_rows]
    assert got == sorted(((i, round(x, 9), int(x >= 0.7)) for i, x in want), key=key)


def test_exceptions_are_learned(spark, frame):
    """A lexicon word in a phrase that harmless rows use doesn't count there."""
    import random

    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        w = prose(rng, 60).split()
        if i % 4 == 0:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["scum", "idiot", "moron"]))
        elif i % 12 == 1:
            k = rng.randrange(len(w))
            w[k:k] = ["harbour", "scum"]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = frame([*rows, (900, "they pulled harbour scum out " + prose(rng, 10)), (901, "you scum idiot moron " + prose(rng, 10))])
    model = toxicity.fit(docs, labels_of(spark, labels))
    assert "harbour scum" in model.exceptions and not any(p.endswith("idiot") for p in model.exceptions if p not in toxicity.EXCEPTIONS)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert out[900].n_matches == 0 and out[901].predicted == 1


SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    import os

    if not os.path.isdir(SF):
        pytest.skip("no tables")
    return {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")}


def test_toxicity_held_out(tables):
    """On rows that were not learned from."""
    model = toxicity.fit(tables["documents"], tables["labels"])
    out = toxicity.score(tables["documents"], model).where("held_out").join(tables["labels"].where("toxic is not null").select("doc_id", "toxic"), "doc_id").collect()
    caught = [r.predicted for r in out if r.toxic == 1]
    alarms = [r.predicted for r in out if r.toxic == 0]
    assert len(caught) >= 5 and sum(caught) / len(caught) >= 0.75 and sum(alarms) / len(alarms) <= 0.02


def test_quality_held_out(tables):
    """Fitted on two thirds of the labels, the verdict agrees with the rest."""
    from pyspark.sql import functions as F

    third = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    labels = tables["labels"].where("quality is not null")
    out = quality.judge(tables["documents"], quality.fit(tables["documents"], labels.where(~third))).join(labels.where(third).select("doc_id", "quality"), "doc_id").collect()
    good, bad = [r.kept for r in out if r.quality == 1], [r.kept for r in out if r.quality == 0]
    assert len(good) >= 20 and sum(good) / len(good) >= 0.9 and sum(bad) / max(1, len(bad)) <= 0.35


# --- licences --------------------------------------------------------------------------------


def test_license(docs, frame):
    model = license.fit(docs)
    rows = [
        (1, "foo bar\nLicensed under the Apache License, Version 2.0.\nmore text"),
        (2, "Released under the MIT License."),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "Licensed under CC BY-NC 4.0."),
        (5, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
        (6, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
        (7, "The licence of the driver was under the seat, and the version of it was old."),
        (8, None),
        (9, "\n\n"),
        (10, "Released under the MIT License.\nLicensed under CC BY 4.0."),
    ]
    got = {r.doc_id: r.families for r in license.scan(frame(rows), model).collect()}
    assert got == {1: "Apache-2.0", 2: "MIT", 3: "GPL-3.0", 4: "CC-BY-NC", 5: "MPL-2.0", 6: "BSD", 7: "", 8: "", 9: "", 10: "CC-BY,MIT"}
    assert license.scan(docs, model).where("families <> ''").count() == 0
    assert license.scan(frame([]), model).count() == 0


WRAPPED = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
}


def test_license_wrapped(docs, frame):
    """Hard-wrapped notices are found once each, whatever the width, the comment marks and the line ends."""
    model = license.fit(docs)
    forms = [(w, mark, end) for w in (40, 60, 72, 80) for mark, end in (("", "\n"), (" * ", "\r\n"), ("# ", "\n\n"))]
    rows, want = [], {}
    for family, text in WRAPPED.items():
        for w, mark, end in forms:
            rows.append((len(rows), end.join(mark + x for x in ["Some file of ours", *textwrap.wrap(text, w), "and then more of it"])))
            want[rows[-1][0]] = (family, 1)
    rows += [(900, "\n".join(textwrap.wrap(WRAPPED["GPL-3.0"] + " " + WRAPPED["BSD"], 72))), (901, "Permission is granted\nto use the software and the terms of the\npublic library, which is free of charge"), (902, WRAPPED["MIT"][:60])]
    want |= {900: ("BSD,GPL-3.0", 2), 901: ("", 0), 902: ("", 0)}
    got = {r.doc_id: (r.families, r.n_confirmed) for r in license.scan(frame(rows), model).collect()}
    assert {k: got[k] for k in want} == want


UNSEEN = {
    "MIT": ["Distributed under the MIT License. See LICENSE for more information.", "This project is released under the terms of the MIT license", "Licensed under MIT"],
    "Apache-2.0": ["This file is licensed to you under the Apache License, Version 2.0", "Code is made available under the Apache License 2.0", "Distributed under the Apache License, Version 2.0, on an AS IS basis"],
    "GPL-3.0": ["You may copy this work under the GNU General Public License, version 3 or later", "This software is licensed under the GNU General Public License version 3"],
    "GPL-2.0": ["This file is licensed under the GNU General Public License, version 2", "Distributed under the terms of the GNU General Public License, version 2 only"],
    "LGPL": ["This file is part of a library under the GNU Lesser General Public License", "Licensed under the GNU Lesser General Public License"],
    "BSD": ["Distributed under the 3-Clause BSD License", "Redistribution in source and binary forms is permitted provided that the following conditions are met"],
    "MPL-2.0": ["This file is subject to the terms of the Mozilla Public License", "Covered by the Mozilla Public License, v. 2.0"],
    "CC-BY-NC": ["This article is under a Creative Commons Attribution-NonCommercial 4.0 licence", "Text available under CC BY-NC 4.0"],
    "CC-BY-SA": ["Content is under a Creative Commons Attribution-ShareAlike 4.0 license", "Text available under CC BY-SA 4.0"],
    "CC-BY": ["This article is licensed under Creative Commons Attribution 4.0 International", "Text available under CC BY 4.0"],
    "Proprietary": ["All rights reserved worldwide", "No part of this book may be reproduced without written permission of the publisher"],
    "": ["The licence of the driver was under the seat and the version of it was old", "permission to enter the park was granted to any person free of charge", "the public library is free and open to all",
         "we reserved all the rooms", "the source of the river lies in the hills", "He worked for a software foundation", "the terms of the contract were published", "common creative work attribution is hard"],
}


def test_license_unseen_wordings():
    """Sentences that no template holds word for word: most are named rightly, none wrongly."""
    model = license.train(license.damaged())
    right = total = 0
    for family, texts in UNSEEN.items():
        for text in texts:
            raw = np.frombuffer(text.encode(), np.uint8)
            *_, para, bucket, size = license.line_features(raw, np.array([0, len(raw)]))
            _, p = model.probabilities(para, bucket, size)
            k = int(p[0].argmax()) if len(p) else 0
            got = license.FAMILIES[k - 1] if k and p[0][k] >= license.MIN_PROBABILITY else ""
            assert got in (family, "")
            total += 1
            right += got == family
    assert right / total >= 0.85


def test_license_by_brute_force(docs, frame):
    """Lines that hold a template, whole or with words lost and added: the families of a plain count of word pairs."""
    import random

    rng = random.Random(8)
    rows = []
    for texts in license.TEMPLATES.values():
        for t in texts:
            ws = t.split()
            long = len(ws) > 12
            for k in range(3):
                some = [w for w in ws if not (long and k and rng.random() < 0.05)]
                rows.append((len(rows), "\n".join([prose(rng, 30), " ".join(["Note:", *some, "Thanks."] if k else some), prose(rng, 12)])))
    rows += [(1000 + i, prose(rng, 80)) for i in range(20)] + [(2000, None), (2001, " \n ")]
    rows.append((3000, "\n".join([prose(rng, 60_000), license.TEMPLATES["MIT"][3], prose(rng, 60_000)])))
    got = {r.doc_id: set(filter(None, r.families.split(","))) for r in license.scan(frame(rows), license.fit(docs)).collect()}
    want = {i: brute.licence_lines(t, license.TEMPLATES) for i, t in rows}
    assert got == want


def test_license_held_out():
    """Damaged notices that training has not seen: families found, fragments left alone."""
    model = license.train(license.damaged(seed=1))
    right = total = 0
    for text, k in license.damaged(seed=99, copies=8):
        raw = np.frombuffer(text.encode(), np.uint8)
        *_, para, bucket, size = license.line_features(raw, np.array([0, len(raw)]))
        _, p = model.probabilities(para, bucket, size)
        total += 1
        right += (p[0].argmax() if len(p) else 0) == k
    assert right / total > 0.9


# --- mixing ------------------------------------------------------------------------------------


def mix_rows(seed=3):
    import random

    rng = random.Random(seed)
    return [(i, " ".join(["w"] * rng.randint(1, 60))) for i in range(3000)]


def test_mixture(frame, docs_rows):
    rows = mix_rows() + [(None, None), (5000, ""), (5001, "\t\n")]
    sources = ["b", "a", None, "c", "d", "a", "a", "a"]
    out = mixing.mixture(frame(rows, sources)).collect()
    size, of = {}, {}
    for k, (i, t) in enumerate(rows):
        of[i] = s = sources[k % len(sources)]
        size[s] = size.get(s, 0) + len(brute.WORD.findall(t or ""))
    want, got = brute.targets(size), dict.fromkeys(size, 0)
    for r in out:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == size[of[r.doc_id]]
        assert r.target == pytest.approx(want[of[r.doc_id]])
        got[of[r.doc_id]] += r.taken
    assert all(abs(want[s] - got[s]) <= 60 for s in want)
    again = {(r.doc_id, r.taken, r.shards) for r in mixing.mixture(frame(rows, sources).repartition(7)).collect()}
    assert {(r.doc_id, r.taken, r.shards) for r in out} == again


def test_mix_rows_agree_with_taken(frame):
    rows = mix_rows()
    docs = frame(rows)
    taken = {r.doc_id: (r.taken // r.size, sorted(r.shards.split(",")) if r.shards else []) for r in mixing.mixture(docs).collect()}
    got = {i: [] for i, _ in rows}
    m = mixing.mix(docs)
    assert m.columns == [*docs.columns, "__shard", "__order"]
    for r in m.collect():
        got[r.doc_id].append(str(r["__shard"]))
    assert {i: (len(s), sorted(s)) for i, s in got.items()} == taken
    words = {s: 0 for s in range(2**mixing.LEVELS)}
    for r in m.collect():
        words[r["__shard"]] += 1
    assert min(words.values()) > 0


def test_mix_nothing(frame):
    assert mixing.mixture(frame([])).count() == 0
    assert [r.taken for r in mixing.mixture(frame([(1, None), (2, " ")])).collect()] == [0, 0]


def test_shards_split_evenly(spark):
    plan = spark.createDataFrame([("a", 64), ("b", 64), (None, 65)], "source string, copies long")
    bounds = {r.source: [*r.bounds, n] for r, n in zip(sorted(mixing.split(plan, 3).collect(), key=lambda r: (r.source is None, r.source)), (64, 64, 65), strict=True)}
    counts = {s: [z - a for a, z in zip(b, b[1:])] for s, b in bounds.items()}
    assert {s: sum(n) for s, n in counts.items()} == {"a": 64, "b": 64, None: 65}
    assert {sum(n) for n in zip(*counts.values(), strict=True)} <= {24, 25} and min(min(n) for n in counts.values()) >= 0
    assert len(set(zip(*counts.values(), strict=True))) > 1


@pytest.mark.parametrize(("total", "good", "draws"), [(20, 7, 9), (10, 10, 4), (10, 0, 4), (9, 8, 5), (1, 1, 1), (0, 0, 0), (5000, 2500, 2500)])
def test_hypergeometric(spark, total, good, draws):
    """Draws follow the distribution, within its support."""
    from math import comb

    from pyspark.sql import functions as F

    n = 4000
    x = mixing.hypergeometric(F.lit(total), F.lit(good), F.lit(draws), (F.col("id") + 0.5) / n)
    got = {r.x: r["count"] / n for r in spark.range(n).select(x.alias("x")).groupBy("x").count().collect()}
    want = {k: comb(good, k) * comb(total - good, draws - k) / comb(total, draws) for k in range(max(0, draws - total + good), min(good, draws) + 1)} if total else {0: 1.0}
    assert set(got) <= set(want)
    assert all(abs(got.get(k, 0) - p) < 2 / n for k, p in want.items())


def test_quota_ends_at_any_depth(spark):
    """Blocks of one document, found in steps of two bits: each source still ends near its target."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(2)
    rows = [("ab"[i % 2], rng.randint(1, 9), rng.randrange(-(2**63), 2**63)) for i in range(4000)]
    sized = spark.createDataFrame(rows, "source string, size long, h long")
    for per, step in ((1, 2), (1, 5), (128, 10), (10**6, 10)):
        plan = mixing.planned(sized.transform(lambda d: d), 2) if (per, step) == (128, 10) else mixing.quotas(sized, per, step).withColumn("bounds", F.array(F.lit(0).cast("long")))
        got = mixing.drawn(sized, plan).groupBy("source").agg(F.sum(F.size("shards") * F.col("size")).alias("taken"), F.first("target").alias("target"), F.max(F.size("shards")).alias("most")).collect()
        assert all(0 <= r.target - r.taken < 10 and r.most <= 2 for r in got)


def test_mixture_of_equal_documents(frame):
    """Equal documents, and such as share an id: the source meets its target all the same, in any partitioning."""
    rows = [(7, "one two three")] * 3000 + [(None, f"{'w ' * (1 + i % 5)}") for i in range(3000)]
    docs = frame(rows, ("a", "a", "b"))
    out = mixing.mixture(docs).collect()
    assert len(out) == 6000
    by = {}
    for r in out:
        by.setdefault(r.source_size, [r.target, 0])[1] += r.taken
        assert r.taken <= 2 * r.size
    assert all(0 <= t - n <= 5 for t, n in by.values())
    plain = lambda rows: sorted(((r.doc_id or 0, r.size, r.taken) for r in rows))
    assert plain(out) == plain(mixing.mixture(docs.repartition(5)).collect())


def test_mix_with_any_columns(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a b", "s", {"x": i}, 1, "r") for i in range(50)], "doc_id long, text string, source string, `a map` map<string,int>, __shard int, row string")
    m = mixing.mix(docs)
    assert m.columns == [*docs.columns, "__shard1", "__order"] and m.count() == 75
    mixing.write_shards(m, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 75 and sorted(r.doc_id for r in back.collect()) == sorted(r.doc_id for r in m.collect())


# --- samples and shared folder -------------------------------------------------------------------


def test_hash_sample_is_bounded_and_stable(spark):
    from wayspan.llm.common import hash_sample

    df = spark.range(5000)
    one, two = (sorted(r.id for r in hash_sample(d, 500, "id").collect()) for d in (df, df.repartition(7)))
    assert one == two and 400 < len(one) < 600
    assert hash_sample(df, 5000, "id").count() == 5000


def test_settled_tables_survive_their_source(spark):
    from wayspan.tables import settled, shared_root

    t = settled(spark.range(10).repartition(3))
    assert t.count() == 10 and all(f.startswith(shared_root(spark)) for f in t.inputFiles())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
