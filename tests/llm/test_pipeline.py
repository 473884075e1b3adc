import os
import random

import brute
import pytest
from samples import DOC, prose

import corpus_pipeline


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Small tables: clean prose, junk, copies, a leaked passage, personal data."""
    rng = random.Random(7)
    d = tmp_path_factory.mktemp("sf")
    clean = [prose(rng, 150) for _ in range(80)]
    item = prose(rng, 14).replace("\n", " ").replace("\t", " ")
    texts = clean + ["%%% " + " ".join(w + "%%%" for w in c.split()) for c in clean[:15]] + clean[:6] + [c + " extra" for c in clean[6:12]]
    texts[20] = texts[20] + " " + item + " tail of it"
    texts[21] += " mail a@b.org"
    texts += [None, "", "short"]
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t), "c", "s", "w", "k", 1) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOC).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 80, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), texts, item


def test_stages(spark, sf):
    d, texts, item = sf
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        if name != "mixing":
            assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append({r.doc_id: r.text for r in docs.collect()})
    good, single, clean, private, mixed = kept
    assert set(good) == set(range(80)) | set(range(95, 107))
    want = brute.near_classes([(i, t) for i, t in good.items()])
    assert set(single) == set(want.values())
    assert set(clean) == set(single) and brute.contamination([(20, clean[20])], [(1, item)])[0][2] == 0
    assert clean[20].endswith("tail of it") and all(clean[i] == single[i] for i in clean if i != 20)
    assert private[21].endswith("mail <EMAIL>")
    assert set(mixed) <= set(private)


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf[0])
    assert out.count() > 80 and out.columns[-2:] == ["__shard", "__order"]


def test_odd_tables(spark, tmp_path):
    """Empty tables, and columns without an order or with the mixture's names, pass every stage."""
    none = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{none}/benchmark.parquet")
    rng = random.Random(9)
    texts = [prose(rng, 80) for _ in range(12)] + [None, ""]
    rows = [(i, t, "en", "s", 0, {"k": i}, i, "r") for i, t in enumerate(texts)] + [(None, texts[0], "en", None, 0, None, 1, "r"), (3, texts[3], "en", "s", 0, {"k": 9}, 1, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `a map` map<string,int>, __shard int, row string")
    for data, count in ((docs.where("false"), 0), (docs, 13)):
        out = data
        for name, stage in corpus_pipeline.STAGES:
            if name == "mixing":
                assert out.count() == count
            out = stage(spark, out, none)
            assert out.columns[: len(docs.columns)] == docs.columns
        assert out.columns[len(docs.columns) :] == ["__shard1", "__order"]
        assert {r.doc_id for r in out.collect()} <= {r[0] for r in rows}


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {q.split("_")[0] + "_" for q in names} and "pipeline" in names


@pytest.mark.parametrize("name", ["op2_suffix_dedup", "op3_warc_archive", "op4_url_filter", "op9_decontamination"])
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from wayspan.llm.queries import QUERIES
    from wayspan.llm.sql import ORACLES

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    plain = lambda rows: sorted(map(tuple, rows), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert plain(df.select(*cols).collect()) == plain(c.execute(f"select {','.join(cols)} from ({ORACLES[name]})").fetchall())
