"""The pipeline on planted cases, and against plain versions of its stages."""

import random

import pytest

import corpus_pipeline
from opslake.llm import queries, simhash

pytest.importorskip("public_tokenizers")

WORDS = "river stone walks under green light and slow winter birds carry old songs over quiet water".split()


def prose(rng, n=60):
    return ". ".join(" ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(10)) for _ in range(n // 10)) + "."


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    item = "Which bird sings before the first light of a winter day? The robin sings before the light."
    docs = {i: prose(rng) for i in range(60)}
    docs |= {100 + i: "BUY!! $$$ NOW!! ### " * 20 for i in range(1, 30)}
    docs |= {200: docs[3], 201: docs[3]}  # exact copies: 201 stays
    long = prose(rng, 2000)
    docs |= {210: long, 211: long + " tail"}  # near copies: 210 stays
    docs |= {220: prose(rng) + " " + item + " " + prose(rng)}  # a leaked item
    rows = [(i, t, "en", "s", len(t)) for i, t in docs.items()] + [(300, None, "en", "s", 0)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(1, 30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs


def test_stages_take_effect_and_keep_clean_documents(spark, corpus):
    path, docs = corpus
    ids = {r.doc_id for r in corpus_pipeline.run(spark, path).collect()}
    assert ids - {300} == (set(range(60)) - {3}) | {201, 210}


def test_every_stage_works_on_what_was_kept(spark, corpus):
    path, texts = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        docs = stage(spark, docs, path)
        assert docs.count() <= before
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    kept = {r.doc_id: r for r in docs.collect()}
    import hashlib

    for i, r in kept.items():
        assert r.decoded_sha256 == hashlib.sha256(texts.get(i, "").encode()).hexdigest() and r.n_tokens == len(r.ids)
    fps = [simhash.fingerprint(texts.get(i, "").encode()) for i in kept]
    assert all((a ^ b).bit_count() > 3 for n, a in enumerate(fps) for b in fps[:n])


def test_queries_are_registered():
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(queries.SQL) <= set(names)


ODD = "doc_id long, text string, lang string, source string, n_chars long, fp long, text_hash string, digest string, gone_id string, leaks string, component_id string"


def tables(spark, path, rows, items, labels):
    spark.createDataFrame([(i, t, "en", None, None, 1, "x", "x", "x", "x", "x") for i, t in rows], ODD).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_empty_tables(spark, tmp_path):
    path = tables(spark, tmp_path, [], [], [])
    got = corpus_pipeline.run(spark, path)
    assert got.count() == 0 and {"doc_id", "n_tokens", "ids", "decoded_sha256"} <= set(got.columns)


def test_null_ids_repeated_rows_long_texts_and_clashing_names(spark, tmp_path):
    rng = random.Random(5)
    item = "Which bird sings before the first light of a winter day? The robin sings before the light."
    long = prose(rng, 60_000)
    rows = [(i, prose(rng)) for i in range(30)] + [(100 + i, "BUY!! $$$ NOW!! ### " * 20) for i in range(15)]
    rows += [(None, rows[4][1]), (None, None), (None, None), (50, ""), (51, " \n\t "), (7, rows[7][1]), (60, long), (61, long + " tail"), (62, long + " " + item), (None, "a text of its own that nobody else has written down")]
    labels = [(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(15)] + [(None, 1, 0), (3, None, None), (999, 0, 1)]
    path = tables(spark, tmp_path, rows, [(1, item), (None, item), (2, None), (1 << 40, "")], labels)
    got = [(r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, path).collect()]
    ids = [i for i, _ in got]
    assert set(range(30)) <= set(ids) and ids.count(7) == 1 and ids.count(4) == 1
    assert not set(ids) & set(range(100, 115)) and 60 in ids and not {61, 62} & set(ids)
