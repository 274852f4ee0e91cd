"""The operators on small tables: nulls, ties, repeated rows, empty tables, extra columns, brute force."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opslake.llm import bm25, bpe, cuckoo, hashtree, lang_crf, lbl, line_crf, notices, simhash, warc
from opslake.llm.common import crc32_mod

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, digest string, shard string, __id string, key string"


def docs_of(spark, rows, parts=3):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "x", "x", "x", "x") for i, t in rows], SCHEMA).repartition(parts)


ROWS = [
    (1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, None), (4, ""), (None, "a b c d"), (None, None), (5, "x" * 5000),
    (6, "A B c d"), (7, " \n\t "), (-8, "é ü ß"), (9, "lone"), (None, "only null"), (None, "only null"), (5, "other text"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return docs_of(spark, ROWS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, [])


# --- exact dedup


def test_exact_groups(docs, none, rows):
    groups = {}
    for i, t in ROWS:
        groups.setdefault(t or "", []).append(i)
    want = []
    for i, t in ROWS:
        ids = groups[t or ""]
        want.append((i, max((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    got = cuckoo.exact_groups(docs)
    assert rows(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=repr)
    kept = Counter(r.text_sha256 for r in got.where("kept").collect())
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert got.where("kept and not (doc_id <=> keep_id)").count() == 0
    assert cuckoo.exact_groups(none).count() == 0


def test_exact_keep_one(docs, none, rows):
    kept = cuckoo.keep_one(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id", "text") == sorted(
        [(2, "a b c d"), (4, ""), (5, "x" * 5000), (6, "A B c d"), (7, " \n\t "), (-8, "é ü ß"), (9, "lone"), (None, "only null"), (5, "other text")], key=repr
    )
    assert cuckoo.keep_one(none).count() == 0


def test_index_takes_removals_before_additions(spark, docs):
    index = cuckoo.update_index(None, cuckoo.digests(docs))
    sha = lambda t: bytearray(hashlib.sha256(t.encode()).digest())
    gone = spark.createDataFrame([(sha("a b c d"),), (sha("lone"),), (sha("never seen"),)], "digest binary")
    more = cuckoo.digests(docs_of(spark, [(50, "a b c d"), (51, "new")]))
    after = {bytes(r.digest): (r.keep_id, r.group_size) for r in cuckoo.update_index(index, more, gone).collect()}
    assert after[bytes(sha("a b c d"))] == (50, 1) and after[bytes(sha("new"))] == (51, 1)
    assert bytes(sha("lone")) not in after and after[bytes(sha(""))] == (4, 3)


def test_hot_copies_are_one_row_per_batch(spark):
    hot = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"))
    got = cuckoo.exact_groups(hot)
    assert got.where("text_sha256 = sha2('same', 256)").agg(F.min("keep_id"), F.max("keep_id"), F.min("group_size"), F.sum(F.col("kept").cast("int"))).first()[:] == (29997, 29997, 10000, 1)
    assert got.where("kept").count() == 20_001


# --- SimHash


def test_near_duplicates_equal_brute_force(spark, docs, none, rows):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.randrange(0, 9))) for _ in range(150)]
    extra = [(100 + k, t) for k, t in enumerate(base)]
    table = docs.unionByName(docs_of(spark, extra))
    got = simhash.near_duplicates(table).select("doc_id", "fp", "component_id").collect()
    fps = [(i, simhash.fingerprint((t or "").encode())) for i, t in ROWS + extra]
    component = {}
    for i, fp in fps:
        if fp in component:
            continue
        reach, todo = {fp}, [fp]
        while todo:
            x = todo.pop()
            for _, y in fps:
                if y not in reach and (x ^ y).bit_count() <= 3:
                    reach.add(y)
                    todo.append(y)
        least = min((j for j, y in fps if y in reach and j is not None), default=None)
        component |= dict.fromkeys(reach, least)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    assert sorted(map(repr, got)) == sorted(repr(type(got[0])(doc_id=i, fp=signed(fp), component_id=component[fp])) for i, fp in fps)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_near_keep_one_leaves_one_of_each_group(spark):
    long = " ".join(f"w{i}" for i in range(300))
    table = docs_of(spark, [(1, long), (2, long + " tail"), (3, "quite another text"), (None, long), (None, "null alone here"), (2, "third text of two")])
    kept = simhash.keep_one(table)
    assert sorted(((r.doc_id, r.text[:5]) for r in kept.collect()), key=repr) == sorted([(1, "w0 w1"), (3, "quite"), (None, "null "), (2, "third")], key=repr)
    assert kept.columns == table.columns


def test_dense_shard_in_pairs_of_blocks_equals_brute_force(spark):
    rng = random.Random(8)
    base = rng.getrandbits(64)
    points = {base ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(9))) for _ in range(900)}
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in points], "fp long")
    found = simhash.links(table, shard_points=64, block=100).collect()
    parent = {p: p for p in points}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        parent[root(a)] = root(b)
    got = len({root(p) for p in points})
    parent = {p: p for p in points}
    for a in points:
        for b in points:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    assert got == len({root(p) for p in points})


# --- BPE


def test_bpe_operator(spark, docs, none, tmp_path):
    path = tmp_path / "ranks"
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b" a", b"abc", b"xx", b"xxxx"]
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    pattern = r" ?\p{L}+|\s+(?!\S)|\s+|[^\s\p{L}]+"
    got = bpe.encode(docs, str(path), pattern)
    texts = sorted((r.doc_id, bytes(r.bytes)) for r in bpe.decode(got, str(path)).where("doc_id is not null").collect())
    assert texts == sorted((i, (t or "").encode()) for i, t in ROWS if i is not None)
    trip = bpe.round_trip(docs, str(path), pattern)
    for r in trip.join(got.where("n_tokens > 0").drop("n_tokens", "decoded_sha256"), "doc_id").collect():
        assert len(r.ids_sha256) == 64
    sums = {(r.doc_id, r.n_tokens, hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest(), r.decoded_sha256) for r in got.collect()}
    assert {tuple(r) for r in trip.collect()} == sums and trip.count() == len(ROWS)
    assert bpe.encode(none, str(path), pattern).count() == 0 and bpe.round_trip(none, str(path), pattern).count() == 0


# --- hash tree


def test_shards_follow_the_law(spark, docs, none):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 7).alias("text"))
    got = hashtree.shard_documents(many, 24, rows_per_chunk=100).collect()
    shards = Counter(r.shard for r in got)
    assert set(shards) == set(range(24)) and max(shards.values()) < 1.25 * 20_000 / 24 and min(shards.values()) > 0.75 * 20_000 / 24
    assert all(r.grown_shard in (r.shard, 24) for r in got)
    assert 0.5 < sum(r.grown_shard == 24 for r in got) / (20_000 / 25) < 1.5
    for s in range(24):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(shards[s]))
    odd = hashtree.shard_documents(docs, 24).collect()
    assert len(odd) == len(ROWS)
    by_id = {}
    for r in odd:
        by_id.setdefault(r.doc_id, set()).add((r.shard, r.grown_shard))
    assert all(len(v) == 1 for v in by_id.values())
    assert {(r.doc_id, r.size, r.text_crc32) for r in odd} == {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ROWS}
    assert hashtree.shard_documents(none, 24).count() == 0


def test_shards_run_no_python(docs):
    plan = hashtree.shard_documents(docs, 24)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan


@pytest.mark.parametrize("change", ["shard", "rack"])
def test_weights_move_keys_only_between_changed_subtrees(spark, change):
    def tree(w):
        rack = lambda name, k, weight=2.0: hashtree.Node(name, weight, tuple(hashtree.Node(str(s), w if (s, change) == (0, "shard") else 1.0, shard=s) for s in (k, k + 1)))
        regions = []
        for r in range(2):
            first = w * 2 if (r, change) == (0, "rack") else 2.0
            regions.append(hashtree.Node(f"r{r}", 4.0, (rack("a", 4 * r, first), rack("b", 4 * r + 2))))
        return tuple(regions)

    keys = spark.range(8000)
    moved = keys.select(hashtree.place([F.col("id")], tree(1.0)).alias("a"), hashtree.place([F.col("id")], tree(3.0)).alias("b")).where("a != b").collect()
    assert moved
    for r in moved:
        # Only inside the rack whose shard grew, or from the other rack of the region to the one that grew.
        assert (r.a, r.b) == (1, 0) if change == "shard" else (r.a in (2, 3) and r.b in (0, 1))


# --- WARC


PAGES = "page_id long, url string, html string, key string, file string, sha1 string"


def test_warc_round_trip(spark, rows):
    big, other = "<html>é" + "x" * 1200, "y" * 999
    pages = [
        (1, "http://B.example.com/a?b#c", big), (2, "http://b.example.com/a?b", big), (3, "https://u@a.example.com:80/", big), (4, None, other),
        (5, "no url at all", other), (6, "http://x.org/\n\t", None), (None, "http://n.org", big), (7, "http://x.org/", ""), (8, "http://b.example.com/a?b", "z" * 1000),
        (None, None, "w" * 1500), (None, None, "w" * 1500),
    ]
    df = spark.createDataFrame([(*p, "k", "f", "s") for p in pages], PAGES).repartition(4)
    got = warc.archive_round_trip(df)
    want = []
    for i, _, h in pages:
        body = (h or "").encode()
        same = [j for j, _, g in pages if (g or "") == (h or "") and j is not None]
        top = max(same, default=None) if len(body) >= 1000 else None
        revisit = top is not None and i != top
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    assert rows(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_warc_index_with_many_blocks_and_one_hot_url(spark, tmp_path):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 3 == 0, "http://hot.com/").otherwise(F.concat(F.lit("http://h"), F.col("id") % 50, F.lit(".com/"), "id")).alias("url"),
        F.concat(F.lit("p"), "id").alias("html"),
    )
    folder = f"file://{tmp_path}"
    captures = warc.write_archives(pages, f"{folder}/archives", archive_bytes=20_000)
    shards = warc.write_index(captures, f"{folder}/index", block_lines=16)
    index = warc.CaptureIndex(f"{folder}/index", shards)
    places = {r.key: (r.file, r.offset, r.length) for r in captures.collect()}
    assert len(places) == 3000 and len({p[0] for p in places.values()}) > 3
    keys = list(places)
    random.Random(1).shuffle(keys)
    assert all(list(index.lookup(k)) == [places[k]] for k in keys[:400])
    assert list(index.lookup("aaa) 0")) == [] and list(index.lookup("zzz) 0")) == []
    found = warc.find(pages.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key")), f"{folder}/index", shards)
    read = warc.read_records(found, f"{folder}/archives")
    assert sorted((r.page_id, bytes(r.payload)) for r in read.collect()) == sorted((i, f"p{i}".encode()) for i in range(3000))


def test_capture_key(spark):
    one = lambda url, i: spark.range(1).select(warc.capture_key(F.lit(url).cast("string"), F.lit(i).cast("long"))).first()[0]
    assert one("https://User@WWW.Example.com:8080/A b?q=1#f", 5) == "com,example,www)/A_b?q=1 8000000000000005"
    assert one(None, None) == ") " + "-" * 16 and one("http://a.b", -1) == "b,a) 7FFFFFFFFFFFFFFF"


# --- decontamination


def test_find_leaks(spark, docs, none, rows):
    item = "Which animal barks at night in the yard? The dog of the house barks."
    items = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "", "x"), (None, item, "x"), (4, "one two", "x"), (1, "alpha beta gamma delta epsilon zeta", "x")], "item_id long, text string, leaks string")
    filler = " ".join(f"f{i}" for i in range(200))
    texts = [(20, filler + " " + item.upper().replace(" ", " - ") + " " + filler), (21, filler), (22, "one two"), (23, item[:35]), (None, item), (20, "clean twin"), (24, "alpha beta gamma delta epsilon zeta")]
    table = docs.unionByName(docs_of(spark, texts))
    got = bm25.find_leaks(table, items)
    assert got.count() == len(ROWS) + len(texts)
    hits = got.where("size(leaks) > 0").select("doc_id", F.transform("leaks", lambda x: x.item_id).alias("ids"), F.col("leaks")[0].alias("one"))
    assert sorted(((r.doc_id, r.ids) for r in hits.collect()), key=repr) == sorted([(20, [1]), (22, [4]), (None, [1]), (24, [1])], key=repr)
    assert all(r.one.overlap == r.one.question_overlap == r.one.answer_overlap == 1.0 and r.one.score > 0 for r in hits.collect())
    kept = bm25.decontaminate(table, items)
    assert kept.count() == got.count() - 4 and kept.where("doc_id = 20").first().text == "clean twin" and kept.columns == table.columns
    assert bm25.find_leaks(none, items).count() == 0
    assert bm25.find_leaks(docs, items.limit(0)).where("size(leaks) = 0").count() == len(ROWS)


def test_leaks_in_chunks_are_those_of_one_index(spark, monkeypatch):
    rng = random.Random(2)
    item = lambda: " ".join(f"v{rng.randrange(80)}" for _ in range(12)) + ". " + " ".join(f"v{rng.randrange(80)}" for _ in range(4))
    items = [(i, item()) for i in range(30)]
    table = docs_of(spark, [(i, f"{item()} {rng.choice(items)[1]} {item()}") for i in range(40)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    pick = lambda df: sorted((r.doc_id, sorted((x.item_id, round(x.score, 9)) for x in r.leaks)) for r in df.collect())
    whole = pick(bm25.find_leaks(table, bench))
    monkeypatch.setattr(bm25, "CHUNK_ITEMS", 7)
    assert pick(bm25.find_leaks(table, bench)) == whole and sum(bool(x) for _, x in whole) == 40


def test_leaks_spread_over_a_document_do_not_depend_on_other_items(spark, monkeypatch):
    rng = random.Random(3)
    say = lambda p, n: " ".join(f"{p}{rng.randrange(9000)}" for _ in range(n))
    question, answer, long = say("q", 20), say("a", 20), say("l", 200)
    items = [(0, f"{question}. {answer}."), (1, long), *((k, say("o", 12)) for k in range(2, 12))]
    inserted = " ".join(w + (" " + say("n", 6) if k % 40 == 39 else "") for k, w in enumerate(long.split()))
    texts = [f"{say('f', 50)} {question} {say('f', gap)} {answer} {say('f', 90)}" for gap in (0, 30, 150, 1000)]
    texts += [f"{say('f', at)} {inserted} {say('f', 700)}" for at in (0, 70, 130, 199)] + [f"{question} {say('f', 99)}"]
    table = docs_of(spark, list(enumerate(texts)))
    pick = lambda bench: sorted((r.doc_id, r.n_passages, [(x.item_id, round(x.score, 9), x.overlap) for x in r.leaks]) for r in bm25.find_leaks(table, bench).collect())
    whole = pick(spark.createDataFrame(items, "item_id long, text string"))
    assert [[x[0] for x in leaks] for _, _, leaks in whole] == [[0]] * 4 + [[1]] * 4 + [[]]
    monkeypatch.setattr(bm25, "CHUNK_ITEMS", 1)
    assert pick(spark.createDataFrame(items, "item_id long, text string")) == whole
    alone = pick(spark.createDataFrame(items[:1], "item_id long, text string"))
    assert [[x[0] for x in leaks] for _, _, leaks in alone] == [[0]] * 4 + [[]] * 5


# --- classifiers


def test_quality_operator(spark, docs, none):
    rng = random.Random(1)
    say = lambda words: "\n".join(" ".join(rng.choice(words) for _ in range(10)) for _ in range(3))
    rows = [(i, say(["good", "plain", "words", "here"]) if i % 2 else say(["BAD!!", "$$$", "###"])) for i in range(100)]
    table, labels = docs_of(spark, rows), spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = line_crf.fit(table, labels)
    got = {r.doc_id: r.score for r in line_crf.score(table, model).collect()}
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(100))
    assert sorted(r.doc_id for r in line_crf.keep_good(table, model, 0.5).collect()) == list(range(1, 100, 2))
    odd = line_crf.score(docs, model)
    assert odd.count() == len(ROWS) and odd.where("score is null or score < 0 or score > 1").count() == 0
    assert line_crf.score(none, model).count() == 0
    assert line_crf.score(docs, line_crf.fit(none, labels)).where("score = 0.5").count() == len(ROWS)


def test_language_operator(spark, docs, none):
    rng = random.Random(1)
    words = {"en": ["the", "night", "house", "with"], "fr": ["la", "nuit", "maison", "avec"]}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(30)), k) for i, k in enumerate(["en", "fr"] * 20)]
    table = spark.createDataFrame([*rows, (90, None, "en"), (91, "text", None)], "doc_id long, text string, lang string")
    model = lang_crf.fit(table)
    assert model.langs == ["en", "fr"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang_crf.identify(table, model).collect()}
    assert all(got[i][0] == k for i, _, k in rows) and got[90] == ("und", 0.0)
    odd = lang_crf.identify(docs, model)
    assert odd.count() == len(ROWS) and {r.lang_pred for r in odd.where("doc_id in (3, 4, 7)").collect()} == {"und"}
    assert lang_crf.identify(none, model).count() == 0
    mixed = docs_of(spark, [(1, " ".join(words["en"] * 4 + words["fr"] * 4))])
    labelled = lang_crf.label_words(mixed, model).first().words
    assert [w.lang for w in labelled] == ["en"] * 16 + ["fr"] * 16
    unknown = lang_crf.fit(table.where("false"))
    assert {r.lang_pred for r in lang_crf.identify(docs, unknown).collect()} == {"und"}
    assert lang_crf.label_words(mixed, unknown).first().words == []


def test_notices_operator(spark, docs, none):
    table = docs.unionByName(docs_of(spark, [(30, "MIT License mit license"), (31, "relesed under the mit licence")]))
    got = {r.doc_id: r for r in notices.find_notices(table).where("doc_id >= 30").collect()}
    assert (got[30].n_words, got[30].n_base, got[30].first_word, got[30].last_word, got[30].labels) == (4, 2, 0, 2, "mit")
    assert got[31].n_base == 0 and got[31].labels == "mit" and got[31].spans[0].matched.startswith("relesed")
    assert notices.find_notices(table).count() == len(ROWS) + 2 and notices.find_notices(none).count() == 0


# --- language-model scores


def test_lm_scores_equal_counts_and_are_finite(spark, docs, none, monkeypatch):
    monkeypatch.setattr(lbl, "FREQUENT", 40)
    monkeypatch.setattr(lbl, "CLASSES", 80)
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(rng.expovariate(0.05))}" for _ in range(rng.randrange(60)))) for i in range(80)]
    table = docs.unionByName(docs_of(spark, rows))
    got = lbl.score_documents(table, crc32_mod("doc_id", 5) == 1).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = lambda t: [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] + [b""]
    counts = Counter(w for i, t in ROWS + rows if not held(i) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in ROWS + rows:
        w = tokens(t)
        base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)
        want.append((i, held(i), len(w), sum(counts[x] > 0 for x in w), total, round(base, 6)))
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lbl.score_documents(none, F.lit(False)).count() == 0
    alone = lbl.score_documents(docs_of(spark, [(1, "a b")]), F.lit(True)).first()
    assert alone.n_known == 0 and alone.train_tokens == 0 and math.isfinite(alone.score) and abs(alone.base_score) < 1e-9


def test_lm_knows_the_end_whatever_its_rank(spark, monkeypatch):
    monkeypatch.setattr(lbl, "FREQUENT", 3)
    monkeypatch.setattr(lbl, "CLASSES", 66)
    text = " ".join(f"w{i}" for i in range(8)) + " "
    got = lbl.score_documents(docs_of(spark, [(1, text * 5), (2, text * 7)]), F.lit(False)).collect()
    total, distinct = 8 * 12 + 2, 9
    for r, n in ((r, {1: 5, 2: 7}[r.doc_id]) for r in got):
        base = 8 * n * math.log10(12.5) + math.log10(2.5) - (8 * n + 1) * math.log10(total + 0.5 * (distinct + 1))
        assert r.n_known == r.n_tokens == 8 * n + 1 and abs(r.base_score - base) < 1e-6


def test_common_start_is_chosen_in_parallel_and_bounded_by_tokens(spark, monkeypatch):
    table = docs_of(spark, [(i, "word " * 1000) for i in range(400)], parts=7).select("doc_id", "text")
    assert lbl.warm_start(table, 400, 400_000).count() == 400
    monkeypatch.setattr(lbl, "WARM_TOKENS", 40_000)
    warm = lbl.warm_start(table, 400, 400_000)
    plan = warm._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and plan.index("SinglePartition") < plan.index("Filter")  # the filter runs below the exchange
    assert warm.rdd.getNumPartitions() == 1 and 15 <= warm.count() <= 75


def test_leaks_come_from_the_search(spark, monkeypatch):
    item = "Which river flows past the old mill town where the millers of the valley met every autumn to trade grain and news?" \
        " The silver river flows past the old mill town every spring and carries melting snow from northern hills to the wide sea."
    question, answer = item.split("?")
    far = question + "? " + "filler words between them " * 300 + answer
    docs = docs_of(spark, [(1, "intro words " + item + " more"), (2, far), (3, "nothing of the kind here"), (4, question), (5, far * 40)])
    items = spark.createDataFrame([(1 << 40, item), (7, item)], "item_id long, text string")
    index = next(bm25._chunks(items, "item_id", "text", 0.8))
    texts = [r.text.encode() for r in sorted(docs.collect(), key=lambda r: r.doc_id)]
    assert [[x["item_id"] for x in leaks] for _, leaks in bm25.scan(index, texts)] == [[7, 1 << 40]] * 2 + [[], [], [7, 1 << 40]]
    found = {r.doc_id: [x.item_id for x in r.leaks] for r in bm25.find_leaks(docs, items).collect()}
    assert found == {1: [7, 1 << 40], 2: [7, 1 << 40], 3: [], 4: [], 5: [7, 1 << 40]}
    monkeypatch.setattr(bm25.ItemIndex, "search", lambda *_: iter(()))
    assert [bool(leaks) for _, leaks in bm25.scan(index, texts)] == [False, True, False, False, True]  # by the document as a whole
    monkeypatch.setattr(bm25.ItemIndex, "gather", lambda *_: [])
    assert not any(leaks for _, leaks in bm25.scan(index, texts))
