"""Ranked search, conversation trie and vector forest against brute force, and on odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from opslake.llm import ranked, turn_trie, vector_forest

# --- ranked search


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k=20):
    held = [(i, terms_of(t)) for i, t in docs]
    held = [(i, Counter(w), len(w)) for i, w in held if w]
    n_docs, tokens = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 100 - 25 + (25 * n * n_docs) // tokens
            s = 0
            for t in terms_of(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if s > 0:
                scores.append((-s, i is None, i))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(scores[:k])]
    return out


DOCS = "doc_id long, text string, item_id long, row long, hash string, m long, terms string, score long"
ITEMS = "item_id long, text string, doc_id long, row long"


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, 2, "x", 3, "y", 4) for i, t in docs], DOCS).repartition(5)
    return d, spark.createDataFrame([(i, t, 7, 8) for i, t in items], ITEMS)


def corpus(rng, n):
    words = [f"w{k}" for k in range(60)] + ["Über", "naïve", "漢字", "42"]
    docs = [(i, " ".join(rng.choices(words, range(len(words), 0, -1), k=rng.randrange(1, 40)))) for i in range(n)]
    docs += [(n + i, docs[i % 7][1].upper() + " !!") for i in range(50)]  # equal bags of seven documents
    docs += [(None, docs[3][1]), (None, None), (n + 60, ""), (n + 61, None), (n + 62, "... !"), (5, docs[5][1]), (n + 63, "w1 " * 60_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for i in range(25)]
    return docs, items + [(30, "unseen words only"), (31, None), (32, ""), (None, "w1 w2 w2"), (3, items[3][1]), (1 << 40, "W1, w1; w1")]


@pytest.mark.parametrize("k", [1, 20, 500])
def test_search_equals_brute_force(spark, rows, k):
    docs, items = corpus(random.Random(k), 150)
    got = ranked.search(*tables(spark, docs, items), k=k)
    assert rows(got) == sorted(plain_search(docs, items, k), key=repr)


def test_search_in_chunks_and_blocks(spark, rows, monkeypatch):
    docs, items = corpus(random.Random(9), 90)
    want = sorted(plain_search(docs, items), key=repr)
    monkeypatch.setattr(ranked, "CHUNK_BYTES", 200)
    assert len(list(ranked.chunks(spark.createDataFrame([(k, bytearray((t or "").encode())) for k, (_, t) in enumerate(items)], "row long, text binary")))) > 3
    assert rows(ranked.search(*tables(spark, docs, items))) == want
    scorer = ranked.Scorer([(0, Counter([b"a", b"b", b"a"])), (5, Counter([b"b"]))], [b"a", b"b"], np.array([10, 7]))
    one = scorer.scores(np.array([0, 1, 1]), np.array([2, 1, 3]), np.array([75, 80]), np.array([2, 1]), 0)
    gain = lambda tf, m: (10**9 * tf) // (1000 * tf + 12 * m)
    assert one.tolist() == [[20 * gain(2, 75) + 7 * gain(1, 75), 7 * gain(3, 80)], [7 * gain(1, 75), 7 * gain(3, 80)]]
    assert (scorer.scores(np.array([1]), np.array([3]), np.array([80]), np.array([1]), 1) == [[7 * gain(3, 80)]]).all()


def test_search_scores_a_class_once(spark):
    docs = [(i, "same words here") for i in range(4000)] + [(5000 + i, f"other w{i}") for i in range(30)]
    d, items = tables(spark, docs, [(1, "same words"), (2, "other")])
    bag = ranked.bags(ranked.texts(d), [b"other", b"same", b"words"])
    found = ranked.classes(bag, 4030, 12060)
    assert found.select("hash", "m", "terms", "tfs").distinct().count() == 2  # the words after "other" are no item's
    got = ranked.search(d, items).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.item_id, r.rank))] == [*range(20), *range(5000, 5020)]


def test_search_on_empty_tables(spark):
    docs, items = corpus(random.Random(2), 20)
    for d, i in ((docs, []), ([], items), ([], []), ([(1, None)], items)):
        got = ranked.search(*tables(spark, d, i))
        assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


# --- conversation trie

CONVS = "conv_id long, turn long, role string, text string, conv string, depth string, name string, n_convs string"


def plain_trie(turns):
    own = defaultdict(list)
    for c, t, r, x in turns:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [y[2:] for y in sorted(x)] for c, x in own.items()}
    built = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - int(math.copysign(abs(c) % 20, c))
        built[c] = own.get(donor, [])[:h] + x[h:]
    nodes = defaultdict(list)
    for c, x in built.items():
        for d in range(len(x) + 1):
            nodes[tuple(x[:d])].append(c)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    leaves, tokens = Counter(), Counter()
    for p, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            tokens[p[:d]] += (len(members) - 1) * words
    return [
        (
            min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], tokens[p],
            hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(p)))).encode()).hexdigest(),
        )
        for p, m in nodes.items()
    ]


def turns_of(spark, turns, parts=4):
    return spark.createDataFrame([(*t, "x", "x", "x", "x") for t in turns], CONVS).repartition(parts)


def conversations(rng, n, longest):
    say = ["hi", "hello there", "", None, "a  b\tc", "x y z", "naïve 漢字"]
    for c in [*range(n), *range(-45, -3, 3), 1 << 40, (1 << 40) + 7]:
        for t in range(rng.randrange(longest + 1)):
            yield c, rng.choice([t, t, t, t // 2, None]), rng.choice(["user", "user", "bot", None]), rng.choice(say[:3] if t < 4 else say)


@pytest.mark.parametrize("longest", [1, 3, 9])
def test_trie_equals_brute_force(spark, rows, longest):
    turns = list(conversations(random.Random(longest), 130, longest))
    turns += [(None, 1, "user", "hi"), (None, None, None, None), turns[0], turns[0]]
    assert rows(turn_trie.prefix_trie(turns_of(spark, turns))) == sorted(plain_trie(turns), key=repr)


def test_trie_with_one_very_long_conversation_and_a_hot_one(spark, rows, monkeypatch):
    monkeypatch.setattr(turn_trie, "PACK", 7)
    rng = random.Random(4)
    turns = [(20 * k, t, "user", f"line {t}") for k in range(30) for t in range(6)]  # equal conversations
    turns += [(20 * k + 1, t, "user", f"line {t}") for k in range(30) for t in range(2)]
    turns += [(7000, t, rng.choice("ab"), f"long {t % 3}") for t in range(700)] + [(7001, t, "a", "word " * 3000) for t in range(3)]
    assert rows(turn_trie.prefix_trie(turns_of(spark, turns, 9))) == sorted(plain_trie(turns), key=repr)


def test_trie_of_nothing(spark):
    assert turn_trie.prefix_trie(turns_of(spark, [], 1)).count() == 0
    assert turn_trie.prefix_trie(turns_of(spark, [(None, 1, "user", "hi")], 1)).count() == 0
    only = turn_trie.prefix_trie(turns_of(spark, [(21, 1, "user", "hi")], 1)).collect()  # conversation 20 is absent
    assert [(r.conv_id, r.depth, r.n_convs) for r in sorted(only, key=lambda r: r.depth)] == [(n[0], n[1], n[3]) for n in sorted(plain_trie([(21, 1, "user", "hi")]), key=lambda n: n[1])]


# --- vector forest

VECTORS = "vec_id long, embedding array<double>, label int, point string, hash string, size string"


def plain_links(vectors, bar=0.9):
    def cosine(a, b):
        if len(a) != len(b):
            return -1
        scale = lambda v: [x / max(map(abs, v)) for x in v]
        a, b = scale(a), scale(b)
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in vectors]
    near = defaultdict(set)
    for i in range(len(vectors)):
        for j in range(i):
            if good[i] and good[j] and cosine(vectors[i][1], vectors[j][1]) >= bar:
                near[i].add(j), near[j].add(i)
    seen, out = {}, []
    for i in range(len(vectors)):
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                new = near[todo.pop()] - group
                group |= new
                todo += new
            ids = [vectors[k][0] for k in group if vectors[k][0] is not None]
            seen |= dict.fromkeys(group, min(ids, default=None))
        out.append((vectors[i][0], len(near[i]), seen[i], vectors[i][0] is not None and vectors[i][0] == seen[i]))
    return out


def vectors_of(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in vectors], VECTORS).repartition(4)


def clustered(rng, n, dim, spread, groups):
    centres = rng.standard_normal((groups, dim))
    return [(i, (centres[rng.integers(groups)] * rng.uniform(0.1, 9) + spread * rng.standard_normal(dim)).tolist()) for i in range(n)]


ODD = [
    (900, None), (901, []), (902, [0.0] * 8), (903, [1.0] * 7 + [None]), (904, [1.0] * 7 + [math.nan]), (905, [1.0] * 7 + [math.inf]),
    (906, [1.0] * 8), (906, [1.0] * 8), (907, [2.0] * 8), (None, [3.0] * 8), (None, [0.0, 1.0]), (908, [1.0] * 9), (909, [1e300] * 8), (910, [1e-300] * 8),
    (911, [-0.0] * 7 + [1.0]), (912, [0.0] * 7 + [1.0]), (None, None),
]


def test_vectors_equal_brute_force_on_odd_rows(spark, rows):
    vectors = clustered(np.random.default_rng(1), 150, 8, 0.3, 20) + ODD
    assert rows(vector_forest.near_duplicates(vectors_of(spark, vectors))) == sorted(plain_links(vectors), key=repr)


def test_deep_forest_finds_all_but_a_few_links_and_none_below_the_bar(spark):
    vectors = clustered(np.random.default_rng(2), 900, 24, 0.5, 150)
    shape = vector_forest.Shape(leaf_points=60, sample_bytes=1 << 17, block=64)
    want = {i: n for i, n, _, _ in plain_links(vectors)}
    got = {r.vec_id: r.n_links for r in vector_forest.near_duplicates(vectors_of(spark, vectors), shape).collect()}
    assert all(got[i] <= want[i] for i in want) and sum(want.values()) > 500
    assert sum(got.values()) >= 0.95 * sum(want.values())


def test_leaf_that_nothing_cuts_is_searched_in_blocks(spark, rows):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(16)
    vectors = [(i, (centre + 0.28 * rng.standard_normal(16)).tolist()) for i in range(260)] + [(500 + i, rng.standard_normal(16).tolist()) for i in range(40)]
    vectors += [(600 + i, vectors[0][1]) for i in range(50)]
    shape = vector_forest.Shape(leaf_points=20, spill=4.0, block=30)  # all points are within the spill
    assert rows(vector_forest.near_duplicates(vectors_of(spark, vectors), shape)) == sorted(plain_links(vectors), key=repr)


def test_no_vectors(spark):
    assert vector_forest.near_duplicates(vectors_of(spark, [])).count() == 0
    assert vector_forest.near_duplicates(vectors_of(spark, [(1, None)])).collect()[0][:4] == (1, 0, 1, True)


# --- bounds of learning


def test_more_languages_than_are_learnt(spark):
    rows = [(i, f"wort{i} und rede{i} " * 3, f"l{i:03}") for i in range(600)] + [(1000 + i, "the quick fox and the dog", "en") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    from opslake.llm import lang_crf

    import unittest.mock as mock

    with mock.patch.object(lang_crf, "LANGUAGES", 3):
        model = lang_crf.fit(docs)
        assert sorted(model.langs) == ["en", "l000", "l001"]
    got = {r.doc_id: r.lang_pred for r in lang_crf.identify(docs, model).collect()}
    assert len(got) == 604 and got[1000] == "en"


def test_most_frequent_words(spark, rows):
    from opslake.llm import lbl

    rng = random.Random(3)
    counts = [(f"w{i}".encode(), int(rng.paretovariate(0.7))) for i in range(500)] + [(b"tie1", 5), (b"tie2", 5)]
    table = spark.createDataFrame([(bytearray(w), c) for w, c in counts], "word binary, c long")
    for n in (1, 7, 100, 501, 5000):
        want = sorted(counts, key=lambda x: (-x[1], x[0]))[:n]
        assert [(bytes(r.word), r.c) for r in lbl.most_frequent(table, n).collect()] == want
