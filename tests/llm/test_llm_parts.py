"""Pure parts of the operators, against plain versions."""

import base64
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from opslake.llm import bm25, bpe, crf, lang_crf, lbl, line_crf, notices, simhash, warc
from opslake.llm.cuckoo import CuckooIndex


# --- cuckoo index


def test_cuckoo_follows_a_dict_through_inserts_deletes_and_resizes():
    rng, index, plain = random.Random(1), CuckooIndex(2), {}
    for step in range(6000):
        digest = rng.randrange(1500).to_bytes(2, "big") * 16
        if rng.random() < 0.3:
            assert index.remove(digest) == (plain.pop(digest, None) is not None)
        else:
            assert index.put(digest, step) == (digest not in plain)
            plain[digest] = step
        assert index.size == len(plain)
    assert dict(index.items()) == plain
    assert index.mask > 2 and all(index.get(d) == v for d, v in plain.items())


def test_cuckoo_filter_hits_are_verified():
    index = CuckooIndex(1)
    a = b"\0" * 8 + b"\1\0" + b"a" * 22
    b = b"\0" * 8 + b"\1\0" + b"b" * 22  # same fingerprint and buckets
    index.put(a, 1)
    assert index.get(b) is None and not index.remove(b) and index.get(a) == 1


def test_cuckoo_with_equal_fingerprints_grows_no_further_than_needed():
    index = CuckooIndex(1)
    for i in range(8):
        index.put(i.to_bytes(32, "little"), i)
    assert [index.get(i.to_bytes(32, "little")) for i in range(8)] == list(range(8))


# --- byte-level BPE


def plain_bpe(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def odd_ranks():
    """All bytes, then merges in an order in which longer tokens may stand before their parts."""
    rng, tokens = random.Random(3), []
    for n in (2, 3, 2, 4, 3, 5, 2):
        tokens += ["".join(rng.choice("abc") for _ in range(n)).encode() for _ in range(8)]
    ranks = {bytes([b]): b for b in range(256)}
    for t in tokens:
        ranks.setdefault(t, len(ranks))
    return ranks


def test_bpe_equals_the_plain_algorithm():
    ranks, rng = odd_ranks(), random.Random(5)
    for _ in range(3000):
        piece = "".join(rng.choice("aaabbc") for _ in range(rng.randrange(1, 30))).encode()
        assert bpe.merge(piece, ranks) == plain_bpe(piece, ranks), piece


def test_bpe_of_a_public_tokenizer():
    public = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    data = open(public.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
    codec = bpe.Codec(data, public.PATTERN)
    real = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(7)
    parts = [" ", " ", "\n", "\t", "a", "the", " ing", "é", "1", "²", "!", "_", "'s", " ", "　", "Ünn", "😀", "aaaa", "\x1c", "  ", "Ende.", "x,", "<|endoftext|>"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(16)))
        ids = codec.encode(text)
        assert ids == ",".join(map(str, real.encode_ordinary(text))), ascii(text)
        assert codec.decode(ids) == text.encode()
    long = "ab" * 30_000
    assert codec.encode(long) == ",".join(map(str, real.encode_ordinary(long)))


def test_bpe_forgets_but_stays_right(monkeypatch):
    ranks = odd_ranks()
    data = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    codec = bpe.Codec(data, r" ?\w+|\W+")
    words = [w for w in "abc bca cab aab bba cca abab baba".split() for _ in range(2)]
    for _ in range(3):
        assert codec.decode(codec.encode(" ".join(words))) == " ".join(words).encode()


# --- SimHash


def plain_fingerprint(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return 0
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \t\n", "One", "a b", "a b c", "a b c d", "Ä Ö x y Ü ß", "A b " * 700, "a\x0bb\x0cc\x1cd e"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def brute_components(points, bits):
    parent = np.arange(len(points))
    a, b = np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= bits)
    simhash._join(parent, a, b)
    return simhash._roots(parent, np.arange(len(points)))


def some_points(seed, n=1500):
    rng = np.random.default_rng(seed)
    p = rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)
    for _ in range(3):  # chains of near points
        q = p[: n // 3] ^ (np.uint64(1) << rng.integers(0, 64, n // 3).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, n // 3).astype(np.uint64))
        p = np.concatenate([p, q])
    return np.unique(p)


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_shards_lose_no_link(seed):
    points = some_points(seed)
    tree = simhash.fit_tree(points[:: 3], len(points), 300, 3)
    at, shard = tree.shards(points, 3)
    assert len(tree.vantage) > 3 and set(at.tolist()) == set(range(len(points)))
    parent, place = np.arange(len(points)), {int(p): i for i, p in enumerate(points)}
    for s in set(shard.tolist()):
        a, b = simhash.forest(points[at[shard == s]], 3)
        simhash._join(parent, np.array([place[int(x)] for x in a], np.int64), np.array([place[int(x)] for x in b], np.int64))
    assert (simhash._roots(parent, np.arange(len(points))) == brute_components(points, 3)).all()


def test_forest_of_a_dense_group_is_linear():
    rng = np.random.default_rng(4)
    points = np.unique(np.uint64(99) ^ (np.uint64(1) << rng.integers(0, 64, 9000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 9000).astype(np.uint64)))
    a, b = simhash.forest(points, 3)
    assert len(a) == len(points) - 1 and len(set(b.tolist())) == 1
    assert len(simhash.forest(points[:0], 3)[0]) == 0


# --- WARC


def test_warc_record_round_trip():
    payload = "<p>é\r\n\r\nx</p>".encode()
    raw = warc.record(7, "http://a.b/c\r\nd e", payload, warc.hashlib.sha1(payload).hexdigest(), None, "2000-01-01T00:00:00Z")
    headers, body = warc.parse(raw)
    assert body == payload and headers["warc-target-uri"] == "http://a.b/c%0D%0Ad%20e" and warc._urn_id(headers["warc-record-id"]) == 7
    headers, body = warc.parse(warc.record(None, None, payload, "00" * 20, 9, "2000-01-01T00:00:00Z"))
    assert headers["warc-type"] == "revisit" and body == b"" and warc._urn_id(headers["warc-refers-to"]) == 9
    assert warc._urn_id(headers["warc-record-id"]) is None


# --- BM25


def brute_leaks(text, items, overlap=0.8):
    w = bm25.words_of(text)
    out = []
    for item_id, item in items:
        words, _ = bm25.split_item(item)
        runs = bm25.shingles(words)
        if not runs:
            continue
        k = len(runs[0])
        held = set(zip(*(w[i:] for i in range(k)), strict=False))
        if sum(r in held for r in runs) / len(runs) >= overlap - 1e-9:
            out.append(item_id)
    return out


def test_block_max_wand_finds_what_brute_force_finds():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, f"{sentence(rng.randrange(1, 25))}. {sentence(rng.randrange(1, 9))}".encode()) for i in range(60)] + [(60, b""), (61, b"w1 w2")]
    docs = [b"", b"w1 w2 w3", b"!!"]
    for _ in range(150):
        item = rng.choice(items)[1].split()
        if rng.random() < 0.6 and len(item) > 4:
            item[rng.randrange(len(item))] = b"zzz"
        docs.append(b" ".join([sentence(rng.randrange(90)).encode(), *item, sentence(rng.randrange(90)).encode()]))
    words = [bm25.split_item(t)[0] for _, t in items]
    df = Counter(w for ws in words for w in set(ws))
    index = bm25.ItemIndex(items, df, 61, sum(map(len, words)) / 61, 0.8)
    found = bm25.scan(index, docs)
    wrong = 0
    for text, (_, leaks) in zip(docs, found, strict=True):
        # The whole text may hold scattered runs of an item that no passage holds.
        assert {x["item_id"] for x in leaks} <= set(brute_leaks(text, items))
        for x in leaks:
            assert x["overlap"] >= 0.8 - 1e-9 and x["score"] > 0
        stride = max(bm25.LEAST_STRIDE, index.longest)
        w = bm25.words_of(text)
        passages = [w[i : i + 2 * stride] for i in range(0, max(1, len(w) - stride), stride)]
        want = {i for p in passages for i in brute_leaks(b" ".join(p), items)}
        wrong += want != {x["item_id"] for x in leaks}
    assert wrong == 0


def test_split_item():
    assert bm25.split_item(b"What is it? It is A.") == ([b"what", b"is", b"it", b"it", b"is", b"a"], 3)
    assert bm25.split_item(b"no answer here") == ([b"no", b"answer", b"here"], 3)
    assert bm25.split_item(b" .!") == ([], 0)


# --- CRF


def test_forward_backward_equals_enumeration():
    from itertools import product

    rng = np.random.default_rng(2)
    lengths, labels = np.array([3, 1, 4, 0, 2]), 3
    scores, trans, start = rng.normal(size=(10, labels)), rng.normal(size=(labels, labels)), rng.normal(size=labels)
    got, log_z, expected = crf.forward_backward(crf.Chains(lengths), scores, trans, start, pairs=True)
    at, want, total, pairs = 0, [], 0.0, np.zeros((labels, labels))
    for n in lengths:
        if not n:
            continue
        weights, marginal, two = [], np.zeros((n, labels)), np.zeros((labels, labels))
        for path in product(range(labels), repeat=int(n)):
            s = start[path[0]] + sum(scores[at + t, k] for t, k in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:]))
            weights.append(np.exp(s))
            for t, k in enumerate(path):
                marginal[t, k] += np.exp(s)
            for a, b in zip(path, path[1:]):
                two[a, b] += np.exp(s)
        want.append(marginal / sum(weights))
        pairs += two / sum(weights)
        total += np.log(sum(weights))
        at += n
    assert np.allclose(got, np.concatenate(want)) and np.isclose(log_z, total) and np.allclose(expected, pairs)


def test_line_model_tells_noise_from_prose_and_handles_no_labels():
    rng = random.Random(3)
    prose = lambda: "\n".join(" ".join(rng.choice(["the", "house", "stands", "on", "hills", "and", "waits"]) for _ in range(12)) + "." for _ in range(4))
    noise = lambda: "\n".join(" ".join(rng.choice(["BUY!!", "$$$", "NOW!!", "###"]) for _ in range(12)) for _ in range(4))
    texts = [(prose() if i % 2 else noise()).encode() for i in range(60)]
    labels = np.array([i % 2 for i in range(60)])
    model = line_crf.train([line_crf.features(t) for t in texts], labels)
    found = model.score([prose().encode(), noise().encode(), b""])
    assert found[0] > 0.7 and found[1] < 0.3 and 0 <= found[2] <= 1
    mixed = model.score([(prose() + "\n" + noise()).encode()])[0]
    assert found[1] <= mixed <= found[0]
    assert line_crf.train([], np.array([], np.int64)).score([b"x", b""]).tolist() == [0.5, 0.5]
    assert line_crf.train([line_crf.features(b"a")], np.array([1])).score([b"x"]).tolist() == [1.0]


def test_language_model_labels_switches():
    rng = random.Random(9)
    en, de = ["the", "house", "stands", "with", "this", "thing"], ["der", "haus", "steht", "mit", "dieser", "schön"]
    say = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    sample = sorted((say(w, 60).encode(), k) for k, w in (("en", en), ("de", de)) for _ in range(30))
    model = lang_crf.train(sample, rounds=20)
    assert model.predict([b"The house", "Dieser schön".encode(), b"", b"12 !!", "—".encode()])[:2] != [("und", 0.0)] * 2
    found = model.predict([say(en, 20).encode(), say(de, 20).encode(), b"", b"123 !?", "—«".encode()])
    assert [x[0] for x in found] == ["en", "de", "und", "und", "und"] and all(0 <= s <= 1 for _, s in found)
    (marginals, _), = model.label([(say(en, 15) + " " + say(de, 15)).encode()])
    labels = [model.langs[k] for k in marginals.argmax(axis=1)]
    assert labels == ["en"] * 15 + ["de"] * 15
    assert lang_crf.train([]).predict([b"abc"]) == [("und", 0.0)]
    assert lang_crf.train([(b"abc def", "xx")]).predict([b"abc"])[0][0] == "xx"


def test_language_of_text_without_spaces_is_that_of_all_of_it():
    rng = random.Random(4)
    one, two = "春夏秋冬山川草木", "あいうえおかきく"
    say = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    sample = sorted((say(w, 300).encode(), k) for k, w in (("zh", one), ("ja", two)) for _ in range(30))
    model = lang_crf.train(sample, rounds=20)
    mixed = (say(one, 40) + say(two, 400)).encode()
    assert [k for k, _ in model.predict([mixed, say(one, 200).encode()])] == ["ja", "zh"]
    (marginals, sizes), = model.label([mixed])
    assert model.langs[marginals[0].argmax()] == "zh" and model.langs[marginals[-1].argmax()] == "ja" and sizes.sum() == len(mixed)
    for text in (mixed, b"a" * 200, b"\x80" * 200, b"x" + mixed):
        parts = lang_crf.words_of(text)
        assert b"".join(parts) == text and max(map(len, parts)) <= 60
    assert [w.decode() for w in lang_crf.words_of(b"x" + mixed)]


# --- license notices


def plain_places(words, phrase):
    p = phrase.split()
    return [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]


def test_notices_count_places_and_find_errors():
    ready = notices.prepare(notices.NOTICES, notices.CHARS_PER_ERROR)
    text = b"MIT license, mit-License mit license.\nLicensed under the Apache  License, Version 2.0. GENERAL public License"
    row = notices.scan(text, notices.PHRASES, ready)
    words = [w.decode() for w in notices.words_of(text)]
    places = [i for p in notices.PHRASES for i in plain_places(words, p)]
    assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (len(words), len(places), min(places), max(places))
    assert row["base_labels"] == "apache,gpl,mit" and row["score"] == 1.0
    span = next(s for s in row["spans"] if s["label"] == "apache")
    assert words[span["first_word"] : span["last_word"] + 1] == "licensed under the apache license version 2 0".split() and span["errors"] == 0
    row = notices.scan(b"x relesed under the MIT licence y", notices.PHRASES, ready)
    assert row["base_labels"] == "" and row["labels"] == "mit" and 0.7 < row["score"] < 1 and row["first_word"] is None
    row = notices.scan(b"", notices.PHRASES, ready)
    assert (row["n_words"], row["n_base"], row["labels"], row["score"], row["spans"]) == (0, 0, "", 0.0, [])


def test_pigeonhole_seeds_lose_no_match():
    import regex

    rng, notice = random.Random(13), notices.Notice(b"licensed under cc by nc 4 0", "cc", 2)
    for _ in range(400):
        body = bytearray(notice.text)
        for _ in range(rng.randrange(5)):
            i = rng.randrange(len(body))
            kind = rng.randrange(3)
            if kind == 0:
                body[i] = 120
            elif kind == 1:
                del body[i]
            else:
                body.insert(i, 120)
        text = b" aa bb " + bytes(body) + b" cc "
        assert bool(list(notice.search(text))) == bool(regex.search(b"(?:%s){e<=2}" % notice.text, text)), text


def test_inexact_notices_beside_exact_ones_are_all_found():
    ready = notices.prepare({"released under the mit license": "mit"}, 10)
    exact, one, two = "released under the mit license", "released under the mit licence", "relesed under the mit licence"
    for order in ([one, exact], [two, one, exact, two, exact], [exact, one], [one] * 3, [two, two, exact, one, two]):
        spans = notices.scan(" ".join(order).encode(), {}, ready)["spans"]
        errors = {exact: 0, one: 1, two: 2}
        assert [(s["first_word"], s["last_word"], s["errors"]) for s in spans] == [(5 * k, 5 * k + 4, errors[t]) for k, t in enumerate(order)]


# --- log-bilinear model


def test_contexts_and_normalised_scores():
    now, one, two = lbl.contexts([[5, 6, 0], [0], [7, 0]], 9)
    assert now.tolist() == [5, 6, 0, 0, 7, 0] and one.tolist() == [9, 5, 6, 9, 9, 7] and two.tolist() == [9, 9, 5, 9, 9, 9]
    classes = lbl.Classes([b"the", b"a"])
    params = lbl.Params.start(np.log(np.full(classes.size, 1 / classes.size)))
    unigram = np.full(classes.size, 1 / classes.size)
    trainer = lbl.Trainer(params, unigram)
    sequence = classes.sequence([b"the", b"xx", b"a", b"yy"] * 50)
    for _ in range(60):
        trainer.learn(*lbl.contexts([sequence], classes.size))
    scorer = lbl.Scorer(params)
    n = classes.size
    for h1, h2 in ((0, 1), (n, n), (3, 2)):
        total = sum(10 ** scorer.tokens(np.array([w]), np.array([h1]), np.array([h2]))[0] for w in range(n))
        assert abs(total - 1) < 1e-4
    after_the = scorer.tokens(np.array([classes.of(b"xx")]), np.array([classes.of(b"the")]), np.array([classes.of(b"yy")]))[0]
    assert 10**after_the > 10 / n


def test_class_of_a_word():
    classes = lbl.Classes([b"the"])
    assert classes.of(b"") == 0 and classes.of(b"the") == 1 and classes.of(b"a") == 2 + zlib.crc32(b"a") % lbl.SHARED
    assert classes.sequence([b"the", b"xyz"]) == [1, 2 + zlib.crc32(b"yz") % lbl.SHARED, 0]


def test_repeated_notices_in_a_very_long_text_cost_linear_time():
    ready = notices.prepare(notices.NOTICES, notices.CHARS_PER_ERROR)
    unit = b"released under the mit licence and apache license too "
    for n in (3, 700):
        got = notices.scan(unit * n, notices.PHRASES, ready)
        assert got["n_base"] == n and len([s for s in got["spans"] if s["label"] == "mit"]) == n
        assert (got["first_word"], got["last_word"]) == (6, 9 * (n - 1) + 6)
    import time

    spent = []
    for n in (5_000, 20_000):
        start = time.process_time()
        notices.scan(unit * n, notices.PHRASES, notices.prepare(notices.NOTICES, notices.CHARS_PER_ERROR))
        spent.append(time.process_time() - start)
    assert spent[1] < 8 * spent[0]
