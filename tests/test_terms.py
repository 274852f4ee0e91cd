"""Terms inside texts against brute force."""

import random

from opslake.plans import terms


def plain(text, words):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    out, at = [], 0
    while at < len(low):
        best = None
        for w, t in words.items():
            end = at + len(w)
            if low.startswith(w, at) and not (at and low[at - 1].isalnum() and w[0].isalnum()) and not (end < len(low) and low[end].isalnum() and w[-1].isalnum()):
                best = max(best or (0, ""), (len(w), t))
        if best:
            out.append((at + 1, at + best[0], best[1]))
            at += best[0]
        else:
            at += 1
    return out


def test_equals_brute_force(spark, rows, monkeypatch):
    rng = random.Random(1)
    listed = [("Stage", "main stage|stage|STG"), ("Gate", "gate|main|gate c"), ("Lot", "lot|é-lot|stage lot c|c"), ("Empty", ""), ("Alone", None), ("Zwei", "stage")]
    pieces = ["main", " stage", "gate", " c", "STAGE", "lot", "é-lot", "-", ".", "s", "\n", "alone", "漢", " Main stage lot c"]
    docs = [(i, "".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randrange(25)))) for i in range(150)]
    docs += [(900, None), (901, ""), (902, "gate c " * 20_000), (None, "main stage"), (5, "stage")]
    table = spark.createDataFrame(listed, "term string, synonyms string")
    words = {r.word: r.term for r in terms.word_list(table).collect()}
    assert words["stage"] == "Stage" and words["alone"] == "Alone" and "" not in words
    want = sorted([(i, *m) for i, t in docs for m in plain(t or "", words)], key=repr)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows(terms.find_terms(d, table)) == want
    monkeypatch.setattr(terms, "CHUNK_BYTES", 10)  # several automata
    assert rows(terms.find_terms(d, table)) == want
    assert terms.find_terms(d, table.limit(0)).count() == 0 and terms.find_terms(d.limit(0), table).count() == 0


def test_a_task_holds_few_matches_at_once(monkeypatch):
    import ahocorasick
    import pyarrow as pa

    automaton = ahocorasick.Automaton()
    automaton.add_word("gate", (4, "Gate"))
    automaton.make_automaton()
    monkeypatch.setattr(terms, "HELD", 10)
    texts = ["gate " * 4, "", "none"] * 30
    kinds = pa.list_(pa.struct([("start_pos", pa.int64()), ("end_pos", pa.int64()), ("term", pa.string())]))
    batch = pa.record_batch([pa.array(range(90)), pa.array(texts), pa.array([None] * 90, kinds)], names=["doc_id", "text", "found"])
    parts = list(terms._searched(batch, automaton, True))
    assert max(p.num_rows for p in parts) <= 14 and sum(p.num_rows for p in parts) == 120
    assert pa.Table.from_batches(parts).column("doc_id").to_pylist() == [i for i in range(0, 90, 3) for _ in range(4)]
    before = list(terms._searched(batch, automaton, False))
    assert [t for p in before for t in p.column(1).to_pylist()] == texts
    again = [r for p in before for q in terms._searched(p, None, True) for r in q.to_pylist()]
    assert again == [r for p in parts for r in p.to_pylist()]
