"""Nearest vectors with pivots against the search that compares all."""

import numpy as np
import pytest

from opslake.plans import pruned_search, retrieval


def tables(spark, n=3000, dim=8, clusters=40, questions=120, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim))
    vectors = [(i, (centres[i % clusters] + 0.05 * rng.standard_normal(dim)).tolist()) for i in range(n)]
    vectors += [(n + i, vectors[7][1]) for i in range(900)]  # a hot vector
    vectors += [(-1, None), (-2, [0.0] * dim), (-3, [1.0, None] + [0.0] * (dim - 2)), (-4, [1.0, 2.0, 3.0]), (-5, [1.0, 2.0, 2.5]), (-6, [])]
    asked = [(f"q{i}", (centres[i % clusters] + 0.2 * rng.standard_normal(dim)).tolist()) for i in range(questions)]
    asked += [("same", vectors[7][1]), ("short", [3.0, 2.0, 1.0]), ("none", None), ("zero", [0.0] * dim), ("other", [1.0] * (dim + 1)), ("null", [None] * dim)]
    return (
        spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5),
        spark.createDataFrame(asked, "query_id string, embedding array<double>"),
    )


def plain(df):
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("shape", [{}, {"sample": 60, "pivots": 5, "rings": 2}, {"sample": 400, "pivots": 16, "rings": 1}])
def test_equals_the_full_search(spark, tmp_path, shape):
    vectors, asked = tables(spark)
    index = pruned_search.build_index(vectors, folder=str(tmp_path / "index"), **shape)
    want = plain(retrieval.cosine_topk(vectors, asked, 6))
    assert plain(pruned_search.pruned_topk(vectors, asked, 6, index=index, chunk=200, block=16)) == want
    assert {q for q, *_ in want} >= {"same", "short", "q0"} and not {q for q, *_ in want} & {"none", "zero", "other", "null"}


def test_most_meetings_are_skipped_and_vectors_move_once(spark, tmp_path):
    vectors, asked = tables(spark)
    index = pruned_search.build_index(vectors, folder=str(tmp_path / "index"))
    assert sum(index.sizes.values()) == 3902  # every usable vector stands in one cell
    chosen = pruned_search.choose_cells(index, asked, 6, "query_id", "embedding")
    met, skipped = pruned_search.meetings(index, chosen, 122)
    assert skipped > 0.8 * (met + skipped)
    for c, low in index.low.items():
        assert (low <= index.high[c]).all()


def test_nothing_to_search(spark):
    vectors, asked = tables(spark, n=50, questions=2)
    for v, q in ((vectors.limit(0), asked), (vectors, asked.limit(0)), (vectors.where("embedding is null"), asked)):
        got = pruned_search.pruned_topk(v, q)
        assert got.count() == 0 and got.columns == ["query_id", "vec_id", "score", "rank"]
