"""Dense and sparse search against all scores."""

import random

import numpy as np
import pytest

from textflow.operators import dense, retrieval, sparse


def vectors(seed, n, dim=6, groups=4):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(groups, dim)) * 3
    return [(i, [float(x) for x in np.round(middle[i % groups] + r.normal(size=dim) * 0.2, 3)]) for i in range(n)]


def plain_scores(queries, candidates, normalized, digits=6):
    def unit(v):
        v = np.array(v)
        return v / max(np.sqrt((v * v).sum()), 1e-12) if normalized else v

    return {q: sorted((-(round(float(unit(a) @ unit(b)), digits)), c) for c, b in candidates if b is not None and c != q) for q, a in queries if a is not None}


@pytest.mark.parametrize("normalized", [True, False])
@pytest.mark.parametrize(("query_bytes", "rows"), [(1 << 20, 1024), (200, 8)])
def test_dense(spark, monkeypatch, normalized, query_bytes, rows):
    monkeypatch.setattr(dense, "QUERY_BYTES", query_bytes), monkeypatch.setattr(dense, "ROWS", rows), monkeypatch.setattr(dense, "QUERIES", 3)
    candidates = vectors(1, 150) + [(1000, None), (1001, [0.0] * 6)] + [(2000 + i, v) for i, v in vectors(1, 12)]  # ties
    queries = [(i, v) for i, v in vectors(1, 150) if i % 10 == 0] + [(5000, None), (5001, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    want = plain_scores(queries, candidates, normalized)
    q = spark.createDataFrame(queries, "query_id long, v array<double>")
    c = spark.createDataFrame(candidates, "cand_id long, v array<double>").repartition(3)
    for table in (c, dense.clustered(c, 5, normalized)):
        got = {}
        for r in dense.search(q, table, 7, normalized, 6).collect():
            got.setdefault(r.query_id, []).append((r["rank"], -r.score, r.cand_id))
        assert got.keys() == want.keys()
        for k, x in got.items():
            assert [y[2] for y in sorted(x)] == [y[1] for y in want[k][:7]]
    positives = [(i, j) for i, _ in queries for j, _ in candidates if i != j and j % 4 == i % 4 and j % 3 == 0] + [(10, 1000), (10, 99_999)]
    p = spark.createDataFrame(positives, "query_id long, cand_id long")
    told = {r.query_id: r for r in dense.evaluate(q, c, p, normalized=normalized, digits=6).collect()}
    first = {r.query_id: r["rank"] for r in dense.ranks_of(q, c, p, normalized, 6).collect()}
    for k, order in want.items():
        own = {b for a, b in positives if a == k}
        ranks = [i + 1 for i, (_, x) in enumerate(order) if x in own]
        assert (k in told) == bool(ranks) == (k in first)
        if ranks:
            r = told[k]
            assert (r.n_positive, r.best_rank, r.recall_5, r.hit_1) == (len(ranks), ranks[0], sum(x <= 5 for x in ranks) / len(ranks), ranks[0] == 1) and first[k] == ranks[0]


def test_dense_leaves_blocks_out_and_counts_what_it_reads(spark, monkeypatch):
    monkeypatch.setattr(dense, "ROWS", 100)
    candidates = vectors(3, 4000, groups=8)
    c = spark.createDataFrame(candidates, "cand_id long, v array<double>")
    q = spark.createDataFrame([(9_000, candidates[0][1])], "query_id long, v array<double>")
    (ids, v), = dense._query_blocks(q, True)
    rows = dense._pass(ids, v, dense.clustered(c).coalesce(1), 5, True, None, None).where("cand_id is null").collect()
    assert sum(r.scored for r in rows) < 3500
    assert dense.search(q.limit(0), c, 5).count() == 0 and dense.search(q, c.limit(0), 5).count() == 0
    with pytest.raises(Exception):  # noqa: B017  another length
        dense.search(spark.createDataFrame([(1, [1.0])], "query_id long, v array<double>"), c, 1).collect()


@pytest.mark.parametrize(("rows", "postings", "terms"), [(128, 1 << 22, 1 << 20), (4, 100, 9), (1, 50, 1000)])
def test_sparse(spark, rows, postings, terms):
    r = random.Random(rows)
    docs = [(i, f"t{min(int(r.expovariate(0.2)), 40)}", float(r.choice([1, 1, 2, 5, -1]))) for i in range(120) for _ in range(r.randrange(1, 12))]
    queries = [(q, f"t{min(int(r.expovariate(0.2)), 45)}", float(r.choice([1, 2, 3, -2]))) for q in range(8) for _ in range(4)]
    score = {}
    for q, t, w in queries:
        for c, u, x in docs:
            if t == u:
                score[q, c] = score.get((q, c), 0) + w * x
    want = {q: sorted((-s, c) for (p, c), s in score.items() if p == q)[:5] for q in range(8)}
    d = spark.createDataFrame([*docs, (None, "t1", 1.0), (1, None, 1.0)], "cand_id long, token string, weight double")
    q = spark.createDataFrame(queries, "query_id long, token string, weight double")
    built = sparse.index(d, rows, postings).persist()
    got = {}
    for x in sparse.search(q, built, 5, rows, terms=terms).collect():
        got.setdefault(x.query_id, []).append((x["rank"], -x.score, x.cand_id))
    assert {k: [(s, c) for _, s, c in sorted(v)] for k, v in got.items()} == {k: v for k, v in want.items() if v}
    same = {(x.query_id, x.cand_id) for x in sparse.search(q, built, 500, rows, same=True).collect()}
    assert same == {(p, c) for p, c in score if p != c}
    assert sparse.search(q.limit(0), built, 5, rows).count() == 0 and sparse.search(q, sparse.index(d.limit(0), rows), 5, rows).count() == 0


def test_sparse_reads_few_postings(spark):
    r = random.Random(7)
    docs = [(i, f"t{k}", float(r.randrange(1, 2 + 2000 // (i + 1)))) for i in range(3000) for k in range(6)]
    built = sparse.index(spark.createDataFrame(docs, "cand_id long, token string, weight double"), 32)
    q = spark.createDataFrame([(0, f"t{k}", 1.0) for k in range(4)], "query_id long, token string, weight double")
    told = sparse.postings_read(q, built, 5, 32).first()
    assert told.total == 12_000 and told.read < 6_000


def test_sparse_index_reads_its_documents_once(spark):
    read = spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = [(i, f"t{k}", 1.0) for i in range(30) for k in range(3)]
    d = spark.createDataFrame(docs, "cand_id long, token string, weight double").mapInArrow(told, "cand_id long, token string, weight double")
    assert sum(r.n for r in sparse.index(d).where("token is not null").collect()) == len(docs) == read.value


@pytest.mark.parametrize("most", [1_000_000, 1])
def test_words_in_lists_are_indexed_as_rows_are(spark, monkeypatch, most):
    monkeypatch.setattr(retrieval, "VARIANTS", most)
    texts = [(1, "A b\tb-c1c É eé\n\nZ"), (2, "b"), (2, "Ab b \u212a İi"), (3, None), (4, ""), (5, "éßñ 12"), (None, "a b"), (6, "x" * 5_000_000 + " a"), (7, "\U0001f600a\U0001f600b a")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    asked = spark.createDataFrame([(0, "a", 1.0), (0, "b", 2.0), (1, "c", 1.0), (1, "k", 1.0), (2, "absent", 1.0), (2, "i", 1.0), (3, None, 1.0)], "query_id long, token string, weight double")
    for only in (None, asked, asked.limit(0)):
        rows, lists = (f(df, "doc_id", "text", only).withColumnRenamed("doc_id", "cand_id") for f in (retrieval.term_weights, retrieval.term_lists))
        added = lists.selectExpr("cand_id", "explode(arrays_zip(tokens, weights)) x").groupBy("cand_id", "x.tokens").sum("x.weights")
        want = {tuple(r) for r in rows.collect()}
        assert {tuple(r) for r in added.collect()} == want and bool(want) == (only is None or only is asked)
        found = [sorted(map(tuple, sparse.search(asked, sparse.index(x, 2, 3), 5, 2).collect())) for x in (rows, lists)]
        assert found[0] == found[1] and bool(found[0]) == bool(want)


def test_items_without_token_or_weight_are_left_out(spark):
    d = spark.createDataFrame([(1, ["a", None, "b"], [1.0, 2.0, None]), (2, ["a", "a"], [float("nan"), 3.0]), (3, [None], [1.0]), (4, [], []), (5, None, None), (None, ["a"], [9.0])], "cand_id long, tokens array<string>, weights array<double>")
    q = spark.createDataFrame([(0, "a", 1.0), (0, "b", 1.0)], "query_id long, token string, weight double")
    assert [tuple(r) for r in sparse.search(q, sparse.index(d), 5).orderBy("rank").collect()] == [(0, 2, 3.0, 1), (0, 1, 1.0, 2)]
