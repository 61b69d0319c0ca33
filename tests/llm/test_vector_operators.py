"""Search and codes of vectors against plain loops."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from postgrove.llm import maxscore, vector_codes

NAN, INFINITE = float("nan"), float("inf")


def clustered(count, size, seed):
    """Vectors around a few centres, many of them equal."""
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((6, size))
    vectors = centres[draw.integers(0, 6, count)] + 0.3 * draw.standard_normal((count, size))
    vectors[::5] = vectors[0]
    vectors[1::7] = 0.0
    return [(int(i), [float(x) for x in v], int(i) % 4 if i % 9 else None) for i, v in enumerate(vectors)]


AWKWARD = [
    (1000, None, 1),
    (1001, [], 1),
    (1002, [NAN] * 8, 1),
    (1003, [INFINITE] + [0.0] * 7, 2),
    (1004, [None] + [0.0] * 7, None),
    (1005, [1.0, 2.0], None),
    (1050, [-0.001] * 8, None),
    (1051, [-0.001] * 8, None),
    (None, [0.25] * 8, 3),
]


def frame(spark, rows):
    """Rows of (vec_id, embedding, label), with columns named as operators name theirs."""
    made = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    return made.selectExpr("*", "1 as id", "'x' as shard", "0 as size", "'y' as score", "2 as rank", "3 as codes").repartition(3)


def whole(rows, scale):
    """What takes part, by hand: (id, whole numbers, label)."""
    kept = []
    for i, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in vector], label))
    return kept


def best_by_hand(rows, every, k):
    kept = [(i, v) for i, v, _ in whole(rows, 256) if i is not None]
    found = []
    for q, query in kept:
        if q % every == 0:
            scores = {}
            for i, v in kept:
                if i != q and len(v) == len(query):
                    scores[i] = max(scores.get(i, -(10**18)), sum(a * b for a, b in zip(query, v)))
            ranked = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
            found += [(q, rank, i, score) for rank, (i, score) in enumerate(ranked, 1)]
    return sorted(found)


@pytest.mark.parametrize("rows_at_once, queries_at_once", [(1 << 14, 1 << 12), (17, 3)])
def test_search_equals_all_products(spark, rows_at_once, queries_at_once):
    rows = clustered(150, 8, 1) + AWKWARD
    vectors = frame(spark, rows)
    got = maxscore.top_k(
        vectors, vectors.where("vec_id % 10 = 0"), rows_at_once=rows_at_once, queries_at_once=queries_at_once
    )
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == best_by_hand(rows, 10, 5)


def test_search_of_few_and_of_nothing(spark):
    vectors = frame(spark, [(0, [1.0, -1.0], 0), (1, [-1.0, 1.0], 0), (1, [0.5, 1.0], 0), (50, [0.0, 0.0], 0)])
    got = maxscore.top_k(vectors, vectors.where("vec_id % 50 = 0"))
    assert sorted(map(tuple, got.collect())) == [
        (0, 1, 50, 0), (0, 2, 1, -128 * 256), (50, 1, 0, 0), (50, 2, 1, 0)
    ]
    nothing = vectors.where("false")
    assert maxscore.top_k(nothing, nothing).collect() == []
    assert maxscore.top_k(vectors, nothing).collect() == []


def test_bounds_leave_rows_out_but_none_of_the_best():
    draw = np.random.default_rng(3)
    rows = np.floor(256 * draw.standard_normal((500, 16)) * np.geomspace(4, 0.01, 16)).astype(np.int64)
    shard = maxscore.Shard.build(np.arange(500), rows)
    row = {name.split()[0]: x[0].as_py() for name, x in zip(maxscore.PACKED.split(", "), shard.packed())}
    shard, bounds = maxscore.Shard.open(row)
    for q in range(0, 500, 25):
        score = rows @ rows[q]
        right = sorted((x for x in range(500) if x != q), key=lambda x: (-score[x], x))[:5]
        for least in (None, int(score[right[4]]), int(score[right[4]]) - 1000):
            ids, scores = maxscore.search(shard, bounds, rows[q], q, 5, least)
            assert ids.tolist() == right and scores.tolist() == score[right].tolist()
        # With a bound that nothing reaches, no row is left.
        assert not len(maxscore.search(shard, bounds, rows[q], q, 5, 10**9)[0])


def codes_by_hand(rows, parts, entries, rounds):
    kept = whole(rows, 4096)
    kept.sort(key=lambda row: (row[0] is None, row[0], row[1]))
    kept = [row for row in kept if len(row[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[own[p] for own in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        far = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in book]
        return min(far), far.index(min(far))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [nearest(c[p], book)[1] for c in cut]
            for e in range(len(book)):
                mine = [c[p] for c, at in zip(cut, own) if at == e]
                if mine:
                    book[e] = [sum(x) // len(mine) for x in zip(*mine)]
    found = []
    for (i, _, label), c in zip(kept, cut):
        near = [nearest(part, book) for part, book in zip(c, books)]
        found.append((i, "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), label))
    of_label = Counter()
    for _, _, error, label in found:
        of_label[label] += error
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, code, error, of_label[label], sha) for i, code, error, label in found)


@pytest.mark.parametrize("rows_at_once, most_labels", [(1 << 14, 100), (13, 0)])
def test_codes_equal_plain_loops(spark, monkeypatch, rows_at_once, most_labels):
    monkeypatch.setattr(vector_codes, "MOST_LABELS", most_labels)
    rows = clustered(150, 8, 2) + AWKWARD + [(7, [0.5] * 8, None)] * 2
    got = vector_codes.compress(frame(spark, rows), parts=4, entries=5, rounds=3, rows_at_once=rows_at_once)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, got.collect())) == codes_by_hand(rows, 4, 5, 3)


def test_codes_of_few_and_of_nothing(spark):
    rows = [(3, [-0.3, 0.7], 1), (2, [0.1, 0.2], None)]
    got = vector_codes.compress(frame(spark, rows), parts=2)
    assert Counter(map(tuple, got.collect())) == codes_by_hand(rows, 2, 16, 6)
    for nothing in (frame(spark, rows).where("false"), frame(spark, [(1, None, 1)])):
        empty = vector_codes.compress(nothing)
        assert empty.collect() == [] and empty.columns == got.columns
    with pytest.raises(ValueError):
        vector_codes.compress(frame(spark, rows), parts=8)
