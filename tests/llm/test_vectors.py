"""Vector search and integer codebooks against plain comparisons of everything with everything."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from civiq.llm import ann, codebooks, queries

# The further names are those the operators use themselves.
SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    *(T.StructField(n, T.StringType()) for n in ("cell", "rep", "v", "ids", "place", "score", "rank", "code", "entry", "same_label", "error")),
])
NAN, INF = math.nan, math.inf


def table(spark, rows):
    return spark.createDataFrame([(i, v, g, *"abcdefghijk") for i, v, g in rows], SCHEMA)


def product(v, w):
    """Summed term by term; Python's own sum would correct the rounding."""
    total = 0.0
    for a, b in zip(v, w):
        total += a * b
    return float(total)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_nearest(rows, k=20):
    good = sorted({(i, tuple(map(float, np.float32(v)))) for i, v, _ in rows if i is not None and usable(v) and any(v)})
    width = max((len(v) for _, v in good), default=0)
    filled = [(i, v + (0.0,) * (width - len(v))) for i, v in good]
    found = set()
    for i, v in filled:
        if i % 20 == 0:
            scored = sorted((-product(v, w), j) for j, w in filled if j != i)
            found |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])}
    return found


def nearest(spark, rows, **settings):
    df = table(spark, rows)
    return {tuple(r) for r in ann.nearest(df, df.where("vec_id % 20 = 0"), **settings).collect()}


def clustered(count, dim=24, seed=3):
    """A third of all rows share one vector, the rest stand around a few centres."""
    random = np.random.default_rng(seed)
    centres = random.standard_normal((6, dim))
    common = centres[0].astype(np.float32).tolist()
    return [(i, common if i % 3 == 0 else (centres[i % 6] + random.standard_normal(dim) * 0.4).astype(np.float32).tolist(), i % 5)
            for i in range(count)]


ODD = [
    (0, [1.0, 2.0, 0.0], 1), (1, [1.0, 2.0, 0.0], None), (2, [2.0, 1.0], 2), (3, None, 3), (4, [], 3), (5, [0.0, -0.0, 0.0], 1),
    (6, [1.0, None, 2.0], 1), (7, [NAN, 1.0, 1.0], 2), (8, [INF, 1.0, 1.0], 2), (20, [-0.0, 1.5, 1.0], None), (20, [-0.0, 1.5, 1.0], None),
    (None, [3.0, 3.0, 3.0], 4), (40, [0.0, 1.5, 1.0], 1), (41, [2.0, 1.0, 0.0], 1),
]


@pytest.mark.parametrize("settings", [{}, {"cell_rows": 64, "block_queries": 8}])
def test_nearest_is_what_comparing_everything_finds(llm, settings):
    rows = clustered(900)
    got, wanted = nearest(llm, rows, **settings), brute_nearest(rows)
    pairs = {(q, i) for q, _, i, _ in wanted}
    assert len(pairs & {(q, i) for q, _, i, _ in got}) >= 0.98 * len(pairs)
    assert len(got) == len(wanted)
    scores = {(q, i): s for q, _, i, s in wanted}
    assert all(scores.get((q, i), s) == s for q, _, i, s in got)


def test_nearest_of_odd_rows(llm):
    assert nearest(llm, ODD) == brute_nearest(ODD)
    assert nearest(llm, ODD, k=2) == brute_nearest(ODD, 2)


def test_fewer_rows_than_wanted_and_none(llm):
    assert nearest(llm, [(0, [1.0], 1), (7, [2.0], 1)]) == {(0, 1, 7, 2.0)}
    assert nearest(llm, [(0, [1.0], 1)]) == set()
    assert nearest(llm, []) == set()


def test_uniform_vectors_reach_recall(llm):
    random = np.random.default_rng(5)
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(random.standard_normal((1200, 64)))]
    wanted = {(q, i) for q, _, i, _ in brute_nearest(rows)}
    found = {(q, i) for q, _, i, _ in nearest(llm, rows, cell_rows=200)}
    assert len(wanted & found) >= 0.97 * len(wanted)


def test_no_true_product_exceeds_a_certain_bound():
    random = np.random.default_rng(1)
    rows, asked = random.standard_normal((400, 20)), random.standard_normal((30, 20))
    centre, rotation = rows.mean(axis=0), ann.rotation_matrix(20, 3)
    assert np.allclose(rotation @ rotation.T, np.eye(24))
    rows[0] = centre  # a residual of length zero
    bits, norms, cosines = ann.encode(rows - centre, rotation)
    assert bits.shape == (400, 3)
    exact = asked @ rows.T
    guesses, uppers = ann.estimate(asked, centre, rotation, bits, norms, cosines, 1e9)
    assert (uppers >= exact - 1e-9).all()
    assert abs((guesses - exact).mean()) < 0.05
    _, likely = ann.estimate(asked, centre, rotation, bits, norms, cosines, 2.0)
    assert (likely >= exact).mean() > 0.95 and (likely < uppers).mean() > 0.3
    assert ann.exact_products(rows, asked[0]).tolist() == [product(r, asked[0]) for r in rows]


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * float(x)) for x in np.float32(v)], g) for i, v, g in rows if usable(v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    kept = [(i, v + [0] * (parts * width - len(v)), g) for i, v, g in kept]

    def cut(v):
        return [v[p * width:(p + 1) * width] for p in range(parts)]

    firsts = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v)[p] for _, v, _ in firsts] for p in range(parts)]

    def best(piece, book):
        return min((sum((a - b) ** 2 for a, b in zip(piece, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            own = [[] for _ in book]
            for _, v, _ in kept:
                own[best(cut(v)[p], book)[1]].append(cut(v)[p])
            new.append([[sum(c) // len(o) for c in zip(*o)] if o else e for o, e in zip(own, book)])
        books = new
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    coded = []
    for i, v, g in kept:
        hits = [best(piece, book) for piece, book in zip(cut(v), books)]
        coded.append((i, g, "".join(f"{n:02x}" for _, n in hits), sum(d for d, _ in hits)))
    totals = {}
    for _, g, _, e in coded:
        totals[g] = totals.get(g, 0) + e
    return sorted(((i, g, c, e, totals[g], sha) for i, g, c, e in coded), key=repr)


@pytest.mark.parametrize("rows", [ODD, clustered(400, 32), [(9, [1.0, 2.0], None)], [(1, [], 2), (2, [], 2)]])
def test_codes_are_those_of_plain_arithmetic(llm, rows):
    assert sorted(map(tuple, codebooks.compress(table(llm, rows)).collect()), key=repr) == brute_codes(rows)


def test_codes_of_an_empty_table_and_of_large_components(llm):
    none = codebooks.compress(table(llm, []))
    assert none.collect() == [] and none.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    big = [(i, [2.0**15 * (i + 1), -(2.0**15) * i] * 8, 1) for i in range(5)]
    assert sorted(map(tuple, codebooks.compress(table(llm, big)).collect()), key=repr) == brute_codes(big)
    with pytest.raises(Exception, match="too large"):
        codebooks.compress(table(llm, [(1, [1e30], 1)])).collect()


def test_dictionaries_give_the_same_as_all_distances():
    random = np.random.default_rng(2)
    integers, books = random.integers(-300, 300, (500, 12)), random.integers(-300, 300, (4, 9, 3))
    codes, errors = codebooks.assign(integers, books)
    for part in range(4):
        wide = ((integers[:, None, part * 3:part * 3 + 3] - books[part][None]) ** 2).sum(axis=2)
        assert (codes[:, part] == wide.argmin(axis=1)).all() and (errors[:, part] == wide.min(axis=1)).all()


def test_registered_queries_give_what_their_sql_gives(llm):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet')")
    for name in ("op11_nearest", "op13_codebooks"):
        df = queries.QUERIES[name](llm, folder)
        wanted = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE[name]})").fetchall()
        assert sorted(map(tuple, df.collect())) == sorted(wanted) and wanted
