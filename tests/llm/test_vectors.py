"""Bit-plane clustering and slice-and-intersect codes against brute force and their statements, odd rows included."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from freightlens.llm import bit_planes, slice_codes
from freightlens.llm.common import steps
from freightlens.llm.queries import QUERIES, STATEMENTS

SCHEMA = "vec_id long, embedding array<float>, label string, cluster string, code long"


def odd_rows(n=300, seed=1):
    """Vectors around a few centres with copies, ties, negative and zero values, and rows that are no vectors."""
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.3) for _ in range(64)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = r.choice(centres)
        rows.append((i * 3, [float(np.float32(x + r.gauss(0, 0.05))) for x in c], r.choice(["a", "b", None]), "x", 1))
    copy = rows[7][1]
    rows += [(5000 + i, list(copy), "hot", "x", 1) for i in range(150)]
    rows += [rows[3], rows[3], (None, rows[9][1], None, None, None), (9000, [0.0] * 64, "a", "x", 1), (9001, [-0.5] * 64, "a", "x", 1), (9001, [-0.25] * 64, "a", "x", 1)]
    bad = list(copy)
    for value in (None, float("nan"), float("inf"), float("-inf")):
        rows.append((9100, [*bad[:63], value], "a", "x", 1))
    rows += [(9200, None, "a", "x", 1)]
    r.shuffle(rows)
    return rows


def other_lengths():
    return [(9300, [], "a", "x", 1), (9301, [0.5] * 63, "b", "x", 1), (9302, [0.5] * 65, None, "x", 1), (9303, [0.5] * 128, "b", "x", 1)]


@pytest.fixture
def folder(spark, tmp_path):
    def make(rows):
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
        return str(tmp_path)

    return make


def compare(spark, name, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    result = con.execute(STATEMENTS[name])
    names = [d[0] for d in result.description]
    order = lambda row: tuple((v is None, v) for v in row)
    got = sorted((tuple(r) for r in QUERIES[name](spark, folder).select(*names).collect()), key=order)
    assert got == sorted(result.fetchall(), key=order)
    return got


def test_planes_give_exact_dots():
    r = np.random.default_rng(2)
    x = r.integers(-3000, 3000, (50, 64))
    x[0], x[1] = -4096, 4095
    planes = bit_planes.planes_of(x, 13)
    assert (bit_planes.dots(planes, planes[:9]) == x @ x[:9].T).all()
    nearest, squared = bit_planes.assigned(planes, (x * x).sum(axis=1), x[[5, 3, 5]])
    every = ((x[:, None] - x[[5, 3, 5]][None]) ** 2).sum(axis=2)
    assert (nearest == every.argmin(axis=1)).all() and (squared == every.min(axis=1)).all()
    totals, counts = bit_planes.member_sums(planes, nearest, 4)
    assert all((totals[c] == x[nearest == c].sum(axis=0)).all() and counts[c] == (nearest == c).sum() for c in range(4))


def test_planes_of_one_bit_and_of_zero():
    for value in (0, -1):
        x = np.full((3, 64), value)
        planes = bit_planes.planes_of(x, 1)
        assert (bit_planes.dots(planes, planes) == 64 * value * value).all()


def test_candidates_are_all_entries_in_the_box():
    r = np.random.default_rng(3)
    for entries, width in ((1, 8), (16, 8), (64, 3), (16, 1)):
        book = r.integers(-50, 50, (entries, width))
        book[entries // 2] = book[0]  # equal entries
        x = np.concatenate([r.integers(-60, 60, (400, width)), book])
        s = slice_codes.Slices(book)
        radius = s.radius(x)
        inside = (np.abs(x[:, None] - book[None]) <= radius[:, None, None]).all(axis=2)
        masks = s.candidates(x, radius)
        assert [[bool(m >> np.uint64(e) & np.uint64(1)) for e in range(entries)] for m in masks] == inside.tolist()
        every = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        entry, squared = s.nearest(x)
        assert (entry == every.argmin(axis=1)).all() and (squared == every.min(axis=1)).all()


def test_candidates_are_few():
    """The initial radius leaves a small part of a spread codebook to compare."""
    r = np.random.default_rng(4)
    book = r.integers(-1000, 1000, (64, 8))
    x = book[r.integers(0, 64, 500)] + r.integers(-20, 20, (500, 8))
    s = slice_codes.Slices(book)
    assert np.bitwise_count(s.candidates(x, s.radius(x))).mean() < 32


def brute_clusters(rows):
    kept = [(i, np.floor(1024 * np.array(v, np.float64)).astype(int)) for i, v, *_ in rows if v is not None and len(v) == 64 and all(e is not None and np.isfinite(e) for e in v)]
    key = [(i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest(), tuple(x)) for i, x in kept]
    centres = np.array([kept[n][1] for n in sorted(range(len(kept)), key=lambda n: key[n])[:8]])
    x = np.array([v for _, v in kept])
    for r in range(11):
        every = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        nearest = every.argmin(axis=1)
        if r < 10:
            centres = np.array([x[nearest == c].sum(axis=0) // (nearest == c).sum() if (nearest == c).any() else centres[c] for c in range(len(centres))])
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    least = every.min(axis=1)
    return [(kept[n][0], int(nearest[n]), int(least[n]), int(least[nearest == nearest[n]].sum()), int(least.sum()), shas[nearest[n]]) for n in range(len(kept))]


def test_clusters(spark, folder):
    rows = odd_rows() + other_lengths()
    got = compare(spark, "op11_bit_plane_clusters", folder(rows))
    order = lambda row: tuple((v is None, v) for v in row)
    assert got == sorted(brute_clusters(rows), key=order) and len(got) == 456


def brute_codes(rows):
    kept = [(i, label, tuple(np.floor(4096 * np.array(v, np.float64)).astype(int).tolist())) for i, v, label, *_ in rows if v is not None and all(e is not None and np.isfinite(e) for e in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    x = np.array([r[2] for r in kept]).reshape(len(kept), 8, -1)
    books = x[:16].copy()
    for r in range(7):
        every = ((x[:, None] - books[None]) ** 2).sum(axis=3)
        entry = every.argmin(axis=1)
        if r < 6:
            for p in range(8):
                for e in range(len(books)):
                    of = x[entry[:, p] == e, p]
                    books[e, p] = of.sum(axis=0) // len(of) if len(of) else books[e, p]
    error = every.min(axis=1).sum(axis=1)
    sha = hashlib.sha256(",".join(str(v) for v in books.transpose(1, 0, 2).ravel()).encode()).hexdigest()
    labels = [r[1] for r in kept]
    of_label = {v: int(sum(e for e, w in zip(error, labels) if w == v)) for v in set(labels)}
    return [(r[0], "".join(f"{e:02x}" for e in entry[n]), int(error[n]), of_label[r[1]], sha) for n, r in enumerate(kept)]


def test_codes(spark, folder):
    rows = odd_rows()
    got = compare(spark, "op12_slice_codes", folder(rows))
    order = lambda row: tuple((v is None, v) for v in row)
    assert got == sorted(brute_codes(rows), key=order) and len(got) == 456


def test_codes_of_other_lengths_are_null(spark):
    rows = odd_rows() + other_lengths()
    of = lambda rows: {(r.vec_id, r.code, r.error) for r in slice_codes.slice_codes(steps(spark), spark.createDataFrame(rows, SCHEMA))[0].collect()}
    odd = {(r[0], None, None) for r in other_lengths()}
    assert of(rows) == of(odd_rows()) | odd
    assert of(other_lengths()[:3]) == {r for r in odd if r[0] < 9303}


@pytest.mark.parametrize("name", ["op11_bit_plane_clusters", "op12_slice_codes"])
def test_few_and_no_vectors(spark, tmp_path, name):
    for case, rows in (("few", odd_rows()[:4]), ("none", []), ("bad", [(1, None, "a", "x", 1)])):
        spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / case / "embeddings.parquet"))
        assert len(compare(spark, name, str(tmp_path / case))) == sum(1 for r in rows if r[1] and all(e is not None and np.isfinite(e) for e in r[1]))


def test_components_beyond_the_limit_end_the_job(spark):
    rows = [(1, [1e30] * 64, "a", "x", 1)]
    with pytest.raises(Exception, match="beyond"):
        bit_planes.bit_plane_clusters(steps(spark), spark.createDataFrame(rows, SCHEMA))
