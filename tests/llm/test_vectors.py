"""Operators on vectors against brute force: groups, copies, ties, broken vectors, empty tables, clashing columns."""

import hashlib
import math

import numpy as np
import pytest

from ledgerline.llm import clustering, cross_polytope, product_codes

SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, v bigint, cluster string, code string, __id bigint, same string, n bigint, hub string"
REST = ("x", 1, "y", "z", 7, "s", 2, "h")


def frame(spark, rows):
    return spark.createDataFrame([(i, e, lab, *REST) for i, e, lab in rows], SCHEMA).repartition(3)


def unit(x):
    return x / np.linalg.norm(x)


@pytest.fixture(scope="module")
def vectors():
    """Random vectors, three groups of close ones (one large, one loose), copies, multiples, repeated ids and broken vectors."""
    rng = np.random.default_rng(11)
    rows = [[float(y) for y in unit(rng.standard_normal(64))] for _ in range(150)]
    for size, noise in ((120, 0.1), (40, 0.24), (6, 0.05)):
        centre = unit(rng.standard_normal(64))
        rows += [[float(y) for y in unit(centre + noise * unit(rng.standard_normal(64)))] for _ in range(size)]
    rows += [rows[3], rows[3], [2 * x for x in rows[5]], [-x for x in rows[7]], [1e200 * x for x in rows[9]], [1e-200 * x for x in rows[9]]]
    out = [(1000 - 3 * k, e, k % 4 if k % 5 else None) for k, e in enumerate(rows)]
    out += [(1, None, 1), (2, [], None), (4, [0.0] * 64, 2), (5, [float("nan")] + [1.0] * 63, 2), (7, [None] + [1.0] * 63, 0), (8, [float("inf")] * 64, 0), (10, [1.0, 2.0], 1), (11, [1.0, 2.0], 1), (13, [1.0] * 48, 3), (None, rows[3], 3)]
    # One id twice: a copy of itself, and another vector.
    return out + [(out[160][0], rows[160], 1), (out[200][0], rows[0], 1)]


def good(e):
    return e is not None and len(e) > 0 and all(x is not None and math.isfinite(x) for x in e)


def test_near_vectors_equal_brute_force(spark, vectors):
    got = cross_polytope.near_vectors(frame(spark, vectors)).collect()
    live = [(i, unit(np.array(e) / np.abs(e).max())) for i, e, _ in vectors if i is not None and good(e) and any(e)]
    cos = [[float(u @ w) if len(u) == len(w) else -1.0 for _, w in live] for _, u in live]
    links = [[k for k, c in enumerate(r) if c >= 0.95 and k != j] for j, r in enumerate(cos)]
    label = [i for i, _ in live]
    for _ in live:
        label = [min([label[j], *(label[k] for k in links[j])]) for j in range(len(live))]
    # Rows of equal id and vector are told apart by nothing, and have the same answer.
    want = sorted((i, len(links[j]), label[j], i == label[j]) for j, (i, _) in enumerate(live))
    dead = [(i, 0, i, True) for i, e, _ in vectors if i is not None and not (good(e) and any(e))]
    assert sorted(tuple(r) for r in got if r.vec_id is not None) == sorted(want + dead)
    assert [tuple(r) for r in got if r.vec_id is None] == [(None, 0, None, True)]
    assert max(w[1] for w in want) >= 119
    assert cross_polytope.near_vectors(frame(spark, vectors).limit(0)).count() == 0 and cross_polytope.near_vectors(frame(spark, vectors[-12:-2]).filter("vec_id < 9")).count() == 6


def test_hashing_recall_at_the_limit():
    """Share of pairs at a given cosine that share a bucket and whose sketches pass, of random pairs."""
    rng = np.random.default_rng(5)
    turns = cross_polytope.Rotations(64)
    for cos, least in ((0.95, 0.999), (0.96, 0.9995), (0.98, 1.0)):
        a = rng.standard_normal((2000, 64))
        a /= np.linalg.norm(a, axis=1)[:, None]
        b = rng.standard_normal((2000, 64))
        b -= (b * a).sum(axis=1)[:, None] * a
        b = cos * a + math.sqrt(1 - cos * cos) * b / np.linalg.norm(b, axis=1)[:, None]
        (ka, pa, sa), (kb, pb, sb) = turns.hashed(a), turns.hashed(b)
        met = [bool(set(x) & {*y, *q} or set(y) & {*x, *p}) for x, y, p, q in zip(ka.tolist(), kb.tolist(), pa.tolist(), pb.tolist())]
        unequal = np.unpackbits((sa ^ sb).view(np.uint8), axis=1).sum(axis=1)
        share = math.acos(cos) / math.pi
        passed = unequal <= 128 * share + 5 * math.sqrt(128 * share * (1 - share)) + 1
        assert (np.array(met) & passed).mean() >= least


def test_rotations_keep_lengths_and_tiny_vectors_are_hashed():
    rng = np.random.default_rng(1)
    for dim in (1, 2, 63, 64, 65, 200):
        x = rng.standard_normal((10, dim))
        u = cross_polytope.units(x)[1]
        turns = cross_polytope.Rotations(dim)
        assert np.allclose(np.linalg.norm(turns.turned(u), axis=2), 1, atol=1e-5)
        base, probes, sketch = turns.hashed(u)
        assert base.shape == (10, 10) and probes.shape == (10, 40) and sketch.shape == (10, 2)


def plain_clusters(rows, k, rounds, scale=1024, dim=64):
    kept = [(i, [math.floor(scale * x) for x in e]) for i, e, _ in rows if good(e) and len(e) == dim and max(map(abs, e)) <= clustering.MOST]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]
    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            own = [v for (_, v), c in zip(kept, of) if c == j]
            if own:
                centres[j] = [sum(col) // len(own) for col in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    return sorted(((i, c, d, sum(e for _, e, g in found if g == c), total, hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for i, d, c in found), key=str)


@pytest.mark.parametrize("k,rounds", [(8, 10), (500, 1), (30, 2)])
def test_clusters_equal_plain_search(spark, vectors, k, rounds):
    # Halves make equal distances common.
    rows = [(i, None if e is None else [x if x is None or not math.isfinite(x) or abs(x) > 10 else round(2 * x) / 2 for x in e] if k == 30 else e, lab) for i, e, lab in vectors]
    got = clustering.clusters(frame(spark, rows), k=k, rounds=rounds).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_clusters(rows, k, rounds)
    assert clustering.clusters(frame(spark, rows).filter("vec_id < 4"), k=k).count() == 0


def test_orchard_stops_early_and_keeps_ties_to_the_smaller_number():
    rng = np.random.default_rng(2)
    centroids = rng.integers(-3, 4, (20, 3))
    x = rng.integers(-3, 4, (500, 3))
    d = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    for start in (np.zeros(500, np.int64), rng.integers(0, 20, 500)):
        now, far = clustering.orchard(x, start, centroids)
        assert (now == d.argmin(axis=1)).all() and (far == d.min(axis=1)).all()


def plain_codes(rows, parts, entries, rounds, scale=256):
    kept = [(i, lab, [math.floor(scale * x) for x in e]) for i, e, lab in rows if good(e) and len(e) % parts == 0 and max(map(abs, e)) <= product_codes.MOST]
    key = lambda r: (r[0] is None, r[0] or 0)
    dim = min((*key(r), len(r[2])) for r in kept)[2]
    kept = [r for r in kept if len(r[2]) == dim]
    w = dim // parts
    heads = sorted(kept, key=lambda r: (*key(r), r[2]))[:entries]
    books = [[h[2][p * w : p * w + w] for h in heads] for p in range(parts)]
    def code(v):
        return [min((sum((a - b) ** 2 for a, b in zip(v[p * w : p * w + w], c)), j) for j, c in enumerate(books[p])) for p in range(parts)]
    for _ in range(rounds):
        codes = [code(v) for _, _, v in kept]
        moved = []
        for p in range(parts):
            moved.append([])
            for j, c in enumerate(books[p]):
                own = [v[p * w : p * w + w] for (_, _, v), found in zip(kept, codes) if found[p][1] == j]
                moved[p].append([sum(col) // len(own) for col in zip(*own)] if own else c)
        books = moved
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    found = [(i, lab, "".join(f"{j:02x}" for _, j in code(v)), sum(d for d, _ in code(v))) for i, lab, v in kept]
    return sorted(((i, c, e, sum(f for _, m, _, f in found if m == lab), digest) for i, lab, c, e in found), key=str)


@pytest.mark.parametrize("parts,entries,rounds", [(16, 64, 2), (4, 400, 1), (64, 1, 1), (32, 9, 3)])
def test_codes_equal_plain_scans(spark, vectors, parts, entries, rounds):
    rows = [(i, None if e is None else [x if x is None or not math.isfinite(x) or abs(x) > 10 else round(8 * x) / 8 for x in e] if entries == 9 else e, lab) for i, e, lab in vectors if i not in (10, 11, 13)]
    entries = min(entries, 256)
    got = product_codes.compressed(frame(spark, rows), parts=parts, entries=entries, rounds=rounds).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_codes(rows, parts, entries, rounds)
    assert product_codes.compressed(frame(spark, rows).filter("vec_id < 4")).count() == 0


def test_codes_take_the_length_of_the_smallest_id(spark, vectors):
    got = product_codes.compressed(frame(spark, [r for r in vectors if r[0] != 4]), parts=16, entries=4).collect()
    assert [r.vec_id for r in got] == [13] and got[0].code == "00" * 16


def test_net_displacement_saves_scans_that_drift_would_not():
    """Entries that go out and come back: the sum of moves is nothing, the sum of their lengths is not."""
    rng = np.random.default_rng(4)
    x = rng.integers(-100, 100, (300, 1, 4))
    book = rng.integers(-100, 100, (1, 16, 4))
    first = product_codes.Codebooks([book])
    code, bound, stamp, _ = first.first(x)
    away = book + rng.integers(20, 40, book.shape)
    back = product_codes.Codebooks([book, away, book])
    again = back.again(x, code, bound, stamp)
    assert (again[0] == code).all() and again[4] <= 300 * 4 // 20
    moved = product_codes.Codebooks([book, away]).again(x, code, bound, stamp)
    d = ((x[:, 0, None] - away[0][None]) ** 2).sum(axis=2)
    assert (moved[0][:, 0] == d.argmin(axis=1)).all() and (moved[3][:, 0] == d.min(axis=1)).all() and moved[4] > again[4]
    # Bounds hold after any chain of rounds, with old and new stamps mixed.
    history, state = [book], (code, bound, stamp)
    for _ in range(6):
        history = [*history, history[-1] + rng.integers(-9, 10, book.shape)]
        books = product_codes.Codebooks(history)
        c, b, s, far, _ = books.again(x, *state)
        d = ((x[:, 0, None] - history[-1][0][None]) ** 2).sum(axis=2)
        assert (c[:, 0] == d.argmin(axis=1)).all() and (far[:, 0] == d.min(axis=1)).all()
        state = (c, b, s)
