"""Vector codes against a plain version of the same rounds."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from wordlake.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error int"


def plain(rows, parts, entries, rounds):
    """rows (vec_id, vector, label) to (vec_id, code, error, label_error) and the entries."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [r for r in kept if r[1] and len(r[1]) % parts == 0]
    by_id = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(by_id[0][1])] if kept else []
    by_id = [r for r in by_id if len(r[1]) == len(by_id[0][1])]
    w = len(by_id[0][1]) // parts if by_id else 0
    cut = lambda v: [tuple(v[p * w : (p + 1) * w]) for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in by_id[:entries]] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda v: [min(range(len(books[p])), key=lambda e: (square(x, books[p][e]), e)) for p, x in enumerate(cut(v))]
    for _ in range(rounds):
        at = [assign(v) for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v)[p] for (_, v, _), a in zip(kept, at) if a[p] == e]
                if own:
                    books[p] = [*books[p][:e], tuple(sum(c) // len(own) for c in zip(*own)), *books[p][e + 1 :]]
    out = []
    for i, v, lab in kept:
        a = assign(v)
        out.append((i, "".join(f"{e:02x}" for e in a), sum(square(x, books[p][a[p]]) for p, x in enumerate(cut(v))), lab))
    totals = Counter()
    for _, _, error, lab in out:
        totals[lab] += error
    return [(i, c, e, totals[lab]) for i, c, e, lab in out], hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def held(spark, rows, parts=4, entries=8, rounds=2):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = vector_codes.vector_codes(table, parts, entries, rounds).collect()
    want, sha = plain(rows, parts, entries, rounds)
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=repr) == sorted(want, key=repr)
    assert {r["codebooks_sha256"] for r in got} <= {sha}


@pytest.mark.parametrize("rounds", [0, 1, 2, 4])
def test_rounds(spark, rounds):
    r = np.random.default_rng(rounds)
    held(spark, [(i, (r.normal(0, 0.2, 8) * r.choice([1, 3])).tolist(), int(r.integers(3)) if i % 5 else None) for i in range(200)], rounds=rounds)


def test_production_form(spark):
    r = np.random.default_rng(9)
    held(spark, [(i, r.normal(0, 0.12, 64).tolist(), i % 3) for i in range(150)], 16, 64)


def test_ties_repeats_nulls_and_odd_lengths(spark):
    r = np.random.default_rng(4)
    grid = [(i, (r.integers(-2, 3, 8) / 256).tolist(), 1) for i in range(80)]  # many equal distances and equal entries
    odd = [(None, [0.5] * 8, 1), (None, None, 1), (3, grid[3][1], 2), (3, grid[3][1], 2), (7, [1.0] * 4, 1), (8, [1.0] * 3, 1), (9, [], 1), (10, [None] * 8, 1), (11, [float("nan")] * 8, 1), (12, [float("inf")] * 8, 1), (13, [1e4] * 8, None)]
    held(spark, grid + odd)
    held(spark, grid[:3] + odd[:1])  # fewer rows than entries


def test_hot_vector_and_empty_table(spark):
    held(spark, [(i, [0.25] * 8, 5) for i in range(300)] + [(i, [i / 256] * 8, None) for i in range(300, 330)])
    empty = vector_codes.vector_codes(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes.vector_codes(spark.createDataFrame([(1, [1.0] * 5, 1, "", 1)], SCHEMA)).count() == 0


def test_bounds_save_distances(spark):
    r = np.random.default_rng(2)
    centres = r.normal(0, 3, (8, 8))
    rows = [(i, (centres[i % 8] + r.normal(0, 0.02, 8)).tolist(), 1, "", 1) for i in range(2000)]
    _, _, measured = vector_codes.encode(vector_codes.whole_vectors(spark.createDataFrame(rows, SCHEMA)), 4, 8, 3)
    assert measured[0] == 2000 * 4 * 8 and measured[2] < 0.3 * measured[0]
