"""Operators on embeddings against plain versions, on small tables with nulls,
non-finite and zero vectors, other lengths, ties, repeated rows and clashing
column names."""

import math

import numpy as np
import pytest

from ledgerlake.llm import embedding_codes, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, node string, `a.b` string"


def crowd(seed=1, n=300, dim=64):
    """Unrelated vectors, a large group of near copies, a chain of links,
    pairs on both sides of the threshold, exact and scaled copies."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x)
    out = [unit(rng.standard_normal(dim)) for _ in range(n)]
    centre = unit(rng.standard_normal(dim))
    out += [unit(centre + 0.2 * unit(rng.standard_normal(dim))) for _ in range(n)]
    a, b = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
    out += [math.cos(t) * a + math.sin(t) * b for t in np.arange(12) * math.acos(0.93)]
    for cos in (0.85, 0.895, 0.899, 0.901, 0.905, 0.95) * 8:
        a, b = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
        out += [a, cos * a + math.sqrt(1 - cos * cos) * b]
    out += [out[0], out[0] * 3, out[n], out[n], -out[5]]
    return out


def embedding_rows(dim=64):
    rows = [(i, v.tolist(), i % 4, "x", None) for i, v in enumerate(crowd(dim=dim))]
    first = rows[0][1]
    rows += [(5000, None, 1, None, None), (5001, [0.0] * dim, 1, None, None), (5002, [None] + first[1:], 1, None, None),
             (5003, [float("nan")] + first[1:], 1, None, None), (5004, [float("inf")] + first[1:], 1, None, None),
             (5005, first[:-1], 1, None, None), (5006, first[:-1], 2, None, None), (5007, [], 1, None, None),
             (None, first, 1, None, None), (None, rows[3][1], None, None, None), (7, rows[7][1], 3, None, None),
             (5008, [1e200 * x for x in rows[9][1]], 1, None, None), (5009, [-0.0, 1.0], 1, None, None),
             (5010, [0.0, 1.0], None, None, None)]
    return rows


def plain_links(rows, least=0.9):
    unit = [embedding_codes.unit(r[1]) for r in rows]
    cos = lambda i, j: len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= least
    ok = [i for i, u in enumerate(unit) if u is not None]
    to = {i: [j for j in ok if j != i and cos(i, j)] if unit[i] is not None else [] for i in range(len(rows))}
    comp = {}
    for i in range(len(rows)):
        if i not in comp:
            seen, queue = {i}, [i]
            while queue:
                for j in to[queue.pop()]:
                    if j not in seen:
                        seen.add(j)
                        queue.append(j)
            ids = [rows[k][0] for k in seen if rows[k][0] is not None]
            comp |= dict.fromkeys(seen, min(ids, default=None))
    return sorted(((r[0], len(to[i]), comp[i], r[0] == comp[i]) for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("dim, block", [(64, 2048), (64, 40), (100, 90)])
def test_embedding_links_are_exact(spark, dim, block):
    rows = embedding_rows(dim)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, embedding_codes.link(df, block=block).collect()), key=repr)
    want = plain_links([(r[0], r[1]) for r in rows])
    assert got == want
    assert max(w[1] for w in want) > 250
    assert embedding_codes.link(df.filter("vec_id < 0")).count() == 0


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    a, b = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
    cos, estimates, kept = 0.9, [], []
    pair = np.stack([a, cos * a + math.sqrt(1 - cos * cos) * b])
    for k in range(400):  # other rotations: turn the pair instead
        turn = np.linalg.qr(np.random.default_rng(k).standard_normal((64, 64)))[0]
        f, s, q = whole = embedding_codes.decoded(embedding_codes.codes(pair @ turn))
        estimates.append(float(np.where(q[0] >= 0, 1, -1) @ q[1] * s[1] / 8 / f[0]))
        kept.append(embedding_codes.possible(tuple(x[:1] for x in whole), tuple(x[1:] for x in whole), cos, 1e-9)[0, 0])
    assert abs(np.mean(estimates) - cos) < 4 * np.std(estimates) / 20 and np.std(estimates) > 0.01
    assert all(kept)
    noise = rng.standard_normal((400, 64))
    whole = embedding_codes.decoded(embedding_codes.codes(noise / np.linalg.norm(noise, axis=1)[:, None]))
    ok = embedding_codes.possible(whole, whole, cos, 1e-9)
    assert ok.sum() - 400 < 0.002 * 400 * 400  # hardly a pair of unrelated vectors is recomputed


def test_tables_follow_the_stated_chance():
    for n in (10, 10_000, 10**9):
        bits, tables = embedding_codes.bits_and_tables(n)
        meet = (1 - math.acos(0.9) / math.pi) ** bits
        assert (1 - meet) ** tables <= embedding_codes.MISS and n / 2**bits <= embedding_codes.BUCKET


def plain_negatives(rows, every, n_pos=5, n_neg=5, low=80):
    usable = [r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None
              and all(x is not None and math.isfinite(x) for x in r[1])]
    vec = [[math.floor(256 * x) for x in r[1]] for r in usable]
    out = []
    for i, a in enumerate(usable):
        if a[0] % every:
            continue
        score = [sum(x * y for x, y in zip(vec[i], v)) for v in vec]
        order = sorted((j for j in range(len(usable)) if j != i), key=lambda j: (-score[j], usable[j][0]))
        for p in [j for j in order if usable[j][2] == a[2]][:n_pos]:
            hits = [j for j in order if usable[j][2] != a[2]
                    and low * score[p] <= 100 * score[j] <= 100 * score[p]][:n_neg]
            out += [(a[0], usable[p][0], k, usable[j][0], score[p], score[j]) for k, j in enumerate(hits, 1)]
    return sorted(out)


@pytest.mark.parametrize("row_block, anchor_block", [(16_384, 1024), (50, 7)])
def test_hard_negatives(spark, row_block, anchor_block):
    rows = [r for r in embedding_rows() if r[0] != 5008]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = hard_negatives.mine(df, anchor_every=10, row_block=row_block, anchor_block=anchor_block)
    want = plain_negatives(rows, 10)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 200
    assert hard_negatives.mine(df.filter("vec_id < 0")).count() == 0


def test_hard_negatives_with_ties_and_large_numbers(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-1, 2, 3)], int(rng.integers(0, 3))) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, hard_negatives.mine(df, 10).collect())) == plain_negatives(rows, 10)
    large = [(i, [1e5 * (i + 1), 1e6, 1.0], i % 2) for i in range(30)]
    df = spark.createDataFrame(large, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, hard_negatives.mine(df, 10).collect())) == plain_negatives(large, 10)


def test_windows_open_and_close_in_a_stream():
    p = hard_negatives.packed
    keys = [p(1, 100, 0, 4), p(1, 100, 1, 2), p(1, 90, 1, 3), p(1, 85, 0, 9), p(1, 81, 1, 5), p(1, 79, 1, 6), p(1, 60, 1, 7),
            p(2, 5, 1, 1), p(2, -5, 0, 1), p(2, -5, 1, 2)]
    assert keys == sorted(keys)
    got = list(hard_negatives.opened_windows(iter([(k, 7) for k in keys]), 2))
    assert got == [(7, 4, 1, 2, 100, 100), (7, 4, 2, 3, 100, 90), (7, 9, 1, 5, 85, 81), (7, 9, 2, 6, 85, 79)]
