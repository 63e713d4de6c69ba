"""Whitening and near-duplicate embeddings against plain numpy."""

import math
import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from ledgerloom.llm import queries
from ledgerloom.llm.itq import learn_codes, learn_rotation, near_vectors, plan_tables, roots, unit
from ledgerloom.llm.whitening import below, leading_components, tridiagonal, whiten
from tests.oracle import _rows, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, vector string, x string, cid long, n long, component string, grp string, h1 string"


def table(spark, rows):
    """Rows are (vec_id, embedding, label); columns with clashing names are added."""
    return spark.createDataFrame([(*r, "v", "x", 7, 7, "c", "g", "h") for r in rows], SCHEMA)


NAN, INF = float("nan"), float("inf")
AWKWARD = [
    (1, [1.0, 0.0, 0.0, 0.5, 0.1], 1), (2, [1.0, 0.0, 0.0, 0.5, 0.1], 1), (2, [1.0, 0.0, 0.0, 0.5, 0.1], 1), (3, [2.0, 0.0, 0.0, 1.0, 0.2], 1),
    (4, [1.0, 0.01, 0.0, 0.5, 0.1], 2), (5, [1.0, 0.0, 0.0, 0.5, 0.1], None), (6, None, 1), (7, [], 1), (8, [0.0] * 5, 1), (9, [0.0] * 5, 1),
    (10, [1.0, NAN, 0.0, 0.0, 0.0], 1), (11, [1.0, INF, 0.0, 0.0, 0.0], 1), (12, [1.0, None, 0.0, 0.0, 0.0], 1),
    (None, [1.0, 0.0, 0.0, 0.5, 0.11], 1), (None, [0.0, 1.0, 0.0, 0.0, 0.0], 3), (13, [1.0, 0.0, 0.0, 0.5], 1), (14, [-1.0, 0.0, 0.0, -0.5, -0.1], 1),
    (15, [1e38, 0.0, 0.0, 0.5e38, 0.1e38], 1), (16, [0.2, 0.9, -0.3, 0.4, 0.1], 2), (-3, [0.1, 0.2, 0.3, -0.4, 0.5], 2),
]


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def plain_links(rows, cosine=0.98):
    """(vec_id, n_links, component_id, kept) of every row, by comparing all."""
    def cos(a, b):
        a, b = (np.array(x, dtype=float) / np.abs(x).max() for x in (a, b))
        return a @ b / math.sqrt((a @ a) * (b @ b))

    able = [usable(v) and any(v) and label is not None for _, v, label in rows]
    near = [[j for j in range(len(rows)) if j != i and able[i] and able[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1])
             and cos(rows[i][1], rows[j][1]) >= cosine] for i in range(len(rows))]
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((vec_id, len(near[i]), least, vec_id is not None and vec_id == least))
    return out


def test_near_vectors_on_awkward_rows(spark):
    vectors = table(spark, AWKWARD)
    stored = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    got = [tuple(r) for r in near_vectors(vectors).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_links(stored)))
    assert near_vectors(table(spark, [])).collect() == []
    assert [tuple(r) for r in near_vectors(table(spark, [(1, None, 1), (2, [1.0], 1)])).collect()] == [(1, 0, 1, True), (2, 0, 2, True)]


def planted(count, dims, seed):
    """Random vectors, groups of near copies at many angles, and exact copies."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(count, dims))
    rows = [base]
    for _ in range(3):
        noise = rng.normal(size=base.shape) * np.linalg.norm(base, axis=1, keepdims=True) / math.sqrt(dims)
        rows.append((base + noise * rng.uniform(0, 0.22, size=(count, 1)))[rng.random(count) < 0.5])
    rows.append(base[0] + rng.normal(size=(700, dims)) * 0.05)  # a large group of distinct near copies
    rows.append(np.repeat(base[1:2], 300, axis=0))  # a large group of exact copies
    x = np.concatenate(rows).astype(np.float32)
    x = x[rng.permutation(len(x))]
    return [(k, v.tolist(), k % 2) for k, v in enumerate(x)], x


@pytest.mark.parametrize("block", [512, 64])
def test_recall_and_precision(spark, block):
    """Every link found is one; of the links, right up to the threshold, at least 0.98 are found; large groups whole."""
    rows, x = planted(1500, 48, 5)
    got = {r.vec_id: r for r in near_vectors(table(spark, rows).repartition(5), block=block).collect()}
    n = x.astype(float)
    n /= np.linalg.norm(n, axis=1, keepdims=True)
    label = np.arange(len(n)) % 2
    linked = (n @ n.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    want = linked.sum(axis=1)
    found = np.array([got[k].n_links for k in range(len(n))])
    assert (found <= want).all()
    assert found.sum() >= 0.995 * want.sum()
    lone = want < 5
    assert found[lone].sum() >= 0.97 * want[lone].sum()
    truth = roots(linked)
    ours = np.array([got[k].component_id for k in range(len(n))])
    assert (ours >= truth).all() and (ours == truth).mean() > 0.99


def test_links_come_once_whatever_the_tables_share(spark):
    rows = [(k, [1.0, 0.001 * k], 1) for k in range(40)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(table(spark, rows), block=8).collect()}
    assert got == {k: (39, 0) for k in range(40)}


def test_a_third_or_all_rows_near_one_direction(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=32)
    near = [centre + rng.normal(size=32) * 0.06 for _ in range(600)]
    for others in (1200, 0):
        x = np.array([*near, *rng.normal(size=(others, 32))], dtype=np.float32)
        n = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
        want = (n @ n.T >= 0.98).sum() - len(n)
        got = near_vectors(table(spark, [(k, v.tolist(), 1) for k, v in enumerate(x)])).collect()
        assert 0.99 * want <= sum(r.n_links for r in got) <= want


def test_rotation_and_codes():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 16)) * np.linspace(3, 0.3, 16)
    r = learn_rotation(x, 3)
    assert np.allclose(r @ r.T, np.eye(16), atol=1e-10)
    loss = lambda q: np.square(np.where(x @ q >= 0, 1, -1) - x @ q).sum()
    start, _ = np.linalg.qr(np.random.default_rng(3).normal(size=(16, 16)))
    assert loss(r) < loss(start)
    codes = learn_codes(x, 8, 5)
    keys = codes.keys(unit(x))
    assert keys.shape == (2000, 5) and keys.min() >= 0 and keys.max() < 256
    bits = (unit(x) - codes.mean) @ codes.planes > 0
    assert np.abs(bits.mean(axis=0) - 0.5).max() < 0.05
    assert plan_tables(10, 0.98)[0] == 8 and plan_tables(1 << 30, 0.98)[0] == 30


def test_itq_query_equals_sql(spark):
    got = queries.op12_itq_dedup(spark, SF).toArrow()
    want = duck(SF).sql(queries.SQL["op12_itq_dedup"]).to_arrow_table()
    names = sorted(got.column_names)
    assert _rows(got.select(names)) == _rows(want.select(names))


def plain_whitening(rows, components=4):
    """(x by row, n, deviations, projections, shares) with a library's eigenvectors."""
    able = [(i, v) for i, v, _ in rows if usable(v)]
    width = max(len(v) for _, v in able)
    x = [[math.floor(256 * c) for c in v] for _, v in able]
    fit = [[*v] + [0] * (width - len(v)) for v in sorted(set(map(tuple, x)))]
    x = [v + [0] * (width - len(v)) for v in x]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(c * n - s) / n for c, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = [sum((c * n - s) ** 2 for c, s in zip(v, sums)) for v in x]
    white = np.array([[float(c * n - s) / n for c, s in zip(v, sums)] for v in x]) @ vectors / np.sqrt(values)
    return [i for i, _ in able], n, deviation, white, values / np.trace(centred.T @ centred / n)


def check_whitening(rows, got):
    ids, n, deviation, white, share = plain_whitening(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    sign = {}
    for k, vec_id in enumerate(ids):
        for c in range(len(share)):
            r = by_id[vec_id][c + 1][0]
            assert r.n == n and r.deviation == deviation[k] and r.identity_error <= 1e-4
            assert abs(r.explained - share[c]) <= 1e-9 * share[c]
            if abs(white[k, c]) > 1e-3:
                sign.setdefault(c, np.sign(r.whitened * white[k, c]))
            assert abs(r.whitened * sign.get(c, 1) - white[k, c]) < 1e-6
    assert len(got) == len(ids) * len(share)


def test_whitening_equals_a_library(spark):
    vectors = queries.embeddings(spark, SF)
    check_whitening([(r.vec_id, r.embedding, r.label) for r in vectors.collect()], queries.op13_whitening(spark, SF).collect())


def test_whitening_of_awkward_rows(spark):
    rows = [r for r in AWKWARD if r[0] not in (2, 15, None)]
    vectors = table(spark, rows)
    stored = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    check_whitening(stored, whiten(vectors.repartition(3)).collect())
    again = whiten(vectors.union(vectors)).collect()  # copies count once in the fit
    assert len(again) == 2 * len(whiten(vectors).collect()) and again[0].n == whiten(vectors).first().n
    assert len(whiten(table(spark, AWKWARD)).collect()) > 0
    assert whiten(table(spark, [])).collect() == []
    assert whiten(table(spark, [(1, [0.1, 0.2], 1), (2, [0.1, 0.2], 1)])).collect() == []
    assert whiten(table(spark, [(1, [], 1), (2, None, 1)])).collect() == []
    huge = whiten(table(spark, [(1, [3e38, 0.5], 1), (2, [-3e38, 0.1], 1), (3, [0.0, 0.2], 1)])).collect()
    assert {r.deviation for r in huge if r.vec_id == 1} == {None}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 40])
def test_eigenvectors_equal_a_library(size):
    rng = np.random.default_rng(size)
    x = rng.normal(size=(200, size))
    outer = rng.normal(size=size)
    for symmetric in (x.T @ x, np.diag(rng.integers(1, 4, size).astype(float)), np.eye(size), np.zeros((size, size)),
                      np.outer(outer, outer) * 1e8 + np.eye(size)):
        values, vectors = leading_components(symmetric, 4)
        want = np.linalg.eigvalsh(symmetric)[::-1][:4]
        scale = max(1, np.abs(want).max())
        assert np.allclose(values, want, rtol=1e-12, atol=1e-12 * scale)
        assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-11)
        assert np.abs(symmetric @ vectors.T - vectors.T * values).max() <= 1e-11 * scale
        diagonal, second, _ = tridiagonal(symmetric)
        for at in (want.min() - 0.37, want.max() + 0.37, 1.5):
            assert below(diagonal, second, at) == (np.linalg.eigvalsh(symmetric) < at).sum()


ALONE = """
import sys
sys.path.insert(0, {root!r})
from ledgerloom.session import local_session
from ledgerloom.llm import queries
spark = local_session("4")
for name in ("op2_language_id", "op7_sentencepiece", "op11_token_alignment", "op12_itq_dedup", "op13_whitening"):
    print(name, queries.QUERIES[name](spark, {folder!r}).count())
"""


def test_tasks_need_no_import_of_this_package(tmp_path):
    """From a folder where workers cannot import the package."""
    root = str(Path(__file__).resolve().parents[2])
    script = tmp_path / "alone.py"
    script.write_text(ALONE.format(root=root, folder=SF))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split("op")) == 6
