"""Vector codes: the mask search against plain distances, the codebooks against a plain version in Python integers."""

import hashlib
import math

import numpy as np
import pytest

from civicledger.llm import vector_codes as V

COLUMNS = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(id, code, error) of every usable row, and the digest of the codebooks; whole numbers of any size."""
    ok = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not ok:
        return [], hashlib.sha256(b"").hexdigest()
    width = len(ok[0][1]) // parts
    whole = [[math.floor(x * scale) for x in r[1]] for r in ok if len(r[1]) == len(ok[0][1])]
    ok = [r for r in ok if len(r[1]) == len(ok[0][1])]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(groups[e]) for col in zip(*groups[e])] if e in groups else old
                        for e, old in enumerate(books[p])]
    out = []
    for r, c in zip(ok, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{e:02x}" for _, e in found), min(V.LONGEST, sum(d for d, _ in found))))
    flat = ",".join(str(v) for b in books for e in b for v in e)
    return out, hashlib.sha256(flat.encode()).hexdigest()


def compare(spark, rows, **how):
    found, books = V.encode(spark, spark.createDataFrame(rows, COLUMNS), keep=("vec_id", "label"), **how)
    want, digest = plain(rows, **how)
    assert sorted(str((r["vec_id"], r["code"], r["error"])) for r in found.collect()) == sorted(map(str, want))
    assert books.digest() == digest
    return found


@pytest.mark.parametrize("entries", [1, 2, 16, 70, 200])
def test_masks_find_the_nearest_entry(entries):
    rng = np.random.default_rng(entries)
    for spread in (3, 400, 1 << 27):
        book = rng.integers(-spread, spread, (entries, 5))
        x = np.concatenate([rng.integers(-spread, spread, (500, 5)), book, book[:1].repeat(5, axis=0), rng.integers(-9, 9, (50, 5))])
        got, far = V.SlicedEntries(book).nearest(x)
        every = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (got == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()


def test_candidates_hold_every_entry_within_the_radius():
    rng = np.random.default_rng(1)
    book, x = rng.integers(-50, 50, (130, 4)), rng.integers(-60, 60, (200, 4))
    r = rng.integers(0, 60, 200)
    mask = V.SlicedEntries(book).candidates(x, r)
    held = np.unpackbits(mask.view(np.uint8).reshape(200, -1), axis=1, bitorder="little")[:, :130].astype(bool)
    assert (held == (np.abs(x[:, None] - book[None]).max(axis=2) <= r[:, None])).all()


def test_against_plain_integers(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16)], int(rng.integers(0, 3))) for i in rng.permutation(300).tolist()]
    rows += [(1000 + i, rows[0][1], None) for i in range(40)]              # copies, null label
    compare(spark, rows)
    compare(spark, rows, parts=2, entries=5, rounds=2, scale=100)


def test_null_broken_repeated_and_large_vectors(spark):
    rng = np.random.default_rng(3)
    v = lambda s=0.5: [float(x) for x in rng.normal(0, s, 8)]
    rows = [(5, v(), 1), (5, v(), 1), (None, v(), 2), (6, None, 1), (7, [], 1), (8, [None] + v()[1:], 1),
            (9, [float("nan")] + v()[1:], 1), (10, [float("inf")] + v()[1:], 1), (11, v()[:5], 1), (12, [0.0] * 8, None),
            (13, v(1e9), 1), (14, v(1e30), 1), (2, v(1e12), 3)] + [(20 + i, v(), 1) for i in range(30)]
    compare(spark, [r for r in rows if r[0] != 11])
    found, _ = V.encode(spark, spark.createDataFrame(rows, COLUMNS), keep=("vec_id", "label"))
    assert {6, 7, 8, 9, 10, 11} & {r["vec_id"] for r in found.collect()} == set()


def test_fewer_rows_than_entries_and_none(spark):
    compare(spark, [(3, [1.0] * 8, 1), (1, [-1.0] * 8, 1)])
    compare(spark, [(1, None, 1)])
    compare(spark, [])


def test_label_errors_add_up_over_equal_labels(spark):
    rows = [(i, [float(i % 7) / 3 + k for k in range(8)], None if i % 3 == 0 else i % 3) for i in range(60)]
    coded, _ = V.encode(spark, spark.createDataFrame(rows, COLUMNS), entries=4, keep=("vec_id", "label"))
    got = V.with_label_errors(coded).collect()
    total = {}
    for r in got:
        total[r["label"]] = total.get(r["label"], 0) + r["error"]
    assert len(got) == 60 and all(r["label_error"] == total[r["label"]] for r in got)


def test_limbs():
    for n in (0, 1, -1, 2**32, -2**32 - 5, 10**60, -10**60, 2**63):
        limbs = V._limbs(n)
        assert sum(v << (V.LIMB * k) for k, v in enumerate(limbs)) == n and all(abs(v) < 2**32 for v in limbs)
