"""Filter audit, whitening and phrase fingerprints against plain versions, on awkward rows and empty tables."""

import hashlib
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from headway.llm import filter_audit, lz_print, queries, spectra, whiten
from tests.llm import brute
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return brute.corpus(spark).cache()


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- filter audit -----------------------------------------------------------------

def fails(rows):
    """Part, failed letters, good and toxic of each row, by the contract's words."""
    out = []
    for doc_id, text, part, good, toxic in rows:
        t, w = text or "", brute.words(text)
        failed = {"A"} if len(w) < 50 else set()
        failed |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        failed |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else set()
        failed |= {"D"} if re.search("[#$%&*|]", t) else set()
        if doc_id is not None and any(i is not None and i < doc_id and (x or "") == t for i, x, *_ in rows):
            failed |= {"E"}
        out.append((part or "", failed, good, toxic))
    return out


def audit(rows):
    cells, out = fails(rows), {}
    for part in {c[0] for c in cells}:
        mine = [c for c in cells if c[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order):
                gone = [c for c in left if letter in c[1]]
                left = [c for c in left if letter not in c[1]]
                shapley[letter] += len(gone)
                out[part, "".join(order), step + 1] = [
                    len(left), len(gone), sum(letter in c[1] for c in mine) - len(gone), sum(c[1] == {letter} for c in mine),
                    sum(c[2] for c in gone), sum(c[3] for c in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def labels_of(spark, docs):
    ids = sorted({r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] is not None})
    return {i: (i % 3 == 0, i % 4 == 1) for i in ids if i % 5}


@pytest.mark.parametrize("which", ["docs", "real"])
def test_audit_equals_applying_the_filters(spark, request, which):
    table = request.getfixturevalue(which)
    marks = labels_of(spark, table)
    labels = spark.createDataFrame([(i, int(g), int(t)) for i, (g, t) in marks.items()] + [(None, 1, 1), (1, 0, 0)],
                                   "doc_id BIGINT, quality INT, toxic INT")
    rows = [(r["doc_id"], r["text"], r["source"], *map(int, marks.get(r["doc_id"], (0, 0)))) for r in table.collect()]
    got = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in filter_audit.filter_audit(table, labels).collect()}
    assert got == audit(rows)


def test_shapley_is_the_share_of_the_first_failing_filter(spark, real):
    """By symmetry a document with k failing filters is removed by each of them in 120 / k orders."""
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    want = Counter()
    for part, failed, *_ in fails([(r["doc_id"], r["text"], r["source"], 0, 0) for r in real.collect()]):
        for letter in failed:
            want[part, letter] += 120 // len(failed)
    rows = filter_audit.filter_audit(real, labels).collect()
    assert all(r["shapley"] == want[r["part"], r["filter_order"][r["step"] - 1]] for r in rows)


def test_audit_of_nothing_and_very_long_texts(spark, docs):
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert filter_audit.filter_audit(docs.limit(0), labels).count() == 0
    long = spark.createDataFrame([(1, "word " * 1_000_000, "a"), (2, "Zq" * 2_000_000, "a"), (3, "word " * 1_000_000, None)],
                                 "doc_id BIGINT, text STRING, source STRING")
    got = filter_audit.filter_audit(long, labels).where("filter_order = 'EBACD'").orderBy("part", "step").collect()
    assert [(r["part"], r["removed"]) for r in got] == [("", 1), ("", 0), ("", 0), ("", 0), ("", 0),
                                                        ("a", 0), ("a", 1), ("a", 1), ("a", 0), ("a", 0)]


def test_audit_agrees_with_sql(spark):
    name = "op11_filter_audit"
    assert not compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name])


# --- whitening --------------------------------------------------------------------

def contract(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(object)
    x = np.array([[int(c) + 1_000_000 for c in row] for row in x], object)
    n, s = len(x), x.sum(axis=0)
    away = n * x - s  # exact
    v = (away.T @ away).astype(float) / float(n) ** 3
    e, q = np.linalg.eigh(v)
    return n, (away ** 2).sum(axis=1), away.astype(float) / n, e[::-1], q[:, ::-1]


def close(rows, ids, vectors, components=32):
    n, deviation, away, e, q = contract(vectors)
    k = min(components, len(e))
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(got) == sorted(ids) and all(sorted(g) == list(range(1, k + 1)) for g in got.values())
    w = np.array([[got[i][c + 1]["whitened"] for c in range(k)] for i in ids])
    want = away @ q[:, :k] / np.sqrt(e[:k])
    want *= np.sign((want * w).sum(axis=0))
    assert np.abs(w - want).max() < 1e-7
    assert [got[i][1]["deviation"] for i in ids] == list(deviation)
    first = got[ids[0]]
    assert all(abs(first[c + 1]["explained"] - e[c] / e.sum()) < 1e-9 * e[c] / e.sum() for c in range(k))
    assert {r["identity_error"] for r in rows} == {first[1]["identity_error"]} and first[1]["identity_error"] < 1e-8
    assert {r["n"] for r in rows} == {n}


def test_whitening_equals_an_eigendecomposition(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    for frame in (table, table.repartition(40)):
        close(whiten.whitened(frame).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_whitening_drops_what_is_no_vector(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=5) * (1 + np.arange(5))]) for i in range(60)]
    good += [(60 + i, good[0][1]) for i in range(40)]  # one vector many times
    bad = [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [float("nan")] * 5), (203, [float("inf")] * 5), (204, [1.0]), (205, [])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in good + bad], "vec_id BIGINT, embedding ARRAY<FLOAT>, v STRING, n INT")
    rows = whiten.whitened(frame).collect()
    close(rows, [i for i, _ in good], [v for _, v in good])
    assert whiten.whitened(frame.limit(0)).count() == 0 and whiten.whitened(frame.where("vec_id IN (200, 205)")).count() == 0
    assert whiten.whitened(frame.limit(0)).columns == whiten.whitened(frame).columns


def test_whitening_of_flat_and_huge_vectors(spark):
    """Components without variance are NULL; sums beyond a long too."""
    frame = spark.createDataFrame([(i, [float(i % 3), 2.0 * (i % 3), 5.0]) for i in range(30)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    rows = whiten.whitened(frame).orderBy("vec_id", "component").collect()
    assert [r["whitened"] is None for r in rows[:3]] == [False, True, True] and rows[0]["explained"] == pytest.approx(1)
    assert rows[0]["identity_error"] < 1e-9
    same = whiten.whitened(frame.where("vec_id % 3 = 0")).collect()
    assert {(r["whitened"], r["deviation"], r["identity_error"]) for r in same} == {(None, 0, None)}
    huge = spark.createDataFrame([(1, [1e30]), (2, [-1e30]), (3, [0.0])], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    assert {r["deviation"] for r in whiten.whitened(huge).collect()} >= {None}


def test_rank_one_updates_follow_the_scatter():
    rng = np.random.default_rng(1)
    for x in (rng.integers(-9, 9, (150, 12)), rng.integers(0, 2, (80, 5)), np.ones((9, 4)), np.repeat(rng.integers(-5, 5, (3, 8)), 30, 0),
              rng.normal(size=(50, 6)) * 10.0 ** np.arange(6)):
        parts = []
        for rows in np.array_split(x.astype(float), 3):
            s = spectra.Spectrum(x.shape[1])
            for row in rows:
                s.add(row)
            parts.append(s)
        s = parts[0].combine(parts[1]).combine(parts[2])
        away = x - x.mean(axis=0)
        size = max(np.abs(away.T @ away).max(), 1)
        assert s.count == len(x) and np.allclose(s.mean, x.mean(axis=0))
        assert np.abs(s.vectors * s.values @ s.vectors.T - away.T @ away).max() < 1e-9 * size
        assert np.abs(s.vectors.T @ s.vectors - np.eye(x.shape[1])).max() < 1e-12


# --- phrase fingerprints ----------------------------------------------------------

def phrases(data):
    found, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in found:
            found.add(data[start:end])
            start = end
    return found


def printed(text):
    """A fingerprint from the set of phrases, one by one."""
    import zlib

    least = [0xFFFFFFFF] * lz_print.SLOTS
    found = phrases((text or "").encode())
    times, plus = lz_print.TIMES[:, 0].tolist(), lz_print.PLUS[:, 0].tolist()
    for phrase in found:
        x = zlib.crc32(phrase)
        x = (x ^ (x >> 16)) * 0x85EBCA6B & 0xFFFFFFFF
        x ^= x >> 13
        least = [min(m, (a * x + b) & 0xFFFFFFFF) for m, a, b in zip(least, times, plus)]
    return lz_print.slots(np.array(least, np.uint32), not found).hex()


def test_fingerprints_equal_plain_parsing(docs, real):
    for table in (docs.where("doc_id IS NOT NULL AND (doc_id <> 10)"), real):
        rows = sorted((r["doc_id"], r["text"] or "") for r in table.collect())
        prints = [printed(t) for _, t in rows]
        share = lambda a, b: np.mean([a[i:i + 4] == b[i:i + 4] for i in range(0, len(a), 4)])
        want = {}
        for at, (doc_id, text) in enumerate(rows):
            after = (at + 1) % len(rows)
            k = len(text) // 4
            edited = text[:len(text) - k] + rows[after][1][:k]
            mark = printed(edited)
            want[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[at], mark,
                            share(prints[at], mark), share(prints[at], prints[after]))
        for frame in (table, table.repartition(7)):
            got = {r["doc_id"]: tuple(r)[1:] for r in lz_print.phrase_fingerprints(frame).collect()}
            assert got == want


def test_likeness_follows_the_phrase_sets(real):
    """Estimates lie near the similarity of the sets, and edits stand apart from neighbours."""
    rows = sorted((r["doc_id"], r["text"] or "") for r in real.collect())
    got = {r["doc_id"]: r for r in lz_print.phrase_fingerprints(real).collect()}
    away = []
    for (i, a), (_, b) in zip(rows, rows[1:]):
        x, y = phrases(a.encode()), phrases(b.encode())
        if x and y:
            away.append(got[i]["near_next"] - len(x & y) / len(x | y))
    assert abs(np.mean(away)) < 0.02 and np.abs(away).max() < 0.2
    assert np.mean([r["near_edited"] > r["near_next"] for r in got.values()]) > 0.98


def test_fingerprints_of_nothing_copies_and_very_long_texts(spark, docs):
    assert lz_print.phrase_fingerprints(docs.limit(0)).count() == 0
    one = lz_print.phrase_fingerprints(docs.where("doc_id = 5")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
    assert lz_print.phrase_fingerprints(docs).count() == docs.count()
    long = spark.createDataFrame([(1, "a" * 3_000_000), (2, "ab" * 1_000_000), (3, None), (4, ""), (5, "a" * 3_000_000), (5, "b")],
                                 "doc_id BIGINT, text STRING")
    got = sorted(lz_print.phrase_fingerprints(long).collect(), key=lambda r: (r["doc_id"], -r["n_chars"]))
    assert got[0]["fingerprint"] == got[4]["fingerprint"] != got[1]["fingerprint"]
    assert got[2]["fingerprint"] == got[3]["fingerprint"] and got[2]["near_next"] == 1 and got[2]["near_edited"] == 1
    assert got[1]["near_next"] == 0
