"""Operators 11 to 13 against the library or brute force, and awkward rows."""

from __future__ import annotations

import hashlib
import math
import time
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import ROWS, SF, frame
from strata.llm import codes, intvec, orchard, pieces, registry

# SentencePiece

PATH = public_tokenizers.path(pieces.MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def _piece_row(library, doc_id, text):
    ids = library.encode(text or "")
    digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return doc_id, len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_piece_query_equals_the_library(spark, library):
    for sf in (SF, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
        got = registry.queries()["op11_sentencepiece"](spark, sf)
        assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert sorted(map(tuple, got.collect())) == sorted(_piece_row(library, *r) for r in docs)


def test_pieces_awkward_rows(spark, library):
    rows = [*ROWS, (20, "▁▁a ▁ b▁", "x"), (21, "   lead  and trail  ", "x"), (22, "<s></s><unk><0x41>", "x"), (23, "\0\t\r\n", "x")]
    got = pieces.encode_pieces(frame(spark, rows)).collect()
    want = [_piece_row(library, *r[:2]) for r in rows]
    assert sorted(map(repr, (tuple(r)[:4] for r in got))) == sorted(map(repr, want))
    texts = {(r["doc_id"], r["ids_sha256"]): r for r in got}
    for (doc_id, text, _), w in zip(rows, want):
        r = texts[doc_id, w[2]]
        assert list(r["ids"]) == library.encode(text or "") and r["decoded"] == library.decode(list(r["ids"]))
    assert pieces.encode_pieces(frame(spark).where("false")).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from(["▁", " ", "  ", "the", "ing", "日本", "\n", "<s>", "'s", "12", "é", "  the"])), max_size=12))
def test_pieces_of_any_text(parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    library, m = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.model(PATH)
    ids = library.encode(text)
    assert m.encode(text) == ids and m.decode(ids) == library.decode(ids)
    assert m._merged(text) == m._merged_word(text)


def test_long_runs_and_a_full_table(library, monkeypatch):
    m = pieces.Model(PATH)
    for text in ("ab" * 100_000, " " * 100_000 + "x", "x" + " " * 100_000, "日" * 100_000):
        t0 = time.perf_counter()
        assert m.encode(text) == library.encode(text)
        assert time.perf_counter() - t0 < 20
    monkeypatch.setattr(pieces, "ENTRIES", 3)
    for text in ("a b c d e f g a b c", "a b", "c d e x y a b"):
        assert m.encode(text) == library.encode(text)
        assert len(m.known) + len(m.older) < 40


def test_pieces_that_cross_markers_make_the_text_one_chunk(library):
    m = pieces.Model(PATH)
    m.chunks = pieces.re.compile("(?s:.+)").findall  # as for a model whose pieces cross
    for text in ("a b  c\nd", "", " "):
        assert m.encode(text) == library.encode(text)


# Integer vectors: shared by vector codes and clusters

VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int, v int, codes string, cluster string, error string, distance int"


def _vector_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", "k", "e", 2) for r in rows], VECTOR_SCHEMA)


def _random_rows(n, dims, seed, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=dims) / 4], int(rng.integers(0, 4))) for i in rng.permutation(n) * 3]
    return rows + rows[:copies]


def _usable(rows, dims):
    return [r for r in rows if r[1] is not None and len(r[1]) == dims and all(x is not None and math.isfinite(x) for x in r[1])]


def _sql_rows(sf, sql, columns):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    return sorted(c.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_centroid_clusters"])
def test_vector_queries_equal_sql(spark, name):
    for sf in (SF, "/root/testdata/sf0.01"):
        got = registry.queries()[name](spark, sf)
        assert sorted(map(tuple, got.collect())) == _sql_rows(sf, registry.oracle_sql()[name], got.columns)


AWKWARD = [
    (None, [0.25] * 64, None),
    (None, [0.125] * 64, 1),
    (5, None, 1),
    (6, [], 1),
    (7, [0.5] * 63 + [None], 2),
    (8, [0.5] * 63 + [float("nan")], 2),
    (9, [float("inf")] + [0.5] * 63, None),
    (10, [0.5] * 32, 2),
    (11, [0.0] * 64, None),
    (11, [0.0] * 64, None),
    (11, [-0.0001] * 64, 3),
    (12, [1e9] + [0.0] * 63, 3),
]


# Vector codes


def test_exact_products_of_large_integers():
    rng = np.random.default_rng(3)
    for width, top in ((8, 4096), (8, 2**29), (64, 2**27), (1, 2**31 - 1), (1000, 2**25)):
        a, b = (rng.integers(-top, top + 1, size=(40, width)) for _ in range(2))
        a[0], b[0] = top, -top
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert codes.exact_product(a, b).tolist() == want
    for bits in (3, 25):
        m = rng.integers(-(2**30), 2**30, size=(5, 5))
        parts = codes.limbs(m, bits)
        assert all((0 <= p).all() and (p < 2**bits).all() for p in parts[:-1]) and (abs(parts[-1]) <= 2**bits).all()
        assert (sum(p.astype(np.int64) << (bits * i) for i, p in enumerate(parts)) == m).all()


def _codes_by_hand(rows, dims, parts=8, entries=16, rounds=6, scale=4096):
    bound = intvec.largest(dims)
    ints = [[max(-bound, min(bound, math.floor(scale * x))) for x in r[1]] for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, ints[i]))
    w = dims // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for v in ints]
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((x - y) ** 2 for x, y in zip(a, e)), k) for k, e in enumerate(books[p])) for p, a in enumerate(c)] for c in cut]

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, n in zip(cut, near) if n[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    near = assign()
    out = [(r[0], "".join(f"{k:02x}" for _, k in n), sum(d for d, _ in n), r[2]) for r, n in zip(rows, near)]
    sums = Counter()
    for r in out:
        sums[r[3]] += r[2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((*r[:3], sums[r[3]], digest) for r in out), key=repr)


def _coded(spark, df, monkeypatch):
    monkeypatch.setattr(codes, "table", lambda *a: df)
    return sorted(map(tuple, codes.op12_vector_codes(spark, "").collect()), key=repr)


@pytest.mark.parametrize("rows", [_random_rows(60, 64, 1, 20) + AWKWARD, _random_rows(9, 64, 2), _random_rows(40, 16, 3), AWKWARD[:2], [(1, [2.0] * 8, None)] * 20])
def test_codes_by_hand(spark, monkeypatch, rows):
    dims = 64 if len(rows[0][1]) == 64 else len(rows[0][1])
    assert _coded(spark, _vector_frame(spark, rows), monkeypatch) == _codes_by_hand(_usable(rows, dims), dims)


def test_codes_of_no_vectors_and_what_they_stand_for(spark, monkeypatch):
    assert _coded(spark, _vector_frame(spark, AWKWARD).where("false"), monkeypatch) == []
    assert _coded(spark, _vector_frame(spark, [(1, [0.5] * 7, 1), (2, None, 1), (3, [], 1)]), monkeypatch) == []
    rows = _random_rows(16, 64, 5)
    out, books = codes.compress(_vector_frame(spark, rows))
    by_id = {r["vec_id"]: r["codes"] for r in out.collect()}
    back = books.decoded(np.array([by_id[r[0]] for r in rows]))
    assert np.abs(back - np.array([r[1] for r in rows])).max() <= 0.5 / 4096 + 1e-9  # as many entries as vectors


def test_label_totals_with_a_hot_label(spark):
    rows = [(i, None if i % 3 == 0 else i % 50, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, label int, error long").repartition(6)
    sums = Counter()
    for _, label, e in rows:
        sums[label] += e
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = intvec.with_group_total(df, "label", "error", "total", 20).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((*r, sums[r[1]])) for r in rows)


# Centroid clusters


def _clusters_by_hand(rows, dims=64, k=16, rounds=3, scale=64, seed=1):
    bound = intvec.largest(dims)
    ints = [[max(-bound, min(bound, math.floor(scale * x))) for x in r[1]] for r in rows]
    draw = [None if r[0] is None else hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (draw[i] is None, draw[i] or "", ints[i]))
    centers = [ints[i] for i in order[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), i) for i, c in enumerate(centers)) for v in ints]

    for _ in range(rounds):
        near = assign()
        for i in range(len(centers)):
            mine = [v for v, n in zip(ints, near) if n[1] == i]
            if mine:
                centers[i] = [sum(x) // len(mine) for x in zip(*mine)]
    near = assign()
    of = Counter()
    for d, c in near:
        of[c] += d
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((r[0], c, d, of[c], sum(of.values()), text[c]) for r, (d, c) in zip(rows, near)), key=repr)


def _clustered(spark, df, monkeypatch):
    monkeypatch.setattr(orchard, "table", lambda *a: df)
    return sorted(map(tuple, orchard.op13_centroid_clusters(spark, "").collect()), key=repr)


@pytest.mark.parametrize("rows", [_random_rows(80, 64, 1, 20) + AWKWARD, _random_rows(9, 64, 2), [(1, [0.5] * 64, 1)], [(1, [0.5] * 64, 1)] * 30 + AWKWARD])
def test_clusters_by_hand(spark, monkeypatch, rows):
    assert _clustered(spark, _vector_frame(spark, rows), monkeypatch) == _clusters_by_hand(_usable(rows, 64))


def test_clusters_of_no_vectors(spark, monkeypatch):
    assert _clustered(spark, _vector_frame(spark, AWKWARD).where("false"), monkeypatch) == []
    assert _clustered(spark, _vector_frame(spark, [(1, [0.5] * 63, 1), (2, None, 1)]), monkeypatch) == []


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 12), st.integers(1, 4), st.integers(1, 6), st.randoms(use_true_random=False))
def test_orchard_search_with_ties(k, dims, spread, rnd):
    point = lambda: [rnd.randint(-spread, spread) for _ in range(dims)]
    centers, m = np.array([point() for _ in range(k)]), np.array([point() for _ in range(30)])
    to, distance, _ = orchard.Lists(centers).nearest(m)
    want = [min((int(((v - c) ** 2).sum()), i) for i, c in enumerate(centers)) for v in m]
    assert [(int(d), int(c)) for d, c in zip(distance, to)] == want


def test_orchard_search_measures_few_distances():
    rng = np.random.default_rng(4)
    centers = rng.integers(-2000, 2000, size=(64, 8))
    m = centers[rng.integers(0, 64, 2000)] + rng.integers(-30, 30, size=(2000, 8))
    to, _, measured = orchard.Lists(centers).nearest(m)
    assert (to == ((m[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert measured < 2000 * 64 / 2
