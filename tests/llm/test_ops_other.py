"""Operators 1, 3, 4, 7, 10 against brute force, and awkward rows."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
import re
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import LONG, ROWS, SF, cosine_groups, frame, words
from strata.llm import quality, registry, tokencount, urls, vectors, warc

SPACE = re.compile(r"[^\x20\x09-\x0D]")

# URL filters

RULES = [*urls.RULES, ("b.com/a", "block"), ("com/a/b/", "block"), ("com/a/b/", "allow"), ("Example.ORG", "block"), ("x.y.z.com/long/path/in", "block")]


def _url_row(url, rules):
    after = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        h, p = h.lower(), "/" + p if "/" in rule else ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (), (len(rule), len(h), verdict, rule))
    return host, path, best and best[3], best[2] if best else "allow"


def test_url_query_equals_sql(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        c = duckdb.connect()
        c.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
        cols = ["page_id", "host", "path", "rule", "verdict"]
        want = c.execute(registry.oracle_sql()["op1_url_filter"]).df()[cols]
        got = registry.queries()["op1_url_filter"](spark, sf).toPandas()[cols]
        clean = [Counter(tuple(None if x != x else x for x in r) for r in d.itertuples(index=False)) for d in (got, want)]
        assert clean[0] == clean[1]


def test_urls_awkward_rows(spark):
    urls_ = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "http://example.com/en", "http://example.com/en/",
        "http://a.b.com/abc", "http://b.com/a", "http://xb.com/a", "http://q.com/a/b/c", "x://y://z.net/es/", "http://u:p@h.net:80/fr/",
        "http://example.org", "http://sub.example.org?x", "http://x.y.z.com/long/path/into", "http://" + "a." * 3000 + "com/" + "d/" * 3000,
        "http://é.com/ß", "http://com/", "http://com", "http:///en/", "http://a.net/es/\nx", "http://.com/",
    ]
    rows = [(i, u) for i, u in enumerate(urls_)] + [(4, urls_[4])] * 3 + [(None, "http://b.com/a"), (None, None)]
    df = spark.createDataFrame([(*r, "h", 1, "r") for r in rows], "page_id long, url string, host string, n int, rule string")
    got = Counter(tuple(r) for r in urls.judge(df, urls.rules_frame(spark, RULES)).collect())
    assert got == Counter((i, *_url_row(u, RULES)) for i, u in rows)
    none = urls.judge(df, urls.rules_frame(spark, [])).collect()
    assert len(none) == len(rows) and {r["verdict"] for r in none} == {"allow"}
    assert urls.judge(df.where("false"), urls.rules_frame(spark)).count() == 0


def test_url_rules_in_a_shuffled_join(spark):
    rules = [(f"host{i}.com/p{i % 7}/", "block") for i in range(500)] + RULES
    rows = [(i, f"http://sub.host{i % 600}.com/p{i % 5}/x") for i in range(1500)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = Counter(tuple(r) for r in urls.judge(df, urls.rules_frame(spark, rules)).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == Counter((i, *_url_row(u, rules)) for i, u in rows)


# WARC


def _warc(rows, min_bytes=0):
    of = defaultdict(list)
    for i, _, h in rows:
        of[(h or "").encode()].append(i)
    out = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        ids = [x for x in of[data] if x is not None]
        first = max(ids) if len(of[data]) > 1 and ids and len(data) >= min_bytes else None
        again = first is not None and first != i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[(i, len(data), digest, "revisit" if again else "response", first if again else None)] += 1
    return out


def _read(spark, path):
    revisit = F.col("record_type") == "revisit"
    return warc.read(spark, path).select(
        warc.page_of(F.col("record_id")),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("payload_bytes")),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("payload_digest")),
        "record_type",
        warc.page_of(F.col("refers_to")),
    )


def test_warc_query(spark):
    got = registry.queries()["op3_warc"](spark, SF)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    assert Counter(tuple(r) for r in got.collect()) == _warc([(p["page_id"], p["url"], p["html"]) for p in pages])


FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 10\r\n\r\n0123456789\r\n\r\n"


@pytest.mark.parametrize("split", ["20000", "128m"])
def test_warc_magic_in_payloads(spark, tmp_path, split):
    rng = random.Random(1)
    bodies = [
        lambda: None, lambda: "", lambda: "dup", lambda: "a" * rng.randint(1, 30_000), lambda: FAKE * rng.randint(1, 40),
        lambda: "x" + FAKE + "WARC/1.0\r\n", lambda: "é日本" * rng.randint(1, 3000),
        lambda: "WARC/1.0\r\nContent-Length: 999999\r\n\r\n" + "z" * 2000,
        lambda: "WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 30,
    ]
    rows = [(i, f"http://x.com/{i}", rng.choice(bodies)()) for i in range(200)]
    rows += [(None, None, "dup"), (5, "u", "dup"), (None, "a b\r\nc", "uniq"), (7, "u", LONG), (7, "u", LONG)]
    df = spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id long, url string, html string, n int, digest string")
    warc.write(df.repartition(3), f"{tmp_path}/w")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert Counter(tuple(r) for r in _read(spark, f"{tmp_path}/w").collect()) == _warc(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_warc_smaller_payloads_are_all_responses(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/w", min_bytes=3)
    assert Counter(tuple(r) for r in _read(spark, f"{tmp_path}/w").collect()) == _warc(rows, 3)


def test_warc_stops_at_a_broken_record(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"body{i}") for i in range(5)], "page_id long, url string, html string")
    warc.write(df.coalesce(1), f"{tmp_path}/w")
    (part,) = (p for p in (tmp_path / "w").iterdir() if p.name.startswith("part"))
    data = part.read_bytes()
    cut = tmp_path / "cut"
    cut.mkdir()
    (cut / "a.warc").write_bytes(data[:-30])
    (cut / "b.warc").write_bytes(b"junk" + data)
    got = Counter(r["file"].rsplit("/", 1)[1] for r in warc.read(spark, str(cut)).collect())
    assert got == {"a.warc": 4}


def test_warc_line_ends_in_urls(spark, tmp_path):
    rows = [(i, f"http://x.com/{i}", f"<p>{i}</p>") for i in range(20)]
    for i, sign in enumerate("\u0085\u2028\u2029\n\r\x0b\x0c"):
        rows[5 + i] = (5 + i, f"http://x.com/{sign}Content-Length:5{sign}WARC-Type: revisit", f"<p>{i}</p>")
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert warc.write(df, f"{tmp_path}/w") == 20
    assert Counter(tuple(r) for r in _read(spark, f"{tmp_path}/w").collect()) == _warc(rows)
    assert warc.read(spark, f"{tmp_path}/w", expected=20).where("target_uri like '%\u2028%'").count() == 0
    with pytest.raises(warc.LostRecords, match="20 records read, 21 written"):
        warc.read(spark, f"{tmp_path}/w", expected=21)


def test_warc_empty_table(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/w")
    assert warc.read(spark, f"{tmp_path}/w").count() == 0


# Token counts


def _best_count(s, scores, unknown):
    """Highest total over all segmentations, by trying every cut."""
    best = (0.0, 0)
    out = None
    for cuts in itertools.product((0, 1), repeat=max(0, len(s) - 1)):
        at, total, n = 0, 0.0, 0
        for end in [i + 1 for i, c in enumerate(cuts) if c] + [len(s)]:
            piece = s[at:end]
            if piece in scores:
                total, n = total + scores[piece], n + 1
            elif len(piece) == 1:
                total, n = total + unknown, n + len(piece.encode())
            else:
                break
            at = end
        else:
            if out is None or total > out[0]:
                out = (total, {n})
            elif total == out[0]:
                out[1].add(n)
    return out or best


def test_token_counts_are_the_best_segmentations():
    c = tokencount.counter(public_tokenizers.path(tokencount.MODEL))
    rng = random.Random(1)
    parts = ["the", "ing", "é", "日", "😀", "\n", "a", "tion", "ß", "x", "क्ष"]
    for _ in range(300):
        s = "▁" + "".join(rng.choice(parts) for _ in range(rng.randint(0, 4)))[:11]
        assert c.count(s) in _best_count(s, c.scores, c.unknown)[1]


def test_token_counts_of_texts(spark):
    c = tokencount.counter(public_tokenizers.path(tokencount.MODEL))

    def plain(text):
        parts = tokencount.pre_tokens(text)
        assert "".join(parts) == ("▁" + text.replace(" ", "▁") if text else "")
        n = 0
        for p in parts:
            best, tokens = [0.0], [0]
            for end in range(1, len(p) + 1):
                b, t = c._forward(p, end, best, tokens)
                best.append(b)
                tokens.append(t)
            n += tokens[-1]
        return len(parts), n

    got = tokencount.token_counts(frame(spark, ROWS + [(50, "x" * 5000 + "日" * 3000, "a")])).collect()
    want = Counter((i, *plain(t)) for i, t, _ in ROWS + [(50, "x" * 5000 + "日" * 3000, "a")])
    assert Counter(tuple(r) for r in got) == want
    assert tokencount.token_counts(frame(spark, [])).count() == 0
    rows = registry.queries()["op4_token_counts"](spark, SF).collect()
    docs = {d["doc_id"]: d["text"] for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    assert {r["doc_id"]: (r["n_pre_tokens"], r["n_tokens"]) for r in rows} == {k: plain(t) for k, t in docs.items()}


def test_trie_shares_prefixes_and_is_bounded(monkeypatch):
    c = tokencount.Counter({"▁": -1.0, "a": -1.0, "b": -1.0, "ab": -1.5, "▁ab": -1.7})
    assert [c.count(p) for p in ("▁ab", "▁abab", "▁aba")] == [1, 2, 2]
    assert len(c.best) == 1 + 5  # the root and one node a prefix
    monkeypatch.setattr(tokencount, "NODES", 10)
    monkeypatch.setattr(tokencount, "REMEMBERED", 5)
    for i in range(50):
        assert c.count("▁" + f"{i:06b}".replace("0", "a").replace("1", "b")) > 0
        assert len(c.best) <= 10 + 8 and len(c.counts) <= 5


# Quality


def _figures(text):
    text = text or ""
    ws = words(text)
    wins = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    n, hit = Counter(wins), set()
    for i, w in enumerate(wins):
        if n[w] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return (
        len(ws), sum(map(len, ws)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit),
        len(ws) < 20 or 100 * len(hit) > 30 * len(ws),
    )


def test_quality_query(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        rows = registry.queries()["op7_quality_rules"](spark, sf).collect()
        docs = {d["doc_id"]: d["text"] for d in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
        assert {r["doc_id"]: tuple(r)[1:7] for r in rows} == {i: _figures(t) for i, t in docs.items()}
        assert not any(r["kept"] and r["base_failed"] for r in rows)
    labels = pq.read_table(f"{sf}/labels.parquet").to_pylist()
    by = {r["doc_id"]: r for r in rows}
    good = [by[x["doc_id"]] for x in labels if x["quality"] and not by[x["doc_id"]]["base_failed"]]
    poor = [by[x["doc_id"]] for x in labels if not x["quality"]]
    assert np.mean([r["kept"] for r in good]) > 0.97 and np.mean([r["kept"] for r in poor]) < 0.1


def test_quality_awkward_rows(spark):
    rows = ROWS + [
        (20, "one two three four five six seven eight " * 2, "a"),
        (21, "a b c d e f g h " + "x " * 30 + "a b c d e f g h", "a"),
        (22, "line\n line\nline\n\n \nline", "a"),
        (23, "x " * 7, "a"),
    ]
    got = quality.quality(frame(spark, rows)).collect()
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter((r["doc_id"], *(r[c] for c in base)) for r in got) == Counter((i, *_figures(t)) for i, t, _ in rows)
    assert all(0 <= r["quality"] <= 1 for r in got)
    assert quality.quality(frame(spark, [])).count() == 0


def _estimated(v):
    """Expectation-maximisation in numpy: posterior of good, share, vote tables."""
    p, last = np.where((v == -1).any(1), 0.1, 0.9), None
    while True:
        share = (p.sum() + 1) / (len(p) + 2)
        table = [np.array([[(w * (v[:, j] == x)).sum() + 1 / 3 for x in (-1, 0, 1)] for w in (1 - p, p)]) for j in range(v.shape[1])]
        table = [t / t.sum(1, keepdims=True) for t in table]
        logs = np.log([1 - share, share]) + sum(np.log(t[:, v[:, j] + 1]).T for j, t in enumerate(table))
        p = 1 / (1 + np.exp(logs[:, 0] - logs[:, 1]))
        now = np.logaddexp(logs[:, 0], logs[:, 1]).sum()
        if last is not None and now - last < quality.CONVERGED * abs(last):
            return p, share, table
        last = now


def _noisy(rng, good):
    right = (0.95, 0.9, 0.85, 0.8, 0.6)
    n = len(good)
    return np.stack([np.where(rng.random(n) < 0.3, 0, np.where(rng.random(n) < a, good, ~good) * 2 - 1) for a in right], 1)


def _careful(rng, good):
    # quality rules: they seldom call a good document bad, and miss many bad ones
    hits, slips = (0.65, 0.55, 0.5, 0.45, 0.4), (0.01, 0.02, 0.01, 0.03, 0.02)
    votes = []
    for hit, slip in zip(hits, slips):
        bad = rng.random(len(good)) < np.where(good, slip, hit)
        votes.append(np.where(bad, -1, np.where(rng.random(len(good)) < 0.15, 0, 1)))
    return np.stack(votes, 1)


@pytest.mark.parametrize("planted", [_noisy, _careful])
def test_expectation_maximisation(spark, planted):
    """The estimate equals the same rounds in numpy, and finds planted accuracies."""
    rng = np.random.default_rng(4)
    good = rng.random(4000) < 0.7
    names = [f"r{i}" for i in range(5)]
    v = planted(rng, good)
    df = spark.createDataFrame([tuple(map(int, r)) for r in v], ", ".join(f"vote_{n} int" for n in names))
    got = quality.estimate(df, names)
    p, share, table = _estimated(v)
    assert abs(got.good - share) < 1e-9
    for j, n in enumerate(names):
        assert np.allclose(got.votes[n], table[j], atol=1e-9)
    assert np.mean((p > 0.5) == good) > 0.9 and abs(share - 0.7) < 0.05
    found = [got.votes[n][0][0] for n in names]  # bad documents that each rule calls bad
    assert found == sorted(found, reverse=True) and found[0] > found[-1] + 0.1


def test_quality_posterior_by_hand(spark):
    """Posterior and verdict of the whole table, recomputed from its votes."""
    rows = quality.quality(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    v = np.array([[r[f"vote_{n}"] for n in quality.rules()] for r in rows])
    p, _, _ = _estimated(v)
    assert np.allclose([r["quality"] for r in rows], p, atol=1e-6)
    assert [r["kept"] for r in rows] == [bool(x >= quality.KEEP) and not r["base_failed"] for x, r in zip(p, rows)]


def test_classes_are_told_apart_by_their_bad_votes(spark):
    e = quality.Estimate(0.2, {"a": [[0.1, 0.1, 0.8], [0.7, 0.1, 0.2]]})
    assert quality._oriented(e) == quality.Estimate(0.8, {"a": [[0.7, 0.1, 0.2], [0.1, 0.1, 0.8]]})


@pytest.mark.parametrize("text", ["a" + " " * 1_000_000 + "b", "a b " + " \t" * 500_000, " \n" * 500_000, "x " * 500_000])
def test_long_white_space_is_linear(spark, text):
    from strata.llm import mixing

    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    t0 = time.perf_counter()
    r = quality.figures(df).select("n_words", "word_chars").first()
    assert tuple(r) == (len(text.split()), sum(map(len, text.split())))
    assert df.select(mixing.words(F.col("text"))).first()[0] == len(text.split())
    assert time.perf_counter() - t0 < 20


# Embeddings


def _vector_rows(vecs, ids=None):
    ids = ids or list(range(len(vecs)))
    links, root = cosine_groups(vecs, 0.9)
    least = defaultdict(list)
    for i, r in root.items():
        if ids[i] is not None:
            least[r].append(ids[i])
    out = Counter()
    for i, v in enumerate(vecs):
        c = min(least[root[i]], default=None)
        out[(ids[i], links[i], c, ids[i] == c)] += 1
    return out


@pytest.mark.parametrize("block", [16, 4096])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "BLOCK_NUMBERS", 16 * 64)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    vecs = [list(map(float, centres[rng.integers(6)] + rng.normal(size=8) * rng.choice([0.02, 0.2, 0.5]))) for _ in range(260)]
    vecs += [vecs[0]] * 30 + [[2 * x for x in vecs[1]]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>")
    assert Counter(tuple(r) for r in vectors.near_duplicates(df).collect()) == _vector_rows(vecs)


def test_vector_query(spark):
    rows = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    got = registry.queries()["op10_embedding_near_dedup"](spark, SF)
    want = _vector_rows([r["embedding"] for r in rows], [r["vec_id"] for r in rows])
    assert Counter(tuple(r) for r in got.collect()) == want


def test_vectors_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    vecs = [
        None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 0.0], [1.0, 0.0], [1e-200, 0.0], [1e200, 1e199],
        [-1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 3.0], [5.0], [2.0], [-0.0, 1.0], [0.0, 1.0],
    ]
    ids = [*range(len(vecs) - 2), None, None]
    links, root = cosine_groups([v if v is None or not any(abs(x or 0) > 1e100 or 0 < abs(x or 0) < 1e-100 for x in v) else [x * (1e-200 if max(v) > 1 else 1e200) for x in v] for v in vecs], 0.9)
    least = defaultdict(list)
    for i, r in root.items():
        if ids[i] is not None:
            least[r].append(ids[i])
    want = Counter()
    for i in range(len(vecs)):
        c = min(least[root[i]], default=None)
        want[(ids[i], links[i], c, ids[i] == c)] += 1
    df = spark.createDataFrame([(i, v, 1, 0) for i, v in zip(ids, vecs)], "vec_id long, embedding array<double>, copies int, cell int")
    assert Counter(tuple(r) for r in vectors.near_duplicates(df).collect()) == want
    assert vectors.near_duplicates(df.where("false")).count() == 0
    assert vectors.near_duplicates(df.where("vec_id < 6")).count() == 6


def test_dual_traversal_counts():
    rng = np.random.default_rng(1)
    for trial in range(9):
        d, m = int(rng.integers(2, 30)), int(rng.integers(2, 200))
        c = rng.normal(size=(3, d))
        x = c[rng.integers(0, 3, m)] + rng.normal(size=(m, d)) * rng.choice([0.01, 0.1, 0.3, 1.0])
        n, limit = rng.integers(1, 4, m), (0.9, 0.99, 0.5)[trial % 3]
        u = vectors._unit(x)
        near = u @ u.T >= limit
        np.fill_diagonal(near, False)

        def tree(s):
            return vectors.Tree(u[s], n[s], vectors.paths(u[s]))

        everything = slice(0, m)
        links, _, _ = vectors.linked(tree(everything), tree(everything), True, limit)
        assert (links == (near * n).sum(1)).all()
        a, b = slice(0, m // 2), slice(m // 2, m)
        left, right, _ = vectors.linked(tree(a), tree(b), False, limit)
        assert (left == (near[a, b] * n[b]).sum(1)).all() and (right == (near[b, a] * n[a]).sum(1)).all()
