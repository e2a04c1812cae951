"""Conversation repair, embedding near duplicates and whitening against plain Python."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemark.llm import conversation_repair as repair
from tidemark.llm import embedding_dedup, flat_graph, packing, queries, whitening

SF = "/root/testdata/sf0.001"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append(
            "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        )
        seen.add((role, text))
    return out


def _best(initials, faults, most):
    """Least (cost, audit) over every string of edits with at most ``most`` insertions."""
    found = []

    def go(i, state, cost, audit, inserted):
        if i == len(initials) and state in (0, 3):
            found.append((cost, audit))
        if inserted < most:
            for role in "ua":
                if (state, role) in STEP:
                    go(i, STEP[state, role], cost + 3, audit + "I", inserted + 1)
        if i < len(initials):
            go(i + 1, state, cost + 4, audit + "D", inserted)
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                for role in "sua":
                    if (state, role) in STEP:
                        if initials[i] == role:
                            go(i + 1, STEP[state, role], cost + extra, audit + "K", inserted)
                        if role != "s":
                            go(i + 1, STEP[state, role], cost + 3 + extra, audit + "R", inserted)

    go(0, 0, 0, "", 0)
    return min(found)


def _expected(rows, turns):
    faults, initials = _faults(rows), [r[:1] for r, _ in rows]
    cost, audit = _best(initials, faults, 3)
    lines, state, left = [], 0, iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == 2 else "user"
        state = STEP[state, role[:1]]
        lines.append(f"{role}:{text}")
    known = [t for t in turns if t is not None]
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def _check(spark, rows, found):
    by_conv = {}
    for conv, *rest in _damaged(rows):
        by_conv.setdefault(conv, []).append(rest)
    assert len(found) == len({r[0] for r in rows})
    for r in found:
        mine = sorted(
            by_conv.get(r["conv_id"], []),
            key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).hexdigest()),
        )
        want = _expected([(role, text) for _, role, text in mine], [t for t, _, _ in mine]) if mine else (
            0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
        assert tuple(r)[1:] == want, r["conv_id"]


def test_repair_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    _check(spark, rows, queries.QUERIES["op11_conversation_repair"](spark, SF).collect())


def test_repair_of_odd_rows(spark):
    rows = [
        (1, None, "user", "No turn."), (1, None, "user", "No turn."), (1, 3, "tool", "What?"), (1, 3, "assistant", "Tie."), (1, 2**40, "", "x."),
        (2, 0, None, None), (2, 1, "user", "\t\n"), (2, 2, "user", "é" * 100_000), (None, 0, "system", "Rules."), (None, 1, "user", "Hi!"),
        (3, 0, "assistant", "Yes."), (3, 0, "assistant", "Yes."), (3, 5, "user", "Ends in a line end.\n\n"), (3, 6, "user", "Odd end.\u0085"),
    ]
    rows += [(10 + i, t, role, f"{role} {t}{end}") for i in range(30) for t, (role, end) in enumerate(
        zip(itertools.islice(itertools.cycle(["system", "user", "user", "assistant", "assistant", "tool"]), i % 5, i % 5 + 5), ".!?, "))]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "conv_id long, turn long, role string, text string, k int, blank string")
    _check(spark, rows, repair.damage_and_repair(df).collect())
    assert repair.damage_and_repair(df.where("false")).count() == 0


def test_long_conversations_are_cut_and_joined(spark):
    """Cells of chunks meet as those of the whole; a plain walk over states gives the same."""
    rng = np.random.default_rng(3)
    rows = [repair.Row("suax"[rng.integers(4)], bool(rng.random() < 0.1), bool(rng.random() < 0.1)) for _ in range(2000)]
    best = {i: c for i, c in enumerate(repair.EMPTY_SPAN[0]) if c is not None}
    for r in rows:
        step = repair.row_cells(*r)
        after = {}
        for i, (cost, audit) in best.items():
            for k, c in enumerate(step[i]):
                if c is not None:
                    after[k] = min(after.get(k, (1 << 60, "")), (cost + c[0], audit + c[1]))
        best = after
    assert repair.cheapest(repair.run_cells(rows)) == min(best[k] for k in repair.ENDS if k in best)
    parts = [repair.run_cells(rows[i : i + 137]) for i in range(0, 2000, 137)]
    assert repair.span_cells(parts) == repair.run_cells(rows)
    df = spark.createDataFrame(
        [(1, i, {"s": "system", "u": "user", "a": "assistant", "x": "tool"}[r.initial], f"Row {i}" + ("" if r.truncated else "."))
         for i, r in enumerate(rows)] + [(2, i, "user", "Same.") for i in range(1500)],
        "conv_id long, turn long, role string, text string",
    )
    whole = {r["conv_id"]: r for r in repair.repair(df).collect()}
    plain = [repair.Row(r.initial, False, r.truncated) for r in rows]
    assert (whole[1]["cost"], whole[1]["audit"]) == repair.cheapest(repair.run_cells(plain))
    lines = repair.repaired(((r["role"], r["text"]) for r in df.where("conv_id = 1").orderBy("turn").collect()), whole[1]["audit"])
    assert whole[1]["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert (whole[2]["duplicate"], whole[2]["illegal"], whole[2]["gaps"]) == (1499, 1499, 0)
    assert whole[2]["audit"].count("D") == 1499


def _linked(vectors, threshold):
    """(n_links, component) of (id, label, vector) rows by comparing all pairs."""
    n, comp = [0] * len(vectors), list(range(len(vectors)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    def good(v):
        return bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)

    for i, j in itertools.combinations(range(len(vectors)), 2):
        (_, a, x), (_, b, y) = vectors[i], vectors[j]
        if a is None or a != b or not good(x) or not good(y) or len(x) != len(y):
            continue
        x, y = (np.array(v) / np.abs(v).max() for v in (x, y))
        if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
            n[i] += 1
            n[j] += 1
            comp[find(i)] = find(j)
    parts = {}
    for i, v in enumerate(vectors):
        if v[0] is not None:
            parts[find(i)] = min(parts.get(find(i), v[0]), v[0])
    return [(v[0], n[i], parts.get(find(i)), v[0] is not None and parts.get(find(i)) == v[0]) for i, v in enumerate(vectors)]


def _groups(rng, many, size, spread, dims=16):
    return [c + spread * rng.normal(size=dims) for c in rng.normal(size=(many, dims)) for _ in range(size)]


@pytest.mark.parametrize("limit", [4096, 64])
def test_embedding_links_against_all_pairs(spark, limit):
    """One shard, and overlapping shards with blocks of a dense group."""
    rng = np.random.default_rng(5)
    vectors = [(None, x) for x in _groups(rng, 40, 5, 0.15)]
    vectors += [(int(i % 2), x) for i, x in enumerate(_groups(rng, 60, 4, 0.2))]
    vectors += [(1, x) for x in _groups(rng, 1, 200, 0.02)] + [(0, np.ones(16))] * 30
    rows = [(i, label, [float(c) for c in x]) for i, (label, x) in enumerate(vectors)]
    df = spark.createDataFrame([(*r, "n") for r in rows], "vec_id long, label int, embedding array<double>, node string")
    found = embedding_dedup.near_duplicates(df, limit=limit, target=limit // 2).orderBy("vec_id").collect()
    want = _linked(rows, 0.93)
    links = sum(w[1] for w in want)
    assert all(r["n_links"] <= w[1] for r, w in zip(found, want))
    assert sum(r["n_links"] for r in found) >= 0.99 * links and links > 40_000
    assert sum(r["component_id"] == w[2] for r, w in zip(found, want)) >= 0.99 * len(want)
    assert found[0]["recall"] >= 0.95


def test_embeddings_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 0, [1.0, 0.0]), (2, 0, [2.0, 0.0]), (3, 1, [1.0, 0.0]), (4, None, [1.0, 0.0]), (5, None, [1.0, 0.0]), (6, 0, None), (7, 0, []),
        (8, 0, [0.0, 0.0]), (9, 0, [0.0, 0.0]), (10, 0, [nan, 1.0]), (11, 0, [inf, 1.0]), (12, 0, [None, 1.0]), (13, 0, [1.0, 0.0, 0.0]),
        (14, 0, [1e300, 1.0]), (15, 0, [-1.0, 0.0]), (None, 0, [0.0, 5.0]), (16, 0, [0.0, 5.0]), (16, 0, [0.0, 5.0]), (None, 2, [1.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = sorted((tuple(r)[:4] for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    assert found == sorted(_linked(rows, 0.93), key=str)
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def test_embedding_query_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    found = {tuple(r)[:4] for r in queries.QUERIES["op12_embedding_dedup"](spark, SF).collect()}
    assert found == set(_linked(rows, 0.93))


def test_graph_walks_find_their_range():
    rng = np.random.default_rng(2)
    x = flat_graph.unit(np.array(_groups(rng, 150, 6, 0.1, 32) + list(rng.normal(size=(600, 32)))))
    near = flat_graph.build(x)
    assert (near < len(x)).all() and not (near == np.arange(len(x))[:, None]).any()
    found = flat_graph.in_range(x, near, flat_graph.undirected(near), np.arange(len(x)), flat_graph.medoid(x), 0.93)
    truth = x @ x.T >= 0.93
    assert not (found & ~truth).any() and (found | found.T)[truth].mean() >= 0.99


def _whitened(rows):
    """Plain whitening: (n, deviation by id, projections by id, shares)."""
    x = {i: np.floor(256 * np.array(v)).astype(np.int64) for i, v in rows}
    fit = np.unique(np.stack(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:4]
    w = vectors[:, order] / np.sqrt(values[order])
    return n, {i: int(((n * v - sums) ** 2).sum()) for i, v in x.items()}, {i: (v - sums / n) @ w for i, v in x.items()}, values[order] / values.sum()


def test_whitening_query_against_numpy(spark):
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, deviation, projected, shares = _whitened(rows)
    found = queries.QUERIES["op13_whitening"](spark, SF).collect()
    assert len(found) == 4 * len(rows)
    for c in range(4):
        mine = [r for r in found if r["component"] == c + 1]
        got, want = (np.array(v) for v in ([r["whitened"] for r in mine], [projected[r["vec_id"]][c] for r in mine]))
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-9
        assert all(r["n"] == n and r["deviation"] == deviation[r["vec_id"]] for r in mine)
        assert abs(mine[0]["explained"] - shares[c]) < 1e-9 and mine[0]["identity_error"] < 1e-9


def test_whitening_over_many_blocks(spark, monkeypatch):
    """Blocks of seven rows, three of them a task of the product; copies do not count in the fit."""
    monkeypatch.setattr(whitening, "MOST_ROWS", 7)
    monkeypatch.setattr(whitening, "SPLIT_BLOCKS", 3)
    rng = np.random.default_rng(9)
    base = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(500, 6)) * [9, 6, 4, 3, 2, 1])]
    rows = base + [(1000 + i, base[0][1]) for i in range(300)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, block int").repartition(9)
    n, deviation, projected, _ = _whitened(rows)
    found = whitening.whiten(df).collect()
    assert len(found) == 4 * len(rows) and found[0]["n"] == n == 500
    assert all(r["deviation"] == deviation[r["vec_id"]] for r in found)
    for c in range(4):
        got, want = zip(*[(r["whitened"], projected[r["vec_id"]][c]) for r in found if r["component"] == c + 1])
        got, want = np.array(got), np.array(want)
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-9


def test_whitening_without_variance(spark):
    nan = float("nan")
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whitening.whiten(df).orderBy(F.col("vec_id").asc_nulls_first(), "component").collect()
    assert [(r["vec_id"], r["component"]) for r in found] == [(i, c) for i in (None, 1, 2) for c in (1, 2)]
    assert all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None for r in found)
    flat = whitening.whiten(spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")).collect()
    assert {r["component"]: r["whitened"] is None for r in flat} == {1: False, 2: True}
    assert {r["component"]: r["explained"] for r in flat} == {1: 1.0, 2: 0.0} and flat[0]["identity_error"] < 1e-9
    assert whitening.whiten(df.where("vec_id > 2")).count() == 1 and whitening.whiten(df.where("false")).count() == 0
    far = whitening.whiten(spark.createDataFrame([(1, [1e12, 0.0]), (2, [0.0, 1.0]), (3, [1e300, 1.0])], "vec_id long, embedding array<double>")).collect()
    assert all(r["deviation"] is None for r in far)


def test_packing_program_reaches_the_lower_bound(spark):
    """At sf0.1 the rounded program needs as many sequences as the sum of lengths, and uses its configurations."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lengths = packing.pieces(docs).groupBy("length").count().collect()
    histogram = {r["length"]: r["count"] for r in lengths}
    solution = packing.fractional_solution(histogram, packing.CAPACITY)
    assert 0 <= solution.gap < 0.05 and sum(int(x) for x in solution.used.values()) > 0.5 * solution.bound
    groups = packing.rounded(histogram, packing.CAPACITY, solution)
    used = {}
    for pattern, copies in groups:
        assert sum(s * m for s, m in pattern.items()) <= packing.CAPACITY
        for s, m in pattern.items():
            used[s] = used.get(s, 0) + m * copies
    assert used == histogram
    assert sum(copies for _, copies in groups) == -(-sum(s * n for s, n in histogram.items()) // packing.CAPACITY)


def test_packing_of_few_and_many_lengths():
    for histogram in ({}, {4096: 3}, {1: 5}, {4096: 1, 1: 1}, {2049: 7, 2047: 7}, {1000: 1_000_000, 96: 250_000, 3000: 10}):
        groups = packing.plan(histogram)
        used = {}
        for pattern, copies in groups:
            assert 0 < sum(s * m for s, m in pattern.items()) <= 4096
            for s, m in pattern.items():
                used[s] = used.get(s, 0) + m * copies
        assert used == histogram
    assert sum(copies for _, copies in packing.plan({1000: 1_000_000, 96: 250_000, 3000: 10})) <= 250_010


def test_words_are_encoded_as_whole_texts():
    """Cut and named words give the ids that the tokenizer gives for the text."""
    from tidemark.llm.tokens import WordEncoder, tokenizer_path
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path(None))
    texts = [
        None, "", " \t", "İstanbul. J̌. TÉST! don't. abc123,45.6 l'eau (été) 5's x_y—z. K.", "́a. é.", "<|endoftext|> x<|endoftext|>y.",
        "a b\x85c d\x1fe 1,000.50!", "日本語です。 テスト ﬁn Σας ǅ", "x" * 5000 + ".", "'s 're 'LL we'LL",
    ]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in WordEncoder(tokenizer_path(None), known=5).encode(texts)] == want
