"""Product codes, runs and mixtures against brute force, on small inputs with odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roomtide.llm import codes, mixing, oracles, periods, queries

SPACES = "[^\x20\x09-\x0d]+"
DOCUMENTS = "doc_id long, text string, source string, _of string, _print string, _row string, u double, class long, rows long"
VECTORS = "vec_id long, embedding array<float>, label int, whole string, entries int, _label int"


# 11 product codes

def vectors(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], VECTORS)


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(float(np.float32(x)) * 1024) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(kept[0][1]) if kept else 0
    width = -(-length // parts)

    def cut(v):
        v = v + [0] * (width * parts - length)
        return [tuple(v[p * width:(p + 1) * width]) for p in range(parts)]

    fits = [(i, cut(v), label) if len(v) == length else (i, None, label) for i, v, label in kept]
    whole = [r for r in fits if r[1]]
    books = [[r[1][p] for r in whole[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for r in whole:
                own.setdefault(nearest(r[1][p], books[p])[1], []).append(r[1][p])
            books[p] = [tuple(math.floor(sum(c) / len(own[k])) for c in zip(*own[k])) if k in own else e
                        for k, e in enumerate(books[p])]
    out = []
    for i, cuts, label in fits:
        found = [nearest(cuts[p], books[p]) for p in range(parts)] if cuts else None
        out.append((i, "".join(f"{k:02x}" for _, k in found) if found else None,
                    sum(d for d, _ in found) if found else None, label))
    totals = {}
    for _, _, error, label in out:
        if error is not None:
            totals[label] = totals.get(label, 0) + error
    flat = ",".join(str(c) for book in books for e in book for c in e)
    return sorted(((i, c, e, totals.get(label)) for i, c, e, label in out), key=repr), hashlib.sha256(flat.encode()).hexdigest()


def vector_rows(seed, n, length):
    rng = random.Random(seed)
    rows = [(rng.randrange(10 * n), [rng.choice([rng.gauss(0, 0.05), 0.0, -0.01, 3.0]) for _ in range(length)],
             rng.choice([None, 1, 2])) for _ in range(n)]
    return rows + rows[:4] + [(rows[5][0], rows[6][1], 1), (None, rows[7][1], None), (10 ** 6, None, 1), (-5, [], 1),
                              (3, [math.nan] + rows[1][1][1:], 1), (4, [math.inf] + rows[1][1][1:], 1),
                              (5, [None] + rows[1][1][1:], 1), (10 ** 7, rows[1][1] + [0.5], 7)]


def coded(spark, rows, **how):
    out, books = codes.compress(vectors(spark, rows).repartition(3), **how)
    found = out.select("vec_id", codes.code(F.col("entries")), "error", "label_error").collect()
    return sorted((tuple(r) for r in found), key=repr), codes.digest(books)


@pytest.mark.parametrize(("n", "length", "how"), [
    (40, 8, {}), (300, 16, {}), (60, 7, {"entries": 9}), (80, 8, {"entries": 5, "rounds": 1, "parts": 2}), (9, 3, {})])
def test_codes_equal_brute_force(spark, n, length, how):
    rows = vector_rows(n, n, length)
    found, digest = coded(spark, rows, **how)
    wanted = brute_codes(rows, **{"parts": 4, **how})
    assert (found, digest) == (wanted[0], wanted[1])


def test_codes_of_an_empty_table_and_large_components(spark):
    assert coded(spark, []) == ([], hashlib.sha256(b"").hexdigest())
    assert coded(spark, [(1, None, 1), (2, [math.nan], 1)]) == ([], hashlib.sha256(b"").hexdigest())
    rows = [(i, [100_000.0 * i, -3.0, 0.0, 2.0 ** 18], 1) for i in range(3)]
    assert coded(spark, rows)[0] == brute_codes(rows)[0]
    with pytest.raises(ValueError, match="64 bits"):
        codes.compress(vectors(spark, [(1, [1e30, 0.0], 1)]))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(*[st.integers(-3, 3)] * 3), min_size=1, max_size=60, unique=True),
       st.lists(st.tuples(*[st.integers(-3, 3)] * 3), min_size=1, max_size=9), st.integers(1, 20))
def test_trie_distances_and_shared_prefixes(parts, book, block):
    leaves = np.array(sorted(parts))
    trie, nodes, found = codes.Trie(np.array(book)), 0, []
    for at in range(0, len(leaves), block):
        entry, far, visited = trie.walk(leaves[at:at + block])
        found += list(zip(far.tolist(), entry.tolist()))
        nodes += visited
    assert found == [min((sum((a - b) ** 2 for a, b in zip(leaf, e)), k) for k, e in enumerate(book)) for leaf in leaves.tolist()]
    # Every prefix is computed once, however the leaves are cut into blocks.
    assert nodes == sum(len({p[:d] for p in parts}) for d in (1, 2, 3))


# 12 runs

def brute_runs(words):
    spans = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                spans.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in spans.items())


def brute_collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), max_size=4), st.integers(1, 12), st.integers(0, 9))
def test_runs_equal_brute_force(texts, period, repeats):
    texts = [t + (t[:period] * repeats) + t for t in texts]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(int)
    words = np.array([ord(w) for t in texts for w in t], int)
    found = [[] for _ in texts]
    for text, *run in zip(*(x.tolist() for x in periods.find(words, first))):
        found[text].append(tuple(run))
    assert found == [brute_runs(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([1, 1, 1, 2, 3]), min_size=2, max_size=120), st.randoms(use_true_random=False))
def test_grammar_extensions_equal_direct_comparison(words, rng):
    sequence = np.array([0, *(w + 2 for w in words), 1])
    grammar = periods.Grammar(sequence, 2)
    a = np.array([rng.randrange(1, len(words)) for _ in range(30)])
    b = np.array([rng.randrange(int(x) + 1, len(words) + 1) for x in a])

    def common(x, y, step):
        n = 0
        while x != y and 0 <= x < len(sequence) and 0 <= y < len(sequence) and sequence[x] == sequence[y]:
            x, y, n = x + step, y + step, n + 1
        return n

    assert grammar.extensions(a, b).tolist() == [common(x, y, 1) for x, y in zip(a, b)]
    assert grammar.extensions(a, b, back=True).tolist() == [common(x, y, -1) for x, y in zip(a, b)]


def texts(seed=2):
    rng = random.Random(seed)
    out = [(i, " \n".join(rng.choice(["One", "one", "é\xa0x", "\x1c", "w"]) for _ in range(rng.choice([0, 3, 23, 30, 90])))
            + rng.choice(["", "\t", " a b c" * 9, " z" * 24, " z" * 23]), rng.choice([None, "s", "t"])) for i in range(120)]
    return out + [(900, None, "s"), (901, "", "s"), (902, " \t ", None), (903, "x " * 5000, "s"), (None, "a b " * 20, "s"),
                  (None, "a b " * 20, "s"), out[7], out[7], (904, "solo", "")]


def documents(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", 0.5, 1, 2) for r in rows], DOCUMENTS)


def test_query_of_runs_equals_brute_force(spark, tmp_path):
    rows = texts()
    documents(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_recompression_runs(spark, str(tmp_path)).drop("n_words").collect()
    wanted = []
    for i, text, _ in rows:
        words = re.findall(SPACES, text or "")
        n, h = len(words), zlib.crc32(str(i).encode()) if i is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None,) * 3
        wanted.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                       hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                       hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()))
    assert sorted((tuple(r) for r in found), key=repr) == sorted(wanted, key=repr)
    assert any(w[1] > 0 for w in wanted) and sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in rows) > 3


def test_runs_of_an_empty_table_and_a_long_text(spark):
    assert periods.runs(documents(spark, [])).collect() == []
    words = [str(i) for i in range(200_000)] + ["a", "b", "c"] * 50_000
    row = periods.runs(documents(spark, [(1, " ".join(words), "s")])).first()
    assert [tuple(r) for r in row.runs] == [(200_000, 150_000, 3)] and row.n_words == 350_000
    assert row.collapsed == " ".join(words[:200_003])


# 13 mixtures

def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares, the excess over the caps shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - most * sum(sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / open_weight for s in names}
        above = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def mixed_rows(seed, n):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * int(rng.lognormvariate(3, 1.2))), rng.choices(["a", "b", "é", "", None, "B"], [9, 3, 1, 1, 1, 5])[0])
            for i in range(n)]
    return rows + [rows[1]] * 5 + [(None, rows[2][1], "a")] * 3 + [(7 * n, None, "a"), (7 * n + 1, "", "z")]


@pytest.mark.parametrize(("n", "near"), [(3000, 0.004), (60, 0.25)])
def test_mixture_keeps_to_its_laws(spark, n, near):
    rows = mixed_rows(n, n)
    found = mixing.plan(documents(spark, rows).repartition(3)).collect()
    size = lambda t: len(re.findall(SPACES, t or ""))
    assert sorted(((r.doc_id, r.size, r.source) for r in found), key=repr) == sorted(((i, size(t), s) for i, t, s in rows), key=repr)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        whole = math.floor(r.target / r.source_size + 1e-12) if r.source_size else 0
        assert r.copies in (whole, whole + 1) and r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    biggest = {s: max(size(t) for _, t, o in rows if o == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(near * target[s], 0.6 * biggest[s])
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))


def test_mixture_reruns_agree_and_ranges_do_not_matter(spark, monkeypatch):
    rows = mixed_rows(5, 800)
    kept = lambda df: sorted(map(repr, mixing.plan(df).collect()))
    once = kept(documents(spark, rows).repartition(2))
    assert kept(documents(spark, rows[::-1]).repartition(5)) == once
    # Strata cut into many ranges, and equal rows numbered in chunks, change nothing.
    monkeypatch.setattr(mixing, "RANGE", 3)
    numbered = mixing.numbered
    monkeypatch.setattr(mixing, "numbered", lambda groups: numbered(groups, 2))
    assert kept(documents(spark, rows)) == once


def test_documents_are_drawn_in_pareto_order(spark):
    """Of a stratum, the ones of smallest random odds over inclusion odds."""
    rows = [(i, "w " * 40, "s") for i in range(800)] + [(1000 + i, "w " * 40, "t") for i in range(300)]
    found = mixing.plan(documents(spark, rows)).collect()
    for source in "st":
        own = [r for r in found if r.source == source]
        low = min(r.copies for r in own)
        drawn = [r.copies > low for r in own]
        n, p = sum(drawn), sum(drawn) / len(own)
        assert 0 < n < len(own)

        def odds(r):
            text = "|".join(["mix-1", f"s{source}", f"d{r.doc_id}", r.print, "0"])
            u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2 ** 52
            return u / (1 - u) / (p / (1 - p))

        assert {r.doc_id for r in sorted(own, key=odds)[:n]} == {r.doc_id for r, d in zip(own, drawn) if d}


def test_mixture_of_rows_and_of_nothing(spark):
    rows = mixed_rows(8, 200)
    table = documents(spark, rows)
    drawn = mixing.plan(table)
    out = mixing.mixture(table, drawn)
    assert out.columns == table.columns
    wanted = {}
    for r in drawn.collect():
        wanted[r.doc_id, r.source] = wanted.get((r.doc_id, r.source), 0) + r.copies
    got = {}
    for r in out.collect():
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + 1
    assert got == {k: n for k, n in wanted.items() if n}
    nothing = documents(spark, [])
    assert mixing.plan(nothing).collect() == [] and mixing.mixture(nothing, mixing.plan(nothing)).collect() == []


def test_queries_equal_their_sql_on_odd_rows(spark, tmp_path):
    documents(spark, mixed_rows(3, 300) + texts()).write.parquet(f"{tmp_path}/documents.parquet")
    vectors(spark, vector_rows(4, 300, 16)).repartition(2).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name, sql in oracles.ORACLES.items():
        found, wanted = queries.QUERIES[name](spark, str(tmp_path)), con.sql(sql)
        order = sorted(found.columns)
        assert order == sorted(wanted.columns)
        cells = [sorted(map(repr, ([r[c] for c in order] for r in found.collect()))),
                 sorted(map(repr, ([r[wanted.columns.index(c)] for c in order] for r in wanted.fetchall())))]
        assert cells[0] == cells[1], name


def test_size_classes_are_in_order(spark):
    sizes = [*range(200), 1023, 1024, 1025, *(1 << k for k in range(20, 62)), (1 << 62) - 1]
    found = [r[0] for r in spark.createDataFrame([(n, s) for n, s in enumerate(sizes)], "n long, s long").orderBy("n").select(
        mixing.size_class(F.col("s"))).collect()]
    assert found == sorted(found)
    for (a, x), (b, y) in itertools.pairwise(zip(sizes, found)):
        assert (x == y) <= (b < a * 1.04)
