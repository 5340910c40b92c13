"""Periodic runs, whitening and decontamination against plain versions, with every awkward case."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import documents, words
from tagloom.llm import decontamination, periodic_runs, whitening
from tagloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, doc int, mark string, term string, pos int, runs string, n_words int, bin string"


def frame(spark, rows):
    """Documents with columns that clash with the operators' own names."""
    return spark.createDataFrame([(i, t, 1, "m", "t", 2, "r", 3, "b") for i, t in rows], SCHEMA).repartition(3)


# --- periodic runs -----------------------------------------------------------------


def plain_lyndon(s):
    out = []
    for i in range(len(s)):
        ends = [e for e in range(i + 1, len(s) + 1) if all(s[i:e] < s[k:e] for k in range(i + 1, e))]
        out.append(max(ends) - i)
    return out


def plain_runs(w):
    """All runs by trying every period."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            own = w[i : j + q]
            if len(own) >= max(6, 4 * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                out.append((i, len(own), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def test_lyndon_lengths_and_runs():
    rnd = random.Random(1)
    for _ in range(600):
        s = [rnd.randrange(rnd.choice([1, 2, 3, 5])) for _ in range(rnd.randint(1, 30))]
        if rnd.random() < 0.6:
            unit = s[: rnd.randint(1, 6)]
            s = s[: rnd.randint(0, 10)] + unit * rnd.randint(2, 8) + s[: rnd.randint(0, 10)]
        assert periodic_runs.lyndon_lengths(s) == plain_lyndon(s)
        assert periodic_runs.runs_in(np.array(s)) == plain_runs(s)


def periodic_rows():
    rnd = random.Random(4)
    rows = documents()
    some = ["one two " * 9, "a " * 5, "a " * 6, "x y z " * 3 + "x y", "x y z " * 4, "q " + "a b " * 5 + "c " + "a b " * 5 + "a a a a a a", "é ß " * 40]
    for k in range(30):
        unit = [rnd.choice("abc") for _ in range(rnd.randint(1, 9))]
        parts = [rnd.choice("abcde") for _ in range(20)] + unit * rnd.randint(3, 9) + unit[: rnd.randint(0, 3)] + [rnd.choice("abcde") for _ in range(20)]
        some.append(" ".join(parts))
    some.append("\t\v".join(f"w{k % 3001}" for k in range(15_000)))
    return rows + [(1000 + k, t) for k, t in enumerate(some)] + [(1000, some[0]), (None, some[4]), (2000, None), (2001, ""), (2002, " \n")]


def test_periodic_runs(spark):
    rows = periodic_rows()
    got = periodic_runs.find_runs(frame(spark, rows)).collect()
    want = collections.Counter()
    for i, t in rows:
        w = words(t)
        runs = [(0, 15_000, 3001)] if len(w) == 15_000 else plain_runs(w) if len(w) < 3000 else []
        if len(w) < 16_000:
            want[i, len(w), tuple(runs), collapsed(w, runs)] += 1
    assert collections.Counter((r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in got if r.n_words < 16_000) == want
    assert len(got) == len(rows) and sum(bool(r.runs) for r in got) > 30
    assert periodic_runs.find_runs(frame(spark, rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(frame(spark, rows), power=2)


def test_periodic_query(spark, tmp_path):
    rows = [(i, t) for i, t in periodic_rows() if len(words(t)) < 3000]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    want, tailed = collections.Counter(), 0
    for i, t in rows:
        w = words(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            tailed += 1
        runs = plain_runs(w)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        want[i, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(w, runs))] += 1
    out = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert collections.Counter(tuple(r) for r in out.collect()) == want and tailed > 5


# --- whitening -----------------------------------------------------------------------


def test_inertia_and_leading_pairs():
    rnd = np.random.default_rng(3)
    for size in (1, 2, 3, 9, 40):
        a = rnd.standard_normal((size, size))
        values = np.linalg.eigvalsh(a + a.T)
        assert whitening.inertia(a + a.T) == ((values < 0).sum(), 0, (values > 0).sum())
        assert whitening.inertia(np.diag([*[0.0] * size, 2.0, -3.0])) == (1, size, 1)
        axes, _ = np.linalg.qr(a)
        for spectrum in (rnd.random(size) * 100, 10.0 ** -np.arange(size), np.r_[7.0, 7.0 * (1 - 1e-9), rnd.random(size)][:size]):
            spectrum = np.sort(spectrum)[::-1]
            matrix = (axes * spectrum) @ axes.T
            matrix = (matrix + matrix.T) / 2
            got = whitening.leading(matrix)
            assert len(got) == min(4, size) and all(c.certified for c in got)
            assert np.allclose([c.value for c in got], spectrum[:4], rtol=1e-10)
            assert max(np.linalg.norm(matrix @ c.vector - c.value * c.vector) for c in got) < 1e-13 * spectrum[0]
    same = whitening.leading(np.diag([5.0, 5.0, 5.0, 1.0, 0.5]))
    assert [round(c.value, 12) for c in same] == [5, 5, 5, 1] and [c.certified for c in same] == [False, False, False, True]
    base = np.array([c.vector for c in same])
    assert np.allclose(base @ base.T, np.eye(4), atol=1e-14)
    assert whitening.leading(np.zeros((3, 3))) == [] and whitening.leading(np.zeros((0, 0))) == []


def vector_rows():
    rnd = np.random.default_rng(6)
    mix = rnd.standard_normal((12, 12)) * 0.3
    rows = [(i, (rnd.standard_normal(12) @ mix).astype(np.float32).tolist()) for i in range(500)]
    rows += [(500 + i, rows[7][1]) for i in range(250)] + [(800, [0.0] * 12), (None, rows[3][1]), (3, rows[4][1])]
    odd = [None, [], [float("nan"), *[1.0] * 11], [float("-inf"), *[1.0] * 11], [None, *[1.0] * 11], [1.0, 2.0]]
    return rows, [(1000 + i, v) for i, v in enumerate(odd)]


@pytest.mark.parametrize("parts", [1, 7])
def test_whitening(spark, parts):
    rows, odd = vector_rows()
    table = spark.createDataFrame([(i, v, 1, "s") for i, v in rows + odd], "vec_id long, embedding array<float>, component int, steps string").repartition(parts)
    x = np.floor(256 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    white = (x - sums / n) @ axes / np.sqrt(values)
    out = collections.defaultdict(list)
    for r in whitening.whiten(table).collect():
        out[r.vec_id].append(r)
    assert set(out) == {i for i, _ in rows} and sum(map(len, out.values())) == 4 * len(rows)
    signs = {}
    for (i, _), own, steps in zip(rows, white, x, strict=True):
        if i in (None, 3):
            continue
        away = sum((n * int(a) - int(s)) ** 2 for a, s in zip(steps, sums, strict=True))
        for r in out[i]:
            k = r.component - 1
            sign = signs.setdefault(k, 1 if r.whitened * own[k] > 0 else -1)
            assert abs(r.whitened - sign * own[k]) < 1e-9 * max(1, abs(own[k]))
            assert (r.n, r.deviation, r.certified) == (n, away, True) and r.identity_error < 1e-10
            assert math.isclose(r.explained, values[k] / np.trace(centred.T @ centred / n), rel_tol=1e-10)
    assert [sorted(round(r.whitened, 6) for r in out[3])] and len(out[3]) == 8


def test_whitening_of_few_large_and_no_vectors(spark):
    kind = "vec_id long, embedding array<double>"
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)
    assert whitening.whiten(one).count() == whitening.whiten(one.limit(0)).count() == 0
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0])], kind)).collect()
    assert [(r.component, round(abs(r.whitened), 9), round(r.explained, 9)) for r in two] == [(1, 1, 1)] * 2
    large = [(i, [(-1.0) ** i * 3e6 * (i + 1), 1e5 * i * i, 1e300 if i == 0 else 0.0]) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(large, kind)).collect()
    x = [[max(-(2**31), min(2**31, math.floor(256 * v))) for v in row] for _, row in large]
    sums = [sum(c) for c in zip(*x, strict=True)]
    away = [sum((9 * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 2**63 else None for i, d in enumerate(away)}
    assert all(r.identity_error < 1e-9 for r in got)


# --- decontamination ----------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_hits(rows, items, window=10):
    out = []
    for i, t in rows:
        w, hit, ids = terms(t), set(), set()
        for key, text in items:
            own = terms(text)
            size = min(window, len(own))
            windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
            for k in range(len(w) - size + 1 if windows else 0):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    if key is not None:
                        ids.add(str(key))
        out.append((i, len(w), len(hit), len(ids), tuple(sorted(ids))))
    return collections.Counter(out)


def cases():
    rnd = random.Random(9)
    vocabulary = ["the", "of", "a", *("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 5))) for _ in range(60))]
    say = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(k, say(rnd.randint(1, 40))) for k in range(25)]
    items += [(30, items[0][1]), (31, ["the", "of"]), (32, ["Ünique"]), (33, []), (34, None), (None, items[2][1] + say(9)), (35, ["absent"] + say(11)), (36, ["a"] * 12), (5, say(12))]
    items = [(k, " ".join(w) if w is not None else None) for k, w in items]
    rows = []
    for i in range(90):
        w = say(rnd.randint(0, 80))
        for _ in range(rnd.randint(0, 2)):
            own = terms(rnd.choice(items)[1])
            cut = rnd.randint(0, len(own))
            part = own[cut : cut + rnd.randint(1, 40)]
            at = rnd.randint(0, len(w))
            w[at:at] = part
        text = rnd.choice([" ", ", ", "-\n", "_"]).join(w)
        rows.append((i, text.upper().replace("É", "é") if i % 7 == 0 else text))
    rows += [(200, "a " * 3000), (201, None), (202, ""), (203, "!?"), (204, "ÜNIQUE Ünique ünique"), (7, rows[3][1]), (7, rows[7][1]), (None, rows[5][1]), (None, items[3][1]), (None, items[3][1])]
    rows += [(300 + k, rows[5][1]) for k in range(40)] + [(400, " ".join(say(30_000) + terms(items[6][1])))]
    return rows, items


def test_contamination(spark, monkeypatch):
    rows, items = cases()
    table = spark.createDataFrame([(k, t, 1, "w") for k, t in items], "item_id int, text string, item int, words string")
    want = plain_hits(rows, items)
    for most in (decontamination.MOST_ROWS, 0):  # broadcast, and shuffled
        monkeypatch.setattr(decontamination, "MOST_ROWS", most)
        got = decontamination.contamination(frame(spark, rows), table).collect()
        assert collections.Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r.item_ids)) for r in got) == want
    assert sum(n for (*_, ids), n in want.items() if ids) > 60
    clean = decontamination.contamination(frame(spark, rows), table.limit(0))
    assert clean.count() == len(rows) and clean.agg(F.sum("n_hit")).first()[0] == 0
    assert decontamination.contamination(frame(spark, rows).limit(0), table).count() == 0


def test_near_matches(spark):
    rows, items = cases()
    rows = [(i, t) for i, t in rows[:90]] + [(95, "x delta x x alpha x charlie x bravo x x x x x x x x x x x alpha"), (96, "alpha bravo " + "x " * 9 + "charlie delta")]
    items = [(k, t) for k, t in items[:8] if t] + [(50, "alpha bravo charlie delta")]
    span = 11
    index = decontamination.build_index(frame(spark, rows))
    texts, _ = decontamination.test_items(spark.createDataFrame(items, "item_id int, text string"))
    got = decontamination.near_matches(index, texts, span=span)
    doc_ids = decontamination.keyed(frame(spark, rows)).select("doc_id", "doc", "mark")
    got = {tuple(r) for r in got.join(doc_ids, ["doc", "mark"]).join(texts, "item").select("doc_id", "words", "window", "first").withColumn("words", F.array_join("words", " ")).collect()}
    want = set()
    for i, t in rows:
        w = terms(t)
        for _, text in items:
            own = terms(text)
            size = min(10, len(own))
            for k in range(len(own) - size + 1):
                need = set(own[k : k + size])
                want |= {(i, " ".join(own), k, p) for p in range(len(w)) if w[p] in need and need <= set(w[p : p + span])}
    assert got == want and {(i, p) for i, text, _, p in want if text.startswith("alpha")} == {(95, 1)}


def test_postings_are_sorted_by_one_number(spark):
    docs = spark.createDataFrame([(i, f"b a c{i % 3} a Z {i}") for i in range(40)], "doc_id long, text string").coalesce(1)
    index = decontamination.build_index(docs)
    terms = [r.term for r in index.collect()]
    assert len(terms) == 240 and sum(a != b for a, b in zip(terms, terms[1:])) == len(set(terms)) - 1
    # a sort by strings compares rows, one by a number needs no comparison
    hashes = [r.h for r in index.select(F.xxhash64("term").alias("h")).collect()]
    assert hashes == sorted(hashes)


def test_terms_are_split_and_not_collected_match_by_match(spark):
    odd = "".join(map(chr, range(0x180))) + " 　﻿�\U0001d4d0\U0001f600\U0010ffff" + "".join(map(chr, range(0x100)))
    texts = [odd, odd.upper(), odd[::-1], "".join(f"{c}Ab" for c in odd), "".join(f"{c}{c}" for c in odd), "\x7f".join(odd), *odd, None, "", " ", "A", " A", "A ", "  A--b  ", "\0\0"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = rows.select("doc_id", decontamination.terms_of(F.col("text")).alias("terms"))
    assert {r.doc_id: r.terms for r in found.collect()} == {i: terms(t) for i, t in enumerate(texts)}
    assert "regexp_extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()  # 80 CPU seconds for 0.10 GB, a split 15


def joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("BroadcastHashJoin"), plan.count("SortMergeJoin")


def test_long_tables_with_small_files_are_not_broadcast(spark, monkeypatch):
    index = decontamination.build_index(spark.createDataFrame([(1, "a b c"), (2, "b c")], "doc_id long, text string"))
    place = index.where("doc = 1 and term = 'b'").drop("pos")
    wanted = place.crossJoin(spark.range(60_000).select((F.col("id") % 2).cast("int").alias("pos"), F.lit("item").alias("item"), F.col("id").alias("k")))
    found = decontamination.held(index, wanted, "wanted")
    assert found.count() == 30_000
    assert joins(found) == (2, 1)  # the lists of documents and terms, and no rows of wanted


def test_broadcast_by_rows_and_bytes(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MOST_ROWS", 100)
    rows = lambda n, size: spark.range(n).select(F.rpad(F.col("id").cast("string"), size, "-").alias("term"))
    index = rows(5_000, 5).withColumn("pos", F.lit(0))
    for table, want in ((rows(90, 5), (1, 0)), (rows(101, 5), (0, 1)), (rows(10, 1_000), (0, 1)), (rows(0, 1), (1, 0))):
        assert joins(index.join(decontamination.lookup(table), "term")) == want
    words = rows(10, 5).select("term", F.array_repeat("term", 300).alias("words"))
    assert joins(index.join(decontamination.lookup(words), "term")) == (0, 1)
