"""Periodic runs against brute force, and on nulls, ties, repeats, empty tables and long texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from callsheet.llm import runs
from callsheet.llm.queries import op12_runs

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, start bigint, n_runs string, runs int"


def brute_runs(w):
    """(start, length, period): all maximal stretches by each period, those with a smaller one left out."""
    found, n = {}, len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                found.setdefault((s, i + q - s), q)
    return sorted((s, m, q) for (s, m), q in found.items())


def repetitive(rng, n):
    """Words over few symbols, with repeated stretches of repeated stretches."""
    out = []
    while len(out) < n:
        kind = rng.randrange(5)
        if kind == 0:
            out += [f"w{rng.randrange(5)}" for _ in range(rng.randrange(1, 12))]
        elif kind == 1 and out:
            p = rng.randrange(1, min(len(out), 9) + 1)
            out += out[-p:] * rng.randrange(1, 8)
        elif kind == 2 and out:
            p = rng.randrange(1, min(len(out), 40) + 1)
            part = out[-p:] * rng.randrange(1, 7)
            out += part[:rng.randrange(len(part) + 1)]
        elif kind == 3:
            out += ["a"] * rng.randrange(1, 15)
        else:
            out += ["a", "b"] * rng.randrange(1, 5)
    return out[:n]


def numbered(texts):
    names = {}
    size = np.array([len(t) for t in texts], np.int64)
    return np.array([names.setdefault(w, len(names)) for t in texts for w in t], np.int64), size


@pytest.mark.parametrize("chunk", [1 << 20, 50])
def test_all_runs_are_found(monkeypatch, chunk):
    monkeypatch.setattr(runs, "_CHUNK", chunk)
    rng = random.Random(3)
    for many in (1, 2, 40):
        for _ in range(12):
            texts = [repetitive(rng, rng.choice((0, 1, 3, 5, 6, 7, 20, 90, 240))) for _ in range(many)]
            texts += [["a"] * k for k in (5, 6, 7, 24)] + [[]]
            text, *run = runs.find_runs(*numbered(texts))
            got = [[] for _ in texts]
            for t, s, m, q in zip(text, *run, strict=True):
                got[t].append((s, m, q))
            assert got == [brute_runs(t) for t in texts]


def test_extensions_are_exact():
    rng = random.Random(6)
    for _ in range(30):
        texts = [repetitive(rng, 150), repetitive(rng, 3), repetitive(rng, 400)]
        words, size = numbered(texts)
        mark = np.zeros(len(words) + 4, bool)
        mark[np.r_[0, np.cumsum(size + 1)]] = True
        symbols = np.empty(len(mark), np.int64)
        symbols[~mark], symbols[mark] = words, 1000 + np.arange(4)
        levels = runs.grammar(symbols, mark)
        assert sum(len(x.symbols) for x in levels) < 12 * len(symbols)
        i, j = np.array([sorted(rng.sample(range(1, 151), 2)) for _ in range(300)]).T
        expected = []
        for a, b in zip(i, j, strict=True):
            k = 0
            while symbols[a + k] == symbols[b + k]:
                k += 1
            expected.append(k)
        assert runs.common_extension(levels, i, j).tolist() == expected
        n = len(symbols)
        back = [x.backwards() for x in levels]
        expected = []
        for a, b in zip(i, j, strict=True):
            k = 0
            while symbols[a - 1 - k] == symbols[b - 1 - k]:
                k += 1
            expected.append(k)
        assert runs.common_extension(back, n - i, n - j).tolist() == expected


def brute_row(doc_id, text):
    w = (text or "").encode().split()
    n, original = len(w), list(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        for i in range(a, n):
            w[i] = original[a + (i - a) % p]
    found = brute_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[:1]
    top = (*best[0], best[0][1] * 1000 // best[0][2]) if best else (None,) * 4
    sha = [hashlib.sha256(x).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in found).encode(),
                                                   b" ".join(x for i, x in enumerate(w) if i not in gone))]
    return (doc_id, len(found), *top, *sha)


def key(row):
    return tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in row)


@pytest.mark.parametrize("batch", [400_000, 100])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, batch):
    rng = random.Random(9)
    dealt = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = [" ".join(repetitive(rng, rng.choice((1, 4, 30, 200)))) for _ in range(80)]
    texts += [None, "", " \n\t", "one", "a a a a a", "a a a a a a", "ü\x0bü\x0cü\rü\nü\tü ü", "x x x x " * 9, "  " * 7]
    texts += [" ".join(f"w{rng.randrange(300)}" for _ in range(n)) for n in (3, 30, 400, 2500)]
    rows = [(d, t) for d, t in zip([*dealt[:60], *range(10_000, 10_100)], texts, strict=False)]
    rows += [(None, texts[0]), (None, None), (-7, "a b " * 8), *rows[:9]]
    path = str(tmp_path)
    spark.createDataFrame([(d, t, "en", "s", 1, 5, "x", 3) for d, t in rows], SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    monkeypatch.setattr(runs, "BATCH_WORDS", batch)
    got = [tuple(r) for r in op12_runs(spark, path).collect()]
    assert sorted(got, key=key) == sorted((brute_row(*r) for r in rows), key=key)


def test_very_long_text():
    rng = random.Random(1)
    words = [f"w{rng.randrange(3000)}" for _ in range(60_000)]
    words[20_000:20_000] = (words[100:7_000] * 5)[:31_000]
    words += ["z"] * 40_000
    (row,) = runs.described([(1, [w.encode() for w in words])])
    assert (20_000, 31_000, 6_900) in [(s, m, q) for s, m, q in row[-1]] or any(q == 6_900 and m >= 31_000 for _, m, q in row[-1])
    assert row[2:6] == (91_000, 40_000, 1, 40_000_000)


def test_collapsed_texts_and_empty_table(spark):
    rows = [(1, "so a b a b a b a b c", "en", "s", 1, 5, "x", 3), (2, None, "en", "s", 1, 5, "x", 3)]
    got = {r.doc_id: r for r in runs.collapsed(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].text == "so a b c" and [tuple(x) for x in got[1].runs] == [(1, 8, 2)]
    assert got[2].text == "" and got[2].runs == []
    empty = spark.createDataFrame([], SCHEMA)
    assert runs.collapsed(empty).collect() == [] and runs.run_digests(empty).collect() == []
