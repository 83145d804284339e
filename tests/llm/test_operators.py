"""Each operator against brute force, and on nulls, empty tables, ties, repeats and clashing columns."""

import datetime as dt
import gc
import math
import random
import tracemalloc
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from callsheet.llm import chat, host_rules, ngram_join, packing, pii, quality_rank, sentencepiece_fst, shards, shingles, topk, toxicity
from callsheet.llm.common import Scratch
from callsheet.llm.queries import tokenizer_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node bigint, host string, score double, n bigint"


def table(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["a"] * len(texts))[i], len(t or ""), 7, "x", 0.5, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def families(rng):
    """Dense groups of near copies, a passage that many share, copies, short and empty texts."""
    passage = prose(rng, 60)
    out = [None, "", "  \n", "one two", "one  TWO", "a b c d e", "a b c d e f"]
    for size in (2, 9, 40):
        base = prose(rng, 90).split()
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
            out.append(" ".join(words))
    out += [f"{passage} {prose(rng, rng.choice((5, 12, 15, 20, 40)))}" for _ in range(60)]
    out += [out[20]] * 30 + [prose(rng, rng.randrange(1, 300)) for _ in range(60)]
    rng.shuffle(out)
    return out


def brute_groups(texts):
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * len(sets[i] | sets[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return [len(s) for s in sets], group


@pytest.mark.parametrize("limit,run", [(8, 64), (2, 3)])
def test_ngram_join_finds_every_link(spark, monkeypatch, limit, run):
    monkeypatch.setattr(ngram_join, "PAIR_LIMIT", limit)
    monkeypatch.setattr(ngram_join, "LOCAL_RUN", run)
    texts = families(random.Random(limit))
    got = {r["doc_id"]: r for r in ngram_join.similar_texts(table(spark, texts)).collect()}
    sizes, groups = brute_groups(texts)
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [got[i]["component_id"] for i in range(len(texts))] == groups


@pytest.mark.parametrize("block", [512, 7])
def test_ngram_join_counts_every_link(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    monkeypatch.setattr(ngram_join, "TILE", 16)
    texts = families(random.Random(11))
    sets = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split() for t in texts]
    sets = [frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset() for w in sets]
    want = {s: sum(o != s and 100 * len(s & o) >= 75 * len(s | o) for o in set(sets) if o) if s else 0 for s in set(sets)}
    got = {r["doc_id"]: r["n_links"] for r in ngram_join.similar_texts(table(spark, texts)).collect()}
    assert max(want.values()) > 8 and [got[i] for i in range(len(texts))] == [want[s] for s in sets]


def test_components_and_later_links(spark):
    rng = random.Random(3)
    pairs = {tuple(sorted(rng.sample(range(90), 2))) for _ in range(60)} | {(i, i + 1) for i in range(100, 130)}
    later = {(0, 100), (200, 201), (129, 200), (101, 102)}
    group = {}
    for a, b in pairs | later:
        low, high = sorted((group.setdefault(a, a), group.setdefault(b, b)))
        group = {k: low if g == high else g for k, g in group.items()}
    scratch = Scratch(spark, "test")
    frame = lambda rows: spark.createDataFrame(sorted(rows), "a bigint, b bigint")
    comp = scratch.keep(ngram_join.components(scratch, frame(pairs)))
    got = ngram_join.merged(scratch, comp, frame(later)).collect()
    assert len(got) == len(group) and {r["node"]: r["comp"] for r in got} == group
    assert ngram_join.components(scratch, frame(pairs).limit(0)).count() == 0


def test_ngram_join_of_nothing(spark):
    assert ngram_join.similar_texts(table(spark, ["x"]).limit(0)).count() == 0
    assert ngram_join.first_of_each(table(spark, [None, ""])).count() == 2


def test_pigeonhole_never_misses_by_size():
    for n in range(1, 3000, 7):
        for band, probe in ngram_join.roles(n):
            assert ngram_join.needed(n, band, probe) <= ngram_join.segments_of(band)
    x = np.arange(1, 1001, dtype=np.uint64)
    a, b = shingles.mix(x), shingles.mix(x + np.uint64(100))
    assert ngram_join.may_link(ngram_join.sketch(a), ngram_join.sketch(b), 1000, 1000)


def test_toxicity_grades(spark):
    rng = random.Random(1)
    texts = [prose(rng, 30, 300) + " vile" * (i % 8 if i % 4 == 0 else 0) for i in range(400)] + [None, ""]
    labels = spark.createDataFrame([(i, None, int(i % 4 == 0 and i % 8 > 0)) for i in range(400)], "doc_id bigint, quality int, toxic int")
    docs = table(spark, texts)
    out = {r["doc_id"]: r for r in toxicity.with_severity(docs, toxicity.train(docs, labels)).collect()}
    assert all(out[i]["toxic"] == (i % 8 == 4) for i in range(400))
    assert not out[400]["toxic"] and not out[401]["toxic"] and 0 <= out[400]["expected_severity"] <= 3
    assert not toxicity.with_severity(docs, toxicity.train(docs, labels.limit(0))).where("toxic").count()


@pytest.mark.parametrize("n", [60, 240])
def test_toxicity_learns_stems_from_few_labels(spark, n):
    # every toxic text has its own word of one stem: no whole word is found in two rows
    rng = random.Random(8)
    own = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    plain = lambda: " ".join(own() for _ in range(30))
    texts = [plain() + (f" réeux{own()} réeux{own()}" if i % 5 == 0 else "") for i in range(n + 100)]
    labels = spark.createDataFrame([(i, None, int(i % 5 == 0)) for i in range(n)], "doc_id bigint, quality int, toxic int")
    docs = table(spark, texts)
    out = {r["doc_id"]: r["toxic"] for r in toxicity.with_severity(docs, toxicity.train(docs, labels)).collect()}
    unseen = range(n, n + 100)
    assert sum(out[i] for i in unseen if i % 5 == 0) >= 18 and sum(out[i] for i in unseen if i % 5) <= 4


def test_ordinal_fit_orders_thresholds():
    grades = np.array([0, 0, 0, 1, 2, 3])
    sample = toxicity.unpacked([toxicity.pack(np.arange(g > 0), np.ones(int(g > 0), int)) for g in grades], (grades > 0).astype(int))
    w, t = toxicity.fit_ordinal(sample, np.ones(6, bool), grades, np.ones(1))
    assert w[0] > 0 and t[0] < t[1] < t[2]


def counted_rows(rng, n, features=30):
    rows = []
    for i in range(n):
        at = np.sort(rng.choice(features, rng.integers(0, 9), replace=False)) * 7
        rows.append((at, rng.choice([1, 2, 3, 254, 255, 256, 2047, 2048, 70_000], len(at))))
    return rows


@pytest.mark.parametrize("block", [1 << 19, 5])
def test_ordinal_fit_finds_the_lowest_loss(monkeypatch, block):
    """The loss of the fit, worked out row by row with plain formulas, can't be lowered along any weight or threshold."""
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = counted_rows(rng, 60)
    grades = np.array([min(3, int(x[1].sum() > 300) + int(3 in x[0] // 7) + int(5 in x[0] // 7)) for x in rows])
    sample = toxicity.unpacked([toxicity.pack(*x) for x in rows], (grades > 0).astype(int))
    keep = np.arange(60) % 5 != 2
    scale = rng.random(len(sample.used)) + 0.1
    w, t = toxicity.fit_ordinal(sample, keep, grades, scale, steps=2000)
    column = {f: i for i, f in enumerate(sample.used)}
    toxic = [g > 0 for g, k in zip(grades, keep, strict=True) if k]

    def loss(w, t):
        total = toxicity.RIDGE / 2 * (w @ w)
        for (at, count), grade, kept in zip(rows, grades, keep, strict=True):
            if kept:
                z = sum(w[column[f]] * scale[column[f]] * (1 + np.log(c)) for f, c in zip(at, count, strict=True))
                above = [1, *(1 / (1 + np.exp(x - z)) for x in t), 0]
                total -= 0.5 / (sum(toxic) if grade else len(toxic) - sum(toxic)) * np.log(max(above[grade] - above[grade + 1], 1e-12))
        return total

    best = loss(w, t)
    for i in range(len(w)):
        for d in (-0.02, 0.02):
            assert loss(w + d * (np.arange(len(w)) == i), t) > best - 1e-5
    for j in range(3):
        for d in (-0.02, 0.02):
            assert loss(w, t + d * (np.arange(3) == j)) > best - 1e-5


def test_counts_are_kept_whole():
    rows = counted_rows(np.random.default_rng(2), 40)
    sample = toxicity.unpacked([toxicity.pack(*x) for x in rows], np.zeros(40, int))
    ends = np.cumsum(sample.lens)
    for (at, count), n, end in zip(rows, sample.lens, ends, strict=True):
        assert sample.used[sample.col[end - n:end]].tolist() == at.tolist() and sample.count[end - n:end].tolist() == count.tolist()
    weights = np.random.default_rng(3).random(len(sample.used))
    plain = [sum(weights[np.searchsorted(sample.used, f)] * (1 + np.log(c)) for f, c in zip(*x, strict=True)) for x in rows]
    assert np.allclose(sample.scores(weights), plain)


def test_one_toxic_row_moves_no_threshold(spark):
    rng = random.Random(2)
    docs = table(spark, [prose(rng, 30, 300) + (" vile" * 9 if i == 7 else "") for i in range(60)])
    labels = spark.createDataFrame([(i, None, int(i == 7)) for i in range(60)], "doc_id bigint, quality int, toxic int")
    out = toxicity.with_severity(docs, toxicity.train(docs, labels)).where("toxic").collect()
    assert len(out) <= 1


def test_toxicity_memory_follows_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(toxicity, "BLOCK", 1 << 14)
    found = [np.unique(rng.integers(0, 20_000, 700)) for _ in range(2000)]
    rows = [toxicity.pack(at, np.ones(len(at), int)) for at in found]
    del found
    tracemalloc.start()
    model = toxicity.fit(toxicity.unpacked(rows, (np.arange(2000) % 9 == 0).astype(int)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.weights) == toxicity.PLACES
    # five bytes a feature, the model and its place table, and what the fit keeps for each used feature
    assert peak < 5 * 2000 * 700 + 3 * 4 * toxicity.PLACES + 8 * 30 * 20_000 + 10_000_000


def test_topk_is_exact(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(0, 0.2, (400, 16))
    vectors[10:60] = vectors[10]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)] + [(400, None, 1), (450, [float("nan")] * 16, 1), (None, [1.0] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int")
    ints = np.floor(vectors * 256).astype(np.int64)
    want = []
    for q in range(0, 400, 50):
        s = ints @ ints[q]
        best = sorted((i for i in range(400) if i != q), key=lambda i: (-s[i], i))[:5]
        want += [(q, r + 1, i, int(s[i])) for r, i in enumerate(best)]
    got = topk.nearest(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_deals_repeated_rows_to_all_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(1, [0.5, 0.25])] * 600 + [(i, [i / 400, 0.1]) for i in range(2, 302)], "vec_id bigint, embedding array<double>")
    blocks = topk._dealt(topk.integers(df), 9).groupBy("c").count().collect()
    assert len(blocks) == 9 and max(r["count"] for r in blocks) < 200
    ask = F.col("vec_id").isin(1, 50)
    want = sorted(map(tuple, topk.nearest(df, ask).collect()))
    monkeypatch.setattr(topk, "BLOCK_ROWS", 100)
    assert sorted(map(tuple, topk.nearest(df, ask).collect())) == want
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 1)
    assert sorted(map(tuple, topk.nearest(df, ask).collect())) == want
    ints = [(1, 128, 64)] * 600 + [(i, int(i / 400 * 256), 25) for i in range(2, 302)]
    best = sorted((-(x * ints[648][1] + y * 25), i) for i, x, y in ints if i != 50)[:5]
    assert [(r[2], r[3]) for r in want if r[0] == 50] == [(i, -score) for score, i in best]


def test_topk_defines_large_and_odd_vectors(spark):
    vectors = {0: [3e17, 1.0], 1: [2e16, 1.0], 2: [-2e16, 0.5], 3: [0.25, 0.5, 9.0], 4: [0.5], 5: [1e6, -1e6], 6: [], 7: [0.5, None],
               8: [float("inf"), 0.0], 50: [0.5, 0.25]}
    df = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>")
    end = 2**63 - 1
    ints = {i: [max(-end - 1, min(end, math.floor(x * 256))) for x in v] for i, v in vectors.items() if i < 6 or i == 50}
    want = []
    for q in (0, 50):
        scores = {i: max(-end - 1, min(end, sum(x * y for x, y in zip(v, ints[q])))) for i, v in ints.items() if i != q}
        want += [(q, r + 1, i, scores[i]) for r, i in enumerate(sorted(scores, key=lambda i: (-scores[i], i))[:5])]
    assert sorted(map(tuple, topk.nearest(df, F.col("vec_id") % 50 == 0).collect())) == sorted(want)


def test_topk_moves_the_table_once(spark):
    df = spark.createDataFrame([(i, [i / 400, 0.1]) for i in range(300)], "vec_id bigint, embedding array<double>")
    plan = topk.nearest(df, F.col("vec_id") % 50 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FlatMapCoGroupsInArrow") == 1
    # rows to their meetings, queries by id and to their meetings, found rows by query
    assert plan.count("Exchange") <= 4


def test_sentencepiece_matches_the_model(spark):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    texts = ["".join(rng.choice("aabbeettnn  ▁.,!'\n\té日ﬁ<>0x12ABC") for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += ["", "   ", "The quick  brown fox's\nend " * 200, "\x00😀"]
    coded = sentencepiece_fst.encoded(table(spark, [*texts, None]), path)
    got = {r["doc_id"]: r for r in coded.collect()}
    assert all(got[i]["ids"] == model.encode(t) for i, t in enumerate(texts))
    assert all(got[i]["round_trip"] for i, t in enumerate(texts) if "▁" not in t) and got[len(texts)]["ids"] == []
    back = {r["doc_id"]: r["text"] for r in sentencepiece_fst.decoded(coded, path).collect()}
    assert all(back[i] == t.replace("▁", " ") for i, t in enumerate(texts))


def test_sentencepiece_refuses_unigram(tmp_path):
    import sentencepiece

    (tmp_path / "text").write_text("some words and some more words\n" * 50)
    paths = {}
    for kind in ("unigram", "bpe"):
        sentencepiece.SentencePieceTrainer.train(
            input=str(tmp_path / "text"), model_prefix=str(tmp_path / kind), model_type=kind, vocab_size=40, hard_vocab_limit=False,
            byte_fallback=False, normalization_rule_name="identity", remove_extra_whitespaces=False, minloglevel=2)
        paths[kind] = str(tmp_path / f"{kind}.model")
    assert sentencepiece_fst.is_byte_pair(paths["bpe"]) and not sentencepiece_fst.is_byte_pair(paths["unigram"])
    with pytest.raises(ValueError, match="byte-pair"):
        sentencepiece_fst.Transducer(paths["unigram"])


def test_quality_rank_held_out(spark):
    rng = random.Random(5)
    texts = [prose(rng, 60) if i % 3 else prose(rng, 60).replace(" ", "### ") for i in range(300)] + [None, ""]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)], "doc_id bigint, quality int, toxic int")
    docs = table(spark, texts)
    out = {r["doc_id"]: r for r in quality_rank.scored(docs, quality_rank.train(docs, labels)).collect()}
    assert all(out[i]["predicted"] == int(i % 3 > 0) for i in range(300))
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= out[i]["score"] <= 1 for i in out)
    assert quality_rank.scored(docs, quality_rank.train(docs, labels.limit(0))).first()["score"] == 0.5


def test_quality_scores_do_not_depend_on_partitions(spark):
    rng = random.Random(12)
    docs = table(spark, [prose(rng, rng.randrange(5, 90)) + "### |" * rng.randrange(6) for _ in range(300)])
    labels = spark.createDataFrame([(i, int(rng.random() < 0.7), 0) for i in range(300)], "doc_id bigint, quality int, toxic int")
    found = []
    for width in (1, 5, 13):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        try:
            model = quality_rank.train(docs.repartition(width, F.rand(width)), labels.repartition(width))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
        found.append({r["doc_id"]: (r["score"], r["predicted"]) for r in quality_rank.scored(docs, model).collect()})
    assert found[0] == found[1] == found[2]


def test_quality_pairs_have_a_low_loss():
    """The logistic loss over all pairs of a good and a bad row, pair by pair, against small moves of every weight."""
    rng = np.random.default_rng(7)
    x = rng.random((80, 3))
    good = x[:, 0] + 0.3 * rng.random(80) > 0.6
    model = quality_rank.fit_ranking(x, good, rounds=3000)
    s = model.steps(x).astype(float)

    def loss(w):
        z = s @ w
        return np.mean([np.log1p(np.exp(z[b] - z[a])) for a in np.flatnonzero(good) for b in np.flatnonzero(~good)])

    flat = loss(np.zeros_like(model.weights))
    assert loss(model.weights) < 0.4 * flat
    # pairs are drawn, so the fit is near the lowest loss over all of them, not at it
    for i in range(len(model.weights)):
        for d in (-0.5, 0.5):
            assert loss(model.weights + d * (np.arange(len(model.weights)) == i)) > loss(model.weights) - 0.02 * flat


def test_repeated_ids_train_once(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, prose(rng, 30, 300) + (" vile ### |" if i % 4 == 0 else ".")) for i in range(80)]
    rows += [(4, f"{t} again") for _, t in rows] * 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), int(i % 4 == 0)) for i in range(80)], "doc_id bigint, quality int, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda sample: seen.append(len(sample.toxic)) or toxicity.OrdinalModel())
    monkeypatch.setattr(quality_rank, "fit_ranking", lambda x, good: seen.append(len(x)))
    toxicity.train(docs, labels)
    quality_rank.train(docs, labels)
    assert seen == [80, sum(not quality_rank.is_held_out(i) for i in range(80))]


def test_pseudonyms_keep_formats_and_links():
    p = pii.Pseudonyms(b"k")
    card = "4111 1111 1111 1111"
    text = f"mail jo.x9@a.example.com, {card} or 4111111111111111, +1 (058) 555-0199, 10.0.0.1, 2001-02-29 2001-02-28, " \
           "078-05-1120, 13/12/1999, DE89 3704 0044 0532 0130 00, 4111111111111112, version 2.0"
    out, n = p.replace(text)
    assert n == 9 and "4111111111111112, version 2.0" in out and "2001-02-29" in out
    for old in ("jo.x9@", card, "4111111111111111", "555-0199", "10.0.0.1", "2001-02-28", "078-05-1120", "13/12/1999", "0532 0130"):
        assert old not in out
    new = out.split(", ")[1].split(" or ")
    assert new[0].replace(" ", "") == new[1] and pii.luhn_digit(new[1][:-1]) == new[1][-1]
    assert p.replace(None) == (None, 0) and p.replace("") == ("", 0)


def test_feistel_is_a_permutation():
    f = pii.Feistel(b"k")
    for n in (1, 2, 10, 97, 1000):
        assert sorted(f.permute(x, n, "t") for x in range(n)) == list(range(n))
    low = dt.date(1900, 1, 1).toordinal()
    days = [dt.date.fromordinal(low + i).isoformat() for i in range(500)]
    p = pii.Pseudonyms(b"k")
    assert len({p.iso(d) for d in days}) == 500


def test_no_value_is_its_own_pseudonym():
    f = pii.Feistel(b"k")
    for n in (2, 3, 10, 97, 1000):
        assert all(f.permute(x, n, "t") != x for x in range(n))
        odd = {x: f.permute(x, n, "t", lambda y: y % 2 == 1 or n < 4) for x in range(n) if x % 2 == 1 or n < 4}
        assert sorted(odd.values()) == sorted(odd) and (len(odd) < 2 or all(a != b for a, b in odd.items()))
    p = pii.Pseudonyms(b"k")
    for c in "abcdefghijklmnopqrstuvwxyz0123456789жя":
        text, n = p.replace(f"{c}@example.com")
        assert n == 1 and text != f"{c}@example.com" and text.endswith("@example.com")


def test_names_of_all_scripts_are_replaced():
    p = pii.Pseudonyms(b"k")
    names = ["田中", "иван", "ivan.петров", "josé.núñez", "ÅSA", "straße", "Ελένη", "שלום", "x_1+tag", "José"]
    for name in names:
        for domain in ("example.jp", "пример.com", "bücher.example.org"):
            out, n = p.replace(f"to {name}@{domain}, please")
            got = out.removeprefix("to ").removesuffix(f"@{domain}, please")
            assert n == 1 and len(got) == len(name) and p.replace(f"{got}@{domain}")[1] == 1
            assert all(a.isalpha() == b.isalpha() and a.isupper() == b.isupper() for a, b in zip(name, got, strict=True))
            assert all(part not in out for part in name.replace("+", ".").replace("_", ".").split(".") if len(part) > 2 and part != "tag")
    # equal but for case: one pseudonym, the case put back
    low, mixed = (p.replace(f"{x}@a.com")[0] for x in ("jo.émile", "Jo.ÉMILE"))
    assert low != mixed and low == mixed.lower()
    assert len({p.email(f"ab{c}") for c in "abcdefghij"}) == 10


def test_short_dates_and_long_addresses():
    p = pii.Pseudonyms(b"k")
    out, n = p.replace("2003/2/1 2003/02/01 2003-02-01 12:30:45 std::vector a::b 2001:db8:0:0:1:0:0:1 2001:0db8:0::1:0:0:1 fe80::1")
    short, padded, dashed, *rest = out.split()
    year, month, day = map(int, short.split("/"))
    assert n == 5 and (year, month, day) != (2003, 2, 1)
    assert padded == f"{year:04d}/{month:02d}/{day:02d}" and dashed == padded.replace("/", "-")
    assert rest[:3] == ["12:30:45", "std::vector", "a::b"] and rest[3] == rest[4] != "2001:0db8:0000:0000:0001:0000:0000:0001"
    assert rest[5] == "fe80::1"  # too short to tell from other text


def plain_finder(text):
    """Personal data by other means: every stretch between blanks, judged as a whole."""
    found = set()
    for part in text.split():
        part = part.strip(",;()")
        name, at, domain = part.rpartition("@")
        if at and name and "." in domain and all(x.isalnum() for x in domain.replace("-", "").split(".")):
            found.add(part)
        if part.isdigit() and 13 <= len(part) <= 19:
            doubled = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(part)))
            if doubled % 10 == 0 and len(set(part)) > 1:
                found.add(part)
        try:
            if 1900 <= dt.date.fromisoformat(part).year <= 2099 and part[4] == "-" and len(part) == 10:
                found.add(part)
        except ValueError:
            pass
        four = part.split(".")
        if len(four) == 4 and all(x.isdigit() and int(x) < 256 and x == str(int(x)) for x in four):
            found.add(part)
    return found


def test_no_planted_value_survives_in_long_texts():
    rng = random.Random(4)
    p, planted = pii.Pseudonyms(b"k"), []
    words = []
    for _ in range(60_000):
        kind = rng.randrange(40)
        if kind == 0:
            body = "".join(rng.choice("0123456789") for _ in range(rng.randrange(12, 18)))
            words.append(body + pii.luhn_digit(body))
        elif kind == 1:
            words.append((dt.date(1950, 1, 1) + dt.timedelta(rng.randrange(40_000))).isoformat())
        elif kind == 2:
            words.append(".".join(str(rng.randrange(256)) for _ in range(4)))
        elif kind == 3:
            words.append("".join(rng.choice("abcdéжя中A") for _ in range(rng.randrange(1, 9))) + "@mail.example.com")
        else:
            words.append(rng.choice(("plain", "word,", "3.14", "x9", "201", "(see)", "a:b", "10:30")))
    text = " ".join(words)
    planted = plain_finder(text)
    out, n = p.replace(text)
    after = out.split(" ")
    assert len(planted) > 4000 and len(after) == len(words)
    changed = [(a, b) for a, b in zip(words, after, strict=True) if a != b]
    assert n == len(changed) and {a.strip(",;()") for a, _ in changed} == planted
    links = {}
    assert all(links.setdefault(a, b) == b for a, b in changed)


def test_pseudonyms_need_a_key(spark):
    docs = table(spark, ["4111111111111111"])
    with pytest.raises(ValueError, match="key"):
        pii.pseudonymised(docs, b"")
    own = pii.application_key(spark)
    assert own == pii.application_key(spark) and len(own) == 32
    spark.conf.set(pii.SETTING, "said")
    try:
        assert pii.application_key(spark) == b"said"
    finally:
        spark.conf.unset(pii.SETTING)


def test_pii_table(spark):
    rows = pii.pseudonymised(table(spark, ["4111111111111111", "x 4111111111111111", None, ""]).withColumn("n_values", F.lit("old")), b"k") \
        .orderBy("doc_id").collect()
    assert rows[1]["text"] == "x " + rows[0]["text"] and rows[2]["text"] is None and [r["n_values"] for r in rows] == [1, 1, 0, 0]


def test_chat_round_trip(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "a\\|<\\|<", "<", "", None, "\\"]
    rows = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate(zip(["user", "assistant", "sys\ntem", None] * 2, texts, strict=False))]
    back = chat.read_back(chat.formatted(chat.canonical(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string"))))
    for r in back.collect():
        assert [tuple(t) for t in r["read_turns"]] == [tuple(t) for t in r["turns"]] and len(r["turns"]) == 6
        assert r["loss_texts"] == [t["text"] for t in r["turns"] if t["role"] == "assistant"]


def test_chat_layouts_by_fingerprint(spark):
    records = [('{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}],"id":3}', "messages"),
               ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}', "from_value"),
               ('{"prompt":"q","response":"a"}', "prompt_response"), ('{"instruction":"q","output":"a"}', "instruction"),
               ('{"question":"q","answer":"a"}', "question_answer"), ('{"other":1}', None), (None, None)]
    out = chat.canonical_records(spark.createDataFrame([(r,) for r, _ in records], "record string"), "record").collect()
    assert {r["record"]: r["layout"] for r in out} == dict(records)
    assert all([tuple(t) for t in r["turns"]] == ([("user", "q"), ("assistant", "a")] if r["layout"] else []) for r in out)
    typed = spark.sql("SELECT 'q' AS instruction, 'i' AS input, 'a' AS output, 1 AS layout")
    assert [tuple(t) for t in chat.canonical(typed).first()["turns"]] == [("user", "q\n\ni"), ("assistant", "a")]


def test_shards_are_near_equal(spark):
    rng = random.Random(2)
    texts = [prose(rng, rng.randrange(1, 120)) for _ in range(1500)] + ["same words here"] * 700 + [None, ""]
    docs = table(spark, texts, [rng.choice("aaab") for _ in texts])
    rows = shards.sharded(docs, 7).collect()
    assert len(rows) == len(texts)
    size = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(7)]
    assert max(size) - min(size) < 0.05 * max(size)
    for s in range(7):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    assert shards.sharded(docs.limit(0)).count() == 0
    assert shards.sharded(docs.limit(2), 40).count() == 2


def test_host_rules_counts_and_verdicts(spark):
    rng = random.Random(4)
    texts = [prose(rng, rng.choice((20, 60, 200)), 30) + rng.choice(("", "\nsame line\nsame line\n \n", " ##$")) for _ in range(80)]
    texts += ["a b a b a b a b " * 20, None, "", "\n\n"]
    docs = table(spark, texts, ["bad" if len((t or "").split()) < 50 else "good" for t in texts])
    for r in host_rules.verdicts(docs).collect():
        t = texts[r["doc_id"]] or ""
        w = t.split()
        wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        covered = {i + k for i, g in enumerate(wins) if wins.count(g) > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if x.strip()]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])
    kept = host_rules.kept_documents(docs)
    assert kept.columns == docs.columns and kept.where("source = 'bad'").count() == 0


def test_bad_host_loses_all_its_documents(spark):
    good = " ".join(f"w{i}" for i in range(80))
    docs = table(spark, [good] * 60 + ["short"] * 50 + [good] * 2, ["good"] * 60 + ["bad"] * 52)
    kept = {r["doc_id"] for r in host_rules.verdicts(docs).collect() if r["kept"]}
    assert kept == set(range(60))


@pytest.mark.parametrize("later", ["shingles", "toxicity"])
def test_a_reused_worker_drops_what_packing_kept(later):
    """The words that packing remembers don't stay beside the next stage's memory; within the stage they do."""
    path = tokenizer_path("word_bpe_49k.json")
    texts = ["one two three four five six", "one more"]
    before = [packing._tokenizer(path).encode(t) for t in texts]
    kept = weakref.ref(packing._tokenizer(path))
    assert kept() is packing._tokenizer(path)
    if later == "shingles":
        assert [len(s) for s in shingles.shingle_sets(pa.array(texts))] == [2, 1]
    else:
        assert len(toxicity.features(texts[0])[0])
    gc.collect()
    assert kept() is None
    assert [packing._tokenizer(path).encode(t) for t in texts] == before


def test_packing_encodes_batches_as_the_tokenizer_does(monkeypatch):
    """Words of all alphabets and cases, null texts, a slice of a batch, and memories far smaller than the batch."""
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    model, rng = Tokenizer.from_file(path), random.Random(7)
    monkeypatch.setattr(packing, "CACHED_PARTS", 40)
    monkeypatch.setattr(packing, "ENCODED_PARTS", 7)
    odd = ["", "İstanbul.", "ΣΑΣ!", "ÀÉÎÕÜ,", "Straße", "ÿ×÷ø", "ªº", "naïve's", "don't", "'Tis", "e\u0301a", "ŉ", "ǅ.", "дом,", "日本語。", "x1", "½",
           "<|endoftext|>", "a<|endoftext|>b", "foo<|", "\x1ca", "a\x85b", "a\u00a0b", "ﬁn", "K", "--", "a-b", "WORD%%%", "wörd***", "\x00"]
    texts = [None, "", " ", "\t\n"] + ["".join(w + rng.choice([" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x0c"]) for w in rng.choices(
        odd + [rng.choice("aàZÜß") * rng.randrange(1, 9) for _ in range(20)], k=rng.randrange(1, 60))) for _ in range(60)]
    words = packing.WordTokenizer(path)
    assert words.letters is not words.model
    for batch in (pa.array(texts), pa.array(texts)[5:31], pa.array([], pa.string()), pa.array([None], pa.string())):
        ids, at = words.encode_all(batch)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [
            model.encode(t or "", add_special_tokens=False).ids for t in batch.to_pylist()]


def test_packing_remembers_parts_not_every_form_of_a_word():
    """A word in capitals or before other punctuation takes no place of its own in a worker's memory."""
    words = packing.WordTokenizer(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(8)
    stems = ["".join(rng.choices("bcdfglmnprst", k=9)) for _ in range(1500)]
    forms = [f + end for s in stems for f in (s, s.title(), s.upper()) for end in ("", ".", ",", "!", "%%%", "***")]
    words.encode(" ".join(stems))
    tracemalloc.start()
    words.encode(" ".join(forms))
    gc.collect()
    grown = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert grown < 500_000  # 25,500 more forms


def test_packing_is_whole_and_tight(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    rng = random.Random(6)
    texts = [prose(rng, rng.randrange(1, 90)) for _ in range(300)] + [None, "", "İ Σσς dog's über<|endoftext|>x ½ ́a", prose(rng, 5000), "\x1c a\x85b"]
    rows = packing.pack_documents(table(spark, texts), path, sequence_tokens=256, group_pieces=150, with_ids=True).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["piece"]):
        assert r["start"] == len(got.setdefault(r["doc_id"], [])) and r["length"] == len(r["ids"])
        got[r["doc_id"]] += r["ids"]
    assert all(got[i] == model.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts))
    fill = {}
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 256 and len(fill) <= -(-sum(fill.values()) // 256) + 6


def test_best_two_fit_replaces_the_smallest():
    # greedy alone would fill 10 with 6 + 3 and strand 2 + 2: taking 3 back lets both in
    seq, _ = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert seq[0] == seq[2] == seq[3] != seq[1]


def test_queries_match_sql(spark):
    import duckdb

    from callsheet.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, sf)
        res = con.execute(sql)
        names = [d[0] for d in res.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, res.fetchall())), name


def test_pipeline_runs_whole(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert 0 < len(ids) < docs.count()


def test_pipeline_stages_keep_what_they_should(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline

    rng = random.Random(12)
    card = "4111111111111111"
    texts = [prose(rng, 80) + (" vile" * 4 if i % 6 == 5 else "") for i in range(60)]
    texts += [" ".join([*t.split()[:40], "changed", *t.split()[41:]]) for t in texts[:10]]
    texts += [f"{prose(rng, 80)} card {card} end" for _ in range(10)]
    texts += [f"w{i} w{i + 1} w{i + 2}" for i in range(50)] + [prose(rng, 80) for _ in range(2)]
    docs = {i: t for i, t in enumerate(texts)}
    table(spark, texts, ["good"] * 80 + ["bad"] * 52).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int("vile" in docs[i])) for i in range(48)], "doc_id bigint, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")

    stages = dict(corpus_pipeline.STAGES)
    scratch = Scratch(spark, "stages")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")

    def after(name):
        nonlocal df
        df = scratch.keep(stages[name](spark, df, str(tmp_path)))
        rows = df.collect()
        assert len({r["doc_id"] for r in rows}) == len(rows)
        return {r["doc_id"]: r["text"] for r in rows}

    want = {i: t for i, t in docs.items() if "vile" not in t}
    assert len(want) < len(docs) and after("toxicity") == want
    want = {i: t for i, t in want.items() if i < 80}
    assert after("host_rules") == want
    ids = sorted(want)
    _, group = brute_groups([want[i] for i in ids])
    want = {i: want[i] for k, i in enumerate(ids) if group[k] == k}
    assert len(want) < len(ids) and after("ngram_join") == want
    hidden = after("pii")
    assert hidden.keys() == want.keys()
    for i, t in want.items():
        before, there, end = t.partition(card)
        if there:
            new = hidden[i][len(before):len(hidden[i]) - len(end)]
            assert hidden[i] == before + new + end and new != card and new.isdigit() and pii.luhn_digit(new[:-1]) == new[-1]
        else:
            assert hidden[i] == t
    assert all(r["n_chars"] == len(r["text"]) for r in df.collect())
    model = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    total = {}
    for r in stages["packing"](spark, df, str(tmp_path)).collect():
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {i: len(model.encode(t, add_special_tokens=False).ids) + 1 for i, t in hidden.items()}
