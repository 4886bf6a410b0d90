"""Spelling variants, nearest neighbours and collocations against plain restatements."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from conftest_llm import fresh, hard_rows
from creditflow.llm import automata, collocations, neighbours, spelling, text
from creditflow.llm.queries import registered
from creditflow.sources.tables import table


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, v) for v in r))


# Spelling variants


def spelled(rows, worn=31):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute._FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if worn and h % worn == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def grouped(n, ratio=10):
    letters, near = sorted(set("".join(n))), {}
    for w in n:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + x + w[j:] for i in range(len(w) + 1) for j in (i, i + 1) for x in letters}
        near[w] = sorted((e for e in edits if e != w and e in n), key=lambda e: (-n[e], e))
    form = {w: e[0] if e and n[e[0]] >= ratio * n[w] else None for w, e in near.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    rows = [(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n]
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def test_words_of_hard_rows(spark, documents):
    rows = hard_rows() + [(None, "Lettering lettering LETTERING×÷ÿÀ Ünïcôdé " * 3), (41, "x" * 90_000), (41, "x" * 90_000 + " " + "y" * 90_000), (42, None)]
    rows += [(k, "wondrous Wondrous wonderful! spelling-spelling") for k in range(100, 160)]
    for worn in (0, 1, 31):
        assert dict(found(spelling.words(documents(rows), worn))) == spelled(rows, worn)


def test_slices_cut_no_run():
    text = "abc defgh-" * 50 + "z" * 100 + " tail"
    for size in (1, 7, 64, 10_000):
        parts = list(spelling.slices(text, size))
        assert [r for p in parts for r in re.findall("[a-z]+", p)] == re.findall("[a-z]+", text)


def test_variants_of_hard_words(spark):
    """Runs of equal letters, ties, chains of forms, words that are near in many places, clashing columns."""
    n = {"aaaaaaa": 5, "aaaaaaaa": 50, "aaaaaaaaa": 500, "aaabaaa": 3, "aaabaaaa": 3, "baaaaaa": 1, "abababa": 7, "bababab": 70, "ababab": 700,
         "wonderful": 2, "wonderfull": 20, "wonderfu": 20, "wondarful": 20, "wonderfulll": 200, "zzzzzzzz": 2, "éèêëéèê": 4, "eèêëéèê": 40, "éèêëéèêé": 41, "alone": 9}
    words = spark.createDataFrame([(w, k, "x", "y", "z") for w, k in n.items()] + [(None, 3, "", "", "")], "word string, n long, key string, form string, root string")
    for ratio in (2, 10):
        assert found(spelling.variants(words, fresh(spark), ratio)) == grouped(n, ratio)
    assert spelling.variants(words.limit(0), fresh(spark)).count() == 0


def test_variants_of_many_near_words(spark):
    rng = np.random.RandomState(5)
    n = Counter("".join(rng.choice(list("abé"), rng.randint(5, 9))) for _ in range(4000))
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert found(spelling.variants(words, fresh(spark), 2)) == grouped(n, 2)


def test_spelling_query(spark, data):
    rows = [tuple(r) for r in table(spark, data, "documents").select("doc_id", "text").collect()]
    assert found(registered()["op11_spelling_variants"](spark, data)) == grouped(spelled(rows))


# Nearest neighbours


def nearest(rows, every=20, k=20):
    """Exact results of the distinct rows that can take part."""
    sound = {(i, tuple(x + 0.0 for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for i, q in sound:
        if i % every == 0:
            scored = sorted((-float(np.add.accumulate(np.array(q) * np.array(v))[-1]), j) for j, v in sound if j != i and len(v) == len(q))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def asked(df, spark, every=20, k=20):
    return found(neighbours.nearest(df, df.where(F.col("vec_id") % every == 0), fresh(spark), k))


def test_neighbours_of_hard_rows(spark):
    rng = np.random.RandomState(2)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((90, 4)).tolist())]
    rows += [(200 + i, rows[0][1]) for i in range(45)] + [(20, rows[20][1])]
    rows += [(300, None), (301, []), (320, [0.0] * 4), (340, [1.0, None, 0.0, 0.0]), (360, [float("nan")] * 4), (380, [float("inf"), 0.0, 0.0, 0.0]), (None, rows[0][1])]
    rows += [(400, [1.0, -0.0]), (401, [1.0, 0.0]), (402, [-1.0, 0.5]), (420, [3.0]), (500, [1e-3, 0.0, 0.0, 0.0]), (501, [1e3, 1.0, 0.0, 2.0]), (502, [-1e3, 1.0, 0.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, shard int, n int, query_id int")
    assert asked(df, spark) == nearest(rows)
    assert asked(df, spark, 1, 3) == nearest(rows, 1, 3)
    assert asked(df.limit(0), spark) == [] and asked(df.where("vec_id = 420"), spark) == []


def recall(got, want):
    assert len(got) == len(want) and {r[:2] for r in got} == {r[:2] for r in want}
    return len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}) / len(want)


def test_recall_over_shards_slices_and_norms(spark, monkeypatch):
    """Many shards and slices, a busy group of near copies, exact copies, and norms from 0.01 to 100."""
    monkeypatch.setattr(neighbours, "SHARDS_PER_ROOT", 0.2)
    rng = np.random.RandomState(3)
    x = rng.standard_normal((1500, 24))
    near = x[:1] + rng.standard_normal((700, 24)) * 0.05
    x = np.vstack([x, near, np.repeat(x[1:2], 300, axis=0), x[:500] * 10 ** rng.uniform(-2, 2, (500, 1))])
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).astype(float).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    want, got = nearest(rows), asked(df, spark)
    score = recall(got, want)
    print("recall", score)
    assert score >= 0.97
    assert all(s == float(np.add.accumulate(np.array(rows[q][1]) * np.array(rows[v][1]))[-1]) for q, _, v, s in got)


def test_neighbours_query(spark, data):
    rows = [tuple(r) for r in table(spark, data, "embeddings").select("vec_id", "embedding").collect()]
    got, want = found(registered()["op12_nearest_neighbours"](spark, data)), nearest(rows)
    assert recall(got, want) >= 0.99


def test_graph_keeps_diverse_edges():
    """Of members on a line only the next ones stay: those behind them are nearer to them."""
    x = np.arange(40, dtype=np.float32)[:, None]
    graph = neighbours.PrunedGraph(x, np.full((40, neighbours.DEGREE), -1, np.int32), 0)
    kept = graph.prune(np.array([20]), np.arange(40)[None, :])[0]
    assert sorted(kept[kept >= 0].tolist())[0] < 20 < max(kept) and len(kept[kept >= 0]) < 16
    assert {19, 21} <= set(kept.tolist())


# Collocations


def phrases(rows, least=100, longest=5, top=2000):
    f = {}
    for text, lang in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(brute._FOLD)):
            w = re.findall("[^\x20\x09]+", piece)
            own.update({(): len(w)})
            own.update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        many = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {p[i : i + k] for p, a in many.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 100 * c[p[i : i + k]]}
        ranked = []
        for p in many.keys() - inside:
            score, k = min((1000 * c[p] * c[()] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]], c[()]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r, n) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


TEXTS = "text string, lang string, phrase string, words int, range string"


def test_phrases_of_hard_rows(spark):
    rows = [(t, lang) for _, t in hard_rows() for lang in ("en", None, "und", "a\x02b")]
    rows += [("New York city, new  york\tcity! NEW york", "fr")] * 9 + [("la la la la la la", "fr"), ("ab cd, ef gh ij. " * 50_000, "fr"), ("é è é è. é è", "fr"), (None, "de"), ("", "de"), ("a,b;c:d!e?f\x0bg\x0ch\ri j", "de")]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], TEXTS).repartition(3)
    for least, longest, top in ((2, 5, 2000), (9, 3, 10), (3, 2, 5), (10**6, 5, 5)):
        got = found(collocations.collocations(df, fresh(spark), least, longest, top))
        assert got == phrases(rows, least, longest, top)
    assert collocations.collocations(df.limit(0), fresh(spark)).count() == 0


def test_phrases_in_small_parts(spark, data, monkeypatch):
    """Tasks send what they hold often, the map of bits is crowded, and ranges unite many parts."""
    for name, value in (("HELD_HASHES", 2000), ("HELD_PHRASES", 300), ("MAP_BITS", 17), ("RANGES", 7), ("UNITED", 2)):
        monkeypatch.setattr(collocations, name, value)
    docs = table(spark, data, "documents")
    rows = [tuple(r) for r in docs.select("text", "lang").collect()]
    assert found(collocations.collocations(docs.repartition(5), fresh(spark), 12)) == phrases(rows, 12)


def test_chains_of_frequent_pairs_are_not_phrases(spark):
    """Of words at random all pairs are frequent and no three in a row are: no task takes longer chains along."""
    rng = np.random.RandomState(5)
    rows = [(" ".join(f"w{x}" for x in rng.randint(0, 12, 400)), "en") for _ in range(20)]
    scratch = fresh(spark)
    got = found(collocations.collocations(spark.createDataFrame(rows, "text string, lang string"), scratch, 25))
    assert got == phrases(rows, 25) and len(got) > 100
    shards = spark.read.parquet(f"{scratch.root}/*-shards").where("weights is not null").toArrow()
    assert max(t.counted().sizes.max() for _, t in collocations.transducers(shards, 6)) == 3


def test_uniting_goes_by_what_there_is(monkeypatch):
    """However many transducers a range has, each phrase is taken along a few times only."""
    met = []
    monkeypatch.setattr(collocations, "union", lambda parts, *a: met.append(sum(len(p.labels) for p in parts)) or automata.union(parts, *a))
    parts = [automata.build(automata.Counted.of([((1, 10 + i), 1), ((1, 1000), 2)], 3)) for i in range(600)]
    rows = [collocations.transducer_row(4, t) for t in parts]
    (out,) = collocations.unite(2, 16, 3, iter(rows))
    ((r, t),) = collocations.transducers(out, 3)
    assert r == 4 and pairs_of(t.counted()) == [((1, 1000), 1200)]
    assert sum(met) < 5 * sum(len(t.labels) for t in parts)


def test_packed_counts_beyond_their_bits():
    keys, n = np.array([5 << 30, 7 << 30], np.uint64), np.array([3, (1 << 26) + 5])
    got = collocations._summed(np.concatenate([collocations._packed(keys, n)] * 2))
    assert got[0].tolist() == keys.tolist() and got[1].tolist() == (2 * n).tolist()


def test_hash_order_is_the_stable_order():
    rng = np.random.RandomState(1)
    for n, top in ((0, 9), (1, 9), (999, 50), (999, 1 << 62), (70_000, 1 << 62)):
        keys = rng.randint(0, top, n).astype(np.uint64)
        keys[n // 2 :] = keys[: n - n // 2]
        assert (text.hash_order(keys) == np.argsort(keys, kind="stable")).all()


def test_phrases_query(spark, data):
    rows = [tuple(r) for r in table(spark, data, "documents").select("text", "lang").collect()]
    assert found(registered()["op13_collocations"](spark, data)) == phrases(rows)


def test_long_texts_are_cut_where_pieces_end():
    data = np.frombuffer(b"aa bb, cc dd. ee ff; gg" + b"hh ii jj kk ll mm", np.uint8)
    offsets = np.array([0, 23, 23, 40])
    parts, owner = collocations.segments(data, offsets, 5)
    assert parts.tolist() == [0, 5, 12, 19, 23, 23, 40] and owner.tolist()[:4] == [0, 0, 0, 0] and owner[-1] == 2


def test_products_beyond_64_bits(spark):
    a, n, l, r = 10**12 + 7, 10**14 + 3, 10**13 + 9, 10**12 + 11
    df = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    got = df.selectExpr("(cast(a as decimal(18,0)) * 1000 * cast(n as decimal(15,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))").first()[0]
    assert got == 1000 * a * n // (l * r)


counts = st.dictionaries(st.lists(st.integers(1, 3), min_size=1, max_size=4).map(tuple), st.integers(1, 9), max_size=25)


def pairs_of(found):
    return sorted((tuple(x for x in row if x), n) for row, n in zip(found.labels.tolist(), found.n.tolist()))


def built_of(c):
    return automata.build(automata.Counted.of(sorted(c.items()), 4))


@settings(max_examples=80, deadline=None)
@given(st.lists(counts, min_size=1, max_size=5), st.integers(0, 12), counts)
def test_transducers_sum_and_compose(parts, least, asked):
    built = [built_of(c) for c in parts]
    for c, t in zip(parts, built):
        assert pairs_of(t.counted()) == sorted(c.items())
        arcs = [tuple(zip(t.labels[a:b].tolist(), t.targets[a:b].tolist())) for a, b in zip(t.first, t.first[1:])]
        assert all(list(a) == sorted(a) for a in arcs)
    total = Counter()
    for c in parts:
        total.update(c)
    united = automata.union(built)
    assert pairs_of(united.counted()) == sorted(total.items())
    kept = {p: n for p, n in total.items() if n >= least}
    assert pairs_of(automata.union(built, least).counted()) == sorted(kept.items())
    assert pairs_of(automata.composed(built_of(asked), united)) == sorted((p, total[p]) for p in asked if p in total)


def test_states_alike_are_one():
    """Two beginnings with the same endings of the same counts."""
    t = built_of({(1, 5): 2, (1, 6): 3, (2, 5): 2, (2, 6): 3, (3, 5): 2})
    assert len(t.weights) == 5 and len(t.labels) == 6
