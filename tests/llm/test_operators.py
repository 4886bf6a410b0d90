"""Operators against plain restatements, on hard rows and on the driver's smallest tables."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

import brute
from conftest_llm import BENCHMARK, fresh, hard_rows
from creditflow.llm import decontam, neardup, packing, records, stages, substring, vectors, warc
from creditflow.llm.queries import registered, tokenizer_path
from creditflow.sources.tables import table


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def pairs(spark, data, name, *columns):
    return [tuple(r) for r in table(spark, data, name).select(*columns).collect()]


def check_near_duplicates(got, rows, percent):
    want = brute.near_duplicates(rows, percent)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_of_hard_rows(spark, documents, percent):
    rows = hard_rows()
    check_near_duplicates(neardup.near_duplicates(documents(rows), fresh(spark), percent).collect(), rows, percent)


def test_near_duplicates_without_ids_and_repeated(spark, documents):
    rows = [(None, "a b c d e f g"), (None, "a b c d e f g"), (3, "a b c d e f g"), (3, "a b c d e f g"), (2, "a b c d e f g")]
    got = neardup.near_duplicates(documents(rows), fresh(spark)).collect()
    assert sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in got) == [
        ("2", 2, True), ("3", 2, False), ("3", 2, False), ("None", None, True), ("None", None, True),
    ]


def test_near_groups_are_whole(spark, documents):
    """Copies that are alike only by way of others, in one busy bucket."""
    base = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(120):
        own = list(base)
        for k in range(4):
            own[(i * 7 + k * 97) % 400] = f"own{i}x{k}"
        rows.append((i, " ".join(own)))
    rows.append((999, " ".join(base)))
    check_near_duplicates(neardup.near_duplicates(documents(rows), fresh(spark), 85).collect(), rows, 85)


def test_near_duplicates_query(spark, data):
    rows = pairs(spark, data, "documents", "doc_id", "text")
    check_near_duplicates(registered()["op2_odd_sketch"](spark, data).collect(), rows, 85)


def check_repeats(got, rows, window=20):
    want = brute.without_repeats(rows, window)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert order(tuple(r) for r in got) == order((d, n, m, digest(t)) for d, n, m, t in want)


@pytest.mark.parametrize("window", [20, 5, 7])
def test_repeats_of_hard_rows(spark, documents, window):
    rows = hard_rows() + [(None, "null id " + "shared " * 50), (None, "null id " + "shared " * 50), (4, "again " + "four " * 40)]
    check_repeats(substring.without_repeats(documents(rows), fresh(spark), window).collect(), rows, window)


def test_repeats_with_frequent_runs(spark, documents, monkeypatch):
    line = " ".join(f"l{k}" for k in range(12))
    rows = [(i, f"u{i} " * 9 + line + f" v{i}" * 15 + " " + line) for i in range(300)]
    check_repeats(substring.without_repeats(documents(rows), fresh(spark)).collect(), rows)


def test_repeats_query_and_text(spark, data):
    rows = pairs(spark, data, "documents", "doc_id", "text")
    check_repeats(registered()["op9_substring_dedup"](spark, data).collect(), rows)
    docs = table(spark, data, "documents")
    out = substring.without_repeats(docs, fresh(spark), keep=True)
    assert out.columns == ["row", "text", "n_words", "n_removed"]
    whole, want = dict(rows), {d: (m, t) for d, _, m, t in brute.without_repeats(rows)}
    for r in out.collect():
        removed, text = want[r["row"]["doc_id"]]
        assert r["text"] == (text if removed else whole[r["row"]["doc_id"]])


def test_decontamination_of_hard_rows(spark, documents):
    docs = hard_rows() + [(30, "x SHARED0 shared1, shared2-shared3 shared4 shared5 shared6 shared7 shared8 shared9 y"), (None, "one"), (31, "nine ten")]
    items = [(1, " ".join(f"shared{k}" for k in range(14))), (2, "one"), (3, None), (4, "..."), (5, "alpha word1"), (10, "one"), (None, "alpha"), (5, "alpha word1"), (7, "ten nine")]
    bench = spark.createDataFrame(items, BENCHMARK)
    got = decontam.contaminated(documents(docs), bench, fresh(spark)).collect()
    assert order(tuple(r) for r in got) == order(brute.contaminated(docs, items))


def test_passages_of_unnamed_items(spark, documents, tmp_path):
    passage = " ".join(f"w{k}" for k in range(12))
    docs = documents([(1, "x " + passage), (2, "a b named item"), (3, "clean")], clash=False)
    bench = spark.createDataFrame([(None, passage), (None, "named item"), (7, "named item")], BENCHMARK)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in registered()["op6_decontamination"](spark, str(tmp_path)).collect()}
    assert got == {1: (12, 0, True), 2: (2, 1, True), 3: (0, 0, False)}
    assert [r["doc_id"] for r in stages.decontaminated(spark, docs, str(tmp_path)).collect()] == [3]


def test_decontamination_in_blocks(spark, documents, data, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WINDOWS", 200)
    docs, items = pairs(spark, data, "documents", "doc_id", "text"), pairs(spark, data, "benchmark", "item_id", "text")
    got = decontam.contaminated(table(spark, data, "documents"), table(spark, data, "benchmark"), fresh(spark)).collect()
    assert order(tuple(r) for r in got) == order(brute.contaminated(docs, items))


def test_decontamination_query(spark, data):
    docs, items = pairs(spark, data, "documents", "doc_id", "text"), pairs(spark, data, "benchmark", "item_id", "text")
    got = registered()["op6_decontamination"](spark, data).collect()
    assert order(tuple(r) for r in got) == order(brute.contaminated(docs, items))
    assert any(r["contaminated"] for r in got) and not all(r["contaminated"] for r in got)


def test_records_of_hard_rows(spark, documents, tokenizer):
    rows = hard_rows() + [(None, "no id"), (12, "one")]
    got = records.round_trip(documents(rows), fresh(spark), tokenizer_path()).collect()
    want = brute.records(tokenizer, sorted(rows, key=lambda r: (r[0] is not None, r[0])))
    assert order(tuple(r) for r in got) == order(want)


def test_records_query(spark, data, tokenizer):
    rows = sorted(pairs(spark, data, "documents", "doc_id", "text"))
    got = registered()["op5_token_records"](spark, data).collect()
    assert order(tuple(r) for r in got) == order(brute.records(tokenizer, rows))


def test_damaged_records_are_refused():
    whole = records.frame(b"payload")
    assert records.unframe(whole) == b"payload"
    for k in range(len(whole)):
        bad = bytearray(whole)
        bad[k] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(bad))
    with pytest.raises(ValueError):
        records.unframe(whole[:-1])


def test_warc_of_hard_rows(spark):
    rows = [(1, "u\n x", "<p>a</p>"), (2, None, "<p>a</p>"), (2, "http://e/ü", "<p>b</p>"), (2, "http://e/ü", "<p>b</p>"), (None, "x", "<p>a</p>"), (None, "", "alone"),
            (3, "x", None), (4, "x", ""), (5, "x", "é" * 200_000), (6, "x", "\r\n\r\nWARC/1.1\r\n"), (-1, "x", "<p>b</p>")]
    pages = spark.createDataFrame([(*r, "y", "z") for r in rows], "page_id long, url string, html string, sha string, n string")
    got = warc.round_trip(pages, fresh(spark)).collect()
    assert order(tuple(r) for r in got) == order(brute.warc([(i, h) for i, _, h in rows]))


def test_warc_query(spark, data):
    rows = pairs(spark, data, "pages", "page_id", "html")
    got = registered()["op3_warc"](spark, data).collect()
    assert order(tuple(r) for r in got) == order(brute.warc(rows))


def test_damaged_warc_is_refused():
    good = warc.record(1, "http://e/", b"payload", None, False)
    assert warc.parse(good)["payload"] == b"payload"
    for bad in (good[:-1], good.replace(b"payload", b"paylode"), good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"WARC-Date", b"WARC-Type"), b""):
        with pytest.raises((ValueError, KeyError)):
            warc.parse(bad)


def test_vectors_of_hard_rows(spark):
    far = [[1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [-1.0, 0.0, 0.0, 0.0], [1.0, 0.1, 0.0, 0.0], [1.0, 0.2, 0.0, 0.0], [2.0, 0.0, 0.0, 0.0]]
    rows = [(i, v) for i, v in enumerate(far)] + [(10, far[0]), (11, None), (12, []), (13, [0.0] * 4), (14, [1.0, None, 0.0, 0.0]), (15, [float("nan")] * 4),
            (16, [float("inf"), 0.0, 0.0, 0.0]), (17, [1.0, 0.0]), (18, [1.0, 0.33, 0.0, 0.0]), (None, far[0]), (10, far[0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, rep int")
    got = vectors.near_duplicates(df, fresh(spark)).collect()
    want = brute.vector_links(list({i: (i, v) for i, v in rows}.values()), 0.95)
    assert len(got) == len(rows)
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, True)
        else:
            assert (r["n_links"], r["component_id"]) == want[r["vec_id"]], r


def test_vectors_query(spark, data):
    rows = pairs(spark, data, "embeddings", "vec_id", "embedding")
    want = brute.vector_links(rows, 0.95)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in registered()["op7_multi_index"](spark, data).collect()}
    assert got == want


def test_recall_of_the_index(spark, data):
    """Neighbours at many angles around the table's vectors, one of them with a busy group."""
    rng = np.random.RandomState(3)
    rows = [(i, np.array(v)) for i, v in pairs(spark, data, "embeddings", "vec_id", "embedding")]
    for i, v in list(rows):
        for k in range(40 if i == 7 else 2):
            aside = rng.standard_normal(len(v))
            rows.append((10_000 + 100 * i + k, v + aside * rng.uniform(0, 0.5) * np.sqrt((v @ v) / (aside @ aside))))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    want = brute.vector_links(rows, 0.95)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicates(df, fresh(spark)).collect()}
    total = sum(n for n, _ in want.values())
    assert total > 1000 and all(got[i][0] <= n for i, (n, _) in want.items())
    assert sum(n for n, _ in got.values()) >= 0.98 * total


def test_vectors_of_several_lengths(spark):
    """Each length has links of its own, in many cells and in one."""
    rng = np.random.RandomState(6)
    rows = []
    for width, n in ((16, 900), (12, 600), (3, 40), (1, 3)):
        base = rng.standard_normal((n, width))
        near = base[: n // 2] + rng.standard_normal((n // 2, width)) * 0.05
        rows += [(width, v) for v in np.vstack([base, near, base[:5]]).astype(np.float32).tolist()]
    rows = [(i, v) for i, (_, v) in enumerate(rows)]
    # An id in two lengths is a vector of each.
    twice = (0, rows[-1][1])
    want = {}
    for width in (16, 12, 3, 1):
        want |= brute.vector_links([r for r in rows if len(r[1]) == width], 0.95)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicates(df, fresh(spark)).collect()}
    for width in (16, 12, 3, 1):
        ids = [i for i, v in rows if len(v) == width]
        total = sum(want[i][0] for i in ids)
        assert total > 0 and 0.98 * total <= sum(got[i][0] for i in ids) <= total
    again = vectors.near_duplicates(spark.createDataFrame([*rows, twice], df.schema), fresh(spark))
    assert again.count() == len(rows) + 1


def test_recall_of_vectors_of_few_dimensions(spark, monkeypatch):
    """Vectors in a space of three dimensions, with many codes, against all pairs."""
    monkeypatch.setattr(vectors, "PER_CELL", 1)
    rng = np.random.RandomState(8)
    x = (rng.standard_normal((3000, 3)) @ rng.standard_normal((3, 64))).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = sum(r["n_links"] for r in vectors.near_duplicates(df, fresh(spark)).collect())
    x = x / np.sqrt((x.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    want = (x @ x.T >= 0.95).sum() - len(x)
    print("recall", got / want)
    assert 0.998 * want <= got <= want


def check_packing(got, rows, tokenizer, capacity):
    assert order((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == order(brute.pieces(tokenizer, rows, capacity))
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


@pytest.mark.parametrize("capacity", [4096, 16])
def test_packing_of_hard_rows(spark, documents, tokenizer, capacity):
    rows = hard_rows() + [(None, "no id"), (12, "one")]
    got = packing.pack(documents(rows), fresh(spark), tokenizer_path(), capacity=capacity).collect()
    check_packing(got, rows, tokenizer, capacity)


def test_packing_query_is_tight(spark, data, tokenizer):
    rows = pairs(spark, data, "documents", "doc_id", "text")
    got = registered()["op10_packing"](spark, data).collect()
    bins = check_packing(got, rows, tokenizer, 4096)
    assert len(bins) <= -(-sum(r["length"] for r in got) // 4096) * 1.02 + 2


def test_two_documents_replace_the_smallest():
    bins, places = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    # 6 and 3 leave one place; 2 and 2 fill it better than 3.
    assert bins.tolist() == [0, 1, 0, 0] and sorted(places.tolist()) == [0, 0, 6, 8]


def test_empty_tables(spark, documents):
    docs = documents([])
    assert neardup.near_duplicates(docs, fresh(spark)).count() == 0
    assert substring.without_repeats(docs, fresh(spark)).count() == 0
    assert records.round_trip(docs, fresh(spark), tokenizer_path()).count() == 0
    assert packing.pack(docs, fresh(spark), tokenizer_path()).count() == 0
    none = spark.createDataFrame([], BENCHMARK)
    assert decontam.contaminated(docs, none, fresh(spark)).count() == 0
    some = documents([(1, "a b")])
    assert [r["contaminated"] for r in decontam.contaminated(some, none, fresh(spark)).collect()] == [False]
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages, fresh(spark)).count() == 0
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"), fresh(spark)).count() == 0
