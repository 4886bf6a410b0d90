"""The pipeline's stages against plain restatements of their decisions, each on its own input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from conftest_llm import DOCUMENT, fresh, hard_rows
from creditflow.llm import stages
from creditflow.llm.queries import tokenizer_path
from creditflow.llm.reference import statements
from creditflow.llm.scratch import Scratch
from creditflow.sources.tables import table
from oracle_check import compare, connect


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def order(found):
    return sorted(found, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.fixture(scope="module")
def steps(spark, data):
    """The input of each stage, and what it returns."""
    docs, out, scratch = table(spark, data, "documents"), {}, fresh(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = scratch.table(stage(spark, docs, data), f"stage-{k}")
        out[stage.__name__] = (docs, result)
        docs = result
    return out


def test_stages_return_documents(steps, spark, data):
    columns = table(spark, data, "documents").schema.simpleString()
    for name, (_, out) in steps.items():
        assert (out.schema.simpleString() == columns) == (name != "packed")


def test_bad_documents_go_and_good_ones_stay(steps, spark, data):
    before, after = steps["good_documents"]
    kept = {r["doc_id"] for r in after.collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, data, "labels").collect()}
    bad = [i for i, q in labels.items() if q == 0]
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in bad) <= 0.1 * len(bad) + 1
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert {i for i, _ in rows(after)} <= {i for i, _ in rows(before)}


def test_one_document_of_each_group_stays(steps):
    before, after = steps["deduplicated"]
    want = brute.near_duplicates(rows(before), 80)
    assert order(rows(after)) == order((i, t) for i, t in rows(before) if want[i][1] == i)


def test_repeated_passages_go(steps):
    before, after = steps["without_repeats"]
    want = {i: (m, text) for i, _, m, text in brute.without_repeats(rows(before))}
    whole = dict(rows(before))
    assert order(rows(after)) == order((i, want[i][1] if want[i][0] else t) for i, t in whole.items())
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect() if want[r["doc_id"]][0])


def test_contaminated_documents_go(steps, spark, data):
    before, after = steps["decontaminated"]
    items = [tuple(r) for r in table(spark, data, "benchmark").select("item_id", "text").collect()]
    bad = {r[0] for r in brute.contaminated(rows(before), items) if r[-1]}
    assert order(rows(after)) == order((i, t) for i, t in rows(before) if i not in bad)


def test_all_that_is_left_is_packed(steps):
    from tokenizers import Tokenizer

    before, after = steps["packed"]
    want = brute.pieces(Tokenizer.from_file(tokenizer_path()), rows(before), 4096)
    assert order((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in after.collect()) == order(want)


def test_run_is_the_stages_in_turn(steps, spark, data):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = corpus_pipeline.run(spark, data).select(columns)
    assert order(tuple(r) for r in whole.collect()) == order(tuple(r) for r in steps["packed"][1].select(columns).collect())


def test_stages_take_hard_rows(spark, documents, data):
    docs = documents(hard_rows() + [(None, None), (None, "null id")], clash=True)
    repeated = docs.unionByName(docs.where("doc_id = 1"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, repeated, data)
        assert out.columns == docs.columns
        out.collect()
        assert stage(spark, docs.limit(0), data).count() == 0
    kept = stages.deduplicated(spark, repeated, data)
    assert kept.where("doc_id = 1").count() == 1 and kept.where(F.col("doc_id").isNull()).count() == 2
    packed = corpus_pipeline.STAGES[-1][1](spark, repeated, data)
    assert packed.select("doc_id").distinct().count() == repeated.select("doc_id").distinct().count()


def python_workers(df):
    """The most Python steps that stand above each other without an exchange, as a task holds a worker for each."""
    most, path = 0, []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        name = line.lstrip(" :+-")
        path = [(depth, kind) for depth, kind in path if depth < len(line) - len(name)]
        path.append((len(line) - len(name), "exchange" if "Exchange" in name else "python" if "InArrow" in name else ""))
        kinds = [kind for _, kind in path]
        own = kinds[len(kinds) - kinds[::-1].index("exchange") :] if "exchange" in kinds else kinds
        most = max(most, own.count("python"))
    return most


def test_a_task_holds_one_python_worker(spark, documents, data, monkeypatch):
    """Workers are kept, so the most that tasks hold at once is what an executor's memory has for good."""
    plain = spark.range(3).mapInArrow(lambda batches: batches, "id long")
    assert [python_workers(df) for df in (plain, plain.mapInArrow(lambda batches: batches, "id long"), plain.repartition("id").mapInArrow(lambda batches: batches, "id long"))] == [1, 2, 1]
    seen, write = {}, Scratch.table

    def table_(self, df, name, instead=None):
        seen[name] = max(seen.get(name, 0), python_workers(df))
        return write(self, df, name, instead)

    monkeypatch.setattr(Scratch, "table", table_)
    docs = documents(hard_rows())
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = python_workers(stage(spark, docs, data))
    assert {name: n for name, n in seen.items() if n > 1} == {}
    python = ["scores", "signatures", "first-links", "spans", "pieces", "benchmark decontamination"]
    assert {name: seen[name] for name in python} == dict.fromkeys(python, 1)


def test_texts_that_share_an_id_are_documents_of_their_own(spark, data):
    one, two = (" ".join(f"{c}{k}" for k in range(40)) for c in ("left", "right"))
    other = " ".join(f"other{k}" for k in range(40))
    given = [(1, one), (1, two), (1, two), (2, one), (3, two + " more"), (4, other), (None, other), (5, None), (5, "")]
    docs = spark.createDataFrame([(i, text, "en", "a", k) for k, (i, text) in enumerate(given)], DOCUMENT)
    kept = stages.deduplicated(spark, docs, data)
    assert kept.columns == docs.columns
    left = rows(kept)
    # One document of each group, whichever goes by the id; the repeated row once; nothing unlike is lost.
    assert sum(text == one for _, text in left) == 1
    assert sum(text is not None and text.startswith(two) for _, text in left) == 1
    assert sorted((i or 0) for i, text in left if text == other) == [0, 4]
    assert sorted(text is None for i, text in left if i == 5) == [False, True]
    assert len(left) == 6


@pytest.mark.parametrize("name", sorted(statements()))
def test_query_matches_sql(spark, data, name):
    from creditflow.llm.queries import registered

    n_rows, problems = compare(registered()[name](spark, data), connect(data), statements()[name])
    assert not problems and n_rows > 0
