"""Language identification: words first, then shorter and shorter character n-grams.

A known word adds its log frequency in each language. An unseen word backs off: the longest
n-grams of which any is known give their mean log frequencies, from ``LONGEST`` characters down to
one; a word without any known character adds nothing. The language with the largest sum wins.

Words and n-grams are learnt from about ``PER_LANGUAGE`` labelled documents of each language at
most, picked by the hash of their ids; counting runs in Spark, and the model's size is bounded by
the sample.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm.scratch import Scratch, narrow

PER_LANGUAGE = 1000
LONGEST = 5
#: Words and n-grams seen less often say little and are left out.
LEAST = 2
#: Unseen words that a worker remembers.
MEMORY = 200_000
UNKNOWN = "und"
#: Numerals such as fractions and Roman numbers count as word characters but are no letters; beyond
#: these code points there are none.
_NUMERALS = "".join(c for c in map(chr, range(0x20000)) if c.isnumeric() and not c.isdecimal() and not c.isalpha())
_WORD = re.compile(rf"[^\W\d_{_NUMERALS}]+")
#: Letters and numerals: a pattern of classes only, many times as fast as one that lists the numerals.
_RUN = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """The maximal runs of letters of a text in lower case; only runs that hold a numeral are split."""
    runs = _RUN.findall((text or "").lower())
    if "".join(runs).isalpha():
        return runs
    return [w for run in runs for w in ((run,) if run.isalpha() else _WORD.findall(run))]


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its ends marked."""
    marked = f"_{word}_"
    return [marked[k : k + n] for k in range(len(marked) - n + 1)]


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in counts], pa.string()), pa.array([b for _, b in counts], pa.string()), pa.array(counts.values(), pa.int64())],
        names=["lang", "key", "n"],
    )


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            counts.update((lang, w) for w in words(text.as_py()))
        yield _counted(counts)


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams of counted words, each as often as its words."""
    for batch in batches:
        counts = Counter()
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "key", "n"))):
            for size in range(1, LONGEST + 1):
                for gram in grams(word, size):
                    counts[lang, gram] += n
        yield _counted(counts)


@dataclass
class Model:
    """Log frequencies: a row of ``logs`` per word, and per n-gram."""

    languages: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray
    _unseen: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def of(cls, languages: list[str], words: list[tuple], grams: list[tuple]) -> Model:
        place = {x: k for k, x in enumerate(languages)}

        def table(counted: list[tuple]) -> tuple[dict[str, int], np.ndarray]:
            keys = {k: i for i, k in enumerate(sorted({key for _, key, _ in counted}))}
            counts = np.zeros((len(keys), len(languages)))
            for lang, key, n in counted:
                counts[keys[key], place[lang]] += n
            smooth = 0.5
            return keys, np.log((counts + smooth) / (counts.sum(axis=0) + smooth * max(1, len(keys))))

        return cls(languages, *table(words), *table(grams))

    def backoff(self, word: str) -> np.ndarray:
        """Mean log frequencies of the longest n-grams of which any is known."""
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            rows = [r for g in grams(word, n) if g != "_" and (r := self.grams.get(g)) is not None]
            if rows:
                return self.gram_logs[rows].mean(axis=0)
        return np.zeros(len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of a text and its probability; ties go to the first in alphabet."""
        found = words(text)
        if not found or not self.languages:
            return UNKNOWN, 0.0
        counts = Counter(found)
        rows, weights, total = [], [], np.zeros(len(self.languages))
        for word, n in counts.items():
            row = self.words.get(word)
            if row is not None:
                rows.append(row)
                weights.append(n)
                continue
            logs = self._unseen.get(word)
            if logs is None:
                if len(self._unseen) >= MEMORY:
                    self._unseen.clear()
                logs = self._unseen[word] = self.backoff(word)
            total = total + n * logs
        if rows:
            total = total + np.array(weights, dtype=np.float64) @ self.word_logs[rows]
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.languages[best], float(odds[best] / odds.sum())


def predict_rows(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = model.value
    for batch in batches:
        found = [known.predict(text.as_py()) for text in batch.column("_text")]
        kept = [c for c in batch.schema.names if c != "_text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
            names=[*kept, "lang_pred", "score"],
        )


def fit(docs: DataFrame, scratch: Scratch) -> Model:
    """Learn from ``text`` and ``lang`` of the rows given; rows without either are left out."""
    known = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    sizes = known.groupBy("lang").count()
    share = F.least(F.lit(1.0), F.lit(float(PER_LANGUAGE)) / F.col("count"))
    # One row per language.
    shares = scratch.table(sizes.select("lang", (share * (1 << 30)).cast("long").alias("below")), "shares")
    picked = known.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.col("below"))
    ddl = "lang string, key string, n long"
    summed = lambda df: df.groupBy("lang", "key").agg(F.sum("n").alias("n"))
    words = scratch.table(summed(picked.select("lang", "text").mapInArrow(count_words, ddl)), "words")
    parts = scratch.table(summed(words.mapInArrow(count_grams, ddl)), "grams")
    rows = lambda df: [(r["lang"], r["key"], r["n"]) for r in df.where(F.col("n") >= LEAST).toLocalIterator()]
    languages = sorted(r["lang"] for r in shares.collect())
    return Model.of(languages, rows(words), rows(parts))


def identified(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns named in ``keep`` with ``lang_pred`` and ``score`` for each row's whole text.

    A null text or one without a letter is ``und`` with score 0, as is every text if nothing was
    learnt. The score is the posterior probability of the language under equal priors.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(narrow(predict_rows, shared), f"{fields}, lang_pred string, score double")
