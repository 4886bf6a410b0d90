"""Spelling variants by permuterm rotations.

A word of m letters, marked with a terminator, has m + 1 rotations. The rotation that starts behind
an edited letter has that letter last, so words that differ in it share all but the last character
of that rotation, and the word that lacks it has just this rest as a whole rotation. Sorted
rotations therefore hold all words near by one edit in groups: a rotation and the rotations that
are longer by one character. A group has at most as many members as there are letters, plus one,
whatever the table's size, so no group is ever large. Members of a group are near each other; each
learns how many others there are and which of them occurs most, and no pairs are formed.

A deletion from a run of equal letters is met in a group per letter of the run; only the first counts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditflow.llm.scratch import Scratch, importable, narrow

#: The letters of a run, and the least length of a word.
LETTERS, LEAST = "A-Za-zÀ-ÿ", 7
#: Stands behind a word's last letter; no letter itself.
TERMINATOR = "\u0001"
#: Characters of a text that are searched at once, and words that a task counts before it sends them on.
SLICE, HELD = 1 << 20, 1 << 19
_FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """Consecutive parts of a text that cut no run of letters."""
    between, at = re.compile(f"[^{LETTERS}]"), 0
    while len(text) - at > size:
        cut = between.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def count(worn: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word of at least ``LEAST`` letters occurs in the task's documents.

    Of the runs of a document whose checksum ``worn`` divides, one letter is taken out first; 0
    takes out none.
    """
    runs, held = re.compile(f"[{LETTERS}]{{{LEAST},}}"), Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            if not text.is_valid:
                continue
            start = zlib.crc32(f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode())
            for part in slices(text.as_py()):
                for run, n in Counter(runs.findall(part)).items():
                    word = run.lower() if run.isascii() else run.translate(_FOLD)
                    if worn and (h := zlib.crc32(word.encode(), start)) % worn == 0:
                        out = h % len(word)
                        word = word[:out] + word[out + 1 :]
                        if len(word) < LEAST:
                            continue
                    held[word] += n
            if len(held) > HELD:
                yield _counts(held)
                held = Counter()
    if held:
        yield _counts(held)


def _counts(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])


def words(docs: DataFrame, worn: int = 0, least: int = 2) -> DataFrame:
    """``(word, n)`` of the words that occur at least ``least`` times in ``docs(doc_id, text)``.

    Words are maximal runs of letters with A-Z lowered, of at least ``LEAST`` letters. Null and
    empty texts have none; a null doc_id counts as an empty one in checksums. Other columns are ignored.
    """
    importable(docs.sparkSession)
    own = docs.select("doc_id", "text").mapInArrow(narrow(count, worn), "word string, n long")
    return own.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


#: The places of a word's letters; a place is also the length of what stands before it.
_ROTATIONS = """
concat(
  transform(sequence(0, length(word)), i -> struct(
    concat(substring(word, i + 1), '{end}', substring(word, 1, i)) AS key,
    '' AS letter, false AS first)),
  transform(sequence(1, length(word)), i -> struct(
    concat(substring(word, i + 1), '{end}', substring(word, 1, i - 1)) AS key,
    substring(word, i, 1) AS letter,
    i = 1 OR substring(word, i, 1) <> substring(word, i - 1, 1) AS first)))"""


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, near)`` of the words that have near ones among ``words(word, n)``.

    ``near`` is the near word of largest n, ties to the smallest word, as ``(n, word)``.
    """
    rotations = words.select("n", F.explode(F.expr(_ROTATIONS.format(end=TERMINATOR))).alias("r")).select("r.key", "r.letter", "r.first", "n")
    # The word is what stands behind the terminator, the letter taken out and what stands before it.
    word = F.concat(F.substring_index("key", TERMINATOR, -1), "letter", F.substring_index("key", TERMINATOR, 1))
    group = Window.partitionBy("key")
    ranked = group.orderBy(F.desc("n"), word).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    member = F.struct("n", word.alias("word"))
    whole = F.col("letter") == ""
    met = rotations.select(
        word.alias("word"), whole.alias("whole"), "first",
        F.count(F.lit(1)).over(group).alias("members"),
        F.count_if(whole).over(group).alias("wholes"),
        F.count_if(F.col("first")).over(group).alias("firsts"),
        F.first(member).over(ranked).alias("best"),
        F.nth_value(member, 2).over(ranked).alias("second"),
    ).where("members > 1")
    others = F.when(F.col("whole"), F.col("firsts")).otherwise(
        F.col("members") - F.col("wholes") - 1 + F.when(F.col("first"), F.col("wholes")).otherwise(0)
    )
    best = F.when(F.col("best.word") == F.col("word"), F.col("second")).otherwise(F.col("best"))
    own = met.select("word", others.alias("others"), F.struct((-best["n"]).alias("less"), best["word"].alias("word")).alias("near"))
    own = own.groupBy("word").agg(F.sum("others").alias("n_near"), F.min("near").alias("near"))
    return own.select("word", "n_near", F.struct((-F.col("near.less")).alias("n"), F.col("near.word").alias("word")).alias("near"))


def variants(words: DataFrame, scratch: Scratch, ratio: int = 10) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each row of ``words(word, n)``.

    Words are near if one inserted, deleted or replaced letter makes one the other. ``form`` is the
    near word of largest n (ties: the smallest), if that is at least ``ratio`` (over 1) times the
    word's own n, else null; ``root`` is where the forms lead from the word, itself if it has none.
    Words hold no terminator and are distinct; rows with a null word are dropped; no words give no rows.
    """
    words = scratch.table(words.where("word is not null").select("word", "n"), "words")
    near = scratch.table(near_words(words), "near")
    own = words.join(near, "word", "left")
    form = F.when(F.col("near.n") >= ratio * F.col("n"), F.col("near"))
    own = own.select("word", form["word"].alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), form["n"].alias("form_n"))
    own = scratch.table(own, "forms")
    # n grows at least by the ratio with each form, so the way is short; each round doubles what was gone.
    way = own.where("form is not null").select("word", F.col("form").alias("to"))
    turn = 0
    while True:
        then = way.select(F.col("word").alias("to"), F.col("to").alias("next"))
        way = scratch.table(way.join(then, "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), f"way-{turn}")
        turn += 1
        if way.where("moved").isEmpty():
            break
        way = way.drop("moved")
    roots = way.select("word", F.col("to").alias("root"))
    return own.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
