"""URL filter: rules first, then naive Bayes over segmented host and path tokens.

Host names run words together, so each letter run is split by a unigram model (Viterbi) of all
words of the pages' html. The words stay a table: the substrings of each distinct run are joined
with it, and a run is split by the costs that it met. The classifier's counts are tables as well;
a run adds the log odds of its words to a URL's, those of the ``HEAD`` most frequent runs at most
from a broadcast table, others by a join. The classifier learns from all URLs that a rule decides
and judges those that no rule fits. Rules say little about kinds of host that they never met, so a
list of seed words counts as evidence too, each like ``SEED_SHARE`` of the URLs that rules decide
(``SEED_LEAST`` URLs at least), and as a word of at least ``FREQUENT`` of all words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm.scratch import Scratch, narrow

FREQUENT = 1e-5
LONGEST_WORD = 24
# Words in host names that speak for blocking.
SEEDS = {
    "block": "adult ads advert bet bets betting casino casinos escort gambling jackpot lottery nude pharmacy pills "
    "poker porn porno roulette sex slots spam tracker tracking viagra warez xxx".split(),
}
SEED_SHARE, SEED_LEAST = 0.05, 20
#: Runs whose log odds are broadcast.
HEAD = 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PIECE = re.compile(r"[a-z]+|[0-9]+|[^a-z0-9./_~+=,;:@!$&'()*-]+")
_WORD = re.compile("[a-z]+")


def with_rule(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``ruled`` (the rule's verdict) to ``url``.

    ``rules`` are (verdict, host, path); the longest that fits wins, null where none does.
    """
    rest = F.expr("substring(url, instr(url, '://') + 3)")
    known = F.coalesce(F.instr("url", "://") > 0, F.lit(False))
    out = pages.withColumns(
        {
            "host": F.when(known, F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)).otherwise(""),
            "path": F.when(known, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(""),
        }
    )
    rule = verdict = F.lit(None).cast("string")
    for says, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return out.withColumns({"rule": rule, "ruled": verdict})


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = Counter()
        for html in batch.column("html"):
            counts.update(_WORD.findall((html.as_py() or "").lower()))
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])


@dataclass
class Segmenter:
    """Unigram word model; ``costs`` are negative log probabilities of known words."""

    costs: dict[str, float]
    unknown: float  # cost of a letter that no known word covers

    @classmethod
    def of(cls, counts: dict[str, int], total: int) -> Segmenter:
        total = max(total, 2)
        # A lone letter in a text is mostly a fragment; words of one letter split nothing.
        costs = {w: math.log(total / n) for w, n in counts.items() if 1 < len(w) <= LONGEST_WORD}
        return cls(costs, math.log(total) + 1)

    def split(self, run: str) -> list[str]:
        """The likeliest split of a letter run; a stretch of unknown letters is one ``?``."""
        best, back = [0.0] + [math.inf] * len(run), [0] * (len(run) + 1)
        for end in range(1, len(run) + 1):
            best[end], back[end] = best[end - 1] + self.unknown, -1
            for start in range(max(0, end - LONGEST_WORD), end):
                cost = self.costs.get(run[start:end])
                if cost is not None and best[start] + cost < best[end]:
                    best[end], back[end] = best[start] + cost, start
        words, end = [], len(run)
        while end:
            if back[end] < 0:
                end -= 1
                if not words or words[-1] != "?":
                    words.append("?")
            else:
                words.append(run[back[end] : end])
                end = back[end]
        words.reverse()
        return words


def keys(host: str, path: str) -> list[str]:
    """What a URL is made of: letter runs, numbers by their length, other characters as one sign."""
    out = []
    for side, part in (("h", host), ("p", path.lower())):
        for piece in _PIECE.findall(part):
            if piece[0].isascii() and piece[0].isdigit():
                out.append(f"{side}#{min(len(piece), 9)}")
            else:
                out.append(f"{side}:{piece}" if "a" <= piece[0] <= "z" else f"{side}*")
    return out


def count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys per verdict; the URLs count as key ``""``."""
    for batch in batches:
        counts = Counter()
        for host, path, verdict in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "ruled"))):
            counts.update((k, verdict) for k in keys(host, path))
            counts["", verdict] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in counts], pa.string()), pa.array([v for _, v in counts], pa.string()), pa.array(counts.values(), pa.int64())],
            names=["key", "verdict", "n"],
        )


def substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct substrings of each run that may be words."""
    for batch in batches:
        for run in batch.column("run").to_pylist():
            found = {run[a:b] for a in range(len(run)) for b in range(a + 2, min(a + LONGEST_WORD, len(run)) + 1)}
            yield pa.RecordBatch.from_arrays([pa.array([run] * len(found), pa.string()), pa.array(found, pa.string())], names=["run", "word"])


def split_runs(total: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each run's words with their counts in it, split by the counts of the words met in it."""
    for batch in batches:
        out = []
        for run, words, counts in zip(*(batch.column(c).to_pylist() for c in ("run", "words", "counts"))):
            split = Segmenter.of(dict(zip(words or (), counts or ())), total).split(run)
            out += [(run, word, c) for word, c in Counter(split).items()]
        columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["run", "word", "c"])


def weigh(odds, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the log odds of each URL's keys in the head, and its other keys."""
    known = odds.value
    for batch in batches:
        sums, rest = [], []
        for host, path in zip(*(batch.column(c).to_pylist() for c in ("host", "path"))):
            own = keys(host, path)
            sums.append(float(sum(known.get(k, 0.0) for k in own)))
            rest.append([k for k in own if k not in known])
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("path"), pa.array(sums, pa.float64()), pa.array(rest, pa.list_(pa.string()))], names=["host", "path", "odds", "rest"]
        )


def judged(
    pages: DataFrame, scratch: Scratch, rules: list[tuple[str, str, str]], seeds: dict[str, list[str]] = SEEDS
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for each page.

    A null URL or one without ``://`` has empty host and path and is judged by the class prior.
    Where both verdicts are as likely the verdict is ``allow``; where no URL is decided by a rule,
    only seed words speak against a URL. Rows are judged one by one, whatever their ids. Other columns are ignored.
    """
    words = scratch.table(
        pages.select("html").mapInArrow(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    total = words.agg(F.sum("n")).first()[0] or 0
    spark, least = pages.sparkSession, max(1, int(FREQUENT * total))
    # Seed words can be told apart in a name even where the pages hardly use them.
    extra = spark.createDataFrame([(w, least) for own in seeds.values() for w in own], "word string, n long")
    words = words.union(extra).where(F.length("word").between(2, LONGEST_WORD)).groupBy("word").agg(F.max("n").alias("n"))
    ruled = with_rule(pages.select(F.col("page_id").cast("long").alias("page_id"), "url"), rules)
    counted = ruled.select("host", "path", "ruled").mapInArrow(count_keys, "key string, verdict string, n long")
    counted = scratch.table(counted.groupBy("key", "verdict").agg(F.sum("n").alias("n")), "keys")
    urls = {r["verdict"]: r["n"] for r in counted.where("key = '' and verdict is not null").collect()}
    counted = counted.where("key <> ''").withColumn("run", F.when(F.substring("key", 2, 1) == ":", F.substring("key", 3, 1 << 30)))

    # Each distinct run with the words that occur in it.
    runs = counted.where("run is not null").select("run").distinct()
    met = runs.mapInArrow(substrings, "run string, word string").join(words, "word")
    met = met.groupBy("run").agg(F.collect_list(F.struct("word", "n")).alias("met"))
    met = runs.join(met, "run", "left").select("run", F.col("met.word").alias("words"), F.col("met.n").alias("counts"))
    splits = scratch.table(met.mapInArrow(narrow(split_runs, total), "run string, word string, c long"), "splits")

    def tokens_of(table: DataFrame) -> DataFrame:
        """Rows of keys with each key's tokens and their counts in it."""
        whole = table.where("run is null").withColumns({"token": F.col("key"), "c": F.lit(1).cast("long")}).drop("run")
        return table.join(splits, "run").withColumn("token", F.concat(F.substring("key", 1, 2), "word")).drop("run", "word").unionByName(whole)

    # Naive Bayes: seeds add to tokens, not to the verdicts' totals.
    weight = max(SEED_LEAST, int(SEED_SHARE * sum(urls.values())))
    seeded = spark.createDataFrame(
        [(f"h:{w}", *(weight if v == verdict else 0 for v in ("allow", "block")), 0, 0) for verdict, own in seeds.items() for w in own],
        "token string, allow long, block long, allow_seen long, block_seen long",
    )
    of = lambda verdict: F.sum(F.when(F.col("verdict") == verdict, F.col("n") * F.col("c")).otherwise(0))
    learnt = tokens_of(counted.where("verdict is not null")).groupBy("token").agg(of("allow").alias("allow"), of("block").alias("block"))
    learnt = learnt.withColumns({"allow_seen": F.col("allow"), "block_seen": F.col("block")}).unionByName(seeded)
    tokens = scratch.table(learnt.groupBy("token").agg(*(F.sum(c).alias(c) for c in learnt.columns if c != "token")), "tokens")
    size, *seen = tokens.agg(F.count("*"), F.sum("allow_seen"), F.sum("block_seen")).first()
    allow, block = ((n or 0) + size + 1 for n in seen)
    tokens = tokens.select("token", (F.log((F.col("block") + 1) / block) - F.log((F.col("allow") + 1) / allow)).alias("odds"))
    prior = math.log((urls.get("block", 0) + 1) / (urls.get("allow", 0) + 1)) if urls else -1.0

    # Log odds of each key. The tokens of unknown letters are in very many keys and are not joined.
    unknown = {r["token"]: r["odds"] for r in tokens.where(F.col("token").isin("h:?", "p:?")).collect()}
    held = tokens_of(counted.groupBy("key", "run").agg(F.sum("n").alias("n")))
    strange = F.col("token").isin("h:?", "p:?")
    odds = F.when(F.col("token") == "h:?", unknown.get("h:?", 0.0)).otherwise(unknown.get("p:?", 0.0))
    held = held.where(~strange).join(tokens, "token", "left").unionByName(held.where(strange).withColumn("odds", odds))
    of_keys = held.groupBy("key").agg(F.max("n").alias("n"), F.sum(F.col("c") * F.coalesce("odds", F.lit(0.0))).alias("odds"))
    of_keys = scratch.table(of_keys.withColumn("level", F.floor(F.log2("n") * 16)), "odds")
    # The head's least count, on a fixed scale of counts, so that few rows decide it.
    line, room = 1 << 30, HEAD
    for row in sorted(of_keys.groupBy("level").count().collect(), reverse=True):
        room -= row["count"]
        if room < 0:
            break
        line = row["level"]
    head = spark.sparkContext.broadcast({r["key"]: r["odds"] for r in of_keys.where(F.col("level") >= line).select("key", "odds").collect()})

    open_ = ruled.where("ruled is null")
    weighed = open_.select("host", "path").distinct().mapInArrow(narrow(weigh, head), "host string, path string, odds double, rest array<string>")
    weighed = scratch.table(weighed, "weighed")
    rest = weighed.select("host", "path", F.explode("rest").alias("key")).join(of_keys.where(F.col("level") < line).select("key", "odds"), "key")
    sums = weighed.select("host", "path", "odds").union(rest.select("host", "path", "odds")).groupBy("host", "path").agg(F.sum("odds").alias("odds"))
    verdict = F.when(F.col("odds") + prior > 0, "block").otherwise("allow").alias("verdict")
    judged = open_.select("page_id", "host", "path", "rule").join(sums, ["host", "path"]).select("page_id", "host", "path", "rule", verdict)
    return ruled.where("ruled is not null").select("page_id", "host", "path", "rule", F.col("ruled").alias("verdict")).union(judged)
