"""Spelling variants: words that differ by one letter, found through a pair dictionary of trie nodes.

The prefixes of all words are numbered as the nodes of a trie, their suffixes as the nodes of the
trie of reversed words. A word without the letter at a place is then the pair of integers (prefix
node before it, suffix node after it), whatever the word's length, and a whole word cut at any place
is such a pair too. Two words that skip a letter and meet in a pair differ by a replaced letter; a
word that skips one and a whole word that meet differ by an inserted one. Meeting is equality of
strings, so neighbours are exact. The words that meet in one pair differ in a single letter, so a
pair has one member a letter of the alphabet and one whole word at most.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from firmlens.llm.common import rows, texts
from firmlens.session import parallelism, settle

RUN = re.compile("[A-Za-zÀ-ÿ]+")
TYPO_ONE_IN = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A word's form has at least so many times its count.
FACTOR = 5
#: Words whose counts a task holds before it passes them on.
COUNTED_AT_ONCE = 40_000

SKIPS, SKIPS_RUN_END, WHOLE = 0, 1, 2


def _doc_words(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """The document's long enough runs with their counts, after the letters that the key deletes."""
    lowered = text.encode().lower().decode()  # bytes lower-case A-Z only
    for run, n in Counter(r for r in RUN.findall(lowered) if len(r) >= LEAST_LENGTH).items():
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        if h % TYPO_ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LENGTH:
            yield run, n


def word_counts(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """word and n of the words of all whole texts that occur ``least`` times or more.

    A null text has no words, a null doc_id counts as the empty text in the key; repeated rows count
    as often as they come, other columns are not read. A task passes on sums, so a frequent word
    sends the shuffle one row a task and flush.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in rows(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                for word, n in _doc_words(doc_id, text):
                    held[word] = held.get(word, 0) + n
                if len(held) >= COUNTED_AT_ONCE:
                    yield out()
                    held = {}
        yield out()

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _paths(keys: DataFrame) -> DataFrame:
    """key, n, part and path: the nodes of the key's prefixes by length, numbered from 0 in its part.

    Keys (distinct, not null, not empty) are sorted in ranges, so the keys of a node follow each other
    and what a key shares with the one before is known. The first key of a part has a path of its
    own; ``_carried`` says which of its nodes were there in earlier parts.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, path, size = TaskContext.get().partitionId(), "", np.zeros(0, np.int64), 0
        for batch in rows(batches):
            names, paths = batch.column("key").to_pylist(), []
            for key in names:
                shared = len(os.path.commonprefix([before, key]))
                path = np.concatenate([path[:shared], np.arange(size, size + len(key) - shared)])
                size += len(key) - shared
                before = key
                paths.append(path)
            lists = pa.LargeListArray.from_arrays(np.cumsum([0, *map(len, paths)]), pa.array(np.concatenate(paths)))
            parts = pa.array([part] * len(names), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n"), parts, lists.cast(pa.list_(pa.int64()))], ["key", "n", "part", "path"])

    ranges = keys.select("key", "n").repartitionByRange(parallelism(keys.sparkSession), "key").sortWithinPartitions("key")
    return settle(ranges.mapInArrow(number, "key string, n long, part int, path array<long>"))


def _carried(paths: DataFrame) -> dict[int, tuple[np.ndarray, int]]:
    """For each part: the global numbers of its first nodes as far as earlier parts have them, and
    the number of its first new node. The root is 0.

    Two keys a part come to the driver, whatever the number of words.
    """
    ends = paths.groupBy("part").agg(F.min("key").alias("first"), F.max(F.struct("key", "path")).alias("last"))
    carried, size, before, path = {}, 1, "", np.zeros(0, np.int64)
    for row in sorted(ends.collect(), key=lambda r: r["part"]):
        shared = len(os.path.commonprefix([before, row["first"]]))
        carried[row["part"]] = path[:shared], size
        before, local = row["last"]["key"], np.array(row["last"]["path"], np.int64)
        path = _numbers(local, carried[row["part"]])
        size += int(local[-1]) + 1 - shared
    return carried


def _numbers(local: np.ndarray, carry: tuple[np.ndarray, int]) -> np.ndarray:
    """Global numbers of a part's nodes."""
    known, first = carry
    out = local + (first - len(known))
    if len(known) and len(old := np.flatnonzero(local < len(known))):
        out[old] = known[local[old]]
    return out


def _pairs(words: DataFrame, forward: dict, backward: dict) -> DataFrame:
    """p, s, kind, id, n: every word with each letter skipped, and whole at each cut. Of equal letters
    in a row only the last one's skip counts as a deletion, since all give the same word."""
    schema = pa.schema([("p", pa.int64()), ("s", pa.int64()), ("kind", pa.int8()), ("id", pa.int64()), ("n", pa.int64())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("word", "n", "part", "path", "back_part", "back_path")
        for batch in rows(batches):
            each = []
            for word, n, part, path, back_part, back_path in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                p = np.concatenate([[0], _numbers(np.array(path, np.int64), forward[part])])
                s = np.concatenate([[0], _numbers(np.array(back_path, np.int64), backward[back_part])])[::-1]
                letters = np.frombuffer(word.encode("utf-32-le"), np.uint32)
                run_end = np.append(letters[1:] != letters[:-1], True)
                kind = np.concatenate([run_end, np.full(len(word) + 1, WHOLE)])
                each.append((np.concatenate([p[:-1], p]), np.concatenate([s[1:], s]), kind, np.full(len(kind), p[-1]), np.full(len(kind), n)))
            columns = [pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*each, strict=True), schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return words.mapInArrow(emit, "p long, s long, kind byte, id long, n long")


def _met(pairs: DataFrame) -> DataFrame:
    """id, n_near, best (count and negated id of the commonest near word) of words that have any.

    A pair's members are one a letter at most; each learns how many others it meets and the best of
    them from the two best of all, so no two members are set side by side.
    """
    both = pairs.groupBy("p", "s").agg(F.collect_list(F.struct("n", (-F.col("id")).alias("back"), "kind")).alias("m")).where(F.size("m") > 1)
    skips = F.sort_array(F.filter("m", lambda x: x["kind"] != WHOLE), asc=False)
    both = both.select(skips.alias("skips"), F.filter("m", lambda x: x["kind"] == WHOLE).alias("whole"))
    both = both.withColumn("cuts", F.filter("skips", lambda x: x["kind"] == SKIPS_RUN_END))

    def known(x):
        return F.struct(x["n"].alias("n"), x["back"].alias("back"))

    def of_skip(x):
        inserted = (x["kind"] == SKIPS_RUN_END) & (F.size("whole") > 0)
        first, second = F.get("skips", F.lit(0)), F.get("skips", F.lit(1))
        other = F.when(first["back"] != x["back"], known(first)).when(F.size("skips") > 1, known(second))
        return F.struct(
            (-x["back"]).alias("id"),
            (F.size("skips") - 1 + F.when(inserted, 1).otherwise(0)).alias("met"),
            F.greatest(other, F.when(inserted, known(F.get("whole", F.lit(0))))).alias("best"),
        )

    def of_whole(x):
        first = F.get("cuts", F.lit(0))
        return F.struct((-x["back"]).alias("id"), F.size("cuts").alias("met"), F.when(F.size("cuts") > 0, known(first)).alias("best"))

    each = both.select(F.explode(F.concat(F.transform("skips", of_skip), F.transform("whole", of_whole))).alias("e"))
    each = each.select("e.id", "e.met", "e.best").where(F.col("met") > 0)
    return each.groupBy("id").agg(F.sum("met").cast("long").alias("n_near"), F.max("best").alias("best"))


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """id, root of words that have a form: forms followed to the last. Each step multiplies the count
    by ``FACTOR``, so the number of steps, doubled a round, is bounded by the largest count."""
    steps = max(1, math.floor(math.log(max(most, 2), FACTOR)))
    at = forms.select("id", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = at.select(F.col("id").alias("root"), F.col("root").alias("__next"))
        at = settle(at.join(further, "root", "left").select("id", F.coalesce("__next", "root").alias("root")))
    return at


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for distinct words (word, n).

    Near words differ by one inserted, deleted or replaced code point. A word's form is its near word
    of largest n (ties: the first in code-point order) if that is ``FACTOR`` times its own; its root
    is the last form in a row of them, or itself. Without words there are no rows.
    """
    words = settle(words.select("word", "n"))
    forward = _paths(words.select(F.col("word").alias("key"), "n"))
    backward = _paths(words.select(F.reverse("word").alias("key"), "n"))
    ahead, behind = _carried(forward), _carried(backward)
    both = forward.withColumnRenamed("key", "word").join(
        backward.select(F.reverse("key").alias("word"), F.col("part").alias("back_part"), F.col("path").alias("back_path")), "word"
    )
    near = settle(_met(_pairs(both, ahead, behind)))
    # One row a part. A word's own node is new in its part, and nodes follow the order of words.
    shifts = words.sparkSession.createDataFrame([(p, first - len(known)) for p, (known, first) in ahead.items()], "part int, shift long")
    numbered = forward.join(F.broadcast(shifts), "part").select((F.element_at("path", -1) + F.col("shift")).alias("id"), F.col("key").alias("word"), "n")
    judged = numbered.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= FACTOR * F.col("n"), -F.col("best.back")).alias("form"),
    )
    judged = settle(judged)
    most = judged.agg(F.max("n")).first()[0] or 1
    roots = _roots(judged.where("form IS NOT NULL"), most)
    names = judged.select(F.col("id").alias("__id"), F.col("word").alias("__word"), F.col("n").alias("__n"))
    form = names.select(F.col("__id").alias("form"), F.col("__word").alias("form_word"), F.col("__n").alias("form_n"))
    root = names.select(F.col("__id").alias("root"), F.col("__word").alias("root_word"))
    # Words that have a form are few beside all words; their names are looked up, then joined once.
    formed = judged.where("form IS NOT NULL").select("id", "form").join(form, "form").join(roots.join(root, "root"), "id").select("id", "form_word", "form_n", "root_word")
    return judged.join(formed, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )


def spellings(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of all whole texts of ``docs`` (doc_id, text)."""
    return variants(word_counts(docs))
