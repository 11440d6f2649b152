"""Spelling variants: pairs of words one edit apart, grouped under their commonest form.

Words are the runs of letters of whole texts; a vocabulary is the words of at least
``MIN_LENGTH`` characters and ``MIN_COUNT`` occurrences. Two words are near if one inserted,
deleted or replaced character makes them equal.

Method: a variable-length gram index. Each word stands between ``^`` and ``$``.

1. *Dictionary.* The grams of ``Q_MIN`` to ``Q_MAX`` characters of the vocabulary form a
   trie with counts, built from the longest grams upwards. It is pruned by frequency: a gram
   has longer ones below it only if it occurs more than ``PRUNE`` times.
2. *Decomposition.* At each place a word has the gram where the walk down the trie ends: the
   shortest that is not frequent, or ``Q_MAX`` characters. The choice reads no character
   beyond the gram, so an edit affects exactly the grams that reach over it.
3. *Bound.* ``affected`` of a word is the largest number of its grams that cover one place.
   A near word shares all others, with their places moved by one at most. So of
   the ``affected + 1`` rarest grams of either word at least one is shared, the rarest
   common one (ties by gram and place). Words have ``length + 1`` grams, more than
   ``Q_MAX`` (checked), so no word is without such a gram.
4. *List merging.* Only those rarest grams are posted, under (gram, place, length).
   A word is looked up at its own list of the same length, and at the two lists of length
   + 1 where an insertion before or behind the gram would put it.
5. *Verification* by edit distance, in the join.

Lists are short by the pruning and by place and length; the join is an equi-join of posted
grams with the lists, which adaptive execution splits where a list is hot. All
tables are of the size of the vocabulary; nothing of it passes through the driver.

Defined results: null and empty texts have no words; repeated rows count each time; a null
id is an empty string in the digest that picks altered runs; words of any length are compared
whole; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm.common import map_batches, narrow, stored

Q_MIN, Q_MAX = 2, 5
PRUNE = 64
MIN_LENGTH, MIN_COUNT = 5, 3
SHARE = 2            # a form has at least so many times the occurrences
ALTER_EACH = 97      # of the runs of a document, one in so many loses a character
SLICE = 1 << 20      # characters of a text that are cut into words at a time
FLUSH = 200_000      # distinct words a task counts before it passes them on

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def runs(text: str):
    """Lists of the lower-cased runs of a text, slice by slice; no run is cut."""
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):  # the run over the end belongs to this slice
            over = _RUN.match(text, end)
            end = over.end() if over else end
        yield _RUN.findall(text[at:end].translate(_LOWER))
        at = end


def altered(doc_id: str, run: str, each: int = ALTER_EACH) -> str:
    """The run, without one character if the digest of document and run says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if each and h % each == 0:
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return run


def _count(each: int, min_length: int):
    """Arrow task: words and their occurrences, combined before they are shuffled."""
    def run(batches):
        total: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                here: Counter = Counter()
                for part in runs(text.as_py() or ""):
                    here.update(part)
                for word, n in here.items():
                    word = altered(doc_id or "", word, each)
                    if len(word) >= min_length:
                        total[word] += n
                if len(total) > FLUSH:
                    yield flush()
        yield flush()
    return run


def vocabulary(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", each: int = ALTER_EACH, min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT) -> DataFrame:
    """(id, word, n) of the words of a corpus; ``id`` is a number of our own."""
    rows = narrow(docs, id=id_col, text=text_col)
    rows = rows.select(F.col("id").cast("string").alias("id"), "text")
    words = map_batches(rows, _count(each, min_length), "word string, n bigint")
    words = words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return stored(spark, words.select(F.monotonically_increasing_id().alias("id"), "word", "n"),
                  "vocabulary")


def _grams(words: DataFrame, q_max: int) -> DataFrame:
    """(id, place, gram) with ``q_max`` characters from each place but the last."""
    pad = "$" * (q_max - 1)
    chars = words.select("id", F.split(F.concat(F.lit("^"), "word", F.lit(pad)), "").alias("c"))
    chars = chars.withColumn("c", F.filter("c", lambda x: x != ""))
    cut = F.transform(F.sequence(F.lit(1), F.size("c") - (q_max - 1)),
                      lambda i: F.array_join(F.slice("c", i, q_max), ""))
    return chars.select("id", F.posexplode(cut).alias("place", "gram"))


def dictionary(spark: SparkSession, grams: DataFrame, prune: int = PRUNE, q_min: int = Q_MIN,
               q_max: int = Q_MAX) -> DataFrame:
    """(gram, chosen, freq): the pruned trie, by the longest grams below its ends."""
    level = stored(spark, grams.groupBy("gram").agg(F.count(F.lit(1)).alias("freq")), "grams")
    trie = level.select("gram", F.col("gram").alias("chosen"), "freq")
    for q in range(q_max - 1, q_min - 1, -1):
        # a node has one child per letter, so these groups are small
        level = stored(spark, level.groupBy(F.substring("gram", 1, q).alias("gram"))
                       .agg(F.sum("freq").alias("freq")), "grams")
        ends = level.where(F.col("freq") <= prune).select(
            F.col("gram").alias("short"), F.col("freq").alias("short_freq"))
        trie = trie.join(ends, F.substring("gram", 1, q) == F.col("short"), "left").select(
            "gram", F.coalesce("short", "chosen").alias("chosen"),
            F.coalesce("short_freq", "freq").alias("freq"))
    return stored(spark, trie, "trie")


def _length(gram: Column) -> Column:
    """Characters of a gram that are read: no more than one ``$``."""
    inner = F.length(F.rtrim(gram, F.lit("$")))
    return F.least(F.length(gram), inner + 1)


def postings(words: DataFrame, grams: DataFrame, trie: DataFrame, q_max: int = Q_MAX) -> DataFrame:
    """(id, word, n, length, gram, place): the rarest ``affected + 1`` grams of each word."""
    found = grams.join(trie, "gram").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("freq", "chosen", "place",
                                             _length(F.col("chosen")).alias("size")))).alias("g"))
    # cover of character i: the grams at i - k that are longer than k
    found = found.withColumn("by_place", F.transform(
        F.array_sort(F.transform("g", lambda x: F.struct(x["place"], x["size"]))),
        lambda x: x["size"]))
    cover = F.transform(F.sequence(F.lit(0), F.size("by_place")), lambda i: sum(
        (F.when((i >= k) & (F.get("by_place", i - k) > k), 1).otherwise(0)
         for k in range(1, q_max)), F.when(F.get("by_place", i) > 0, 1).otherwise(0)))
    found = found.withColumn("affected", F.array_max(cover))
    rare = F.slice("g", F.lit(1), F.col("affected") + 1)
    return (found.select("id", F.explode(rare).alias("x")).join(words, "id")
            .select("id", "word", "n", F.length("word").alias("length"),
                    F.col("x.chosen").alias("gram"), F.col("x.place").alias("place")))


def near_pairs(posted: DataFrame) -> DataFrame:
    """(a, b) with words and counts: every near pair, once."""
    lists = posted.select("gram", "place", "length", *[
        F.col(c).alias(f"{c}_b") for c in ("id", "word", "n")])
    shift = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(m).alias("m"))
                                for p, m in ((0, 0), (0, 1), (1, 1))]))
    asked = posted.select("*", shift.alias("s")).select(
        "gram", (F.col("place") + F.col("s.p")).alias("place"),
        (F.col("length") + F.col("s.m")).alias("length"), F.col("s.m").alias("longer"),
        *[F.col(c).alias(f"{c}_a") for c in ("id", "word", "n")])
    pairs = asked.join(lists, ["gram", "place", "length"]).where(
        ((F.col("longer") == 1) | (F.col("id_a") < F.col("id_b")))
        & (F.levenshtein("word_a", "word_b", 1) == 1))
    return pairs.select("id_a", "word_a", "n_a", "id_b", "word_b", "n_b").dropDuplicates(
        ["id_a", "id_b"])


def roots(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(id, root) of (id, to) links without cycles, by doubling: each round follows the links
    twice as far, so chains of length k need log2(k) rounds."""
    reach = stored(spark, links.select("id", F.col("to").alias("root")), "roots")
    while True:
        step = reach.select(F.col("id").alias("root"), F.col("root").alias("next"))
        joined = stored(spark, reach.join(step, "root", "left").select(
            "id", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        reach = joined.select("id", "root")
        if joined.where("moved").isEmpty():
            return reach


def variants(spark: SparkSession, words: DataFrame, prune: int = PRUNE, share: int = SHARE,
             q_max: int = Q_MAX) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (id, word, n; stored).

    ``form`` is the commonest near word (ties: the first in code-point order) if it has at
    least ``share`` times the occurrences, ``root`` where the forms lead to in the end.
    """
    grams = _grams(words, q_max)
    trie = dictionary(spark, grams, prune, Q_MIN, q_max)
    posted = stored(spark, postings(words, grams, trie, q_max), "postings")
    pairs = stored(spark, near_pairs(posted), "pairs")
    sides = [pairs.select(F.col(f"id_{x}").alias("id"), F.col(f"n_{y}").alias("m"),
                          F.col(f"word_{y}").alias("other"), F.col(f"id_{y}").alias("other_id"))
             for x, y in (("a", "b"), ("b", "a"))]
    best = sides[0].unionByName(sides[1]).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("m")).alias("less"), "other", "other_id")).alias("best"))
    found = stored(spark, words.join(best, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("best.less") >= share * F.col("n"), F.col("best")).alias("form")), "forms")
    ends = roots(spark, found.where("form is not null").select(
        "id", F.col("form.other_id").alias("to")))
    names = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    return found.join(ends.join(names, "root"), "id", "left").select(
        "word", F.col("form.other").alias("form"),
        F.coalesce("root_word", "word").alias("root"), "n", "n_near",
        (-F.col("form.less")).alias("form_n"))
