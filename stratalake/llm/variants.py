"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

Two words within one edit differ in one place only. Cut the shorter of the two in
halves: either the first halves are equal, or all that follows the first half of the
shorter one is. So words meet in groups that share a beginning or an end, and only
what lies between is compared: each word of a group goes down the sorted list of
the others with a three-cell band of the edit matrix, keeps the rows of the letters
that neighbours of the list have in common, and skips the range of words whose shared
letters already take two edits.

A group with more than ``LARGEST_GROUP`` words is halved again in the same way,
as often as needed: the part between gets shorter each time, and with one letter left a
group has no more words than there are letters. A pair that would meet in both
halves counts in the first.

Words are counted in tasks first, so a frequent word is a row per task. Null and empty
texts have no words; a null id reads as an empty text in the hash of a run; rows that
are repeated count as often as they occur. An empty table has no words. Other columns
have no part in it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import in_slices, read, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
DELETED_BY = 199
FEWEST_LETTERS = 6
FEWEST_TIMES = 5
RATIO = 5
LARGEST_GROUP = 500
WORDS_IN_TASK = 300_000
COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
FAR = 2


def runs_of(doc_id: int | None, text: str | None) -> Counter:
    """The words of a text with their counts; one in ``DELETED_BY`` runs, by its hash, loses a letter."""
    found: Counter = Counter()
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lowered = (text or "").encode().lower().decode()  # bytes: ASCII only
    for run, n in Counter(RUN.findall(lowered)).items():
        if len(run) >= FEWEST_LETTERS:
            h = zlib.crc32(run.encode(), seed)
            if h % DELETED_BY == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= FEWEST_LETTERS:
                found[run] += n
    return found


def vocabulary(docs: DataFrame, fewest_times: int = FEWEST_TIMES) -> DataFrame:
    """Words with their number of occurrences ``n``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in in_slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                held.update(runs_of(doc_id, text))
                if len(held) > WORDS_IN_TASK:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()))], schema=COUNTS)
                    held.clear()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()))], schema=COUNTS)

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest_times)


def halved(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, pre, suf, below) in two groups each: more of the beginning is shared, or more of the end.

    ``m`` is the length of the shorter word of a pair, ``pre`` and ``suf`` how many
    letters are shared at the ends. A pair counts where it has fewer than ``below`` first letters
    in common.
    """
    half = F.expr("(m - pre - suf) div 2").cast("int")
    first = F.struct((F.col("pre") + half).alias("pre"), F.col("suf"), F.col("below"))
    last = F.struct(F.col("pre"), (F.col("m") - F.col("pre") - half).alias("suf"), (F.col("pre") + half).alias("below"))
    parts = rows.select("word", "n", "m", F.explode(F.array(first, last)).alias("_p")).select("word", "n", "m", "_p.*")
    ends = F.array(F.expr("left(word, pre)"), F.expr("right(word, suf)"))
    # Words that meet by an equal hash alone are compared as well: their ends are part of the comparison.
    return parts.withColumn("key", F.xxhash64("m", "pre", "suf", "below", ends))


def groups(words: DataFrame, largest: int = LARGEST_GROUP) -> DataFrame:
    """The words dealt into groups (key) of at most ``largest`` rows, unless their middle is one letter long."""
    lengths = F.array(F.length("word"), F.length("word") - 1)
    ends = [F.lit(0).alias("pre"), F.lit(0).alias("suf"), F.lit(1 << 30).alias("below")]
    paired = words.select("word", "n", F.explode(lengths).alias("m"), *ends)
    rows = halved(paired.filter(F.col("m") >= FEWEST_LETTERS))
    done = None
    while True:
        rows = written(rows, "groups")
        large = F.col("m") - F.col("pre") - F.col("suf") > 1
        sizes = rows.filter(large).groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
        hot = written(sizes.filter(F.col("_n") > largest).select(F.col("key").alias("_key")), "hot-groups")
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        listed = large & (F.col("key") == F.col("_key"))
        cold = rows.join(hot, listed, "left_anti")
        done = cold if done is None else done.unionByName(cold)
        rows = halved(rows.join(hot, listed, "left_semi").drop("key"))


def shared_letters(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def within_one_edit(query: str, words: list[str], shared: list[int]) -> Iterator[int]:
    """Places in a sorted list of words one edit from ``query`` that are as long or one letter longer.

    ``shared`` holds how many first letters each word has in common with the one before it.
    A row of the edit matrix belongs to a number of letters of the word; its cells are those
    of as many letters of the query, one less and one more.
    """
    m = len(query)
    padded = query + "\0\0\0"
    rows = [(FAR, 0, 1)]
    i, valid = 0, 0
    while i < len(words):
        word = words[i]
        valid = min(valid, shared[i])
        del rows[valid + 1 :]
        less, same, more = rows[valid]
        depth = valid
        for letter in word[valid : m + 1]:
            depth += 1
            new_less = min(same + 1, less + (padded[depth - 2] != letter))
            new_same = min(more + 1, new_less + 1, same + (padded[depth - 1] != letter))
            less, same, more = new_less, new_same, min(new_same + 1, more + (padded[depth] != letter))
            rows.append((less, same, more))
            if less >= FAR and same >= FAR and more >= FAR:
                break
        else:
            if (len(word) == m and same == 1) or (len(word) == m + 1 and less == 1):
                yield i
        valid = depth
        i += 1
        if depth and less >= FAR and same >= FAR and more >= FAR:
            while i < len(words) and shared[i] >= depth:
                i += 1


def near_in_group(rows: list[tuple[str, int, int, int, int, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, number of near words, largest n among them, that word) for rows (word, n, m, pre, suf, below) of one key."""
    by_ends: dict[tuple, list] = {}
    for row in rows:
        word, _, m, pre, suf, below = row
        by_ends.setdefault((m, below, word[:pre], word[len(word) - suf :]), []).append(row)
    for (m, below, first, last), members in by_ends.items():
        if len(members) < 2:
            continue
        middle = m - len(first) - len(last)
        members = sorted((word[len(first) : len(word) - len(last)], word, n) for word, n, *_ in members)
        middles = [row[0] for row in members]
        shared = [0, *map(shared_letters, middles, middles[1:])]
        best: dict[int, list] = {}
        for q, (query, word, n) in enumerate(members):
            if len(query) != middle:
                continue
            for i in within_one_edit(query, middles, shared):
                other, other_n = members[i][1:]
                # Words of one length see each other twice.
                if (len(other) == len(word) and i < q) or other[:below] == word[:below]:
                    continue
                for at, near_n, near in ((q, other_n, other), (i, n, word)):
                    entry = best.setdefault(at, [0, 0, ""])
                    entry[0] += 1
                    if near_n > entry[1] or (near_n == entry[1] and near < entry[2]):
                        entry[1:] = near_n, near
        for at, (count, near_n, near) in best.items():
            yield members[at][1], count, near_n, near


def _near_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs over rows in the order of their key."""
    key, held = None, []
    names = ["word", "n_near", "near_n", "near"]
    for batch in batches:
        out = []
        columns = [batch[c].tolist() for c in ("key", "word", "n", "m", "pre", "suf", "below")]
        for row_key, *row in zip(*columns):
            if row_key != key:
                if len(held) > 1:
                    out += near_in_group(held)
                key, held = row_key, []
            held.append(tuple(row))
        if out:
            yield pd.DataFrame(out, columns=names)
    if len(held) > 1 and (out := list(near_in_group(held))):
        yield pd.DataFrame(out, columns=names)


def near_words(words: DataFrame, largest: int = LARGEST_GROUP) -> DataFrame:
    """For words (word, n) that have near ones: ``n_near``, and the most frequent of them as ``near`` and ``near_n``."""
    in_runs = groups(words, largest).repartition("key").sortWithinPartitions("key")
    found = in_runs.mapInPandas(_near_rows, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    best_rows = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b"))
    return best_rows.select("word", "n_near", (-F.col("_b.less")).alias("near_n"), F.col("_b.near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """The last word of each chain of (word, form): every round doubles the steps taken.

    A form is more frequent than its word, so chains end.
    """
    current = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = current.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        moved = current.join(onward, F.col("root") == F.col("_w"), "left")
        current = written(moved.select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_moved")), "roots")
        if not current.filter("_moved").head(1):
            return current.drop("_moved")


def variants(docs: DataFrame, ratio: int = RATIO, fewest_times: int = FEWEST_TIMES) -> DataFrame:
    """The words of documents (doc_id, text) with their near words, form and root."""
    words = written(vocabulary(docs, fewest_times), "vocabulary")
    near = words.join(near_words(words), "word", "left")
    takes = F.col("near_n") >= ratio * F.col("n")
    formed = written(
        near.select(
            "word",
            F.when(takes, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(takes, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    rooted = formed.join(roots(formed.filter("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the form that they are variants of."""
    return variants(read(spark, sf_dir, "documents"))


OP13_SQL = """
WITH RECURSIVE table_entries AS (
    -- The remainders of all bytes by the reversed polynomial of CRC-32.
    SELECT list(list_reduce(range(8), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS entries
    FROM range(256) t(i)
),
runs AS (
    SELECT doc_id, run, count(*) AS n
    FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents
    )
    WHERE length(run) >= 6
    GROUP BY ALL
),
hashed AS (
    SELECT run, n, xor(list_reduce(
        list_transform(range(length(digits) // 2), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c // 256, entries[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS h
    FROM (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS digits FROM runs), table_entries
),
words AS (
    SELECT word, sum(n)::BIGINT AS n
    FROM (
        SELECT n, CASE WHEN h % 199 = 0
            THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
            ELSE run END AS word
        FROM hashed
    )
    WHERE length(word) >= 6
    GROUP BY word
    HAVING sum(n) >= 5
),
holes AS (
    SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
),
near AS (
    SELECT DISTINCT a.word, b.word AS near FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.rest
    UNION SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.rest
),
best AS (
    SELECT near.word, near.near, w.n, count(*) OVER (PARTITION BY near.word) AS n_near
    FROM near JOIN words w ON w.word = near.near
    QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, near.near) = 1
),
formed AS (
    SELECT words.word, words.n, coalesce(best.n_near, 0) AS n_near,
        CASE WHEN best.n >= 5 * words.n THEN best.near END AS form,
        CASE WHEN best.n >= 5 * words.n THEN best.n END AS form_n
    FROM words LEFT JOIN best USING (word)
),
chains AS (
    SELECT word, word AS root, form AS onward FROM formed
    UNION ALL
    SELECT chains.word, chains.onward, formed.form FROM chains JOIN formed ON formed.word = chains.onward
)
SELECT formed.word, formed.form, chains.root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN chains ON chains.word = formed.word AND chains.onward IS NULL
"""
