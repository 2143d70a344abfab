"""Benchmark decontamination with spaced seeds.

A benchmark item leaks into a text where, with the item laid along the text at some
place, at least ``LEAST_EQUAL`` of ``WINDOW`` consecutive words are equal. The masks
say which words of a run are hashed and which are ignored; any window with so few
substitutions has a run whose hashed words are all untouched, for one mask at least
(``tests/llm`` tries all cases), so nothing is missed. Shorter items leak where they
stand as a whole, with one substitution from 7 words on; three masks as long as the item,
each without every third word, find it. Items under ``FEWEST_WORDS`` words stand in any
text, so they leak only where they are all of a text.

Scripts without spaces have words as long as sentences. Items of few words, or mostly in
such a script, are looked up by characters as well: letters and digits alone, 42 of 48
consecutive ones or, in shorter items, all but one in eight. Their rows count characters.

Hashes of all runs of the texts meet those of the benchmark in a join; of the hits
along one line only the first of each run is kept. Around a hit the words are
compared one by one. The benchmark's hashes are counted first and broadcast if they
are at most ``SEEDS_AT_ONCE``; a larger benchmark is taken in blocks of whole items,
each at most about that large, and the results are put together.

Texts and items that are null or empty have no words. Repeated rows give the same
leaks, once each. Words are runs of letters and digits, A-Z in lower case.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import lower_ascii, read, words_of

# Together they find every window of 13 words with two substitutions.
MASKS = ("11010111", "111001011")
WINDOW = 13
LEAST_EQUAL = 11
FEWEST_WORDS = 5
SEEDS_AT_ONCE = 500_000
# One of these of an item's words or characters may be another, in items below the window.
ONE_IN_WORDS, ONE_IN_CHARACTERS = 7, 8
# With one in eight substituted, each run of 13 to 48 characters has 13 with two at most.
CHARACTERS, LEAST_EQUAL_CHARACTERS = 48, 42
_SCRIPTS = ("Han", "Hiragana", "Katakana", "Bopomofo", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan")
UNSPACED = "[" + "".join(rf"\p{{Is{script}}}" for script in _SCRIPTS) + "]"


@dataclass(frozen=True)
class Rule:
    """A leak has ``least_equal`` of ``window`` units; items below the window have all but one in ``one_in`` (0: all)."""

    window: int = WINDOW
    least_equal: int = LEAST_EQUAL
    one_in: int = 0

    def substitutions(self, n: int) -> int:
        return n // self.one_in if self.one_in else 0

    def needed(self, n: Column) -> Column:
        short = n - F.floor(n / self.one_in) if self.one_in else n
        return F.when(n < self.window, short).otherwise(self.least_equal)


WHOLE_SHORT = Rule()
BY_WORDS = Rule(one_in=ONE_IN_WORDS)
BY_CHARACTERS = Rule(CHARACTERS, LEAST_EQUAL_CHARACTERS, ONE_IN_CHARACTERS)


def word_hashes(text: Column) -> Column:
    return F.transform(words_of(text), lambda word: F.xxhash64(word))


def characters_of(text: Column) -> Column:
    """Letters, their marks and digits."""
    return F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", "")


def character_hashes(text: Column) -> Column:
    return F.transform(F.filter(F.split(characters_of(text), ""), lambda c: c != ""), lambda c: F.xxhash64(c))


def _by_characters(text: Column) -> Column:
    """Whether an item is looked up by characters: it has unspaced ones, and few words or little else."""
    unspaced = F.length(F.regexp_replace(text, UNSPACED.replace("[", "[^", 1), ""))
    few = F.size(words_of(text)) < FEWEST_WORDS
    return (unspaced > 0) & (few | (unspaced * 2 > F.length(characters_of(text))))


def seed(hashes: Column, at: Column, mask: str, kind: int) -> Column:
    """The hash of the words that the mask keeps, from a place (from 0); null where the run does not fit."""
    kept = [F.get(hashes, at + i) for i, c in enumerate(mask) if c == "1"]
    fits = (at >= 0) & (at + len(mask) <= F.size(hashes))
    return F.when(fits, F.xxhash64(F.lit(kind), *kept))


def _masks(lengths: list[int], rule: Rule = WHOLE_SHORT) -> list[str]:
    """The spaced masks, and for each shorter length that there is one that covers it, or three for a substitution."""
    without = lambda n, r: "".join("0" if i % 3 == r else "1" for i in range(n))
    short = [n for n in lengths if FEWEST_WORDS <= n < WINDOW]
    return [*MASKS, *[m for n in short for m in ([without(n, r) for r in range(3)] if rule.substitutions(n) else ["1" * n])]]


def _seed_rows(rows: DataFrame, hashes: str, masks: list[str], place: str) -> DataFrame:
    """``rows`` once for every place and mask, with the seed there."""
    # Places where no run fits, those of empty arrays too, have no seed. The outer form keeps
    # Spark from working out the array once more for a filter.
    at = F.explode_outer(F.sequence(F.lit(0), F.size(hashes))).alias(place)
    placed = rows.select(*rows.columns, at)
    seeds = F.array(*[seed(F.col(hashes), F.col(place), mask, kind) for kind, mask in enumerate(masks)])
    return placed.select(*placed.columns, F.posexplode(seeds).alias("_mask", "_seed")).filter("_seed IS NOT NULL")


def _best_window(equal: Column, window: Column) -> Column:
    """The most equal words in any window of the 0/1 array, or -1 if it is shorter than a window."""
    sums = F.transform(
        F.sequence(F.lit(1), F.size(equal) - window + 1),
        lambda k: F.aggregate(F.slice(equal, k, window), F.lit(0), lambda n, x: n + x),
    )
    return F.when(F.size(equal) >= window, F.array_max(sums)).otherwise(-1)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    seeds_at_once: int = SEEDS_AT_ONCE,
    rule: Rule = WHOLE_SHORT,
    hashes=word_hashes,
) -> DataFrame:
    """Places where items stand in texts: key, item_id, first_word (of the overlap in the text), n_words, n_equal, similarity.

    ``docs`` has the key and text, ``benchmark`` item_id and text. Items of fewer than
    ``FEWEST_WORDS`` are left to ``all_leaks``, as are other rules and units than words.
    """
    items = benchmark.select("item_id", hashes(F.col("text")).alias("_item"))
    items = items.filter(F.size("_item") >= FEWEST_WORDS).distinct()
    # A row per length below the window.
    short = [r[0] for r in items.filter(F.size("_item") < WINDOW).select(F.size("_item")).distinct().collect()]
    masks = _masks(sorted(short), rule)
    n_seeds = items.agg(F.coalesce(F.sum(F.size("_item")), F.lit(0))).first()[0] * len(MASKS)
    n_blocks = max(1, -(-n_seeds // seeds_at_once))
    texts = docs.select(F.col(key).alias("_key"), hashes(F.col("text")).alias("_text"))
    block = F.pmod(F.xxhash64("item_id", "_item"), F.lit(n_blocks))
    found = [_leaks_of_block(texts, items.filter(block == n), masks, rule) for n in range(n_blocks)]
    return reduce(DataFrame.unionByName, found).distinct().withColumnRenamed("_key", key)


def _whole_texts(docs: DataFrame, benchmark: DataFrame, key: str, hashes) -> DataFrame:
    """Texts that are an item of fewer than ``FEWEST_WORDS`` units and nothing else, as ``find_leaks`` gives them."""
    few = F.size("_units").between(1, FEWEST_WORDS - 1)
    items = benchmark.select("item_id", hashes(F.col("text")).alias("_units")).filter(few).distinct()
    texts = docs.select(F.col(key).alias("_key"), hashes(F.col("text")).alias("_units")).filter(few)
    n = F.size("_units").cast("long")
    return (
        texts.join(items, "_units")
        .select("_key", "item_id", F.lit(0).cast("long").alias("first_word"), n.alias("n_words"), n.alias("n_equal"), F.lit(1.0).alias("similarity"))
        .distinct()
        .withColumnRenamed("_key", key)
    )


def all_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", seeds_at_once: int = SEEDS_AT_ONCE) -> DataFrame:
    """``find_leaks`` for items of every length and script; rows of items looked up by characters count these."""
    unspaced = benchmark.filter(_by_characters(F.col("text")))
    found = [find_leaks(docs, benchmark, key, seeds_at_once, BY_WORDS)]
    few = F.size(words_of(F.col("text"))).between(1, FEWEST_WORDS - 1)
    # The other ways are gone only where there are items for them.
    if not benchmark.filter(few).isEmpty():
        found.append(_whole_texts(docs, benchmark, key, word_hashes))
    if not unspaced.isEmpty():
        there = docs.filter(F.col("text").rlike(UNSPACED))
        found.append(find_leaks(there, unspaced, key, seeds_at_once, BY_CHARACTERS, character_hashes))
        found.append(_whole_texts(there, unspaced, key, character_hashes))
    return reduce(DataFrame.unionByName, found).distinct() if found[1:] else found[0]


def _leaks_of_block(texts: DataFrame, items: DataFrame, masks: list[str], rule: Rule) -> DataFrame:
    of_items = _seed_rows(items, "_item", masks, "_item_at")
    for_length = F.size("_item") < WINDOW
    whole = F.col("_mask") >= len(MASKS)
    # Spaced masks for long items, those of their length for short ones.
    covers = F.get(F.array(*[F.lit(len(m)) for m in masks]), F.col("_mask")) == F.size("_item")
    of_items = of_items.filter((~for_length & ~whole) | (for_length & whole & covers))
    of_items = of_items.select(F.col("_seed").alias("_item_seed"), "item_id", "_item", "_item_at")
    of_texts = _seed_rows(texts, "_text", masks, "_at")
    # At most SEEDS_AT_ONCE rows, or one item: counted before.
    hits = of_texts.join(F.broadcast(of_items), F.col("_seed") == F.col("_item_seed"))

    def before(hashes: str, at: str) -> Column:
        seeds = [seed(F.col(hashes), F.col(at) - 1, m, k) for k, m in enumerate(masks)]
        return F.get(F.array(*seeds), F.col("_mask"))

    # Along one line, the first hit of each run stands for all.
    first = ~F.coalesce(before("_text", "_at") == before("_item", "_item_at"), F.lit(False))
    line = F.col("_at") - F.col("_item_at")
    hits = hits.filter(first).withColumn("_line", line)
    skipped = F.greatest(-F.col("_line"), F.lit(0))  # words of the item before the text begins
    n = F.least(F.size("_item") - skipped, F.size("_text") - F.greatest("_line", F.lit(0)))
    sides = F.struct(
        F.slice("_text", F.greatest("_line", F.lit(0)) + 1, n).alias("a"), F.slice("_item", skipped + 1, n).alias("b")
    )
    # Unfolded in the stage of the join, so that no hit takes the whole text along.
    beside = hits.select(
        "_key",
        "item_id",
        F.size("_item").alias("_n_item"),
        F.greatest("_line", F.lit(0)).alias("first_word"),
        F.explode(F.array(sides)).alias("_sides"),
    )
    equal = F.zip_with("_sides.a", "_sides.b", lambda a, b: F.when(a == b, 1).otherwise(0))
    window = F.least("_n_item", F.lit(rule.window))

    def judge(equal: Column) -> Column:
        n_equal = F.aggregate(equal, F.lit(0), lambda n, x: n + x)
        return F.struct(_best_window(equal, window).alias("best"), n_equal.alias("n_equal"), F.size(equal).alias("n_words"))

    # The comparison is the variable of a list of one, so that windows do not work it out again.
    judged = F.get(F.transform(F.array(equal), judge), F.lit(0))
    needed = rule.needed(F.col("_n_item"))
    leaks = beside.select("_key", "item_id", "_n_item", "first_word", judged.alias("_j")).filter(F.col("_j.best") >= needed)
    return leaks.select(
        "_key",
        "item_id",
        F.col("first_word").cast("long").alias("first_word"),
        F.col("_j.n_words").cast("long").alias("n_words"),
        F.col("_j.n_equal").cast("long").alias("n_equal"),
        (F.col("_j.n_equal") / F.col("_n_item")).alias("similarity"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place where a benchmark item stands in a document."""
    return all_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
