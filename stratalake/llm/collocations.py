"""Phrases of words that belong together, counted with HAT-tries.

Each task counts phrases in a trie over word ids: below the first word hangs a hash
container of what may follow, and a container with more than ``BURST`` entries bursts into
one container for each next word. Ids are those of the task. When the trie holds more than
``ENTRIES_IN_TASK`` entries, its largest subtrees are spilled whole, as sorted runs of phrases
with their counts. Runs are merged by the shuffle, in partitions by prefix and, since a first word can
be in a third of all phrases, by the hash of what follows it: equal phrases meet, and no word is hot.

A phrase is no more frequent than its parts. So words and pairs are counted first, and longer
phrases only where each pair in them is frequent. A fixed number of bits (``FILTER_BITS``, two for each
frequent pair) tells tasks which pairs those are; a pair that is let through by chance costs
time and has no part in the result, because counts are compared after they are merged.

Texts are read whole. A null language is ``und``; null and empty texts have no phrases; repeated
rows count as often as they occur; an empty table gives an empty result. Other columns have no part in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import in_slices, read, written

LEAST_TIMES = 30
MOST_WORDS = 4
MOST_PHRASES = 2000
INSIDE_PERCENT = 80
SCALE = 2_000_000
UNKNOWN = "und"
# Lower-cases A-Z and makes the ends of pieces line feeds, tabs spaces.
BYTES = bytes(range(256)).translate(
    bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
)
ID_BITS = 21
IDS_IN_TASK = 1 << 17
BURST = 1 << 13
ENTRIES_IN_TASK = 200_000
BUFFERED_WORDS = 1 << 17
TOKENS_AT_ONCE = 1 << 20
FILTER_BITS = 1 << 27
SEED = 42
RUNS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


END, NO_WORD = 0, 1


class Ids(dict):
    """Numbers for words, in the order in which they are met, after those of the end of a piece and of no word."""

    def __init__(self) -> None:
        self.words: list[bytes] = [b"\n", b""]
        self.update({word: n for n, word in enumerate(self.words)})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


class HatTrie:
    """Counts of (first word, next words), the next ones packed into one number.

    A container is a dictionary of packed words; a burst one is a ``list`` holding a
    dictionary of containers by the next word.
    """

    def __init__(self) -> None:
        self.root: dict[int, dict | list] = {}
        self.sizes: dict[int, int] = {}
        self.entries = 0

    def add(self, firsts: np.ndarray, rests: np.ndarray) -> None:
        """Counts phrases; in order, so that those of a first word go to its containers together."""
        if not len(firsts):
            return
        order = np.lexsort((rests, firsts))
        firsts, rests = firsts[order], rests[order]
        new_first = np.ones(len(firsts), dtype=bool)
        new_first[1:] = firsts[1:] != firsts[:-1]
        new = new_first.copy()
        new[1:] |= rests[1:] != rests[:-1]
        begins = np.flatnonzero(new)
        counts = np.diff(np.append(begins, len(firsts))).tolist()
        groups = np.flatnonzero(new_first[begins])
        names, rest_list = firsts[begins][groups].tolist(), rests[begins].tolist()
        bounds = [*groups.tolist(), len(begins)]
        root, sizes = self.root, self.sizes
        for first, begin, end in zip(names, bounds, bounds[1:]):
            entries = zip(rest_list[begin:end], counts[begin:end])
            container = root.get(first)
            before = sizes.get(first, 0)
            if container is None:
                root[first] = container = dict(entries)
                sizes[first] = len(container)
            elif type(container) is dict:
                for rest, n in entries:
                    container[rest] = container.get(rest, 0) + n
                sizes[first] = len(container)
            else:
                below = container[0]
                for rest, n in entries:
                    inner = below.setdefault(rest >> (2 * ID_BITS), {})
                    sizes[first] += rest not in inner
                    inner[rest] = inner.get(rest, 0) + n
            if type(container) is dict and len(container) > BURST:
                root[first] = self._burst(container)
            self.entries += sizes[first] - before

    @staticmethod
    def _burst(container: dict[int, int]) -> list:
        below: dict[int, dict[int, int]] = {}
        for rest, n in container.items():
            below.setdefault(rest >> (2 * ID_BITS), {})[rest] = n
        return [below]

    def take(self, leave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Removes the largest subtrees until ``leave`` entries are left: sorted firsts, rests and counts."""
        taken = []
        for first in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if self.entries <= leave:
                break
            taken.append(first)
            self.entries -= self.sizes.pop(first)
        subtrees = [self.root.pop(first) for first in taken]
        parts = [list(t[0].values()) if type(t) is list else [t] for t in subtrees]
        sizes = [sum(map(len, p)) for p in parts]
        total = sum(sizes)
        firsts = np.repeat(np.array(taken, dtype=np.int64), sizes)
        rests = np.fromiter(chain.from_iterable(chain.from_iterable(parts)), np.int64, total)
        counts = np.fromiter(chain.from_iterable(c.values() for c in chain.from_iterable(parts)), np.int64, total)
        order = np.lexsort((rests, firsts))
        return firsts[order], rests[order], counts[order]


def pair_hash(first: np.ndarray, second: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """A hash of two words from theirs; ``pair_bits`` is the same for columns."""
    return ((first << np.uint64(7)) | (first >> np.uint64(57))) ^ second ^ lang


def pair_bits(phrase: Column, lang: Column) -> Column:
    words = F.split(phrase, " ")
    first, second = F.xxhash64(words[0]), F.xxhash64(words[1])
    turned = F.shiftleft(first, 7).bitwiseOR(F.shiftrightunsigned(first, 57))
    h = turned.bitwiseXOR(second).bitwiseXOR(F.xxhash64(lang))
    low = h.bitwiseAND(F.lit(FILTER_BITS - 1))
    return F.array(low, F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(FILTER_BITS - 1)))


def pair_filter(pairs: DataFrame) -> bytes:
    """The bits of frequent pairs (lang, phrase): ``FILTER_BITS`` of them, whatever the number of pairs."""
    bits = pairs.select(F.explode(pair_bits(F.col("phrase"), F.col("lang"))).alias("bit"))
    # Bit positions of Spark's bitmaps count from bucket 1, which begins with value 1.
    placed = bits.selectExpr("bitmap_bucket_number(bit + 1) - 1 AS bucket", "bitmap_bit_position(bit + 1) AS position")
    filled = placed.groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bits"))
    whole = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in filled.toLocalIterator():
        at = row["bucket"] * len(row["bits"])
        whole[at : at + len(row["bits"])] = np.frombuffer(row["bits"], dtype=np.uint8)
    return whole.tobytes()


class Counter:
    """Counts the phrases of ``fewest`` to ``most`` words in the texts of a task."""

    def __init__(self, fewest: int, most: int, pairs: np.ndarray | None) -> None:
        self.fewest, self.most, self.pairs = fewest, most, pairs
        self.trie = HatTrie()
        self.langs: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.ids = Ids()
        self.hashes = np.zeros(0, dtype=np.uint64)
        self._clear()

    def _clear(self) -> None:
        self.texts: list[tuple[int, np.ndarray, int]] = []  # language, words, how many may begin a phrase
        self.buffered = 0

    def text(self, lang: str, text: str) -> Iterator[pa.RecordBatch]:
        number = self.langs.setdefault(lang, len(self.langs))
        tokens = text.encode().translate(BYTES).replace(b"\n", b" \n ").split(b" ")
        for at in range(0, len(tokens), TOKENS_AT_ONCE):
            end = min(at + TOKENS_AT_ONCE, len(tokens))
            # A long text is read in parts that overlap by the words of a phrase less one.
            after, more = end, 0
            while more < MOST_WORDS - 1 and after < len(tokens) and tokens[after] != b"\n":
                more += tokens[after] != b""
                after += 1
            words = np.fromiter(map(self.ids.__getitem__, tokens[at:after]), np.int64, after - at)
            begins = int(np.count_nonzero(words[: end - at] != NO_WORD))
            words = words[words != NO_WORD]
            self.words[lang] = self.words.get(lang, 0) + int(np.count_nonzero(words[:begins] != END))
            self.texts.append((number, words, begins))
            self.buffered += len(words)
            full = len(self.ids) > IDS_IN_TASK
            if full or self.buffered > BUFFERED_WORDS:
                yield from self.flush(full)

    def flush(self, all_of_it: bool) -> Iterator[pa.RecordBatch]:
        """Puts the buffered words into the trie, and spills if it is full, or all of it."""
        for at in range(0, len(self.texts), 4096):
            self._add(self.texts[at : at + 4096])
        self._clear()
        if self.trie.entries > ENTRIES_IN_TASK or (all_of_it and self.trie.entries):
            yield from self._runs(0 if all_of_it else ENTRIES_IN_TASK // 2)
        if all_of_it:
            self._forget()

    def totals(self) -> pa.RecordBatch:
        """The number of words of each language, as the count of the phrase without words."""
        names, numbers = list(self.words), list(self.words.values())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([""] * len(names)), pa.array(numbers)], schema=RUNS)

    def _add(self, texts: list[tuple[int, np.ndarray, int]]) -> None:
        apart = np.full(MOST_WORDS - 1, END)
        words = np.concatenate([part for _, text, _ in texts for part in (text, apart)])
        lengths = [len(text) + len(apart) for _, text, _ in texts]
        lang = np.repeat([number for number, _, _ in texts], lengths)
        place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        n = len(words) - len(apart)
        begins = (words[:n] != END) & (place < np.repeat([b for _, _, b in texts], lengths))[:n]
        follow = [words[1 : n + 1]]
        for i in range(2, MOST_WORDS):
            # What comes after the end of a piece, or is beyond the longest phrase, is not there.
            ended = (follow[-1] == END) | (i >= self.most)
            follow.append(np.where(ended, END, words[i : i + n]))
        if self.pairs is not None:
            frequent = self._frequent(words, lang)
            begins &= frequent[:n] & frequent[1 : n + 1]
            follow[2] = np.where(frequent[2 : n + 2], follow[2], END)
        rest = (follow[0] << (2 * ID_BITS)) | (follow[1] << ID_BITS) | follow[2]
        first = (lang[:n] << ID_BITS) | words[:n]
        self.trie.add(first[begins], rest[begins])

    def _frequent(self, words: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Whether each word begins a pair that passes the filter."""
        new = [xxhash.xxh64_intdigest(w, SEED) for w in self.ids.words[len(self.hashes) :]]
        self.hashes = np.concatenate([self.hashes, np.array(new, dtype=np.uint64)])
        of_langs = np.array([xxhash.xxh64_intdigest(name, SEED) for name in self.langs], dtype=np.uint64)
        second = np.append(words[1:], END)
        h = pair_hash(self.hashes[words], self.hashes[second], of_langs[lang])
        passed = (words != END) & (second != END)
        for bit in (h & np.uint64(FILTER_BITS - 1), (h >> np.uint64(32)) & np.uint64(FILTER_BITS - 1)):
            passed &= (self.pairs[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return passed

    def _runs(self, leave: int) -> Iterator[pa.RecordBatch]:
        """Sorted runs of the subtrees that are spilled."""
        firsts, rests, counts = self.trie.take(leave)
        names, words = pa.array(list(self.langs), pa.string()), pa.array(self.ids.words, pa.binary())
        mask = (1 << ID_BITS) - 1
        columns = [firsts & mask, rests >> (2 * ID_BITS), (rests >> ID_BITS) & mask, rests & mask]
        langs = firsts >> ID_BITS
        changed = np.ones(len(firsts), dtype=bool)
        changed[1:] = firsts[1:] != firsts[:-1]
        for k in range(1, self.most + 1):
            if k > 1:
                changed[1:] |= columns[k - 1][1:] != columns[k - 1][:-1]
            if k < self.fewest:
                continue
            begins = np.flatnonzero(changed)
            sums = np.add.reduceat(counts, begins)
            whole = columns[k - 1][begins] != END
            begins, sums = begins[whole], sums[whole]
            for at in range(0, len(begins), 50_000):
                some = begins[at : at + 50_000]
                parts = [words.take(pa.array(column[some])) for column in columns[:k]]
                phrases = parts[0] if k == 1 else pc.binary_join_element_wise(*parts, b" ")
                lang = names.take(pa.array(langs[some]))
                yield pa.RecordBatch.from_arrays([lang, phrases.cast(pa.string()), pa.array(sums[at : at + 50_000])], schema=RUNS)


def phrase_counts(docs: DataFrame, fewest: int, most: int, least_times: int, pairs: bytes | None = None) -> DataFrame:
    """Counts ``n`` of the phrases of ``fewest`` to ``most`` words with at least ``least_times`` occurrences.

    With words, the empty phrase counts the words of a language. ``pairs`` is a filter of frequent pairs, without which all phrases are counted.
    """
    shared = None if pairs is None else docs.sparkSession.sparkContext.broadcast(pairs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else np.frombuffer(shared.value, dtype=np.uint8)
        counter = Counter(fewest, most, bits)
        for batch in in_slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if text:
                    yield from counter.text(UNKNOWN if lang is None else lang, text)
        yield from counter.flush(True)
        if fewest == 1 and counter.words:
            yield counter.totals()

    runs = docs.select("lang", "text").mapInArrow(count, "lang string, phrase string, n long")
    # Tasks have added up what they could: runs go into the shuffle as they are.
    counts = runs.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return counts.filter((F.col("n") >= least_times) | (F.col("phrase") == ""))


def _exact(column: Column) -> Column:
    """Products of counts pass 64 bits."""
    return column.cast("decimal(38,0)")


def scored(counts: DataFrame) -> DataFrame:
    """Phrases of two words and more with the cut that scores lowest: lang, phrase, a, l, r, score."""
    words = F.split("phrase", " ")
    cuts = (
        counts.select("lang", "phrase", F.col("n").alias("a"), words.alias("_words"))
        .filter(F.size("_words") > 1)
        .withColumn("_cut", F.explode(F.expr("sequence(1, size(_words) - 1)")))
        .select(
            "lang",
            "phrase",
            "a",
            "_cut",
            F.expr("array_join(slice(_words, 1, _cut), ' ')").alias("_first"),
            F.expr("array_join(slice(_words, _cut + 1, size(_words) - _cut), ' ')").alias("_rest"),
        )
    )
    left = counts.select(F.col("lang").alias("_ll"), F.col("phrase").alias("_lp"), F.col("n").alias("l"))
    right = counts.select(F.col("lang").alias("_rl"), F.col("phrase").alias("_rp"), F.col("n").alias("r"))
    joined = cuts.join(left, (F.col("lang") == F.col("_ll")) & (F.col("_first") == F.col("_lp")))
    joined = joined.join(right, (F.col("lang") == F.col("_rl")) & (F.col("_rest") == F.col("_rp")))
    score = F.expr(f"({SCALE}BD * cast(a AS decimal(20,0))) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))")
    lowest = F.min(F.struct(score.cast("long").alias("score"), F.col("_cut"), F.col("l"), F.col("r")))
    found = joined.groupBy("lang", "phrase", "a").agg(lowest.alias("_s"))
    return found.select("lang", "phrase", "a", "_s.l", "_s.r", "_s.score")


def outermost(phrases: DataFrame, percent: int = INSIDE_PERCENT) -> DataFrame:
    """Phrases (lang, phrase, a, ...) but those inside a longer one that has ``percent`` of their occurrences."""
    parts = (
        phrases.select("lang", F.col("a").alias("_a"), F.split("phrase", " ").alias("_words"))
        .withColumn("_n", F.explode(F.expr("filter(sequence(1, size(_words)), n -> n > 1 AND n < size(_words))")))
        .withColumn("_at", F.explode(F.expr("sequence(1, size(_words) - _n + 1)")))
        .select(F.col("lang").alias("_lang"), F.expr("array_join(slice(_words, _at, _n), ' ')").alias("_part"), "_a")
        .groupBy("_lang", "_part")
        .agg(F.max("_a").alias("_a"))
    )
    inside = (
        (F.col("lang") == F.col("_lang"))
        & (F.col("phrase") == F.col("_part"))
        & (_exact(F.col("_a")) * 100 >= _exact(F.col("a")) * percent)
    )
    return phrases.join(parts, inside, "left_anti")


def first_of_each(phrases: DataFrame, most: int) -> DataFrame:
    """The ``most`` best of each language with their ``rank``; slices of a language are ranked before the whole."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = phrases.withColumn("_slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    inner = F.row_number().over(Window.partitionBy("lang", "_slice").orderBy(*order))
    best = sliced.withColumn("_nth", inner).filter(F.col("_nth") <= most).drop("_nth", "_slice")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return best.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= most)


def collocations(
    docs: DataFrame, least_times: int = LEAST_TIMES, most: int = MOST_PHRASES, percent: int = INSIDE_PERCENT
) -> DataFrame:
    """The best phrases of documents (lang, text) by language."""
    if least_times < 1:
        raise ValueError("least_times must be at least 1")
    short = written(phrase_counts(docs, 1, 2, least_times), "words-and-pairs")
    sizes = short.filter("phrase = ''").select("lang", "n")
    frequent = short.filter("phrase <> ''")
    is_word = F.instr("phrase", " ") == 0
    long = written(phrase_counts(docs, 3, MOST_WORDS, least_times, pair_filter(frequent.filter(~is_word))), "phrases")
    phrases = written(scored(written(frequent.unionByName(long), "counts")), "scored")
    best = first_of_each(outermost(phrases, percent), most)
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of all documents."""
    return collocations(read(spark, sf_dir, "documents"))


OP11_SQL = """
WITH pieces AS (
    SELECT row_number() OVER () AS piece, lang, words
    FROM (
        SELECT coalesce(lang, 'und') AS lang,
            list_filter(regexp_split_to_array(
                unnest(regexp_split_to_array(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')),
                '[\\x20\\x09]+'), lambda w: w <> '') AS words
        FROM documents
    )
    WHERE len(words) > 0
),
counts AS (
    SELECT lang, k, phrase, count(*) AS n
    FROM (
        SELECT lang, k, array_to_string(words[pos : pos + k - 1], ' ') AS phrase
        FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS pos
              FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(words) >= k)
    )
    GROUP BY ALL
),
frequent AS (SELECT * FROM counts WHERE n >= 30),
sizes AS (SELECT lang, sum(n)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
cuts AS (
    SELECT lang, phrase, k, n AS a, string_split(phrase, ' ') AS words, unnest(range(1, k)) AS cut
    FROM frequent WHERE k > 1
),
scores AS (
    SELECT c.lang, c.phrase, c.k, c.a, c.cut, l.n AS l, r.n AS r,
        (2000000::HUGEINT * c.a // (l.n::HUGEINT + r.n))::BIGINT AS score
    FROM cuts c
    JOIN frequent l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1 : c.cut], ' ')
    JOIN frequent r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[c.cut + 1 :], ' ')
),
phrases AS (
    SELECT lang, phrase, k, a, l, r, score FROM scores
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
),
parts AS (
    SELECT lang, array_to_string(words[pos : pos + m - 1], ' ') AS phrase, max(n) AS n
    FROM (
        SELECT lang, n, words, m, unnest(range(1, k - m + 2)) AS pos
        FROM (SELECT lang, n, k, string_split(phrase, ' ') AS words, unnest(range(2, k)) AS m FROM frequent WHERE k > 2)
    )
    GROUP BY ALL
),
ranked AS (
    SELECT p.*, row_number() OVER (PARTITION BY p.lang ORDER BY p.score DESC, p.a DESC, p.phrase) AS rank
    FROM phrases p
    LEFT JOIN parts ON parts.lang = p.lang AND parts.phrase = p.phrase
    WHERE parts.n IS NULL OR 100 * parts.n < 80 * p.a
)
SELECT lang, rank, phrase, a, l, r, sizes.n, score
FROM ranked JOIN sizes USING (lang)
WHERE rank <= 2000
"""
