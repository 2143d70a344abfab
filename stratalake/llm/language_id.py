"""Language identification with bit-sliced Bloom filters of character n-grams.

Texts are lower-cased, and whatever is not a letter becomes one space; an n-gram is
three characters of that. A language contains an n-gram if it uses it at least
``LEAST_SHARE`` times as often as the language that uses it most, and for
``LEAST_RATE`` of its n-grams; so a language contains at most one by that rate, and
the misspellings of a large corpus do not fill the table. All languages share one
table: each slot has a bit per language, an n-gram sets its languages'
bits in ``HASHES`` slots, and the bits that all its slots have are the languages
that contain it. A text's n-grams are counted per language, less those that are
expected by chance from how full the language's bits are, and the highest count
decides. The score is that count as a share of all n-grams.

N-grams are counted over all labelled texts, in the tasks first and then by n-gram;
what reaches the driver is the table, whose size is fixed. Null texts and texts
without a letter are ``und``; so is everything if nothing is labelled. Ties go to the
first language in alphabetical order. Each row is judged alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.llm.common import in_slices, read

UNKNOWN = "und"
SLOT_BITS = 20
HASHES = 2
LEAST_SHARE = 0.5
LEAST_RATE = 1e-6
# Odd multipliers of the slots' hash functions.
MULTIPLIERS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]
LANGUAGES_PER_WORD = 63
CHARACTERS_AT_ONCE = 1 << 18
GRAMS_HELD = 1 << 21


def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def normalised(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts with single spaces, the text of each, and which texts have a letter."""
    padded = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in padded])
    is_letter = letters[codes]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1] | (owner[1:] != owner[:-1])
    keep[:1] = True
    has_letter = np.bincount(owner[is_letter], minlength=len(texts)) > 0
    return np.where(is_letter, codes, 32)[keep].astype(np.uint64), owner[keep], has_letter


def grams(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """N-grams with their texts, a bounded number at a time."""
    for at in range(0, len(codes), CHARACTERS_AT_ONCE):
        c, o = codes[at : at + CHARACTERS_AT_ONCE + 2], owner[at : at + CHARACTERS_AT_ONCE + 2]
        whole = o[2:] == o[:-2] if len(o) > 2 else np.zeros(0, dtype=bool)
        found = c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:] if len(c) > 2 else c[:0]
        yield found[whole], o[:-2][whole] if len(o) > 2 else o[:0]


def text_groups(texts: list[str]) -> Iterator[slice]:
    """Consecutive texts of about as many characters as are handled at once."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHARACTERS_AT_ONCE:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text) + 2
    if begin < len(texts):
        yield slice(begin, len(texts))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = letter_table()
    held: dict[str, list] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            keys, n = _summed(parts)
            names = pa.array(np.full(len(keys), lang, dtype=object), pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(keys.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])
        held.clear()

    for batch in in_slices(batches):
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            for part in text_groups(texts):
                codes, owner, _ = normalised(texts[part], letters)
                for found, _ in grams(codes, owner):
                    parts = held.setdefault(lang, [])
                    parts.append(np.unique(found, return_counts=True))
                    if sum(len(k) for k, _ in parts) > GRAMS_HELD // 8:
                        held[lang] = [_summed(parts)]
            if sum(len(k) for parts in held.values() for k, _ in parts) > GRAMS_HELD:
                yield from out()
    yield from out()


def slots_of(found: np.ndarray) -> list[np.ndarray]:
    shift = np.uint64(64 - SLOT_BITS)
    mixed = found ^ (found >> np.uint64(31))
    return [((mixed * np.uint64(m)) >> shift).astype(np.int64) for m in MULTIPLIERS[:HASHES]]


@dataclass(frozen=True)
class Filters:
    """Bit-sliced Bloom filters: ``table`` has a row per 63 languages and a column per slot."""

    languages: list[str]
    table: np.ndarray
    false_rate: np.ndarray

    def judge(self, texts: list[str], letters: np.ndarray) -> tuple[list[str], list[float]]:
        codes, owner, has_letter = normalised(texts, letters)
        hits = np.zeros((len(self.languages), len(texts)))
        total = np.zeros(len(texts))
        for found, of_text in grams(codes, owner):
            total += np.bincount(of_text, minlength=len(texts))
            slots = slots_of(found)
            masks = [np.bitwise_and.reduce([row[s] for s in slots]) for row in self.table]
            for n in range(len(self.languages)):
                word, bit = divmod(n, LANGUAGES_PER_WORD)
                has = (masks[word] >> np.uint64(bit) & np.uint64(1)).astype(bool)
                hits[n] += np.bincount(of_text[has], minlength=len(texts))
        names, scores = [], []
        for i in range(len(texts)):
            if not has_letter[i] or not self.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            true = (hits[:, i] - total[i] * self.false_rate) / np.maximum(1 - self.false_rate, 1e-9)
            best = int(np.argmax(true))
            names.append(self.languages[best])
            scores.append(float(min(1.0, max(0.0, true[best] / max(total[i], 1)))))
        return names, scores


def learn(docs: DataFrame) -> Filters:
    """Filters from ``docs`` (text, lang); rows without either are left out."""
    labelled = docs.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = (
        labelled.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    rows_of_table = max(1, -(-len(languages) // LANGUAGES_PER_WORD))
    table = np.zeros((rows_of_table, 1 << SLOT_BITS), dtype=np.uint64)
    if languages:
        by_name = lambda values: F.create_map(*[F.lit(x) for pair in zip(languages, values) for x in pair])
        rate = F.col("n") / by_name([float(totals[x]) for x in languages])[F.col("lang")]
        number = by_name(range(len(languages)))[F.col("lang")]
        most = F.max("rate").over(Window.partitionBy("gram"))
        frequent = counts.select("gram", rate.alias("rate"), number.alias("number")).filter(F.col("rate") >= LEAST_RATE)
        contained = frequent.withColumn("most", most)
        contained = contained.filter(F.col("rate") >= LEAST_SHARE * F.col("most")).select(
            "gram",
            F.expr(f"number div {LANGUAGES_PER_WORD}").alias("word"),
            F.expr(f"shiftleft(1L, cast(number % {LANGUAGES_PER_WORD} as int))").alias("mask"),
        )

        def in_slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for slots in slots_of(batch["gram"].to_numpy().astype(np.uint64)):
                    yield pd.DataFrame({"slot": slots, "word": batch["word"], "mask": batch["mask"]})

        bits = contained.mapInPandas(in_slots, "slot long, word long, mask long")
        # A row per slot and 63 languages at most.
        found = bits.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toPandas()
        table[found["word"].to_numpy(), found["slot"].to_numpy()] = found["mask"].to_numpy().astype(np.uint64)
    full = [
        np.mean(table[n // LANGUAGES_PER_WORD] >> np.uint64(n % LANGUAGES_PER_WORD) & np.uint64(1)) for n in range(len(languages))
    ]
    return Filters(languages, table, np.array(full) ** HASHES)


def identify(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, which replace columns of these names."""
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    kept = docs.select(*[F.col(f"`{c}`") for c in others])
    sent = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.table, filters.false_rate))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, known = letter_table(), Filters(*sent.value)
        for batch in in_slices(batches):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            names: list[str] = []
            scores: list[float] = []
            for part in text_groups(texts):
                found = known.judge(texts[part], letters)
                names += found[0]
                scores += found[1]
            made = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(made, [*batch.schema.names, "lang_pred", "score"])

    schema = StructType([*kept.schema.fields, *StructType.fromDDL("lang_pred string, score double").fields])
    return kept.mapInArrow(judge, schema)


def held_out() -> Column:
    """Documents that are never learned from; those without an id are judged, not learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from three quarters of them."""
    docs = read(spark, sf_dir, "documents")
    filters = learn(docs.filter(~held_out()))
    rows = docs.select("doc_id", "text", F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    return identify(rows, filters).drop("text")
