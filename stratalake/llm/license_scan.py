"""Licence scan with a positional index of rare words.

Each licence template is a run of words with key phrases that must be there. Over all
documents, the words of the key phrases are counted; the rarest ones of each template
are its anchors. The index holds, by the hash of the word, each template's rarest anchor
and its position. A file looks up its own places of such words: the place less the
position is where the template would begin. Beginnings where the other anchors do not
stand at their relative positions go, and what is left counts when every key phrase
stands there word for word. Each lookup reads one bucket of the index, and a template is
read by its number, so the work for a file does not grow with the number of templates.

All of that is done on the arrays of one row: no shuffle but for the word counts,
which have one row per word of the key phrases. The texts are read twice, for the counts
and for the scan. Null and empty texts have no words. Each row is looked at alone, so
repeated rows and ids change nothing. Columns may have any names but ``n_words`` and
``matches``, which are replaced.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import LOWER, UPPER, numbered, read, words_of

RARE_WORDS = 3


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...] = ()  # none: the whole text
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def phrases(self) -> list[tuple[int, list[str]]]:
        """Key phrases with their position in the template."""
        found = []
        for phrase in self.keys or (self.text,):
            words = phrase.split()
            starts = [i for i in range(len(self.words)) if self.words[i : i + len(words)] == words]
            found.append((starts[0], words))
        return found


# Licence names and the words that name them in licence notices.
TEMPLATES = [
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        ("permission is hereby granted free of charge", "obtaining a copy of this software"),
    ),
    Template("apache-2", "licensed under the apache license version 2 0", ("licensed under the apache license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use in source and binary forms",)),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("lgpl-3", "gnu lesser general public license version 3"),
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("mpl-2", "mozilla public license version 2 0", ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose",
             ("permission to use copy modify and or distribute this software",)),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc0", "cc0 1 0 universal"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software released into the public domain",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the software the "
        "software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
        "authors or copyright holders be liable for any claim damages or other liability whether in an action of "
        "contract tort or otherwise arising from out of or in connection with the software or the use or other dealings "
        "in the software",
        ("the above copyright notice and this permission notice shall be included in all copies", "without warranty of any kind"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies the software "
        "is provided as is and the author disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall the author be liable for any special direct "
        "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether "
        "in an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
        ("the above copyright notice and this permission notice appear in all copies", "the author disclaims all warranties"),
    ),
]


def vocabulary(templates: list[Template]) -> list[str]:
    """The words of all key phrases."""
    return sorted({word for t in templates for _, phrase in t.phrases for word in phrase})


def _constant(value: object, kind: str) -> Column:
    """A nested value as one literal, once the optimizer has folded it."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def document_counts(words: DataFrame, column: str, vocab: list[str]) -> dict[str, int]:
    """In how many documents each word of the vocabulary stands; a row per word reaches the driver."""
    known = _constant(vocab, "array<string>")
    seen = words.select(F.explode_outer(F.array_intersect(column, known)).alias("word"))
    counts = seen.filter("word IS NOT NULL").groupBy("word").count().collect()
    return dict.fromkeys(vocab, 0) | {r["word"]: r["count"] for r in counts}


def anchors(template: Template, counts: dict[str, int], most: int = RARE_WORDS) -> list[tuple[str, int]]:
    """Words of highest IDF in the key phrases, each with one position in the template, the rarest first."""
    position = {}
    for at, phrase in template.phrases:
        for k, word in enumerate(phrase):
            position.setdefault(word, at + k)
    chosen = sorted(position, key=lambda word: (counts[word], word))[:most]
    return [(word, position[word]) for word in chosen]


POSTINGS = "array<array<struct<word: string, template: int, position: int>>>"
TEMPLATE_ROWS = """array<struct<
    anchors: array<struct<word: string, at: int>>, keys: array<struct<at: int, words: array<string>>>, words: array<string>>>"""


def index_of(templates: list[Template], counts: dict[str, int]) -> tuple[list[list[dict]], list[dict], list[str]]:
    """Buckets of postings, templates by number, and the words that have postings."""
    n_buckets = 1 << max(4, (4 * len(templates)).bit_length())
    buckets: list[list[dict]] = [[] for _ in range(n_buckets)]
    rows, indexed = [], set()
    for number, t in enumerate(templates):
        (word, position), *others = anchors(t, counts)
        buckets[zlib.crc32(word.encode()) % n_buckets].append({"word": word, "template": number, "position": position})
        indexed.add(word)
        keys = [{"at": at, "words": phrase} for at, phrase in t.phrases]
        rows.append({"anchors": [{"word": w, "at": p} for w, p in others], "keys": keys, "words": t.words})
    return buckets, rows, sorted(indexed)


def _word_at(words: Column, place: Column) -> Column:
    return F.when(place >= 0, F.get(words, F.greatest(place, F.lit(0))))


def _stands_at(words: Column, start: Column, phrase: Column) -> Column:
    return (start >= 0) & (F.slice(words, F.greatest(start + 1, F.lit(1)), F.size(phrase)) == phrase)


def _likeness(words: Column, start: Column, template: Column) -> Column:
    """The share of the template's words that stand at their places."""
    equal = F.filter(template["words"], lambda word, k: F.coalesce(_word_at(words, start + k) == word, F.lit(False)))
    return F.size(equal) / F.size(template["words"])


def scan(docs: DataFrame, text: str = "text", templates: list[Template] = TEMPLATES) -> DataFrame:
    """``docs`` with ``n_words``, ``matches`` (template number, first word, score; by template and place)."""
    named, names = numbered(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "matches")]))
    others = list(names.values())
    split = named.select(*others, words_of(F.col(names[text])).alias("words"))
    buckets, rows, indexed = index_of(templates, document_counts(split, "words", vocabulary(templates)))
    index, known, words = _constant(buckets, POSTINGS), _constant(rows, TEMPLATE_ROWS), F.col("words")
    places = F.filter(F.transform(words, lambda word, i: F.when(word.isin(indexed), i)), lambda i: i.isNotNull())
    placed = split.select(*others, "words", places.alias("places"))

    def beginnings(i: Column) -> Column:
        """Where templates would begin of whose rarest anchor this is the place."""
        word = F.get(words, i)
        bucket = F.get(index, F.pmod(F.crc32(word), F.lit(len(buckets))).cast("int"))
        of_word = F.filter(bucket, lambda p: p["word"] == word)
        return F.transform(of_word, lambda p: F.struct(p["template"].alias("template"), (i - p["position"]).alias("start")))

    def agreed(b: Column) -> Column:
        return F.forall(F.get(known, b["template"])["anchors"], lambda a: F.coalesce(_word_at(words, b["start"] + a["at"]) == a["word"], F.lit(False)))

    def verified(b: Column) -> Column:
        return F.forall(F.get(known, b["template"])["keys"], lambda key: _stands_at(words, b["start"] + key["at"], key["words"]))

    begun = F.filter(F.filter(F.flatten(F.transform("places", beginnings)), agreed), verified)
    match = lambda b: F.struct(
        b["template"].alias("template"),
        b["start"].cast("long").alias("first_word"),
        _likeness(words, b["start"], F.get(known, b["template"])).alias("score"),
    )
    found = placed.select(*others, F.size("words").cast("long").alias("n_words"), F.sort_array(F.transform(begun, match)).alias("matches"))
    return found.toDF(*names, "n_words", "matches")


def _labels(matches: Column, chosen: list[Template]) -> Column:
    of_template = F.array(*[F.lit(t.label) if t in chosen else F.lit(None) for t in TEMPLATES])
    names = F.transform(matches, lambda m: F.get(of_template, m["template"]))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(names, lambda n: n.isNotNull()))), ",")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of all documents; base phrases are counted apart."""
    base = [t for t in TEMPLATES if t.base]
    found = scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    numbers = [n for n, t in enumerate(TEMPLATES) if t.base]
    starts = F.transform(F.filter("matches", lambda m: m["template"].isin(numbers)), lambda m: m["first_word"])
    rows = found.select("doc_id", "n_words", "matches", starts.alias("_starts"))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("_starts").cast("long").alias("n_base"),
        F.array_min("_starts").alias("first_word"),
        F.array_max("_starts").alias("last_word"),
        _labels(F.col("matches"), base).alias("base_labels"),
        _labels(F.col("matches"), TEMPLATES).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )


def _sql() -> str:
    """The same in SQL: every place is tried, without an index."""

    def at(start: str, phrase: list[str]) -> str:
        listed = ", ".join(f"'{w}'" for w in phrase)
        return f"({start} >= 0 AND w[{start} + 1 : {start} + {len(phrase)}] = [{listed}])"

    places, scores = [], []
    for n, t in enumerate(TEMPLATES):
        true = " AND ".join(at(f"(s + {o})", phrase) for o, phrase in t.phrases)
        first = f"-{t.phrases[0][0]}"
        offset, phrase = t.phrases[0]
        begun = f"list_filter(range({first}, len(w)), lambda s: w[s + {offset + 1}] = '{phrase[0]}')"
        places.append(f"list_filter({begun}, lambda s: {true}) AS p{n}")
        equal = " + ".join(f"CASE WHEN s + {k} >= 0 AND w[s + {k + 1}] = '{word}' THEN 1 ELSE 0 END" for k, word in enumerate(t.words))
        scores.append(f"list_max(list_transform(p{n}, lambda s: ({equal}) / {len(t.words)}.0::DOUBLE))")
    base = [n for n, t in enumerate(TEMPLATES) if t.base]

    def labels(numbers) -> str:
        each = ", ".join(f"CASE WHEN len(p{n}) > 0 THEN '{TEMPLATES[n].label}' END" for n in numbers)
        return f"array_to_string(list_sort(list_distinct([{each}])), ',')"

    starts = " || ".join(f"p{n}" for n in base)
    return f"""
    WITH tokens AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
    ), placed AS (SELECT doc_id, w, {", ".join(places)} FROM tokens)
    SELECT doc_id, len(w)::BIGINT AS n_words, len({starts})::BIGINT AS n_base,
           list_min({starts})::BIGINT AS first_word, list_max({starts})::BIGINT AS last_word,
           {labels(base)} AS base_labels, {labels(range(len(TEMPLATES)))} AS labels,
           coalesce(greatest({", ".join(scores)}), 0)::DOUBLE AS score
    FROM placed
    """


OP2_SQL = _sql()
