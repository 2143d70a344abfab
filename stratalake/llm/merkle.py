"""Document fingerprints: Merkle trees over phrases, paragraphs and sections.

The leaves are the hashes of a text's phrases, with their lengths. A phrase ends behind a
word whose own hash says so, one in four, or behind its eighth word: so phrases move with
the text, and a word put in changes the phrase around it only. A paragraph's (line's) hash
covers its phrases'. A section ends where a paragraph's hash ends in ``0``, one in sixteen.
A section's hash covers its paragraphs' hashes, the root covers the sections'. Equal roots
mean equal texts.

Where roots differ, two trees are compared from the top (``left_out``): sections of equal
hash are done with, the paragraphs of the others are compared by their hashes, and the
phrases of paragraphs that are still left by theirs (``characters_apart``). Repeats count
at each level.
Likeness is the share of the characters that found their like. ``edits`` gives the numbers
of the paragraphs that one text lacks, and of those that stand in another order: if the
roots differ, it is never empty on both sides. Nothing but the trees is needed.

The next document is found by joins on ids only: ids are ordered in ranges, as many
as shuffle partitions, written, and linked within ranges and from range to range. Texts
are shuffled twice, with their phrases marked. Null texts are empty. Rows without an id have no next document,
and a repeated id stands for its smallest text where it is the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import read, written

WORD = r"[ \t\r]*+[^ \t\r]++|[ \t\r]++"
# A line feed, of which paragraphs have none, marks where hashes end phrases.
PHRASE = r"(?:[ \t\r]*+[^ \t\r\n]++){1,8}+|[ \t\r]++"
LAST_WORDS = ("0", "4", "8", "c")
LEAF_DIGITS = 32


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once: the variable of a list of one."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _phrases(paragraph: Column) -> Column:
    words = F.regexp_extract_all(paragraph, F.lit(WORD), F.lit(0))
    ended = F.transform(words, lambda w: F.when(F.substring(F.md5(w), 32, 1).isin(*LAST_WORDS), F.concat(w, F.lit("\n"))).otherwise(w))
    return F.regexp_extract_all(F.array_join(ended, ""), F.lit(PHRASE), F.lit(0))


def _leaf(phrase: Column) -> Column:
    return F.concat_ws(":", F.substring(F.sha2(phrase, 256), 1, LEAF_DIGITS), F.length(phrase).cast("string"))


def _branch(hashed: Column, size: Column, content: Column) -> Column:
    return F.concat(F.sha2(hashed, 256), F.lit(":"), size.cast("string"), F.lit("="), content)


def _hash_of(branch: Column) -> Column:
    return F.substring(branch, 1, 64)


def _content_of(branch: Column) -> Column:
    return F.substr(branch, F.locate("=", branch) + 1)


def _of_phrases(phrases: Column, size: Column) -> Column:
    joined = F.array_join(F.transform(phrases, _leaf), " ")
    return _let(joined, lambda found: _branch(found, size, found))


def paragraphs(text: Column) -> Column:
    """Each paragraph as a branch: the hash over its leaves, its length, and behind them the leaves."""
    return F.transform(F.split(text, "\n"), lambda p: _of_phrases(_phrases(p), F.length(p)))


def marked(text: Column) -> Column:
    """The text with one line feed behind each phrase but a paragraph's last, and two between paragraphs."""
    return F.array_join(F.transform(F.split(text, "\n"), lambda p: F.array_join(_phrases(p), "\n")), "\n\n")


def unmarked(marked_text: Column) -> Column:
    return F.regexp_replace(marked_text, "\n(\n?)", "$1")


def marked_paragraphs(marked_text: Column) -> Column:
    """``paragraphs`` of a marked text: words are not looked at again."""

    def of_paragraph(paragraph: Column) -> Column:
        # Phrases are never empty.
        phrases = F.when(paragraph == "", F.array().cast("array<string>")).otherwise(F.split(paragraph, "\n"))
        return _of_phrases(phrases, F.length(F.replace(paragraph, F.lit("\n"), F.lit(""))))

    return F.transform(F.split(marked_text, "\n\n"), of_paragraph)


def sections(some_paragraphs: Column) -> Column:
    """Each section as a branch: the hash over those of its paragraphs, its length in letters of these, and behind them these."""
    ended = F.transform(some_paragraphs, lambda p: F.when(F.substring(p, 64, 1) == "0", F.concat(p, F.lit("|"))).otherwise(F.concat(p, F.lit(";"))))
    # Without what ends the last paragraph.
    contents = F.split(_let(F.array_join(ended, ""), lambda all_of: F.left(all_of, F.length(all_of) - 1)), r"\|")

    def of_section(content: Column) -> Column:
        return _branch(F.array_join(F.transform(F.split(content, ";"), _hash_of), " "), F.length(content), content)

    return F.transform(contents, of_section)


def root(some_sections: Column) -> Column:
    return F.sha2(F.array_join(F.transform(some_sections, _hash_of), " "), 256)


def fingerprint(text: Column) -> Column:
    return root(sections(paragraphs(text)))


def _in_runs(ordered: Column, key: Callable[[Column], Column], made: Callable[[Column, Column], Column]) -> Column:
    """``made(element, nth)`` for all elements in order of ``key``, numbered from 0 among those of equal key."""

    def of_runs(found: Column, starts: Column) -> Column:
        n = F.size(starts)
        ends = F.slice(F.concat(F.slice(starts, F.lit(2), n), F.array(F.size(found))), F.lit(1), n)
        return F.flatten(F.zip_with(starts, ends, lambda start, end: F.transform(F.slice(found, start + 1, end - start), made)))

    def of_sorted(found: Column) -> Column:
        places = F.transform(found, lambda x, i: F.when((i == 0) | (key(x) != key(F.get(found, F.greatest(i - 1, F.lit(0))))), i))
        return _let(F.filter(places, lambda i: i.isNotNull()), lambda starts: of_runs(found, starts))

    return _let(ordered, of_sorted)


def told_apart(branches: Column) -> Column:
    """Branches or leaves, equal ones numbered, so that sets of them count repeats."""
    return _in_runs(F.sort_array(branches), lambda b: b, lambda b, nth: F.concat_ws("#", nth.cast("string"), b))


def _only(mine: Column, theirs: Column) -> Column:
    left = F.array_except(mine, theirs)
    return F.transform(left, lambda b: F.substr(b, F.locate("#", b) + 1))


def _both_ways(mine: Column, theirs: Column) -> Column:
    """What each side has and the other has not, as a struct of two lists."""
    pair = F.struct(told_apart(mine).alias("l"), told_apart(theirs).alias("r"))
    return _let(pair, lambda p: F.struct(_only(p["l"], p["r"]).alias("l"), _only(p["r"], p["l"]).alias("r")))


def _below(branches: Column, separator: str) -> Column:
    parts = F.flatten(F.transform(branches, lambda b: F.split(_content_of(b), separator)))
    return F.filter(parts, lambda part: part != "")


def left_out(mine: Column, theirs: Column) -> Column:
    """The paragraphs of two trees' sections that have no like: only sections that differ are opened."""
    by_paragraph = lambda p: _both_ways(_below(p["l"], ";"), _below(p["r"], ";"))
    return _let(_both_ways(mine, theirs), by_paragraph)


def _added_up(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda n, x: n + x)


def _leaf_characters(some_leaves: Column) -> Column:
    # A leaf's length stands behind a colon.
    return _added_up(F.transform(some_leaves, lambda leaf: F.substring_index(leaf, ":", -1).cast("long")))


def _characters_below(some_paragraphs: Column) -> Column:
    # A paragraph's length stands behind its hash.
    return _added_up(F.transform(some_paragraphs, lambda p: F.substring_index(F.substring(p, 66, 20), "=", 1).cast("long")))


def _repeats(some_leaves: Column) -> Column:
    """Each leaf as often as it is there, less once."""
    again = lambda found: F.filter(found, lambda b, i: (i > 0) & (b == F.get(found, F.greatest(i - 1, F.lit(0)))))
    return _let(F.sort_array(some_leaves), again)


def characters_apart(mine: Column, theirs: Column) -> Column:
    """The characters of the leaves below two lists of paragraphs that have no like on the other side."""

    def shared(p: Column) -> Column:
        repeats = F.array_intersect(told_apart(_repeats(p["l"])), told_apart(_repeats(p["r"])))
        return _leaf_characters(F.array_intersect(p["l"], p["r"])) + _leaf_characters(repeats)

    opened = F.struct(_below(mine, " ").alias("l"), _below(theirs, " ").alias("r"))
    return _characters_below(mine) + _characters_below(theirs) - 2 * _let(opened, shared)


def edits(text: Column, other: Column) -> Column:
    """Numbers of paragraphs, from 0: ``removed`` and ``moved`` of ``text``, ``added`` of ``other``.

    Equal paragraphs are paired in their order. Of the pairs, those are moved whose place
    among all pairs is another in ``other``.
    """
    return edits_of(paragraphs(text), paragraphs(other))


def edits_of(mine: Column, theirs: Column) -> Column:
    def keyed(branches: Column, side: int) -> Column:
        ordered = F.sort_array(F.transform(branches, lambda b, i: F.struct(_hash_of(b).alias("h"), i.alias("i"))))
        keys = lambda x, nth: F.struct(F.concat_ws("#", x["h"], nth.cast("string")).alias("k"), F.lit(side).alias("s"), x["i"].alias("i"))
        return _in_runs(ordered, lambda x: x["h"], keys)

    def places(found: Column, made: Callable[[Column, Column], Column]) -> Column:
        return F.sort_array(F.filter(F.transform(found, made), lambda x: x.isNotNull()))

    def of_merged(found: Column) -> Column:
        before = lambda m: F.get(found, F.greatest(m - 1, F.lit(0)))
        behind = lambda m: F.get(found, m + 1)
        paired = lambda x, m: F.coalesce(behind(m)["k"] == x["k"], F.lit(False))
        removed = places(found, lambda x, m: F.when((x["s"] == 0) & ~paired(x, m), x["i"]))
        added = places(found, lambda x, m: F.when((x["s"] == 1) & ((m == 0) | (before(m)["k"] != x["k"])), x["i"]))
        pairs = places(found, lambda x, m: F.when((x["s"] == 0) & paired(x, m), F.struct(x["i"].alias("i"), behind(m)["i"].alias("j"))))

        def of_pairs(p: Column) -> Column:
            return _let(F.sort_array(p["j"]), lambda js: F.transform(p, lambda x, r: F.when(x["j"] != F.get(js, r), x["i"])))

        moved = F.filter(_let(pairs, of_pairs), lambda i: i.isNotNull())
        return F.struct(removed.alias("removed"), added.alias("added"), moved.alias("moved"))

    return _let(F.sort_array(F.concat(keyed(mine, 0), keyed(theirs, 1))), of_merged)


def changed_paragraphs(text: Column, other: Column) -> Column:
    """Numbers of the paragraphs of ``text``, from 0, that ``other`` has not, or has in another order."""
    return _let(edits(text, other), lambda e: F.sort_array(F.concat(e["removed"], e["moved"])))


def with_trees(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Tree and root of several text columns, by prefix; the texts' columns stay."""
    others = [F.col(f"`{c}`") for c in df.columns]
    lines = df.select(*others, *[paragraphs(F.col(column)).alias(f"{prefix}_paragraphs") for prefix, column in texts.items()])
    return with_roots(lines, list(texts))


def with_roots(df: DataFrame, prefixes: list[str]) -> DataFrame:
    """Sections, root and number of characters above the paragraphs of each prefix."""
    df = df.select("*", *[sections(F.col(f"{p}_paragraphs")).alias(f"{p}_sections") for p in prefixes])
    return df.select("*", *[root(F.col(f"{p}_sections")).alias(f"{p}_root") for p in prefixes])


def likeness(left: str, right: str, n_left: Column, n_right: Column) -> Column:
    """1 for equal roots, else the share of characters in branches and leaves that have their like.

    ``n_left`` and ``n_right`` are the characters of both texts, line feeds aside.
    """
    both = n_left + n_right
    missing = _let(
        left_out(F.col(f"{left}_sections"), F.col(f"{right}_sections")), lambda p: characters_apart(p["l"], p["r"])
    )
    by_parts = F.when(both > 0, (both - missing) / both).otherwise(0.0)
    return F.when(F.col(f"{left}_root") == F.col(f"{right}_root"), 1.0).otherwise(by_parts)


def characters(text: Column) -> Column:
    """How many characters stand in phrases: all but line feeds."""
    return F.length(F.replace(text, F.lit("\n"), F.lit(""))).cast("long")


def previous_ids(docs: DataFrame) -> DataFrame:
    """Every id with the one before it; the first follows the last."""
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ranged = written(ordered.withColumn("_range", F.spark_partition_id()), "ids")
    inside = ranged.withColumn("_before", F.lag("doc_id").over(Window.partitionBy("_range").orderBy("doc_id")))
    # A row per range, as many as shuffle partitions.
    ends = ranged.groupBy("_range").agg(F.max("doc_id").alias("_last"))
    by_range = Window.partitionBy(F.lit(0)).orderBy("_range")
    whole = Window.partitionBy(F.lit(0))
    ends = ends.select(
        F.col("_range").alias("_of"),
        F.coalesce(F.lag("_last").over(by_range), F.max("_last").over(whole)).alias("_last_before"),
    )
    joined = inside.join(F.broadcast(ends), F.col("_range") == F.col("_of"))
    return joined.select(F.col("doc_id").alias("_id"), F.coalesce("_before", "_last_before").alias("_previous"))


def with_next_text(docs: DataFrame) -> DataFrame:
    """doc_id, text and the text of the next document, empty where there is none; both also ``marked``.

    Phrases are found before the rows are dealt, once for a text and for the one before it. Only
    marked texts are shuffled; the text itself goes along where it is no UTF-8, which marking would mend.
    """
    filled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = filled.select("doc_id", marked(F.col("text")).alias("marked"), F.when(~F.is_valid_utf8("text"), F.col("text")).alias("_raw"))
    known = rows.filter("doc_id IS NOT NULL")
    text = F.coalesce("_raw", unmarked(F.col("marked")))
    # Dealt by id once, and used on both sides. An id has one before it.
    following = (
        known.join(previous_ids(docs).hint("merge"), F.col("doc_id") == F.col("_id"))
        .groupBy("doc_id")
        .agg(F.min("_previous").alias("_previous"), F.min_by(F.struct("marked", "_raw"), text).alias("_next"))
        .select("_previous", F.col("_next.marked").alias("next_marked"), F.col("_next._raw").alias("_next_raw"))
    )
    linked = known.hint("merge").join(following, F.col("doc_id") == F.col("_previous")).drop("_previous")
    alone = rows.filter("doc_id IS NULL").withColumns({"next_marked": F.lit(""), "_next_raw": F.lit(None).cast("string")})
    next_text = F.coalesce("_next_raw", unmarked(F.col("next_marked")))
    return linked.unionByName(alone).select("doc_id", text.alias("text"), next_text.alias("next_text"), "marked", "next_marked")


def op5_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and which paragraphs the edit removed, added and moved."""
    rows = with_next_text(read(spark, sf_dir, "documents")).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("_replaced", F.expr("cast(n_chars div 4 as int)"))
    start = F.substring("text", F.lit(1), (F.col("n_chars") - F.col("_replaced")).cast("int"))
    cut = rows.select("*", start.alias("_start"), F.substring("next_text", F.lit(1), F.col("_replaced")).alias("_piece"))
    edited = cut.select("*", F.concat("_start", "_piece").alias("edited"))
    own, following = (marked_paragraphs(F.col(c)) for c in ("marked", "next_marked"))
    lines = edited.select("*", own.alias("own_paragraphs"), following.alias("next_paragraphs"))
    # The paragraphs before the cut are known from the text's own tree.
    kept = F.length("_start") - characters(F.col("_start"))
    begun = F.concat(F.substring_index("_start", "\n", -1), F.col("_piece"))
    lines = lines.select("*", F.concat(F.slice("own_paragraphs", F.lit(1), kept.cast("int")), paragraphs(begun)).alias("edited_paragraphs"))
    trees = with_roots(lines, ["own", "edited", "next"])
    n_own, n_edited, n_next = (characters(F.col(c)) for c in ("text", "edited", "next_text"))
    found = trees.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("own_root").alias("fingerprint"),
        F.col("edited_root").alias("edited_fingerprint"),
        likeness("own", "edited", n_own, n_edited).alias("near_edited"),
        likeness("own", "next", n_own, n_next).alias("near_next"),
        edits_of(F.col("own_paragraphs"), F.col("edited_paragraphs")).alias("_edits"),
    )
    counts = [F.size(F.col("_edits")[c]).cast("long").alias(f"n_{c}") for c in ("removed", "added", "moved")]
    first = F.array_min(F.concat(F.col("_edits.removed"), F.col("_edits.moved"))).cast("long").alias("first_changed")
    return found.select(*[c for c in found.columns if c != "_edits"], *counts, first)


def _sql() -> str:
    """The same in SQL: a row per section, paragraph and phrase, numbered among its likes."""
    word = "[ \\t\\r]*[^ \\t\\r]+|[ \\t\\r]+"
    phrase = "(?:[ \\t\\r]*[^ \\t\\r\\n]+){1,8}|[ \\t\\r]+"
    last = ", ".join(f"'{c}'" for c in LAST_WORDS)

    def only(table: str, source: str, columns: str) -> str:
        """Rows of ``source`` (doc, side, h) without a like on the other side, for both pairs of texts."""
        return f"""
        {table}_n AS (
            SELECT *, row_number() OVER (PARTITION BY doc, pair, side, h) AS nth FROM {source}
        ), {table} AS (
            SELECT doc, pair, side, {columns} FROM {table}_n AS a
            WHERE NOT EXISTS (SELECT 1 FROM {table}_n AS b
                              WHERE a.doc = b.doc AND a.pair = b.pair AND a.side <> b.side AND a.h = b.h AND a.nth = b.nth)
        )"""

    return f"""
    WITH base AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    linked AS (
        SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text
        FROM base
    ), cut AS (
        SELECT *, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited FROM linked
    ), texts AS (
        SELECT doc_id AS doc, 'own' AS kind, text AS t FROM cut
        UNION ALL SELECT doc_id, 'edited', edited FROM cut
        UNION ALL SELECT doc_id, 'next', next_text FROM cut
    ), lines AS (
        SELECT doc, kind, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS i FROM texts
    ), phrases AS (
        SELECT doc, kind, i, list_transform(
            regexp_extract_all(array_to_string(list_transform(regexp_extract_all(line, '{word}'),
                lambda w: w || CASE WHEN right(md5(w), 1) IN ({last}) THEN chr(10) ELSE '' END), ''), '{phrase}'),
            lambda c: left(sha256(c), {LEAF_DIGITS}) || ':' || length(c)) AS leaves
        FROM lines
    ), paragraphs AS (
        SELECT doc, kind, i, leaves, sha256(coalesce(array_to_string(leaves, ' '), '')) AS h FROM phrases
    ), numbered AS (
        SELECT *, coalesce(sum(CASE WHEN right(h, 1) = '0' THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
        FROM paragraphs
    ), sections AS (
        SELECT doc, kind, s, sha256(string_agg(h, ' ' ORDER BY i)) AS h FROM numbered GROUP BY doc, kind, s
    ), roots AS (
        SELECT doc, kind, sha256(string_agg(h, ' ' ORDER BY s)) AS root FROM sections GROUP BY doc, kind
    ), pairs AS (
        SELECT * FROM (VALUES ('edited', 'own'), ('edited', 'edited'), ('next', 'own'), ('next', 'next')) AS v(pair, kind)
    ), section_sides AS (
        SELECT doc, pair, kind = 'own' AS side, kind, s, h FROM sections JOIN pairs USING (kind)
    ), {only("open_sections", "section_sides", "kind, s")},
    paragraph_sides AS (
        SELECT o.doc, o.pair, o.side, n.leaves, n.h FROM open_sections AS o
        JOIN numbered AS n ON n.doc = o.doc AND n.kind = o.kind AND n.s = o.s
    ), {only("open_paragraphs", "paragraph_sides", "leaves")},
    leaf_sides AS (SELECT doc, pair, side, unnest(leaves) AS h FROM open_paragraphs),
    {only("open_leaves", "leaf_sides", "h")},
    missing AS (
        SELECT doc, pair, sum(substr(h, {LEAF_DIGITS + 2})::BIGINT)::BIGINT AS n FROM open_leaves GROUP BY doc, pair
    ), sizes AS (
        SELECT doc, kind, length(replace(t, chr(10), ''))::BIGINT AS n FROM texts
    ), near AS (
        SELECT p.doc_id AS doc, v.pair, CASE WHEN a.root = b.root THEN 1.0::DOUBLE
               WHEN x.n + y.n > 0 THEN (x.n + y.n - coalesce(m.n, 0))::DOUBLE / (x.n + y.n)::DOUBLE ELSE 0.0::DOUBLE END AS likeness
        FROM cut AS p CROSS JOIN (VALUES ('edited'), ('next')) AS v(pair)
        JOIN roots AS a ON a.doc = p.doc_id AND a.kind = 'own' JOIN roots AS b ON b.doc = p.doc_id AND b.kind = v.pair
        JOIN sizes AS x ON x.doc = p.doc_id AND x.kind = 'own' JOIN sizes AS y ON y.doc = p.doc_id AND y.kind = v.pair
        LEFT JOIN missing AS m ON m.doc = p.doc_id AND m.pair = v.pair
    ), keyed AS (
        SELECT doc, kind, i, h, row_number() OVER (PARTITION BY doc, kind, h ORDER BY i) AS nth
        FROM paragraphs WHERE kind IN ('own', 'edited')
    ), met AS (
        SELECT doc, o.i, e.i AS j
        FROM (SELECT * FROM keyed WHERE kind = 'own') AS o FULL JOIN (SELECT * FROM keyed WHERE kind = 'edited') AS e USING (doc, h, nth)
    ), ordered AS (
        SELECT *, row_number() OVER (PARTITION BY doc, i IS NULL, j IS NULL ORDER BY i) AS at_i,
               row_number() OVER (PARTITION BY doc, i IS NULL, j IS NULL ORDER BY j) AS at_j
        FROM met
    ), edits AS (
        SELECT doc, count(*) FILTER (j IS NULL) AS n_removed, count(*) FILTER (i IS NULL) AS n_added,
               count(*) FILTER (i IS NOT NULL AND j IS NOT NULL AND at_i <> at_j) AS n_moved,
               min(i) FILTER (j IS NULL OR at_i <> at_j) AS first_changed
        FROM ordered GROUP BY doc
    )
    SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, a.root AS fingerprint,
           b.root AS edited_fingerprint, e.likeness AS near_edited, n.likeness AS near_next,
           n_removed, n_added, n_moved, first_changed
    FROM cut
    JOIN roots AS a ON a.doc = doc_id AND a.kind = 'own' JOIN roots AS b ON b.doc = doc_id AND b.kind = 'edited'
    JOIN near AS e ON e.doc = doc_id AND e.pair = 'edited' JOIN near AS n ON n.doc = doc_id AND n.pair = 'next'
    JOIN edits ON edits.doc = doc_id
    """


OP5_SQL = _sql()
