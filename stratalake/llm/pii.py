"""Personal data: candidate spans judged by gradient-boosted trees.

Base rules find e-mail addresses, IP addresses, card numbers and phone numbers that
pass their checks. Generators with high recall propose further spans, which overlap
each other and the base spans: anything with an at sign, dotted numbers, long runs of
digits, digits with phone punctuation. A candidate is described by its form (length,
digits, groups, marks) and its context (what stands before and after), never by the
checks themselves. Boosted trees learn which candidates hold a base span of their
kind; so a card number with one wrong digit in the place of a card number scores
high. Scores are calibrated on all candidates: a kind's threshold is the lowest score
from which on at least ``PRECISION`` of the candidates hold a base span. Candidates
above it are spans as well, unless they touch a base span or a neighbour that scores
higher. Base spans always stay.

Secrets have no base rule. Their candidates are long runs of letters, digits and the marks of encoded bytes; those that
something like ``token =`` stands before are labelled so. Trees of their own learn from the form alone, not from what stands
before, so that a secret without such a word is found too. They are fitted on one half of the candidates, by hash, and the
threshold comes from the other.

Patterns are anchored or possessive, so that long texts without a match take linear
time. Equal texts are judged once: candidates have the text's digest as key, and rows
find their spans by it. The trees are fitted on at most ``SAMPLE_ROWS`` candidates,
the first by hash; candidates, scores and thresholds cover all texts. If the sample
has no base span, or nothing else, no span is added.

Null texts are empty. Every row gets its spans, repeated rows and ids too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import numbered, read, written

KINDS = ["email", "ip", "card", "phone"]
SECRET = len(KINDS)
ALL_KINDS = [*KINDS, "secret"]
SAMPLE_ROWS = 20_000
PRECISION = 0.95
SCORE_STEPS = 100
BLOCK = 128
ROUNDS = 10
DEPTH = 3

# What a pattern finds is the same as with the plain form given beside it.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+, of at least 13 digits
    "card": r"(?<![0-9])(?=(?:[0-9][\x20-]?){12}[0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![^\s@])[^\s@]++@[^\s@]++",
    "ip": r"(?<![0-9])[0-9]++(?:[.,:][0-9]++){2,}+",
    "card": r"(?<![0-9])[0-9]{4}[0-9 ./-]{6,}[0-9]",
    "phone": r"[+(]?[0-9][0-9 ().-]{6,}[0-9]",
}
WIDE_SECRET = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+"
SECRET_BEFORE = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|key|auth)[\"']?\s*[=:]\s*[\"']?$"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
FEATURES = ["kind", "length", "digits", "letters", "groups", "longest", "dots", "plus", "parens", "spaces", "dashes",
            "before_space", "before_word", "before_length", "after_space", "after_mark", "after_word"]
SECRET_FEATURES = ["length", "digits", "letters", "groups", "longest", "dashes", "different", "hex", "vowels", "changes"]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _passes(kind: str, text: Column) -> Column:
    n = F.length(_digits(text))
    if kind == "ip":
        return text.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return n.between(13, 19) & F.call_function("luhn_check", _digits(text))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _summed(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda n, x: n + x)


def with_matches(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """``df`` with all matches of each pattern: start, end (code points), text and what stands beside.

    What lies between the matches, in order, is what a split at the pattern leaves.
    Ends are sums over blocks and within a block, so that many matches take little
    more than linear time. Lambdas refer to their own variables only: Spark would
    work out any other column again for each element.
    """
    others, names = df.columns, list(patterns)
    df = df.withColumns(
        {f"_found_{n}": F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)) for n, p in patterns.items()}
        | {f"_gaps_{n}": F.split(F.col(text), p) for n, p in patterns.items()}
    )

    def parts(n: str) -> Column:
        gaps = F.slice(f"_gaps_{n}", F.lit(1), F.size(f"_found_{n}"))
        pairs = F.zip_with(gaps, f"_found_{n}", lambda gap, m: F.length(gap) + F.length(m))
        blocks = F.sequence(F.lit(0), F.floor(F.size(f"_found_{n}") / BLOCK).cast("int"))
        # The sizes stand in a list of their own, as the variable that the blocks are cut from.
        cut = F.transform(F.array(pairs), lambda sizes: F.transform(blocks, lambda b: F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))))
        return F.flatten(cut)

    def ends(n: str) -> Column:
        def of_blocks(blocks: Column) -> Column:
            sums = F.transform(F.array(F.transform(blocks, _summed)), _running)
            return F.flatten(F.zip_with(blocks, F.get(sums, F.lit(0)), _ends_in_block))

        return F.get(F.transform(F.array(F.col(f"_parts_{n}")), of_blocks), F.lit(0))

    def spans(n: str) -> Column:
        size = F.size(f"_found_{n}")
        rows = F.arrays_zip(
            F.col(f"_found_{n}").alias("text"),
            F.col(f"_ends_{n}").alias("end"),
            F.slice(f"_gaps_{n}", F.lit(1), size).alias("gap"),
            F.slice(f"_gaps_{n}", F.lit(2), size).alias("next"),
        )
        return F.transform(
            rows,
            lambda r: F.struct(
                (r["end"] - F.length(r["text"])).alias("start"),
                r["end"].alias("end"),
                r["text"].alias("text"),
                F.right(r["gap"], F.lit(20)).alias("before"),
                F.left(r["next"], F.lit(1)).alias("after"),
            ),
        )

    df = df.withColumns({f"_parts_{n}": parts(n) for n in names})
    df = df.withColumns({f"_ends_{n}": ends(n) for n in names})
    return df.select(*others, *[spans(n).alias(n) for n in names])


def _running(sums: Column) -> Column:
    """For each block, the sum of all before it."""
    return F.transform(sums, lambda _, b: _summed(F.slice(sums, F.lit(1), b)))


def _ends_in_block(sizes: Column, before: Column) -> Column:
    return F.transform(sizes, lambda _, i: before + _summed(F.slice(sizes, F.lit(1), i + 1)))


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def candidates(docs: DataFrame) -> DataFrame:
    """key, kind number, start, end, base flag, label and features of all candidates; equal texts once."""
    hint = "[@0-9]"  # every pattern needs one of these
    texts = docs.select(text_key(F.col("text")).alias("key"), "text").filter(F.col("text").rlike(hint))
    patterns = {f"base_{k}": p for k, p in BASE.items()} | {f"wide_{k}": p for k, p in WIDE.items()}
    patterns["wide_secret"] = WIDE_SECRET
    found = with_matches(texts, "text", patterns)
    arrays = []
    for number, kind in enumerate(KINDS):
        arrays.append(_marked(F.filter(f"base_{kind}", _passing(kind)), number, True))
        arrays.append(_marked(F.col(f"wide_{kind}"), number, False))
    arrays.append(_marked(F.col("wide_secret"), SECRET, False))
    # Only this narrow array is shuffled; copies of a text are one row from here on.
    # No filter on its size: that would work everything out once more.
    rows = found.select("key", F.concat(*arrays).alias("_all"))
    spans = rows.groupBy("key").agg(F.first("_all").alias("_all")).select("key", F.inline("_all"))
    return _described(spans)


def _passing(kind: str):
    return lambda span: _passes(kind, span["text"])


def _marked(spans: Column, number: int, base: bool) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(number).alias("kind_no"),
            F.lit(base).alias("base"),
            *[s[c].alias(c) for c in ("start", "end", "text", "before", "after")],
        ),
    )


def _described(spans: DataFrame) -> DataFrame:
    """Spans with label, form and context; a candidate that is a base span itself goes."""
    in_kind = Window.partitionBy("key", "kind_no").orderBy("start", "end", "base")
    base_end = F.max(F.when(F.col("base"), F.col("end"))).over(in_kind.rowsBetween(Window.unboundedPreceding, -1))
    base_start = F.min(F.when(F.col("base"), F.col("start"))).over(in_kind.rowsBetween(1, Window.unboundedFollowing))
    twin = F.max("base").over(Window.partitionBy("key", "kind_no", "start", "end")) & ~F.col("base")
    holds = F.col("base") | (F.coalesce(base_end, F.lit(0)) > F.col("start")) | (
        F.coalesce(base_start, F.col("end")) < F.col("end")
    )
    holds = F.when(F.col("kind_no") == SECRET, F.col("before").rlike(SECRET_BEFORE)).otherwise(holds)
    labelled = spans.withColumns({"label": F.when(holds, 1).otherwise(0), "_twin": twin}).filter("NOT _twin").drop("_twin")
    word, before, after = F.col("text"), F.col("before"), F.col("after")
    count = lambda pattern: F.length(word) - F.length(F.regexp_replace(word, pattern, ""))
    flag = lambda condition: F.when(condition, 1).otherwise(0)
    groups = F.filter(F.split(word, "[^0-9]+"), lambda g: g != "")
    values = {
        "kind": F.col("kind_no"),
        "length": F.length(word),
        "digits": count("[0-9]"),
        "letters": count("[A-Za-z]"),
        "groups": F.size(groups),
        "longest": F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        "dots": count(r"\."),
        "plus": count(r"\+"),
        "parens": count("[()]"),
        "spaces": count(" "),
        "dashes": count("-"),
        "before_space": flag((F.col("start") == 0) | before.rlike(r"\s$")),
        "before_word": flag((F.col("start") > 0) & (before.rlike(r"[\p{L}\p{N}]$") | (before == ""))),
        "before_length": F.length(F.regexp_extract(before, r"(\S*)\s*$", 1)),
        "after_space": flag((after == "") | after.rlike(r"^\s")),
        "after_mark": flag(after.rlike(r"^[.,;:!?]")),
        "after_word": flag(after.rlike(r"^[\p{L}\p{N}]")),
        "different": F.size(F.array_distinct(F.split(F.left(word, F.lit(256)), ""))),
        "hex": count("[0-9A-Fa-f]"),
        "vowels": count("[AEIOUaeiou]"),
        # Where letters follow digits: often in codes, rarely in words with a number.
        "changes": F.size(F.regexp_extract_all(word, F.lit("[0-9][A-Za-z]"), F.lit(0))),
    }
    features = dict.fromkeys([*FEATURES, *SECRET_FEATURES])
    return labelled.select(
        "key", "kind_no", "start", "end", "base", "label", *[values[n].cast("double").alias(n) for n in features]
    )


def held_out() -> Column:
    """The half of the candidates of secrets that the trees never see."""
    return (F.col("kind_no") == SECRET) & (F.pmod(F.xxhash64("key", "start"), F.lit(2)) == 1)


def _judged(spans: DataFrame, features: list[str]) -> DataFrame:
    """Candidates with ``score``; below zero where there is nothing to learn from."""
    seen = spans.filter(~held_out())
    sample = seen.orderBy(F.xxhash64("key", "kind_no", "start", "base"), "key", "start", "end").limit(SAMPLE_ROWS)
    sample = written(sample.select("label", *features), "sample").coalesce(1)
    labels = {r["label"] for r in sample.select("label").distinct().collect()}
    if labels != {0, 1}:
        return spans.withColumn("score", F.lit(-1.0))
    assembler = VectorAssembler(inputCols=features, outputCol="_features")
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", maxIter=ROUNDS, maxDepth=DEPTH, seed=17
    ).fit(assembler.transform(sample))
    judged = trees.transform(assembler.transform(spans))
    return judged.withColumn("score", vector_to_array("probability")[1]).drop("_features", "probability", "rawPrediction", "prediction")


def scored(spans: DataFrame) -> DataFrame:
    """Candidates with ``score``, by one set of trees for the kinds with base rules and one for secrets."""
    is_secret = F.col("kind_no") == SECRET
    return _judged(spans.filter(~is_secret), FEATURES).unionByName(_judged(spans.filter(is_secret), SECRET_FEATURES))


def thresholds(judged: DataFrame) -> dict[int, float]:
    """Per kind the lowest score whose candidates, with all above, are right often enough; of secrets the held-out ones."""
    known = judged.filter((F.col("score") >= 0) & ((F.col("kind_no") != SECRET) | held_out()))
    step = F.floor(F.col("score") * SCORE_STEPS).cast("int").alias("step")
    # Rows: kinds by steps.
    counts = known.groupBy("kind_no", step).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("right")).collect()
    found = {}
    for kind in {r["kind_no"] for r in counts}:
        n = right = 0
        for row in sorted((r for r in counts if r["kind_no"] == kind), key=lambda r: -r["step"]):
            n, right = n + row["n"], right + row["right"]
            if right < PRECISION * n:
                break
            found[kind] = row["step"] / SCORE_STEPS
    return found


def select_spans(judged: DataFrame) -> DataFrame:
    """key, kind_no, start, end and base of the base spans and of the candidates above the thresholds."""
    limits = thresholds(judged)
    above = reduce(
        lambda a, b: a | b, [(F.col("kind_no") == k) & (F.col("score") >= v) for k, v in limits.items()], F.lit(False)
    )
    chosen = judged.select("key", "kind_no", "start", "end", "base", "score", "label").filter(F.col("base") | above)
    in_text = Window.partitionBy("key").orderBy("start", "end", "kind_no", "base")
    earlier = in_text.rowsBetween(Window.unboundedPreceding, -1)
    later = in_text.rowsBetween(1, Window.unboundedFollowing)
    beside = chosen.withColumns(
        {
            "_base_end": F.max(F.when(F.col("base"), F.col("end"))).over(earlier),
            "_base_start": F.min(F.when(F.col("base"), F.col("start"))).over(later),
        }
    )
    touches = (F.coalesce("_base_end", F.lit(-1)) > F.col("start")) | (
        F.coalesce("_base_start", F.col("end")) < F.col("end")
    )
    free = beside.filter(F.col("base") | ~touches)
    around = free.withColumns(
        {
            "_e": F.lag("end").over(in_text),
            "_es": F.lag("score").over(in_text),
            "_s": F.lead("start").over(in_text),
            "_ss": F.lead("score").over(in_text),
        }
    )
    beaten = ((F.col("_e") > F.col("start")) & (F.col("_es") >= F.col("score"))) | (
        (F.col("_s") < F.col("end")) & (F.col("_ss") > F.col("score"))
    )
    return around.filter(F.col("base") | ~F.coalesce(beaten, F.lit(False))).select("key", "kind_no", "start", "end", "base")


def find_spans(docs: DataFrame) -> DataFrame:
    """key (of ``text_key``) and the array ``spans`` (kind_no, start, end, base), sorted, for texts that have any."""
    judged = scored(written(candidates(docs), "candidates"))
    spans = F.array_sort(F.collect_list(F.struct("kind_no", "start", "end", "base")))
    return written(select_spans(judged).groupBy("key").agg(spans.alias("spans")), "spans")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; other columns stay.

    Spans that overlap are replaced together, by the kind of the first. Texts without
    spans, null ones too, stay as they are.
    """
    found = find_spans(docs)
    by_start = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind_no"].alias("kind_no")))
    )
    spans = found.select(F.col("key").alias("_key"), by_start.alias("_spans"))
    rows, names_of = numbered(docs)
    own = F.col(names_of["text"])
    keyed = rows.withColumn("_own_key", text_key(own))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in ALL_KINDS])
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(done: Column, span: Column) -> Column:
        gap = F.substring(own, done["at"] + 1, span["start"] - done["at"])
        more = F.concat(done["parts"], F.array(gap, F.get(names, span["kind_no"])))
        inside = span["start"] < done["at"]
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"), F.when(inside, done["parts"]).otherwise(more).alias("parts")
        )

    cut = F.aggregate("_spans", empty, add)
    rest = F.substring(own, cut["at"] + 1, F.length(own))
    text = F.when(F.col("_spans").isNull(), own).otherwise(F.concat(F.array_join(cut["parts"], ""), rest))
    # Both sides are tables: adaptive execution can split the copies of a text.
    joined = keyed.join(spans.hint("merge"), F.col("_own_key") == F.col("_key"), "left")
    return joined.select(*[(text if old == "text" else F.col(new)).alias(old) for old, new in names_of.items()])


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, ALL_KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_spans(docs)
    keys = docs.select("doc_id", text_key(F.col("text")).alias("_key"))
    none = F.array().cast(found.schema["spans"].dataType)
    rows = keys.join(found, F.col("_key") == F.col("key"), "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda n: F.size(F.filter("spans", lambda s: s["base"] & (s["kind_no"] == n))).cast("long")
    return rows.select(
        "doc_id",
        *[count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
