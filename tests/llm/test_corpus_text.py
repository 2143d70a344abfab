"""Collocations, repeated passages and spelling variants against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from stratalake.llm import collocations, run_length, variants

# Extra columns with names that the operators use themselves, in other types.
DOCS = "doc_id long, text string, lang string, key string, n string, word string, tie string, start string, phrase string, root int"


def table(spark, rows):
    return spark.createDataFrame([(*row, *[None] * 7) for row in rows], DOCS).repartition(3)


# Collocations


def phrase_rows():
    rng = random.Random(5)
    words = ["new", "york", "city", "Über", "a b", "the", "x\x00y", "of", "Great"]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".", "\n", "\t"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    rows = [(n, t, rng.choice(["en", "de", None])) for n, t in enumerate(texts)]
    rows += [(100, None, "en"), (101, "", "en"), (None, " . ,\t", None), (102, "new york " * 3000, "en"), (None, "und only", "und")]
    return rows + [rows[3], rows[3]]


def counted_phrases(rows):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\x0b\x0c\r":
            lowered = lowered.replace(c, "\n")
        for piece in lowered.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            sizes[lang or "und"] += len(words)
            for k in range(1, 5):
                for at in range(len(words) - k + 1):
                    counts[lang or "und"][tuple(words[at : at + k])] += 1
    return counts, sizes


def best_phrases(rows, least, most, percent=80):
    counts, sizes = counted_phrases(rows)
    out = set()
    for lang, f in counts.items():
        scored = []
        for phrase, a in f.items():
            if len(phrase) > 1 and a >= least:
                cuts = [(2_000_000 * a // (f[phrase[:k]] + f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]]) for k in range(1, len(phrase))]
                inside = any(
                    n >= least and len(other) > len(phrase) and 100 * n >= percent * a
                    and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
                    for other, n in f.items()
                )
                if not inside:
                    score, _, left, right = min(cuts)
                    scored.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return out


@pytest.mark.parametrize("most", [7, 2000])
def test_collocations_are_those_of_a_full_count(spark, rows_of, most):
    rows = phrase_rows()
    found = rows_of(collocations.collocations(table(spark, rows), least_times=4, most=most))
    assert set(found) == best_phrases(rows, 4, most) and len(found) == len(set(found))


def test_collocations_with_bursts_spills_and_parts(spark, rows_of, monkeypatch):
    """Small limits: containers burst, subtrees are spilled, ids are forgotten, and long texts are cut."""
    for name, value in {"BURST": 3, "ENTRIES_IN_TASK": 20, "IDS_IN_TASK": 5, "BUFFERED_WORDS": 50, "TOKENS_AT_ONCE": 17}.items():
        monkeypatch.setattr(collocations, name, value)
    counts, sizes = counted_phrases(phrase_rows())
    for pairs, fewest, most in [(None, 1, 2), (np.full(collocations.FILTER_BITS // 8, 255, dtype=np.uint8), 3, 4)]:
        counter, found = collocations.Counter(fewest, most, pairs), Counter()
        batches = [b for _, t, lang in phrase_rows() if t for b in counter.text(lang or "und", t)] + list(counter.flush(True))
        for batch in batches:
            for row in batch.to_pylist():
                found[row["lang"], row["phrase"]] += row["n"]
        assert found == {(lang, " ".join(p)): n for lang, f in counts.items() for p, n in f.items() if fewest <= len(p) <= most}
        assert counter.words == {lang: n for lang, n in sizes.items() if lang in counter.langs}


def test_collocations_of_nothing(spark):
    assert collocations.collocations(table(spark, [])).count() == 0
    assert collocations.collocations(table(spark, [(1, None, None), (2, "", "en")])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark, rows_of):
    n = 2**62
    counts = spark.createDataFrame([("en", "a", n), ("en", "b", n), ("en", "a b", n - 1)], "lang string, phrase string, n long")
    assert rows_of(collocations.scored(counts)) == [("en", "a b", n - 1, n, n, 999_999)]


# Repeated passages


def passage_rows():
    rng = random.Random(11)
    passage = "".join(rng.choice("abcdé ") for _ in range(400))
    fresh = lambda n: "".join(rng.choice("abcdefgh ß") for _ in range(n))
    long = fresh(9_000)
    rows = [
        (7, fresh(50) + passage + fresh(30)),
        (3, passage[:250] + fresh(20)),
        (9, fresh(10) + passage[100:199] + fresh(10)),  # a byte or so short, by characters
        (12, "z" * 5_000),
        (13, "zy" * 2_000 + "z" * 150),
        (20, None),
        (21, ""),
        (22, "short"),
        (23, "short"),
        (30, long + passage + long[2_000:4_000]),
        (31, long),
        (None, long[:500]),
        (None, long[:500] + "!"),
        (41, fresh(300)),
        (41, passage + fresh(5)),
    ]
    return [(*row, "en") for row in rows + [rows[0], rows[0], rows[7]] + [(100 + i, fresh(40) + passage[50:330] + fresh(40)) for i in range(40)]]


def removed(rows, tie_of):
    """Rows (doc_id, n_bytes, spans, kept) by looking up every string."""
    in_order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, tie_of[r[1] or ""]))
    seen, out = set(), []
    for doc_id, text, _ in in_order:
        data = (text or "").encode()
        cut = bytearray(len(data))
        for at in range(len(data) - 99):
            string = data[at : at + 100]
            if string in seen:
                cut[at : at + 100] = b"\1" * 100
            seen.add(string)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(cut), dtype=np.uint8), [0]]).astype(int)))
        spans = tuple((int(a), int(b)) for a, b in edges.reshape(-1, 2))
        out.append((doc_id, len(data), spans, bytes(x for x, c in zip(data, cut) if not c)))
    return out


@pytest.mark.parametrize("largest, chunk, bucket", [(10_000, 1 << 20, 1 << 20), (2, 1_000, 300)])
def test_repeats_are_those_of_a_lookup(spark, rows_of, monkeypatch, largest, chunk, bucket):
    """With small limits long texts are read in parts, and keys are divided to the end."""
    monkeypatch.setattr(run_length, "CHUNK", chunk)
    monkeypatch.setattr(run_length, "BUCKET_BYTES", bucket)
    rows = passage_rows()
    docs = table(spark, rows)
    tie_of = {r["text"]: r["tie"] for r in run_length.placed(docs).collect()}
    kept = run_length.without_repeats(docs, largest)
    found = sorted(((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in kept.collect()), key=repr)
    assert found == sorted(removed(rows, tie_of), key=repr)


def test_repeats_of_nothing(spark):
    assert run_length.without_repeats(table(spark, [])).count() == 0


def test_index_keeps_a_sample_for_each_run():
    piece = bytes(random.Random(2).choice(b"acgt") for _ in range(500))
    text = np.frombuffer(b"\xff".join([piece] * 20 + [b""]), dtype=np.uint8)
    index = run_length.RunLengthIndex(text)
    assert len(index.places) < len(text) / 10
    neighbours, shared = index.matches()
    order = run_length.suffix_array(text)
    for before, place in zip(order[:200], order[1:201]):
        assert neighbours[place] == before
        n = int(shared[place])
        assert bytes(text[place : place + n]) == bytes(text[before : before + n])
        assert bytes(text[place : place + n + 1]) != bytes(text[before : before + n + 1])


# Spelling variants


def variant_rows():
    rng = random.Random(8)
    stems = ["recieve", "receive", "recceive", "Éclair", "éclairs", "banana", "bananas", "bananà", "bananasx", "abcdefghij", "short", "aaaaaa", "aaaaaaa"]
    weights = [1, 30, 2, 3, 20, 40, 7, 1, 1, 5, 9, 6, 30]
    texts = [" ".join(rng.choices(stems, weights, k=rng.randint(0, 90))) for _ in range(150)]
    rows = [(n, t, "en") for n, t in enumerate(texts)]
    rows += [(None, "banana1banana", None), (900, None, "en"), (901, "", "en"), (902, "q" * 40_000, None), (903, "banana-" * 500, None)]
    return rows + [rows[1], rows[1]]


def near(a, b):
    short, long = sorted((a, b), key=len)
    if len(long) == len(short):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(rows):
    counts = Counter()
    for doc_id, text, _ in rows:
        for run in variants.RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    best = {w: sorted((-n[x], x) for x in n if near(w, x)) for w in n}
    form = {w: b[0][1] for w, b in best.items() if b and -b[0][0] >= 5 * n[w]}
    root = dict.fromkeys(n)
    for w in n:
        last = w
        while last in form:
            last = form[last]
        root[w] = last
    return [(w, form.get(w), root[w], n[w], len(best[w]), n[form[w]] if w in form else None) for w in n]


def test_variants_are_those_of_all_pairs(spark, rows_of):
    rows = variant_rows()
    assert rows_of(variants.variants(table(spark, rows))) == brute_variants(rows)


def test_variants_of_nothing(spark):
    assert variants.variants(table(spark, [])).count() == 0


@pytest.mark.parametrize("largest", [2, 500])
def test_near_words_in_groups_of_any_size(spark, rows_of, largest):
    """With small groups the middles are halved to the last letter."""
    rng = random.Random(4)
    words = {"".join(rng.choices("abc", k=rng.randint(6, 9))) for _ in range(300)} | {"c" * 300, "c" * 301}
    n = {w: rng.randint(5, 9) for w in words}
    found = rows_of(variants.near_words(spark.createDataFrame(list(n.items()), "word string, n long"), largest))
    wanted = {w: sorted((-n[x], x) for x in n if near(w, x)) for w in n}
    assert found == [(w, len(b), -b[0][0], b[0][1]) for w, b in wanted.items() if b]
