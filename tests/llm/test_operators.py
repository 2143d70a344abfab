"""The training-data operators against brute force, on rows with nulls, empty and long texts and copies."""

import hashlib
import itertools
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratalake.llm import chat_format, decontaminate, hash_ring, language_id, license_scan, merkle, packing, pii, simhash_golay, warc

LONG = " ".join(f"word{n % 997}x" for n in range(20_000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, shard int, key string, slot string"


def doc_rows():
    texts = [
        None,
        "",
        "   \n\t ",
        "12345 ... !!!",
        LONG,
        "Released under the MIT License. Mail to ann@example.com or +1 (663) 555-6869, from 10.0.0.255.",
        "Licensed under CC BY-NC 4.0; Apache License, Version 2.0",
        "x" * 50_000,
        "the cat sat on the mat and looked at the dog for a long time today",
        "the cat sat on the mat and looked at the dog for a long time today",
        "Der Hund lief über die Straße und bellte die Katze an, weil er sie nicht mochte.",
    ]
    rows = [(n, t, "de" if t and "Hund" in t else "en", None, None, "s", 3, None, "") for n, t in enumerate(texts)]
    # A repeated row, a repeated id with another text, rows without an id.
    return rows + [rows[5], (5, "another text", None, "a", 1, None, None, None, None), (None, "no id", *[None] * 7), (None, None, *[None] * 7)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(doc_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def in_folder(tmp_path):
    """Tables as the queries read them."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


# Sharding


def test_ring_balances_and_numbers_all_rows(spark, docs, no_docs, in_folder):
    folder = in_folder(documents=docs)
    rows = hash_ring.op1_hash_ring(spark, folder).collect()
    texts = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in doc_rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == texts
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    assert max(map(len, by_shard.values())) - min(len(by_shard[s]) for s in range(8)) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert hash_ring.assign(no_docs.select("doc_id"), "doc_id", 8).count() == 0


def test_ring_deals_copies_of_one_row(spark):
    rows = hash_ring.assign(spark.range(1).selectExpr("7 AS k").crossJoin(spark.range(1000)).select("k"), "k", 4)
    counts = {r["shard"]: (r["n"], r["last"]) for r in rows.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last")).collect()}
    assert counts == {s: (250, 249) for s in range(4)}


def walked(keys, n_shards, owned):
    """The shard of each key, walked clockwise from its place one by one; keys stand in their order at a place."""
    places = sorted(owned)
    room = [len(keys) // n_shards + (s < len(keys) % n_shards) for s in range(n_shards)]
    waiting = [(place, n) for place, n in sorted(keys)]
    found = {}
    for distance in range(n_shards):
        still = []
        for place, n in waiting:
            met = []
            for p in [p for p in places if p >= place] + places:
                if owned[p] not in met:
                    met.append(owned[p])
                if len(met) > distance:
                    break
            if room[met[distance]]:
                room[met[distance]] -= 1
                found[place, n] = met[distance]
            else:
                still.append((place, n))
        waiting = still
    assert not waiting
    return found


@pytest.mark.parametrize("rows_per_part", [100_000, 7])
def test_ring_assignment_equals_a_walk(spark, rows_per_part):
    hashed = lambda k: xxhash.xxh64_intdigest(struct.pack("<q", k), seed=42) if k is not None else 42
    keys = [*range(600), *[7] * 90, *[None] * 300]
    rows = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "k long, n long")
    found = hash_ring.assign(rows, "k", 5, rows_per_part=rows_per_part).collect()
    assert sorted(r.n for r in found) == list(range(len(keys)))
    # Which of a place's rows go to a shard is a matter of their ranks; how many go where is not.
    at = defaultdict(list)
    for n, k in enumerate(keys):
        signed = hashed(k) - (1 << 64) if hashed(k) >> 63 else hashed(k)
        at[signed % hash_ring.POSITIONS].append(n)
    expected = Counter()
    for (place, _), shard in walked([(p, n) for p, some in at.items() for n in range(len(some))], 5, hash_ring.owners(5)).items():
        expected[place, shard] += 1
    place_of = {n: p for p, some in at.items() for n in some}
    assert Counter((place_of[r.n], r.shard) for r in found) == expected
    for shard in range(5):
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))


def test_ring_takes_any_column_names(spark):
    names = ["key", "_n", "_copies", "_position", "position", "part", "rank", "copies", "at", "n", "shard", "slot", "a.b"]
    rows = spark.createDataFrame([tuple([k] * len(names)) for k in range(50)], names)
    found = hash_ring.assign(rows, "key", 4)
    assert found.columns == [*[n for n in names if n not in ("shard", "slot")], "shard", "slot"]
    assert sorted(r["_copies"] for r in found.collect()) == list(range(50))


def test_ring_without_headroom_moves_less_than_half():
    counts = {p: random.Random(p).randrange(5) for p in range(0, hash_ring.POSITIONS, 3)}
    shards = lambda n: {(s.position, s.first_rank + i): s.shard for s in hash_ring.plan(counts, n) for i in range(s.n_rows)}
    before, after = shards(8), shards(9)
    assert sum(before[k] != after[k] for k in before) / len(before) < 0.5


def test_ring_moves_few_keys_and_overflow_goes_clockwise():
    counts = {p: random.Random(p).randrange(5) for p in range(0, hash_ring.POSITIONS, 3)}

    def shards(n, headroom):
        return {(s.position, s.first_rank + i): s.shard for s in hash_ring.plan(counts, n, headroom) for i in range(s.n_rows)}

    before, after = shards(8, 0.1), shards(9, 0.1)
    moved = sum(before[k] != after[k] for k in before) / len(before)
    assert len(before) == sum(counts.values()) and moved < 0.3  # a modulo would move 8 in 9
    order = hash_ring.clockwise(hash_ring.owners(8))
    loads, limit = Counter(before.values()), hash_ring.bounds(len(before), 8, 0.1)[0]
    for (place, _), shard in before.items():
        assert all(loads[s] == limit for s in itertools.takewhile(lambda s: s != shard, order[place]))


# Licences


def test_license_scan_equals_a_plain_search(spark, docs, no_docs, in_folder):
    rows = license_scan.op2_license_scan(spark, in_folder(documents=docs)).collect()
    found = {(r.doc_id, r.n_words): r for r in rows}
    assert len(rows) == len(doc_rows())
    mit = found[5, 20]
    assert (mit.n_base, mit.first_word, mit.last_word, mit.base_labels, mit.labels, mit.score) == (1, 1, 1, "mit", "mit", 1.0)
    both = found[6, 12]
    assert (both.n_base, both.first_word, both.last_word, both.base_labels) == (2, 2, 7, "apache-2,cc-by-nc")
    assert found[0, 0].first_word is None and found[0, 0].labels == "" and found[None, 2].score == 0.0
    assert license_scan.scan(no_docs.select("doc_id", "text")).count() == 0


def test_license_words_are_found_wherever_they_stand(spark):
    rng = random.Random(3)
    vocab = sorted({w for t in license_scan.TEMPLATES for w in t.words})
    texts = [" ".join(rng.choices(vocab, k=30)) + " cc by nc " * rng.randrange(3) for _ in range(60)]
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for row in rows:
        words = texts[row.doc_id].split()
        for number, t in enumerate(license_scan.TEMPLATES):
            places = [
                s
                for s in range(-200, len(words))
                if all(s + o >= 0 and words[s + o : s + o + len(p)] == p for o, p in t.phrases)
            ]
            assert sorted(m.first_word for m in row.matches if m.template == number) == places


def test_license_scan_of_whole_licences(spark):
    whole = license_scan.TEMPLATES[-2:]
    cut = " ".join(whole[0].words[40:])  # begins before the text does
    rows = [("mit", whole[0].text), ("isc", f"x {whole[1].text} y"), ("cut", cut), ("other", whole[0].text.replace("warranty", "promise"))]
    frame = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "words string, text string, places int, n_words int")
    found = license_scan.scan(frame)
    assert found.columns == ["words", "text", "places", "n_words", "matches"]
    numbers = {r.words: [(m.template, m.first_word, m.score) for m in r.matches if m.template >= len(license_scan.TEMPLATES) - 2] for r in found.collect()}
    mit, isc = len(license_scan.TEMPLATES) - 2, len(license_scan.TEMPLATES) - 1
    n = len(whole[0].words)
    assert numbers == {"mit": [(mit, 0, 1.0)], "isc": [(isc, 1, 1.0)], "cut": [(mit, -40, (n - 40) / n)], "other": []}


def test_license_scan_does_not_grow_with_the_templates(spark):
    rng = random.Random(4)
    more = [license_scan.Template(f"t{n}", " ".join(f"w{rng.randrange(5000)}" for _ in range(40))) for n in range(500)]
    rows = [(n, " ".join(["a b"] * 50 + more[n].words * (n % 2))) for n in range(200)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    nodes = []
    for templates in (more[:16], more):
        found = license_scan.scan(frame, templates=templates)
        plan = found._jdf.queryExecution().optimizedPlan()
        assert "from_json" not in plan.toString().split("LocalRelation")[0]
        # The constants aside, the plan is the same for any number of templates.
        nodes.append(plan.toString().count("lambdafunction"))
        expected = {n: [(n, 100)] if n % 2 and n < len(templates) else [] for n in range(200)}
        assert {r.doc_id: [(m.template, m.first_word) for m in r.matches] for r in found.collect()} == expected
    assert nodes[0] == nodes[1]


# Languages


def test_languages_of_held_out_texts(spark):
    data = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = language_id.op3_language_id(spark, "/root/testdata/sf0.001").join(data.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.held_out for r in rows} == {zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark, docs, no_docs, in_folder):
    rows = language_id.op3_language_id(spark, in_folder(documents=docs)).collect()
    assert len(rows) == len(doc_rows())
    unknown = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert unknown == {0, 1, 2, 3, None} and {r.lang_pred for r in rows} <= {"en", "de", "und"}
    assert not [r for r in rows if r.doc_id is None and r.held_out]
    nothing = language_id.learn(no_docs)
    assert nothing.languages == [] and language_id.identify(docs, nothing).filter("lang_pred <> 'und'").count() == 0


def test_rare_grams_do_not_fill_the_filters(spark):
    rows = [(f"the cat and the dog {'the ' * 200}", "en")] * 20 + [("qxz", "en")]
    letters = language_id.letter_table()
    docs = spark.createDataFrame(rows, "text string, lang string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(language_id, "LEAST_RATE", 1e-3)
        few = language_id.learn(docs)
    every = language_id.learn(docs)
    assert few.judge(["qxz"], letters) == (["en"], [0.0]) and every.judge(["qxz"], letters)[1][0] > 0.9
    assert few.judge(["the cat"], letters) == every.judge(["the cat"], letters)
    assert (few.false_rate < every.false_rate).all()


def test_gram_counts_do_not_depend_on_the_pieces(monkeypatch):
    letters = language_id.letter_table()
    texts = ["Über  uns, 1 2 3 und mehr!", "", "a", LONG[:3000]]

    def all_grams():
        codes, owner, _ = language_id.normalised(texts, letters)
        return Counter((int(g), int(o)) for found, of in language_id.grams(codes, owner) for g, o in zip(found, of))

    whole = all_grams()
    monkeypatch.setattr(language_id, "CHARACTERS_AT_ONCE", 7)
    assert all_grams() == whole
    plain = Counter()
    for n, text in enumerate(texts):
        clean = " " + re.sub(r"[^a-zäöüß]+", " ", text.lower()).strip() + " "
        clean = re.sub(" +", " ", clean)
        for i in range(len(clean) - 2):
            plain["".join(clean[i : i + 3]), n] += 1
    assert sum(plain.values()) == sum(whole.values())


# Chats


def test_layouts_become_the_same_turns(spark):
    want = [("user", "hi"), ("assistant", "yes")]
    records = [
        '{"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yes"}], "id": 3}',
        '{"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yes"}]}',
        '{"prompt": "hi", "completion": "yes", "meta": {"a": [1]}}',
        '{"instruction": "hi", "input": "", "output": "yes"}',
        '{"question": "hi", "answer": "yes"}',
        '{"data": {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yes"}]}}',
        '{"messages": [{"role": "user", "content": [{"type": "text", "text": "h"}, {"type": "text", "text": "i"}]}, {"role": "assistant", "content": [{"text": "yes"}]}]}',
    ]
    odd = ["{}", "not json", None, '{"messages": []}', '[1, 2]']
    df = spark.createDataFrame(list(enumerate(records + odd)), "id long, record string").withColumn("role", F.lit("other"))
    turns = defaultdict(list)
    for r in chat_format.canonical_turns(df).orderBy("id", "place").collect():
        turns[r.id].append((r.role, r.text))
        assert (r.layout is None) == (r.id >= len(records))
    assert all(turns[n] == want for n in range(len(records)))
    assert all(turns[n] == [(None, None)] for n in range(len(records), len(records) + len(odd)))
    assert chat_format.canonical_turns(df.limit(0)).count() == 0


def test_mixed_layouts_keep_every_text(spark):
    said = [("user", "hi"), ("assistant", "yes")]
    earlier = [("user", "a"), ("assistant", "b")]
    records = [
        ('{"messages": [{"role": "user", "content": [{"text": "h"}, "i"]}, {"role": "assistant", "content": "yes"}]}', said, []),
        ('{"prompt": [{"role": "user", "content": "hi"}], "completion": [{"role": "assistant", "content": "yes"}]}', said, []),
        ('{"prompt": [{"role": "user", "content": "hi"}], "completion": "yes"}', said, []),
        ('{"prompt": "hi", "response": [{"role": "assistant", "content": [{"text": "yes"}]}]}', said, []),
        ('{"instruction": "hi", "output": "yes", "history": [["a", "b"]]}', earlier + said, []),
        ('{"instruction": "hi", "output": "yes", "history": [{"role": "user", "content": "a"}, {"role": "bot", "content": "b"}]}', earlier + said, []),
        ('{"instruction": "hi", "output": "yes", "history": []}', said, []),
        ('{"prompt": "hi", "completion": "yes", "chosen": "no", "n": 1, "empty": ""}', said, ["chosen"]),
        ('{"prompt": "hi", "completion": {"a": ["yes"]}}', [("user", "hi"), ("assistant", "")], ["completion.a[]"]),
        ('{"messages": ["lost", {"role": "user", "content": "hi"}, {"role": "assistant", "content": "yes"}]}', said, ["messages[]"]),
        ('{"messages": [{"role": "user", "content": [{"text": "hi"}, {"url": "u"}]}, {"role": "assistant", "content": "yes"}]}', said, ["messages[].content[].url"]),
        ('{"question": "hi", "answer": 42, "unsure": true}', [("user", "hi"), ("assistant", "42")], []),
        ('{"other": {"x": "y"}}', [(None, None)], ["other.x"]),
        ("not json", [(None, None)], [""]),
    ]
    df = spark.createDataFrame([(n, r[0]) for n, r in enumerate(records)], "id long, record string")
    turns, left = defaultdict(list), {}
    for r in chat_format.canonical_turns(df).orderBy("id", "place").collect():
        turns[r.id].append((r.role, r.text))
        left[r.id] = r.unread
    assert [(turns[n], left[n]) for n in range(len(records))] == [(r[1], r[2]) for r in records]


def test_control_strings_come_back():
    rng = random.Random(1)
    parts = [*chat_format.CONTROL, "\\", "\\l", "<", "[", "é", "\n", "s>", "b"]
    for _ in range(300):
        turns = [("".join(rng.choices(parts, k=2)), "".join(rng.choices(parts, k=rng.randrange(9)))) for _ in range(3)]
        turns += [("assistant", "".join(rng.choices(parts, k=5)))]
        text, mask = chat_format.formatted(turns)
        assert chat_format.parsed_back(text) == turns
        assert "".join(chat_format.unescaped(text[a:b]) for a, b in zip(mask[::2], mask[1::2])) == turns[-1][1]


def test_odd_conversations(spark, in_folder):
    rows = [(1, 0, "user", None), (1, 1, "assistant", LONG), (2, 0, None, "x"), (None, 0, "user", "y"), (3, 5, "assistant", "b"), (3, 5, "assistant", "b")]
    folder = in_folder(conversations=spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit("z")))
    got = {r.conv_id: r for r in chat_format.op4_chat_format(spark, folder).collect()}
    assert set(got) == {1, 2, 3, None, -1}
    assert got[1].turns_sha256 == hashlib.sha256(f"user\n\nassistant\n{LONG}\n".encode()).hexdigest()
    assert (got[1].loss_chars, got[3].n_turns, got[3].loss_chars, got[2].n_turns) == (len(LONG), 2, 2, 1)
    assert got[-1].loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()


def test_long_conversations_are_never_one_row(spark, in_folder):
    rng = random.Random(2)
    parts = [*chat_format.CONTROL, "\\", "é", "word "]
    said = {key: [(rng.choice(["user", "assistant"]), "".join(rng.choices(parts, k=rng.randrange(6)))) for _ in range(5000)] for key in (None, 1)}
    said[2] = [("user", "x")]
    rows = [(key, n, *turn) for key, turns in said.items() for n, turn in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = defaultdict(list)
    for r in chat_format.conversations(df.withColumn("place", F.lit(0)), piece_chars=500).collect():
        got[r.conv_id].append(r)
    assert set(got) == set(said) and len(got[2]) == 1
    for key, turns in said.items():
        text, mask = chat_format.formatted(turns)
        pieces = sorted(got[key], key=lambda r: r.piece)
        assert pieces == got[key] and [r.piece for r in pieces] == list(range(len(pieces)))
        assert "".join(r.formatted for r in pieces) == text and [r.begin + n for r in pieces for n in r.loss_mask] == mask
        assert all(text[r.begin :].startswith(r.formatted) and len(r.formatted) < 1000 for r in pieces)
    result = chat_format.op4_chat_format(spark, in_folder(conversations=df))
    assert "collect_list" not in result._jdf.queryExecution().executedPlan().toString()
    read = {r.conv_id: r for r in result.collect()}
    for key, turns in said.items():
        assert read[key].n_turns == len(turns) and read[key].formatted_chars == len(chat_format.formatted(turns)[0])
        assert read[key].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert read[key].loss_sha256 == hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest()


# Fingerprints


def test_trees_of_odd_rows(spark, docs, no_docs, in_folder):
    rows = merkle.op5_merkle(spark, in_folder(documents=docs)).collect()
    assert len(rows) == len(doc_rows())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by_text = defaultdict(set)
    for r in rows:
        if r.doc_id in (8, 9):
            by_text["same"].add(r.fingerprint)
    assert len(by_text["same"]) == 1
    at = {r.doc_id: r for r in rows if r.doc_id not in (None, 5)}
    assert at[8].near_next == 1.0 and at[8].near_edited < 1
    # The last document is followed by the first, which is empty.
    last = doc_rows()[10][1]
    assert at[10].edited_sha256 == hashlib.sha256(last[: len(last) - len(last) // 4].encode()).hexdigest()
    assert merkle.with_next_text(no_docs).count() == 0


def plain_paragraphs(text):
    """The leaves of each paragraph, with their characters, by loops."""
    found = []
    for line in text.split("\n"):
        parts, part, n = [], "", 0
        for word in re.findall(r"[ \t\r]*[^ \t\r]+|[ \t\r]+", line):
            if not word.strip(" \t\r"):  # behind the last word, blanks are a leaf of their own
                parts, part, n = [*parts, part] if part else parts, "", 0
            part, n = part + word, n + 1
            if n == 8 or hashlib.md5(word.encode()).hexdigest()[-1] in "048c":
                parts, part, n = [*parts, part], "", 0
        parts += [part] if part else []
        found.append([(hashlib.sha256(c.encode()).hexdigest()[:32], len(c)) for c in parts])
    return found


def plain_sections(text):
    parts, part = [], []
    for leaves in plain_paragraphs(text):
        part.append((hashlib.sha256(" ".join(f"{h}:{n}" for h, n in leaves).encode()).hexdigest(), leaves))
        if part[-1][0][-1] == "0":
            parts, part = [*parts, part], []
    parts += [part] if part else []
    return [(hashlib.sha256(" ".join(h for h, _ in p).encode()).hexdigest(), p) for p in parts]


def plain_likeness(a, b):
    def apart(mine, theirs):
        """Those of each side that are left when equal ones are struck out."""
        counts = [Counter(x[0] for x in side) for side in (theirs, mine)]
        left = []
        for side, count in zip((mine, theirs), counts):
            left.append([])
            for x in side:
                if count[x[0]]:
                    count[x[0]] -= 1
                else:
                    left[-1].append(x)
        return left

    if a == b:
        return 1.0
    left = apart(plain_sections(a), plain_sections(b))
    left = apart(*([p for _, part in side for p in part] for side in left))
    left = apart(*([(f"{h}:{n}", n) for _, leaves in side for h, n in leaves] for side in left))
    both = sum(len(t.replace("\n", "")) for t in (a, b))
    return (both - sum(n for side in left for _, n in side)) / both if both else 0.0


def test_tree_locates_edits(spark):
    lines = [f"line {n} of the text. It goes  on, {n} times!" for n in range(200)]
    other = lines[:50] + ["a new line"] + lines[50:120] + ["changed"] + lines[121:]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(other))], "a string, b string")
    row = df.select(
        merkle.changed_paragraphs(F.col("a"), F.col("b")).alias("left"),
        merkle.changed_paragraphs(F.col("b"), F.col("a")).alias("right"),
        merkle.fingerprint(F.col("a")).alias("f"),
    ).first()
    assert (row.left, row.right) == ([120], [50, 121])
    assert row.f == hashlib.sha256(" ".join(h for h, _ in plain_sections("\n".join(lines))).encode()).hexdigest()


def test_a_marked_text_has_the_tree_and_the_letters_of_the_text(spark):
    """Phrases are found once, before texts are dealt: the trees of a text and of the one before it start from them."""
    many = " ".join(f"w{i}" for i in range(300))
    texts = ["", " ", "\n", "\n\n\n", "a b\n\n\nc  d\t\r\n", f"{many}\n{many}  \n", "x" * 5000 + " y\n", "é \U0001d11e\u0085z\x00 b"]
    docs = spark.createDataFrame([*enumerate(texts), (3, "\n \n"), (None, "q r"), (90, None)], "doc_id long, text string")
    docs = docs.unionByName(spark.sql("SELECT 99L AS doc_id, CAST(unhex('61FF620A63C3') AS STRING) AS text"))
    linked = merkle.with_next_text(docs)
    for text, mark in (("text", "marked"), ("next_text", "next_marked")):
        same = merkle.marked_paragraphs(F.col(mark)) == merkle.paragraphs(F.col(text))
        assert linked.filter(~same).isEmpty() and linked.filter(same).count() == 12
    assert linked.select("doc_id", "text").exceptAll(docs.fillna("", ["text"])).isEmpty()
    by_id = {r.doc_id: r.next_text for r in linked.filter("doc_id IN (2, 98, 7)").collect()}
    assert by_id == {2: min(texts[3], "\n \n"), 7: ""}


def test_tree_locates_lost_repeats_and_swaps(spark):
    rows = [
        ("a\nx\nb\nx", "a\nx\nb"),
        ("a\nb\nc\nd", "a\nc\nb\nd"),
        ("a\nb", "a\n\nb"),
        ("a\nb\na\nc\na", "a\nc\na\nb\na"),
        ("a\nb", "a\nb"),
        ("", "a"),
        ("x\n" * 40, "x\n" * 38),
    ]
    df = spark.createDataFrame(rows, "a string, b string").select(merkle.edits(F.col("a"), F.col("b")).alias("e"))
    found = [(r.e.removed, r.e.added, r.e.moved) for r in df.collect()]
    assert found == [([3], [], []), ([], [], [1, 2]), ([], [1], []), ([], [], [1, 3]), ([], [], []), ([0], [0], []), ([38, 39], [], [])]


def test_one_word_changes_little(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(400)]
    rows = [(" ".join(words), " ".join([*words[:at], "new", *words[at:]])) for at in (0, 13, 200, 399, 400)]
    df = merkle.with_trees(spark.createDataFrame(rows, "a string, b string"), {"l": "a", "r": "b"})
    near = merkle.likeness("l", "r", merkle.characters(F.col("a")), merkle.characters(F.col("b")))
    assert min(r.n for r in df.select(near.alias("n")).collect()) >= 0.95


def test_likeness_is_that_of_a_plain_descent(spark):
    rng = random.Random(8)
    rows = [("a b c d " * 30, "a b c d " * 10), ("one.\ntwo. three", "two. three\none."), ("", ""), ("", "x"), ("u v w x y", "u v w x z")]
    rows += [("same " * 100, "same " * 99), ("\n\n", "\n"), (" \t", "\t "), (LONG, LONG[:-40] + "\nend")]
    for _ in range(60):
        lines = [" ".join(rng.choices("abcdefgh", k=rng.randrange(9))) for _ in range(rng.randrange(1, 60))]
        others = [line if rng.random() < 0.8 else line + " z" for line in lines if rng.random() < 0.9]
        if rng.random() < 0.5:
            rng.shuffle(others)
        rows.append(("\n".join(lines), "\n".join(others)))
    df = merkle.with_trees(spark.createDataFrame(rows, "a string, b string"), {"l": "a", "r": "b"})
    near = merkle.likeness("l", "r", merkle.characters(F.col("a")), merkle.characters(F.col("b")))
    assert [r.n for r in df.select(near.alias("n")).collect()] == pytest.approx([plain_likeness(*r) for r in rows])
    changed = df.select(merkle.edits(F.col("a"), F.col("b")).alias("e"), (F.col("l_root") == F.col("r_root")).alias("same")).collect()
    assert all(r.same == (not any(r.e)) for r in changed)


# Archives


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    big = "é<p>\r\n\r\nWARC/1.1\r\n" * 9000
    rows = [(1, "http://a/\r\nX: y", big), (2, None, big), (7, "u", big), (7, "u", big), (3, "u", "x"), (4, "u", "x"), (5, "u", None), (None, "u", big), (None, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(rows) and not [r for r in got if r.problem]
    payload = Counter(bytes(r.payload) for r in got if r.payload is not None)
    assert payload == Counter([big.encode()] * 2 + [b"x", b"x", b"", b""])
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in got)
    assert kinds == Counter([(1, "revisit", 7), (2, "revisit", 7), (None, "revisit", 7), (7, "response", None), (7, "response", None),
                             (3, "response", None), (4, "response", None), (5, "response", None), (None, "response", None)])
    assert {(r.payload_bytes, r.payload_digest) for r in got if r.page_id == 1} == {(len(big.encode()), hashlib.sha1(big.encode()).hexdigest())}
    warc.write_archives(pages.limit(0), path + "0")
    assert warc.read_archives(spark, path + "0").count() == 0


def test_segments_are_checked():
    page = {"page_id": 1, "url": "u", "html": "z" * 100_000, "record_type": "response", "payload_digest": hashlib.sha1(b"z" * 100_000).hexdigest(), "refers_to": None}
    records = [r for raw in warc.records_of(page, "<urn:1>") for r in warc.parse_archive(raw + b"\r\n\r\n")]
    assert len(records) == 4 and {r["origin_id"] for r in records} == {"<urn:1>"}
    assert warc.page_of(records[::-1])["problem"] is None and len(warc.page_of(records)["payload"]) == 100_000
    assert warc.page_of(records[:-1])["problem"] == warc.page_of([records[0], *records[2:]])["problem"] == "segments missing"
    short = [*records[:-1], records[-1] | {"block": b""}]
    assert warc.page_of(short)["problem"] == "total length"


# Decontamination


def test_masks_lose_no_window():
    for n in range(decontaminate.WINDOW - decontaminate.LEAST_EQUAL + 1):
        for wrong in itertools.combinations(range(decontaminate.WINDOW), n):
            assert any(
                all(c == "0" or start + i not in wrong for i, c in enumerate(mask))
                for mask in decontaminate.MASKS
                for start in range(decontaminate.WINDOW - len(mask) + 1)
            )


def brute_leaks(docs, items):
    split = lambda text: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = set()
    for doc_id, text in docs:
        words = split(text)
        for item_id, item in items:
            item = split(item)
            window = min(len(item), decontaminate.WINDOW)
            needed = len(item) if len(item) < decontaminate.WINDOW else decontaminate.LEAST_EQUAL
            for line in range(-len(item), len(words)) if len(item) >= decontaminate.FEWEST_WORDS else []:
                span = [k for k in range(len(item)) if 0 <= line + k < len(words)]
                equal = [words[line + k] == item[k] for k in span]
                if any(sum(equal[i : i + window]) >= needed for i in range(len(equal) - window + 1)):
                    found.add((doc_id, item_id, max(line, 0), len(span), sum(equal)))
    return found


@pytest.mark.parametrize("seeds_at_once", [1_000_000, 50])
def test_leaks_equal_brute_force(spark, docs, seeds_at_once):
    rng = random.Random(4)
    vocab = [f"w{n}" for n in range(40)] + ["Über", "A", "b"]
    items = [(n, " ".join(rng.choices(vocab, k=rng.choice([3, 6, 12, 13, 14, 25, 40])))) for n in range(25)]
    items += [(90, None), (91, ""), (92, "b b b b b b b b b b b b b b b"), (92, "b b b b b b b b b b b b b b b")]
    texts = [(n, t) for n, t in enumerate([None, "", "b " * 60, LONG])]
    for n in range(80):
        words = rng.choice(items[:25])[1].split()
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        cut = rng.randrange(len(words)) if rng.random() < 0.3 else 0
        texts.append((100 + n, " ".join(rng.choices(vocab, k=rng.randrange(20)) + words[cut:] + rng.choices(vocab, k=rng.randrange(20)))))
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("_seed", F.lit(1))
    rows = decontaminate.find_leaks(frame, bench, seeds_at_once=seeds_at_once).collect()
    got = {(r.doc_id, r.item_id, r.first_word, r.n_words, r.n_equal) for r in rows}
    assert got == brute_leaks(texts, items) and len(rows) == len(got) > 60
    if seeds_at_once > 50:
        assert decontaminate.find_leaks(frame, bench.limit(0)).count() == decontaminate.find_leaks(frame.limit(0), bench).count() == 0


def test_short_masks_lose_no_substitution():
    for rule in (decontaminate.BY_WORDS, decontaminate.BY_CHARACTERS):
        for n in range(decontaminate.FEWEST_WORDS, 27):
            masks = decontaminate._masks([n], rule)
            masks = [m for m in masks if len(m) == n] if n < decontaminate.WINDOW else list(decontaminate.MASKS)
            few = rule.substitutions(n) if n < rule.window else rule.window - rule.least_equal
            for wrong in itertools.combinations(range(n), few) if n < rule.window else []:
                places = [(m, start) for m in masks for start in range(n - len(m) + 1)]
                assert any(all(c == "0" or start + i not in wrong for i, c in enumerate(m)) for m, start in places)


@pytest.mark.parametrize("seeds_at_once", [1_000_000, 200])
def test_short_items_with_a_substitution_and_tiny_items(spark, seeds_at_once):
    rng = random.Random(5)
    items = [(n, " ".join(f"w{rng.randrange(1000)}" for _ in range(n))) for n in range(1, 16)]
    docs, want = [], set()
    for n, item in items:
        for at in range(n):
            for changed in (1, 2):
                words = item.split()
                words[at] = "other"
                words[(at + changed - 1) % n] = "other"
                docs.append((len(docs), f"before {' '.join(words)} after"))
                wrong = words.count("other")
                if wrong <= (2 if n >= 13 else 1 if n >= 7 else 0):
                    want.add((docs[-1][0], n))
        docs += [(len(docs), f"Before {item} after"), (len(docs) + 1, item.upper())]
        want |= {(docs[-2][0], n)} if n >= 5 else set()
        want |= {(docs[-1][0], n)}
    frame = spark.createDataFrame([*docs, (-1, None), (-2, "")], "doc_id long, text string")
    bench = spark.createDataFrame([*items, (90, None), (91, "?")], "item_id long, text string")
    rows = decontaminate.all_leaks(frame, bench, seeds_at_once=seeds_at_once).collect()
    # Long items overlap their neighbours by parts; no other item stands in a text of another.
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)


def test_items_without_spaces_are_found(spark, in_folder):
    chinese, thai, japanese = "植物为什么需要阳光和水才能生长", "ทำไมท้องฟ้าจึงเป็นสีฟ้าในเวลากลางวัน", "日本の首都はどこですか"
    mixed, tiny, far = "GDP是什么的缩写", "東京", "𠮷野家の牛丼は何円ですか"
    long = "".join(chr(0x4E00 + (7 * n * n + 13 * n) % 5000) for n in range(120))
    items = [(1, chinese + "？"), (2, thai), (3, japanese), (4, mixed), (5, tiny), (6, far), (7, long)]
    docs = [
        (1, f"昨天老师问：{chinese}。没有人回答。"),
        (2, f"คำถาม{thai}คำตอบ"),
        (3, f"問題：{japanese.replace('首', '主')}？"),
        (4, f"请问,{mixed}"),
        (5, "東京。"),
        (6, f"x {far}"),
        (7, "前文" + long[30:90] + "后文"),
        (11, "今天天气很好，我们去公园散步吧。"),
        (12, f"{tiny}へ行きました"),
        (13, f"問題：{japanese.replace('首都', '主人')}？"),
        (14, "no such script"),
        (15, None),
        (16, f"x {far.replace('𠮷', '𠀋')[:4]}"),
    ]
    folder = in_folder(
        documents=spark.createDataFrame(docs, "doc_id long, text string"), benchmark=spark.createDataFrame(items, "item_id long, text string")
    )
    found = decontaminate.op7_decontaminate(spark, folder).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(n, n) for n in range(1, 8)}
    assert {r.n_equal for r in found if r.doc_id == 3} == {len(japanese) - 1}


# Packing


def test_plan_places_everything_once():
    rng = random.Random(5)
    for capacity in (16, 100):
        for _ in range(30):
            counts = {rng.randint(1, capacity): rng.randrange(1, 50) for _ in range(rng.randrange(1, 12))}
            tokens = defaultdict(list)
            ranks = Counter()
            for s in packing.best_fit(counts, capacity):
                assert s.first_rank == ranks[s.length]
                ranks[s.length] += s.n
                for i in range(s.n):
                    tokens[s.first_sequence + i // s.per_sequence].append((s.offset + i % s.per_sequence * s.length, s.length))
            assert ranks == counts
            for parts in tokens.values():
                ends = list(itertools.accumulate(n for _, n in sorted(parts)))
                assert [at for at, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= capacity
            rooms = []  # best fit, one by one
            for length in sorted(Counter(counts).elements(), reverse=True):
                fitting = [r for r in rooms if r >= length]
                if fitting:
                    rooms.remove(min(fitting))
                rooms.append((min(fitting) if fitting else capacity) - length)
            assert len(tokens) == len(rooms)


def test_packing_of_odd_rows(spark, docs, no_docs, in_folder):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.public_tokenizer())
    rows = packing.packed(packing.pieces(docs))
    places = rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids").collect()
    joined = defaultdict(list)
    for r in places:
        joined[r.sequence_id].append((r.offset, r.length))
    for parts in joined.values():
        ends = list(itertools.accumulate(n for _, n in sorted(parts)))
        assert [at for at, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024
    want = Counter()
    for doc_id, text, *_ in doc_rows():
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        ends = range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)
        for piece, end in enumerate(ends):
            part = ids[max(0, end - 1024) : end]
            want[doc_id, piece, max(0, end - 1024), len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in places) == want
    whole = packing.sequences(rows).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(k[3] * n for k, n in want.items())
    assert packing.pack_documents(no_docs).count() == 0


def test_faster_library_has_the_same_ids(spark):
    import json

    encoders = packing._encoders(packing.public_tokenizer())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += ["<|endoftext|> a", "‍🙂 naïve\r\n\t x  y", json.dumps({"ü": "\x00"}), "  ", "don't I'LL"]
    for text in texts:
        assert packing.token_ids(text, encoders)[:-1].tolist() == encoders[0].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("gap", [" " * 2_000_000, "\n" * 1_000_829, "\n " * 2_000_000, " " * 100_000, "\u3000" * 1_000_829])
def test_long_gaps_have_the_ids_of_the_tokenizer(gap):
    encoders = packing._encoders(packing.public_tokenizer())
    text = f"before{gap}after"
    assert packing.token_ids(text, encoders)[:-1].tolist() == encoders[0].encode(text, add_special_tokens=False).ids


def test_a_document_with_a_long_gap_is_packed(spark):
    rows = packing.pack_documents(spark.createDataFrame([(1, " " * 2_000_000), (2, "short")], "doc_id long, text string")).collect()
    tokens = Counter()
    for r in rows:
        tokens[r.doc_id] += r.length
    assert tokens[1] == 2_000_001 and tokens[2] < 10 and all(r.length <= packing.CAPACITY for r in rows)


# Personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = [int(c) for c in re.sub("[^0-9]", "", text)]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [d if n % 2 == 0 else 2 * d - 9 * (d > 4) for n, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def base_spans(text):
    # Long runs without the mark that a pattern needs would take the plain pattern quadratic time.
    needs = {"email": "@", "ip": ".", "card": "", "phone": "+"}
    tried = {kind: p for kind, p in PLAIN.items() if needs[kind] in (text or "")}
    return [f"{kind}:{m.start()}:{m.end()}" for kind, p in tried.items() for m in re.finditer(p, text or "") if passes(kind, m[0])]


def test_base_spans_equal_the_plain_patterns(spark, docs, in_folder):
    rng = random.Random(6)
    alphabet = list("0123456789") * 3 + list(" -.+()@ab%_,é🙂\n")
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(400)]
    texts += ["a@b.co_x@y.zz", "é a.b@c.de, 🙂x@y.z.w", "1.2.3.4.5.6.7.8", "4012-8888-8888-1881", "+1 (663) 555-6869", "1 " * 9000, "a" * 200_000, "1" * 100_000]
    frame = spark.createDataFrame(list(enumerate(texts, 1000)), "doc_id long, text string")
    odd = docs.select("doc_id", "text")
    rows = pii.op9_pii(spark, in_folder(documents=frame.unionByName(odd))).collect()
    want = Counter()
    for doc_id, text in [*enumerate(texts, 1000), *[r[:2] for r in doc_rows()]]:
        base = base_spans(text)
        kinds = Counter(s.split(":")[0] for s in base)
        want[doc_id, *[kinds[k] for k in pii.KINDS], hashlib.sha256(",".join(base).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == want
    by_id = dict(enumerate(texts, 1000))
    for r in rows:
        if r.doc_id in by_id:
            listed = r.spans.split(",") if r.spans else []
            assert set(base_spans(by_id[r.doc_id])) <= set(listed)
            assert listed == sorted(listed, key=lambda s: (pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1]), int(s.split(":")[2])))


def test_card_with_a_wrong_digit_is_added(spark):
    rng = random.Random(7)

    def card(valid):
        digits = "".join(rng.choices("0123456789", k=15))
        ends = [d for d in "0123456789" if passes("card", digits + d) == valid]
        return digits + ends[0]

    texts = [f"pay with {card(True)} today and {rng.randrange(10**6)} more" for _ in range(400)] + [f"pay with {card(False)} today" for _ in range(5)]
    texts += [f"serial{card(False)}x of the part" for _ in range(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.key: r.spans for r in pii.find_spans(frame).collect()}
    key = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert all([(s.start, s.end) for s in spans.get(key(t), [])] == [(9, 25)] for t in texts[:405])
    assert not any(key(t) in spans for t in texts[405:])


def test_redaction(spark, docs, no_docs):
    got = {(r.doc_id, r.text) for r in pii.redact(docs).collect()}
    assert (5, "Released under the MIT License. Mail to [EMAIL] or [PHONE], from [IP].") in got and (0, None) in got
    assert pii.redact(docs).columns == docs.columns and pii.redact(no_docs).count() == 0


# SimHash


def plain_fingerprint(text, size=3):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """Smallest id of each row's component, by trying all pairs."""
    ids = {}
    for n in sorted(range(len(fps)), key=lambda n: (fps[n][0] is None, fps[n][0])):
        if n in ids:
            continue
        reached = [n]
        ids[n] = fps[n][0]
        while reached:
            here = reached.pop()
            for m in range(len(fps)):
                if m not in ids and (fps[m][1] ^ fps[here][1]).bit_count() <= 3:
                    ids[m] = fps[n][0]
                    reached.append(m)
    return [ids[n] for n in range(len(fps))]


def test_components_of_odd_rows(spark, docs, no_docs, in_folder):
    rows = simhash_golay.op10_simhash(spark, in_folder(documents=docs)).collect()
    fps = [(r[0], plain_fingerprint(r[1])) for r in doc_rows()]
    want = Counter((i, f"{fp:016x}", c) for (i, fp), c in zip(fps, plain_components(fps)))
    assert Counter(tuple(r) for r in rows) == want
    assert simhash_golay.near_duplicates(no_docs).count() == 0


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def near_fingerprints(n, seed=8):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 10)]
    found = {c ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(5))}) for c in centres for _ in range(10)}
    return [(i, fp) for i, fp in enumerate(sorted(found))]


@pytest.mark.parametrize("large", [50_000, 3])
def test_links_connect_what_is_within_three_bits(spark, large):
    fps = near_fingerprints(600)
    frame = spark.createDataFrame([(signed(fp),) for _, fp in fps], "fp long")
    roots = {r.node: r.root for r in simhash_golay.components(simhash_golay.links(frame, large=large)).collect()}
    groups = defaultdict(set)
    for (_, fp), component in zip(fps, plain_components(fps)):
        groups[component].add(roots.get(signed(fp), signed(fp)))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set().union(*groups.values()))


def test_every_pair_within_three_bits_shares_a_key():
    rng = random.Random(9)
    table = simhash_golay.error_table()
    left = [rng.getrandbits(64) for _ in range(2000)]
    right = [x ^ sum({1 << rng.randrange(64) for _ in range(3)}) for x in left]
    keys = []
    for side in (left, right):
        own = defaultdict(set)
        for row, key in zip(*simhash_golay.keys_of(np.array([signed(x) for x in side]), table)):
            own[int(row)].add(int(key))
        keys.append(own)
    assert all(keys[0][n] & keys[1][n] for n in range(2000))


def test_golay_decoding_is_perfect():
    table = simhash_golay.error_table()
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 23, 5000)
    index = simhash_golay.decode(words, table)
    codewords = np.array([w ^ e for w, e in zip(words, table[simhash_golay._remainder(words)])])
    assert (simhash_golay._remainder(codewords) == 0).all() and (np.bitwise_count(words ^ codewords) <= 3).all()
    assert len(set(table.tolist())) == 2048 and (index < 4096).all()


def test_long_chains_are_one_component(spark):
    edges = [(n, n + 1) for n in range(300)] + [(1000, 1001), (1002, 1001)]
    roots = simhash_golay.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.root for r in roots if r.node <= 300} == {0} and {r.root for r in roots if r.node > 300} == {1000}
