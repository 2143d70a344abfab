"""Secrets that no base rule finds: precision and recall on planted cases."""

import base64
import random

from stratalake.llm import pii

WORDS = "the of and to in is that for it as with his they at be this from".split()


def planted(n=600, seed=3):
    """Documents (id, text), and the spans of their secrets; half of them have no word before that gives them away."""
    rng = random.Random(seed)
    rows, secrets = [], {}
    for i in range(n):
        before, after = " ".join(rng.choices(WORDS, k=12)), " ".join(rng.choices(WORDS, k=9))
        hexed = "".join(rng.choices("0123456789abcdef", k=40))
        coded = base64.urlsafe_b64encode(rng.randbytes(30)).decode()
        form = i % 6
        if form < 4:
            secret = coded if i % 3 == 0 else hexed
            lead = ['token = "', "api_key: ", "", "see "][form]
            text = f"{before} {lead}{secret}{'\"' if form == 0 else ''} {after}"
            secrets[i] = (len(f"{before} {lead}"), len(f"{before} {lead}{secret}"))
        elif form == 4:
            text = f"{before} {''.join(rng.choices('0123456789', k=16 + i % 9))} {after}"
        else:
            text = f"{before} chapter-of-the-long-report-{i % 50} and section_number_{rng.randrange(10**6)} {after}"
        rows.append((i, text))
    return rows, secrets


def test_secrets_are_found_by_their_form(spark):
    rows, secrets = planted()
    # The labels come from what stands before; most secrets must have it for the threshold to be trusted.
    more, _ = planted(seed=4)
    rows += [(10_000 + i, t) for i, t in more if i % 6 not in (2, 3)] + [(20_000 + i, t) for i, t in planted(seed=5)[0] if i % 6 < 2]
    labelled = [(i, t) for i, t in rows if i >= 10_000 or i % 6 not in (2, 3)]
    unlabelled = [(i, t) for i, t in rows if i < 10_000 and i % 6 in (2, 3)][:20]
    frame = spark.createDataFrame(labelled + unlabelled, "doc_id long, text string")
    key_of = {r.doc_id: r.key for r in frame.select("doc_id", pii.text_key(frame.text).alias("key")).collect()}
    spans = {r.key: [(s.start, s.end) for s in r.spans if s.kind_no == pii.SECRET] for r in pii.find_spans(frame).collect()}
    mine = [i for i in key_of if i < 10_000]
    found = {(i, span) for i in mine for span in spans.get(key_of[i], [])}
    wanted = {(i, secrets[i]) for i in mine if i in secrets}
    right = len(found & wanted)
    assert right >= 0.9 * len(wanted) and right >= 0.9 * len(found)
    hidden = {(i, s) for i, s in wanted if i % 6 in (2, 3)}
    assert len(found & hidden) >= 0.9 * len(hidden) > 0


def test_no_secret_without_labels(spark):
    rows, _ = planted(60)
    frame = spark.createDataFrame([(i, t) for i, t in rows if i % 6 > 1], "doc_id long, text string")
    assert not [s for r in pii.find_spans(frame).collect() for s in r.spans if s.kind_no == pii.SECRET]


def test_secrets_are_replaced(spark):
    rows, secrets = planted()
    frame = spark.createDataFrame([(i, t) for i, t in rows if i % 6 not in (2, 3)], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in pii.redact(frame).collect()}
    mine = [i for i in secrets if i % 6 not in (2, 3)]
    assert sum("[SECRET]" in texts[i] for i in mine) >= 0.9 * len(mine)
    assert not any("[SECRET]" in texts[i] for i, _ in rows if i % 6 in (4, 5))
