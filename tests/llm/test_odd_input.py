"""Records that other tools wrote, or that are cut, missing or nested too deeply."""

import hashlib
import json

import pytest

from stratalake.llm import chat_format, warc


def record(kind, block, **fields):
    lines = ["WARC/1.1", f"WARC-Type:{kind}", *[f"{k}: {v}" for k, v in fields.items()], f"content-length:  {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def only(data):
    (found,) = warc.parse_archive(data)
    return warc.page_of([found])


def test_foreign_records_are_read():
    http = b"HTTP/1.1 200 OK\r\nContent-Type:text/html\r\n\r\n<p>plain</p>"
    data = record("warcinfo", b"software: x") + record("response", http, **{"Page-ID": 7}) + record("request", b"GET /")
    page = only(data)
    assert (page["page_id"], page["payload"], page["problem"]) == (7, b"<p>plain</p>", None)
    assert page["payload_digest"] == hashlib.sha1(b"<p>plain</p>").hexdigest()


@pytest.mark.parametrize(
    "body, payload",
    [(b"3\r\nabc\r\n0\r\n\r\n", b"abc"), (b"9\r\nabc", None), (b"xyz\r\nabc", None), (b"", None), (b"-3\r\nabc", None), (b"3\r\nabc\r\n", None)],
)
def test_chunks_that_do_not_fit_are_a_problem(body, payload):
    page = only(record("response", b"HTTP/1.1 200 OK\r\ntransfer-encoding:Chunked\r\n\r\n" + body))
    assert page["payload"] == payload and page["problem"] == (None if payload else "framing")
    assert (page["payload_bytes"] is None) == (payload is None) and (page["payload_digest"] is None) == (payload is None)


def test_what_a_record_says_does_not_stand_in_for_what_was_read():
    http = b"HTTP/1.1 200 OK\r\n\r\nabc"
    wrong = only(record("response", http, **{"WARC-Payload-Digest": "sha1:" + "0" * 40, "Payload-Length": 99}))
    assert wrong["problem"] == "digest" and wrong["payload_bytes"] == 3
    base32 = only(record("response", http, **{"WARC-Payload-Digest": "sha1:VGMT4NSHA2AWVOR6EVYXQUGCNSONBWE5"}))
    assert base32["problem"] is None
    assert only(record("response", b"no header"))["problem"] == "framing"
    assert list(warc.parse_archive(b"WARC/1.1\r\nWARC-Type: response\r\n\r\nrest")) == []


def test_pages_without_a_segment_are_no_good_responses():
    page = {"page_id": 5, "url": "http://x", "html": "y" * 100_000, "record_type": "response", "refers_to": None, "payload_digest": hashlib.sha1(b"y" * 100_000).hexdigest()}
    records = [r for raw in warc.records_of(page, "<urn:1>") for r in warc.parse_archive(raw + b"\r\n\r\n")]
    assert len(records) > 2 and warc.page_of(records)["payload_bytes"] == 100_000
    for some in (records[:-1], records[1:], [records[0], *records[2:]]):
        found = warc.page_of(some)
        assert found["problem"] == "segments missing" and found["payload_digest"] is None and found["payload_bytes"] is None


def test_records_that_cannot_be_turns_are_unread(spark):
    deep = "[" * 20_000 + '"x"' + "]" * 20_000
    nested = '{"a":' * 900 + '"x"' + "}" * 900
    half = '{"prompt": "\\ud800", "completion": "b"}'
    whole = json.dumps({"prompt": "\U0001f600", "completion": "b"})
    frame = spark.createDataFrame(list(enumerate([deep, half, whole, nested, "{", None])), "id int, record string")
    rows = chat_format.canonical_turns(frame).collect()
    by_id = {i: [r for r in rows if r.id == i] for i in range(6)}
    assert [r.text for r in by_id[2]] == ["\U0001f600", "b"] and by_id[2][0].layout
    for i in (0, 1, 4):
        assert [(r.layout, r.text, r.unread) for r in by_id[i]] == [(None, None, [""])]
    assert by_id[3][0].layout is None and by_id[3][0].unread and by_id[5][0].layout is None
