import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stratalake.functions.dates import boundaries_between, business_days
from stratalake.functions.numbers import haversine_distance, safe_add, safe_divide, safe_subtract, width_bucket
from stratalake.functions.text import slugify, slugify_name, surrogate_key
from stratalake.functions.urls import url_host, url_parameter, url_path


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def day(text):
    return dt.date.fromisoformat(text) if text else None


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2024-01-03", "2024-01-03", 1),
        ("2024-01-05", "2024-01-08", 2),
        ("2024-01-06", "2024-01-07", 0),
        ("2024-01-07", "2024-01-06", None),
        (None, "2024-01-06", None),
        ("2024-01-06", None, None),
    ],
)
def test_business_days_cases(table, start, end, expected):
    df = table("s date, e date", (day(start), day(end)))
    assert values(df, business_days(F.col("s"), F.col("e"))) == [expected]


def test_business_days_equals_counting_every_day(table):
    rng = random.Random(7)
    pairs = []
    for _ in range(400):
        start = dt.date(1950, 1, 1) + dt.timedelta(rng.randrange(30_000))
        pairs.append((start, start + dt.timedelta(rng.randrange(-5, 900))))
    expected = [
        sum((s + dt.timedelta(i)).weekday() < 5 for i in range((e - s).days + 1)) if e >= s else None
        for s, e in pairs
    ]
    df = table("s date, e date", *pairs).coalesce(1)
    assert values(df, business_days(F.col("s"), F.col("e"))) == expected


@pytest.mark.parametrize(
    "part, start, end, expected",
    [
        ("day", "2018-01-01", "2018-01-10", 9),
        ("month", "2024-01-15", "2024-03-01", 2),
        ("year", "2023-12-31", "2024-01-01", 1),
        ("quarter", "2024-03-31", "2024-04-01", 1),
        ("week", "2024-01-06", "2024-01-07", 1),
        ("week", "2024-01-07", "2024-01-13", 0),
        ("hour", "2024-01-01", "2024-01-02", 24),
    ],
)
def test_boundaries_between(table, part, start, end, expected):
    df = table("s date, e date", (day(start), day(end)))
    assert values(df, boundaries_between(part, F.col("s"), F.col("e"))) == [expected]


def test_unknown_date_part(spark):
    with pytest.raises(ValueError):
        boundaries_between("fortnight", F.lit(1), F.lit(2))


def test_safe_arithmetic(table):
    add = table("a int, b int, c int", (1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)).coalesce(1)
    assert values(add, safe_add(["a", "b", "c"])) == [6, 4, 2, 0]
    sub = table("a int, b int, c int", (3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)).coalesce(1)
    assert values(sub, safe_subtract(["a", "b", "c"])) == [0, 1, -2, 0]
    for wrong in ("a", F.col("a"), []):
        with pytest.raises(TypeError):
            safe_subtract(wrong)


def test_safe_divide(table):
    pairs = [(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5)]
    df = table("n int, d int", *pairs).coalesce(1)
    assert values(df, safe_divide("n", "d")) == [None, 2.0, None, None, None, None, None, 0.0]
    assert values(df, safe_divide("n * 2", "d * 2"))[1] == 2.0


def test_width_bucket(table):
    amounts = [190000, 290000, 320000, 399999.99, 400000, 470000, 510000, 610000, 0, 50000, 600000, 700000]
    df = table("amount double", *[float(a) for a in amounts]).coalesce(1)
    assert values(df, width_bucket("amount", 200000, 600000, 4)) == [0, 1, 2, 2, 3, 3, 4, 5, 0, 0, 5, 5]
    edges = table("x double", 2.0, 4.0, 6.0, 8.0, 10.0, 21.9, 22.0).coalesce(1)
    assert values(edges, width_bucket("x", 2, 22, 5)) == [1, 1, 2, 2, 3, 5, 6]


def test_haversine(table):
    df = table("a double, b double, c double, d double", (48.864716, 2.349014, 52.379189, 4.899431))
    assert [round(v) for v in values(df, haversine_distance("a", "b", "c", "d", "km"))] == [430]
    assert [round(v) for v in values(df, haversine_distance("a", "b", "c", "d"))] == [267]
    opposite = table("a double, b double, c double, d double", (37.3, 10.1, -37.3, -169.9))
    assert values(opposite, haversine_distance("a", "b", "c", "d"))[0] == pytest.approx(3.14159265 * 3961, 1e-6)
    with pytest.raises(ValueError):
        haversine_distance("a", "b", "c", "d", "ft")


def test_surrogate_key(table):
    rows = [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)]
    df = table("x string, y string, z string", *rows).coalesce(1)
    # Known keys.
    assert values(df, surrogate_key(["x", "y", "z"])) == [
        "7b193b3d33184464106f41ddf733783b",
        "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05",
        "2fa5491950d66d153d23cfbcfea4e164",
    ]
    assert values(df, surrogate_key(["x"])) == [
        "0cc175b9c0f1b6a831c399e269772661",
        "0cc175b9c0f1b6a831c399e269772661",
        "f14cc5cdce0420f4a5a6b6d9d7b85f39",
        "f14cc5cdce0420f4a5a6b6d9d7b85f39",
    ]
    empty = "d41d8cd98f00b204e9800998ecf8427e"
    assert values(df, surrogate_key(["x"], nulls_as_empty=True))[2:] == [empty, empty]


SLUGS = {
    "!Hell0 world-hi": "hell0_world_hi",
    "0Hell0 world-hi": "_0hell0_world_hi",
    "!!": "",
    "a  - b": "a_b",
    "!9lives": "_9lives",
}


def test_slugify(table):
    df = table("s string", *SLUGS).coalesce(1)
    assert values(df, slugify(F.col("s"))) == list(SLUGS.values())
    assert [slugify_name(s) for s in SLUGS] == list(SLUGS.values())


def test_url_host(table):
    # URLs and their hosts.
    hosts = {
        "www.google.co.uk?p=e": "www.google.co.uk",
        "http://witanddelight.com/2018/01/tips-tricks-how-run-half-marathon-first-time/": "witanddelight.com",
        "https://www.nytimes.com/2018/01/30/magazine/blockchain.html?module=subsection": "www.nytimes.com",
        "android-app://m.facebook.com/": "m.facebook.com",
        "docs.nytimes.com": "docs.nytimes.com",
        "http://m.facebook.com:8080/x": "m.facebook.com:8080",
        None: None,
    }
    df = table("u string", *hosts).coalesce(1)
    assert values(df, url_host(F.col("u"))) == list(hosts.values())


def test_url_path(table):
    paths = {
        "http://h.com/": "",
        "https://h.com/2018/01/tips/": "2018/01/tips/",
        "h.com/2018/01/01/blog?x=/y": "2018/01/01/blog",
        "http://h.com": "",
        "https://h.com?r=/a": "",
        None: None,
    }
    df = table("u string", *paths).coalesce(1)
    assert values(df, url_path(F.col("u"))) == list(paths.values())


def test_url_parameter(table):
    df = table(
        "u string",
        "http://h.com/a?utm_medium=organic",
        "http://h.com/a?utm_medium=organic&utm_source=github",
        "http://h.com/a?xutm_source=1",
        "http://h.com/a?utm_source=",
        "http://h.com/a?utm_source=x#top",
        None,
    ).coalesce(1)
    assert values(df, url_parameter(F.col("u"), "utm_medium")) == ["organic", "organic", None, None, None, None]
    assert values(df, url_parameter(F.col("u"), "utm_source")) == [None, "github", None, None, "x", None]


# --- random inputs against plain Python


def random_texts(seed, alphabet, n=300):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(n)]


def test_slugs_of_random_text(table):
    texts = random_texts(1, "aZ09 -_!éKİ\t.")
    df = table("s string", *texts).coalesce(1)
    assert values(df, slugify(F.col("s"))) == [slugify_name(t) for t in texts]


def test_keys_of_random_text(table):
    texts = random_texts(2, "ab-é ")
    pairs = [(a, b if len(b) % 3 else None) for a, b in zip(texts, reversed(texts))]
    mark = "_dbt_utils_surrogate_key_null_"
    expected = [hashlib.md5(f"{a}-{mark if b is None else b}".encode()).hexdigest() for a, b in pairs]
    df = table("a string, b string", *pairs).coalesce(1)
    assert values(df, surrogate_key(["a", "b"])) == expected


def test_urls_of_random_parts(table):
    rng = random.Random(3)
    urls, hosts, paths, refs = [], [], [], []
    for _ in range(300):
        host = rng.choice(["a.com", "b.org:81", "localhost"])
        path = rng.choice(["", "/", "/x", "/x/y.html", "/x/"])
        ref = rng.choice(["", "z", "a/b"])
        query = rng.choice(["", f"?ref={ref}", f"?q=1&ref={ref}", "?xref=1", f"?ref={ref}&q=/"])
        urls.append(rng.choice(["", "http://", "https://"]) + host + path + query)
        hosts.append(host)
        paths.append(path[1:])
        refs.append((ref or None) if "?ref=" in query or "&ref=" in query else None)
    df = table("u string", *urls).coalesce(1)
    assert values(df, url_host(F.col("u"))) == hosts
    assert values(df, url_path(F.col("u"))) == paths
    assert values(df, url_parameter(F.col("u"), "ref")) == refs


def test_buckets_of_random_numbers(table):
    rng = random.Random(4)
    numbers = [rng.uniform(-5, 25) for _ in range(300)]
    edges = [2 + 4 * i for i in range(6)]
    expected = [sum(n >= e for e in edges) for n in numbers]
    assert values(table("x double", *numbers).coalesce(1), width_bucket("x", 2, 22, 5)) == expected
