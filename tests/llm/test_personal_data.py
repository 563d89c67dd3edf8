import hashlib
import random
import re

import pytest

from hazeframe.llm.personal_data import BASE, MORE, find_personal_data, finder, luhn, mask_personal_data

# The base patterns as they are, run over whole texts.
PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def valid(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p.lstrip("0") or 0) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), k, m.end()) for k, kind in enumerate(PLAIN) for m in PLAIN[kind].finditer(text or "") if valid(kind, m.group())]
    said = ",".join(f"{BASE[k]}:{s}:{e}" for s, k, e in sorted(found))
    return (*[sum(f[1] == k for f in found) for k in range(4)], hashlib.sha256(said.encode()).hexdigest(), said)


def base_of(spans):
    return ",".join(s for s in spans.split(",") if s.split(":")[0] in BASE)


PIECES = [
    "a", "Z", "@", "@", ".", ".", "-", " ", " ", "+", "+", "(", ")", "0", "1", "7", "255", "256", "99", "x.y", "a@b.c", "é", "\n", "1.2.3.4", "+44 20 7946 0958", "4111 1111 1111 1111", "4111-1111-1111-1111",
    "%", "_", "00001", "1234567890123", "://", "iban", "ssn: ", "account ", "12345678", "١", "K", "İ",
]


def corpus(n=3000):
    rng = random.Random(12)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 25))) for _ in range(n)]
    long = ["a" * 50_000 + "@b.c", "1." * 20_000 + "1", "0" * 6000 + "1.2.3.4", "1 " * 30_000, "+1" + " " * 30_000 + "23456789012", "a@" * 20_000 + "b.c", "://" * 5000, "ssn " * 5000]
    return list(enumerate([None, "", *long, *texts, texts[0]]))


def test_base_spans_equal_the_patterns(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: (*tuple(r)[1:6], base_of(r["spans"])) for r in find_personal_data(df).collect()}
    assert got == {k: plain(t) for k, t in rows}
    total = [sum(v[k] for v in got.values()) for k in range(4)]
    assert min(total) > 20, total


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("IBAN: DE89 3704 0044 0532 0130 00 paid", ["iban:6:33"]),
        ("iban DE89370400440532013000.", ["iban:5:27"]),
        ("IBAN: DE89 3704 0044 0532 0130 01", []),
        ("Our SSN is 078-05-1120, not 666-05-1120", ["ssn:11:22"]),
        ("ssn 666-05-1120", []),
        ("Social Security number 123-45-6789", ["ssn:23:34"]),
        ("classnote 123-45-6789", []),
        ("Account no. 12345678", ["account:12:20"]),
        ("Kontonummer: 1234 5678", ["account:13:22"]),
        ("accounting 12345678", []),
        ("on account of 12345678", []),
        ("ftp://joe:pw@host/x", ["login:0:13"]),
        ("see http://host/a:b@c", []),
    ],
)
def test_cues_and_schemes(text, spans):
    found = finder().spans(text, text.encode().lower().decode())
    named = [f"{(*BASE, *MORE)[k]}:{s}:{e}" for s, k, e in found if k >= len(BASE)]
    assert named == spans


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112") and luhn("0" * 14)


def test_masks(spark):
    df = spark.createDataFrame([(1, "Mail é bob@x.org or +44 20 7946 0958.", 5), (2, None, 6), (3, "ftp://joe:pw@host.org", 7), (4, "", 8)], "doc_id long, text string, spans long")
    got = {r["doc_id"]: (r["text"], r["spans"]) for r in mask_personal_data(df).collect()}
    assert got == {1: ("Mail é [EMAIL] or [PHONE].", 5), 2: (None, 6), 3: ("[LOGIN]", 7), 4: ("", 8)}
    assert mask_personal_data(df, kinds=("phone",)).where("doc_id = 1").first()["text"] == "Mail é bob@x.org or [PHONE]."


def test_nulls_repeated_rows_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([(None, "a@b.c", 1), (1, "a@b.c", 2), (1, "a@b.c", 2), (2, None, None)], "doc_id long, text string, n_email long")
    assert sorted((r[0] or 0, r[1]) for r in find_personal_data(df).collect()) == [(0, 1), (1, 1), (1, 1), (2, 0)]
    assert find_personal_data(df.limit(0)).count() == 0 and mask_personal_data(df.limit(0)).columns == df.columns
