"""Forms of personal data that have to go, and what has to stay."""

import re

from helpers import table
from pyspark.sql import functions as F

from citeloom.llm import surrogates

GONE = [
    "+44 20 7946 0958", "+33 1 42 68 53 00", "+49 151 23456789", "+34 912 34 56 78", "+49 (0)30 123456", "555.123.4567",
    "555 123 4567", "01 42 68 53 00", "0044 20 7946 0958", "030/1234567", "(030) 1234567", "912 34 56 78", "01.42.68.53.00",
    "3782 822463 10005", "378282246310005", "6304 0000 0000 0000 000", "2001:db8:0:1::7", "fe80::1ff:fe23:4567:890a",
    "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "ghp_0123456789abcdefghijABCDEFGHIJ012345", "AIzaSyA0123456789abcdefghijklmnopqrstuv",
    "sk_live_0123456789abcdefABCDEF", "Dr Smith", "Prof. Dr. Anna Smith", "Mlle Dupont", "Don Quijote", "Herr Dr. Kranz",
]
STAY = [
    "0.12345678901", "01.02.2021", "07/11/2021", "2021-01-02 03:04:05", "std::vector", "12:30:45", "378282246310006", "Don",
    "1,234,567,890", "0123456789abcdef", "a::b", "v1.2.3", "1 000 000 000", "1 012 345 678",
]


def test_forms(spark):
    rows = [(i, f"see {x}, or") for i, x in enumerate(GONE)] + [(100 + i, f"see {x}, or") for i, x in enumerate(STAY)]
    rows += [(200, "call +1 (017) 555-7713 218.44.7.91"), (201, "card 4111 1111 1111 1111 12 and 4111111111111111")]
    rows += [(202, "2001:db8::1 or 2001:0DB8:0:0:0:0:0:1"), (203, "Dr Anna Smith, Mrs Anna Smith")]
    got = {r["doc_id"]: r for r in surrogates.replace_personal_data(table(spark, rows), "key").collect()}
    left = [x for i, x in enumerate(GONE) if got[i]["n_entities"] != 1 or x in got[i]["text"] or not got[i]["text"].endswith(", or")]
    assert not left
    assert not [x for i, x in enumerate(STAY) if got[100 + i]["n_entities"] or got[100 + i]["text"] != f"see {x}, or"]
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} \d+(\.\d+){3}", got[200]["text"]) and got[200]["n_entities"] == 2
    cards = re.fullmatch(r"card ([\d ]{19}) 12 and (\d{16})", got[201]["text"]).groups()
    assert cards[0].replace(" ", "") == cards[1]
    a, b = got[202]["text"].split(" or ")
    assert a == b.lower()
    assert re.fullmatch(r"Dr (\w+ \w+), Mrs \1", got[203]["text"])


def repeating(size):
    return [
        "a@" + "b." * (size // 2) + "com", "sk-" + "a" * 20 + ".b" * (size // 2), "a@" + "b." * (size // 2) + "1", "1 " * (size // 2),
        "0 123" + " 123" * (size // 4), "Dr " * (size // 3) + "Smith", "DE12" + " AB12" * (size // 5), "1:" * (size // 2), "::" * (size // 2),
        "Mr A" + "-b" * (size // 2), "1.1." * (size // 4), "+1" + "-(1" * (size // 3), "a" * size + "@b.com", "4111 " * (size // 5),
    ]


def test_parts_that_repeat(spark):
    """No pattern takes a frame of the stack, or reads all that follows, at each turn of a part that repeats: a megabyte of
    each is searched, and texts of some kilobytes are rewritten."""
    found = F.regexp_extract_all("text", F.lit(surrogates.PATTERN), F.lit(0))
    rows = list(enumerate(f"see {x} now" for x in repeating(1 << 20)))
    got = dict(table(spark, rows).select("doc_id", F.transform(found, F.length)).collect())
    assert len(got) == len(rows) and got[0] == [len(rows[0][1]) - 8] and got[1] == [len(rows[1][1]) - 8]
    rows = [(i, f"see {x} now") for i, x in enumerate(repeating(8192)[:4])] + [(99, "mail a@b.com.1 or c@d.e-f.org-x, g@h.example")]
    got = {r["doc_id"]: r for r in surrogates.replace_personal_data(table(spark, rows), "key").collect()}
    assert [got[i]["n_entities"] for i in range(4)] == [1, 1, 0, 0] and "b.b" not in got[0]["text"] + got[1]["text"]
    assert got[99]["n_entities"] == 3 and re.fullmatch(r"mail \S+\.1 or \S+-x, \S+", got[99]["text"])


def test_the_key_is_a_setting(spark):
    rows = [(1, "to a.b@c.example.com")]
    texts = [surrogates.replace_personal_data(table(spark, rows), k).first()["text"] for k in ("one", "one", "two")]
    assert texts[0] == texts[1] != texts[2]
    drawn = surrogates.session_key(spark)
    assert len(drawn) == 64 and surrogates.session_key(spark) == drawn
    spark.conf.set(surrogates.KEY_SETTING, "mine")
    try:
        assert surrogates.session_key(spark) == "mine"
    finally:
        spark.conf.unset(surrogates.KEY_SETTING)
