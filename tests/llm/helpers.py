"""Small tables of odd rows, and plain versions of what the operators compute."""

import random
import re
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, ROOT)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, row string, digest string, kept boolean, n int, key int, score double"
WORDS = "der the and la que für wörter ist in of to a b c mañana été naïve 42 x-y".split()


def text(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def edited(base, every):
    words = base.split()
    return " ".join(w if i % every else f"new{i}" for i, w in enumerate(words))


def odd_texts():
    """Null, empty, white space, short, equal but for case, near copies, repeated passages, a very long text."""
    base, passage = text(1, 120), text(2, 60)
    return [
        None, "", " \t\n ", "one", "Two WORDS", "two words", base, base.upper().replace("Ü", "ü"), base,
        edited(base, 50), edited(base, 3), text(3, 20) + " " + passage, passage + "\n" + text(4, 30), text(5, 34),
        text(6, 35), text(6, 35) + " tail", "a " * 90, "日本語 テキスト 🙂 é   x", "x" * 5000, text(7, 30_000), "!!! ### 123",
    ]


def table(spark, rows=None):
    """Odd rows with an id each, one row repeated, one without id, and columns whose names the operators use inside."""
    if rows is None:
        texts = odd_texts()
        rows = [(10 + 3 * i, t) for i, t in enumerate(texts)] + [(10 + 3 * 6, texts[6])] + [(None, "no id here")]
    spark.sparkContext.environment["PYTHONPATH"] = ROOT
    full = [(i, t, "en", "s1", None if t is None else len(t), -1, "r", "d", True, 7, 8, 0.5) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def words(t, lower=False):
    t = t or ""
    if lower:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t)
    return [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
