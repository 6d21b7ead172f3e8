"""Collocations against a count of every phrase in plain Python."""
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from retailcast.llm.setm import collocations, mine, score_cuts

R = random.Random(13)
VOCABULARY = [f"w{i}" for i in range(30)] + ["Ünder", "ÉTÉ", "a", "A", "x\x0by", "　", "\xa0"]
FIXED = ["strong Tea and milk", "strong tea", "of the new york", "new york", "in\tspite  of"]


def text(n):
    out = []
    for _ in range(n):
        out.append(R.choice(FIXED) if R.random() < 0.3 else R.choice(VOCABULARY))
        out.append(R.choice([" ", " ", " ", "\t ", ". ", ",", "\n", " ! ? ", "\r\n"]))
    return "".join(out)


ROWS = ([(i, text(R.randint(0, 60)), "s", R.choice(["en", "fr", None, "und", ""])) for i in range(150)]
        + [(500, None, "s", "en"), (501, "", "s", "en"), (None, " \t", None, None), (502, "again and again " * 4000, "s", "en"), (503, ".,;:!?\n", "s", "xx")]
        + [(7, "strong tea and milk of the day", "s", "fr")] * 40)


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for _, t, _, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, 5):
                    if i + k <= len(w):
                        f[lang, tuple(w[i:i + k])] += 1
    cand = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            cand[lang, p] = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
    gone = {(lang, p[i:i + k]) for lang, p in cand for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * f[lang, p] >= 80 * f[lang, p[i:i + k]]}
    out = []
    for lang in n:
        left = sorted(((-c[0], -f[key], " ".join(key[1]).encode(), c) for key, c in cand.items() if key[0] == lang and key not in gone), key=lambda x: x[:3])[:top]
        out += [(lang, i + 1, p.decode(), -a, c[2], c[3], n[lang], c[0]) for i, (_, a, p, c) in enumerate(left)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, lang string, n long").withColumnRenamed("source", "phrase")


@pytest.mark.parametrize(("least", "top", "block", "shard", "parts"), [(30, 2000, 8 << 20, 4_000_000, 2), (4, 50, 600, 40, 3), (2, 5, 3000, 1000, 1)])
def test_against_all_phrases(spark, least, top, block, shard, parts):
    got = collocations(table(spark, ROWS).repartition(parts), least=least, top=top, block_bytes=block, per_shard=shard)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(ROWS, least, top)
    assert want and sorted(map(tuple, got.collect())) == want


def test_nothing_to_find(spark):
    assert collocations(table(spark, [])).count() == 0
    assert collocations(table(spark, [(1, None, "s", None), (2, " ", "s", "en")])).count() == 0


def test_occurrences_that_cannot_be_frequent_are_not_extended(spark):
    """R_1 and longer relations hold nothing of words that are too rare."""
    rows = [(i, f"rare{i} alpha beta rare{i}", "s", "en") for i in range(40)]
    phrases, words = mine(table(spark, rows), least=30, block_bytes=100)
    assert {r["phrase"]: r["n"] for r in phrases.collect()} == {"alpha": 40, "beta": 40, "alpha beta": 40}
    assert [tuple(r) for r in words.collect()] == [("en", 160)]


def test_scores_beyond_64_bits(spark):
    a, l, r = 3_000_000_000_000_000, 6_100_000_000_000_000, 5_700_000_000_000_001
    phrases = spark.createDataFrame([("en", "x", 1, l), ("en", "y", 1, r), ("en", "x y", 2, a)], "lang string, phrase string, size int, n long")
    assert [tuple(x) for x in score_cuts(phrases).select("k", "l", "r", F.col("score")).collect()] == [(1, l, r, 2_000_000 * a // (l + r))]
