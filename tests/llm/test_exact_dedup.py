"""Exact dedup against a dictionary of normalised texts, over trees of one to many rounds."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from retailcast.llm import exact_dedup
from retailcast.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

R = random.Random(11)
COPY = "the same text\tin  many rows"
ROWS = ([(i, R.choice(["", " ", None, "\n\x0b ", COPY, COPY.replace("\t", "\r\n"), f"text {i % 7}", f"text\t{i % 7}", f" text {i % 7}", f"só {i}　x\xa0"]), f"s{i % 3}") for i in range(400)]
        + [(None, COPY, "s0"), (None, "only without id", "s0"), (None, "only without id", None), (3, "twice", "s1"), (3, "twice", "s1"), (2, "twice", None),
           (900, "long " * 50_000, "s0"), (901, "long\n" * 50_000, "s0"), (2**63 - 1, "only without id 2", "s0"), (None, "only without id 2", "s0"), (-5, COPY, "s0")])


def want(rows):
    groups = defaultdict(list)
    for d, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", t or "")].append(d)
    out = Counter()
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda d: (d is None, d or 0))
        for i, d in enumerate(ids):
            out[d, ids[0], len(ids), i == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize(("fan", "run_rows", "parts"), [(8, 1 << 17, 1), (2, 16, 5), (4, 7, 3), (8, 3, 8)])
def test_against_groups(spark, docs_of, fan, run_rows, parts):
    docs = docs_of(ROWS).repartition(parts)
    got = exact_duplicates(docs, fan=fan, run_rows=run_rows)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == want(ROWS)


def test_empty_and_all_equal(docs_of):
    assert exact_duplicates(docs_of([])).count() == 0 and drop_exact_duplicates(docs_of([])).count() == 0
    same = [(7, COPY, "s")] * 300
    assert Counter(map(tuple, exact_duplicates(docs_of(same), fan=2, run_rows=9).collect())) == want(same)


def test_kept_documents_keep_all_columns(docs_of):
    docs = docs_of(ROWS).withColumnsRenamed({"source": "row"}).withColumn("keep_id", F.lit(1)).withColumn("sha", F.lit("x")).withColumn("a.b", F.lit(2))
    kept = drop_exact_duplicates(docs, fan=2, run_rows=50)
    assert kept.columns == docs.columns
    texts = Counter(re.sub(r"[\x20\x09-\x0d]+", " ", r["text"] or "") for r in kept.collect())
    assert max(texts.values()) == 1 and len(texts) == len({k[4] for k in want(ROWS)})


def test_entries_that_fail_the_check_stay_apart(monkeypatch, docs_of):
    """With a digest that is the same for all, only the second hash and the length tell texts apart."""
    rows = [(i, f"t{i % 9}", "s") for i in range(60)]
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.repeat(F.lit("ab"), F.lit(32)))
    got = {(r["doc_id"], r["keep_id"]) for r in exact_duplicates(docs_of(rows), fan=2, run_rows=8).collect()}
    assert got == {(i, i % 9) for i in range(60)}
