import hashlib
import re

import pytest
from pyspark.sql import functions as F

from sievekit.llm.exact import exact_duplicates, without_duplicates

TEXTS = ["a b", "a  b", "a\t\r\n b", " a b", "a b ", "", None, " ", "A b", "é x", "é x", "x" * 300_000, "x" * 300_000 + " ",
         "x" * 300_000, "a\x0bb", "a\x1cb", "ab"]


def brute(rows):
    norm = {k: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for k, (_, t) in enumerate(rows)}
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in norm if norm[j] == norm[k]]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm[k].encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()], key=str)


def test_equals_brute_force(docs):
    rows = list(enumerate(TEXTS))
    assert rows_of(exact_duplicates(docs(TEXTS))) == brute(rows)


@pytest.mark.parametrize("weak", [lambda t: F.unhex(F.md5(F.length(t).cast("string"))), lambda t: F.unhex(F.md5(F.lit("one")))])
def test_colliding_hashes_are_split_by_bytes(docs, weak):
    assert rows_of(exact_duplicates(docs(TEXTS), hash_of=weak)) == brute(list(enumerate(TEXTS)))
    kept = without_duplicates(docs(TEXTS), hash_of=weak)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(b[0] for b in brute(list(enumerate(TEXTS))) if b[3])


def test_null_and_repeated_ids(spark):
    rows = [(None, "p"), (None, "p"), (3, "q"), (3, "q"), (None, "q"), (2, "q"), (2, "q"), (3, "r"), (1, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(exact_duplicates(df)) == brute(rows)
    kept = sorted(((r.doc_id, r.text) for r in without_duplicates(df).collect()), key=str)
    assert kept == sorted([(None, "p"), (None, "p"), (2, "q"), (2, "q"), (3, "r"), (1, None)], key=str)


def test_a_third_in_one_group(docs):
    texts = {i: "same  text" if i % 3 == 0 else f"text {i // 2}" for i in range(3000)}
    assert rows_of(exact_duplicates(docs(texts, parts=7))) == brute(list(texts.items()))


def test_empty_and_clashing(spark, empty):
    assert exact_duplicates(empty).count() == 0
    assert without_duplicates(empty).count() == 0
    names = ["_hash", "_norm", "keep_id", "group_size", "kept", "_sha", "_map", "_bit", "_class", "text_sha256"]
    df = spark.createDataFrame([(i, t, *range(len(names))) for i, t in enumerate(TEXTS)],
                               "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    assert rows_of(exact_duplicates(df)) == brute(list(enumerate(TEXTS)))
    assert without_duplicates(df).columns == df.columns


def test_no_python_in_the_plan(docs):
    plan = exact_duplicates(docs(TEXTS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
