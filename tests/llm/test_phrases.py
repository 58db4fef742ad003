import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sievekit.llm import phrases
from sievekit.llm.phrases import Slice, collocations, stripes_of

FIELDS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, top=2000, least=10, longest=3, share=50):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in cand.items():
        inside = any(l2 == lang and len(q) > len(p) and 100 * b >= share * a
                     and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (l2, q), b in cand.items())
        if inside:
            continue
        s, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], s))
    res = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))[:top]
        res += [(lang, i, *o[1:]) for i, o in enumerate(own, 1)]
    return sorted(res)


def corpus(seed, texts=200, words=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "THE", "x-y", "\x1c", "日本"]
    breaks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!", "\x0b"]
    return [(rng.choice(["en", "en", "de", None]), None if rng.random() < .05 else
             "".join(rng.choice(vocabulary) + rng.choice(breaks) for _ in range(rng.randrange(60)))) for _ in range(texts)]


def result(spark, rows, parts=4, **kw):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    return sorted(tuple(r[c] for c in FIELDS) for r in collocations(df, **kw).select(*FIELDS).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    want = brute(rows)
    assert want and result(spark, rows) == want


def test_four_words_top_and_share(spark):
    rows = corpus(5, words=4) + [(lang, "one two three four, five three four") for lang in ("en", "fr") for _ in range(9)]
    want = brute(rows, top=7, least=4, longest=4, share=70)
    assert result(spark, rows, top=7, min_count=4, max_words=4, share=70) == want
    assert {"one two three four", "five three four"} <= {w[2] for w in want} and "two three four" not in {w[2] for w in want}


FULL = np.full(phrases.BITMAP_BITS // 8, 255, dtype=np.uint8)


def test_slices_hold_whole_texts_and_their_stripes(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_BYTES", 4)
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de", "en", "en"]), pa.array(["a b c", "", "a b", "a b; c"])], ["lang", "text"])
    parts = list(phrases.slices(iter([batch])))
    assert [len(p) for p in parts] == [3, 5]
    none = pa.array([], pa.string())
    got = stripes_of(parts[1], 1, FULL, none).to_pylist()
    assert [(r["prefix"], r["words"], r["counts"]) for r in got] == [("a", "b", [2])]
    assert stripes_of(parts[0], 2, FULL, none).to_pylist() == [
        {"lang": "en", "prefix": "a b", "shard": 0, "words": "c", "counts": [1]}]
    assert stripes_of(parts[0], 2, FULL * 0, none).num_rows == 0
    assert stripes_of(Slice([b" .,"], ["en"]), 0, None, none).num_rows == 0


def test_a_hot_prefix_is_cut_into_shards(spark):
    rows = [("en", " ".join(f"the word{i % 40}" for i in range(j, j + 30)) + ".") for j in range(200)]
    assert result(spark, rows) == brute(rows)
    part = Slice([rows[0][1].encode()], ["en"])
    cut = stripes_of(part, 1, FULL, pa.array(["en the"], pa.string())).to_pylist()
    shards = {r["shard"] for r in cut if r["prefix"] == "the"}
    assert len(shards) > 5 and all(r["shard"] == 0 for r in cut if r["prefix"] != "the")


def test_counts_past_64_bits(spark):
    from sievekit.llm.phrases import _score
    df = spark.createDataFrame([(900_000_000_000, 10**12, 10**12 + 7)], "a long, l long, r long")
    a, l, r = df.first()
    assert df.select(_score("a", "l", "r")).first()[0] == 1000000 * a * a // (l * r)


def test_empty_long_and_clashing(spark, empty, clashing):
    assert collocations(empty).count() == 0
    assert collocations(clashing(["", None, "..", " \t"])).count() == 0
    long = "one two three, " * 60_000
    got = collocations(clashing([long])).collect()
    assert [(r.phrase, r.a, r.score) for r in got] == [("one two three", 60_000, 1_000_000)]
