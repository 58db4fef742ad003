import hashlib
import random
import re

import pytest

from sievekit.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(texts, items):
    pats = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(LOW))
        for k in range(max(1, len(w) - 9) if w else 0):
            pats.setdefault(tuple(w[k:k + 10]), set()).add(i)
    out = {}
    for d, t in texts.items():
        w = WORD.findall((t or "").translate(LOW))
        hit, found = set(), set()
        for p, who in pats.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit.update(range(k, k + len(p)))
                    found |= who
        ids = sorted(str(x) for x in found if x is not None)
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block_words", [400_000, 20])
def test_matches_brute_force(spark, docs, block_words):
    r = random.Random(5)
    word = lambda: r.choice(["the", "of", "a", "ab", "Été", "x9", "THE"]) if r.random() < .6 else f"w{r.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(r.choice([1, 3, 9, 10, 11, 25])))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "!!! ..."), (None, "null id item words"), (7, items[3][1]), (200, "the of a the of a the of a the of a")]
    texts = {}
    for d in range(60):
        w = [word() for _ in range(r.choice([0, 5, 40, 1200]))]
        for _ in range(r.choice([0, 1, 2])):
            at = r.randrange(len(w) + 1)
            w[at:at] = (items[r.randrange(len(items))][1] or "").upper().split()
        texts[d] = r.choice([" ", ", ", "\n- "]).join(w)
    texts[900] = None
    texts[901] = "the of a " * 50
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(docs(texts), bench, block_words=block_words).collect()
    want = brute(texts, items)
    assert {x.doc_id: (x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) for x in got} == want
    kept = D.decontaminated(docs(texts), bench)
    assert kept.columns == docs(texts).columns
    assert {x.doc_id for x in kept.collect()} == {d for d, v in want.items() if not v[4]}


def test_edges(spark, docs, empty, clashing):
    bench = spark.createDataFrame([(1, "some words here")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(empty, bench).collect() == []
    assert [r.contaminated for r in D.contamination(docs(["some words here", None]), none).collect()] == [False, False]
    rows = {r.doc_id: r.n_hit for r in D.contamination(clashing(["x some words here y", None]), bench).collect()}
    assert rows == {0: 3, 1: 0}


def test_twenty_blocks_are_never_more_than_a_few_in_a_stage(spark, docs, monkeypatch):
    """Blocks of few words give the rows of one block, and rows are written after every few passes."""
    from sievekit.llm import decontaminate as D
    from sievekit.llm import frames
    items = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(12))) for i in range(40)] + [(3, None), (3, "w3x0 w3x1"), (None, "w5x1")],
                                  "item_id long, text string")
    texts = docs([" ".join(f"w{i % 7}x{k}" for k in range(i % 13)) for i in range(60)] + [None, "", "w3x0 w3x1 " * 3000])
    writes = []
    monkeypatch.setattr(D, "stored", lambda df: writes.append(1) or frames.stored(df))
    pick = lambda **kw: sorted(map(tuple, D.contamination(texts, items, **kw).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256").collect()))
    one = pick()
    assert not writes and pick(block_words=25) == one and len(writes) >= 4
