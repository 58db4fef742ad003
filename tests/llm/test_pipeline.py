import public_tokenizers as P
import pytest
import sentencepiece

import corpus_pipeline
from sievekit.llm import jaccard, private
from sievekit.llm.frames import stored, table
from sievekit.llm.language import MIN_SCORE, identify
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as components
from tests.llm.test_jaccard import shuffled, unlike

SF001 = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark):
    docs = table(spark, SF001, "documents")
    columns = docs.columns
    bench = [(r.item_id, r.text) for r in table(spark, SF001, "benchmark").collect()]
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        lang = {r.doc_id: r for r in identify(docs).collect()} if name == "language_id" else {}
        docs = stored(stage(spark, docs, SF001))
        after = {r.doc_id: r for r in docs.collect()}
        texts = {i: r.text for i, r in before.items()}
        if name == "language_id":
            want = {i for i, r in lang.items() if r.lang_pred != "und" and r.score >= MIN_SCORE}
        elif name == "ngram_jaccard":
            want = {i for i, (_, c) in components(texts).items() if c == i}
        elif name == "decontaminate":
            want = {i for i, v in contaminated(texts, bench).items() if not v[4]}
        else:
            want = set(before)
        assert set(after) == want, name
        if name != "sentencepiece":
            assert docs.columns == columns, name
        if name in ("language_id", "ngram_jaccard", "decontaminate"):
            assert all(after[i] == before[i] for i in want)
        if name == "pii":
            for i, r in after.items():
                old = private.entities(texts[i])
                assert len(old) == len(private.entities(r.text)) and (old or r.text == texts[i])
                assert not {texts[i][s:e] for s, e, _ in old} & {r.text[s:e] for s, e, _ in private.entities(r.text)}
                assert r.n_chars == len(r.text)
        if name == "sentencepiece":
            for i, r in after.items():
                assert r.ids == sp.encode(texts[i]) and r.text == texts[i] and r.n_pieces == len(r.ids)
    assert len(after) == corpus_pipeline.run(spark, SF001).count()


def test_stages_and_edges(spark, empty, clashing):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "decontaminate", "pii", "sentencepiece"]
    for docs in (empty, clashing(["some plain words of text", None, "some plain words of text"])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF001)
            assert name == "sentencepiece" or out.columns == docs.columns
            assert out.count() <= docs.count()


def test_near_copy_stage_shuffles_few_texts(spark, docs):
    """Rows that stay, or go, by a bit of their id don't travel."""
    texts = unlike(300)
    rows = stored(docs(texts * 2))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = corpus_pipeline.ngram_jaccard(spark, rows, SF001)
        known = set(shuffled(spark))
        kept = stored(result)
        sent = sum(n for name, n in shuffled(spark).items() if name not in known)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.doc_id for r in kept.collect()} == set(range(300))
    assert sent < sum(map(len, texts)) / 4


@pytest.mark.parametrize("bits", [32, 1 << 25])
def test_representatives_with_odd_ids(spark, monkeypatch, bits):
    monkeypatch.setattr(jaccard, "FILTER_BITS", bits)
    a, b, c = unlike(3)
    rows = [(1, a), (2, a), (2, a), (3, b), (4, None), (4, None), (None, b), (None, None), (5, c), (6, c + " end")]
    odd = spark.createDataFrame([(i, t, [k], {"k": k}) for k, (i, t) in enumerate(rows)], "doc_id int, text string, _key array<int>, m map<string,int>")
    got = corpus_pipeline.ngram_jaccard(spark, odd, SF001)
    assert got.columns == odd.columns
    assert sorted(r._key[0] for r in got.collect()) == [0, 3, 4, 5, 6, 7, 8]
