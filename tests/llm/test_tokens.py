import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sievekit.llm import pieces, token_counts

BPE, SP = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
HARD = ["", " ", "a", "  a   b ", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "don't we'll I'VE", "aaaa" * 50, "\x1c\x85\xa0  x",
        "日本語 テキスト 😀😀 ١٢٣ ½ Ⅷ", "\x00\x01", "tab\tand\nnewline\r\n", "x86-64 foo_bar(baz);", "▁a ▁▁b", " " * 70 + "z", "Ünïcödé ñandú", "((a))[b]{c}",
        "word, word. word!! \"word\" 'word'", "=" * 300, "﻿\xad"]


def test_counts_equal_the_library():
    c, t = token_counts.BpeCounter(BPE), Tokenizer.from_file(BPE)
    assert [c.count(x) for x in HARD] == [len(t.encode(x, add_special_tokens=False).ids) for x in HARD]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_counts_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert _counter().count(text) == len(_library().encode(text, add_special_tokens=False).ids)


_made = {}


def _counter():
    return _made.setdefault("c", token_counts.BpeCounter(BPE))


def _library():
    return _made.setdefault("t", Tokenizer.from_file(BPE))


def _model():
    return _made.setdefault("m", pieces.PieceModel(SP))


def _sp():
    return _made.setdefault("s", sentencepiece.SentencePieceProcessor(model_file=SP))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" ▁aeithn.,'\n12")), max_size=60))
def test_pieces_of_any_text(text):
    offsets, ids = _model().encode_batch([text])
    assert ids.tolist() == _sp().encode(text)
    assert _model().decode(ids.tolist()) == _sp().decode(_sp().encode(text)) == text.replace("▁", " ")


def test_pieces_equal_the_library_and_decode():
    offsets, ids = _model().encode_batch(HARD)
    for i, x in enumerate(HARD):
        mine = ids[offsets[i]:offsets[i + 1]].tolist()
        assert mine == _sp().encode(x), x
        assert _model().decode(mine) == x.replace("▁", " ")


def test_unigram_forward_pass_is_the_best_segmentation():
    m = _model()
    u = object.__new__(pieces.PieceModel)
    u.__dict__.update(m.__dict__)
    u.bpe, u.unknown_score = False, -1e6

    def best(word):
        if not word:
            return 0.0
        return max((u.score.get(word[:k], u.unknown_score if k == 1 else -1e12) + best(word[k:]) for k in range(1, len(word) + 1)))
    for word in ("▁the", "▁hello", "▁zzq", "▁aé"):
        (_, ids), = u.encode_sorted([word])
        got = sum(u.score[p] for p in (_sp().id_to_piece(i) for i in ids) if p in u.score)
        unknown = sum(c not in u.score for c in word)
        assert got + unknown * u.unknown_score == pytest.approx(best(word))


def test_spark_forms_and_edges(spark, docs, empty, clashing):
    texts = [*HARD, None]
    counts = {r.doc_id: r for r in token_counts.token_counts(docs(texts), BPE, limit=20).collect()}
    for i, x in enumerate(texts):
        n = len(_library().encode(x or "", add_special_tokens=False).ids)
        assert (counts[i].n_bytes, counts[i].n_tokens, counts[i].over_limit) == (len((x or "").encode()), n, n > 20)
    rows = {r.doc_id: r for r in pieces.encode(docs(texts), SP).collect()}
    for i, x in enumerate(texts):
        assert rows[i].ids == (None if x is None else _sp().encode(x))
        assert rows[i].n_pieces == (len(_sp().encode(x)) if x else 0)
        assert rows[i].decoded == (None if x is None else x.replace("▁", " "))
    back = pieces.decode(spark.createDataFrame([(1, _sp().encode("hello  there")), (2, None), (3, [])], "k int, ids array<int>"), SP)
    assert {r.k: r.text for r in back.collect()} == {1: "hello  there", 2: None, 3: ""}
    for df in (empty, clashing(["a b", None])):
        n = df.count()
        assert token_counts.token_counts(df, BPE).count() == n and pieces.encode(df, SP).count() == n


def test_very_long_texts():
    x = "abc" * 30_000 + " " + "word " * 30_000
    assert _counter().count(x) == len(_library().encode(x, add_special_tokens=False).ids)
    _, ids = _model().encode_batch([x])
    assert ids.tolist() == _sp().encode(x)
