import zlib

import numpy as np

from sievekit.llm import language as L

SF01 = "/root/testdata/sf0.01"
WORDS = {"aa": "bada dabad abba dada bad", "oo": "lomo molol ommo lolo mol", "ii": "riki kirik irri kiki rik"}


def labelled(spark, n=300):
    rows = []
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        rows.append((i, " ".join(WORDS[lang].split()[(i * k) % 5] for k in range(1, 8)), lang))
    return rows


def test_held_out_accuracy_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_and_other_columns_have_no_say(spark):
    rows = labelled(spark)
    a = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spoiled = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else g) for i, t, g in rows]
    b = spark.createDataFrame(spoiled, "doc_id long, text string, lang string")
    pick = lambda df: sorted(map(tuple, L.identify(df).collect()))
    assert pick(a) == pick(b)
    assert all(r.lang_pred != "zz" for r in L.identify(b).collect())


def test_kernel_is_the_blended_spectrum_kernel():
    m = L.fit([(WORDS[g], g) for g in WORDS for _ in range(2)])
    t = "bada lomo"

    def grams(text):
        s = "\0" + "".join(c if c.isalpha() else "\0" for c in text) + "\0"
        return {s[i:i + n] for n in L.ORDERS for i in range(len(s) - n + 1)}
    want = [len(grams(t) & grams(WORDS[g])) / np.sqrt(len(grams(t)) * len(grams(WORDS[g]))) for g in sorted(WORDS) for _ in range(2)]
    assert np.allclose(m.kernel([t])[0], [w for _, w in sorted(zip([g for g in WORDS for _ in range(2)], want))] if list(WORDS) != sorted(WORDS) else want)


def test_edges(spark, empty):
    rows = labelled(spark, 90) + [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !! 34", "aa"), (1003, "bada", None), (None, "lomo", "oo"), (7, "bada", "aa")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, score int, held_out int")
    got = L.identify(df).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["doc_id", "held_out", "lang_pred", "score"]
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1000].score == 0
    assert by[1003].lang_pred == "aa" and by[None].lang_pred == "oo" and by[None].held_out is False
    assert L.identify(empty).collect() == []
    none = spark.createDataFrame([(1, "bada", None)], "doc_id long, text string, lang string")
    assert L.identify(none).first().lang_pred == "und"
    kept = L.identified(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {0, 1, 2, 1003, None}
    assert not {1000, 1001, 1002} & {r.doc_id for r in kept.collect()}
    long_ = [(0, "bada " * 100_000, "aa")] + labelled(spark, 30)[1:]
    assert L.identify(spark.createDataFrame(long_, "doc_id long, text string, lang string")).where("doc_id = 0").first().lang_pred == "aa"


def _brute_scores(sample, texts):
    """Kernel ridge regression on Nyström features, from sets and dense algebra."""
    def grams(text):
        s = "\0" + "".join(c if c.isalpha() else "\0" for c in text.lower()) + "\0"
        return {s[i:i + n] for n in L.ORDERS for i in range(len(s) - n + 1)}

    def k(a, b):
        return len(a & b) / np.sqrt(len(a) * len(b))
    g = [grams(t) for t, _ in sample]
    own = np.array([[k(a, b) for b in g] for a in g])
    value, vector = np.linalg.eigh(own)
    keep = value > 1e-8 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    feature = lambda rows: np.hstack([rows @ root, np.ones((len(rows), 1))])
    x, langs = feature(own), sorted({lang for _, lang in sample})
    new = feature(np.array([[k(grams(t), b) for b in g] for t in texts]))
    out = []
    for lang in langs:
        y = np.array([1.0 if v == lang else -1.0 for _, v in sample])
        w = np.diag([1 / sum(v == other for _, other in sample) for _, v in sample])
        out.append(new @ np.linalg.solve(x.T @ w @ x + L.RIDGE * np.eye(x.shape[1]), x.T @ w @ y))
    return np.array(out).T


def test_scores_match_brute_force(monkeypatch):
    sample = [(t, lang) for lang, t in WORDS.items()] + [("bada lolo", "aa"), ("Lomo riki", "oo"), ("日本 riki", "ii"), ("дом kirik", "ii")]
    texts = ["bada lomo", "riki", "日本 дом", "q"]
    want = _brute_scores(sample, texts)
    assert np.allclose(L.fit(sample).scores(texts), want, atol=1e-9)
    monkeypatch.setattr(L, "DENSE", 5)          # most n-grams by lists
    monkeypatch.setattr(L, "BLOCK", 3)
    assert np.allclose(L.fit(sample).scores(texts), want, atol=1e-9)


#: first code points of the letters of twelve made-up languages in ten scripts
SCRIPTS = {"en": (0x61, 20), "pl": (0x61, 20), "ru": (0x430, 30), "uk": (0x430, 30), "el": (0x3B1, 20), "hy": (0x561, 30), "he": (0x5D0, 20),
           "ar": (0x628, 20), "hi": (0x915, 30), "zh": (0x4E00, 900), "ja": (0x3042, 80), "ko": (0xAC00, 900)}


def made_up(seed, texts=40):
    rng = np.random.default_rng(seed)
    out = []
    for k, (lang, (start, n)) in enumerate(sorted(SCRIPTS.items())):
        own = np.random.default_rng(k)
        words = ["".join(chr(start + c) for c in own.integers(0, n, own.integers(2, 6))) for _ in range(60)]
        out += [(" ".join(rng.choice(words, 25)), lang) for _ in range(texts)]
    return out


def test_twelve_languages_in_ten_scripts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(made_up(1))]
    # a very long training text counts whole: its language shows after 5,000 letters of another's
    rows.append((len(rows) + 3, rows[0][1] + " " + "x" * 5000, rows[0][2]))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in L.identify(df).collect()}
    for lang in SCRIPTS:
        held = [got[i].lang_pred == lang for i, _, v in rows if v == lang and got[i].held_out]
        assert len(held) >= 3 and np.mean(held) >= 0.95, lang
    assert all(got[i].score >= L.MIN_SCORE for i, *_ in rows[:-1])


def test_ties_between_languages_go_to_the_first():
    m = L.fit([("same text", "zz"), ("same text", "aa")])
    assert m.predict(["same text", "other"])[0] == ["aa", "aa"]
