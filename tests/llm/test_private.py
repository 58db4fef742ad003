import pytest

from sievekit.llm import private as X

KEY = b"k"
TEXT = ("Mail und.34@mail7.example.com or UND.34@MAIL7.EXAMPLE.COM, call +1 (017) 555-7713, host 97.51.17.173, card 4111 1111 1111 1111 "
        "or 4111111111111111; Mrs. Jane Doe met Mr Bob Stone. IBAN DE44 5001 0517 5407 3249 31, no. 078-05-1120.")


def test_entities_are_found_with_their_kinds():
    kinds = [k for _, _, k in X.entities(TEXT)]
    assert kinds == ["email", "email", "phone", "ipv4", "card", "card", "name", "name", "iban", "ssn"]
    for clean in ("", "The year 2024 had 365 days, 3.14 and 1,000,000.", "1.2.3", "version 10.2.3.400", "a@b", "call 5"):
        assert X.entities(clean) == []


@pytest.mark.parametrize("kind,entity", [("email", "a.b1@x.org"), ("ipv4", "97.51.17.173"), ("card", "4111111111111111"),
                                         ("iban", "DE44500105175407324931"), ("ssn", "078051120"), ("phone", "+10175557713"),
                                         ("name", "Mrs Jane Doe"), ("name", "Mr Stone")])
def test_surrogates_keep_type_and_format(kind, entity):
    s = X.surrogate(KEY, kind, entity)
    assert s != entity and s == X.surrogate(KEY, kind, entity) != X.surrogate(b"other", kind, entity)
    assert X.surrogate(KEY, kind, entity, 1) != s
    written = X.in_format(kind, entity, s)
    assert [k for _, _, k in X.entities(f"x {written} y")] == [kind] or kind in ("card", "ssn", "phone", "iban")
    if kind == "card":
        assert X.luhn(s) == 0 and s[0] == "4" and len(s) == 16
    if kind == "name":
        assert s.split()[0] == entity.split()[0] and len(s.split()) == len(entity.split())
        assert s.split()[1] in X.GIVEN["f"] or kind != "name" or entity == "Mr Stone"


def test_texts_spark(spark, docs):
    texts = [TEXT, "again und.34@mail7.example.com and 97.51.17.173 twice 97.51.17.173", None, "", "clean words only"]
    rows = {r.doc_id: r for r in X.with_surrogates(docs(texts), "k").collect()}
    assert rows[2].text is None and rows[3].text == "" and rows[4].text == "clean words only"
    assert [rows[i].n_entities for i in range(5)] == [10, 3, 0, 0, 0]
    new = [t[s:e] for t in [rows[0].text] for s, e, _ in X.entities(t)]
    old = [TEXT[s:e] for s, e, _ in X.entities(TEXT)]
    assert len(new) == len(old) and not set(new) & set(old)
    assert new[1] == new[0].upper()                              # one entity, written two ways
    assert new[4].replace(" ", "") == new[5]                      # the same card with and without blanks
    again = [rows[1].text[s:e] for s, e, _ in X.entities(rows[1].text)]
    assert again[0] == new[0] and again[1] == again[2] == new[3]  # the same surrogate in another row
    for a, b in zip(old, new):
        assert [c.isdigit() for c in a if not c.isalnum()] == [c.isdigit() for c in b if not c.isalnum()] or "@" in a or "." in a
    # what isn't an entity stays
    assert rows[0].text.startswith("Mail ") and "; Mrs. " in rows[0].text and rows[0].text.endswith(".")


def test_collisions_draw_again(spark, monkeypatch):
    """With a tiny space of surrogates, distinct entities still get distinct ones, none of them an entity."""
    found = spark.createDataFrame([("ipv4", f"1.1.1.{i}") for i in range(60)], "kind string, entity string")
    table = X.settled_turns(found, KEY).collect()
    assert len({r.drawn for r in table}) == 60
    names = spark.createDataFrame([("name", f"Mr Name{i}") for i in range(3000)], "kind string, entity string")
    table = X.settled_turns(names, KEY).collect()
    assert len({r.drawn for r in table}) == 3000 and any(r.turn > 0 for r in table)
    assert all(r.drawn == X.surrogate(KEY, r.kind, r.entity, r.turn) for r in table)
    # all passes of the collision table write the same texts
    texts = spark.createDataFrame([(i, f"Mr Name{i} came") for i in range(3000)], "doc_id long, text string")
    one = {r.doc_id: r.text for r in X.with_surrogates(texts, "k").collect()}
    two = {r.doc_id: r.text for r in X.with_surrogates(texts, "k", turns_at_once=40).collect()}
    assert one == two and len(set(one.values())) == 3000


def test_edges(spark, empty, clashing):
    assert X.with_surrogates(empty, "k").collect() == []
    rows = X.with_surrogates(clashing(["a 97.51.17.173", None]), "k", keep=("doc_id", "key", "spans"), prefix="_").collect()
    assert sorted((r.doc_id, r._n_entities) for r in rows) == [(0, 1), (1, 0)]
    long_ = "word " * 200_000 + "97.51.17.173"
    assert len(X.entities(long_)) == 1


@pytest.mark.parametrize("title", ["Mr", "Mrs", "Ms", "Miss", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señora", "Señor", "Sra", "Sr"])
def test_each_title_alone(title):
    for name in (f"{title} García", f"{title}. García"):
        text = f"hoy vino {name} otra vez"
        assert [(text[s:e], k) for s, e, k in X.entities(text)] == [(name, "name")]


@pytest.mark.parametrize("number", ["01 23 45 67 89", "01.23.45.67.89", "+33 6 12 34 56 78", "+33 (0)6 12 34 56 78", "0033 6 12 34 56 78",
                                    "+34 612 34 56 78", "612 34 56 78", "91 234 56 78", "+34 91 234 56 78", "030/1234567", "089/12 34 56 78",
                                    "0171 123 45 67", "+49 171 123 45 67", "+49 (0)30 1234567", "+49 30/1234567", "(030) 123 4567",
                                    "+1 (017) 555-7713", "555-123-4567", "+4930123456"])
def test_each_phone_format_alone(number):
    text = f"call {number}, please"
    assert [(text[s:e], k) for s, e, k in X.entities(text)] == [(number, "phone")]
    s = X.in_format("phone", number, X.surrogate(KEY, "phone", X.canonical("phone", number)))
    assert s != number and [c for c in s if not c.isdigit()] == [c for c in number if not c.isdigit()]


def test_phone_neighbours():
    text = "tel +33 6 12 34 56 78 75001 Paris, 01 23 45 67 89 12 fois"
    assert [text[s:e] for s, e, _ in X.entities(text)] == ["+33 6 12 34 56 78", "01 23 45 67 89"]
    for clean in ("am 01.02.2024 um 12:30", "05/12/2024 10 30", "01-02-2024", "01.02.24 12.30", "0.123 4", "2024/12/31"):
        assert X.entities(clean) == []


def test_possessives_and_family_names_refer_to_one_person(spark):
    texts = ["Mr. John Smith came. Mr Smith's dog and MR. SMITH? Mr Smith left; Mrs Smith stayed.", "Mr Smith’s car", "Mr Smith"]
    rows = {r.doc_id: r.text for r in X.with_surrogates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").collect()}
    names = [rows[0][s:e] for s, e, _ in X.entities(rows[0])]
    full = names[0].split(" ")
    assert len(full) == 3 and names[1] == f"Mr {full[2]}" and f"{names[1]}'s dog" in rows[0] and f"Mr {full[2]} left" in rows[0]
    assert names[-1].startswith("Mrs ") and names[-1].split(" ")[1] != full[2]
    assert rows[1] == rows[2] + "’s car" and "Smith" not in "".join(rows.values()).replace("MR. SMITH", "")


def test_two_fuller_names_leave_the_family_name_alone():
    text = "Mr John Smith and Mr Paul Smith met Mr Smith"
    assert [x for _, x in X.named(text, X.entities(text))] == ["Mr John Smith", "Mr Paul Smith", "Mr Smith"]


@pytest.mark.parametrize("name, script", [("Господин Иванов", "cyrillic"), ("Госпожа Анна Иванова", "cyrillic"), ("Κύριος Παπαδόπουλος", "greek"),
                                          ("Prof. Müller", "latin"), ("Dr. Jane Roe", "latin")])
def test_names_keep_their_script(name, script):
    text = f"x {name} y"
    (s, e, kind), = X.entities(text)
    assert (text[s:e], kind) == (name, "name")
    new = X.in_format("name", name, X.surrogate(KEY, "name", X.canonical("name", name)))
    assert new != name and len(new.split()) == len(name.split()) and {X.script_of(w) for w in new.split()[1:]} == {script}


@pytest.mark.parametrize("address", ["2001:db8::ff00:42:8329", "2001:0db8:0000:0000:0000:ff00:0042:8329", "FE80::1:2:3"])
def test_ipv6(address):
    text = f"from {address}, ok"
    assert [(text[s:e], k) for s, e, k in X.entities(text)] == [(address, "ipv6")]
    assert X.canonical("ipv6", "2001:0DB8:0:0:0:FF00:42:8329") == X.canonical("ipv6", "2001:db8::ff00:42:8329")
    new = X.surrogate(KEY, "ipv6", X.canonical("ipv6", address))
    assert new.startswith("2001:db8:") and new != address


def test_numbers_that_are_no_phone():
    for clean in ("1000 2000 3000 units", "12:30:45", "a::b", "ratio 1:2:3", "12 345 6789"):
        assert X.entities(clean) == []


def test_generated_texts_keep_reference_and_distinctness(spark):
    """Brute force over random texts: one entity, one surrogate; two entities, two; formats stay; the rest of the text too."""
    import random
    r = random.Random(4)
    people = [f"{t} {g} {f}" for t, g in (("Mr", "John"), ("Mrs", "Jane"), ("Herr", "Karl")) for f in ("Stone", "Rivers", "O'Neil", "Großmann")]
    others = [f"user{i}@host{i % 3}.org" for i in range(8)] + [f"10.{i}.2.{i}" for i in range(8)] + [f"+1 (212) 555-{1000 + i}" for i in range(8)]
    texts = []
    for _ in range(80):
        picked = [r.choice(people + others) for _ in range(r.randrange(1, 6))]
        texts.append("begin " + "".join(f"{e}{r.choice([' ', ', ', '; '])}w{r.randrange(9)} " for e in picked) + "end")
    rows = {x.doc_id: x.text for x in X.with_surrogates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5), "k").collect()}
    seen = {}
    for i, t in enumerate(texts):
        old, new = X.entities(t), X.entities(rows[i])
        assert [k for *_, k in old] == [k for *_, k in new]
        for (_, entity), (s, e, k) in zip(X.named(t, old), new):
            assert seen.setdefault((k, entity), rows[i][s:e]) == rows[i][s:e]
        cut = lambda x, found: [x[a:b] for a, b in zip([0, *(e for _, e, _ in found)], [*(s for s, *_ in found), len(x)])]
        assert cut(t, old) == cut(rows[i], new)
    assert len(set(seen.values())) == len(seen) and not {v for v in seen.values()} & {e for _, e in seen}
