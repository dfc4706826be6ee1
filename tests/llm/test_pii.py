"""Detection, consistent and distinct surrogates, clean texts untouched."""

import re

import pyarrow.parquet as pq
import pytest

from shelfline.llm import pii

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize(("text", "want"), [
    ("mail thwhhe.68@mail2.example.com### now", [("EMAIL", "thwhhe.68@mail2.example.com")]),
    ("A.B@X.ORG.", [("EMAIL", "a.b@x.org")]),
    ("call +1 (663) 555-6869 or (663) 555-6869.", [("PHONE", "6635556869"), ("PHONE", "6635556869")]),
    ("+49 30 1234567 x", [("PHONE", "49301234567")]),
    ("at 233.233.171.252, or 1.2.3.4.", [("IP", "233.233.171.252"), ("IP", "1.2.3.4")]),
    ("card 4316522678525456 and 4111-1111-1111-1111", [("CARD", "4316522678525456"), ("CARD", "4111111111111111")]),
    ('token = "11acdfb36bb72224148e6160f674b4be45601bff"###', [("SECRET", "11acdfb36bb72224148e6160f674b4be45601bff")]),
    ("2321bac4d15ec8f90433955bf9d3cf61da5bdd1e", [("SECRET", "2321bac4d15ec8f90433955bf9d3cf61da5bdd1e")]),
    ("ssn 123-45-6789", [("SSN", "123-45-6789".replace("-", ""))]),
    ("GB82 WEST 1234 5698 7654 32", [("IBAN", "GB82WEST12345698765432")]),
    ("Mrs. Anna Smith met Smith; Mr Lee", [("GIVEN_F", "anna"), ("SURNAME", "smith"), ("SURNAME", "smith"), ("SURNAME", "lee")]),
    ("госпожа Иванова", [("SURNAME", "иванова")]),
    ("", []), ("plain words, 825 of 1234567 and 1.2.3, v1.2.3.4.5 a@b x=y 12:30", []),
    ("no card: 4316522678525457 1700000000000 1234-5678-9012-3456", []), ("CC12 3456 7890 1234 5678", []),
    ("Mr fox, dr who", []), ("x" * 200_000, []), ("a." * 50_000, []), ("1" * 50, []),
])
def test_find(text, want):
    assert [(k, n) for _, _, k, n in pii.find(text)] == want


ROWS = [
    (1, "hein.19@mail5.example.com and +1 (323) 555-9830, HEIN.19@MAIL5.EXAMPLE.COM"),
    (2, "again hein.19@mail5.example.com; (323) 555-9830; other.19@mail5.example.com"),
    (None, "card 4111111111111111 ip 84.93.123.184"), (None, "card 4111111111111111 ip 84.93.123.184"),
    (3, "nothing here"), (4, None), (5, ""), (6, "Mrs Anna Smith and Mr Tom Smith, Smith. Frau Müller"),
    (7, 'token = "11acdfb36bb72224148e6160f674b4be45601bff"!!'), (8, "GB82 WEST 1234 5698 7654 32 123-45-6789"),
]


def test_replace(frame):
    made = pii.replace(frame([(*r, 1) for r in ROWS], SCHEMA + ", entities int"))
    out = made.collect()
    assert len(out) == len(ROWS)
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert (by[3].text, by[4].text, by[5].text) == ("nothing here", None, "")
    first, second = by[1]["entities"], by[2]["entities"]
    # One entity, one surrogate, in each mention's own format.
    assert first[0].surrogate == second[0].surrogate
    assert first[2].surrogate == first[0].surrogate.upper()
    assert first[1].surrogate[3:] == second[1].surrogate
    assert first[1].surrogate.startswith("+1 (")
    assert second[2].surrogate != second[0].surrogate
    assert second[2].surrogate.split("@")[1] == second[0].surrogate.split("@")[1]  # same host
    private = ["hein", "555-9830", "4111111111111111", "84.93.123.184", "Smith", "Müller", "11acdfb36", "123-45-6789", "5698"]
    assert not any(p in (r.text or "") for r in out for p in private)
    for r in out:
        source = next(t for d, t in ROWS if d == r.doc_id)
        back = r.text
        for e in reversed(r["entities"]):
            assert source[e.start: e.end] != e.surrogate
            assert e.surrogate in back
    twins = [r.text for r in out if r.doc_id is None]
    assert twins[0] == twins[1]
    card = next(e.surrogate for e in next(r for r in out if r.doc_id is None)["entities"] if e.type == "CARD")
    assert pii.luhn(card)
    assert card[0] == "4"
    names = by[6]["entities"]
    assert names[1].surrogate == names[3].surrogate == names[4].surrogate
    assert names[0].surrogate[-1] == "a"
    assert pii.replace(frame(ROWS, SCHEMA), key="other").filter("doc_id = 1").first().text != by[1].text


def test_collisions_are_drawn_again(spark, monkeypatch):
    """A generator with few values still gives every entity its own."""
    entities = spark.createDataFrame([("SSN", f"{i:09d}") for i in range(40)] + [("SSN", "000000001")], "type string, norm string")

    def few(key, kind, norm, attempt):
        return f"{pii.Draw(key, kind, norm, attempt).below(200):09d}"

    monkeypatch.setattr(pii, "surrogate", few)
    rows = pii.assign(entities).collect()
    assert len(rows) == 40
    assert len({r.surrogate for r in rows}) == 40
    assert not {r.surrogate for r in rows} & {r.norm for r in rows}


@pytest.mark.parametrize("kind", ["EMAIL", "PHONE", "CARD", "SSN", "IP", "IBAN", "SECRET", "SURNAME", "GIVEN_F", "GIVEN_M"])
def test_surrogates_are_found_as_their_own_type(kind):
    norm = {"EMAIL": "a.b1@c-d.example.org", "PHONE": "6635556869", "CARD": "4111111111111111", "SSN": "123456789",
            "IP": "10.20.30.40", "IBAN": "GB82WEST12345698765432", "SECRET": "11acdfb36bb72224148e6160f674b4be45601bff"}.get(kind, "anna")
    made = pii.surrogate("k", kind, norm, 0)
    assert made == pii.surrogate("k", kind, norm, 0) != pii.surrogate("k", kind, norm, 1)
    if kind in ("EMAIL", "CARD", "IP", "IBAN", "SECRET"):
        assert [(k, n) for _, _, k, n in pii.find(f"x {made} y")] == [(kind, made)]
    if kind == "IBAN":
        assert pii._iban_ok(made)


def test_empty_table(spark):
    assert pii.replace(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(("text", "want"), [
    ("+1 (826) 555-4081 190.137.223.204", [("PHONE", "8265554081"), ("IP", "190.137.223.204")]),
    ("+1 (843) 555-7672 170.106.47.218", [("PHONE", "8435557672"), ("IP", "170.106.47.218")]),
    ("+1 (663) 555-6869 123456", [("PHONE", "6635556869")]),
    ("+1 (663) 555-6869 2024; +1 663 555 6869 2024; +16635556869 2024", [("PHONE", "6635556869")] * 3),
    ("+49 30 1234567 2024, +49 30 1234567 123456, +49 (30) 123-4567 2024", [("PHONE", "49301234567")] * 3),
    ("+44 20 7946 0958 2024, +44 20 7946 0958", [("PHONE", "442079460958")] * 2),
    ("+48 601 123 456 2024 +33 1 23 45 67 89 2024", [("PHONE", "48601123456"), ("PHONE", "33123456789")]),
    ("+49 30 190.137.223.204", [("IP", "190.137.223.204")]), ("+49 30.123.45.67", [("PHONE", "49301234567")]),
    ("+359 88 812 3456 1.2.3.4", [("PHONE", "359888123456"), ("IP", "1.2.3.4")]),
    ("+49 30 123 456 4111 1111 1111 1111", [("PHONE", "4930123456"), ("CARD", "4111111111111111")]),
    ("+1 (663) 555-6869 2321bac4d15ec8f90433955bf9d3cf61da5bdd1e",
     [("PHONE", "6635556869"), ("SECRET", "2321bac4d15ec8f90433955bf9d3cf61da5bdd1e")]),
    ("+1 (663) 555-6869 12ab@x.org", [("PHONE", "6635556869"), ("EMAIL", "12ab@x.org")]),
    ("1234 4111 1111 1111 1111", [("CARD", "4111111111111111")]), ("+4111111111111111", [("CARD", "4111111111111111")]),
])
def test_numbers_that_follow_a_number(text, want):
    assert [(k, n) for _, _, k, n in pii.find(text)] == want


def test_planted_values_are_found():
    """Phones and IP addresses of the documents, searched for by patterns of their own."""
    own = {"PHONE": re.compile(r"\+1 \(\d{3}\) 555-\d{4}"), "IP": re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]*\d)")}
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"]).column(0).to_pylist()
    planted = 0
    for t in filter(None, texts):
        want = {(*m.span(), k) for k, p in own.items() for m in p.finditer(t)}
        if want:
            planted += len(want)
            assert want <= {x[:3] for x in pii.find(t)}, t
    assert planted > 300


@pytest.mark.parametrize(("text", "want"), [
    ("ES9121000418450200051332 EUR 50", ["ES9121000418450200051332"]),
    ("ES91 2100 0418 4502 0005 1332 THEN", ["ES9121000418450200051332"]),
    ("BE68 5390 0754 7034 OK", ["BE68539007547034"]), ("AT611904300234573201 BIC X", ["AT611904300234573201"]),
    ("ES91 2100 0418 4502 0005 1332 THEN MORE WORDS", ["ES9121000418450200051332"]),
    ("NO93 8601 1117 947 NOK", ["NO9386011117947"]),
    ("REF AB12 GB82 WEST 1234 5698 7654 32 EUR", ["GB82WEST12345698765432"]),
    ("DE89 3704 0044 0532 0130 00 AND FR1420041010050500013M02606 BIC", ["DE89370400440532013000", "FR1420041010050500013M02606"]),
    ("ES91 2100 0418 4502 0005 1333 THEN", []),
])
def test_account_numbers_before_words(text, want):
    found = pii.find(text)
    assert [(k, n) for _, _, k, n in found] == [("IBAN", w) for w in want]
    assert [text[a:b].replace(" ", "") for a, b, _, _ in found] == want


@pytest.mark.parametrize(("text", "want"), [
    ("My name is John Smith and I met Smith. JOHN", [("GIVEN_N", "john"), ("SURNAME", "smith"), ("SURNAME", "smith")]),
    ("my name is Anna, not Hanna", [("GIVEN_N", "anna")]), ("my name is legion", []), ("My name is Dr. Lee", [("SURNAME", "lee")]),
    ("Меня зовут Анна Иванова", [("GIVEN_N", "анна"), ("SURNAME", "иванова")]), ("dummy name is Foo", []),
    ("from 2001:db8::8a2e:370:7334, or 2001:0DB8:0000:0000:0000:8A2E:0370:7334.", [("IP", "2001:db8::8a2e:370:7334")] * 2),
    ("fe80::1%eth0 [2001:db8:0:1:1:1:1:1]:80", [("IP", "fe80::1"), ("IP", "2001:db8:0:1:1:1:1:1")]),
    ("std::vector face::bad 12:30:45 100:20:30 a::1 1234:5678 aaa::bbb::1 2001:db8:1", []),
])
def test_own_names_and_long_addresses(text, want):
    assert [(k, n) for _, _, k, n in pii.find(text)] == want


def test_address_formats():
    """Spellings of one address stay spellings of one surrogate."""
    made = pii.surrogate("k", "IP", "2001:db8::8a2e:370:7334", 0)
    assert pii.find(made) == [(0, len(made), "IP", made)]
    full = pii.render("2001:0DB8:0000:0000:0000:8A2E:0370:7334", "IP", made)
    assert len(full) == 39
    assert full == full.upper()
    for surface in ("2001:db8::8a2e:370:7334", "2001:db8:0:0:0:8a2e:370:7334"):
        put = pii.render(surface, "IP", made)
        assert [n for *_, n in pii.find(put)] == [n for *_, n in pii.find(full)] == [made]
        assert [bool(g) for g in put.split(":")] == [bool(g) for g in surface.split(":")]


@pytest.mark.parametrize(("kind", "norm", "surface"), [
    ("EMAIL", "a@b.org", "A@B.org"), ("PHONE", "6635556869", "+1 (663) 555-6869"), ("PHONE", "6635556869", "(663) 555-6869"),
    ("CARD", "4111111111111111", "4111 1111 1111 1111"), ("SSN", "123456789", "123-45-6789"), ("IP", "10.20.30.40", "10.20.30.40"),
    ("IP", "fe80::1", "FE80::1"), ("IBAN", "GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32"), ("SECRET", "ab12cd34", "ab12cd34"),
    ("SECRET", "Zz-12345678", "Zz-12345678"), ("SURNAME", "lee", "Lee"),
])
def test_late_draws_are_longer(kind, norm, surface):
    """Beyond the draws of its own length a format gets room: nothing is cut, all digits are written."""
    few, many = (pii.surrogate("k", kind, norm, a) for a in (pii.SAME_LENGTH_DRAWS - 1, pii.SAME_LENGTH_DRAWS + 4))
    assert kind == "SURNAME" or kind == "IP" or len(few) == len(norm)
    assert len(many) > len(norm)
    put = pii.render(surface, kind, many)
    if kind in ("CARD", "PHONE", "SSN"):
        assert re.sub(r"\D", "", put).endswith(many)
        assert kind != "CARD" or pii.luhn(many)
    else:
        assert put.replace(" ", "").lower() == many.lower()
    assert kind != "IBAN" or pii._iban_ok(many)


def test_crowded_format(spark, monkeypatch):
    """Every value of a format is a real entity: all still get distinct surrogates that are no entities."""
    monkeypatch.setattr(pii, "SAME_LENGTH_DRAWS", 2)
    entities = spark.createDataFrame([("SSN", f"{i:02d}") for i in range(100)], "type string, norm string")
    rows = pii.assign(entities, "k").collect()
    assert len(rows) == 100 == len({r.surrogate for r in rows})
    assert not {r.surrogate for r in rows} & {r.norm for r in rows}


def test_key_of_the_session(frame, spark):
    """Without a key one is drawn and kept in the session; a set one gives the same surrogates again."""
    spark.conf.unset(pii.KEY_SETTING)
    try:
        text = lambda **k: pii.replace(frame(ROWS, SCHEMA), **k).filter("doc_id = 1").first().text
        first = text()
        drawn = spark.conf.get(pii.KEY_SETTING)
        assert len(drawn) == 64
        assert text() == first == text(key=drawn)
        spark.conf.set(pii.KEY_SETTING, "another")
        assert text() == text(key="another") != first
    finally:
        spark.conf.unset(pii.KEY_SETTING)
