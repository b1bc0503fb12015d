"""Pseudonyms against a plain rendering of the same network."""

import hashlib
import re

import pytest

from rankstream.llm import pii

KEY = "k1"


def network(units, kind, key=KEY, rounds=pii.ROUNDS):
    cut = (len(units) + 1) // 2
    a, b = units[:cut], units[cut:]
    for r in range(1, rounds + 1):
        radices = ",".join(str(m) for _, m in a + b)
        seed = "|".join([key, kind, str(r), ",".join(str(v) for v, _ in b), radices])
        shifted = []
        for place, (v, m) in enumerate(a):
            digest = hashlib.sha256(f"{seed}#{place}".encode()).hexdigest()
            shifted.append(((v + int(digest[:12], 16)) % m, m))
        a, b = b, shifted
    return a + b


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def run(spark, texts, key=KEY):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in pii.pseudonymised(df, key=key, counts="n").orderBy("doc_id").collect()]


def test_addresses_follow_the_network(spark):
    out = run(spark, ["at 10.20.30.40 now"])[0].text
    want = ".".join(str(v) for v, _ in network([(10, 256), (20, 256), (30, 256), (40, 256)], "ipv4"))
    assert out == f"at {want} now"


def test_cards_follow_the_network(spark):
    out = run(spark, ["4111 1111-1111 1111"])[0].text
    digits = re.sub(r"\D", "", out)
    want = "".join(str(v) for v, _ in network([(int(c), 10) for c in "411111111111111"], "card"))
    assert digits[:-1] == want and luhn(digits)
    assert re.fullmatch(r"\d{4} \d{4}-\d{4} \d{4}", out)


def test_formats_and_validity(spark):
    texts = [
        "mail Ann.Lee9@Site7.example.com.", "born 1984-02-29, 29.02.1984", "ssn 123-45-6789",
        "iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432", "+1 (017) 555-7713 x",
        'token = "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e"', "TOKEN = 9233A8ECF7C5B09FE594971",
    ]
    found = run(spark, texts)
    assert [sum(r.n.values()) for r in found] == [1, 2, 1, 2, 1, 1, 1]
    for before, row in zip(texts, found):
        assert row.text != before
        shape = lambda t: re.sub(r"[A-Za-z]", "a", re.sub(r"\d", "9", t))
        if "oken" not in before and "OKEN" not in before:
            assert shape(row.text) == shape(before)
        assert len(row.text) == len(before)
    again = run(spark, [r.text for r in found])  # pseudonyms are valid values themselves
    assert [r.n for r in again] == [r.n for r in found]


def test_equal_values_stay_linked_and_keys_matter(spark):
    a, b = (r.text for r in run(spark, ["x 4111111111111111 y", "4111-1111-1111-1111"]))
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b)
    assert run(spark, ["10.20.30.40"])[0].text != run(spark, ["10.20.30.40"], "k2")[0].text


@pytest.mark.parametrize(
    "text",
    ["9807915762804490", "1111111111111111" * 2, "999.1.2.3", "01.2.3.4", "1.2.3.4.5", "v1.2.3",
     "1983-02-29", "2024-13-01", "666-12-3456", "900-12-3456", "123-00-6789", "DE88370400440532013000",
     "+123", "a@b", "only words", "CC BY-NC 4.0.", "", "page 12, line 345-6789"],
)
def test_other_text_is_left_alone(spark, text):
    assert run(spark, [text])[0].text == text


def test_permutations_are_one_to_one(spark):
    days = spark.range(3000).selectExpr("id doc_id", "cast(date_add('1990-01-01', int(id)) as string) text")
    out = [r.text for r in pii.pseudonymised(days, key=KEY).collect()]
    assert len(set(out)) == 3000 and all(re.fullmatch(r"\d{4}-\d{2}-\d{2}", t) for t in out)
    ssns = spark.range(3000).selectExpr("id doc_id", "format_string('%03d-%02d-%04d', 1 + id % 600, 1 + id % 99, id + 1) text")
    out = [r.text for r in pii.pseudonymised(ssns, key=KEY).collect()]
    assert len(set(out)) == 3000
    assert not any(t.startswith(("000", "666", "9")) for t in out)


def test_nulls_clashes_long_texts_and_plans(spark):
    rows = [(None, None, "g", "f"), (1, "", None, None), (2, "w " * 300_000 + "10.20.30.40", "a", "b"),
            (2, "a" * 300_000, "a", "b"), (3, "10.20.30.40 " * 500, "", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, gaps string, found string")
    made = pii.pseudonymised(df)
    assert made.columns == df.columns
    out = made.collect()
    assert out[0].text is None and out[1].text == "" and len(out[3].text) == 300_000
    assert out[2].text.endswith(out[4].text.split(" ")[0]) and len(set(out[4].text.split())) == 1
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert pii.pseudonymised(df.limit(0)).collect() == []


VALUES = {
    "email": "ann@site.example", "iban": "DE89 3704 0044 0532 0130 00", "iban ": "BE68 5390 0754 7034",
    "phone": "+1 (826) 555-4081", "ipv4": "190.137.223.204", "date": "1984-02-29",
    "ssn": "123-45-6789", "card": "4111111111111111", "card ": "4111 1111 1111 1111",
}


def test_adjacent_values_of_every_two_kinds(spark):
    pairs = [(a, b) for a in VALUES for b in VALUES]
    found = run(spark, [f"{VALUES[a]} {VALUES[b]}" for a, b in pairs])
    bad = []
    for (a, b), row in zip(pairs, found):
        want = {k: 0 for k in pii.KINDS}
        for kind in (a, b):
            want[kind.strip()] += 1
        if row.n != want or VALUES[a] in row.text or VALUES[b] in row.text:
            bad.append((a, b, row.text))
    assert not bad


def test_values_beside_other_numbers(spark):
    cards = ["4111111111111111 123", "12 4111111111111111", "77 4111 1111 1111 1111 2024",
             "123 456 4111 1111 1111 1111", "+1 4111111111111111", "41111 11111 11111 1 22222222"]
    others = ["77777 123-45-6789", "+49 170.123.45.67", "GB82WEST12345698765432 1234"]
    found = run(spark, cards + others)
    assert [r.n["card"] for r in found] == [1] * len(cards) + [0] * len(others)
    assert [sum(r.n.values()) for r in found] == [1] * len(found)
    assert found[0].text.endswith(" 123") and found[1].text.startswith("12 ")
    assert found[2].text.startswith("77 ") and found[2].text.endswith(" 2024")


def test_control_characters_stay(spark):
    """The characters that mark matches may be in the text, beside values or alone."""
    card, mark = "4111111111111111", [chr(i) for i in range(1, 6)]
    texts = [f"{a}{b}{card}{b}{a} a@b.org{a}{b}" for a in mark for b in mark]
    texts += ["".join(mark) * 3, "".join(mark) + " 1", "x\u0001\u00034111", f"\u0002{card}", card * 2]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(pii.pseudonymised(df).select("doc_id", "text").collect())
    whole = spark.createDataFrame([(0, f" {card}  a@b.org ")], "doc_id long, text string")
    other, mail = pii.pseudonymised(whole).first().text.split()
    for number, text in rows:
        want = text if text == card * 2 else text.replace(card, other).replace("a@b.org", mail)
        assert got[number] == want
