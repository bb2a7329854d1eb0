import datetime as dt
import hashlib
import re

from pyspark.sql import functions as F

from millrace.llm import pseudonyms

from .helpers import frame, odd_rows, rng

KEY = "k"
VALID = {
    "card": ["4041894974608795", "4111 1111 1111 1111", "3782-822463-10005"], "ssn": ["123-45-6789", "899-99-9999", "665-01-0001"], "phone": ["+1 (988) 555-2485", "212-555-0199", "(136) 555-1234", "212.155.0000"],
    "ip": ["42.144.35.254", "0.0.0.0", "255.255.255.255"], "date": ["2020-02-29", "1999/12/31", "24.12.1985", "02/28/2021", "1900-01-01", "2099-12-31"], "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"], "email": ["bosbt.42@mail8.example.com", "a@b.co"],
}
INVALID = ["4111111111111112", "000-12-3456", "666-12-3456", "123-00-4567", "999.1.1.1", "1.2.3.4.5", "2020-13-01", "2021-02-29", "DE88370400440532013000", "4.0.3", "12345", "@", "a@b", "1899-12-31"]


def rounds(left, right, a, b, tweak):
    """The Feistel network, written anew."""
    for i in range(pseudonyms.ROUNDS):
        other = right if i % 2 == 0 else left
        f = int(hashlib.sha256(f"{KEY}|{tweak}|{i}|{other}".encode()).hexdigest()[:15], 16)
        left, right = ((left + f % a) % a, right) if i % 2 == 0 else (left, (right + f % b) % b)
    return left, right


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += (d * 2 - 9 if d > 4 else d * 2) if i % 2 else d
    return total % 10 == 0


def run(spark, texts, back=False):
    out = pseudonyms.pseudonymise(frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]), KEY, back=back)
    return {r["doc_id"]: r for r in out.collect()}


def test_formats_and_validity(spark):
    cases = [(k, v) for k, vs in VALID.items() for v in vs]
    out = run(spark, [f"see {v} there" for _, v in cases])
    for i, (kind, value) in enumerate(cases):
        new = out[i]["text"].removeprefix("see ").removesuffix(" there")
        assert out[i][f"n_{kind}"] == 1 and sum(out[i][f"n_{k}"] for k in pseudonyms.KINDS) == 1
        assert new != value and re.sub(r"[0-9]", "9", re.sub("[A-Z]", "A", re.sub("[a-z]", "a", new))) == re.sub(r"[0-9]", "9", re.sub("[A-Z]", "A", re.sub("[a-z]", "a", value))) or kind == "ip"
        digits = re.sub(r"\D", "", new)
        if kind == "card":
            assert luhn(digits) and new[0] == value[0]
        if kind == "iban":
            s = new.replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1 and s[:2] == value[:2]
        if kind == "ssn":
            assert 0 < int(digits[:3]) < 900 and digits[:3] != "666" and digits[3:5] != "00" and digits[5:] != "0000"


def test_values_by_a_second_implementation(spark):
    out = run(spark, ["ip 42.144.35.254.", "on 2020-02-29", "ssn 123-45-6789"])
    a, b = rounds(42 * 256 + 144, 35 * 256 + 254, 65536, 65536, "ip")
    assert f"{a // 256}.{a % 256}.{b // 256}.{b % 256}" in out[0]["text"]
    n = (dt.date(2020, 2, 29) - dt.date(1900, 1, 1)).days
    a, b = rounds(n // 4297, n % 4297, 17, 4297, "date")
    assert str(dt.date(1900, 1, 1) + dt.timedelta(a * 4297 + b)) in out[1]["text"]
    a, b = rounds(122, 44 * 9999 + 6788, 898, 99 * 9999, "ssn")
    assert f"{a + (2 if a >= 665 else 1):03}-{b // 9999 + 1:02}-{b % 9999 + 1:04}" in out[2]["text"]


def test_invalid_values_stay(spark):
    texts = [f"x {v} y" for v in INVALID]
    out = run(spark, texts)
    assert [out[i]["text"] for i in range(len(texts))] == texts


def test_equal_values_stay_linked_and_the_key_undoes_it(spark):
    texts = [f"{a} and {b}, again {a}" for a in VALID["phone"] + VALID["email"] for b in VALID["card"] + VALID["date"] + VALID["iban"]]
    out = run(spark, texts)
    new = [out[i]["text"] for i in range(len(texts))]
    for t in new:
        first, _, rest = t.partition(" and ")
        assert rest.endswith(f"again {first}")
    assert [r["text"] for _, r in sorted(run(spark, new, back=True).items())] == texts


def test_permutation_of_a_small_domain(spark):
    n = spark.range(7 * 11).select(pseudonyms.permute(F.floor(F.col("id") / 11), F.col("id") % 11, 7, 11, KEY, "t").alias("p"))
    assert n.select("p").distinct().count() == 77
    assert {(r["p"]["l"], r["p"]["r"]) for r in n.collect()} == {(a, b) for a in range(7) for b in range(11)}


def test_odd_rows(spark):
    rows = odd_rows(rng()) + [(70, "9" * 200_000, "en", "a"), (71, "a" * 100_000 + "@", "en", "a")]
    docs = frame(spark, rows)
    out = pseudonyms.pseudonymise(docs, KEY)
    assert sorted(map(repr, (r["text"] for r in out.collect()))) == sorted(map(repr, (r[1] for r in rows)))
    assert out.columns == [*docs.columns, *[f"n_{k}" for k in pseudonyms.KINDS]]
    assert pseudonyms.pseudonymise(docs.limit(0), KEY).count() == 0


def test_values_next_to_other_digits(spark):
    card = "4111 1111 1111 1111"
    cases = [
        (f"{card} 12/25", {"card": 1}), (f"{card} 123", {"card": 1}), (f"2024 {card}", {"card": 1}), (f"62704 {card}", {"card": 1}), (f"{card} 10.0.0.1", {"card": 1, "ip": 1}),
        ("217-555-0123 217-555-0124", {"phone": 2}), ("62704 217-555-0123", {"phone": 1}), ("1987 123-45-6789", {"ssn": 1}), (f"{card}-217-555-0123", {"card": 1, "phone": 1}),
        ("217-555-0123-123-45-6789", {"phone": 1, "ssn": 1}), (f"{card} {card}", {"card": 2}), ("BE68 5390 0754 7034 2024", {"iban": 1}), ("PO12 3456 7890 DE89 3704 0044 0532 0130 00", {"iban": 1}),
        ("DE88 3704 0044 217 555 0123", {"phone": 1}), ("﷐ 217-555-0123 ﷑﷑", {"phone": 1}),
    ]
    out = run(spark, [t for t, _ in cases])
    for i, (text, want) in enumerate(cases):
        assert {k: out[i][f"n_{k}"] for k in pseudonyms.KINDS if out[i][f"n_{k}"]} == want, text
        for value in (card, "217-555-0123", "217-555-0124", "123-45-6789", "10.0.0.1", "5390 0754 7034", "3704 0044 0532"):
            assert value not in out[i]["text"]
        for c in "﷐﷑":
            assert out[i]["text"].count(c) == text.count(c)
    assert out[0]["text"].endswith(" 12/25") and out[2]["text"].startswith("2024 ")
