from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from answerclock.llm import pseudonyms as pseudo
from tests.llm.helpers import AWKWARD

CIPHER = pseudo.Feistel(b"key")


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 4096])
def test_it_is_a_permutation(size):
    assert sorted(CIPHER.permuted(i, size, "x") for i in range(size)) == list(range(size))


def test_valid_dates_and_cards_stay_so_one_to_one():
    cards = [f"400000000000{i:03d}" for i in range(200)]
    cards = [c + pseudo.luhn_digit(c) for c in cards]
    new = {pseudo.pseudonymised(CIPHER, c)[0] for c in cards}
    assert len(new) == len(cards) and all(pseudo.luhn_digit(c[:-1]) == c[-1] for c in new)
    dates = [f"19{y:02d}-0{m}-1{d}" for y in range(50, 60) for m in range(1, 10) for d in range(10)]
    changed = {pseudo.pseudonymised(CIPHER, d)[0] for d in dates}
    assert len(changed) == len(dates)
    assert all(re.fullmatch(r"(19|20)\d\d-\d\d-\d\d", d) for d in changed)


VALUES = {
    "email": "jo.doe+x@mail7.example.com",
    "iban": "DE89 3704 0044 0532 0130 00",
    "date": "31/12/1999",
    "ip": "97.51.17.173",
    "ssn": "123-45-6789",
    "card": "4111 1111 1111 1111",
    "phone": "+1 (017) 555-7713",
}


@pytest.mark.parametrize("kind", VALUES)
def test_every_kind_keeps_its_format(kind):
    value = VALUES[kind]
    text, spans = pseudo.pseudonymised(CIPHER, f"é {value}, and")
    new = text[2:-5]
    assert spans == [(2, 2 + len(value), kind)]
    assert new != value and len(new) == len(value)
    assert re.sub(r"[A-Za-z]", "a", re.sub(r"\d", "9", new)) == re.sub(r"[A-Za-z]", "a", re.sub(r"\d", "9", value))
    assert pseudo.pseudonymised(CIPHER, new)[1][0][2] == kind  # still valid


def test_equal_values_stay_linked():
    plain = pseudo.pseudonymised(CIPHER, "x 4111111111111111 y")[0].split()[1]
    spaced = pseudo.pseudonymised(CIPHER, "4111 1111 1111 1111")[0].replace(" ", "")
    other = pseudo.pseudonymised(pseudo.Feistel(b"other"), "4111111111111111")[0]
    assert plain == spaced != other


@pytest.mark.parametrize("text", ["version 3.", "4.0.", "256.1.1.1", "1.2.3", "2024-13-45", "call 12345", "a@b"])
def test_other_numbers_stay(text):
    assert pseudo.pseudonymised(CIPHER, text) == (text, [])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1 2.3-@+()45/6", max_size=60))
def test_any_text_keeps_its_length_and_what_lies_outside(text):
    new, spans = pseudo.pseudonymised(CIPHER, text)
    assert len(new) == len(text)
    inside = {i for a, b, _ in spans for i in range(a, b)}
    assert all(new[i] == text[i] for i in range(len(text)) if i not in inside)


def test_over_a_table(spark, no_docs):
    rng = random.Random(1)
    rows = [(i, f"w {rng.choice(list(VALUES.values()))} v", 1) for i in range(50)]
    rows += [(100 + i, t, 2) for i, t in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = {r.doc_id: r for r in pseudo.digest(pseudo.pseudonymise(df, "key")).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        want = pseudo.pseudonymised(CIPHER, text) if text else (text, [])
        assert (got[i].text, got[i].n_spans) == (want[0], len(want[1]))
        assert not any(v in (got[i].text or "") for v in VALUES.values())
    assert pseudo.pseudonymise(no_docs, "key").count() == 0


@pytest.mark.parametrize(
    ("kind", "value"),
    [("phone", p) for p in (
        "+44 7911 123456", "+49 151 12345678", "+49 1512 34567890", "+33 6 12 34 56 78", "01 23 45 67 89",
        "01.23.45.67.89", "07911 123456", "5551234567", "98765 43210", "+44 (0)20 7946 0958")]
    + [("date", d) for d in ("1/2/2020", "2020/01/02", "2020-1-12", "31-12-1850", "1850-02-28", "2150-01-01", "12/31/1999")]
    + [("ip", a) for a in ("2001:db8::8a2e:370:7334", "FE80::1", "2001:0db8:85a3:0000:0000:8a2e:0370:7334")],
)
def test_wider_shapes_are_replaced(kind, value):
    new, spans = pseudo.pseudonymised(CIPHER, f"é {value}. 12 b")
    assert spans == [(2, 2 + len(value), kind)] and new[2:-6] != value
    assert pseudo.pseudonymised(CIPHER, new)[1] == spans


@pytest.mark.parametrize("text", ["std::vector a::b", "at 10:20:30 on", "00:1a:2b:3c:4d:5e", "::1", "1600000000"])
def test_other_runs_stay(text):
    assert pseudo.pseudonymised(CIPHER, text) == (text, [])


@pytest.mark.parametrize("after", [" BIC COBADEFF", " 2024 4111", " DE89 3704 0044 0532 0130 00"])
def test_an_iban_ends_at_its_length(after):
    value = VALUES["iban"]
    new, spans = pseudo.pseudonymised(CIPHER, f"AB12 {value}{after}")
    assert spans[0] == (5, 5 + len(value), "iban") and len(new) == 5 + len(value) + len(after)
    assert len(spans) == (2 if "DE" in after and "BIC" not in after else 1)


def test_equal_values_in_other_shapes_stay_linked():
    plain = lambda x: pseudo.pseudonymised(CIPHER, x)[0]
    digits = lambda x: re.sub(r"\D", "", plain(x))
    assert digits("+15551234567") == digits("+1 555 123 4567") == digits("+1 (555) 123-4567")
    assert digits("5551234567") == digits("555-123-4567")
    assert plain("1999-12-31").split("-")[::-1] == plain("31/12/1999").split("/")
    year, month, day = map(int, plain("2020-02-01").split("-"))
    assert list(map(int, plain("1/2/2020").split("/"))) == [day, month, year]
    assert plain("12/31/1999") == "/".join(plain("1999-12-31").split("-")[i] for i in (1, 2, 0))
    assert plain("+1 555 123 4567 300 x")[15:] == " 300 x"
