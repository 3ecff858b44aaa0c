"""Values beside others, in every form, with any characters: replaced, linked, undone."""

import random

import pytest
from test_operators import table

from lanewise.llm import pseudonyms

KEY = b"a key for tests only"
THERE, BACK = pseudonyms.Pseudonyms(KEY), pseudonyms.Pseudonyms(KEY, back=True)


def made(text):
    new, found = THERE.replace(text)
    return new, [f["kind"] for f in found]


def test_letters_that_grow_in_lower_case(spark):
    """The dotted I has two characters in lower case; it stays, and nothing ends the job."""
    texts = ["write to aİb@example.com now", "İstanbul@example.com", "xß9@example.org", "K1@example.org"]
    out = pseudonyms.pseudonymise(table(spark, texts), KEY)
    got = {r.doc_id: r.text for r in out.collect()}
    assert all(len(got[i]) == len(t) for i, t in enumerate(texts)) and got[0] != texts[0] and "İ" in got[0]
    back = pseudonyms.pseudonymise(out.drop("pii"), KEY, back=True)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts))


@pytest.mark.parametrize(
    "text,card",
    [
        ("qty 1 4111 1111 1111 1111", "4111 1111 1111 1111"),
        ("20 4111111111111111", "4111111111111111"),
        ("4111-1111-1111-1111 12 345", "4111-1111-1111-1111"),
        ("1 2 3 4111111111111111 5500005555555559", "4111111111111111"),
    ],
)
def test_cards_beside_other_numbers(text, card):
    new, kinds = made(text)
    assert card not in new and set(kinds) == {"card"} and len(new) == len(text)
    assert new[: text.index(card)] == text[: text.index(card)]
    assert THERE.replace(f"pay {card}.")[0][4:-1] in new
    assert BACK.replace(new)[0] == text


def test_values_beside_numbers_that_are_no_card():
    new, kinds = made("1234567 2020-12-31 99 5551234")
    assert kinds == ["date"] and new.startswith("1234567 ") and "2020-12-31" not in new
    assert made("12345678901234567890123") == ("12345678901234567890123", [])


def test_equal_dates_stay_linked():
    rng = random.Random(1)
    for _ in range(300):
        y, m, d = rng.randint(1900, 2099), rng.randint(1, 12), rng.randint(1, 28)
        wanted = THERE.replace(f"{y}-{m:02}-{d:02}")[0].split("-")
        forms = [f"{d:02}.{m:02}.{y}", f"{m:02}/{d:02}/{y}"] + [f"{d:02}/{m:02}/{y}"] * (d > 12)
        for form in forms:
            new = THERE.replace(form)[0]
            sign = "." if "." in new else "/"
            parts = new.split(sign)
            if len(parts[0]) == 4:
                found = parts
            elif sign == "." or int(parts[0]) > 12:
                found = parts[::-1]
            else:
                found = [parts[2], parts[0], parts[1]]
            assert found == wanted, (form, new)


def test_digits_stay_digits_and_letters_letters():
    for text in ("password=123456789012", "token: abc123def456", "secret=ABCdef123456gh", "api_key=deadbeef0000"):
        new, kinds = made(text)
        value, other = text.split("=")[-1].split(": ")[-1], new.split("=")[-1].split(": ")[-1]
        assert kinds == ["secret"] and value != other
        assert [(c.isdigit(), c.isupper()) for c in value] == [(c.isdigit(), c.isupper()) for c in other]


def card(rng):
    payload = "".join(rng.choice("0123456789") for _ in range(rng.randint(12, 18)))
    return payload + pseudonyms.luhn_digit(payload)


def iban(rng):
    account = "".join(rng.choice("0123456789ABCXYZ") for _ in range(16))
    return f"DE{98 - pseudonyms._mod97(account + 'DE00'):02d}{account}"


KINDS = {
    "card": card,
    "iban": iban,
    "ip": lambda rng: ".".join(str(rng.randrange(256)) for _ in range(4)),
    "date": lambda rng: f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
    "social": lambda rng: f"{rng.randint(1, 665):03}-{rng.randint(1, 99):02}-{rng.randint(1, 9999):04}",
    "phone": lambda rng: f"+49 {rng.randint(100, 999)} {rng.randint(10**6, 10**7)}",
    "email": lambda rng: "".join(rng.choice("abcXYZ019._é") for _ in range(6)).join(("q", "q@mail.example")),
    "secret": lambda rng: "token=" + "".join(rng.choice("abcdefghp0123456789XYZ") for _ in range(12)),
}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_round_trip(kind):
    """Many values of each kind: back again, different ones different."""
    rng = random.Random(kind)
    values = {KINDS[kind](rng) for _ in range(12_500)}
    new = {}
    for value in values:
        text, found = THERE.replace(f"see {value} there")
        assert [f["kind"] for f in found] == [kind] and (kind == "ip" or len(text) == len(value) + 10), value
        assert BACK.replace(text)[0] == f"see {value} there"
        new[value] = text
    assert len(set(new.values())) == len(values)
    assert sum(new[v] == f"see {v} there" for v in values) < 5
