"""Pseudonyms beside other numbers and in other notations; secrets in very long words."""

import random
import time

import pytest

from millrace.llm import pii, secret_scans

VALUES = [
    "555-123-4567", "(555) 123-4567", "+49 30 1234567", "+15551234567", "4111 1111 1111 1111", "4111111111111111", "078-05-1120",
    "2001-02-03", "03/14/1999", "10.20.30.40", "DE89 3704 0044 0532 0130 00", "jane.doe@example.org",
]


@pytest.mark.parametrize("value", VALUES)
def test_no_valid_value_is_left_beside_digit_groups(value):
    hide, rng = pii.Pseudonyms(b"key"), random.Random(value)
    for _ in range(400):
        before, after = (" ".join(str(rng.randrange(10 ** rng.randrange(1, 6))) for _ in range(rng.randrange(3))) for _ in range(2))
        text = f"call {before} {value} {after} now" if rng.random() < 0.5 else f"{before} x_{value} {after}."
        text = " ".join(text.split(" "))
        assert value not in hide(text)[0], text


def test_known_leaks():
    hide = pii.Pseudonyms(b"key")
    phone = hide("555-123-4567")[0]
    assert hide("call 555-123-4567 1234 now") == (f"call {phone} 1234 now", 1)
    day = hide("2001-02-03")[0]
    assert hide("at 2001-02-03T10:00, a/2001-02-03 x_2001-02-03_y") == (f"at {day}T10:00, a/{day} x_{day}_y", 3)
    # parts of longer words stay
    for text in ("v1.2001-02-03", "2001-02-03x", "12001-02-03", "2001-02-034", "a4111111111111111", "4111111111111111b"):
        assert hide(text) == (text, 0)


def test_one_number_in_several_notations():
    hide = pii.Pseudonyms(b"key")
    digits = lambda text: "".join(c for c in hide(text)[0] if c.isdigit())
    assert digits("+1 555 123 4567") == digits("+15551234567") == digits("+1 (555) 123-4567") == "1" + digits("555-123-4567")
    assert digits("555-123-4567") == digits("(555) 123-4567") and digits("+49 30 1234567") == digits("+49301234567")
    a, b, c = (hide(f"{n}@x.com")[0] for n in ("John", "john", "JOHN"))
    assert a.lower() == b == c.lower() and a[0].isupper() and a != "John@x.com" and len({a, b, c}) == 3
    seen = {digits(f"+1 555 12{i:02d}") for i in range(100)}
    assert len(seen) == 100


@pytest.mark.parametrize("part", ["ab-", "ab_", "-", "_", "a", "a1", "token=", "ab-1", "x-token", "/", "=", "+", "key ", "0-"])
def test_long_words_take_linear_time(part):
    """A megabyte of one run; a quadratic search takes hours."""
    text = part * (1_000_000 // len(part))
    began = time.perf_counter()
    secret_scans.candidates(text)
    assert time.perf_counter() - began < 5


def test_candidates_by_form():
    key = "q8Zr41" * 6
    for text in (f"token={key}", f"API_KEY: '{key}'", f"my-app_secret => {key}", f"--password={key}", f"x__auth = {key}", f"aws_access-key={key}", f"see {key} end"):
        assert [text[a:b] for a, b in secret_scans.candidates(text)] == [key], text
    assert secret_scans.candidates("broken=abcdefgh") == [] and secret_scans.candidates("atoken=abcdefgh") == []
