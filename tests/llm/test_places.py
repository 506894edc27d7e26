"""Odd places of a text and their decoding, against their plain definitions."""

import itertools
import random
import re
import time

import numpy as np
import pytest

from holdfast.llm import toxicity as X

# the definition as one pattern: quadratic on rows of digits
UNIT, GAP = X._UNIT, X._GAP
PLAIN = re.compile(
    rf"{X._START}(?={UNIT}(?:{GAP}{UNIT})*?{GAP}{X._LETTER}|{X._LETTER}){UNIT}(?:{GAP}{UNIT}){{2,}}{X._END}|{X._MIXED.pattern}"
)


def test_places_are_those_of_the_definition():
    rng = random.Random(3)
    found = 0
    for letters in ("a1 .-", "ab12 .", "a1! -_)", "aab3 .,(", "1 a\n@*"):
        for _ in range(6000):
            text = "".join(rng.choices(letters, k=rng.randint(0, 24)))
            want = [m.span() for m in PLAIN.finditer(text)]
            assert list(X.odd_places(text)) == want, text
            found += len(want)
    assert found > 10_000


@pytest.fixture(scope="module")
def channel():
    rng = np.random.default_rng(2)
    return X.Channel.of(rng.integers(0, 40, (X.SIZE,) * 3).astype(float))


def _cost(channel, chain):
    a = b = 0
    total = 0.0
    for reading, price in chain:
        total += price
        for k in X.classes_of(reading).tolist() if reading else ():
            total -= channel.log[a, b, k]
            a, b = b, k
    return total - channel.log[a, b, 0]


def test_decode_is_the_cheapest_of_all_readings(channel):
    for place in ("a1b", "l33t", "s h 1 t", "b.a.d", "heeeelp", "$4!", "1 2 a", "xx0xx", "a--b3", "é1é"):
        chains = list(itertools.product(*channel.lattice(place)))
        want = min(_cost(channel, c) for c in chains)
        got = channel.decode(place)
        best = [c for c in chains if _cost(channel, c) < want + 1e-9]
        assert got in {"".join(r for r, _ in c) for c in best}, place


@pytest.mark.parametrize("row", ["1.5 2 3 ", "1 ", "1-2-", "9 9.", "1_2 3*", "7"])
def test_rows_of_numbers_are_read_once(channel, row):
    text = row * (1_000_000 // len(row))
    start = time.process_time()
    assert channel.restore(text) == text
    assert time.process_time() - start < 2


def test_a_letter_after_a_row_of_numbers(channel):
    """A long place with one letter at its end is one place, and decoded in linear time."""
    text = "1 " * 20_000 + "a"
    assert list(X.odd_places(text)) == [(0, len(text))]
    assert channel.restore(text)[-1] == "a"
