"""Invented text for the tests."""

import random

import pytest


@pytest.fixture
def words():
    """A maker of reproducible texts of invented words."""

    def make(seed, count, stems=("ta", "re", "lo", "mi", "son", "ke", "pra", "du", "vel", "ich")):
        rng = random.Random(seed)
        return " ".join(
            "".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(count)
        )

    return make
