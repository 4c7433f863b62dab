"""Registered queries against their checking texts; all of them with CASCATA_ALL=1."""

import os
import re

import pytest

import __spark_entry__ as entry
from checks import compare

FOLDER = "/root/testdata/sf0.001"
# The corpus queries have tests of their own.
QUERIES, TEXTS = dict(entry.QUERIES), dict(entry.ORACLE)
ALWAYS = re.compile(r"^(T\d|W|J9|J1[0-7]|S7|S12|S15|S22|S3[0-3])")
FAMILIES = {"S": 33, "P": 12, "J": 17, "A": 16, "W": 6, "O": 3, "U": 3, "F": 22, "C": 25, "T": 15, "M": 60}


def covered():
    found = set()
    for name in QUERIES:
        ids = re.findall(r"(?:^|_)([A-Z])(\d+)(?=_|$)", name)
        for letter, number in ids:
            found.add((letter, int(number)))
        for letter, first, last in re.findall(r"([A-Z])(\d+)_to_[A-Z](\d+)", name):
            found |= {(letter, n) for n in range(int(first), int(last) + 1)}
    return found


def test_every_operator_has_a_query_and_a_text():
    wanted = {(letter, n) for letter, size in FAMILIES.items() for n in range(1, size + 1)}
    assert wanted - covered() == set()
    assert set(QUERIES) == set(TEXTS)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def engine():
    return compare.engine(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if os.environ.get("CASCATA_ALL") or ALWAYS.match(n)])
def test_query(spark, engine, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), engine, TEXTS[name]) == []
