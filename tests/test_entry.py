"""The driver's contract, over the smallest test tables where they are there."""

import importlib
import os

import pytest

SMALL = "/root/testdata/sf0.001"


def test_registry():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and "otp_hour" in names and {f"p{n}_found" for n in (2, 3, 4, 5, 6)} <= names


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", ["otp_hour", "p2_found", "p3_found", "p4_found", "p5_found", "p6_found", "p3_positions", "p4_rows"])
def test_runs(spark, name):
    entry = importlib.import_module("__spark_entry__")
    assert entry.queries()[name](spark, SMALL).columns
    assert entry.queries()[name](spark, SMALL).count() >= 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_entry(spark):
    assert importlib.import_module("__spark_entry__").entry(spark).count() > 0
