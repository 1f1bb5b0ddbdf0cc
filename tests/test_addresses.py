"""Addresses made up for these tests, with answers worked out by hand from the rules."""

import pytest
from pyspark.sql import functions as F

from ligature.functions import addresses

RAW = [
    ("padded", "0340 Juniper Street", "US"),
    ("masked", "##5 Quarry Lane", "US"),
    ("parts", "12-7-09 Lotus Road", "India"),
    ("short", "88 Larkspur Ave", "US"),
    ("long", "88 Larkspur Avenue", "US"),
    ("french", "27 rue des lilas 69003", "France"),
    ("full", "9 Pine Street, Unit 31, Salem, Oregon", "US"),
    ("terse", "9 PINE ST, SALEM, OR", "US"),
    ("suburb", "4 Mill Road Jammu & Kashmir 180001", "India"),
    ("ampersand", "4 Mill Road J & K", "India"),
    ("west", "1 Elm Drive West Virginia", "US"),
    ("null", "null", "US"),
    ("empty", "", "US"),
    ("none", None, "US"),
]


@pytest.fixture(scope="module")
def normal(spark):
    df = spark.createDataFrame(RAW, "k string, raw_address string, country string")
    return {r["k"]: r for r in addresses.normalize_addresses(df).collect()}


def test_house_numbers(normal):
    assert [normal[k]["house_no"] for k in ("padded", "masked", "parts")] == ["340", "5", "12709"]
    assert [normal[k]["house_masked"] for k in ("padded", "masked", "parts")] == [0, 1, 0]


def test_abbreviations_and_units(normal):
    assert normal["short"]["addr_norm"] == normal["long"]["addr_norm"] == "88 larkspur avenue"
    assert normal["padded"]["addr_norm"] == "340 juniper st"
    assert normal["full"]["unit_tokens"] == ["unit"] and normal["full"]["num_tokens"] == ["9", "31"]
    assert normal["french"]["zip_pin"] == "69003" and "rue" in normal["french"]["addr_tokens"]


def test_derived_parts(normal):
    assert normal["padded"]["house_cands"] == ["340_juniper"]
    assert normal["padded"]["street_token"] == "juniper"
    assert [normal[k]["state_code"] for k in ("full", "terse", "suburb", "ampersand", "west")] == ["or", "or", "jk", "", "wv"]


def test_missing(normal):
    assert [normal[k]["addr_missing"] for k in ("null", "empty", "none", "full")] == [1, 1, 1, 0]


def test_street_key_and_numbers(spark):
    r = spark.range(1).select(addresses.street_key(F.lit("Annex, 0045 Birch Avenue, 30301")).alias("k"), addresses.street_key(F.lit("30301")).alias("none"), addresses.long_numbers(F.lit("a 12345 b 12 c99999 12345")).alias("n"), addresses.rerank_tokens(F.array(F.lit("12"), F.lit("elm"), F.lit("birch"), F.lit("12"))).alias("r")).first()
    assert (r["k"], r["none"], r["n"], r["r"]) == ("45 birch av", "", ["12345", "99999"], ["12", "birch"])
