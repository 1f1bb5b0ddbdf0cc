"""Names made up for these tests, with answers worked out by hand from the rules."""

import pytest
from pyspark.sql import functions as F

from ligature.functions import names

RAW = {
    "accents": "Società Quarzo-Fiúme",
    "run": "Harbor Harbor Lantern LP",
    "legal": "Pvt. Willow Tin Works Ltd.",
    "spelt": "Zephyr Praivet Limtid",
    "dba": "Oakline Ventures dba Copper Kettle Inc",
    "aka": "Quill aka Feather Corp",
    "a k a": "Tidewater a k a Low Water",
    "leet": "Basil 5t0ne Co",
    "plain": "Basil Stone Co",
    "url": "www.cobaltgarden.org",
    "pipe url": "Cobalt Garden | www.cobaltgarden.com",
    "pipe": "Cobalt|Garden",
    "acronym": "Tern L.L.C.",
    "sign": "No. 7 Plum",
    "id": "Plum Orchard #004512",
    "india": "Plum Orchard (India) M/S",
    "and": "Salt & Pepper's",
    "weak": "The Shri USA",
    "only legal": "LLC",
    "dots": "...",
    "hindi": "कमल फूड",
    "tamil": "மலர் நிலா",
    "none": "",
}


@pytest.fixture(scope="module")
def normal(spark):
    df = spark.createDataFrame([*RAW.items(), ("null", None)], "k string, raw_name string")
    return {r["k"]: r for r in names.normalize_names(df).collect()}


@pytest.mark.parametrize(
    ("key", "full", "core", "legal"),
    [
        ("accents", "societa quarzo fiume", "societa quarzo fiume", ""),
        ("run", "harbor lantern", "harbor lantern", "lp"),
        ("legal", "willow tin works", "willow tin works", "private limited"),
        ("spelt", "zephyr", "zephyr", "private limited"),
        ("url", "cobaltgarden", "cobaltgarden", ""),
        ("pipe url", "cobalt garden", "cobalt garden", ""),
        ("pipe", "cobalt garden", "cobalt garden", ""),
        ("acronym", "tern", "tern", "llc"),
        ("sign", "7 plum", "7 plum", ""),
        ("id", "plum orchard", "plum orchard", ""),
        ("india", "plum orchard ms", "plum orchard ms", ""),
        ("and", "salt and peppers", "salt and peppers", ""),
        ("weak", "the shri usa", "the shri usa", ""),
        ("only legal", "llc", "llc", "llc"),
        ("none", "", "", ""),
        ("null", "", "", ""),
    ],
)
def test_parts(normal, key, full, core, legal):
    assert (normal[key]["name_full"], normal[key]["core_name"], normal[key]["legal"]) == (full, core, legal)


def test_halves(normal):
    r = normal["dba"]
    assert (r["name_a"], r["name_b"], r["name_aka_a"], r["name_aka_b"]) == ("oakline ventures", "copper kettle", "oakline ventures", "copper kettle")
    assert (normal["aka"]["name_aka_a"], normal["aka"]["name_aka_b"], normal["aka"]["name_a"]) == ("quill", "feather", "")
    assert (normal["a k a"]["name_aka_a"], normal["a k a"]["name_aka_b"]) == ("tidewater", "low water")


def test_skeletons(normal):
    assert normal["leet"]["name_skel"] == normal["plain"]["name_skel"] == "bsl stn"
    assert normal["acronym"]["name_skel"] == "trn"


def test_indic_scripts_become_ascii(normal):
    for key in ("hindi", "tamil"):
        assert normal[key]["core_name"] and normal[key]["core_name"].isascii()
    assert normal["hindi"]["core_name"].split()[0] == "kamal"


def test_legal_forms_initials_and_encoded_texts(spark):
    main, other = names.main_and_alternate(F.col("raw"), F.col("full"))
    row = spark.createDataFrame([("naïve", "naive"), ("plain", "plain")], "raw string, full string").select(main.alias("m"), other.alias("o")).collect()
    assert [tuple(r) for r in row] == [("naïve", "naive"), ("plain", None)]
    forms = names.legal_forms(F.lit("Tern S.A.R.L. Gmbh"), F.lit("llc"))
    r = spark.range(1).select(forms.alias("a"), names.initials_match(F.lit("low water"), F.lit("lw")).alias("b"), names.initials_match(F.lit("low"), F.lit("l")).alias("c"), names.skeleton(F.lit("2200 chroma zq")).alias("d"), names.compact(F.lit("a-b_c d")).alias("e")).first()
    assert tuple(r) == ("gmbh llc sarl", True, False, "20 chrm jk", "abcd")
