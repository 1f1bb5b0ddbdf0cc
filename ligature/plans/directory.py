"""Queries on dirty records: every rule of the normalisers meets names and addresses that need it.

The records are put together from clean parts, by the customer's key; the SQL puts the expected results together from
the same parts, without the raw texts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import addresses, names
from ..sources import records
from .registry import query

_WORDS = ", ".join(f"'{w}'" for w in records.WORDS)
_N = len(records.WORDS)
_PARTS = f"""SELECT c_custkey, k, w1, w2, CASE WHEN w1 = w2 THEN w1 ELSE w1 || ' ' || w2 END AS two, w3, n, d FROM (SELECT c_custkey, CAST(c_custkey % {len(records.NAMES)} AS INTEGER) AS k,
    [{_WORDS}][CAST(c_custkey % {_N} AS INTEGER) + 1] AS w1, [{_WORDS}][CAST(c_custkey // 5 % {_N} AS INTEGER) + 1] AS w2, [{_WORDS}][CAST(c_custkey // 7 % {_N} AS INTEGER) + 1] AS w3, CAST(100 + c_custkey % 900 AS VARCHAR) AS n, CAST(10 + c_custkey % 90 AS VARCHAR) AS d FROM customer)"""


def _case(values: dict[int, str], other: str = "''") -> str:
    return "CASE k " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + f" ELSE {other} END"


_FULL = {0: "two", 1: "w1 || w2", 2: "two", 3: "two || ' dba ' || w3", 4: "two || ' aka ' || w3", 5: "CASE WHEN w2 = w1 || 's' THEN w2 ELSE w1 || 's ' || w2 END", 6: "'abc ' || w1", 7: "'7 ' || two", 8: "two", 9: "'the ' || w1 || ' and ' || w2", 10: "'elan ' || w1", 11: "''", 12: "'llc'", 13: "'kamal ' || w1", 14: "w1", 15: "two"}
_CORE = _FULL | {9: "w1 || ' and ' || w2"}
_LEGAL = {0: "'private limited'", 3: "'incorporated'", 6: "'corporation'", 9: "'company'", 10: "'sarl'", 12: "'llc'", 14: "'private limited'"}
_FORMS = _LEGAL | {0: "'limited private'", 14: "'limited private'"}


def _named(spark, d):
    return names.normalize_names(records.directory_records(spark, d))


@query(f"SELECT c_custkey, {_case(_FULL)} AS name_full, {_case(_CORE)} AS core_name, {_case(_LEGAL)} AS legal FROM ({_PARTS})")
def name_rules(spark, d):
    """Names with legal forms, URLs, pipes, aliases, acronyms, trailing numbers, accents, an Indic script and no letters."""
    return _named(spark, d).select("c_custkey", "name_full", "core_name", "legal")


@query(f"SELECT c_custkey, {_case({3: 'two'})} AS name_a, {_case({3: 'w3'})} AS name_b, {_case({3: 'two', 4: 'two'})} AS name_aka_a, {_case({3: 'w3', 4: 'w3'})} AS name_aka_b FROM ({_PARTS})")
def name_halves(spark, d):
    return _named(spark, d).select("c_custkey", "name_a", "name_b", "name_aka_a", "name_aka_b")


@query(f"SELECT c_custkey, {_case(_FORMS)} AS legal FROM ({_PARTS})")
def legal_forms(spark, d):
    return _named(spark, d).select("c_custkey", names.legal_forms(F.col("raw_name"), F.col("legal")).alias("legal"))


@query(f"SELECT c_custkey, k NOT IN (10, 13) AS ascii, CASE k WHEN 10 THEN 'Élan ' || upper(w1[1]) || w1[2:] || ' S.A.R.L.' WHEN 13 THEN 'कमल ' || w1 END AS main FROM ({_PARTS})")
def encoded_texts(spark, d):
    """Which text an encoder gets: the raw one where it is not ASCII (shown here), else the normalised one."""
    made = _named(spark, d).withColumn("ascii", names.is_ascii(F.col("raw_name")))
    main, other = names.main_and_alternate(F.col("raw_name"), F.col("name_full"))
    return made.select("c_custkey", "ascii", F.when(other.isNotNull(), main).alias("main"))


_A = _PARTS.replace(f"c_custkey % {len(records.NAMES)} AS INTEGER", f"c_custkey % {len(records.PLACES)} AS INTEGER")
_NORM = {0: "n || ' grand st ste 12 salem oregon'", 1: "n || ' mill road 4 97301'", 2: "'16 11 ' || d || ' lotus marg west bengal 700001'", 6: "n || ' rue de paris 75001'", 7: "'plot ' || n || ' j and k'", 8: "n || ' elm boulevard or'", 9: "n"}
_PLACE = {
    "addr_norm": _case(_NORM),
    "num_tokens": _case({0: "n || ' 12'", 1: "n || ' 4 97301'", 2: "CASE d WHEN '11' THEN '16 11 700001' WHEN '16' THEN '16 11 700001' ELSE '16 11 ' || d || ' 700001' END", 6: "n || ' 75001'", 7: "n", 8: "n", 9: "n"}),
    "house_no": _case({0: "n", 1: "n", 2: "'1611' || d", 6: "n", 7: "n", 8: "n", 9: "n"}),
    "house_masked": _case({1: "1"}, "0"),
    "zip_pin": _case({0: "'00' || n", 1: "'97301'", 2: "'700001'", 6: "'75001'"}),
    "state_code": _case({0: "'or'", 2: "'wb'", 6: "'idf'", 8: "'or'"}),
    "house_cands": _case({0: "n || '_grand 12_salem'", 1: "n || '_mill'", 2: "d || '_lotus'", 6: "n || '_rue'", 8: "n || '_elm'"}),
    "unit_tokens": _case({1: "'unit'", 9: "'po box'"}),
    "street_token": _case({0: "'grand'", 1: "'mill'", 2: "'lotus'"}),
    "addr_missing": _case({3: "1", 4: "1", 5: "1"}, "0"),
}


@query(f"SELECT c_custkey, {', '.join(f'{v} AS {c}' for c, v in _PLACE.items())} FROM ({_A})")
def address_rules(spark, d):
    """Addresses with padded and masked house numbers, units, boxes, missing parts, codes and states of three countries.
    An ampersand is spelt out before states are looked up, so "J & K" is not found."""
    made = addresses.normalize_addresses(records.directory_records(spark, d))
    lists = [F.array_join(c, " ").alias(c) for c in ("num_tokens", "house_cands", "unit_tokens")]
    return made.select("c_custkey", "addr_norm", "house_no", "house_masked", "zip_pin", "state_code", "street_token", "addr_missing", *lists)


_KEYS = {0: "n || ' grand st'", 1: "n || ' mill rd unit 4 97301'", 2: "'16 11 ' || d || ' lotus marg'", 6: "n || ' r de paris 75001'", 8: "n || ' elm bd or'"}


@query(f"SELECT c_custkey, {_case(_KEYS)} AS street_key FROM ({_A})")
def street_keys(spark, d):
    return records.directory_records(spark, d).select("c_custkey", addresses.street_key(F.col("raw_address")).alias("street_key"))
