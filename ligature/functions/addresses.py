"""Address normalisation as column expressions and table transformations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import constants as K
from .names import mapping, member, replaced, transliterate, words

NUMBER = r"^[0-9]+$"
ALPHA = r"(?U)^\p{Alpha}+$"


def unpadded(t: Column) -> Column:
    return F.regexp_replace(t, "^0+(?=.)", "")


def _numbers(tokens: Column) -> Column:
    """The numbers of a token list, in order and distinct."""
    runs = F.flatten(F.transform(tokens, lambda t: F.regexp_extract_all(t, F.lit("([0-9]+)"), F.lit(1))))
    return F.array_distinct(F.transform(runs, unpadded))


def _street(tokens: Column, house: Column) -> Column:
    skip = K.STREET_WORDS + K.STREET_STOP_WORDS + sorted({*K.STATES, *K.STATES.values()})
    at = F.coalesce(F.array_position(F.transform(tokens, lambda t: t.rlike(NUMBER) & (unpadded(t) == house)), True), F.lit(0))
    usable = F.filter(tokens, lambda t, i: (i >= at) & (F.length(t) >= 4) & t.rlike(ALPHA) & ~member(t, skip))
    return F.coalesce(F.try_element_at(usable, F.lit(1)), F.lit(""))


def _house_candidates(tokens: Column) -> Column:
    pairs = F.transform(tokens, lambda t, i: F.struct(t.alias("n"), F.try_element_at(tokens, i + 2).alias("w")))
    good = F.filter(pairs, lambda p: p["n"].rlike(NUMBER) & p["w"].rlike(ALPHA) & (F.length(p["w"]) >= 3))
    return F.slice(F.array_distinct(F.transform(good, lambda p: F.concat(unpadded(p["n"]), F.lit("_"), p["w"]))), 1, 3)


def state_code(tokens: Column, country: Column) -> Column:
    """The state of the longest, leftmost run of up to four tokens that names one; else of a short code at the end or
    the start."""
    states, short = mapping(K.STATES), mapping(K.SHORT_STATES)

    def named(n: int) -> Column:
        runs = F.transform(F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - n + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.try_element_at(states, F.array_join(F.slice(tokens, i, n), " ")))
        return F.try_element_at(F.filter(runs, lambda s: s.isNotNull()), F.lit(1))

    last, first = F.try_element_at(tokens, F.lit(-1)), F.try_element_at(tokens, F.lit(1))
    french = F.when(member(last, K.FRENCH_REGIONS), last).when(member(first, K.FRENCH_REGIONS), first)
    at_start = F.when(~first.isin("la", "de") | country.isin("US", "India"), F.try_element_at(short, first))
    other = F.coalesce(F.try_element_at(short, last), at_start)
    return F.coalesce(named(4), named(3), named(2), named(1), F.when(country == "France", french).otherwise(other), F.lit(""))


def normalize_addresses(df: DataFrame, address: str = "raw_address", country: str = "country", scripts: str = "all") -> DataFrame:
    """Adds addr_norm, addr_tokens, unit_tokens, num_tokens, house_no, house_masked, zip_pin, state_code,
    street_token, house_cands (lists as arrays) and addr_missing."""
    raw = F.coalesce(F.col(address), F.lit(""))
    blank = F.lower(F.trim(raw)).isin("", "null")
    text = F.when(blank, "").otherwise(F.replace(F.lower(transliterate(replaced(raw, (K.NUMBER_SIGN, " ")), scripts)), F.lit("&"), F.lit(" and ")))
    table = mapping(K.ADDRESS_ABBREVIATIONS)
    df = df.withColumn("__t", text).withColumn("__w", words(replaced(F.col("__t"), (r"[^\w\s]", " "))))
    df = df.withColumn("__n", F.transform("__w", lambda t: F.when(t.rlike(NUMBER), unpadded(t)).otherwise(F.coalesce(F.try_element_at(table, t), t))))
    df = df.withColumns({"unit_tokens": F.filter("__n", lambda t: member(t, K.UNIT_TOKENS)), "addr_tokens": F.filter("__n", lambda t: ~member(t, K.UNIT_TOKENS))})
    house = F.try_element_at(F.filter(words(F.col("__t")), lambda t: t.rlike("[0-9]")), F.lit(1))
    df = df.withColumn("__h", house).withColumns({
        "addr_norm": F.array_join("addr_tokens", " "),
        "num_tokens": _numbers(F.col("addr_tokens")),
        "house_no": F.coalesce(unpadded(F.regexp_replace("__h", "[^0-9]", "")), F.lit("")),
        "house_masked": F.coalesce(F.contains("__h", F.lit("#")).cast("int"), F.lit(0)),
        "zip_pin": F.coalesce(F.try_element_at(F.filter("__w", lambda t: t.rlike("^[0-9]{5,6}$")), F.lit(-1)), F.lit("")),
        "house_cands": _house_candidates(F.col("addr_tokens")),
        "state_code": state_code(F.col("addr_tokens"), F.col(country)),
    })
    df = df.withColumn("street_token", _street(F.col("addr_tokens"), F.col("house_no")))
    return df.withColumn("addr_missing", (F.col("addr_norm") == "").cast("int")).drop("__t", "__w", "__n", "__h")


def street_key(raw: Column) -> Column:
    """The first comma-separated part with a number followed by a word, its numbers unpadded and street words short."""
    table = mapping(K.STREET_SHORT)
    parts = F.transform(F.split(F.lower(F.coalesce(raw, F.lit(""))), ","), lambda s: words(replaced(s, (r"[^\w]+", " "))))

    def good(toks: Column) -> Column:
        return F.exists(F.transform(toks, lambda t, i: t.rlike("[0-9]") & F.coalesce(F.try_element_at(toks, i + 2).rlike(ALPHA), F.lit(False))), lambda x: x)

    first = F.try_element_at(F.filter(parts, good), F.lit(1))
    return F.coalesce(F.array_join(F.transform(first, lambda t: F.when(t.rlike(NUMBER), unpadded(t)).otherwise(F.coalesce(F.try_element_at(table, t), t))), " "), F.lit(""))


def rerank_tokens(tokens: Column, limit: int = 24) -> Column:
    """Numbers, and words of four letters or more; distinct, in order."""
    return F.slice(F.array_distinct(F.filter(tokens, lambda t: t.rlike(NUMBER) | (t.rlike(ALPHA) & (F.length(t) >= 4)))), 1, limit)


def long_numbers(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit("([0-9]{5,})"), F.lit(1)))
