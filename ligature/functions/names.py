"""Name normalisation as column expressions and table transformations."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import constants as K


def mapping(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")


def member(token: Column, values: list[str]) -> Column:
    return token.isin(values)


def replaced(text: Column, *steps: tuple[str, str]) -> Column:
    """Regular expressions replaced one after another; classes are Unicode-aware."""
    return reduce(lambda c, s: F.regexp_replace(c, f"(?U){s[0]}", s[1]), steps, text)


def _latin() -> tuple[str, str]:
    """Letters of Latin blocks and the ASCII letter that they are a variant of."""
    pairs = []
    for c in map(chr, range(0xC0, 0x250)):
        base = unicodedata.normalize("NFD", c)[0]
        if base.isascii() and base.isalpha():
            pairs.append((c, base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_FOLDED = (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ø", "o"), ("Ø", "O"), ("ł", "l"), ("Ł", "L"), ("đ", "d"), ("Đ", "D"), ("þ", "th"), ("Þ", "TH"), ("ð", "d"), ("ı", "i"))


def fold_latin(text: Column) -> Column:
    """Latin letters without their diacritics."""
    return F.translate(reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), _FOLDED, text), *_latin())


def transliterate(text: Column, scripts: str = "all") -> Column:
    """ASCII text as it is; Latin letters without diacritics; Indic letters by their Unicode names.

    ``scripts="latin"`` leaves other scripts as they are and needs no Python on the executors.
    """
    folded = fold_latin(text)
    if scripts == "latin":
        return folded
    from .translit import indic

    return F.when(is_ascii(text), text).when(is_ascii(folded), folded).otherwise(indic(folded))


def is_ascii(text: Column) -> Column:
    return ~text.rlike(r"[^\x00-\x7F]")


def skeleton_of_token(token: Column) -> Column:
    """The consonant skeleton of one lower-cased token without white space."""
    number = token.rlike(r"^[0-9]+$")
    sounds = replaced(token, ("ph", "f"), ("q", "k"), ("z", "j"), ("c(?!h)", "k"), ("m(?=[cdfghjklmnqrstvwxz])", "n"))
    letters = F.translate(sounds, "5013", "sole")
    kept = F.concat(F.substring(letters, 1, 1), F.regexp_replace(F.substring(letters, F.lit(2), F.length(letters)), "[aeiouy]", ""))
    return F.regexp_replace(F.when(number, token).otherwise(kept), r"(.)\1+", "$1")


def skeleton(text: Column) -> Column:
    """The consonant skeleton of every token."""
    return F.array_join(F.transform(words(F.lower(text)), skeleton_of_token), " ")


def _clean(text: Column, scripts: str) -> Column:
    """Everything up to the tokens, but for the parts after `` dba ``, which need the text before the last steps."""
    n = F.lower(transliterate(replaced(text, (K.NUMBER_SIGN, " ")), scripts))
    last = F.element_at(F.split(n, r"\|"), -1)
    url = reduce(lambda a, b: a | b, [F.contains(last, F.lit(x)) for x in K.URL_MARKS])
    n = F.when(~F.contains(n, F.lit("|")), n).when(url, F.split_part(n, F.lit("|"), F.lit(1))).otherwise(F.replace(n, F.lit("|"), F.lit(" ")))
    n = replaced(n, (K.URL_AFFIXES, ""))
    n = F.translate(F.replace(n, F.lit("(india)"), F.lit(" ")), "'’", "")
    return n


def _folded(n: Column) -> Column:
    # each pass leaves at most a pair of letters apart; three passes reach what repeated ones do
    acronyms = [(K.DOTTED_LETTERS, "$1")] * 3
    return F.replace(replaced(n, *acronyms), F.lit("m/s"), F.lit("ms"))


def _tokens(n: Column) -> Column:
    n = replaced(n, (K.TRAILING_ID, ""))
    n = replaced(F.replace(n, F.lit("&"), F.lit(" and ")), (r"[^\w\s]", " "))
    table = mapping(K.NAME_ABBREVIATIONS)

    def known(t: Column) -> Column:
        s = skeleton_of_token(t)
        return F.when(s == "prvt", "private").when(s.isin("lmtd", "lmtt"), "limited").otherwise(F.coalesce(F.try_element_at(table, t), t))

    return F.transform(words(n), known)


def without_runs(tokens: Column) -> Column:
    """Tokens that differ from the one before them."""
    return F.filter(tokens, lambda t, i: (i == 0) | (t != F.try_element_at(tokens, i)))


def with_name_parts(df: DataFrame, name: str, prefix: str = "", scripts: str = "all") -> DataFrame:
    """Adds name_full, core_name, legal, core_sorted and name_skel of a raw name, and the text ``<prefix>folded``."""
    p = lambda c: f"{prefix}{c}"
    text = F.coalesce(F.col(name), F.lit(""))
    df = df.withColumn(p("folded"), _clean(text, scripts)).withColumn(p("folded"), _folded(F.col(p("folded"))))
    df = df.withColumn(p("toks"), _tokens(F.col(p("folded")))).withColumn(p("toks"), without_runs(F.col(p("toks"))))
    df = df.withColumn(p("legal"), F.array_join(F.filter(p("toks"), lambda t: member(t, K.LEGAL_SUFFIXES)), " "))
    df = df.withColumn(p("full"), F.filter(p("toks"), lambda t: ~member(t, K.LEGAL_SUFFIXES)))
    df = df.withColumn(p("strong"), F.filter(p("full"), lambda t: ~member(t, K.WEAK_TOKENS)))
    df = df.withColumn(p("strong"), F.when(F.size(p("strong")) > 0, F.col(p("strong"))).otherwise(F.col(p("full"))))
    df = df.withColumns({p("name_full"): F.array_join(p("full"), " "), p("core_name"): F.array_join(p("strong"), " "), p("core_sorted"): F.array_join(F.array_sort(p("strong")), " ")})
    return df.withColumn(p("name_skel"), skeleton(F.col(p("core_name")))).drop(p("toks"), p("full"), p("strong"))


def _core_of(df: DataFrame, part: str, out: str) -> DataFrame:
    """The core name of a part that is transliterated already."""
    df = df.withColumn("__t", _tokens(_folded(_clean(F.col(part), "latin"))))
    df = df.withColumn("__t", F.filter(without_runs(F.col("__t")), lambda t: ~member(t, K.LEGAL_SUFFIXES)))
    df = df.withColumn("__s", F.filter("__t", lambda t: ~member(t, K.WEAK_TOKENS)))
    return df.withColumn(out, F.array_join(F.when(F.size("__s") > 0, F.col("__s")).otherwise(F.col("__t")), " ")).drop("__t", "__s")


def _with_halves(df: DataFrame, name: str, scripts: str) -> DataFrame:
    halves = F.split(F.col("folded"), " dba ", 2)
    df = df.withColumn("__a", F.when(F.size(halves) > 1, F.trim(halves[0])).otherwise("")).withColumn("__b", F.when(F.size(halves) > 1, F.trim(halves[1])).otherwise(""))
    df = df.withColumn("__low", F.lower(transliterate(F.coalesce(F.col(name), F.lit("")), scripts)))
    cut = F.lit(None)
    for sep in reversed(K.ALIAS_MARKS):
        cut = F.when(F.contains("__low", F.lit(sep)), F.split("__low", sep, 2)).otherwise(cut)
    df = df.withColumn("__k", cut).withColumn("__ka", F.coalesce(F.trim(F.col("__k")[0]), F.lit(""))).withColumn("__kb", F.coalesce(F.trim(F.col("__k")[1]), F.lit("")))
    for part, out in (("__a", "name_a"), ("__b", "name_b"), ("__ka", "name_aka_a"), ("__kb", "name_aka_b")):
        df = _core_of(df, part, out)
    both = (F.col("__a") != "") & (F.col("__b") != "")
    df = df.withColumns({"name_a": F.when(both, F.col("name_a")).otherwise(F.col("__a")), "name_b": F.when(both, F.col("name_b")).otherwise(F.col("__b"))})
    return df.drop("__a", "__b", "__low", "__k", "__ka", "__kb")


def normalize_names(df: DataFrame, name: str = "raw_name", scripts: str = "all", halves: bool = True) -> DataFrame:
    """Adds name_full, core_name, legal, core_sorted and name_skel; with ``halves`` also name_a, name_b, name_aka_a and
    name_aka_b, the core names around `` dba `` and `` aka ``.

    A name that normalises to nothing falls back to its lower-cased letters and digits.
    """
    df = with_name_parts(df, name, scripts=scripts)
    if halves:
        df = _with_halves(df, name, scripts)
    plain = F.trim(replaced(F.lower(transliterate(F.coalesce(F.col(name), F.lit("")), scripts)), (r"[^\w\s]", " ")))
    empty = (F.col("name_full") == "") & (F.trim(F.coalesce(F.col(name), F.lit(""))) != "")
    df = df.withColumn("__p", F.when(empty, plain))
    df = df.withColumns({
        "name_full": F.coalesce("__p", "name_full"),
        "core_name": F.coalesce("__p", "core_name"),
        "core_sorted": F.when(empty, F.array_join(F.array_sort(words(F.col("__p"))), " ")).otherwise(F.col("core_sorted")),
        "name_skel": F.when(empty, skeleton(F.col("__p"))).otherwise(F.col("name_skel")),
    })
    return df.drop("folded", "__p")


def legal_forms(raw: Column, legal: Column) -> Column:
    """Sorted legal forms: the normalised ones, and those of the raw name with its full stops removed."""
    table, forms = mapping(K.NAME_ABBREVIATIONS), K.LEGAL_SUFFIXES + K.EXTRA_LEGAL_FORMS
    found = F.transform(words(replaced(F.replace(F.lower(raw), F.lit("."), F.lit("")), (r"[^\w]+", " "))), lambda t: F.coalesce(F.try_element_at(table, t), t))
    return F.array_join(F.array_sort(F.array_union(words(legal), F.filter(found, lambda t: member(t, forms)))), " ")


def acronym(text: Column) -> Column:
    return F.array_join(F.transform(words(text), lambda t: F.substring(t, 1, 1)), "")


def initials(name: Column) -> Column:
    """The first letters of two tokens at least; null for fewer."""
    return F.when(F.size(words(name)) >= 2, acronym(name))


def initials_equal(a_initials: Column, a: Column, b_initials: Column, b: Column) -> Column:
    """Whether one name's ``initials`` are the other name without blanks."""
    one = lambda x, y: F.coalesce(x == F.replace(y, F.lit(" "), F.lit("")), F.lit(False))
    return one(a_initials, b) | one(b_initials, a)


def initials_match(a: Column, b: Column) -> Column:
    """Whether one name's initials, of two tokens at least, are the other name without blanks."""
    return initials_equal(initials(a), a, initials(b), b)


def compact(text: Column) -> Column:
    return replaced(text, (r"[\W_]+", ""))


def main_and_alternate(raw: Column, full: Column) -> tuple[Column, Column]:
    """The text to encode (the raw name if it is not ASCII), and the normalised name beside it in that case."""
    other = ~is_ascii(raw)
    return F.when(other, raw).otherwise(full), F.when(other, full)


def rewritten(text: Column, table: Column) -> Column:
    """Tokens replaced by a map column."""
    return F.array_join(F.transform(words(text), lambda t: F.coalesce(F.try_element_at(table, t), t)), " ")
