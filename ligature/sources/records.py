"""Reading records and gold tables, and adapters that give the driver's tables the shape of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import resumed, version

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
GOLD = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


def load_tsv(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """Tab-separated text with a header, without quoting; empty fields stay empty strings."""
    df = spark.read.csv(path, schema=schema, sep="\t", header=True, quote="", escape="", nullValue="\u0000", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return df.fillna("")


def numbered(lines: DataFrame, out: str) -> DataFrame:
    """Adds ``out``: the number from 1 of each line of a table of text files, files by path and lines as they stand.

    Spark puts files together by size, so only places within a split stand for order: lines are numbered there, and the
    splits before them, one row each, are counted.
    """
    split = ["__file", "__start"]
    placed = lines.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__at"))
    sizes = placed.groupBy(*split).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select(*split, (F.sum("__n").over(W.orderBy(*split)) - F.col("__n")).alias("__before"))
    rows = placed.join(before, split).withColumn(out, F.row_number().over(W.partitionBy(*split).orderBy("__at")) + F.col("__before"))
    return rows.drop(*split, "__at", "__before")


def cached(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """A tab-separated table as Parquet: converted once for each state of its files, then read from there."""
    state = version(spark.read.text(path))
    return resumed(spark, "tsv", f"{path} {state} {schema.simpleString()}", lambda: load_tsv(spark, path, schema))


def records_of(tsv: DataFrame) -> DataFrame:
    """(entity_id, source, country, raw_name, raw_address) of a loaded table."""
    return tsv.select("entity_id", F.substring("entity_id", 2, 1).cast("int").alias("source"), "country", F.col("business_name").alias("raw_name"), F.col("business_address").alias("raw_address"))


def gold_pairs(gold: DataFrame) -> DataFrame:
    """(s1_id, cand_id, cand_source) from id lists joined by commas; an empty list gives no row."""
    ids = F.filter(F.transform(F.split("matched_entity_ids", ","), lambda x: F.trim(x)), lambda x: x != "")
    return gold.select(F.col("source1_entity_id").alias("s1_id"), F.explode(ids).alias("cand_id")).distinct().withColumn("cand_source", F.substring("cand_id", 2, 1).cast("int") - 2)


def encoded_id(column: str):
    """The id as a number: the source's digit times 10^12 plus the rest; null for ids of another form."""
    good = F.col(column).rlike("^S[1-9]-[0-9]{1,12}$")
    return F.when(good, F.substring(column, 2, 1).cast("long") * 1_000_000_000_000 + F.substring(F.col(column), F.lit(4), F.length(column)).cast("long"))


def decoded_id(column: str):
    return F.concat(F.lit("S"), (F.col(column) / 1_000_000_000_000).cast("long").cast("string"), F.lit("-"), (F.col(column) % 1_000_000_000_000).cast("string"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(n: str):
    return F.concat(F.lit("S"), (1 + F.col(n) % 3).cast("string"), F.lit("-"), F.col(n).cast("string"))


def catalog_records(spark: SparkSession, sf_dir: str, country: str = "p_type") -> DataFrame:
    """Parts as records of three sources: dense duplicates of names, heavy blocks, numbers in addresses. Countries are
    types (many, small) or brands (``p_brand``: few, large)."""
    p = _table(spark, sf_dir, "part")
    address = F.concat_ws(" ", F.col("p_size").cast("string"), F.replace("p_brand", F.lit("#"), F.lit(" ")), F.lit("Street"), F.floor("p_retailprice").cast("string"))
    return p.select(_id("p_partkey").alias("entity_id"), (1 + F.col("p_partkey") % 3).cast("int").alias("source"), F.col(country).alias("country"), F.col("p_name").alias("raw_name"), address.alias("raw_address"))


#: Words and patterns of the directory's names and addresses; {w1} to {w3} are words, {n} and {d} numbers.
WORDS = ["amber", "birch", "cedar", "dune", "ember", "fjord", "grove", "heron", "iris", "jade", "kelp", "larch", "mesa"]
NAMES = ["{W1} {W2} Pvt. Ltd.", "www.{w1}{w2}.com", "{W1} {W2} | www.{w1}{w2}.in", "{W1} {W2} dba {W3} Inc", "{W1} {W2} a k a {W3}", "{W1}'s {W2} #0012345", "A.B.C. {W1} Corp", "No. 7 {W1} {W2}", "{W1} (India) {W2}", "The {W1} & {W2} Co", "Élan {W1} S.A.R.L.", "!!!", "LLC", "कमल {w1}", "{W1} Pruvet Limitid", "{W1}|{W2}"]
PLACES = [("US", "00{n} Grand Street, Suite 12, Salem, Oregon"), ("US", "##{n} Mill Rd Unit 4 97301"), ("India", "16-11-{d} Lotus Marg, West Bengal 700001"), ("US", "null"), ("India", ""), ("France", None), ("France", "{n} rue de Paris 75001"), ("India", "Plot No. {n}, J & K"), ("US", "{n} Elm Blvd OR"), ("US", "PO Box {n}")]


def directory_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as records whose names and addresses need every rule of the normalisers."""
    key = F.col("c_custkey")
    word = lambda i: F.element_at(F.array(*[F.lit(w) for w in WORDS]), (i % len(WORDS) + 1).cast("int"))
    parts = {"w1": word(key), "w2": word(F.floor(key / 5)), "w3": word(F.floor(key / 7)), "n": (100 + key % 900).cast("string"), "d": (10 + key % 90).cast("string")}
    parts |= {f"W{i}": F.initcap(parts[f"w{i}"]) for i in (1, 2, 3)}

    def filled(pattern: str | None):
        out = F.lit(pattern)
        for name, value in parts.items():
            out = F.replace(out, F.lit("{" + name + "}"), value) if pattern and "{" + name + "}" in pattern else out
        return out

    pick = lambda xs: F.element_at(F.array(*xs), (key % len(xs) + 1).cast("int"))
    c = _table(spark, sf_dir, "customer").select("c_custkey")
    return c.select(key, _id("c_custkey").alias("entity_id"), (1 + key % 3).cast("int").alias("source"), pick([F.lit(p[0]) for p in PLACES]).alias("country"), pick([filled(p) for p in NAMES]).alias("raw_name"), pick([filled(p[1]) for p in PLACES]).alias("raw_address"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, source, country, v) of the embeddings, with the label as country."""
    e = _table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), (F.col("vec_id") % 3).cast("int").alias("source"), F.col("label").cast("string").alias("country"), F.col("embedding").alias("v"))
