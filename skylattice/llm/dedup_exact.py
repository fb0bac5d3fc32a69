"""Exact duplicates by deterministic block naming, in DataFrame operations alone.

A normalised text is cut into blocks of a fixed number of bytes. Every block gets an integer name (h, v): h is its
64-bit hash, v its rank among the sorted, different blocks that share h. Adjacent pairs of names are named in the same way,
level by level, until each text has a single name. Each level sorts and counts the different contents under every h
exactly, so equal names stand for equal contents and nothing else; v is 0 except where that count finds a collision.
Names need no global counter, are the same in every run, and a repeated task gives the same names.

Texts stay in their rows: a row holds the array of its names, and only the first level's contents, the different
blocks, are shuffled, after partial aggregation in the map tasks, so copies of a text travel once per task. The names of
places are joined back only for contents with v > 0.

Defined results: a null text counts as empty; empty texts are one group; rows that share a doc_id and a normalised text
are members of the group, each marked as the row that stays if that is theirs; a null doc_id sorts after all others; other
columns are not read; a text of any length is read whole; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylattice.llm._shared import Scratch, cut, documents

BLOCK_BYTES = 2048
#: Parts into which the members of a group are dealt where they meet its result; a group of any size spreads over as many tasks.
SALTS = 64
#: The characters of [\x20\x09-\x0D].
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c)), SPACES, F.coalesce(text, F.lit("")))


def hash64(content: Column) -> Column:
    return F.xxhash64(content)


def _blocks(norm: Column, block_bytes: int) -> Column:
    last = F.greatest(F.ceil(F.octet_length(norm) / F.lit(block_bytes)).cast("int") - 1, F.lit(0))
    raw = norm.cast("binary")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(raw, k * block_bytes + 1, F.lit(block_bytes)))


def _variants(scratch: Scratch, contents: DataFrame) -> DataFrame:
    """(h, content, v) of the contents with v > 0; contents: (h, content), repeated ones included."""
    different = contents.distinct()
    shared = different.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    ranked = different.join(shared, "h", "left_semi").select("*", (F.row_number().over(Window.partitionBy("h").orderBy("content")) - 1).alias("v"))
    return scratch.table(ranked.where("v > 0"))


def _renamed(state: DataFrame, places: DataFrame, variants: DataFrame) -> DataFrame:
    """`state` with the v of `variants` in its names; places: (doc_id, sha, at, h, content)."""
    told = places.join(variants, ["h", "content"]).select("doc_id", "sha", F.struct("at", "v").alias("told"))
    told = told.groupBy("doc_id", "sha").agg(F.collect_set("told").alias("told")).select(F.col("doc_id").alias("d"), F.col("sha").alias("s"), "told")
    joined = state.join(told, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("sha") == F.col("s")), "left")
    fixed = F.transform(
        "names",
        lambda name, at: F.struct(name["h"].alias("h"), F.coalesce(F.get(F.filter("told", lambda t: t["at"] == at), F.lit(0))["v"], F.lit(0)).alias("v")),
    )
    return joined.withColumn("names", fixed).drop("d", "s", "told")


def _names(hashes: Column) -> Column:
    return F.transform(hashes, lambda h: F.struct(h.alias("h"), F.lit(0).alias("v")))


def named(scratch: Scratch, rows: DataFrame, block_bytes: int = BLOCK_BYTES, fingerprint=hash64) -> DataFrame:
    """`rows` (doc_id, sha, norm and more) without norm, with level, h, v: equal norms, and only those, get equal ones.

    Rows with equal doc_id and sha have the same norm. The result reads tables of `scratch`.
    """
    blocks = rows.select("doc_id", "sha", F.posexplode(_blocks(F.col("norm"), block_bytes)).alias("at", "content")).withColumn("h", fingerprint(F.col("content")))
    state = rows.withColumn("names", _names(F.transform(_blocks(F.col("norm"), block_bytes), fingerprint))).drop("norm")
    state = scratch.table(state)
    variants = _variants(scratch, blocks.select("h", "content"))
    done, level = [], 0
    while True:
        if not variants.isEmpty():
            state = scratch.table(_renamed(state, blocks, variants))
        done.append(state.where(F.size("names") == 1).select(*[c for c in state.columns if c != "names"], F.lit(level).alias("level"), F.inline("names")))
        state = state.where(F.size("names") > 1)
        if state.isEmpty():
            return reduce(DataFrame.unionByName, done)
        level += 1
        pair = F.transform(
            F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int")),
            lambda k: F.struct(F.get("names", 2 * k).alias("left"), F.get("names", 2 * k + 1).alias("right")),
        )
        paired = state.withColumn("pairs", pair)
        state = scratch.table(paired.withColumn("names", _names(F.transform("pairs", fingerprint))))
        blocks = state.select("doc_id", "sha", F.posexplode(F.arrays_zip("pairs", "names")).alias("at", "both")).select("doc_id", "sha", "at", F.col("both.names.h").alias("h"), F.col("both.pairs").alias("content"))
        scratch.drop(variants)
        variants = _variants(scratch, blocks.select("h", "content"))
        state = state.drop("pairs")


def deduplicate(docs: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text", fingerprint=hash64) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.char_length(text), F.lit(0)).alias("chars"), normalised(text).alias("norm"))
    rows = rows.withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256))
    with Scratch(docs.sparkSession, "exact") as scratch:
        members = named(scratch, rows, block_bytes, fingerprint).withColumn("salt", F.pmod(F.xxhash64("doc_id", "chars"), F.lit(SALTS)).cast("int"))
        first = F.max(F.struct(F.col("chars"), F.when(F.col("doc_id").isNotNull(), -F.col("doc_id")).alias("back")))
        parts = members.groupBy("level", "h", "v", "salt").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
        groups = parts.groupBy("level", "h", "v").agg((-F.max("first")["back"]).alias("keep_id"), F.sum("n").alias("group_size"))
        told = parts.select("level", "h", "v", "salt").join(groups, ["level", "h", "v"])
        joined = members.join(told, ["level", "h", "v", "salt"])
        return cut(joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(documents(spark, sf_dir))


SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
      count(*) OVER (PARTITION BY text_sha256) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
