"""Secrets by corpus-wide ownership frequency, in DataFrame operations alone.

Every text is scanned once; what is found, without the text, is kept as places and value hashes. The hashes of all
candidates are counted by distinct owners and repositories over the corpus: a value that few owners and few repositories have
looks live, one that many owners share, or that one owner has spread over many repositories, is a copied example. Base spans
stay in any case; further candidates are added when they look live. Counting goes through partial aggregates by (hash, owner,
repository), and verdicts return by a join on the hash and a salt, so a value that a third of the corpus holds meets no single task.

Defined results: a null text counts as empty; a null owner or repository counts as one of its own; rows are independent
but for the counts, repeated rows repeat their results and rows with a null doc_id are kept; a text of any length is read
whole and a value has no greatest length but where its format sets one; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import _spans
from skylattice.llm._shared import cut, documents

#: The base kinds as Java patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
BASE = ("assign", "access", "hex")

#: Further candidates, public formats of credentials.
CANDIDATES = {
    "forge_token": r"(?<![A-Za-z0-9_])gh[oprsu]_[A-Za-z0-9]{20,}+",
    "chat_token": r"(?<![A-Za-z0-9])xox[abeprs]-[A-Za-z0-9-]{10,}+",
    "service_key": r"(?<![A-Za-z0-9])(?:sk|pk|rk)[-_](?:live[-_]|test[-_])?[A-Za-z0-9]{20,}+",
    "map_key": r"(?<![A-Za-z0-9])AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])",
    "web_token": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
    "private_key": r"-----BEGIN\x20(?:(?!PRIVATE\x20KEY-----)[A-Z]++\x20)*+PRIVATE\x20KEY-----",
    "url_password": r"(?<=://)[^\s:/@]++:[^\s:/@]{3,}+@",
}
#: What must occur in a text for a candidate kind to be looked for; a plain search is cheaper than the pattern.
_HINTS = {"forge_token": "gh", "chat_token": "xox", "map_key": "AIza", "web_token": "eyJ", "private_key": "PRIVATE KEY", "url_password": "://"}
#: A value is taken for live when no more distinct owners and no more distinct repositories have it.
MAX_OWNERS = 2
MAX_REPOS = 20
#: Parts into which the places of a value are dealt where they meet its verdict.
SALTS = 64


def _found(text: Column) -> Column:
    """Base spans and candidates, each (n, kind, begin, stop, found); found is the value, of assign its second group."""
    assign = F.transform(_spans.matches(text, ASSIGN), lambda s: F.struct(s["begin"].alias("begin"), s["stop"].alias("stop"), F.regexp_extract(s["found"], ASSIGN, 1).alias("found")))
    base = (F.filter(assign, lambda s: F.length(s["found"]) >= 6), _spans.matches(text, ACCESS, F.instr(text, "AKIA") > 0), _spans.matches(text, HEX))
    more = {kind: _spans.matches(text, pattern, F.instr(text, _HINTS[kind]) > 0 if kind in _HINTS else None) for kind, pattern in CANDIDATES.items()}
    kinds = [*zip(BASE, base, strict=True), *more.items()]
    return F.concat(*[_spans.labelled(spans, kind, n) for n, (kind, spans) in enumerate(kinds)])


def scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """row, doc_id, owner, repo and the found places with their values' hashes, kept in the shared folder."""
    hashed = F.transform(
        _found(F.coalesce(F.col(text_col), F.lit(""))),
        lambda s: F.struct(s["n"].alias("n"), s["kind"].alias("kind"), s["begin"].alias("begin"), s["stop"].alias("stop"), F.substring(F.sha2(s["found"], 256), 1, 32).alias("value")),
    )
    return cut(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(owner_col).cast("string").alias("owner"), F.col(repo_col).cast("string").alias("repo"), hashed.alias("found")))


def ownership(scanned: DataFrame) -> DataFrame:
    """Of each value: how many owners and repositories have it, and in how many places it is."""
    places = scanned.select(F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repo", F.lit("")).alias("repo"), F.explode("found").alias("s"))
    by_owner = places.groupBy(F.col("s.value").alias("value"), "owner", "repo").agg(F.count(F.lit(1)).alias("places"))
    return by_owner.groupBy("value").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repos"), F.sum("places").alias("places"))


def classify(scanned: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """The rows of `scanned` with all their spans, each with its value's owners and repositories and whether it looks live."""
    places = scanned.select("row", F.explode("found").alias("s")).select("row", "s", F.col("s.value").alias("value"), F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt"))
    told = places.select("value", "salt").distinct().join(ownership(scanned), "value")
    live = ((F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)).alias("live")
    judged = places.join(told, ["value", "salt"]).groupBy("row").agg(F.collect_list(F.struct("s.n", "s.kind", "s.begin", "s.stop", "owners", "repos", live)).alias("spans"))
    return scanned.select("row", "doc_id").join(judged, "row", "left").withColumn("spans", F.coalesce("spans", F.array().cast(judged.schema["spans"].dataType)))


def digests(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    rows = classify(scan(docs, id_col, text_col, owner_col, repo_col), max_owners, max_repos)
    base = F.filter("spans", lambda s: s["n"] < len(BASE))
    taken = F.filter("spans", lambda s: (s["n"] < len(BASE)) | s["live"])
    counts = [F.size(F.filter("spans", _spans.is_kind(n))).cast("long").alias(f"n_{kind}") for n, kind in enumerate(BASE)]
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live")
    return rows.select("doc_id", *counts, F.sha2(_spans.listed(base), 256).alias("base_sha256"), _spans.listed(taken).alias("spans"), live, F.size("spans").cast("long").alias("n_found"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
