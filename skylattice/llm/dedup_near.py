"""Near duplicates by an inverted join over MinHash signature coordinates, links confirmed on the full sets.

A text's set is that of its distinct shingles of five words (A-Z folded). Texts with equal sets are one class and go on as
one. A signature of COORDINATES values is the class's posting key set: a class is posted under (coordinate, value) pairs.
Two classes are candidates when at least MATCHES coordinates agree; by the prefix rule they then share a pair among the
COORDINATES - MATCHES + 1 rarest of each, so only those are posted, and pairs that a single class has are skipped outright.
That leaves the frequent pairs, which widely shared passages bring, out of the lists.

Lists are merged block by block with signatures beside the ids, so collisions are counted in place and no list is
expanded into pairs: a pair is looked at in the list of the rarest value it shares. It must agree in SKETCH_MATCHES of the
SKETCH two-bit values of a longer sketch as well, and its parity sketches (a bit is set when an odd number of shingles fall on
it) must not differ in more bits than a link's sets can differ in shingles, which refuses no link. In each round a class names its best partners of other components and the
list's most central member. Named pairs are confirmed on the texts' words, confirmed links join components, and the next round
looks only at lists that still hold several components. Of all lists together a class names two partners, the most alike and the most central. A long list is dealt over blocks by a hash that changes each round. While
named pairs are links, a class goes to few of its long lists and meets its own block alone, so that a large family costs in
proportion to its rows. Then all blocks of all lists meet, components instead of classes name partners, and at last every
pair is named. Rounds end when no list withheld a pair, so
every candidate pair lies within one component or was confirmed or refused on the full sets. What remains quadratic is a
family whose members are alike just below the threshold and never join: its pairs are compared, though hardly any is named.

A pair at the similarity 0.75 agrees in 36 of 48 coordinates on average and misses 24 with a probability below 0.0002; it
agrees in 416 of 512 two-bit values and misses 383 with a probability below 0.0002.

Defined results: a text without words, or null, has an empty set and is linked with nothing; fewer words than five
are one shingle; a text of any length is read whole; rows that share a doc_id count as one document; a row with a null doc_id
is linked with nothing, its component_id is null and it is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import _graph, _text
from skylattice.llm._shared import Scratch, cut, documents

WORDS = 5
COORDINATES = 48
MATCHES = 24
#: Two-bit values of a longer sketch, one per hash function, and how many must agree: a check of candidates before they are named.
SKETCH = 512
SKETCH_MATCHES = 383
#: Bits of the parity sketch of the whole set.
PARITY = 1024
#: Rows of a list that are compared with each other at once.
BLOCK = 512
#: Of its lists that are longer than a block, those that a class goes to while only rows of one block meet.
LONG_LISTS = 2
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 75

#: Bytes of both sketches.
_WIDTH = SKETCH // 4 + PARITY // 8

_rng = np.random.default_rng(48)
_FACTORS = _rng.integers(1, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(1, 2**63, SKETCH, dtype=np.uint64)


def _chain(parts: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        h = _text.mix(h * np.uint64(0x9E3779B97F4A7C15) + p)
    return h


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each document's distinct shingles, by document and hash."""
    data = _text.LOWER[data]
    doc, starts, ends = _text.words(data, offsets)
    h = _text.hashes(data, starts, ends)
    n = np.bincount(doc, minlength=len(offsets) - 1) if len(doc) else np.zeros(len(offsets) - 1, np.int64)
    m = len(h) - WORDS + 1
    inside = np.flatnonzero(doc[:m] == doc[WORDS - 1 :]) if m > 0 else np.zeros(0, np.int64)
    found = [(doc[inside], _chain([h[k:][inside] for k in range(WORDS)]) if len(inside) else np.zeros(0, np.uint64))]
    ends = np.cumsum(n)
    for size in range(1, WORDS):
        short = np.flatnonzero(n == size)
        if len(short):
            first = ends[short] - size
            found.append((short, _chain([h[first + k] for k in range(size)])))
    doc, h = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in _text.slices(batch):
            doc, h = shingles(*_text.buffer(rows["text"]))
            n = np.bincount(doc, minlength=rows.num_rows).astype(np.int64)
            has = np.flatnonzero(n)
            starts = (np.cumsum(n) - n)[has]
            signature, marks = np.zeros((rows.num_rows, COORDINATES), np.int32), np.zeros((rows.num_rows, 2), np.uint64)
            sketch = np.zeros((rows.num_rows, _WIDTH), np.uint8)
            if len(has):
                hashed = np.empty_like(h)
                for k in range(SKETCH):
                    np.multiply(h, _FACTORS[k], out=hashed)
                    np.add(hashed, _SHIFTS[k], out=hashed)
                    least = np.minimum.reduceat(hashed, starts)
                    sketch[has, k // 4] |= ((least >> np.uint64(20)) & np.uint64(3)).astype(np.uint8) << np.uint8(2 * (k % 4))
                    if k < COORDINATES:
                        signature[has, k] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
                bit = doc * PARITY + (_text.mix(h) & np.uint64(PARITY - 1)).astype(np.int64)
                bit, times = np.unique(bit, return_counts=True)
                bit = bit[times % 2 == 1]
                np.bitwise_or.at(sketch, (bit // PARITY, SKETCH // 4 + bit % PARITY // 8), np.uint8(1) << (bit % 8).astype(np.uint8))
                for k, salt in enumerate((0x1234567, 0x7654321)):
                    marks[has, k] = np.add.reduceat(_text.mix(h ^ np.uint64(salt)), starts)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(rows.num_rows + 1, dtype=np.int32) * COORDINATES), pa.array(signature.ravel()))
            bytes_ = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_WIDTH), rows.num_rows, [None, pa.py_buffer(sketch.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], pa.array(n), pa.array(np.ascontiguousarray(marks[:, 0]).view(np.int64)), pa.array(np.ascontiguousarray(marks[:, 1]).view(np.int64)), flat, bytes_],
                ["doc_id", "n_shingles", "mark", "mark2", "signature", "sketch"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit mark of the set, the signature, and the longer sketch followed by the parity sketch."""
    return docs.mapInArrow(_sign, "doc_id long, n_shingles long, mark long, mark2 long, signature array<int>, sketch binary")


def postings(classes: DataFrame) -> DataFrame:
    """Of the classes (rep, signature) that can have a partner: rep and the coordinate-value pairs to post, rarest first."""
    token = F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").cast("long") + F.lit(1 << 31)
    tokens = classes.select("rep", F.posexplode("signature").alias("at", "value")).select("rep", token.alias("token"))
    frequent = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = tokens.join(frequent, "token").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("shared"))
    # the pairs that no other class has come first in the order; they fill that many places of the prefix
    prefix = F.slice("shared", F.lit(1), F.size("shared") - (MATCHES - 1))
    return shared.where(F.size("shared") >= MATCHES).select("rep", F.transform(prefix, lambda s: s["token"]).alias("tokens"))


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches cut so that a list, whose rows follow each other, lies in one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        number = batch["list"].to_numpy(zero_copy_only=False)
        new = np.flatnonzero(number[1:] != number[:-1])
        if held and held[-1]["list"][-1].as_py() != number[0]:
            yield pa.Table.from_batches(held)
            held = []
        if not len(new):
            held.append(batch)
            continue
        at = int(new[-1]) + 1
        yield pa.Table.from_batches([*held, batch.slice(0, at)])
        held = [batch.slice(at)]
    if held:
        yield pa.Table.from_batches(held)


def _name_pairs(every: bool, wide: bool):
    def withheld(table: pa.Table) -> bool:
        """Whether a list has blocks that have not met."""
        return not wide and bool((table["blocks"].to_numpy() > 1).any())

    def pairs_of(number, side, comp, at, blocks, size_of, signature, rank, sketch):
        """Candidate pairs (i, j, agreeing values of the sketch) of whole lists; rows of a list follow each other.

        A pair is looked at in one list alone, that of the rarest coordinate value both have, but for long lists' own blocks.
        """
        size = np.bincount(np.cumsum(np.concatenate([[0], number[1:] != number[:-1]])))
        left = np.repeat(np.cumsum(size), size) - np.arange(len(number)) - 1
        out = []
        for d in range(1, int(left.max(initial=0)) + 1):
            i = np.flatnonzero(left >= d)
            j = i + d
            ok = (comp[i] != comp[j]) & ((side[i] != side[j]) | (side[i] == 0))
            i, j = i[ok], j[ok]
            for a in range(0, len(i), 100_000):
                x, y = i[a : a + 100_000], j[a : a + 100_000]
                same = signature[x] == signature[y]
                keep = same.sum(1) >= MATCHES
                keep &= (np.where(same, rank[x], 255).argmin(1) == at[x]) | (not wide and blocks[x] > 1)
                x, y = x[keep], y[keep]
                odd = np.bitwise_count(sketch[x, SKETCH // 32 :] ^ sketch[y, SKETCH // 32 :]).sum(1, dtype=np.int64)
                # sets with 100 * intersection >= PERCENT * union differ in this share of both sizes' sum at most
                keep = (100 + PERCENT) * odd <= (100 - PERCENT) * (size_of[x] + size_of[y])
                x, y = x[keep], y[keep]
                n = sketch[x, : SKETCH // 32] ^ sketch[y, : SKETCH // 32]
                n = SKETCH - np.bitwise_count((n | n >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(1, dtype=np.int64)
                keep = n >= SKETCH_MATCHES
                out.append((x[keep], y[keep], n[keep]))
        return (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3

    def named(rep, *columns):
        """(name, u, v, alike, central): all pairs, or of each class, or component when `wide`, the most alike and the most central one."""
        i, j, n = pairs_of(*columns)
        if not len(i):
            return [np.zeros(0, np.int64)] * 5, False
        comp = columns[2]
        if every:
            return [comp[i], rep[i], rep[j], n, n], False
        a, b, n = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([n, n])
        central = np.bincount(a, weights=n, minlength=len(rep)).astype(np.int64)[b]
        name, take = (comp if wide else rep)[a], np.zeros(len(a), bool)
        for best in (np.lexsort((rep[b], -n, name)), np.lexsort((rep[b], -central, name))):
            take[best[np.concatenate([[True], name[best][1:] != name[best][:-1]])]] = True
        return [name[take], rep[a[take]], rep[b[take]], n[take], central[take]], bool(take.sum() < len(take))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["name", "u", "v", "alike", "central", "more"]
        for table in _lists(batches):
            number, rep, *columns = [table[c].to_numpy() for c in ("list", "rep", "side", "comp", "at", "blocks", "n_shingles")]
            if withheld(table):
                yield pa.RecordBatch.from_arrays([*[pa.nulls(1, pa.int64())] * 5, pa.array([True])], names)
            # 15 bits of each value are compared; another value with the same bits is one collision too many, no harm
            signature = table["signature"].combine_chunks().flatten().to_numpy().astype(np.uint16).reshape(len(table), COORDINATES)
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(table), _WIDTH // 8)
            order = table["coordinates"].to_pylist()
            sizes = np.fromiter(map(len, order), np.int64, len(order))
            rank = np.full((len(table), COORDINATES), 255, np.uint8)
            rows = np.repeat(np.arange(len(table)), sizes)
            rank[rows, np.frombuffer(b"".join(order), np.uint8)] = _text.ragged(np.zeros(len(table), np.int64), sizes)
            edge = np.flatnonzero(np.diff(number, prepend=number[0] - 1))
            ends = np.append(edge[1:], len(table))
            at = 0
            while at < len(edge):  # lists of about a million pairs at a time
                pairs = np.cumsum((ends[at : at + 4096] - edge[at : at + 4096]) ** 2 // 2)
                to = at + max(1, int(np.searchsorted(pairs, 1_000_000, "right")))
                part = slice(int(edge[at]), int(ends[to - 1]))
                found, more = named(rep[part], number[part], *[c[part] for c in columns], signature[part], rank[part], sketch[part])
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([*map(pa.array, found), pa.array(np.full(len(found[0]), more))], names)
                at = to

    return run


def candidates(posted: DataFrame, classes: DataFrame, stars: DataFrame | None, every: bool, wide: bool, salt: int) -> DataFrame:
    """(u, v, more): pairs of different components that agree in MATCHES coordinates; more: some of a list were not named.

    posted: (rep, tokens); classes: (rep, n_shingles, signature, sketch). Of a list that is split only blocks meet themselves, unless `wide`;
    of a class, or of a component if `wide`, two pairs are named, unless `every`. A row without u and v says that some were not looked at.
    """
    if stars is None:
        labelled = posted.withColumn("comp", F.col("rep"))
    else:
        labelled = posted.join(stars.select(F.col("u").alias("rep"), F.col("v").alias("comp")), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    rows = labelled.select("rep", "comp", F.explode("tokens").alias("token"))
    open_lists = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("token", F.pow(F.lit(2), F.ceil(F.log2(F.ceil(F.col("n") / BLOCK)))).cast("int").alias("blocks"))
    rows = rows.drop("comp").join(open_lists, "token")
    if not wide:
        order = F.struct((F.col("blocks") > 1).alias("long"), F.xxhash64("token", F.lit(salt)).alias("place"), "token", "blocks")
        lists = rows.groupBy("rep").agg(F.array_sort(F.collect_list(order)).alias("lists"))  # no more than a prefix has
        taken = F.slice("lists", F.lit(1), F.size(F.filter("lists", lambda x: ~x["long"])) + LONG_LISTS)
        rows = lists.select("rep", F.explode(taken).alias("x")).select("rep", "x.token", "x.blocks")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep", F.lit(salt)), F.col("blocks")).cast("int"))
    # side says which of two blocks a row is of, 0: both are one
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)) if wide else F.col("own"))
    key = F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")).alias("list")
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side")
    rows = rows.select("rep", key, side, F.shiftright("token", 32).cast("int").alias("at"), "blocks")
    # signatures join last, so that they travel once, to their lists
    coordinates = F.unhex(F.concat_ws("", F.transform("tokens", lambda t: F.lpad(F.hex(F.shiftright(t, 32)), 2, "0")))).alias("coordinates")
    half = F.transform("signature", lambda x: x.bitwiseAND(F.lit(0x7FFF)).cast("short")).alias("signature")
    rows = rows.join(labelled.select("rep", "comp", coordinates).join(classes.select("rep", "n_shingles", half, "sketch"), "rep"), "rep")
    rows = rows.select("list", "side", "at", "blocks", "rep", "comp", "n_shingles", "coordinates", "signature", "sketch").repartition("list").sortWithinPartitions("list", "rep")
    found = rows.mapInArrow(_name_pairs(every, wide), "name long, u long, v long, alike long, central long, more boolean")
    if every:
        return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), F.lit(False).alias("more")).distinct()
    # of what one names in all its lists two pairs are left; the greatest of structs is found by partial aggregation
    back = F.struct((-F.col("u")).alias("u"), (-F.col("v")).alias("v")).alias("back")
    best = F.array(F.max(F.struct("alike", "central", back))["back"], F.max(F.struct("central", "alike", back))["back"])
    named = found.groupBy("name").agg(best.alias("best"), F.max("more").alias("more"), F.count(F.lit(1)).alias("n"))
    named = named.select(F.explode("best").alias("x"), (F.col("more") | (F.col("n") > 2)).alias("more")).select((-F.col("x.u")).alias("u"), (-F.col("x.v")).alias("v"), "more")
    return named.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.max("more").alias("more"))


def word_shingles(text: str | None) -> set:
    words = (text or "").encode().translate(bytes(_text.LOWER)).split()
    if len(words) < WORDS:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(WORDS)], strict=False))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: list = [None, None]  # pairs of one text follow each other
    for batch in batches:
        keep = []
        for a, b in zip(batch["text_u"], batch["text_v"], strict=True):
            a = a.as_py()
            if last[0] != a:
                last = [a, word_shingles(a)]
            x, y = last[1], word_shingles(b.as_py())
            both = len(x & y)
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both) and both > 0)
        yield pa.RecordBatch.from_arrays([batch["u"], batch["v"], pa.array(keep, pa.bool_())], ["u", "v", "linked"])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(u, v, linked) of pairs (u, v), decided on the words of texts (rep, text), one row per rep."""
    joined = pairs.join(texts.select(F.col("rep").alias("u"), F.col("text").alias("text_u")), "u")
    joined = joined.join(texts.select(F.col("rep").alias("v"), F.col("text").alias("text_v")), "v")
    return joined.select("u", "v", "text_u", "text_v").mapInArrow(_confirm, "u long, v long, linked boolean")


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept, and class_id, the smallest doc_id with the same set."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with Scratch(docs.sparkSession, "near") as scratch:
        signed = scratch.table(signatures(rows))
        sets = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        classes = sets.groupBy("mark", "mark2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"))
        classes = scratch.table(classes)
        posted = scratch.table(postings(classes.select("rep", "signature")))
        texts = rows.withColumnRenamed("doc_id", "rep").join(posted.select("rep").distinct(), "rep", "left_semi")
        texts = scratch.table(texts.groupBy("rep").agg(F.min("text").alias("text")))
        stars = _rounds(scratch, posted, classes, texts)
        scratch.drop(texts, posted)
        known = classes.select("mark", "mark2", F.col("n_shingles").alias("n"), "rep")
        if stars is not None:
            known = known.join(stars.select(F.col("u").alias("rep"), F.col("v").alias("root")), "rep", "left")
        else:
            known = known.withColumn("root", F.col("rep"))
        same = (F.col("s.mark") == F.col("k.mark")) & (F.col("s.mark2") == F.col("k.mark2")) & (F.col("s.n_shingles") == F.col("k.n")) & F.col("s.doc_id").isNotNull()
        joined = signed.select("doc_id", "n_shingles", "mark", "mark2").alias("s").join(known.alias("k"), same, "left")
        component = F.coalesce("root", "rep", "doc_id")
        return cut(joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), F.coalesce("rep", "doc_id").alias("class_id")))


def _rounds(scratch: Scratch, posted: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame | None:
    """(u, v): the linked classes, each with its component's smallest one; None without links."""
    stars, tested, every, wide, salt = None, [], False, False, 0
    while True:
        found = scratch.table(candidates(posted, classes, stars, every, wide, salt))
        more = not found.where("more").isEmpty()
        new = found.where("u IS NOT NULL").select("u", "v")
        for old in tested:
            new = new.join(old.select("u", "v"), ["u", "v"], "left_anti")
        decided = scratch.table(confirmed(new, texts))
        scratch.drop(found)
        tested.append(decided)
        n_links, n_decided = decided.agg(F.count_if("linked"), F.count(F.lit(1))).first()
        if n_links:
            links = decided.where("linked").select("u", "v")
            joined = _graph.components(scratch, links if stars is None else links.unionByName(stars))
            scratch.drop(stars)
            stars = joined
        if not more:
            return stars
        salt += 1
        # while pairs are links, components grow; then all blocks of a list meet, at last naming every pair
        if 10 * n_links <= n_decided:
            wide, every = True, wide


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(documents(spark, sf_dir))
