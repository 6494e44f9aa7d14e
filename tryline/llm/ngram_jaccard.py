"""N-gram Jaccard join by multiple-global-order prefix filtering (operator 1).

Two documents link when the Jaccard similarity of their word-shingle sets is
at least ``percent / 100``. Components of links are returned; no links
between different texts are lost.

Method
------
1. *Equal sets collapse* to their smallest document (a partial aggregate on a
   128-bit set fingerprint), so copies cost one row each from here on.
2. *Sample.* Shingle hashes are uniform, so their numeric order is a random
   global token order. By the prefix principle, linked sets ``x, y`` of sizes
   ``n`` share at least ``min(l(x), l(y))`` tokens among their first
   ``n - ceil(t n) + l(n)`` tokens. Only these few tokens are exchanged.
3. *Several global orders.* The sampled tokens are counted over all documents.
   Each of ``ORDERS`` total orders puts rare tokens first (by the logarithm
   of their count) and breaks ties by its own hash. Under every one of them
   linked sets must share a token of their prefixes; tokens of count one
   take places in the prefixes but can't be shared, so they are dropped.
   A pair that meets under the first order is kept only if it also meets
   under all others; then it is verified on the whole sets.
4. *Groups of near copies.* A token's documents are first compared with one
   pivot ``B`` of theirs, the one of the most common tokens; links contract
   documents into components, and a token whose documents are all of one
   component is finished. For the rest: if ``x`` and ``y`` are linked but
   ``y`` is not linked with ``B``, they share a token outside ``B``, unless
   ``|x|`` is so small that ``y`` and ``B`` alone reach the overlap needed. So
   documents meet again only under (``B``, token outside ``B``), by prefixes
   of what they hold beside ``B``, rare tokens first, and the few exceptions
   are verified one by one. After ``ROUNDS`` rounds all pairs that still meet,
   are of different components, may reach the similarity by sketches of
   ``SKETCH`` bits and meet under all other orders are verified. Nothing is
   capped, and no link between components is missed.

Defined cases: null, empty or white-space texts have an empty set and link
with nothing; a sequence shorter than a shingle is one shingle. Rows of equal
id count as one vertex, each with its own ``n_shingles``. A row with null id
gets a null component and takes part in no link. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tryline.llm.common import Scratch
from tryline.llm.components import components
from tryline.llm.textops import U64, chunks, shingle_sets, splitmix

ORDERS = 3
#: Pivot rounds before all that is still open is verified.
ROUNDS = 1
#: Ids broadcast at most (8 bytes each); beyond it the same join is shuffled.
BROADCAST_IDS = 2_000_000
#: Bits of a set's sketch; it tells sets apart well up to about twice as many tokens.
SKETCH = 2048


def _need(n, percent: int):
    """Smallest overlap with any linked set: ceil(t n)."""
    return -(-percent * n // 100)


def _level(n, percent: int):
    """How many common tokens the sample of a set of size ``n`` is sure to show."""
    return np.minimum(-(-n // 10) + 8, _need(n, percent))


def sample_size(n, percent: int):
    return np.minimum(n, n - _need(n, percent) + _level(n, percent))


def prefix_size(n, percent: int):
    """Places of the sample that must hold a token shared with any linked set."""
    return sample_size(n, percent) - _level(_need(n, percent), percent) + 1


SIGNATURE = "uid long, id long, n long, fp1 long, fp2 long, places int, sample binary"


def _prints(sets: list[np.ndarray]) -> list[pa.Array]:
    """Two independent order-free sums of the tokens: a set's fingerprint."""
    return [pa.array(np.array([f(s).sum(dtype=U64) for s in sets], dtype=U64).view(np.int64))
            for f in (lambda s: s, lambda s: splitmix(s ^ U64(0x5BF03635)))]


def _signatures(size: int, percent: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch.column("text")):
                sets = shingle_sets(c, size, lower)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                k = sample_size(n, percent)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(x).slice(c.rows.start, len(sets)) for x in ("uid", "id")), pa.array(n), *_prints(sets),
                     pa.array(prefix_size(n, percent).astype(np.int32)),
                     pa.array([s[:j].tobytes() for s, j in zip(sets, k.tolist(), strict=True)], pa.binary())],
                    names=["uid", "id", "n", "fp1", "fp2", "places", "sample"])
    return run


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            tokens = [np.frombuffer(x, np.int64) for x in part.column("sample").to_pylist()]
            reps = np.array([len(x) for x in tokens], dtype=np.int64)
            rows = pa.array(np.repeat(np.arange(len(tokens)), reps))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int64)), part.column("uid").take(rows)],
                names=["tok", "uid"])


def _full_sets(size: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch.column("text")):
                sets = shingle_sets(c, size, lower)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(c.rows.start, len(sets)), *_prints(sets), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["id", "fp1", "fp2", "whole"])
    return run


COMPARED = "a long, b long, linked boolean, both long, places int, beside binary"


def _compare(percent: int, differences: bool):
    """Verifies pairs of whole sets; with ``differences`` also what ``b`` holds beside ``a``, and how many places
    of it, in any order, must hold a token shared with any linked set that ``a`` doesn't explain."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, common, places, beside = [], [], [], []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                at = np.searchsorted(a, b)
                at[at == len(a)] = 0
                inside = a[at] == b
                both = int(inside.sum())
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
                common.append(both)
                rest = b[~inside] if differences else b[:0]
                places.append(max(0, len(rest) - max(1, _need(len(b), percent) - both) + 1))
                beside.append(rest.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()), pa.array(common, pa.int64()),
                 pa.array(places, pa.int32()), pa.array(beside, pa.binary())], names=["a", "b", "linked", "both", "places", "beside"])
    return run


def ngram_jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                             percent: int = 80, lower: bool = True) -> DataFrame:
    """``(id_col, n_shingles, component_id)``, one row per row of ``docs``; see the module's text.

    ``component_id`` is the smallest id reachable by links, itself included.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "ngram-jaccard")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    numbered = texts.select(F.monotonically_increasing_id().alias("uid"), "id", "text")
    sig = scratch.table(numbered.mapInArrow(_signatures(size, percent, lower), SIGNATURE), "signatures")

    # one row per distinct set; its uid names the set from here on
    reps = scratch.table(
        sig.where("n > 0 and id is not null").groupBy("fp1", "fp2", "n")
        .agg(F.min(F.struct("id", "uid")).alias("r"), F.first("places").alias("places")).select("r.*", "fp1", "fp2", "n", "places"), "reps")
    tokens = scratch.table(sig.join(reps.select("uid"), "uid", "left_semi").select("uid", "sample")
                           .mapInArrow(_explode, "tok long, uid long"), "tokens")
    counts = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = scratch.table(tokens.join(counts, "tok").select("uid", "tok", F.floor(F.log2("df")).cast("int").alias("c")), "shared")
    index = scratch.table(_prefixes(tokens, shared, reps.select("uid", "n", "places")), "index")
    scratch.drop("tokens", "shared")

    active = index.join(reps.select("uid", "id"), "uid").select("id").distinct()
    few = active.count() <= BROADCAST_IDS
    wanted = texts.join(F.broadcast(active) if few else active, "id", "left_semi")
    whole = wanted.mapInArrow(_full_sets(size, lower), "id long, fp1 long, fp2 long, whole binary")
    whole = scratch.table(whole.join(reps.select("uid", "id", "fp1", "fp2"), ["id", "fp1", "fp2"]).select("uid", "whole"), "sets")

    links = _links(spark, scratch, index, whole, percent)
    member = sig.select("id", "n", "fp1", "fp2").join(
        reps.select(F.col("id").alias("rep"), "fp1", "fp2", "n"), ["fp1", "fp2", "n"], "left")
    if links is not None:
        ids = reps.select("uid", "id")
        edges = links.join(ids.select(F.col("uid").alias("u"), F.col("id").alias("x")), "u").join(
            ids.select(F.col("uid").alias("v"), F.col("id").alias("y")), "v").select(F.col("x").alias("u"), F.col("y").alias("v"))
        # rows of one id are one vertex, whatever their texts
        twins = member.where("rep <> id").select(F.col("id").alias("u"), F.col("rep").alias("v"))
        comp = components(spark, edges.unionByName(twins), scratch, "final")
    else:
        twins = member.where("rep <> id").select(F.col("id").alias("u"), F.col("rep").alias("v"))
        comp = components(spark, twins, scratch, "final")
    # the components stand: only they and the signatures are read from here on
    scratch.drop(*[t for t in scratch.paths if t != "signatures" and not t.startswith("final-")])
    out = sig.select("id", "n").join(comp, F.col("id") == F.col("node"), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def _prefixes(tokens: DataFrame, shared: DataFrame, sampled: DataFrame) -> DataFrame:
    """Per set with room for a shared token in its prefixes: these, under each order, without unshared tokens.

    A set's list is at most its own sample, never a group of documents.
    """
    lists = shared.groupBy("uid").agg(F.collect_list(F.struct("c", "tok")).alias("toks"))
    total = tokens.groupBy("uid").agg(F.count(F.lit(1)).alias("k"))
    df = lists.join(total, "uid").join(sampled, "uid")
    # unshared tokens come first in every order
    df = df.withColumn("rare", (F.col("k") - F.size("toks")).cast("int")).withColumn("room", F.col("places") - F.col("rare"))
    df = df.where("room > 0")

    def ordered(k: int) -> Column:
        return F.array_sort(F.transform("toks", lambda t: F.struct(
            t["c"].alias("c"), F.xxhash64(t["tok"], F.lit(k)).alias("h"), t["tok"].alias("tok"))))

    for k in range(ORDERS):
        df = df.withColumn(f"p{k}", F.transform(F.slice(ordered(k), F.lit(1), F.col("room")), lambda t: t["tok"]))
    # how common its tokens are on average: the middle of a group of copies has few that are its own
    mid = F.floor(F.aggregate("toks", F.lit(0), lambda a, t: a + t["c"]) * 1000 / F.col("k")).cast("int")
    return df.select("uid", "n", mid.alias("mid"), *[f"p{k}" for k in range(ORDERS)])


def _beside(again: DataFrame) -> DataFrame:
    """``(key, uid)``: the sets of a pivot ``a`` under the tokens of their differences' prefixes, rare tokens first."""
    each = again.select("places", F.struct("a", "b").alias("uid"), F.col("beside").alias("sample"))
    rows = each.select("uid", "sample").mapInArrow(_explode, "tok long, uid struct<a:long,b:long>").select(
        F.col("uid.a").alias("a"), F.col("uid.b").alias("b"), "tok")
    counts = rows.groupBy("a", "tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    lists = rows.join(counts, ["a", "tok"]).groupBy("a", "b").agg(
        F.sort_array(F.collect_list(F.struct("df", F.xxhash64("tok").alias("h"), "tok"))).alias("toks"))
    room = F.col("places") - (F.floor(F.length("beside") / 8) - F.size("toks"))
    out = lists.join(again.select("a", "b", "places", "beside"), ["a", "b"]).withColumn("room", room.cast("int")).where("room > 0")
    out = out.select("a", "b", F.explode(F.slice("toks", F.lit(1), F.col("room"))).alias("t"))
    return out.select(F.xxhash64("a", "t.tok").alias("key"), F.col("b").alias("uid")).distinct()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per set ``SKETCH`` bits: whether an odd number of its tokens falls on each place."""
    for batch in batches:
        bits = np.zeros((batch.num_rows, SKETCH), np.uint8)
        for row, x in enumerate(batch.column("whole")):
            at = np.frombuffer(x.as_buffer(), U64) & np.uint64(SKETCH - 1)
            bits[row] = np.bincount(at.astype(np.int64), minlength=SKETCH) & 1
        words = np.packbits(bits, axis=1).view(np.int64).ravel()
        off = np.arange(batch.num_rows + 1, dtype=np.int32) * (SKETCH // 64)
        yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.ListArray.from_arrays(pa.array(off), pa.array(words))], names=["uid", "bits"])


def _meeting(rows: DataFrame, prefixes: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of sets of one key and different components that may be linked.

    A pair must be near in size, and the places where its sketches differ,
    which are no more than the tokens that only one of the sets has, must
    leave room for the similarity. Both are the join's condition, so little
    more than links comes out, and a row's size doesn't grow with its set.
    What comes out must meet under all other orders too.
    """
    near = (F.col("l.n") * percent <= F.col("r.n") * 100) & (F.col("r.n") * percent <= F.col("l.n") * 100)
    uids = rows.select("uid").distinct()
    uids = F.broadcast(uids) if uids.count() <= BROADCAST_IDS else uids
    sets = whole.join(uids, "uid", "left_semi").mapInArrow(_sketches, "uid long, bits array<long>").dropDuplicates(["uid"])
    full = rows.select("key", "uid", "n", "comp").join(sets, "uid")
    differ = F.aggregate(F.zip_with("l.bits", "r.bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    cond = (F.col("l.key") == F.col("r.key")) & (F.col("l.uid") < F.col("r.uid")) & (F.col("l.comp") != F.col("r.comp")) & near
    cond = cond & (differ * (100 + percent) <= (F.col("l.n") + F.col("r.n")) * (100 - percent))
    met = full.alias("l").join(full.alias("r"), cond).select(F.col("l.uid").alias("a"), F.col("r.uid").alias("b")).distinct()
    wanted = prefixes.join(uids, "uid", "left_semi")
    for side in ("a", "b"):
        met = met.join(wanted.select(F.col("uid").alias(side), *[F.col(f"p{k}").alias(f"{side}{k}") for k in range(1, ORDERS)]), side)
    for k in range(1, ORDERS):
        met = met.where(F.arrays_overlap(f"a{k}", f"b{k}"))
    return met.select("a", "b")


def _links(spark: SparkSession, scratch: Scratch, index: DataFrame, whole: DataFrame, percent: int) -> DataFrame | None:
    """Verified links ``(u, v)`` of sets that connect what any link connects (step 4 of the module's text)."""
    prefixes = index.select("uid", *[f"p{k}" for k in range(1, ORDERS)])
    size_of = index.select("uid", "n", "mid")
    links: list[DataFrame] = []

    def verify(pairs: DataFrame, differences: bool) -> DataFrame:
        both = pairs.join(whole.select(F.col("uid").alias("b"), F.col("whole").alias("y")), "b")             .join(whole.select(F.col("uid").alias("a"), F.col("whole").alias("x")), "a")
        return both.select("a", "b", "x", "y").mapInArrow(_compare(percent, differences), COMPARED)

    def unfinished(rows: DataFrame, name: str) -> DataFrame:
        """``(key, uid)`` rows of keys whose sets are not all of one component, with the sets' component and size."""
        comp = components(spark, all_links(), scratch, name) if links else None
        rows = rows.join(size_of, "uid")
        if comp is not None:
            comp = scratch.table(comp, f"{name}-comp")
            rows = rows.join(comp.withColumnRenamed("node", "uid"), "uid", "left").withColumn(
                "comp", F.coalesce("component", "uid")).drop("component")
        else:
            rows = rows.withColumn("comp", F.col("uid"))
        rows = scratch.table(rows, f"{name}-all")
        mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
        return scratch.table(rows.join(mixed, "key"), name)

    def all_links() -> DataFrame:
        out = links[0]
        for x in links[1:]:
            out = out.unionByName(x)
        return out

    near = (F.col("l.n") * percent <= F.col("r.n") * 100) & (F.col("r.n") * percent <= F.col("l.n") * 100)
    rows = unfinished(index.select(F.explode("p0").alias("key"), "uid").distinct(), "open0")
    for step in range(ROUNDS + 1):
        if rows.isEmpty():
            break
        if step == ROUNDS:
            pairs = scratch.table(_meeting(rows, prefixes, whole, percent), f"pairs{step}")
            links.append(scratch.table(verify(pairs, False).where("linked").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(),
                                       f"links{step}"))
            break
        # the pivot: the set of the most common tokens, most likely the middle of its copies; then the smallest
        pivots = scratch.table(rows.groupBy("key").agg(F.min(F.struct(-F.col("mid"), "n", "uid")).alias("p")).select(
            "key", F.col("p.uid").alias("a")), f"pivots{step}")
        met = rows.join(pivots, "key").where("uid <> a").select("a", F.col("uid").alias("b")).distinct()
        found = scratch.table(verify(met, True), f"found{step}")
        links.append(found.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
        rest = unfinished(rows.join(pivots, "key").where("uid <> a").select("key", "uid"), f"rest{step}")
        # what is still open meets again beside its pivot
        again = rest.join(pivots, "key").select("a", F.col("uid").alias("b"), "comp", "n").distinct().join(found, ["a", "b"])
        again = scratch.table(again, f"again{step}")
        small = again.where("not linked").select("a", "b", "comp", "n", F.floor(F.col("both") * (100 + percent) / percent - F.col("n")).alias("most"))
        odd = small.alias("l").join(again.alias("r"), (F.col("l.a") == F.col("r.a")) & (F.col("r.n") <= F.col("l.most"))
                                    & (F.col("l.comp") != F.col("r.comp")) & near).select(
            F.least("l.b", "r.b").alias("a"), F.greatest("l.b", "r.b").alias("b")).distinct()
        odd = scratch.table(odd, f"odd{step}")
        links.append(scratch.table(verify(odd, False).where("linked").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(),
                                   f"links{step}"))
        rows = unfinished(_beside(again), f"open{step + 1}")
        done = tuple(f"{t}{step}" for t in ("open", "pivots", "rest", "again", "odd"))
        scratch.drop(*[t for t in scratch.paths if t.startswith(done)])
    return all_links() if links else None
