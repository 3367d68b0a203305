"""Near-duplicate documents by HyperMinHash.

A document is its set of 5-word shingles.  Each shingle's hash falls into one of
256 buckets; a bucket's register keeps the least hash there as its number of
leading zeros and the 10 bits after the leading one, 16 bits in all.  Empty
buckets borrow from others in an order all documents share.  Bands of 6 registers
bring documents together: two at a similarity of 0.8 miss each other in all 42
bands three times in 10^6, two at 0.85 once in 4 * 10^8.  Within a band's bucket
no pairs are listed: all members are compared to one of them, the leader, first by
the registers' estimate, corrected for chance collisions, then on the full sets.
Buckets that are one component then are settled.  The members of the others, texts that are alike but
not near enough to their leader, meet anew in the shingles of their prefixes (see
prefixes), which any two that can link share.  There a few members meet each
other, and a crowd meets leaders, more in each round, until every bucket is one
component or exhausted; so no link between documents that share a bucket is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.components import components
from quern.llm.store import Store
from quern.llm.vectors import BLANK_WORDS, U, blocks, grams, mix, prefix, spans, words

SHINGLE, PERCENT = 5, 80
BUCKETS, ROWS = 256, 6
MANTISSA = 10
EMPTY = np.uint16(0xFFFF)
#: A bucket of prefixes with so few members has no leaders: each meets the others that it can link with.
SMALL = 32


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted; a text of fewer words is one shingle, one of none has none."""
    _, _, _, names, first = words(texts, BLANK_WORDS, lower=True)
    sums = prefix(names)
    whole = grams(sums, SHINGLE)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(whole[a : b - SHINGLE + 1]))
        else:
            out.append(mix(spans(sums, np.array([a]), np.array([b])) + U(b - a)) if b > a else np.zeros(0, U))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers for each set, EMPTY where no shingle falls."""
    size = np.array([len(x) for x in sets])
    flat = mix(np.concatenate([np.zeros(0, U), *sets]) + U(0x2545F4914F6CDD1D))
    least = np.full(len(sets) * BUCKETS, ~U(0))
    np.minimum.at(least, np.repeat(np.arange(len(sets)), size) * BUCKETS + (flat >> U(56)).astype(np.int64), flat << U(8) >> U(12))
    empty = least == ~U(0)
    value = np.where(empty, U(1), np.maximum(least, U(1)))
    exponent = np.frexp(value.astype(np.float64))[1]  # value has at most 52 bits, so this is exact
    zeros = 52 - exponent
    mantissa = (value << zeros.astype(U) >> U(51 - MANTISSA)) & U((1 << MANTISSA) - 1)
    out = (zeros.astype(np.uint16) << MANTISSA | mantissa.astype(np.uint16)).astype(np.uint16)
    out[empty] = EMPTY
    return out.reshape(-1, BUCKETS)


def filled(own: np.ndarray) -> np.ndarray:
    """The registers with each empty one replaced by the first full one in the order that its place prescribes."""
    out = own.copy()
    row, place = np.nonzero(own == EMPTY)
    has = (own != EMPTY).any(1)
    row, place = row[has[row]], place[has[row]]
    attempt = 0
    while len(row):
        attempt += 1
        other = (mix((place * 1_000_003 + attempt).astype(U)) >> U(56)).astype(np.int64)
        found = own[row, other]
        out[row, place] = found
        left = found == EMPTY
        row, place = row[left], place[left]
    return out


def band_keys(full: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row."""
    n = BUCKETS // ROWS
    parts = full[:, : n * ROWS].reshape(len(full), n, ROWS).astype(U)
    key = np.broadcast_to(mix(np.arange(n).astype(U) + U(77)), parts.shape[:2])
    for i in range(0, ROWS, 3):
        key = mix(key ^ (parts[:, :, i] | parts[:, :, i + 1] << U(16) | parts[:, :, i + 2] << U(32)) + U(i))
    return key


def collision_rate(n: int, m: int) -> float:
    """Expected share of registers that agree for two disjoint sets of n and m shingles: both least values in one cell of the register's grid."""
    a, b = max(1.0, n / BUCKETS), max(1.0, m / BUCKETS)
    zeros = np.arange(0, 40)[:, None]
    cell = np.arange(1 << MANTISSA)[None, :]
    low = 2.0 ** -(zeros + 1.0) * (1 + cell / (1 << MANTISSA))
    high = low + 2.0 ** -(zeros + 1.0) / (1 << MANTISSA)
    return float((((1 - low) ** a - (1 - high) ** a) * ((1 - low) ** b - (1 - high) ** b)).sum())


#: Collision rates for sets of 2^i shingles (the smaller of the two decides, within a factor).
_RATES = np.array([collision_rate(1 << i, 1 << i) for i in range(32)])


def estimates(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of rows of filled registers, for sets of n and m shingles."""
    same = (a == b).mean(1)
    rate = _RATES[np.minimum(31, np.log2(np.maximum(1, np.minimum(n, m))).astype(int))]
    return np.clip((same - rate) / (1 - rate), 0, 1)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc, n, s1, s2, regs) of docs(doc, text): size and two sums that tell the set, and its filled registers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches):
            sets = shingle_sets(texts)
            full = filled(registers(sets))
            sums = [np.array([mix(x + U(k)).sum(dtype=U) for x in sets], U).view(np.int64) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([len(x) for x in sets], pa.int64()), *map(pa.array, sums), pa.array([x.tobytes() for x in full], pa.binary())], ["doc", "n", "s1", "s2", "regs"])

    return docs.mapInArrow(run, "doc bigint, n bigint, s1 bigint, s2 bigint, regs binary")


def banded(reps: DataFrame) -> DataFrame:
    """(key, doc): the buckets of reps(doc, regs)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            full = np.frombuffer(b"".join(rows.column(1).to_pylist()), np.uint16).reshape(-1, BUCKETS)
            keys = band_keys(full)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), rows.column(0).take(pa.array(np.repeat(np.arange(len(full)), keys.shape[1])))], ["key", "doc"])

    return reps.select("doc", "regs").mapInArrow(run, "key bigint, doc bigint")


def prefixes(store: Store, open_: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(key, doc, n, u) of the documents of open_(doc): a bucket for each shingle of their prefixes, u of the text's shingles stand before it.

    A text's shingles stand in one order for all, the rarest among these texts
    first.  Two sets that reach the threshold share at least that percentage of
    either, so the first shingle that they share stands in the prefix of both:
    among the n - ceil(n * percent / 100) + 1 first.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, own in blocks(batches):
            sets = shingle_sets(own)
            size = np.array([len(x) for x in sets])
            owner = pa.array(np.repeat(np.arange(len(sets)), size))
            yield pa.RecordBatch.from_arrays([rows.column(0).take(owner), rows.column(1).take(owner), pa.array(size).take(owner), pa.array(np.concatenate([np.zeros(0, U), *sets]).view(np.int64))], ["doc", "row", "n", "s"])

    some = texts.join(open_.select(F.col("doc").alias("d")).distinct(), F.col("doc") == F.col("d"), "left_semi").select("doc", F.xxhash64("text").alias("row"), "text").dropDuplicates(["doc", "row"])
    held = store.keep(some.mapInArrow(run, "doc bigint, row bigint, n bigint, s bigint"))
    often = held.groupBy(F.col("s").alias("k")).agg(F.count(F.lit(1)).alias("c"))
    ordered = held.join(often, F.col("s") == F.col("k")).groupBy("doc", "row", "n").agg(F.array_sort(F.collect_list(F.struct("c", "s"))).alias("x"))
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return ordered.select("doc", "n", F.posexplode(F.slice("x", F.lit(1), first.cast("int"))).alias("u", "x")).where("x.c > 1").select(F.col("x.s").alias("key"), "doc", "n", F.col("u").cast("bigint").alias("u"))


def possible(n: Column | str, u: Column | str, m: Column | str, v: Column | str, percent: int) -> Column:
    """Whether sets of n and m shingles, u and v of them in no other set, can reach the threshold: they share no more than either's other shingles."""
    n, u, m, v = (F.col(x) if isinstance(x, str) else x for x in (n, u, m, v))
    both = F.least(n - u, m - v)
    return 100 * both >= percent * (n + m - both)


def likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose estimate is less than six standard deviations below the threshold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(rows.column(i).to_pylist()), np.uint16).reshape(-1, BUCKETS) for i in (2, 3))
            n, m = (rows.column(i).to_numpy() for i in (4, 5))
            least = percent / 100
            cut = least - 6 * np.sqrt(least * (1 - least) / np.clip(np.minimum(n, m) / 4, 1, BUCKETS))
            keep = pa.array(np.flatnonzero(estimates(a, b, n, m) >= cut))
            yield pa.RecordBatch.from_arrays([rows.column(0).take(keep), rows.column(1).take(keep)], ["u", "v"])

    one = reps.select(F.col("doc").alias("u"), F.col("regs").alias("a"), F.col("n").alias("n"))
    two = reps.select(F.col("doc").alias("v"), F.col("regs").alias("b"), F.col("n").alias("m"))
    # sizes alone rule out most chance meetings
    sized = pairs.join(two, "v").join(one, "u").where(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    return sized.select("u", "v", "a", "b", "n", "m").mapInArrow(run, "u bigint, v bigint")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose full sets reach the threshold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, bytes, np.ndarray] = (None, b"", np.zeros(0, U))
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                rows = whole.slice(at, 64)
                u, v = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                a, b = ([x or b"" for x in rows.column(i).cast(pa.binary()).to_pylist()] for i in (2, 3))
                sets, keep = shingle_sets(b), []
                for i, other in enumerate(sets):
                    if last[0] != u[i] or last[1] != a[i]:
                        last = (u[i], a[i], shingle_sets([a[i]])[0])
                    both = len(np.intersect1d(last[2], other, assume_unique=True))
                    if 100 * both >= percent * (len(last[2]) + len(other) - both):
                        keep.append(i)
                yield pa.RecordBatch.from_arrays([pa.array([u[i] for i in keep], pa.int64()), pa.array([v[i] for i in keep], pa.int64())], ["u", "v"])

    one, two = (texts.select(F.col("doc").alias(x), F.col("text").alias(f"text_{x}")) for x in "uv")
    return pairs.join(two, "v").join(one, "u").select("u", "v", "text_u", "text_v").mapInArrow(run, "u bigint, v bigint")


def met(buckets: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of a bucket's members with its leaders(k, lead, m, v, other) that can reach the threshold and aren't joined yet."""
    both = buckets.join(leaders, (F.col("key") == F.col("k")) & (F.col("root") != F.col("other")) & possible("n", "u", "m", "v", percent))
    return both.select(F.least("lead", "doc").alias("u"), F.greatest("lead", "doc").alias("v"))


def groups(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each document.

    A null, empty or blank text has no shingles and links with nothing, nor does
    a row with a null id (its component is null, and it is kept).  Equal sets are
    one document for the search; rows that share an id share a component.
    """
    return grouped(Store(docs.sparkSession, "minhash"), docs.select(F.col(id).cast("bigint").alias("doc"), F.col(text).alias("text")), percent)


def grouped(store: Store, docs: DataFrame, percent: int) -> DataFrame:
    """groups() of docs(doc, text); what it reads is all that stays in the store."""
    sig = store.keep(signatures(docs))
    some = sig.where("n > 0 and doc is not null")
    reps = store.keep(some.groupBy("n", "s1", "s2").agg(F.min("doc").alias("doc"), F.first("regs").alias("regs")))
    bands = store.keep(banded(reps))
    often = bands.groupBy(F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("k")
    buckets = store.keep(bands.join(often, F.col("key") == F.col("k")).select("key", "doc").distinct())
    # the more buckets a document shares, the more central it is
    shared = store.keep(buckets.groupBy(F.col("doc").alias("d")).agg(F.count(F.lit(1)).alias("shared")))
    texts = store.keep(docs.join(shared, F.col("doc") == F.col("d"), "left_semi"))
    near = store.keep(reps.join(shared, F.col("doc") == F.col("d"), "left_semi"))
    sizes = shared.join(near.groupBy("doc").agg(F.max("n").alias("n")), F.col("d") == F.col("doc")).select("d", "n", "shared")
    buckets = store.keep(buckets.join(sizes, F.col("doc") == F.col("d")).select("key", "doc", "n", F.lit(0).cast("bigint").alias("u"), F.col("doc").alias("root"), "shared"))
    links, roots = [], None

    def test(pairs: DataFrame) -> None:
        links.append(store.keep(confirmed(store.keep(likely(pairs.distinct(), near, percent)), texts, percent)))

    # one leader a bucket: most buckets are one component then
    chosen = store.keep(buckets.groupBy(F.col("key").alias("k")).agg(F.max_by(F.struct("doc", "n", "u"), F.struct("shared", -F.col("doc"))).alias("x")).select("k", F.col("x.doc").alias("lead"), F.col("x.n").alias("m"), F.col("x.u").alias("v"), F.col("x.doc").alias("other")))
    test(met(buckets, chosen, percent))
    roots = components(store, links[-1])
    open_ = hopeful(store, unled(buckets.drop("shared"), chosen, roots), percent)
    store.drop(chosen, buckets)
    # what is left are crowded buckets of texts alike but not near enough to the leader: they meet in their prefixes instead
    buckets = hopeful(store, rooted(prefixes(store, open_, texts, percent), roots, "doc", "root"), percent)
    leaders = SMALL
    while not buckets.isEmpty():
        size = store.keep(buckets.groupBy(F.col("key").alias("b")).agg(F.count(F.lit(1)).alias("c")))
        sized = buckets.join(size, F.col("key") == F.col("b")).drop("b")
        small, large = sized.where(F.col("c") <= SMALL).drop("c"), sized.where(F.col("c") > SMALL).drop("c")
        every = small.select(F.col("key").alias("k"), F.col("doc").alias("lead"), F.col("n").alias("m"), F.col("u").alias("v"), F.col("root").alias("other"))
        slot = F.pmod(F.xxhash64("doc", F.lit(leaders)), F.lit(leaders))
        chosen = store.keep(large.groupBy(F.col("key").alias("k"), slot.alias("slot")).agg(F.min_by(F.struct("doc", "n", "u", "root"), F.struct("u", "doc")).alias("x")).select("k", F.col("x.doc").alias("lead"), F.col("x.n").alias("m"), F.col("x.u").alias("v"), F.col("x.root").alias("other")))
        test(met(buckets, every.unionByName(chosen), percent))
        if chosen.isEmpty():
            break
        roots = components(store, roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(links[-1]))
        rest = hopeful(store, unled(large, chosen, roots), percent)
        store.drop(buckets, size, chosen)
        buckets = rest
        leaders *= SMALL
    store.drop(texts, near, buckets)
    named = reps.select("n", "s1", "s2", F.col("doc").alias("rep"))
    member = store.keep(sig.select("doc", "n", "s1", "s2").join(named, ["n", "s1", "s2"], "left").select("doc", "n", "rep"))
    # an id with several texts joins the groups of all of them
    several = member.groupBy(F.col("doc").alias("d")).agg(F.min("rep").alias("v"), F.max("rep").alias("w")).where("v <> w").select("d", "v")
    several = member.join(several, F.col("doc") == F.col("d")).select(F.col("rep").alias("u"), "v")
    late = several
    for found in links[1:]:
        late = late.unionByName(found)
    late = store.keep(late)
    if not late.isEmpty():
        roots = components(store, roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(late))
    store.clear(member, roots)
    out = rooted(member, roots, "rep", "root").withColumn("root", F.when(F.col("doc").isNotNull(), F.coalesce("root", "doc")))
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("root").alias("component_id"), F.col("doc").eqNullSafe(F.col("root")).alias("kept"))


def unled(buckets: DataFrame, chosen: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of the buckets but their leaders, who have met all others, with their present roots."""
    rest = buckets.join(chosen.select("k", "lead"), (F.col("key") == F.col("k")) & (F.col("doc") == F.col("lead")), "left_anti").drop("root")
    return rooted(rest, roots, "doc", "root")


def hopeful(store: Store, buckets: DataFrame, percent: int) -> DataFrame:
    """The rows of buckets(key, doc, n, u, root) that can still gain a link there.

    A bucket of one component is settled.  From the others go the rows whose u
    shingles alone, which no other of the bucket has, keep them from the threshold
    with a set as small as the bucket's least.
    """
    buckets = store.keep(buckets)
    least = buckets.groupBy(F.col("key").alias("k")).agg(F.min("root").alias("a"), F.max("root").alias("b"), F.min("n").alias("least")).where("a <> b").select("k", "least")
    shared = F.col("n") - F.col("u")
    floor = F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))
    rest = store.keep(buckets.join(least, F.col("key") == F.col("k")).where(100 * shared >= percent * (F.col("n") + floor - shared)).select("key", "doc", "n", "u", "root"))
    again = rest.groupBy(F.col("key").alias("k")).agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("k")
    out = store.keep(rest.join(again, F.col("key") == F.col("k"), "left_semi"))
    store.drop(buckets, rest)
    return out


def rooted(table: DataFrame, roots: DataFrame, node: str, name: str) -> DataFrame:
    """table with the root of the column node (itself where it has no other)."""
    known = roots.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    return table.join(known, F.col(node) == F.col("__node"), "left").withColumn(name, F.coalesce("__root", node)).drop("__node", "__root")


def first_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """docs without those that belong to a group of near duplicates and aren't its least id; all columns stay.

    Every row is a document of its own: of rows that share an id the one that
    stands first in the table stays, and rows without an id come after all others.
    """
    store, search, columns = Store(docs.sparkSession, "near"), Store(docs.sparkSession, "minhash"), docs.columns
    # the texts, most of the table, are in it once
    rows = store.keep(docs.select(F.struct(*(docs[x] for x in columns)).alias("whole"), docs[id].cast("bigint").alias("doc"), F.monotonically_increasing_id().alias("row")))
    texts = rows.select(F.col("row").alias("doc"), F.col("whole")[text].alias("text"))
    found = store.keep(grouped(search, texts, percent).select(F.col("doc_id").alias("r"), F.col("component_id").alias("c")))
    search.clear()
    several = found.where("r <> c").select(F.col("c").alias("several")).distinct()
    member = store.keep(found.join(several, F.col("c") == F.col("several"), "left_semi").join(rows.select("row", "doc"), F.col("r") == F.col("row")).select("row", "c", "doc"))
    first = member.groupBy(F.col("c").alias("of")).agg(F.min(F.struct(F.col("doc").isNull(), "doc", "row")).alias("first"))
    gone = store.keep(member.join(first, F.col("c") == F.col("of")).where(F.col("row") != F.col("first.row")).select(F.col("row").alias("gone")))
    store.clear(rows, gone)
    return rows.join(gone, F.col("row") == F.col("gone"), "left_anti").select("whole.*")
