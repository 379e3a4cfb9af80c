"""Near-duplicate documents by HyperMinHash sketches, bands and verified links.

1. One pass shingles every whole text (five lower-cased words).  Each distinct shingle's 64-bit hash picks one of 512
   buckets; a bucket keeps its smallest hash as a 16-bit register: leading-zero count (6 bits) and the 10 bits after
   the first one.
2. Equal shingle sets collapse to one class, named after its smallest id.
3. Bands of five registers are join keys.  For them, empty buckets of small sets copy another bucket along a fixed
   permutation per bucket, which keeps the chance that two registers agree equal to the Jaccard similarity.  A pair at the threshold shares none of the 64 bands with a chance of 3e-8.
   In each band's group every member is paired with the group's smallest id only; a document keeps the partner with
   which it shares most bands.
4. Pairs are filtered by set sizes and by the collision-corrected estimate (with five standard errors of slack), then
   verified on the full shingle sets.  Verified links give components.
5. In groups that still hold several components, the members outside the largest one visit the group's blocks, where
   they are compared with members of other components inside the task, best estimates first.  A block keeps a
   union-find of its components: sets of up to 256 shingles are decided there, larger ones are presumed linked and
   verified afterwards, and a pair that is already connected is skipped.  So a block emits fewer links than it has
   components, however many of its pairs are alike.
6. Groups where a presumed link fails are gone through once more, with every open pair verified.  The components of
   all links are the result.

Groups never meet in one task unless they are small: stars come from pre-aggregated minima and equi-joins, large
groups are cut into blocks, and a star's centre is copied to salted shares of its members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.rolling import mix
from ledgerloom.llm.store import dropped, written
from ledgerloom.llm.words import shingle_hashes, text_chunks, word_hashes

BUCKET_BITS = 9
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BANDS, BAND_SIZE = 64, 5
EMPTY = np.uint16(0xFFFF)
SHARE = 512  # members of a star that one salted share holds
BLOCK = 256  # members of a group in one block, which the others visit
VISITORS = 2000  # visitors of a block whose open pairs are held at a time
SMALL = 256  # sets of up to so many shingles travel to blocks whole, in place of their registers
NO_ID = 1 << 62  # documents without an id take part under a hash of their text from here on

_random = np.random.default_rng(20240229)
_PROBES = np.array([_random.permutation(BUCKETS) for _ in range(BUCKETS)])
_BAND_REGISTERS = np.array([_random.permutation(BUCKETS)[:BAND_SIZE] for _ in range(BANDS)])
_BAND_FACTORS = mix(np.arange(7, 7 + BANDS * BAND_SIZE, dtype=np.uint64)).reshape(BANDS, BAND_SIZE) | np.uint64(1)


def distinct_sets(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text and their row numbers."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((shingles, rows))
    shingles, rows = shingles[order], rows[order]
    keep = np.ones(len(rows), dtype=bool)
    keep[1:] = (shingles[1:] != shingles[:-1]) | (rows[1:] != rows[:-1])
    return shingles[keep], rows[keep]


def registers_of(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """(n_rows, 512) registers from each row's sorted distinct hashes; EMPTY throughout for an empty set."""
    out = np.full((n_rows, BUCKETS), EMPTY, dtype=np.uint16)
    if not len(hashes):
        return out
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    place = rows * BUCKETS + bucket
    first = np.concatenate(([True], place[1:] != place[:-1]))
    rest = hashes[first] << np.uint64(BUCKET_BITS)
    zeros = 52 - np.frexp((rest >> np.uint64(12)).astype(np.float64))[1].astype(np.int64)
    shift = np.minimum(zeros + 1, 63).astype(np.uint64)
    mantissa = (rest << shift) >> np.uint64(64 - MANTISSA_BITS)
    out.ravel()[place[first]] = (zeros.astype(np.uint16) << MANTISSA_BITS) | mantissa.astype(np.uint16)
    return out


def densified(registers: np.ndarray) -> np.ndarray:
    """The registers with each empty one filled from the first that is not, along a fixed order of its own."""
    filled = registers.copy()
    todo = np.flatnonzero((registers == EMPTY).any(axis=1) & (registers != EMPTY).any(axis=1))
    for step in range(BUCKETS):
        if not len(todo):
            break
        part = filled[todo]
        part = np.where(part == EMPTY, registers[todo][:, _PROBES[:, step]], part)
        filled[todo] = part
        todo = todo[(part == EMPTY).any(axis=1)]
    return filled


def estimate(equal: np.ndarray, filled: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard estimate from the numbers of equal registers and of those that either set fills.

    Two different minima land in the same register with a chance of about 0.17 * 4ab/(a+b)**2 / 2**mantissa_bits; that
    share of the registers is taken off."""
    n_a, n_b = n_a.astype(float), n_b.astype(float)
    chance = 0.17 * 4 * n_a * n_b / np.maximum(n_a + n_b, 1) ** 2 / (1 << MANTISSA_BITS)
    return np.clip((equal / np.maximum(filled, 1) - chance) / (1 - chance), 0, 1)


def margins(registers_a: np.ndarray, registers_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """By how much the estimate lies above what the threshold leaves room for; -1 where sizes rule a link out.

    The filled buckets are a sample, without replacement, of the united shingles; its standard error shrinks as it nears
    all of them.  Five of those and two registers are the slack."""
    share = percent / 100
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    there = registers_a != EMPTY
    equal = ((registers_a == registers_b) & there).sum(axis=-1)
    filled = (there | (registers_b != EMPTY)).sum(axis=-1)
    united = np.maximum((n_a + n_b) / (1 + share), 1)
    error = np.sqrt(share * (1 - share) / np.maximum(filled, 1) * np.clip(1 - filled / united, 0.02, 1))
    above = estimate(equal, filled, n_a, n_b) - (share - 5 * error - 2 / np.maximum(filled, 1))
    return np.where(100 * small >= percent * large, above, -1.0)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted shingle sets reach the threshold."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for first, last, data, offsets in text_chunks(batch.column("text")):
            hashes, rows = distinct_sets(*shingle_hashes(*word_hashes(data, offsets)))
            n = np.bincount(rows, minlength=last - first)
            ends = np.concatenate(([0], np.cumsum(n)))
            sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64))) for x in (hashes, mix(hashes))]
            set_a, set_b = ((s[ends[1:]] - s[ends[:-1]]).view(np.int64) for s in sums)
            registers = registers_of(hashes, rows, last - first)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, last - first), pa.array(n, pa.int64()), pa.array(set_a), pa.array(set_b), pa.array([r.tobytes() for r in registers], pa.binary())],
                names=["doc_id", "n_shingles", "set_a", "set_b", "registers"],
            )


def _register_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)


def keys_of(registers: np.ndarray) -> np.ndarray:
    """(rows, BANDS) keys of each row's bands."""
    filled = densified(registers).astype(np.uint64)
    return mix((filled[:, _BAND_REGISTERS] * _BAND_FACTORS).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.slice(at, 2000)
            keys = keys_of(_register_matrix(part.column("registers")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(part.column("doc_id").to_numpy(), BANDS))], names=["key", "doc_id"]
            )


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Registers, band keys and whole sorted sets, once for every document that some group holds."""
    for batch in batches:
        ids = batch.column("doc_id")
        for first, last, data, offsets in text_chunks(batch.column("text")):
            hashes, rows = distinct_sets(*shingle_hashes(*word_hashes(data, offsets)))
            cuts = np.searchsorted(rows, np.arange(last - first + 1))
            registers = registers_of(hashes, rows, last - first)
            sets = [hashes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, last - first), pa.array(np.diff(cuts), pa.int64()), *(pa.array([r.tobytes() for r in rows], pa.binary()) for rows in (registers, keys_of(registers))), pa.array(sets, pa.binary())],
                names=["doc_id", "n_shingles", "registers", "keys", "shingles"],
            )


class _Components:
    """Union-find over the component labels of one block."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def find(self, x: int) -> int:
        while self.above.get(x, x) != x:
            self.above[x] = self.above.get(self.above[x], self.above[x])
            x = self.above[x]
        return x


def _unpacked(group: pa.Table) -> tuple[np.ndarray, list[np.ndarray | None]]:
    """Registers of all rows of a block, and the whole sets of its small ones."""
    small = group.column("small").to_numpy()
    packed = group.column("packed").to_pylist()
    sets = [np.frombuffer(p, dtype=np.uint64) if own else None for p, own in zip(packed, small)]
    registers = np.empty((len(group), BUCKETS), dtype=np.uint16)
    at = np.flatnonzero(~small)
    if len(at):
        registers[at] = np.frombuffer(b"".join(packed[i] for i in at), dtype=np.uint16).reshape(-1, BUCKETS)
    at = np.flatnonzero(small)
    if len(at):
        own = [sets[i] for i in at]
        registers[at] = registers_of(np.concatenate(own), np.repeat(np.arange(len(own)), [len(s) for s in own]), len(own))
    return registers, sets


def _block_links(percent: int, every: bool):
    """Links of blocks: (key, lead, doc_id, sure).  ``every``: open pairs of large sets are all emitted, not presumed."""

    def links(group: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, comp, n, visits, largest = (group.column(c).to_numpy() for c in ("doc_id", "component", "n_shingles", "visits", "of_largest"))
        right, left = np.flatnonzero(~visits), np.flatnonzero(visits)
        if not len(left) or not len(right):
            return
        registers, sets = _unpacked(group)
        key = group.column("key")[0].as_py()
        own_key = np.uint64(key & (1 << 64) - 1)
        keys = np.frombuffer(b"".join(group.column("keys").to_pylist()), dtype=np.uint64).reshape(-1, BANDS)
        joined, out = _Components(), []
        for some in np.split(left, range(VISITORS, len(left), VISITORS)):
            found = []
            for i in some:
                own = keys[i]
                j = right[(comp[right] != comp[i]) & (largest[right] | (ids[right] > ids[i]))]
                # a pair meets in every band that it shares; the first of them has it
                j = j[own[(own == keys[j]).argmax(axis=1)] == own_key]
                above = margins(registers[i][None, :], registers[j], np.full(len(j), n[i]), n[j], percent)
                may = above >= 0
                found.append((above[may], np.full(may.sum(), i), j[may]))
            above, one, other = (np.concatenate(c) for c in zip(*found))
            for k in np.argsort(-above, kind="stable"):
                i, j = int(one[k]), int(other[k])
                a, b = joined.find(int(comp[i])), joined.find(int(comp[j]))
                if a == b:
                    continue
                sure = sets[i] is not None and sets[j] is not None
                if sure and not linked(sets[i], sets[j], percent):
                    continue
                out.append((key, min(int(ids[i]), int(ids[j])), max(int(ids[i]), int(ids[j])), sure))
                if sure or not every:
                    joined.above[a] = b
        columns = zip(*out) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))], names=["key", "lead", "doc_id", "sure"])

    def groups(table: pa.Table, last: bool) -> Iterator[pa.Table]:
        keys = [table.column(c).to_numpy() for c in ("key", "block")]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        cuts = [0, *change.tolist(), len(table)]
        for a, b in zip(cuts[:-1], cuts[1:] if last else cuts[1:-1]):
            yield table.slice(a, b - a)
        return None if last else table.slice(cuts[-2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if carried is None else pa.concat_tables([carried, table])
            found = groups(table, False)
            while True:
                try:
                    yield from links(next(found))
                except StopIteration as end:
                    carried = end.value
                    break
        if carried is not None and len(carried):
            for group in groups(carried, True):
                yield from links(group)

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, lead_set, lead_registers = None, None, None
        for batch in batches:
            leads, ids, sets = batch.column("lead").to_numpy(), batch.column("doc_id").to_numpy(), batch.column("shingles")
            registers = _register_matrix(batch.column("registers")) if len(batch) else np.zeros((0, BUCKETS), np.uint16)
            a, b = [], []
            for i in range(len(batch)):
                own = np.frombuffer(sets[i].as_py(), dtype=np.uint64)
                if ids[i] == leads[i]:
                    lead, lead_set, lead_registers = leads[i], own, registers[i].copy()
                elif lead == leads[i]:
                    above = margins(lead_registers[None, :], registers[i][None, :], np.array([len(lead_set)]), np.array([len(own)]), percent)
                    if above[0] >= 0 and linked(lead_set, own, percent):
                        a.append(leads[i])
                        b.append(ids[i])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _verified(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links among ``pairs`` (lead, doc_id).  Every salted share of a lead's partners gets its own copy of the lead."""
    shares = pairs.groupBy("lead").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    partners = pairs.join(shares, "lead").select("lead", "doc_id", F.pmod(F.xxhash64("doc_id"), "shares").cast("int").alias("share"))
    centres = shares.select("lead", F.col("lead").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    rows = partners.unionByName(centres).join(members.select("doc_id", "registers", "shingles"), "doc_id")
    dealt = rows.repartition("lead", "share").sortWithinPartitions("lead", "share", F.col("lead") != F.col("doc_id"))
    return dealt.select("lead", "doc_id", "registers", "shingles").mapInArrow(_verify(percent), "a long, b long")


def _across(shared: DataFrame, members: DataFrame, found: DataFrame, percent: int, every: bool) -> DataFrame:
    """Links between components of ``found`` that meet in a band's group of ``shared`` (key, doc_id), as of _block_links."""
    placed = shared.select("key", "doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    # per group and component: members of the group's largest component meet the others, not each other
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(F.sum("n").alias("total"), F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("components")).where("components > 1")
    open_rows = placed.join(mixed.select("key", "largest", F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks")), "key").withColumn("own", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
    resting = open_rows.select("key", F.col("own").alias("block"), "doc_id", "component", F.lit(False).alias("visits"), (F.col("component") == F.col("largest")).alias("of_largest"))
    visiting = open_rows.where("component <> largest").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "doc_id", "component", F.lit(True).alias("visits"), F.lit(False).alias("of_largest")
    )
    small = F.col("n_shingles") <= SMALL
    packed = members.select("doc_id", "n_shingles", "keys", small.alias("small"), F.when(small, F.col("shingles")).otherwise(F.col("registers")).alias("packed"))
    dealt = resting.unionByName(visiting).join(packed, "doc_id").repartition("key", "block").sortWithinPartitions("key", "block")
    return dealt.mapInArrow(_block_links(percent, every), "key long, lead long, doc_id long, sure boolean")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text; more columns are ignored).

    Two documents are linked if 100 * common >= percent * united distinct shingles.  A null, empty or blank text has no
    shingles and is linked with nothing.  component_id is the smallest doc_id reachable over links; kept marks the
    document of that id.  Repeated doc_ids with equal texts stay separate rows; an empty table gives an empty result.
    Documents without an id link like others, equal texts as one; where no linked document has an id, component_id stays
    null and they are kept.  Ids are below 2**62.
    """
    spark = docs.sparkSession
    unnamed = F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(NO_ID))
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), unnamed).alias("doc_id"), "text")
    sketches, sketch_path = written(docs.mapInArrow(_sketch, "doc_id long, n_shingles long, set_a long, set_b long, registers binary"), "sketches")
    key = ["n_shingles", "set_a", "set_b"]
    classes = sketches.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("class_id"))
    labelled, _ = written(
        sketches.select("doc_id", *key).join(classes, key, "left").select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id")), "classes"
    )
    firsts = labelled.where("n_shingles > 0 and doc_id = class_id").select("doc_id").distinct()
    banded = sketches.join(firsts, "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "registers").mapInArrow(_band_keys, "key long, doc_id long")
    bands, band_path = written(banded, "bands")
    dropped(spark, sketch_path)
    groups = bands.groupBy("key").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("high")).where("lead < high").select("key", "lead")
    shared, shared_path = written(bands.join(groups, "key"), "shared-bands")
    dropped(spark, band_path)

    texts = docs.join(shared.select("doc_id").distinct(), "doc_id").dropDuplicates(["doc_id"])
    members, members_path = written(texts.mapInArrow(_members, "doc_id long, n_shingles long, registers binary, keys binary, shingles binary"), "members")

    stars = shared.where("doc_id <> lead").groupBy("doc_id", "lead").count().groupBy("doc_id").agg(F.max_by("lead", F.struct("count", -F.col("lead"))).alias("lead"))
    links, link_path = written(_verified(stars.select("lead", "doc_id"), members, percent), "links")
    found, paths = connected_components(links), [shared_path, members_path, link_path]
    for every in (False, True):
        across, across_path = written(_across(shared, members, found, percent, every), "across")
        presumed = across.where("not sure").select("lead", "doc_id").distinct()
        checked, checked_path = written(_verified(presumed, members, percent), "links")
        paths += [across_path, checked_path]
        more = across.where("sure").select(F.col("lead").alias("a"), F.col("doc_id").alias("b")).unionByName(checked)
        if not more.isEmpty():
            hung = found.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
            found = connected_components(hung.unionByName(more))
        pair = ["lead", "doc_id"]
        failed = across.where("not sure").join(checked.withColumnsRenamed({"a": "lead", "b": "doc_id"}), pair, "left_anti").select("key").distinct()
        if every or failed.isEmpty():
            break
        shared = shared.join(failed, "key")
    dropped(spark, *paths)
    placed = labelled.join(found.withColumnRenamed("node", "class_id"), "class_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"))
    named = lambda c: F.when(F.col(c) < NO_ID, F.col(c)).alias(c)
    return placed.select(named("doc_id"), "n_shingles", named("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

