"""Toxicity by two class-conditional Kneser-Ney models of the letters of words.

Each class has a model of the next byte of a word, given up to four bytes before it in the word, its opening and its end
included.  The highest order counts texts: in how many labelled texts of the class a word with that expression occurs.  Lower
orders count continuations, the number of different bytes that stand before an expression.  Counts are discounted by
``DISCOUNT``, and the discounted mass goes to the next lower order.  Orders up to ``SHARED`` are counted over all documents
and shared by both classes, so expressions that are rare in a class fall back to what both have in common and say nothing.
An expression that neither class has is looked up without its first bytes: how much mass a class leaves to what it has not
seen tells its number of texts, not what they say.  A word's first byte has only the space before it as its context; each class counts texts there and falls back to the shared
probabilities of that context.

A text's evidence is its log-likelihood under the toxic model less that under the ordinary one, by word; a few numbers fitted
on training texts that the scoring models have not seen turn it into a probability.

Up to five bytes are one whole number, the last byte lowest, so the suffix of an expression is a mask of it and its context a
shift.  All orders above the shared ones of one expression share the two bytes before the last; by these the counts are cut into
blocks of bounded size, whose models need nothing from each other, and texts are scored by one block after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerloom.llm.columns import unused
from ledgerloom.llm.rolling import fingerprints, prefix_sums
from ledgerloom.llm.store import dropped, written
from ledgerloom.llm.words import IN_WORD, LOWER, text_chunks

ORDER = 5  # bytes of an expression of the highest order
SHARED = 2  # orders that both classes share
DISCOUNT = 0.75
SHORT = 25  # words without evidence that are added to every text, so that few words say little
MAX_ROWS = 4_000  # texts per class that the calibration takes, about
MAX_EXPRESSIONS = 1_500_000  # expressions of the highest order in a block, about
MAX_BROADCAST = 500_000  # labels sent to the executors; more are shuffled
FOLDS = 4
SCALE = 10.0  # of the evidence in the fit, whose shrinkage is not free of units
SPACE = 32  # stands before and after every word
_LETTERS = np.where(IN_WORD, np.maximum(LOWER, 1), SPACE).astype(np.uint64)  # NUL counts as the next byte, so no expression opens with 0


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, fold of all labelled rows outside the held-out fifth, each text once a class."""
    own = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    hashes = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.octet_length("text").alias("bytes"))
    found = hashes.join(own, "doc_id").groupBy("doc_id", "hash", "bytes", "toxic").count()
    once, _ = written(found.groupBy("hash", "bytes", "toxic").agg(F.min(F.struct("doc_id", "count")).alias("row")).select("hash", "toxic", "row.*"), "labelled")
    repeated = not once.where("count > 1").isEmpty()
    once = F.broadcast(once) if once.count() <= MAX_BROADCAST else once
    rows = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text").join(once, ["doc_id", "hash"])
    if repeated:  # rows that share doc_id and text
        rows = rows.where("count = 1").unionByName(rows.where("count > 1").dropDuplicates(["hash", "toxic"]))
    return rows.select("text", "toxic", F.pmod(F.xxhash64(F.lit(7), "text"), F.lit(FOLDS)).cast("int").alias("fold"))


@dataclass
class Letters:
    """The places of a chunk of texts at which a model predicts a byte: those of words, and the space after each."""

    expression: np.ndarray  # the byte and up to ORDER - 1 before it, not beyond the space before the word
    word: np.ndarray  # number of the word in the chunk
    starts: np.ndarray  # of the words
    ends: np.ndarray
    bounds: np.ndarray  # where each text's words begin, one more at the end
    letters: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Letters:
        letters = np.insert(_LETTERS[data], offsets, SPACE)  # a space before each text and after the last
        space = letters == SPACE
        starts, ends = np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1
        last_space = np.maximum.accumulate(np.where(space, np.arange(len(letters)), 0))
        at = np.flatnonzero(~space | np.concatenate(([False], ~space[:-1])))
        length = np.minimum(at - last_space[at - 1] + 1, ORDER)
        packed = np.zeros(len(at), dtype=np.uint64)
        for back in range(ORDER):
            use = length > back
            packed[use] |= letters[at[use] - back] << np.uint64(8 * back)
        word = np.searchsorted(starts, at, side="right") - 1
        return cls(packed, word, starts, ends, np.searchsorted(starts, offsets + np.arange(len(offsets))), letters)


class _Sums:
    """Counts by key, gathered over a task and given out when they are many."""

    def __init__(self, most: int = 1_000_000):
        self.most, self.parts, self.size = most, [], 0

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.parts.append(np.unique(keys, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > self.most:
            keys, n = self.merged()
            self.parts, self.size = [(keys, n)], len(keys)
            if self.size > self.most // 2:
                self.parts, self.size = [], 0
                yield keys, n

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, inverse = np.unique(np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in self.parts)]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([np.zeros(0), *(n for _, n in self.parts)]), minlength=len(keys)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(expression, part, n): in how many pairs of text and word of class and fold ``part`` an expression occurs."""

    def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array((keys >> np.uint64(3)).astype(np.int64)), pa.array((keys & np.uint64(7)).astype(np.int32)), pa.array(n)]
        return pa.RecordBatch.from_arrays(columns, names=["expression", "part", "n"])

    sums = _Sums()
    for batch in batches:
        part = batch.column("toxic").to_numpy() * FOLDS + batch.column("fold").to_numpy()
        for first, last, data, offsets in text_chunks(batch.column("text")):
            found = Letters.of(data, offsets)
            if not len(found.starts):
                continue
            text = np.repeat(np.arange(last - first), np.diff(found.bounds))
            hashes = fingerprints(prefix_sums(found.letters.astype(np.uint8)), found.starts, found.ends)
            order = np.lexsort((hashes, text))
            new = np.concatenate(([True], (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])))
            once = np.zeros(len(order), dtype=bool)
            once[order[new]] = True
            use = once[found.word]
            for keys, n in sums.add(found.expression[use] << np.uint64(3) | part[first:last][text[found.word[use]]].astype(np.uint64)):
                yield rows(keys, n)
    yield rows(*sums.merged())


def _shortest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(expression, n) of up to three bytes; of three, only that they occur."""
    seen, opening = np.zeros(1 << 24, dtype=bool), np.zeros(1 << 16, dtype=np.int64)
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column("text")):
            found = Letters.of(data, offsets).expression & np.uint64((1 << 24) - 1)
            seen[found.astype(np.int64)] = True
            opening += np.bincount(found[found < 1 << 16].astype(np.int64), minlength=1 << 16)
    keys = np.flatnonzero(seen)
    n = np.where(keys < 1 << 16, opening[np.minimum(keys, (1 << 16) - 1)], 1)
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["expression", "n"])


def shared_probabilities(docs: DataFrame) -> np.ndarray:
    """(256, 256) probabilities of a byte after another, by continuation counts over all ``docs`` (text)."""
    found = docs.select("text").mapInArrow(_shortest, "expression long, n long").groupBy("expression").agg(F.sum("n").alias("n"))
    pair = F.col("expression").bitwiseAND(F.lit((1 << 16) - 1))
    # words' first bytes have nothing before their space: how often they occur stands for their contexts
    counts = np.zeros((256, 256))
    for row in found.groupBy(pair.alias("pair")).agg(F.sum(F.when(F.col("expression") < 1 << 16, F.col("n")).otherwise(1)).alias("n")).collect():  # 65,536 at most
        counts[row["pair"] >> 8, row["pair"] & 255] = row["n"]
    contexts = (counts > 0).sum(axis=0)
    if not contexts.sum():
        return np.full((256, 256), 1 / 256)
    single = (np.maximum(contexts - DISCOUNT, 0) + DISCOUNT * (contexts > 0).sum() / 256) / contexts.sum()
    total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    return np.where(total > 0, (np.maximum(counts - DISCOUNT, 0) + DISCOUNT * kinds * single) / np.maximum(total, 1), single)


@dataclass
class KneserNey:
    """Where the two models of a block differ: for each order from ``SHARED`` on, sorted expressions of either class with the
    log ratio of their probabilities."""

    expressions: list[tuple[np.ndarray, np.ndarray]]

    def ratios(self, expressions: np.ndarray) -> np.ndarray:
        """Log ratio of the probabilities, toxic over ordinary, of the last byte of each expression after its longest known context."""
        asked, inverse = np.unique(expressions, return_inverse=True)
        length = np.searchsorted(np.uint64(1) << np.arange(8, 8 * ORDER, 8, dtype=np.uint64), asked, side="right") + 1
        out, open_ = np.zeros(len(asked)), np.arange(len(asked))
        for order in range(ORDER, SHARED - 1, -1):
            here, rest = open_[length[open_] >= order], open_[length[open_] < order]
            own = asked[here] & np.uint64((1 << 8 * order) - 1)
            found, out[here] = looked_up(*self.expressions[order - SHARED], own)
            open_ = np.concatenate((rest, here[~found]))
        return out[inverse]


def looked_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each asked key is there, and its value, 0 if it isn't."""
    if not len(keys):
        return np.zeros(len(asked), dtype=bool), np.zeros(len(asked))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    found = keys[at] == asked
    return found, np.where(found, values[at], 0.0)


def estimate(expressions: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray, shared: np.ndarray) -> KneserNey:
    """The two models by the text counts of whole expressions (of ORDER bytes, or fewer from a word's opening on)."""
    tables: list[tuple[np.ndarray, np.ndarray]] = []
    longer: tuple[np.ndarray, np.ndarray] | None = None
    for order in range(ORDER, SHARED - 1, -1):
        here = (expressions >> np.uint64(8 * (order - 1)) > 0) & (expressions >> np.uint64(8 * order) == 0)
        keys, counts = expressions[here], np.stack([ordinary[here], toxic[here]]).astype(float)
        if SHARED < order < ORDER:  # continuations: each longer expression is one byte before its suffix
            keys = np.concatenate((keys, longer[0] & np.uint64((1 << 8 * order) - 1)))
            counts = np.concatenate((counts, longer[1] > 0), axis=1)
        keys, inverse = np.unique(keys, return_inverse=True)
        longer = keys, np.stack([np.bincount(inverse, c, minlength=len(keys)) for c in counts])
        tables.append(longer)
    found, lower = [], None
    for order, (keys, counts) in zip(range(SHARED, ORDER + 1), reversed(tables)):
        if order <= SHARED + 1:
            below = np.stack([shared[(keys >> np.uint64(8) & np.uint64(255)).astype(int), (keys & np.uint64(255)).astype(int)]] * 2)
        else:
            below = lower[1][:, np.searchsorted(lower[0], keys & np.uint64((1 << 8 * (order - 1)) - 1))]
        context, of = np.unique(keys >> np.uint64(8), return_inverse=True)
        total, kinds = (np.stack([np.bincount(of, c, minlength=len(context)) for c in cs]) for cs in (counts, counts > 0))
        left = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        probabilities = np.maximum(counts - DISCOUNT, 0) / np.maximum(total, 1)[:, of] + left[:, of] * below
        lower = keys, probabilities
        found.append((keys, np.log(probabilities[1]) - np.log(probabilities[0])))
    return KneserNey(found)


@dataclass
class Model:
    """Counts of all labelled texts in blocks, and the calibration.  A block's table is what reaches the driver at once."""

    counts: DataFrame  # expression, block and for each fold f the counts n0_f and n1_f of either class
    blocks: int
    shared: np.ndarray
    slopes: tuple[float, float] = (0.0, 0.0)
    shift: float = 0.0

    def table(self, block: int) -> pa.Table:
        return self.counts.where(F.col("block") == block).drop("block").toArrow()

    def models(self, table: pa.Table, without: int | None = None) -> KneserNey:
        """The models of a block's ``table`` by the texts of all folds, or of all but one."""
        n0, n1 = (sum(table.column(f"n{c}_{f}").to_numpy() for f in range(FOLDS) if f != without) for c in (0, 1))
        seen = n0 + n1 > 0
        return estimate(table.column("expression").to_numpy()[seen].astype(np.uint64), n0[seen], n1[seen], self.shared)


def count(rows: DataFrame, docs: DataFrame) -> Model:
    """Counts of ``rows`` (text, toxic, fold), written as a table, and the orders shared with all ``docs``."""
    columns = [F.sum(F.when(F.col("part") == c * FOLDS + f, F.col("n")).otherwise(0)).alias(f"n{c}_{f}") for f in range(FOLDS) for c in (0, 1)]
    counts, _ = written(rows.mapInArrow(_count, "expression long, part int, n long").groupBy("expression").agg(*columns), "expressions")
    blocks = max(1, -(-counts.count() // MAX_EXPRESSIONS))
    middle = F.shiftright("expression", 8).bitwiseAND(F.lit((1 << 16) - 1))
    return Model(counts.withColumn("block", F.pmod(F.xxhash64(middle), F.lit(blocks))), blocks, shared_probabilities(docs))


def totals(model: KneserNey, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood ratio of each text by the expressions of a block, and its number of words."""
    out, words = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for first, last, data, offsets in text_chunks(texts):
        found = Letters.of(data, offsets)
        if len(found.starts):
            by_word = np.bincount(found.word, model.ratios(found.expression), minlength=len(found.starts))
            words[first:last] = np.diff(found.bounds)
            # summed text by text, so that no total depends on what else is in the chunk
            out[first:last] = np.bincount(np.repeat(np.arange(last - first), words[first:last]), by_word, minlength=last - first)
    return out, words


def _evidence(model: KneserNey, name: str):
    """Batches with the evidence by the only block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, words = totals(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total / (words + SHORT), pa.float64())], names=[*batch.schema.names, name])

    return run


def _totals(model: KneserNey):
    """Batches with what one block says, in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, words = totals(model, batch.column("text"))
            columns = {c: batch.column(c) for c in batch.schema.names if c != "text"}
            yield pa.RecordBatch.from_pydict(columns | {"total": pa.array(total, pa.float64()), "words": pa.array(words, pa.int64())})

    return run


def with_evidence(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` (text, any other columns) with the evidence as ``name``; several blocks are added up by text."""
    if model.blocks == 1:
        return docs.mapInArrow(_evidence(model.models(model.table(0)), name), StructType([*docs.schema.fields, StructField(name, DoubleType())]))
    digest, size = unused([*docs.columns, name], "digest", "size")
    texts, parts = docs.select(F.xxhash64("text").alias(digest), F.octet_length("text").alias(size), "text"), None
    for block in range(model.blocks):
        part, _ = written(texts.mapInArrow(_totals(model.models(model.table(block))), f"`{digest}` long, `{size}` int, total double, words long"), "totals")
        parts = part if parts is None else parts.unionByName(part)
    both = parts.groupBy(digest, size).agg((F.avg("total") * model.blocks).alias("total"), F.max("words").alias("words"))
    both = both.select(digest, size, (F.col("total") / (F.col("words") + SHORT)).alias(name))
    same = F.xxhash64("text").eqNullSafe(F.col(digest)) & F.octet_length("text").eqNullSafe(F.col(size))
    return docs.join(both, same, "left").drop(digest, size)


def calibrate(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Slopes below and above no evidence, and shift, of the logistic fit, by Newton steps with a little shrinkage.

    ``weight`` gives each class the share that it has among all labelled rows, however the rows were sampled.

    Two slopes, because wrong labels keep texts without toxic words at a floor that evidence does not explain.  A falling
    slope below is made flat, one above almost flat."""
    x = np.stack([np.minimum(evidence, 0), np.maximum(evidence, 0), np.ones_like(evidence)], axis=1)
    used, beta = [0, 1, 2], np.zeros(3)
    for _ in range(60):
        own = x[:, used]
        p = 1 / (1 + np.exp(-np.clip(own @ beta[used], -30, 30)))
        gradient = own.T @ (weight * (toxic - p)) - 1e-2 * beta[used]
        hessian = (own * (weight * p * (1 - p))[:, None]).T @ own + 1e-2 * np.eye(len(used))
        step = np.clip(np.linalg.solve(hessian, gradient), -2, 2)
        beta[used] += step
        if np.abs(step).max() < 1e-8:
            falling = [i for i in used if i < 2 and beta[i] < 0]
            if not falling:
                break
            beta[falling] = 0.0
            used = [i for i in used if i not in falling]
    return float(max(beta[0], 0)), float(max(beta[1], 0.1)), float(beta[2])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The models of all labelled texts, and their calibration from about ``max_rows`` of each class.

    The calibration sees its texts once, scored by models of the other folds; the models themselves have all of them.
    Labels of the held-out fifth are never read.  Without labelled texts every score is one third, so nothing is called toxic.
    """
    rows, path = written(training_rows(docs, labels), "training")
    model = count(rows, docs)
    full = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    fine = 1 << 30
    drawn = F.pmod(F.xxhash64(F.lit(8), "text"), F.lit(fine))
    sample, sample_path = written(rows.where(drawn < F.when(F.col("toxic") == 1, int(fine * max_rows / full.get(1, 1))).otherwise(int(fine * max_rows / full.get(0, 1)))), "sample")
    found: dict[tuple[int, int], list[float]] = {}
    for block in range(model.blocks):
        table = model.table(block)
        for fold in range(FOLDS):
            texts = sample.where(F.col("fold") == fold).select(F.xxhash64("text").alias("hash"), "toxic", "text")
            for row in texts.mapInArrow(_totals(model.models(table, without=fold)), "hash long, toxic int, total double, words long").collect():  # bounded as the sample is
                entry = found.setdefault((row["hash"], row["toxic"]), [0.0, row["words"]])
                entry[0] += row["total"]
    if found:
        toxic = np.array([c for _, c in found], dtype=float)
        total, words = np.array(list(found.values())).T
        weight = np.where(toxic == 1, full.get(1, 0) / max(toxic.sum(), 1), full.get(0, 0) / max((1 - toxic).sum(), 1))
        below, above, model.shift = calibrate(SCALE * total / (words + SHORT), toxic, weight)
        model.slopes = SCALE * below, SCALE * above
    else:
        model.shift = float(np.log(0.5))
    dropped(docs.sparkSession, path, sample_path)
    return model


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    A null, empty or blank text has no evidence and gets the calibration's score of none.  Repeated rows are scored alike;
    an empty table gives an empty result; other columns are not read.
    """
    evidence = with_evidence(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, "evidence")
    return evidence.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), score(F.col("evidence"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def score(evidence: Column, model: Model) -> Column:
    """Probability that a text of this evidence is toxic."""
    linear = evidence * F.when(evidence < 0, model.slopes[0]).otherwise(model.slopes[1]) + model.shift
    return 1 / (1 + F.exp(-linear))


def filter_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (text, any other columns) that score below one half, as they are."""
    (name,) = unused(docs.columns, "evidence")
    return with_evidence(docs, model, name).where(score(F.col(name), model) < 0.5).drop(name)
