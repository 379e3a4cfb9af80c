"""How filters interact: what each one removes at every step of every order in which they can be applied.

The orders form a trie whose edges are single filters.  It is walked depth first; the state after a prefix depends only on
which filters have run, so each unordered prefix is met once and its counts are remembered.  A state is the persisted DataFrame
of the documents that survived, filtered from the state above it, and one aggregate over it counts what each remaining filter
really removes.  At most one state per filter is persisted at a time.
"""

from __future__ import annotations

import itertools
import math
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.columns import unused
from ledgerloom.llm.store import dropped, shared_folder, written

SPACES = "[\\x20\\x09-\\x0D]+"
MAX_FILTERS = 7


def words(text: Column) -> Column:
    """The maximal runs outside ``\\x20 \\x09-\\x0D``."""
    return F.array_remove(F.split(text, SPACES), "")


def standard_failures(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` (doc_id, text) with one boolean column a filter, true where the document fails it, and filter -> column.

    A: under 200 words.  B: distinct words are under half of the words.  C: more than 3 in 100 code points are A-Z.
    D: holds one of ``#$%&*|``.  E: the whole text equals that of a row with a smaller doc_id, whatever becomes of that
    row.  A null text is empty; a null doc_id is neither smaller nor larger than any.
    """
    a, b, c, d, e, own, digest, least, found = unused(docs.columns, "a", "b", "c", "d", "e", "w", "digest", "least_id", "found")
    text = F.coalesce("text", F.lit(""))
    n, capitals = F.size(own), F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    marked = docs.withColumn(own, words(text)).withColumns(
        {
            a: n < 200,
            b: 100 * F.size(F.array_distinct(own)) < 50 * n,
            c: 100 * capitals > 3 * F.length(text),
            d: F.length(F.translate(text, "#$%&*|", "")) < F.length(text),
            digest: F.sha2(text, 256),
        }
    )
    # only the filters' columns go on: texts and words are not shuffled
    marked, _ = written(marked.drop(own, "text"), "audit-marks")
    repeated = marked.groupBy(digest).agg(F.count("*").alias(found), F.min("doc_id").alias(least)).where(F.col(found) > 1)
    # written, so that the join deals both sides by itself and a text with very many copies is split over tasks
    repeated, _ = written(repeated.select(F.col(digest).alias(found), least), "audit-copies")
    both = marked.join(repeated, F.col(digest) == F.col(found), "left")
    both = both.withColumn(e, F.coalesce(F.col("doc_id") > F.col(least), F.lit(False))).drop(digest, found, least)
    return both, dict(zip("ABCDE", (a, b, c, d, e)))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, ...) with ``good`` and ``toxic``: some row of ``labels`` (doc_id, quality, toxic) marks them
    so; null ids have no labels."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("__id"))
    marks = marks.agg(F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic"))
    both = docs.drop("good", "toxic").join(marks, F.col("doc_id") == F.col("__id"), "left").drop("__id")
    return both.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})


class _Trie:
    """Counts of every state, one folder of rows (part, n, and removed, good_lost, toxic_lost of each filter not yet run)."""

    def __init__(self, names: list[str], folder: str):
        self.names, self.folder, self.known = names, folder, set()

    def visit(self, state: DataFrame, done: int) -> None:
        """Count ``state``, the survivors of the filters in the bits of ``done``, then go down to the states not met yet."""
        self.known.add(done)
        rest = [i for i in range(len(self.names)) if not done >> i & 1]
        kept = state.persist(StorageLevel.MEMORY_AND_DISK)
        edges = [
            F.struct(
                F.lit(i).alias("edge"),
                F.count_if(F.col(f"f{i}")).alias("removed"),
                F.count_if(F.col(f"f{i}") & F.col("good")).alias("good_lost"),
                F.count_if(F.col(f"f{i}") & F.col("toxic")).alias("toxic_lost"),
            )
            for i in rest
        ]
        none = F.array().cast("array<struct<edge:int,removed:bigint,good_lost:bigint,toxic_lost:bigint>>")
        counted = kept.groupBy("part").agg(F.count("*").alias("n"), (F.array(*edges) if edges else none).alias("edges"))
        counted.withColumn("done", F.lit(done)).write.mode("append").parquet(self.folder)
        for i in rest:
            if done | 1 << i not in self.known:
                self.visit(kept.where(~F.col(f"f{i}")), done | 1 << i)
        kept.unpersist()


def audit_filters(docs: DataFrame, failures: dict[str, str], part: str) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``docs`` has a boolean column for each filter (``failures``: one-letter name -> column, at most 7; null passes), the
    column ``part`` and booleans ``good`` and ``toxic``.  One row for every part (null: the empty string), order of all
    filters and step: documents of the part left after the step, removed by it, failing its filter but removed earlier,
    failing its filter alone, good and toxic ones among the removed, and ``shapley``, the filter's removals summed over
    all orders.  Rows count as often as they occur.  An empty table gives an empty result.
    """
    names = sorted(failures)
    if not 0 < len(names) <= MAX_FILTERS or any(len(n) != 1 for n in names):
        raise ValueError(f"1 to {MAX_FILTERS} filters of one letter")
    spark, fails = docs.sparkSession, [F.coalesce(F.col(failures[n]), F.lit(False)) for n in names]
    root = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "good", "toxic",
        *(f.alias(f"f{i}") for i, f in enumerate(fails)),
    )
    root, path = written(root, "audit-root")
    folder = f"{shared_folder(spark)}/audit-states-{uuid.uuid4().hex}"
    _Trie(names, folder).visit(root, 0)
    states = spark.read.schema(
        "part string, n bigint, edges array<struct<edge:int,removed:bigint,good_lost:bigint,toxic_lost:bigint>>, done int"
    ).parquet(folder)
    alone = root.groupBy("part").agg(
        F.array(*(F.count_if(F.col(f"f{i}") & ~_any(f"f{j}" for j in range(len(names)) if j != i)) for i in range(len(names)))).alias("alone"),
        F.array(*(F.count_if(F.col(f"f{i}")) for i in range(len(names)))).alias("fails"),
    )
    alone, _ = written(alone, "audit-alone")
    dropped(spark, path)

    size = range(len(names))
    paths = [(sum(1 << i for i in before), edge) for edge in size for k in size for before in itertools.combinations([i for i in size if i != edge], k)]
    # so many orders run through an edge: those of the filters before it times those of the filters after it
    through = [math.factorial(done.bit_count()) * math.factorial(len(names) - 1 - done.bit_count()) for done, _ in paths]
    every = [F.struct(F.lit(done).alias("done"), F.lit(edge).alias("edge"), F.lit(n).alias("through")) for (done, edge), n in zip(paths, through)]
    counts = states.select("part", "done", "n", F.inline("edges"))
    # every part has every edge, those that nothing reached with zeros
    edges = alone.select("part", "alone", "fails", F.inline(F.array(*every))).join(counts, ["part", "done", "edge"], "left")
    edges = edges.select(
        "part", "done", "edge", "through", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "removed", "good_lost", "toxic_lost")),
        F.element_at("alone", F.col("edge") + 1).alias("unique_fails"), F.element_at("fails", F.col("edge") + 1).alias("fails"),
    )
    shapley = edges.groupBy(F.col("part").alias("__part"), F.col("edge").alias("__edge")).agg(F.sum(F.col("removed") * F.col("through")).alias("shapley"))
    full = edges.join(shapley, (F.col("part") == F.col("__part")) & (F.col("edge") == F.col("__edge")))
    steps = [("".join(names[i] for i in o), k + 1, sum(1 << i for i in o[:k]), o[k]) for o in itertools.permutations(size) for k in size]
    listed = spark.createDataFrame(steps, "filter_order string, step int, done int, edge int")
    return full.join(F.broadcast(listed), ["done", "edge"]).select(  # the orders make 7! x 7 rows at most
        "part", "filter_order", "step", (F.col("n") - F.col("removed")).alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def _any(names) -> Column:
    found = F.lit(False)
    for name in names:
        found = found | F.col(name)
    return found
