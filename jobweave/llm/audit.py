"""Interaction of filters: what each removes, in every order, read off decision diagrams.

A document fails some of the filters; the set of those is its failure mask.  Documents are counted by part and
mask in Spark, which leaves at most 32 rows a part.  One diagram a part holds these counts: every level is a
filter, every edge says pass or fail, equal parts of the diagram are one node.  A chain of swaps of adjacent
levels visits all orders of the filters, and the path of passes from the root gives an order's steps: at each
node the weight of the failing edge is what the filter removes there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_least, written

FILTERS = "ABCDE"
_UPPER = bytes(range(0x41, 0x5B))
_MARKS = b"#$%&*|"
_MASKS = "doc_id long, part string, mask int, text_hash binary"
STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def mask_of(text: str) -> int:
    """Failure bits of the filters that look at one text alone: A is bit 0, B bit 1, C bit 2, D bit 3."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # at blank and 09-0D, as the filters do
    mask = 1 if len(words) < 200 else 0
    mask |= 2 if 100 * len(set(words)) < 50 * len(words) else 0
    mask |= 4 if 100 * (len(data) - len(data.translate(None, _UPPER))) > 2 * len(text) else 0
    mask |= 8 if len(data.translate(None, _MARKS)) < len(data) else 0
    return mask


def _masks(batches):
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("part"),
                pa.array([mask_of(t) for t in texts], pa.int32()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts], pa.binary()),
            ],
            names=["doc_id", "part", "mask", "text_hash"],
        )


def failure_masks(docs: DataFrame) -> DataFrame:
    """doc_id, part and failure mask of every row of (doc_id, text, source).

    A null text is empty, a null source is the part ''.  Filter E fails a text that some smaller doc_id has too;
    rows that repeat the smallest id pass it, and a null id neither fails it nor makes another row fail it.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
    )
    rows = written(rows.mapInArrow(_masks, _MASKS))
    copied = with_least(rows, "text_hash", "doc_id", "least")
    fails = F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False))
    return copied.select("doc_id", "part", (F.col("mask") + F.when(fails, 16).otherwise(0)).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and mask, and how many of them are labelled good (quality 1) and toxic (1).

    A document counts once for a label that any of its label rows carries.
    """
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
    )
    joined = masks.join(known, "doc_id", "left")
    total = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")]
    return joined.groupBy("part", "mask").agg(F.count("*").alias("n"), *total)


# --- the diagram --------------------------------------------------------------------------------------------------------


class Diagram:
    """Decision diagram over failure masks whose leaves are counts.

    ``order`` names the filter of each level.  A node is (pass, fail) or, below the last level, a tuple of
    counts; equal nodes are one, so their weights are summed once.
    """

    def __init__(self, counts: dict[int, tuple[int, ...]], n: int):
        self.order = list(range(n))
        self._nodes: dict[tuple, int] = {}
        self._kids: list[tuple] = []
        self._weights: list[tuple[int, ...]] = []
        width = len(next(iter(counts.values()), (0,)))
        level = [self._leaf(counts.get(m, (0,) * width)) for m in range(1 << n)]
        # filter 0 is the top level, so its bit is the last to be folded
        for bit in reversed(range(n)):
            level = [self._node(level[m], level[m | 1 << bit]) for m in range(1 << bit)]
        self.root = level[0]

    def _leaf(self, weight: tuple[int, ...]) -> int:
        return self._kept(("leaf", weight), weight)

    def _node(self, passed: int, failed: int) -> int:
        weight = tuple(a + b for a, b in zip(self._weights[passed], self._weights[failed]))
        return self._kept((passed, failed), weight)

    def _kept(self, kids: tuple, weight: tuple[int, ...]) -> int:
        if kids not in self._nodes:
            self._nodes[kids] = len(self._kids)
            self._kids.append(kids)
            self._weights.append(weight)
        return self._nodes[kids]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below; nodes above are built anew, those below stay."""
        done: dict[int, int] = {}

        def rebuilt(node: int, depth: int) -> int:
            if node not in done:
                passed, failed = self._kids[node]
                if depth < level:
                    done[node] = self._node(rebuilt(passed, depth + 1), rebuilt(failed, depth + 1))
                else:
                    (pp, pf), (fp, ff) = self._kids[passed], self._kids[failed]
                    done[node] = self._node(self._node(pp, fp), self._node(pf, ff))
            return done[node]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Along the path of passes: filter, weight kept, weight removed."""
        node = self.root
        for of in self.order:
            node, failed = self._kids[node]
            yield of, self._weights[node], self._weights[failed]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to exchange, one after the other, so that all orders of n are visited once, the first one included.

    The largest element travels through every order of the others, to one end and then back; where it turns,
    the others make a step of their own.
    """
    if n < 2:
        return
    down = True
    inner = adjacent_swaps(n - 1)
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        # with the largest at the top the others stand one level lower
        yield step + 1 if down else step
        down = not down


def audit_part(counts: dict[int, tuple[int, int, int]], names: str = FILTERS) -> list[tuple]:
    """Rows (order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part.

    ``counts`` gives (documents, good, toxic) by failure mask.
    """
    n = len(names)
    fails = [sum(c[0] for m, c in counts.items() if m >> i & 1) for i in range(n)]
    alone = [counts.get(1 << i, (0,))[0] for i in range(n)]
    diagram = Diagram(counts or {0: (0, 0, 0)}, n)
    rows, shares = [], [0] * n
    for level in [None, *adjacent_swaps(n)]:
        if level is not None:
            diagram.swap(level)
        order = "".join(names[i] for i in diagram.order)
        for step, (of, kept, removed) in enumerate(diagram.steps(), 1):
            shares[of] += removed[0]
            rows.append((order, step, of, kept[0], removed[0], fails[of] - removed[0], alone[of], removed[1], removed[2]))
    return [(order, step, *rest, shares[of]) for order, step, of, *rest in rows]


def _audited(part: pd.DataFrame) -> pd.DataFrame:
    counts = {int(m): (int(n), int(g), int(t)) for m, n, g, t in part[["mask", "n", "good", "toxic"]].itertuples(index=False)}
    names = [c.split()[0] for c in STEPS.split(", ")]
    rows = [(part["part"].iloc[0], *row) for row in audit_part(counts)]
    return pd.DataFrame(rows, columns=names).astype({"step": "int32"})


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each of the five filters removes at each step of each order, by part.

    Columns: part, filter_order, step and the counts kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley.  Every part has 600 rows, zeros included; without documents there are none.
    """
    counts = mask_counts(failure_masks(docs), labels)
    return counts.groupBy("part").applyInPandas(_audited, STEPS)
