"""Fuzzy matching: greedy leader groups.

The rule to reproduce is sequential: walk the names in order; a name joins the
best earlier leader that is similar enough, otherwise it becomes a leader.  So
a name only ever has to be compared with leaders, of which there are few:

* the first undecided names are a front.  The first front is small and walked
  in one task; later ones double, and their leaders follow from the similar
  pairs inside the front, which are few, since names close to earlier leaders
  have left;
* the new leaders meet all names behind them, whoever is similar is decided.

Names meet in blocks of bounded size, so neither a frequent word nor a long
text makes a hot key.  A block holds names of like lengths: texts whose lengths
differ much cannot be similar, so most pairs of blocks never meet.  Within a
pair of blocks the letter counts of all texts bound all ratios at once; only
pairs that can reach the threshold are compared letter by letter, each once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import mean_ratio, text_ratio
from ..functions.text import _c, strip, strip_accents
from ..session import cut_lineage
from .ranking import lookup

THRESHOLD = 0.8
#: Names of the first front, walked in one task; every later front holds twice as many.
FRONT = 4096
#: Names of a block; two blocks meet in one task.
BLOCK = 1024
#: Lengths of one band differ by this factor at most; names are grouped by the bands of their fields.
BAND = 1.1
#: Letters are counted in this many classes.
CLASSES = 32
#: Ratios a task remembers.
REMEMBERED = 200_000


class Texts:
    """The fields of many names: texts, lengths and letter counts; ``agree`` holds texts that must be equal."""

    def __init__(self, rows: list[list[str]], agree: list[list[str] | None]):
        self.rows = rows
        self.agree = agree
        n, fields = len(rows), len(rows[0]) if rows else 0
        self.sizes = np.array([[len(t) for t in row] for row in rows], dtype=np.int64).reshape(n, fields)
        # hashes of the texts that must be equal, 0 for an empty one
        self.marks = np.zeros((n, max((len(texts or ()) for texts in agree), default=0)), dtype=np.int64)
        for i, texts in enumerate(agree):
            for f, text in enumerate(texts or ()):
                self.marks[i, f] = hash(text) or 1 if text else 0
        self.counts = np.zeros((fields, n, CLASSES), dtype=np.int16)
        for i, row in enumerate(rows):
            for f, text in enumerate(row):
                if text:
                    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) % CLASSES
                    self.counts[f, i] = np.minimum(np.bincount(codes, minlength=CLASSES), 1 << 14)


class Comparison:
    """Ratio of an earlier and a later name: the mean over the fields that both fill.

    With ``skip_empty`` off a field counts whether filled or not; ``agreeing`` is the number of
    ``agree`` texts that must be equal and not empty.
    """

    def __init__(self, threshold: float, skip_empty: bool, agreeing: int):
        self.threshold, self.skip_empty, self.agreeing = threshold, skip_empty, agreeing
        self.known: dict[tuple[str, str], float] = {}

    def possible(self, early: Texts, late: Texts, j: int) -> np.ndarray:
        """Early names that may reach the threshold with late name ``j``.

        Every letter that one text has more often than the other is an insertion or deletion.
        """
        if not len(early.rows):
            return np.zeros(0, dtype=bool)
        if self.agreeing:
            # few names agree, and only they are worth a look at their letters
            agree = ((early.marks == late.marks[j]) & (late.marks[j] != 0)).sum(axis=1) >= self.agreeing
            at = np.flatnonzero(agree)
            agree[at] = self._reaches(early.sizes[at], early.counts[:, at], late, j)
            return agree
        return self._reaches(early.sizes, early.counts, late, j)

    def _reaches(self, sizes: np.ndarray, counts: np.ndarray, late: Texts, j: int) -> np.ndarray:
        total, filled = np.zeros(len(sizes)), np.zeros(len(sizes))
        for f in range(len(counts)):
            both = sizes[:, f] + late.sizes[j, f]
            edits = np.abs(counts[f] - late.counts[f, j]).sum(axis=1, dtype=np.int64)
            bound = 1.0 - edits / np.maximum(both, 1)
            used = (sizes[:, f] > 0) & (late.sizes[j, f] > 0) if self.skip_empty else np.ones(len(bound), dtype=bool)
            total += np.where(used, bound, 0.0)
            filled += used
        return (filled > 0) & (total >= (self.threshold - 1e-9) * filled)

    def score(self, early: Texts, i: int, late: Texts, j: int) -> float:
        if self.agreeing:
            same = sum(1 for a, b in zip(early.agree[i] or (), late.agree[j] or ()) if a and a == b)
            if same < self.agreeing:
                return 0.0
        scores = []
        for a, b in zip(early.rows[i], late.rows[j]):
            if self.skip_empty and not (a and b):
                continue
            if (a, b) not in self.known:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[a, b] = text_ratio(b, a)
            scores.append(self.known[a, b])
        return sum(scores, 0.0) / len(scores) if scores else 0.0


def _texts(table: pa.Table, side: str) -> tuple[np.ndarray, Texts]:
    """Names of a table in the order of their ids."""
    table = table.sort_by("id")
    return table.column("id").to_numpy(), Texts(table.column(side).to_pylist(), table.column("agree").to_pylist())


def walk(table: pa.Table, compare: Comparison) -> list[int]:
    """The sequential rule itself: positions of the leaders among the names in order."""
    _, early = _texts(table, "early")
    _, late = _texts(table, "late")
    leaders: list[int] = []
    chosen = Texts([], [])
    chosen.sizes, chosen.counts = early.sizes[:0], early.counts[:, :0]
    sizes, counts, marks = np.empty_like(early.sizes), np.empty_like(early.counts), np.empty_like(early.marks)
    for j in range(table.num_rows):
        hits = np.flatnonzero(compare.possible(chosen, late, j))
        if any(compare.score(early, leaders[k], late, j) >= compare.threshold for k in hits):
            continue
        k = len(leaders)
        sizes[k], counts[:, k], marks[k] = early.sizes[j], early.counts[:, j], early.marks[j]
        leaders.append(j)
        chosen.rows = leaders
        chosen.sizes, chosen.counts, chosen.marks = sizes[: k + 1], counts[:, : k + 1], marks[: k + 1]
    return leaders


@dataclass
class Group:
    """Names whose fields have lengths from ``low`` to ``high``, in ``blocks`` blocks."""

    bands: list[str]
    names: int
    low: tuple[int, ...]
    high: tuple[int, ...]

    @property
    def blocks(self) -> int:
        return max(1, -(-self.names // BLOCK))


def _banded(names: DataFrame, side: str) -> DataFrame:
    sizes = F.transform(side, F.char_length)
    bands = F.transform(sizes, lambda n: F.when(n > 0, F.floor(F.log(n) / math.log(BAND)) + 1).otherwise(0).cast("int"))
    return names.withColumn("sizes", sizes).withColumn("band", F.array_join(bands, ","))


def length_groups(names: DataFrame, side: str) -> list[Group]:
    """Groups of names by the lengths of their fields, from one count per combination of bands.

    Bands grow with the length, so their number is bounded whatever the texts.  Rare combinations that follow each
    other share a group of up to a block.
    """
    banded = _banded(names, side)
    width = names.select(F.size(side)).first()
    if width is None:
        return []
    fields = range(width[0])
    counted = banded.groupBy("band").agg(
        F.count("*").alias("n"),
        *[F.min(F.col("sizes")[f]).alias(f"low{f}") for f in fields],
        *[F.max(F.col("sizes")[f]).alias(f"high{f}") for f in fields],
    )
    rows = sorted(counted.collect(), key=lambda r: [int(b) for b in r["band"].split(",")])
    groups: list[Group] = []
    for r in rows:
        low, high = tuple(r[f"low{f}"] for f in fields), tuple(r[f"high{f}"] for f in fields)
        last = groups[-1] if groups else None
        if last is not None and last.names + r["n"] <= BLOCK:
            wide = tuple(map(min, last.low, low)), tuple(map(max, last.high, high))
            groups[-1] = Group([*last.bands, r["band"]], last.names + r["n"], *wide)
        else:
            groups.append(Group([r["band"]], r["n"], low, high))
    return groups


def may_meet(a: Group, b: Group, compare: Comparison) -> bool:
    """Whether any two names of the groups can reach the threshold, by their lengths alone.

    A text of n and one of m > n letters differ in m - n insertions at least.  A field that may be empty on a side
    may not count, so it is taken as equal.
    """
    total = fields = 0.0
    for low_a, high_a, low_b, high_b in zip(a.low, a.high, b.low, b.high):
        gap, both = max((low_a - high_b, low_a + high_b), (low_b - high_a, low_b + high_a))
        optional = compare.skip_empty and not (low_a and low_b)
        total += 1.0 if optional or gap <= 0 else 1 - gap / both
        fields += 1
    return total >= (compare.threshold - 1e-9) * fields


def meetings(early: list[Group], late: list[Group], compare: Comparison) -> list[tuple[int, int]]:
    """Pairs of groups whose blocks meet."""
    return [(i, j) for i, a in enumerate(early) for j, b in enumerate(late) if may_meet(a, b, compare)]


#: Columns of a dealt name, after the name of its side.
DEALT = ["id", "text", "agree", "own", "own_block", "other", "other_block"]


def _dealt(names: DataFrame, side: str, own: list[Group], met: list[tuple[int, int, int]]) -> DataFrame:
    """Names with their group and block, once for every group and block that theirs meets.

    ``met`` holds (own group, other group, blocks of the other); it is as long as there are pairs of groups.
    """
    spark = names.sparkSession
    bands = spark.createDataFrame([(b, i, g.blocks) for i, g in enumerate(own) for b in g.bands], "band string, own int, blocks int")
    others = spark.createDataFrame(met, "own int, other int, other_blocks int")
    rows = _banded(names, side).join(F.broadcast(bands), "band").join(F.broadcast(others), "own")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other_block = F.explode(F.sequence(F.lit(0), F.col("other_blocks") - 1))
    columns = [F.col("id"), F.col(side), F.col("agree"), F.col("own"), block, F.col("other"), other_block]
    return rows.select(*[c.alias(f"{side}_{name}") for c, name in zip(columns, DEALT)])


def meet(early: DataFrame, late: DataFrame, compare: Comparison, every: bool, first: bool) -> DataFrame:
    """``early_id, late_id, score`` of similar pairs, the earlier one in ``early``.

    Each pair of blocks gives all of its pairs with ``every``, else the one choice of each later name: the
    first similar one, or the most similar and then first.
    """
    e_groups, l_groups = length_groups(early, "early"), length_groups(late, "late")
    met = meetings(e_groups, l_groups, compare)
    e = _dealt(early, "early", e_groups, [(i, j, l_groups[j].blocks) for i, j in met])
    l = _dealt(late, "late", l_groups, [(j, i, e_groups[i].blocks) for i, j in met])

    def pairs(left, right):
        found: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            early_id, early_texts = _texts(left.rename_columns(DEALT), "text")
            late_id, late_texts = _texts(right.rename_columns(DEALT), "text")
            for j in range(len(late_id)):
                before = int(np.searchsorted(early_id, late_id[j]))
                hits = np.flatnonzero(compare.possible(early_texts, late_texts, j)[:before])
                best: tuple[float, int] | None = None
                for i in hits:
                    score = compare.score(early_texts, i, late_texts, j)
                    if score < compare.threshold:
                        continue
                    if every:
                        found.append((int(early_id[i]), int(late_id[j]), score))
                    elif best is None or score > best[0]:
                        best = (score, i)
                        if first:
                            break
                if best is not None:
                    found.append((int(early_id[best[1]]), int(late_id[j]), best[0]))
        columns = list(zip(*found)) if found else [[], [], []]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("early_id", "late_id", "score"), columns, types)})

    mine, theirs = ("own", "own_block", "other", "other_block"), ("other", "other_block", "own", "own_block")
    # a stated number of tasks: the rows are few bytes for their work, and adaptive execution would join them in one task
    spark = early.sparkSession
    most = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(2, min(most, sum(e_groups[i].blocks * l_groups[j].blocks for i, j in met)))
    e_keys, l_keys = [f"early_{n}" for n in mine], [f"late_{n}" for n in theirs]
    together = e.repartition(tasks, *e_keys).groupBy(*e_keys).cogroup(l.repartition(tasks, *l_keys).groupBy(*l_keys))
    return together.applyInArrow(pairs, "early_id long, late_id long, score double")


def _front_leaders(front: DataFrame, compare: Comparison) -> DataFrame:
    """Leaders of a front by the similar pairs inside it: whoever has no undecided name before it leads."""
    edges = cut_lineage(meet(front, front, compare, every=True, first=True).select("early_id", "late_id"))
    nodes = front.select("id")
    found = [nodes.join(edges.select(F.col("late_id").alias("id")), "id", "left_anti")]
    while not edges.isEmpty():
        held = edges.select(F.col("late_id").alias("id")).distinct()
        leads = cut_lineage(edges.select(F.col("early_id").alias("id")).distinct().join(held, "id", "left_anti"))
        covered = edges.join(leads, edges["early_id"] == leads["id"], "left_semi").select(F.col("late_id").alias("id")).distinct()
        gone = cut_lineage(leads.unionByName(covered))
        rest = edges.join(gone, edges["early_id"] == gone["id"], "left_anti").join(gone, edges["late_id"] == gone["id"], "left_anti")
        # a name whose earlier neighbours were all covered leads too, though no pair holds it any more
        freed = edges.join(gone, edges["late_id"] == gone["id"], "left_anti").select(F.col("late_id").alias("id")).distinct()
        rest = cut_lineage(rest)
        found += [leads, freed.join(rest.select(F.explode(F.array("early_id", "late_id")).alias("id")), "id", "left_anti")]
        edges = rest
    return reduce(DataFrame.unionByName, found).distinct()


def leader_groups(
    names: DataFrame, threshold: float = THRESHOLD, first: bool = False, skip_empty: bool = False, agreeing: int = 0
) -> DataFrame:
    """``id, leader, score`` of every name.

    ``names`` holds ``id`` (unique, giving the order), the fields as ``early`` and as ``late`` name of a
    pair, and the texts that may have to ``agree``.  A member joins its most similar leader, or with
    ``first`` its earliest one.
    """
    compare = Comparison(threshold, skip_empty, agreeing)
    names = cut_lineage(names)
    leaders, matches, undecided, size = [], [], names, FRONT

    def lead(table):
        ids = table.sort_by("id").column("id")
        return pa.table({"id": ids.take(pa.array(walk(table, compare), pa.int64()))})

    while not undecided.isEmpty():
        if not leaders:
            front = undecided.orderBy("id").limit(size)
            ids = front.groupBy(F.lit(0).alias("front")).applyInArrow(lead, "id long")
        else:
            share = min(1.0, size / undecided.count())
            last = undecided.agg(F.percentile_approx("id", share, 10_000)).first()[0]
            ids = _front_leaders(cut_lineage(undecided.where(F.col("id") <= last)), compare)
        found = cut_lineage(names.join(ids, "id", "left_semi"))
        leaders.append(found.select("id"))
        others = names.join(reduce(DataFrame.unionByName, leaders), "id", "left_anti")
        matches.append(cut_lineage(meet(found, others, compare, every=False, first=first)))
        decided = found.select("id").unionByName(matches[-1].select(F.col("late_id").alias("id"))).distinct()
        undecided = cut_lineage(undecided.join(decided, "id", "left_anti"))
        size *= 2
    if not leaders:
        return names.select("id", F.col("id").alias("leader"), F.lit(1.0).alias("score"))
    rank = F.lit(0.0) if first else -F.col("score")
    choice = F.struct(rank.alias("rank"), F.col("early_id").alias("leader"), F.col("score"))
    found = reduce(DataFrame.unionByName, matches).groupBy(F.col("late_id").alias("id")).agg(F.min(choice).alias("best"))
    own = reduce(DataFrame.unionByName, leaders).select("id", F.col("id").alias("leader"), F.lit(1.0).alias("score"))
    return own.unionByName(found.select("id", "best.leader", "best.score"))


def first_seen(df: DataFrame, name: str, row_id: str) -> DataFrame:
    """Distinct non-null values with the first row that holds them."""
    values = df.filter(F.col(f"`{name}`").isNotNull())
    return values.groupBy(F.col(f"`{name}`").alias("name")).agg(F.min(row_id).alias("id"))


def entity_mapping(df: DataFrame, name: str, row_id: str, threshold: float = THRESHOLD) -> DataFrame:
    """``name, canonical, score, id``: each distinct value and its canonical form.

    Values are taken in first-seen order; among canonical forms that come
    earlier and reach the threshold the best wins, the earliest on a tie.
    """
    names = cut_lineage(first_seen(df, name, row_id))
    low = F.lower("name")
    nodes = names.select(
        F.col("id").cast("long"),
        F.array(low).alias("early"),
        F.array(strip(low)).alias("late"),
        F.array().cast("array<string>").alias("agree"),
    )
    groups = leader_groups(nodes, threshold)
    canonical = names.select(F.col("id").alias("leader"), F.col("name").alias("canonical"))
    return names.join(groups, "id").join(canonical, "leader").select("name", "canonical", "score", "id")


def resolve_entities(df: DataFrame, row_id: str, company: str = "company_name", title: str = "job_title_clean"):
    """Entity mappings for companies and titles, and their statistics."""
    mappings = {"company": cut_lineage(entity_mapping(df, company, row_id)),
                "job_title": cut_lineage(entity_mapping(df, title, row_id))}
    stats = [
        m.agg(
            F.lit(kind).alias("entity"),
            F.count("*").alias("total"),
            F.count("*").alias("mapped"),
            F.count_if(F.col("name") == F.col("canonical")).alias("canonical"),
        )
        for kind, m in mappings.items()
    ]
    return mappings, stats[0].unionByName(stats[1])


# --- similar records -------------------------------------------------------------------------------------------------


def record_similarity(left: Column, right: Column, fields: list[str]) -> Column:
    """Mean ratio over the fields that both records fill; 0 when there is none."""
    return mean_ratio([(left[f], right[f]) for f in fields])


def similar_records(
    df: DataFrame, row_id: str, fields: list[str], threshold: float = THRESHOLD, agreeing: int = 0
) -> DataFrame:
    """``fields, id, leader, score, copies``: greedy groups of similar records.

    A record joins the earliest leader it is similar to.  Equal records are
    collapsed first, so copies cost nothing.  With ``agreeing`` records are
    similar only if so many fields also agree up to case, accents and
    punctuation, which is another rule.
    """
    values = [F.coalesce(F.lower(_c(f)), F.lit("")).alias(f) for f in fields]
    rows = df.select(F.col(row_id).cast("long").alias("row"), *values)
    distinct = cut_lineage(rows.groupBy(*fields).agg(F.min("row").alias("id"), F.count("*").alias("copies")))
    folded = F.array(*[strip_accents(f) for f in fields]) if agreeing else F.array().cast("array<string>")
    nodes = distinct.select("id", F.array(*fields).alias("early"), F.array(*fields).alias("late"), folded.alias("agree"))
    groups = leader_groups(nodes, threshold, first=True, skip_empty=True, agreeing=agreeing)
    return distinct.join(groups, "id").select(*fields, "id", "leader", "score", "copies")


def similar_rows(df: DataFrame, groups: DataFrame, row_id: str, fields: list[str]) -> DataFrame:
    """``row id, leader``: the group of every single row, copies included."""
    values = [F.coalesce(F.lower(_c(f)), F.lit("")).alias(f) for f in fields]
    rows = df.select(row_id, *values)
    return lookup(rows, groups.select(*fields, "leader", "copies"), fields, "copies").select(row_id, "leader")
