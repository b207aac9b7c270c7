"""A Merkle manifest of a table: a content-addressed store of its hash tree, proofs by descent, and their verification.

Every row is a leaf: the sha256 (lowercase hex) of its columns, each ``-`` if null, else its UTF-8 byte count, ``:`` and
its text. Of each group the leaves stand in order of the key; every ``FAN`` neighbours become the sha256 of their
digests, level by level, until one node is left, the group's subroot. The subroots, in order of the groups (null first,
by bytes), give the root in the same way.

The store holds records from digest to children, ``DEEP`` levels of a subtree together in one row under the digest of its
top, so that one lookup serves six rank digits. A node's place is known from its rank alone, so each such row is made
from at most 3 ** 6 neighbouring nodes, whatever the size of the group: a third of all rows in one group is as good as
any other number. Ranks come from one range sort and the counts of its partitions, not from a window over a group.

A leaf is proved by descent: from the root, each digit of the group's rank and then of the leaf's rank chooses a child;
the children not chosen are collected. Leaves whose ranks share all digits but the last six descend as one, and part in the
last row. The collected segments, reversed, are the proof from leaf to root.

Rows of equal key are ordered by their leaves; rows that are equal throughout have their own ranks and proofs. A null key
comes first, a null group is a group of its own. An empty table has no root and gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.labelled import id_remainder
from tallyline.llm.tables import near, table
from tallyline.session import saved

FAN = 3
DEEP = 6
#: Rows of the store go to all tasks up to this number; one has at most 3 ** 6 + ... + 1 = 1093 digests, some 90 KB.
NEAR_ROWS = 256
_WIDE = FAN**DEEP


def leaf_digest(columns: Sequence[str | Column]) -> Column:
    """The digest of a row: of each column its length and text, or ``-``."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank``, from 0, within each group, and ``size``, the number of its rows; nulls come first.

    One range sort; then the rows of each group in each partition are counted, and these counts are added up.
    """
    at = F.monotonically_increasing_id()
    sorted_ = saved(rows.orderBy(*group, *order).withColumn("at", at), "ranked")
    part = F.shiftright("at", 33)
    counts = sorted_.groupBy(*group, part.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    all_ = Window.partitionBy(*group)
    before = F.sum("n").over(all_.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    names = [f"g{i}" for i in range(len(group))]
    offsets = saved(
        counts.select(
            *[F.col(g).alias(n) for g, n in zip(group, names)], F.col("part").alias("of_part"), "first",
            F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(all_).alias("size"),
        ), "offsets",
    )
    same = part == F.col("of_part")
    for g, n in zip(group, names):
        same &= F.col(g).eqNullSafe(F.col(n))
    rank = F.col("at") - F.col("first") + F.col("before")
    return sorted_.join(near(offsets), same).select(*rows.columns, rank.alias("rank"), "size")


def _height(size: str) -> str:
    powers = ", ".join(f"{FAN**i}L" for i in range(40))
    return f"size(filter(array({powers}), p -> p < {size}))"


def _levels(digests: str, levels: str) -> str:
    """The digests of ``levels`` levels over ``digests``, the lowest first, the digests themselves included."""
    parents = f"""transform(sequence(0, (size(element_at(a, -1)) - 1) div {FAN}),
        i -> sha2(array_join(slice(element_at(a, -1), {FAN} * i + 1, {FAN}), ''), 256))"""
    steps = f"if({levels} > 0, sequence(1, {levels}), cast(array() as array<int>))"
    return f"aggregate({steps}, array({digests}), (a, k) -> concat(a, array({parents})))"


@dataclass(frozen=True)
class Tree:
    """Steps of ``DEEP`` levels, the lowest first: tables of ``group, block, size, digest, levels``; and the tops."""

    steps: list[DataFrame]
    tops: DataFrame

    def store(self, step: int) -> DataFrame:
        """``digest`` and ``levels``, the records under it; equal subtrees are held once."""
        return self.steps[step].groupBy("digest").agg(F.first("levels").alias("levels"))


def build_tree(nodes: DataFrame, extra: Sequence[str] = ()) -> Tree:
    """The tree over ``group, rank, size, digest``; columns ``extra`` stay with the lowest step, as lists of ``members``."""
    steps, tops, step = [], None, 0
    while True:
        levels = f"least({DEEP}, {_height('size')} - {DEEP * step})"
        more = list(extra) if step == 0 else []
        packed = nodes.groupBy("group", F.expr(f"rank div {_WIDE}").alias("block"), "size").agg(
            F.array_sort(F.collect_list(F.struct("rank", "digest", *more))).alias("members")
        )
        made = packed.withColumn("levels", F.expr(_levels("members.digest", levels)))
        made = made.withColumn("digest", F.expr("element_at(element_at(levels, -1), 1)"))
        table_ = saved(made if step == 0 else made.drop("members"), f"segments{step}")
        steps.append(table_)
        done = F.expr(f"{_height('size')} <= {DEEP * (step + 1)}")
        ready = table_.where(done).select("group", "size", "digest")
        tops = ready if tops is None else tops.unionByName(ready)
        rest = table_.where(~done)
        if rest.isEmpty():
            return Tree(steps, tops)
        nodes = rest.select("group", F.col("block").alias("rank"), "size", "digest")
        step += 1


def _path(levels: str, place: str) -> str:
    """From the top of ``levels`` to its lowest element number ``place``: digits, and the children not chosen."""
    power = f"element_at(array({', '.join(str(FAN**i) for i in range(DEEP + 1))}), k + 1)"
    here = f"cast({place} div {power} as int)"
    run = f"slice(element_at({levels}, k + 1), {here} - {here} % {FAN} + 1, {FAN})"
    step = f"named_struct('digit', {here} % {FAN}, 'others', filter({run}, (d, j) -> j <> {here} % {FAN}))"
    down = f"if(size({levels}) > 1, sequence(size({levels}) - 2, 0, -1), cast(array() as array<int>))"
    return f"transform({down}, k -> {step})"


def _descend(state: DataFrame, tree: Tree, step: int, rank: str) -> DataFrame:
    """``state`` with its ``digest`` and ``path`` led down by the records of one step; rows that start lower stay."""
    store = tree.store(step).withColumnRenamed("digest", "top")
    few = tree.steps[step].limit(NEAR_ROWS + 1).count() <= NEAR_ROWS
    met = state.join(F.broadcast(store) if few else store, F.col("digest") == F.col("top"), "left")
    place = f"({rank} div {_WIDE**step}L) % {_WIDE}"
    return met.select(
        *[c for c in state.columns if c not in ("digest", "path")],
        F.expr(f"if(top is null, digest, element_at(levels[0], cast({place} as int) + 1))").alias("digest"),
        F.expr(f"if(top is null, path, concat(path, {_path('levels', place)}))").alias("path"),
    )


PATH = "array<struct<digit:int,others:array<string>>>"


@dataclass(frozen=True)
class Manifest:
    """The trees of the groups, the tree over their subroots, and the root (null of an empty table).

    ``places`` has the rank of each group, and the root as the digest to start from.
    """

    groups: Tree
    top: Tree
    places: DataFrame
    root: str | None

    def proofs(self) -> DataFrame:
        """One row per leaf: ``group``, the leaf's own columns, ``leaf``, ``subroot``, ``root`` and ``proof``.

        ``proof`` leads from the leaf to the root: on each level the digit of the node in its run and the run's
        other digests.
        """
        requests = self.groups.steps[0].select("group", "block", "size")
        state = requests.join(near(self.places), F.col("group").eqNullSafe(F.col("of_group"))).drop("of_group")
        state = state.withColumn("path", F.expr(f"cast(array() as {PATH})"))
        for step in reversed(range(len(self.top.steps))):
            state = _descend(state, self.top, step, "place")
        state = state.withColumn("subroot", F.col("digest"))
        for step in reversed(range(1, len(self.groups.steps))):
            state = _descend(state, self.groups, step, f"(block * {_WIDE}L)")
        state = saved(state, "descent").withColumnsRenamed({"group": "of_group", "block": "of_block"})
        store = self.groups.store(0).withColumnRenamed("digest", "top")
        members = self.groups.steps[0].select("group", "block", "members")
        same = F.col("group").eqNullSafe(F.col("of_group")) & (F.col("block") == F.col("of_block"))
        met = state.join(store, F.col("digest") == F.col("top")).join(members, same)
        each = met.select("group", "subroot", "path", "levels", F.explode("members").alias("m"))
        place = f"(m.rank % {_WIDE})"
        own = [c for c in members.schema["members"].dataType.elementType.names if c not in ("rank", "digest")]
        return each.select(
            "group", *[F.col(f"m.{c}").alias(c) for c in own],
            F.expr(f"element_at(levels[0], cast({place} as int) + 1)").alias("leaf"),
            "subroot", F.lit(self.root).cast("string").alias("root"),
            F.reverse(F.expr(f"concat(path, {_path('levels', place)})")).alias("proof"),
        )


def build_manifest(leaves: DataFrame, group: str, key: str, extra: Sequence[str] = (), leaf: str = "leaf") -> Manifest:
    """The manifest of a table with a column of leaf digests; columns ``extra`` come back with the proofs."""
    rows = leaves.select(
        F.col(group).alias("group"), F.col(key).alias("key"), F.col(leaf).alias("digest"),
        *[F.col(c).alias(f"x{i}") for i, c in enumerate(extra)],
    )
    # stored before the sort, whose sampling would hash the texts again; the number parts rows that are equal
    rows = saved(rows.withColumn("number", F.monotonically_increasing_id()), "leaves")
    nodes = ranked(rows, ["group"], ["key", "digest", "number"])
    own = ["key", *[f"x{i}" for i in range(len(extra))]]
    groups = build_tree(nodes.drop("number"), own)
    subroots = ranked(groups.tops.select(F.col("group").alias("of_group"), "digest"), [], ["of_group"])
    subroots = saved(subroots, "subroots")
    top = build_tree(subroots.select(F.lit(0).alias("group"), "rank", "size", "digest"))
    found = top.tops.select("digest").first()
    root = found and found[0]
    # stored, so that the descent is a join on digests from the first step on
    places = saved(subroots.select("of_group", F.col("rank").alias("place"), F.lit(root).cast("string").alias("digest")), "places")
    return Manifest(groups, top, places, root)


def folded(leaf: str, proof: str = "proof") -> Column:
    """The root that a leaf and a proof give."""
    return F.expr(f"""aggregate({proof}, {leaf}, (d, s) -> sha2(concat(
        array_join(slice(s.others, 1, s.digit), ''), d, array_join(slice(s.others, s.digit + 1, {FAN}), '')), 256))""")


def proof_digest(proof: str = "proof") -> Column:
    """The sha256 of all digests of a proof, from the leaf's level up, left to right."""
    return F.expr(f"sha2(array_join(flatten(transform({proof}, s -> s.others)), ''), 256)")


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; where 2 divides the crc32 of the id, the text is checked without its line breaks."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    changed = F.when(id_remainder("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit("")))
    tampered = F.when(changed.isNotNull(), leaf_digest([*COLUMNS[:-1], changed]))
    leaves = docs.select("doc_id", "source", leaf_digest(COLUMNS).alias("leaf"), tampered.alias("tampered"))
    proofs = build_manifest(leaves, "source", "doc_id", ["tampered"]).proofs()
    checked = proofs.withColumn("given", F.coalesce("x0", "leaf")).withColumn("folded_root", folded("given"))
    return checked.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest().alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
