"""Merkle manifest of a dataset, kept as a postorder append log.

Every row is a leaf. The leaves of a source, in order, are hashed in runs of 16 until one node, its
subroot, is left; the subroots are hashed into one root in the same way. Nodes are logged when they
are complete: each after its last child. So the place of any node follows from its level and index alone,
by the sizes of the complete subtrees before it, and siblings are addressed without a search.

Builders are aligned: one takes 4,096 consecutive nodes of a level, which are whole subtrees three levels
high, and writes their part of the log. Their tops are the nodes of the next round, so a round
leaves 1/4,096 of the nodes, and no task ever holds more than one block of a source, however large it is.
Proofs go the way back: what lies beside a block's top is passed down to the block, once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from tidemark.llm.common import arrow_type, fold, materialise, prepare, table

ARITY = 16
HEIGHT = 3
#: nodes that one builder takes
BLOCK = ARITY**HEIGHT
#: characters of a node
WIDTH = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


# ---- closed forms ------------------------------------------------------------------------


def subtree_size(level: int) -> int:
    """Nodes of a complete subtree of that height."""
    return (ARITY ** (level + 1) - 1) // (ARITY - 1)


def leaf_position(leaf: int) -> int:
    """How many nodes a log holds before its given leaf: the subtrees that are complete by then, each
    of which is as long as `subtree_size` says."""
    before, level = 0, 0
    while leaf >> (4 * level):
        before += ((leaf >> (4 * level)) % ARITY) * subtree_size(level)
        level += 1
    return before


def position(level: int, index: int, leaves: int) -> int:
    """Where the log of a tree holds a node: `level` places after the last leaf below it."""
    return leaf_position(min((index + 1) * ARITY**level, leaves) - 1) + level


def height(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // ARITY), levels + 1
    return levels


def runs(rank: int, leaves: int) -> Iterator[tuple[int, int]]:
    """For each level, from the leaves up, how many siblings stand to the left and right of a leaf's path."""
    while leaves > 1:
        left = rank % ARITY
        yield left, min(ARITY, leaves - (rank - left)) - 1 - left
        rank, leaves = rank // ARITY, -(-leaves // ARITY)


def append_nodes(base: list[bytes], levels: int) -> list[bytes]:
    """The log of consecutive nodes and of what `levels` levels above them make, in completion order."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def complete(level: int, node: bytes) -> None:
        log.append(node)
        if level < levels:
            waiting[level].append(node)
            if len(waiting[level]) == ARITY:
                close(level)

    def close(level: int) -> None:
        run, waiting[level] = waiting[level], []
        complete(level + 1, digest(b"".join(run)))

    for node in base:
        complete(0, node)
    for level in range(levels):
        if waiting[level]:
            close(level)
    return log


def climb(node: bytes, path: list[tuple[int, int]], siblings: bytes) -> bytes:
    """The node at the top of a path, from one below and the siblings along it."""
    at = 0
    for left, right in path:
        middle, end = at + left * WIDTH, at + (left + right) * WIDTH
        node = digest(siblings[at:middle] + node + siblings[middle:end])
        at = end
    return node


# ---- building ----------------------------------------------------------------------------


def hashed(*columns: Column) -> Column:
    """The leaf of a row: of each value its bytes as UTF-8 with their number before, or a dash for null."""

    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[part(c) for c in columns]).cast("binary"), 256)


def ranked(rows: DataFrame) -> DataFrame:
    """rows (tree, id, node, salt, ...) with `rank`, the position in their tree by (id, node, salt), nulls
    first, and `leaves`, the size of the tree. Written once.

    Rows are dealt by ranges, so a tree of any size lies over many tasks; what they count of each
    tree, a row per task and tree, gives the offsets.
    """
    order = ["tree", "id", "node", "salt"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = materialise(placed.withColumn("part", F.shiftright("place", 33)))
    counted = placed.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    upto = Window.partitionBy("tree").orderBy("part")
    offsets = counted.select(
        "part", "tree", (F.sum("n").over(upto) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("leaves"))
    return placed.join(offsets, ["part", "tree"]).withColumn("rank", F.col("place") + F.col("shift")).drop("part", "place", "shift", "salt")


SEGMENT = StructType([StructField("tree", StringType()), StructField("block", LongType()), StructField("leaves", LongType()),
                      StructField("nodes", BinaryType())])


def dealt(rows: DataFrame) -> DataFrame:
    """Rows (tree, block, rank, ...) so that a task holds whole blocks, one after the other by rank."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block after the other."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[0]["tree"], held[0]["block"]) != (row["tree"], row["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def levels_of(leaves: int) -> int:
    """Levels that a builder adds to a block: all, or as many as a block is high if the tree has more blocks."""
    return height(leaves) if leaves <= BLOCK else HEIGHT


def segments(nodes: DataFrame) -> DataFrame:
    """The log segment of every block of nodes (tree, rank, leaves, node), written once."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_block(batches):
            first = rows[0]
            log = append_nodes([r["node"].encode() for r in rows], levels_of(first["leaves"]))
            yield pa.RecordBatch.from_pylist(
                [{"tree": first["tree"], "block": first["block"], "leaves": first["leaves"], "nodes": b"".join(log)}],
                schema=pa.schema([(f.name, arrow_type(f.dataType)) for f in SEGMENT.fields]))

    rows = nodes.select("tree", F.floor(F.col("rank") / BLOCK).alias("block"), "rank", "leaves", "node")
    return materialise(dealt(rows).mapInArrow(build, SEGMENT))


def top(nodes: Column) -> Column:
    """The node that a segment completes last."""
    return F.substring(nodes, -WIDTH, WIDTH).cast("string")


def rounds(leaves: DataFrame) -> list[DataFrame]:
    """Segments of the leaves, of the tops of their blocks, and so on until every tree has one top."""
    done = [segments(leaves)]
    while not (rest := done[-1].where(F.col("leaves") > BLOCK)).isEmpty():
        done.append(segments(rest.select("tree", F.col("block").alias("rank"), F.ceil(F.col("leaves") / BLOCK).alias("leaves"), top(F.col("nodes")).alias("node"))))
    return done


def tops(built: list[DataFrame]) -> DataFrame:
    """(tree, node): the one node that is left of each tree."""
    parts = [s.where(F.col("leaves") <= BLOCK).select("tree", top(F.col("nodes")).alias("node")) for s in built]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@dataclass(frozen=True)
class Manifest:
    """leaves: (tree, id, node, changed, rank, leaves) of every row; log: segments of the leaves' trees, by
    round; sources: (tree, rank, leaves, node) of their subroots; upper: segments of the tree above;
    root: its top, None for an empty dataset."""

    leaves: DataFrame
    log: list[DataFrame]
    sources: DataFrame
    upper: list[DataFrame]
    root: str | None


def build_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, tree: str = "source", order: str = "doc_id", changed: Column | None = None) -> Manifest:
    """The manifest of docs: leaves over `fields`, a tree for each value of `tree` (null is one of its own and
    comes first), leaves by `order` (nulls first). `changed`, if given, is a second digest that
    travels with each row, such as that of a row to be verified.

    Rows of equal order follow by their digest; rows that are equal in all fields are leaves of their own,
    in the order in which they are read. Other columns, whatever their names, take no part.
    """
    prepare(docs.sparkSession)
    name = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    rows = docs.select(
        name.alias("tree"), F.col(order).alias("id"), hashed(*[F.col(c) for c in fields]).alias("node"),
        (F.lit(None).cast("string") if changed is None else changed).alias("changed"), F.monotonically_increasing_id().alias("salt"))
    leaves = materialise(ranked(materialise(rows)))
    log = rounds(leaves)
    subroots = tops(log).select(F.lit("").alias("tree"), F.col("tree").alias("id"), "node", F.lit(0).cast("long").alias("salt"))
    sources = materialise(ranked(subroots))
    upper = rounds(sources)
    root = tops(upper).first()
    return Manifest(leaves, log, sources, upper, root and root["node"])


# ---- proofs ------------------------------------------------------------------------------


class Siblings:
    """What lies beside the paths of one block, read from its segment at closed-form positions."""

    def __init__(self, nodes: bytes, base: int, leaves: int, above: bytes):
        """nodes: the segment; base: how many nodes the block was built from; above: the siblings beside
        the path from the block's top on."""
        self.levels = levels_of(leaves)
        sizes = [base]
        for _ in range(self.levels):
            sizes.append(-(-sizes[-1] // ARITY))
        self.rows = [[self._at(nodes, position(level, i, base)) for i in range(size)] for level, size in enumerate(sizes[:-1])]
        self.upward = [above]
        for level in range(self.levels - 1, 0, -1):
            self.upward = [b"".join(self.beside(level, i)) + self.upward[i // ARITY] for i in range(sizes[level])]

    @staticmethod
    def _at(nodes: bytes, place: int) -> bytes:
        return nodes[place * WIDTH : (place + 1) * WIDTH]

    def beside(self, level: int, index: int) -> tuple[bytes, bytes]:
        """Siblings to the left and to the right, none if there is no level above."""
        if level >= self.levels:
            return b"", b""
        first, row = index - index % ARITY, self.rows[level]
        return b"".join(row[first:index]), b"".join(row[index + 1 : first + ARITY])

    def rest(self, index: int) -> bytes:
        """The siblings from the parent of a base node on."""
        return self.upward[index // ARITY] if self.levels else self.upward[0]


def _base(row: dict) -> int:
    """Base nodes of a segment row: a whole block, or what is left for the last one."""
    return min(BLOCK, row["leaves"] - row["block"] * BLOCK)


HEAD = StructType([StructField("tree", StringType()), StructField("block", LongType()), StructField("above", BinaryType()),
                   StructField("place", LongType()), StructField("trees", LongType()), StructField("subroot", StringType())])


def together(built: DataFrame, heads: DataFrame, *rows: DataFrame) -> DataFrame:
    """Segments, what lies above their blocks, and rows of the blocks, dealt so that of each block the segment comes
    first and its head second. No side is sent to all tasks: each has its share of the nodes."""
    whole = built.withColumn("rank", F.lit(-2).cast("long")).unionByName(heads.withColumn("rank", F.lit(-1).cast("long")), allowMissingColumns=True)
    for more in rows:
        whole = whole.unionByName(more, allowMissingColumns=True)
    return dealt(whole)


def passed_down(built: list[DataFrame], above: DataFrame) -> DataFrame:
    """The heads of every block of the first round: `above`, the siblings beside the path from its top up, and what
    else the row of its tree in `above` (tree, above, place, trees, subroot) says."""

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, head in by_block(batches):
            base = _base(segment)
            block = Siblings(segment["nodes"], base, segment["leaves"], head["above"])
            at, first = range(base), segment["block"] * BLOCK
            columns = [[segment["tree"]] * base, [first + i for i in at], [b"".join(block.beside(0, i)) + block.rest(i) for i in at],
                       *([head[n]] * base for n in HEAD.names[3:])]
            yield pa.RecordBatch.from_arrays([pa.array(c, arrow_type(f.dataType)) for c, f in zip(columns, HEAD.fields, strict=True)], names=HEAD.names)

    heads = None
    for built_round in reversed(built):
        # a tree has one block here, so no value of the key repeats
        crowned = built_round.where(F.col("leaves") <= BLOCK).select("tree", "block").join(above.hint("merge"), "tree").select(*HEAD.names)
        heads = crowned if heads is None else heads.unionByName(crowned)
        if built_round is not built[0]:
            heads = materialise(together(built_round, heads).mapInArrow(down, HEAD))
    return heads


PROOF = [StructField("leaf", StringType()), StructField("subroot", StringType()), StructField("root", StringType()),
         StructField("proof_sha256", StringType()), StructField("folded_root", StringType()), StructField("verified", BooleanType())]


def verify_rows(manifest: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: the digest of its siblings
    from leaf to root, and the root that follows from its `changed` digest, or from its leaf where that
    is null. One row per leaf; no rows for an empty dataset."""
    leaves = manifest.leaves
    schema = StructType([StructField("id", leaves.schema["id"].dataType), *PROOF])
    nothing = {"above": F.lit(b""), "place": F.lit(None).cast("long"), "trees": F.lit(None).cast("long"), "subroot": F.lit(None).cast("string")}
    heads = passed_down(manifest.upper, tops(manifest.upper).select("tree", *[c.alias(n) for n, c in nothing.items()]))
    spans = manifest.sources.select("tree", F.floor(F.col("rank") / BLOCK).alias("block"), "rank", F.col("leaves").alias("trees"), F.col("id").alias("name"), "node")

    # siblings of every subroot, from the blocks of the upper tree
    found = StructType([HEAD["tree"], *HEAD.fields[2:]])

    def source_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, head, *rows in by_block(batches):
            block = Siblings(segment["nodes"], _base(segment), segment["leaves"], head["above"])
            out = []
            for r in rows:
                i = r["rank"] - segment["block"] * BLOCK
                out.append({"tree": r["name"], "above": b"".join(block.beside(0, i)) + block.rest(i), "place": r["rank"],
                            "trees": r["trees"], "subroot": r["node"]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(f.name, arrow_type(f.dataType)) for f in found.fields]))

    paths = materialise(together(manifest.upper[0], heads, spans).mapInArrow(source_paths, found))
    below = passed_down(manifest.log, paths)
    rows = leaves.withColumn("block", F.floor(F.col("rank") / BLOCK))
    root = (manifest.root or "").encode()

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, head, *block_rows in by_block(batches):
            block = Siblings(segment["nodes"], _base(segment), segment["leaves"], head["above"])
            out: dict[str, list] = {n: [] for n in schema.names}
            paths_up: dict[int, list[tuple[int, int]]] = {}
            known: dict[tuple[int, bytes], bytes] = {}
            for r in block_rows:
                i = r["rank"] - segment["block"] * BLOCK
                up = i // ARITY if block.levels else 0
                left, right = block.beside(0, i)
                rest = block.rest(i)
                node = (r["changed"] or r["node"]).encode()
                if block.levels:
                    node = digest(left + node + right)
                if up not in paths_up:
                    whole = list(runs(r["rank"], r["leaves"]))[1 if block.levels else 0 :]
                    paths_up[up] = [*whole, *runs(head["place"], head["trees"])]
                if (up, node) not in known:
                    known[up, node] = climb(node, paths_up[up], rest)
                folded = known[up, node]
                values = (r["id"], r["node"], head["subroot"], root.decode(), digest(left + right + rest).decode(), folded.decode(), folded == root)
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], arrow_type(f.dataType)) for f in schema.fields], names=schema.names)

    return together(manifest.log[0], below, rows).mapInArrow(prove, schema)


def log_rows(manifest: Manifest) -> DataFrame:
    """(tree, position, level, place, node) of every node of the leaves' trees: the log as one table. Positions
    are gapless from 0 in each tree, and no node comes before its children."""
    out = StructType([StructField("tree", StringType()), StructField("position", LongType()), StructField("level", LongType()),
                      StructField("place", LongType()), StructField("node", StringType())])
    sizes = manifest.log[0].groupBy("tree").agg(F.max("leaves").alias("all"))
    parts = []
    for number, built in enumerate(manifest.log):

        def placed(batches: Iterator[pa.RecordBatch], above: int = HEIGHT * number) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    rows, size = [], _base(row)
                    base = size
                    for level in range(levels_of(row["leaves"]) + 1):
                        first = row["block"] * ARITY ** (HEIGHT - level)
                        for i in range(size if level or not above else 0):
                            at = position(level, i, base)
                            rows.append({"tree": row["tree"], "position": position(above + level, first + i, row["all"]), "level": above + level,
                                         "place": first + i, "node": row["nodes"][at * WIDTH : (at + 1) * WIDTH].decode()})
                        size = -(-size // ARITY)
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([(f.name, arrow_type(f.dataType)) for f in out.fields]))

        parts.append(built.join(sizes.hint("merge"), "tree").mapInArrow(placed, out))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# ---- the registered query ----------------------------------------------------------------


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    columns = [F.col(c) for c in FIELDS[:-1]]
    tampered = F.when(fold(F.col("doc_id")) == 0, hashed(*columns, F.translate("text", UPPER, LOWER)))
    return verify_rows(build_manifest(docs, changed=tampered)).withColumnRenamed("id", "doc_id")


def _merkle_levels(name: str, first: str, group: str, levels: int) -> str:
    """Common table expressions <name>0 to <name><levels>: nodes (grp, i, n, h) level by level. A tree of one
    node keeps it."""
    parts = [f"{name}0 AS ({first})"]
    for level in range(levels):
        parts.append(
            f"{name}{level + 1} AS (SELECT {group}, CASE WHEN n = 1 THEN i ELSE i // 16 END AS i, max((n + 15) // 16) AS n, "
            f"CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{level} GROUP BY 1, 2)")
    return ",\n".join(parts)


def _proof(name: str, group: str, levels: int, key: str) -> tuple[str, str]:
    """Joins and the list of (left, right) siblings of a path, level by level."""
    joins, items = [], []
    for level in range(levels):
        here = f"{name}s{level}"
        joins.append(
            f"JOIN (SELECT {group}, i, n, coalesce(string_agg(h, '') OVER (PARTITION BY {group}, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(h, '') OVER (PARTITION BY {group}, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{level}) {here} "
            f"ON {here}.{group} = {key[0]} AND {here}.i = {key[1]} // {16**level}")
        items.append(f"{{'l': {here}.l, 'r': {here}.r, 'more': {here}.n > 1}}")
    return "\n".join(joins), ", ".join(items)


def oracle(levels: int = 6, upper: int = 4) -> str:
    """The manifest in SQL, for sources of up to 16^levels documents and up to 16^upper sources."""
    parts = "concat(" + ", ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen({c}::VARCHAR), ':', {c}) END" for c in FIELDS[:-1]) + ", CASE WHEN {0} IS NULL THEN '-' ELSE concat(strlen({0}), ':', {0}) END)"
    crc = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
           "lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)")
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    below, below_items = _proof("t", "g", levels, ("d.g", "d.i"))
    above, above_items = _proof("u", "g", upper, ("0", "s.i"))
    return f"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, sha256({parts.format('text')}) AS h,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN sha256({parts.format(lower)}) END AS changed,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, sha256({parts.format('text')})) - 1 AS i
  FROM documents),
{_merkle_levels('t', 'SELECT g, i, count(*) OVER (PARTITION BY g) AS n, h FROM d', 'g', levels)},
s AS (SELECT g AS name, h, row_number() OVER (ORDER BY g) - 1 AS i FROM t{levels}),
{_merkle_levels('u', 'SELECT 0 AS g, i, count(*) OVER () AS n, h FROM s', 'g', upper)},
p AS (
  SELECT d.doc_id, d.h AS leaf, d.changed, s.h AS subroot, (SELECT h FROM u{upper}) AS root,
         list_filter([{below_items}, {above_items}], lambda x: x.more) AS path
  FROM d JOIN s ON s.name = d.g
{below}
{above}),
f AS (
  SELECT *, sha256(list_aggregate(list_concat([''], list_transform(path, lambda x: x.l || x.r)), 'string_agg', '')) AS proof_sha256,
         list_reduce(list_concat([coalesce(changed, leaf)], list_transform(path, lambda x: x.l || '|' || x.r)),
                     lambda a, x: sha256(concat(split_part(x, '|', 1), a, split_part(x, '|', 2)))) AS folded_root
  FROM p)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f"""


ORACLE_OP13 = oracle()
