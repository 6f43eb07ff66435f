"""A trie of the prefixes of conversations, built as burst tries.

A turn's id is a hash of its role and text; equal conversations are one sequence of turn ids with a count.
All sequences start in one container. A container with too many of them is burst: what they have in common
becomes a head of the trie, and they go to new containers by their next turn id; that goes on until all
containers are small. Spark sorts the sequences by container, and each container is swept once
with a stack of open nodes. Heads add up what lies below them, by the lists of heads above each container.

A burst parts the sequences at the first turn in which they differ, so a long beginning that all share
takes one burst and not one per turn; there are at most as many rounds as turns in the longest sequence
that runs through oversized containers. Copies never meet in a container, however many there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, temporary_work, work_dir
from .common import tidy

#: A container is burst when it has more sequences or more turns than this.
SEQUENCES = 4096
TURNS = 1 << 17
#: Rows sent back at a time, and characters of a block of joined ids.
ROWS = 8192
BLOCK = 1 << 20
#: The first turns come from the conversation that starts the group of GROUP ids.
GROUP = 5
SHARED = 9
NONE = hashlib.sha256(b"").hexdigest()
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, cls binary"


def _md5(text: Column) -> Column:
    return F.unhex(F.md5(text))


def sequences(conversations: DataFrame) -> DataFrame:
    """conv, ids, sizes: per conversation the ids of its turns in order and the bytes of their texts.

    Turns without a number come first; turns of one number follow their ids. A missing role or text
    is empty. Rows without a conversation are left out; repeated rows are turns of their own. The ids
    of one conversation (16 bytes a turn) are held in a task, its texts are not.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = _md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.struct(F.col("turn").cast("bigint").alias("turn"), key.alias("id"), F.octet_length(text).cast("bigint").alias("size")).alias("t"),
    )
    found = turns.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return found.select("conv", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"))


def rebuilt(found: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the one that starts its group of ids, which may be missing."""
    start = F.col("conv") - F.col("conv") % GROUP
    firsts = found.select(F.col("conv").alias("start"), *[F.slice(c, 1, SHARED - 1).alias(f"first_{c}") for c in ("ids", "sizes")])
    rows = found.withColumn("start", start).join(firsts, "start", "left")
    many = (F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED).cast("int")

    def both(name: str, kind: str) -> Column:
        own, first = F.col(name), F.coalesce(f"first_{name}", F.array().cast(f"array<{kind}>"))
        return F.concat(F.slice(first, F.lit(1), many), F.slice(own, many + 1, F.greatest(F.size(own) - many, F.lit(0)))).alias(name)

    return rows.select("conv", both("ids", "binary"), both("sizes", "bigint"))


def _classes(rows: DataFrame) -> DataFrame:
    found = rows.groupBy("cls").agg(
        F.count("*").alias("n"), F.min("conv").alias("least"), F.first("ids").alias("ids"), F.first("sizes").alias("sizes")
    )
    return found.select(
        "*",
        _md5(F.lit("")).alias("key"),
        F.lit(0).alias("top"),
        F.array().cast("array<binary>").alias("path"),
        F.lit(None).cast("bigint").alias("up"),
    )


def _bursts(held: DataFrame, sequences: int, turns: int) -> DataFrame:
    """One row per oversized container: where its sequences part, and what they have in common."""
    found = held.groupBy("key").agg(
        F.count("*").alias("rows"),
        F.sum(F.size("ids") - F.col("top")).alias("turns"),
        F.min(F.struct("ids", "sizes")).alias("low"),
        F.max("ids").alias("high"),
        F.sum("n").alias("n"),
        F.min("least").alias("least"),
        F.first("top").alias("top"),
        F.first("path").alias("path"),
        F.first("up").alias("up"),
    )
    big = found.where((F.col("rows") > 1) & ((F.col("rows") > sequences) | (F.col("turns") > turns)))
    a, b = F.col("low.ids"), F.col("high")
    # The first turn in which the least and the greatest differ; all agree up to there.
    shorter = F.least(F.size(a), F.size(b))
    differ = F.expr("transform(sequence(0, greatest(least(size(low.ids), size(high)) - 1, 0)), i -> get(low.ids, i) <> get(high, i))")
    at = F.array_position(differ, True).cast("int")
    agree = F.when(at > 0, at - 1).otherwise(shorter)
    return big.select("key", "n", "least", "top", "path", "up", agree.alias("agree"), F.slice("low.sizes", F.lit(1), agree).alias("sizes"))


def _sweep(rows: DataFrame) -> DataFrame:
    """The nodes of all containers from their sequences; the top node of a container carries ``path``."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(c.split()[0], pa.int64()) for c in NODE.split(", ")[:-1]] + [("cls", pa.binary()), ("path", pa.list_(pa.binary()))]
        )
        out: list[tuple] = []
        stack: list[dict] = []
        key, before, up, path = None, [], None, []

        def node(depth: int, sizes: list[int]) -> dict:
            size = sizes[depth - 1] if depth else 0
            return {"depth": depth, "n": 0, "least": None, "children": [], "leaves": 0, "saved": 0, "cls": None, "size": size}

        def close() -> None:
            """Closes the deepest open node; its children learn their parent."""
            top = stack.pop()
            least, children = top["least"], top["children"]
            out.extend((conv, depth, least, *rest, None) for conv, depth, *rest in children)
            leaves = top["leaves"] or 1
            saved = top["saved"] + (top["n"] - 1) * top["size"]
            row = least, top["depth"], top["n"], len(children), leaves, saved, top["cls"]
            if stack:
                above = stack[-1]
                above["children"].append(row)
                above["leaves"] += leaves
                above["saved"] += saved
                count(above, top["n"], least)
            else:
                out.append((least, top["depth"], up, *row[2:], path))

        def count(at: dict, n: int, least: int) -> None:
            at["n"] += n
            at["least"] = least if at["least"] is None else min(at["least"], least)

        def sent() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            for k in range(batch.num_rows):
                row = {c: v[k].as_py() for c, v in columns.items()}
                ids, sizes, top = row["ids"], row["sizes"], row["top"]
                if row["key"] != key:
                    while stack:
                        close()
                    key, before, up, path = row["key"], ids, row["up"], row["path"]
                    stack.append(node(top, sizes))
                    same = top
                else:
                    same = top
                    while same < len(before) and same < len(ids) and before[same] == ids[same]:
                        same += 1
                    while stack[-1]["depth"] > same:
                        close()
                    before = ids
                stack.extend(node(depth, sizes) for depth in range(same + 1, len(ids) + 1))
                stack[-1]["cls"] = row["cls"]
                count(stack[-1], row["n"], row["least"])
                if len(out) >= ROWS:
                    yield sent()
        while stack:
            close()
        if out:
            yield sent()

    ordered = rows.repartition("key").sortWithinPartitions("key", "ids")
    return ordered.mapInArrow(sweep, f"{NODE}, path array<binary>")


def _chains(bursts: DataFrame, tops: DataFrame, ends: DataFrame) -> DataFrame:
    """The nodes of the heads, which burst containers left, from the containers below them."""
    own = F.expr("(n - 1) * aggregate(sizes, 0L, (s, x) -> s + x)") - F.expr(
        "(n - 1) * aggregate(slice(sizes, 1, greatest(top - 1, 0)), 0L, (s, x) -> s + x)"
    )
    parts = tops.select("path", "n_leaves", "saved_tokens").unionByName(
        bursts.select("path", F.lit(0).cast("bigint").alias("n_leaves"), own.alias("saved_tokens"))
    )
    below = parts.select(F.explode("path").alias("key"), "n_leaves", "saved_tokens").groupBy("key")
    below = below.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
    children = tops.select("path").unionByName(bursts.select("path")).where(F.size("path") > 0)
    children = children.groupBy(F.element_at("path", -1).alias("key")).agg(F.count("*").alias("below_it"))
    rows = bursts.join(below, "key").join(children, "key").join(ends, "key", "left")
    rows = rows.select("*", F.explode(F.sequence("top", "agree")).alias("depth"))
    last = F.col("depth") == F.col("agree")
    from_here = F.expr("aggregate(slice(sizes, greatest(depth, 1), greatest(agree - greatest(depth, 1) + 1, 0)), 0L, (s, x) -> s + x)")
    return rows.select(
        F.col("least").alias("conv_id"),
        F.col("depth").cast("bigint").alias("depth"),
        F.when(F.col("depth") == F.col("top"), F.col("up")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("below_it")).otherwise(1).cast("bigint").alias("n_children"),
        "n_leaves",
        (F.col("below") + (F.col("n") - 1) * from_here).alias("saved_tokens"),
        F.when(last, F.col("cls")).alias("cls"),
    )


def _signed(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """cls, ends_sha256: the hash of the ascending conversations that are one sequence.

    Ids are joined in blocks by range; only the blocks of a sequence meet in a task, one at a time.
    """
    alone = classes.where("n = 1").select("cls", F.sha2(F.col("least").cast("string"), 256).alias("ends_sha256"))
    many = rows.select("cls", "conv").join(classes.where("n > 1").select("cls"), "cls", "left_semi")
    many = materialize(many, "prefixes-copies").repartitionByRange("cls", "conv").sortWithinPartitions("cls", "conv")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["cls", "first", "part"]
        kinds = [pa.binary(), pa.int64(), pa.string()]
        cls, held, size, out = None, [], 0, []

        def close() -> None:
            if held:
                out.append((cls, held[0], ",".join(map(str, held))))

        for batch in batches:
            for one, conv in zip(batch.column("cls").to_pylist(), batch.column("conv").to_pylist()):
                if one != cls or size >= BLOCK:
                    close()
                    cls, held, size = one, [], 0
                held.append(conv)
                size += 20
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, state, out = None, None, []
        for batch in batches:
            for one, part in zip(batch.column("cls"), batch.column("part")):
                if one.as_py() != cls:
                    if state:
                        out.append((cls, state.hexdigest()))
                    cls, state = one.as_py(), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(part.as_py().encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.binary()), pa.array([s for _, s in out])], names=["cls", "ends_sha256"])
                out = []
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([cls], pa.binary()), pa.array([state.hexdigest()])], names=["cls", "ends_sha256"])

    blocks = many.mapInArrow(join, "cls binary, first bigint, part string")
    blocks = blocks.repartition("cls").sortWithinPartitions("cls", "first").select("cls", "part")
    return alone.unionByName(blocks.mapInArrow(sign, "cls binary, ends_sha256 string"))


def prefix_trie(found: DataFrame, sequences: int = SEQUENCES, turns: int = TURNS) -> DataFrame:
    """One row per node of the trie of ``found`` (conv, ids, sizes), whose ids are turns' ids in order.

    The root stands for all conversations, turnless ones included. An empty table gives no rows.
    """
    spark = found.sparkSession
    tidy(spark)
    path = work_dir(spark, "prefixes")
    with temporary_work(spark):
        cls = _md5(F.array_join(F.transform("ids", lambda x: F.hex(x)), ""))
        rows = materialize(found.select("conv", cls.alias("cls"), "ids", "sizes"), "prefixes-rows")
        classes = materialize(_classes(rows), "prefixes-classes")
        held, settled, bursts, ends = classes, [], [], []
        while True:
            big = materialize(_bursts(held, sequences, turns), "prefixes-bursts")
            if big.isEmpty():
                settled.append(held)
                break
            bursts.append(big)
            at = big.select("key", "agree", F.col("least").alias("above"))
            parted = materialize(held.join(at, "key", "left"), "prefixes-parted")
            settled.append(parted.where("agree is null").drop("agree", "above"))
            ends.append(parted.where("size(ids) = agree").select("key", "cls"))
            held = parted.where("size(ids) > agree").select(
                "cls",
                "n",
                "least",
                "ids",
                "sizes",
                F.unhex(F.md5(F.concat(F.col("key"), F.expr("ids[agree]")))).alias("key"),
                (F.col("agree") + 1).alias("top"),
                F.array_append("path", F.col("key")).alias("path"),
                F.col("above").alias("up"),
            )
        union = lambda tables: reduce(DataFrame.unionByName, tables)
        swept = materialize(_sweep(union(settled)), "prefixes-swept")
        nodes = swept.drop("path")
        if bursts:
            nodes = nodes.unionByName(_chains(union(bursts), swept.where("path is not null"), union(ends)))
        result = nodes.join(_signed(rows, classes), "cls", "left").select(
            *[c.split()[0] for c in NODE.split(", ")[:-1]], F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256")
        )
        result.write.parquet(path)
    return spark.read.schema(result.schema).parquet(path)


def op11(conversations: DataFrame) -> DataFrame:
    return prefix_trie(rebuilt(sequences(conversations)))


#: crc32 of a number's digits, bit by bit; 3988292384 is the reversed polynomial.
_CRC = (
    "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length({0}) + 1), "
    "lambda i: list_concat([ascii(substr({0}, i, 1))::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])))), "
    "lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END), 4294967295)"
)
OP11_SQL = f"""WITH src AS (
SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
num AS (SELECT c, r, t, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST,
md5(CAST(strlen(r) AS VARCHAR) || ':' || r || t)) AS p FROM src),
conv AS (SELECT c, c - c % 5 AS b, {_CRC.format("CAST(c AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT c FROM src)),
built AS (SELECT v.c, n.p, n.r, n.t FROM conv v JOIN num n ON n.c = v.b AND n.p <= v.h
UNION ALL SELECT v.c, n.p, n.r, n.t FROM conv v JOIN num n ON n.c = v.c AND n.p > v.h),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY p) AS d, {{'r': r, 't': t}} AS s FROM built),
prefixes AS (SELECT c, 0 AS d, CAST([] AS STRUCT(r VARCHAR, t VARCHAR)[]) AS s FROM conv
UNION ALL SELECT c, d, list(s) OVER (PARTITION BY c ORDER BY d) FROM turns),
nodes AS (SELECT d, s, min(c) AS conv_id, count(*) AS n FROM prefixes GROUP BY d, s),
size AS (SELECT c, max(d) AS last FROM prefixes GROUP BY c),
place AS (SELECT p.c, p.d, n.conv_id, n.n, CASE WHEN p.d = 0 THEN 0 ELSE strlen(p.s[p.d].t) END AS bytes
FROM prefixes p JOIN nodes n ON n.d = p.d AND n.s = p.s),
own AS (SELECT * FROM place WHERE c = conv_id),
ends AS (SELECT p.conv_id, p.d, sha256(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c)) AS sha
FROM place p JOIN size z ON z.c = p.c AND z.last = p.d GROUP BY p.conv_id, p.d),
children AS (SELECT a.conv_id, a.d, count(*) AS n FROM own o JOIN place a ON a.c = o.c AND a.d = o.d - 1 GROUP BY a.conv_id, a.d),
below AS (SELECT a.conv_id, a.d, count(*) FILTER (WHERE k.n IS NULL) AS leaves, sum((o.n - 1) * o.bytes) AS saved
FROM own o JOIN place a ON a.c = o.c AND a.d <= o.d LEFT JOIN children k ON k.conv_id = o.conv_id AND k.d = o.d GROUP BY a.conv_id, a.d)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, o.n AS n_convs, coalesce(k.n, 0) AS n_children,
CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM own o JOIN below b ON b.conv_id = o.conv_id AND b.d = o.d
LEFT JOIN place u ON u.c = o.c AND u.d = o.d - 1
LEFT JOIN children k ON k.conv_id = o.conv_id AND k.d = o.d
LEFT JOIN ends e ON e.conv_id = o.conv_id AND e.d = o.d"""
