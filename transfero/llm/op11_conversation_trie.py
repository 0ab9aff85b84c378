"""Prefix trie of conversations by fixed-length block hashing.

Conversations are cut into blocks of ``BLOCK`` turns. A block's digest covers its turns and its place, and the
xor of a conversation's earlier block digests (two 64-bit hashes) names the node at which the block starts, so
(start, digest) pairs group conversations block by block without comparing texts. Where a node has a single
block below it, every turn boundary inside that block belongs to the same conversations and is taken over as it
is; only blocks that have siblings are refined turn by turn, once per distinct block and not per conversation.

Sums over subtrees need no walk through the tree. A node belongs to its smallest member, whose own nodes are a
tail of its path, so the sum below a node is the total of the own nodes of all its members, less those of its
owner that lie above: one more grouping by blocks and one running sum along the path of each owner.

No text is shuffled, only digests. Conversations with very many turns, first turns that a third of all
conversations share, and thousands of equal conversations are pre-aggregated or dealt over range slices; ids of
conversations that end together are joined into texts of ``IDS`` ids, which one task hashes as a stream.

Defined results: rows without conv_id are no conversation; null turn comes first, equal turns are ordered by
digest, null role and text are empty, repeated rows are turns of their own; ``c % 5`` keeps the sign of c; a
conversation without turns is a member of the root; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, store, table
from .slices import running

#: Turns in a block, ids in one text, and what the rebuilding of conversations uses.
BLOCK, IDS = 4, 4096
FAMILY, HEADS = 5, 9
_NODE = ["depth", "a", "b"]


def rebuilt(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): turns ``conv_id, d, digest, bytes, n_turns`` and one row ``conv_id, n_turns`` each."""
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    own = running(rows, ["conv_id"], ["turn", "digest"], i=("sum", F.lit(1).cast("long")))
    own = store(spark, own.select("conv_id", (F.col("i") + 1).alias("i"), "digest", "bytes"), "turns")

    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("m"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h")
    each = sizes.select("conv_id", "m", h, (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    first = sizes.select(F.col("conv_id").alias("base"), F.col("m").alias("base_m"))
    each = each.join(first, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_m", F.lit(0))))
    each = store(spark, each.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("m") - F.col("h"), F.lit(0)))
                                    .alias("n_turns")), "conversations")
    heads_of = own.filter((F.col("conv_id") % family == 0) & (F.col("i") < heads)).withColumnRenamed("conv_id", "base")
    head = heads_of.join(each, "base").filter(F.col("i") <= F.col("h")).select("conv_id", F.col("i").alias("d"), "digest", "bytes", "n_turns")
    rest = own.join(each, "conv_id").filter(F.col("i") > F.col("h")).select(
        "conv_id", (F.col("i") - F.col("h") + F.col("taken")).alias("d"), "digest", "bytes", "n_turns")
    return head.unionByName(rest), each.select("conv_id", "n_turns")


def _mix(salt: int, k: Column, j: Column, digests: Column) -> Column:
    """Hash of the first j turns of block k."""
    return F.xxhash64(F.lit(salt), k, j.cast("long"), F.array_join(F.slice(digests, F.lit(1), j), ""))


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """``conv_id, k, digests, sizes, n_turns, ha, hb, a, b``: block k with its digest and the node (a, b) it starts at."""
    k = F.floor((F.col("d") - 1) / block).cast("long")
    grouped = turns.groupBy("conv_id", k.alias("k")).agg(
        F.sort_array(F.collect_list(F.struct("d", "digest", "bytes"))).alias("t"), F.max("n_turns").alias("n_turns"))
    cut = grouped.select("conv_id", "k", F.col("t.digest").alias("digests"), F.col("t.bytes").alias("sizes"), "n_turns")
    size = F.size("digests")
    cut = cut.withColumns({"ha": _mix(11, F.col("k"), size, F.col("digests")), "hb": _mix(17, F.col("k"), size, F.col("digests"))})
    return running(cut, ["conv_id"], ["k"], a=("xor", F.col("ha")), b=("xor", F.col("hb")))


def _inside(blocks: DataFrame, block: int, *carried: str) -> DataFrame:
    """A row per turn boundary of each distinct block: ``depth, a, b, pa, pb, bytes`` and the carried columns."""
    at = lambda j, salt, start: F.when(j == 0, F.col(start)).otherwise(F.col(start).bitwiseXOR(_mix(salt, F.col("k"), j, F.col("digests"))))
    one = lambda j: F.struct((F.col("k") * block + j).alias("depth"), at(j, 11, "a").alias("a"), at(j, 17, "b").alias("b"),
                             at(j - 1, 11, "a").alias("pa"), at(j - 1, 17, "b").alias("pb"), F.get(F.col("sizes"), j - 1).alias("bytes"))
    return blocks.select(*carried, F.explode(F.transform(F.sequence(F.lit(1), F.size("digests")), one)).alias("node")).select("node.*", *carried)


def _distinct(blocks: DataFrame, *aggregates: Column) -> DataFrame:
    return blocks.groupBy("k", "a", "b", "ha", "hb").agg(F.first("digests").alias("digests"), F.first("sizes").alias("sizes"), *aggregates)


def _nodes(blocks: DataFrame, block: int) -> DataFrame:
    """``depth, a, b, pa, pb, bytes, n, conv_id`` of every node under the root."""
    members = _distinct(blocks, F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    members = store(blocks.sparkSession, members, "blocks-distinct")
    # A block without siblings comes out of the grouping by its start; all others are joined by the whole block, not
    # by the start, under which very many may lie.
    one = members.groupBy("k", "a", "b").agg(F.count(F.lit(1)).alias("siblings"), F.first(F.struct("ha", "hb", "digests", "sizes", "n", "conv_id")).alias("one"))
    single = one.filter("siblings = 1").select("k", "a", "b", "one.*")
    alone = _inside(single, block, "n", "conv_id")
    split = members.join(single, ["k", "a", "b", "ha", "hb"], "left_anti")
    split = _inside(split, block, "n", "conv_id").groupBy(*_NODE).agg(
        *[F.first(c).alias(c) for c in ("pa", "pb", "bytes")], F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"))
    return alone.unionByName(split)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of texts sorted by (depth, a, b, chunk), joined by commas: one digest at a time is held."""
    at, state = None, None

    def row(key, digest):
        return pa.RecordBatch.from_pylist([dict(zip(_NODE, key), ends_sha256=digest.hexdigest())], _ENDS)

    for batch in batches:
        for depth, a, b, ids in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in [*_NODE, "ids"])):
            if (depth, a, b) != at:
                if at is not None:
                    yield row(at, state)
                at, state = (depth, a, b), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if at is not None:
        yield row(at, state)


_ENDS = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])


def _ends(ends: DataFrame, ids: int) -> DataFrame:
    """``depth, a, b, ends_sha256`` of the nodes at which conversations end (``depth, a, b, conv_id``)."""
    numbered = running(ends, _NODE, ["conv_id"], at=("sum", F.lit(1).cast("long")))
    chunk = F.floor(F.col("at") / ids).cast("long")
    texts = numbered.groupBy(*_NODE, chunk.alias("chunk")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    texts = store(ends.sparkSession, texts.select(*_NODE, "chunk", F.array_join("ids", ",").alias("ids")), "ends")
    long = texts.filter("chunk = 1").select(*_NODE)
    short = texts.join(long, _NODE, "left_anti").select(*_NODE, F.sha2("ids", 256).alias("ends_sha256"))
    rows = texts.join(long, _NODE, "left_semi").repartition(*_NODE).sortWithinPartitions(*_NODE, "chunk")
    return short.unionByName(map_arrow(rows.select(*_NODE, "ids"), _hash_ends, "depth long, a long, b long, ends_sha256 string"))


def trie(conversations: DataFrame, block: int = BLOCK, ids: int = IDS) -> DataFrame:
    """One row per node of the trie; see the module."""
    spark = conversations.sparkSession
    turns, each = rebuilt(conversations)
    blocks = store(spark, _blocks(turns, block), "blocks")
    zero = F.lit(0).cast("long")
    root = each.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")).filter("n > 0")
    root = root.select(*[zero.alias(c) for c in (*_NODE, "pa", "pb", "bytes")], "n", "conv_id")
    nodes = store(spark, _nodes(blocks, block).unionByName(root), "nodes")

    parent = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    children = (nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    nodes = nodes.join(parent, ["depth", "pa", "pb"], "left").join(children, _NODE, "left").select(
        *_NODE, "conv_id", "parent_conv_id", F.col("n").alias("n_convs"), F.coalesce("n_children", zero).alias("n_children"),
        ((F.col("n") - 1) * F.col("bytes")).alias("saved"))
    nodes = running(nodes, ["conv_id"], ["depth"], above=("sum", F.col("saved")))
    nodes = store(spark, nodes, "nodes-owned")

    # what each conversation owns, summed over the members of every node
    owned = nodes.groupBy("conv_id").agg(F.sum("saved").alias("own_saved"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).cast("long").alias("own_leaf"))
    both = [F.sum("own_saved").alias("all_saved"), F.sum("own_leaf").alias("n_leaves")]
    below = _distinct(blocks.join(owned, "conv_id"), *both)
    below = below.withColumnsRenamed({"all_saved": "own_saved", "n_leaves": "own_leaf"})
    sums = _inside(below, block, "own_saved", "own_leaf").groupBy(*_NODE).agg(*both)
    top = owned.agg(*both).filter("n_leaves > 0").select(*[zero.alias(c) for c in _NODE], "all_saved", "n_leaves")
    sums = sums.unionByName(top)

    last = blocks.filter(F.col("k") == F.floor((F.col("n_turns") - 1) / block)).select(
        F.col("n_turns").alias("depth"), F.col("a").bitwiseXOR(F.col("ha")).alias("a"), F.col("b").bitwiseXOR(F.col("hb")).alias("b"), "conv_id")
    empty = each.filter("n_turns = 0").select(*[zero.alias(c) for c in _NODE], "conv_id")
    ends = _ends(last.unionByName(empty), ids)
    nothing = hashlib.sha256().hexdigest()
    return (nodes.join(sums, _NODE, "left").join(ends, _NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("all_saved") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


def crc32_sql(text: str) -> str:
    """DuckDB text: unsigned CRC-32 of an ASCII text, bit by bit (a byte, then eight shifts)."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = f"lambda s, x: if(x >= 0, xor(s, x), xor(s >> 1, {0xEDB88320}::bigint * (s & 1)))"
    return f"xor(list_reduce({bits}, {step}, {0xFFFFFFFF}::bigint), {0xFFFFFFFF}::bigint)"


ORACLE = f"""
with turns as (
  select conv_id c, coalesce(role, '') role, coalesce(text, '') text, row_number() over (partition by conv_id order by turn nulls first,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) i from conversations where conv_id is not null),
each as (select c, c - c % {FAMILY} base, {crc32_sql("c::varchar")} % {HEADS} h, count(*) m from turns group by c),
lines as (
  select each.c, i d, role, text from each join turns on turns.c = each.base and i <= h
  union all
  select c, i - h + least(h, coalesce((select b.m from each b where b.c = e.base), 0)), role, text from turns join each e using (c) where i > h),
paths as (select c, d, list({{'r': role, 't': text}}) over (partition by c order by d) p, strlen(text) size from lines),
members as (select c, d, p, size from paths union all select c, 0, [], 0 from each),
nodes as (select d, p, min(c) c, count(*) n, any_value(size) size from members group by d, p),
whole as (select c, max_by(p, d) p from members group by c),
ends as (select p, sha256(string_agg(c::varchar, ',' order by c)) ends from whole group by p),
children as (select p[:d - 1] p, count(*) n from nodes where d > 0 group by all),
sums as (
  select u.p, sum((v.n - 1) * v.size) saved, count(*) filter (k.n is null) leaves
  from nodes u join nodes v on v.d >= u.d and v.p[:u.d] = u.p left join children k on k.p = v.p group by u.p)
select n.c::bigint conv_id, n.d::bigint as depth, u.c::bigint parent_conv_id, n.n::bigint n_convs, coalesce(k.n, 0)::bigint n_children,
  s.leaves::bigint n_leaves, s.saved::bigint saved_tokens, coalesce(e.ends, sha256('')) ends_sha256
from nodes n left join nodes u on u.d = n.d - 1 and u.p = n.p[:n.d - 1] left join children k on k.p = n.p
join sums s on s.p = n.p left join ends e on e.p = n.p
"""
