"""Merkle manifest of a dataset, one tree per language, by butterfly exchange.

Leaves of a language are numbered by doc_id. A block is the ``FANOUT ** LEVELS`` aligned leaves of one subtree and
is held as one row. A block hashes its own levels alone. Then, round by round, aligned groups of ``FANOUT`` blocks
swap their subtree roots: in round r the partners of a block agree in all places of their number (to the base
``FANOUT``) but place r. Every partner hashes the common ancestor itself and keeps the others' roots as its proof
of that level, so after the last round each block holds all upper proofs and the root, and nothing is handed down.
The last subtree of a level may have fewer blocks than the others; each of them then also answers for the numbers
that are missing. The subroots of the languages are exchanged the same way.

Only digests leave the scan, texts are never shuffled. A round moves one digest per block and partner (a few
thousandths of the leaves), a group has at most ``FANOUT`` rows, and a language with most of the rows has as many
more blocks, so no task gets more than a few blocks. A node that changes is checked by folding: the original
siblings around a leaf computed again.

Defined results: null values are ``-``, an empty text is ``0:``; null is a language of its own, before all others;
null doc_id comes first; rows of equal language and doc_id are ordered by their leaf; a tree of one node is its
own root, with an empty proof; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, store, table
from .op11_conversation_trie import crc32_sql
from .slices import running

#: Children of a node, and levels that a block hashes alone.
FANOUT, LEVELS = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_of(text: Column) -> Column:
    """SHA-256 (32 bytes) of a row whose text is ``text``."""
    def field(name: str) -> Column:
        value = text if name == "text" else F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*map(field, FIELDS)), 256))


def _h(*parts: bytes) -> bytes:
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def _levels(leaves: list[bytes], total: int, levels: int, fanout: int) -> list[list[bytes]]:
    """The nodes of a block by level, as long as its tree (of ``total`` leaves) has more than one node."""
    out = [leaves]
    while total > 1 and len(out) <= levels:
        nodes = out[-1]
        out.append([_h(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)])
        total = -(-total // fanout)
    return out


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):  # a block at a time as Python objects
        yield batch.slice(i, 1).to_pylist()[0]


def _roots(levels: int, fanout: int):
    schema = pa.schema([("lang", pa.string()), ("p", pa.int64()), ("total", pa.int64()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"lang": r["lang"], "p": r["p"], "total": r["total"], "digest": _levels(r["leaf"], r["total"], levels, fanout)[-1][0]}
                    for r in _rows(batch)]
            yield pa.RecordBatch.from_pylist(rows, schema)
    return run


_STEP = "struct<left:array<binary>,right:array<binary>>"


def butterfly(nodes: DataFrame, most: int, fanout: int = FANOUT) -> DataFrame:
    """``tree, p, root, steps`` of nodes (tree, p, n, digest), p counting the n nodes of a tree from 0.

    steps: for every level the siblings to the left and right, from below. ``most``: the largest n.
    """
    spark = nodes.sparkSession
    state = nodes.select("tree", "p", "n", "digest", F.array().cast(f"array<{_STEP}>").alias("steps"))
    width = 1
    while width < most:
        here = F.expr(f"p div {width}")
        low = F.col("p") % width
        there = F.least(F.lit(width).cast("long"), F.col("n") - here * width)  # blocks of this subtree
        told = state.filter(F.col("n") > width).select(
            "tree", (F.expr(f"p div {width * fanout}")).alias("group"), here.alias("child"), "digest",
            F.explode(F.sequence(low, F.lit(width - 1).cast("long"), there)).alias("low"))
        heard = told.groupBy("tree", "group", "low").agg(F.sort_array(F.collect_list(F.struct("child", "digest"))).alias("run"))
        heard = heard.withColumnsRenamed({"tree": "_tree", "group": "_group", "low": "_low"})
        mine = state.join(heard, state["tree"].eqNullSafe(heard["_tree"]) & (F.expr(f"p div {width * fanout}") == F.col("_group")) & (low == F.col("_low")), "left")
        run = F.col("run")
        digest = F.unhex(F.sha2(F.array_join(F.transform(run, lambda x: F.lower(F.hex(x["digest"]))), ""), 256))
        side = lambda keep: F.transform(F.filter(run, keep), lambda x: x["digest"])
        step = F.struct(side(lambda x: x["child"] < here).alias("left"), side(lambda x: x["child"] > here).alias("right"))
        met = run.isNotNull()
        state = store(spark, mine.select("tree", "p", "n", F.when(met, digest).otherwise(F.col("digest")).alias("digest"),
                                         F.when(met, F.concat("steps", F.array(step))).otherwise(F.col("steps")).alias("steps")), "butterfly")
        width *= fanout
    return state.select("tree", "p", F.col("digest").alias("root"), "steps")


_PROVED = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
                     ("folded_root", pa.string()), ("lang", pa.string())])


def _prove(levels: int, fanout: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                inner = _levels(r["leaf"], r["total"], levels, fanout)
                upper = [("".join(x.hex() for x in s["left"]), "".join(x.hex() for x in s["right"])) for s in r["steps"] + r["lang_steps"]]
                above = "".join(a + b for a, b in upper).encode()
                hexes = [[x.hex() for x in nodes] for nodes in inner]
                root, subroot = r["root"].hex(), r["subroot"].hex()
                out = []
                for i, (doc_id, changed) in enumerate(zip(r["doc_id"], r["changed"])):
                    at, proof, folded = i, hashlib.sha256(), changed.hex()
                    for nodes in hexes[:-1]:
                        lo = at // fanout * fanout
                        left, right = "".join(nodes[lo:at]), "".join(nodes[at + 1:lo + fanout])
                        proof.update((left + right).encode())
                        folded = hashlib.sha256((left + folded + right).encode()).hexdigest()
                        at //= fanout
                    proof.update(above)
                    for left, right in upper:
                        folded = hashlib.sha256((left + folded + right).encode()).hexdigest()
                    out.append((doc_id, hexes[0][i], subroot, root, proof.hexdigest(), folded, r["lang"]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PROVED)], schema=_PROVED)
    return run


def manifest(docs: DataFrame, tampered: Column | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``.

    ``tampered``: the text to fold from instead of the original, null where the row is left as it is.
    """
    spark = docs.sparkSession
    text = F.col("text")
    other = F.coalesce(tampered, text) if tampered is not None else text
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", leaf_of(text).alias("leaf"), leaf_of(other).alias("changed"))
    numbered = running(ids, ["lang"], ["doc_id", "leaf"], i=("sum", F.lit(1).cast("long")))
    size = fanout ** levels
    blocks = numbered.groupBy("lang", F.expr(f"i div {size}").alias("p")).agg(
        F.sort_array(F.collect_list(F.struct("i", "doc_id", "leaf", "changed"))).alias("x"))
    blocks = store(spark, blocks.select("lang", "p", F.col("x.doc_id").alias("doc_id"), F.col("x.leaf").alias("leaf"), F.col("x.changed").alias("changed")), "merkle-blocks")

    totals = blocks.groupBy("lang").agg(F.sum(F.size("leaf")).alias("total"))
    totals = running(totals, [], ["lang"], lang_no=("sum", F.lit(1).cast("long")))
    totals = store(spark, totals.withColumn("n", F.ceil(F.col("total") / size).cast("long")), "merkle-langs")
    most = totals.agg(F.max("n"), F.count(F.lit(1))).first()
    by_lang = totals.select(F.col("lang").alias("_lang"), "total", "n", "lang_no")
    sized = blocks.join(by_lang, blocks["lang"].eqNullSafe(by_lang["_lang"])).drop("_lang")
    roots = map_arrow(sized.select("lang", "p", "total", "leaf"), _roots(levels, fanout), "lang string, p long, total long, digest binary")
    roots = store(spark, roots.withColumn("n", F.ceil(F.col("total") / size).cast("long")).withColumnRenamed("lang", "tree"), "merkle-roots")

    upper = butterfly(roots, most[0] or 0, fanout).withColumnsRenamed({"tree": "_lang", "p": "_p", "root": "subroot"})
    tops = upper.filter("_p = 0").select(F.col("_lang").alias("_top"), "subroot")
    tops = tops.join(by_lang, tops["_top"].eqNullSafe(by_lang["_lang"]))
    tops = butterfly(tops.select(F.lit(0).alias("tree"), F.col("lang_no").alias("p"), F.lit(most[1]).cast("long").alias("n"), F.col("subroot").alias("digest")), most[1], fanout)
    tops = tops.select(F.col("p").alias("lang_no"), "root", F.col("steps").alias("lang_steps"))
    whole = sized.join(upper, sized["lang"].eqNullSafe(upper["_lang"]) & (F.col("p") == F.col("_p"))).join(tops, "lang_no")
    proved = map_arrow(whole.select("lang", "total", "doc_id", "leaf", "changed", "subroot", "root", "steps", "lang_steps"), _prove(levels, fanout),
                       "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, lang string")
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    changed = F.when(hit, F.translate("text", UPPER, LOWER))
    return manifest(table(spark, sf_dir, "documents"), changed).drop("lang")


def _oracle(levels: int = 7) -> str:
    """DuckDB text for trees of at most ``FANOUT ** levels`` leaves: one step for every level."""
    def field(name: str, text: str) -> str:
        value = text if name == "text" else f"{name}::varchar"
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(f, text) for f in FIELDS)})"

    tampered = f"if({crc32_sql('doc_id::varchar')} % 3 = 0, translate(text, '{UPPER}', '{LOWER}'), text)"
    ctes = [f"rows as (select doc_id, lang, {leaf('text')} leaf, {leaf(f'coalesce({tampered}, text)')} changed from documents)",
            "n0 as (select lang tree, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 i, leaf h, doc_id, changed, count(*) over (partition by lang) total from rows)"]

    def climb(name: str, first: str) -> list[str]:
        out = [f"{name}0 as ({first})"]
        for k in range(levels):
            run = f"partition by tree, i // {FANOUT} order by i rows between"
            out.append(f"{name}{k}s as (select *, coalesce(string_agg(h, '') over ({run} unbounded preceding and 1 preceding), '') l, "
                       f"coalesce(string_agg(h, '') over ({run} 1 following and unbounded following), '') r from {name}{k})")
            out.append(f"{name}{k + 1} as (select tree, i // {FANOUT} i, if(max(total) > 1, sha256(string_agg(h, '' order by i)), max(h)) h, "
                       f"ceil(max(total) / {FANOUT})::bigint total from {name}{k} group by tree, i // {FANOUT})")
        return out

    ctes += climb("t", "select tree, i, h, total from n0")
    ctes += climb("u", f"select 0 tree, row_number() over (order by tree nulls first) - 1 i, h, count(*) over () total, tree lang from t{levels}")

    def path(doc: str, name: str, index: str) -> tuple[list[str], str]:
        joins, proof = [], []
        for k in range(levels):
            j = f"{name}{k}j"
            joins.append(f"join {name}{k}s {j} on {j}.tree is not distinct from {doc} and {j}.i = {index} // {FANOUT ** k}")
            proof.append(f"{j}.l || {j}.r")
        return joins, " || ".join(proof)

    low, low_proof = path("n0.tree", "t", "n0.i")
    high, high_proof = path("0", "u", "u.i")
    ctes.append(f"p0 as (select n0.doc_id, n0.h leaf, t{levels}.h subroot, u{levels}.h root, sha256({low_proof} || {high_proof}) proof_sha256, n0.changed f, "
                + ", ".join(f"{n}{k}j.total {n}{k}n, {n}{k}j.l {n}{k}l, {n}{k}j.r {n}{k}r" for n in "tu" for k in range(levels))
                + f" from n0 join t{levels} on t{levels}.tree is not distinct from n0.tree join u0 u on u.lang is not distinct from n0.tree cross join u{levels} "
                + " ".join(low + high) + ")")
    step = 0
    for n in "tu":
        for k in range(levels):
            ctes.append(f"p{step + 1} as (select * replace (if({n}{k}n > 1, sha256({n}{k}l || f || {n}{k}r), f) as f) from p{step})")
            step += 1
    return ("with " + ",\n".join(ctes) + "\nselect doc_id, leaf, subroot, root, proof_sha256, f folded_root, f = root verified "
            f"from p{step}")


ORACLE = _oracle()
