"""A Merkle manifest of a dataset: every third level is kept in a table, proofs regenerate the levels between.

Rows are leaves.  Per tree (here: language) the leaves ascend by id; runs of
eight nodes hash to their parent until one node, the subroot, is left.  The
subroots, ordered by tree, form a tree of their own up to the root.

A node of a kept level and the 512 nodes three levels below it are an aligned
subtree.  To extract proofs, the subtrees of a level are dealt to tasks
together with the siblings above each of them; a task hashes the two missing
levels again from the kept nodes, gives out the siblings and forgets the levels.
So the manifest stores 1/512 more nodes than leaves, and no task holds more than
eight subtrees whatever the size of a tree.
"""

from __future__ import annotations

from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.operators.ranking import ordered_positions
from saltmarsh.session import shared_folder, stored

FANOUT = 8
STRIDE = 3  # levels from one kept level to the next
SUBTREE = FANOUT**STRIDE
GROUP = 8 * SUBTREE  # nodes of a task group
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

PATH = "array<struct<place int, others array<string>>>"
ABOVE = f"tree string, position long, digest string, path {PATH}, subroot string, root string"
PROOF_SCHEMA = f"tree string, position long, doc_id long, leaf string, path {PATH}, subroot string, root string"
CHECK_SCHEMA = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
    "tree string, position long"
)


class Manifest(NamedTuple):
    """Kept levels of all trees, the subroots with their way to the root, and the root."""

    levels: list[DataFrame]  # tree, size (leaves of the tree), position, digest; level 0 also has doc_id and shown
    subroots: DataFrame  # tree, position 0, digest, path, subroot, root
    root: str | None


def field(value: Column) -> Column:
    """One field of a leaf: ``-`` for null, else its number of UTF-8 bytes, ``:`` and the value."""
    plain = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    return F.sha2(F.concat(*[field(text if c == "text" else F.col(c)) for c in FIELDS]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered(docs: DataFrame) -> Column:
    """The text of the copy that is held against the manifest: lower case where 3 divides the crc32 of the decimal id.

    A null id has no decimal form, so its row is left as it is.
    """
    return F.when(F.crc32(docs["doc_id"].cast("string")) % 3 == 0, lower_ascii(docs["text"])).otherwise(docs["text"])


def leaves(docs: DataFrame, shown: Column | None = None) -> DataFrame:
    """``tree``, ``doc_id``, ``leaf`` and ``shown``, the leaf of the row with the text ``shown`` where that is another one.

    The name of a tree is empty for a null language and else starts with ``=``,
    so it sorts null first, then by UTF-8 bytes.
    """
    shown = docs["text"] if shown is None else shown
    other = F.when(~shown.eqNullSafe(docs["text"]), leaf_digest(shown))
    tree = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    return docs.select(tree.alias("tree"), "doc_id", leaf_digest(F.col("text")).alias("leaf"), other.alias("shown"))


def _hash(nodes: list[bytes]) -> bytes:
    return sha256(b"".join(nodes)).hexdigest().encode()


def _interior(nodes: list[bytes], whole: bool) -> list[list[bytes]]:
    """The levels of an aligned subtree, lowest first: up to its single node if it is a whole tree, else ``STRIDE`` levels up."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= STRIDE:
        below = levels[-1]
        levels.append([_hash(below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return levels


def _subtrees(rows: pa.Table, level: int):
    """The aligned subtrees of a task group: number, columns of the nodes in order, and the levels hashed again from them."""
    rows = rows.sort_by("position")
    columns = {name: rows.column(name).to_pylist() for name in rows.column_names}
    nodes = -(-columns["size"][0] // FANOUT**(STRIDE * level))
    base = columns["position"][0] // SUBTREE
    for k in range(0, rows.num_rows, SUBTREE):
        part = {name: values[k:k + SUBTREE] for name, values in columns.items()}
        yield base + k // SUBTREE, part, _interior([d.encode() for d in part["digest"]], nodes <= SUBTREE)


def _grouped(rows: DataFrame, nodes: int):
    return rows.withColumn("_group", F.floor(F.col("position") / nodes)).groupBy("tree", "_group")


def _climb(rows: DataFrame, level: int) -> DataFrame:
    """The tops of the aligned subtrees of a kept level: the next kept level."""

    def tops(part: pa.Table) -> pa.Table:
        found = [(number, levels[-1][0].decode()) for number, _, levels in _subtrees(part, level)]
        return pa.table({
            "tree": [part.column("tree")[0].as_py()] * len(found), "size": [part.column("size")[0].as_py()] * len(found),
            "position": [n for n, _ in found], "digest": [d for _, d in found],
        }, schema=pa.schema([("tree", pa.string()), ("size", pa.int64()), ("position", pa.int64()), ("digest", pa.string())]))

    plain = rows.select("tree", "size", "position", "digest")
    return _grouped(plain, GROUP).applyInArrow(tops, "tree string, size long, position long, digest string")


def _unfinished(level: int) -> Column:
    """Nodes of trees that have more than one node on a kept level; every tree climbs one stride at least."""
    return F.lit(True) if level == 0 else F.col("size") > FANOUT**(STRIDE * level)


def _kept_levels(base: DataFrame) -> list[DataFrame]:
    """The kept levels of all trees over their leaves; only the largest size of a tree comes to the driver."""
    largest = base.agg(F.max("size")).first()[0] or 0
    levels = [base]
    while largest and (len(levels) == 1 or largest > FANOUT**(STRIDE * (len(levels) - 1))):
        at = len(levels) - 1
        levels.append(stored(_climb(levels[-1].where(_unfinished(at)), at), f"merkle-level-{STRIDE * (at + 1)}"))
    return levels


def _ways(levels: list[list[bytes]], i: int):
    """On each level of a subtree: place of the node's branch in its run, and the run."""
    for level in levels[:-1]:
        yield i % FANOUT, level[i // FANOUT * FANOUT:i // FANOUT * FANOUT + FANOUT]
        i //= FANOUT


def _with_above(rows: DataFrame, above: DataFrame, emit, schema: str) -> DataFrame:
    """``emit`` over the nodes of a kept level, dealt together with the tops of their subtrees."""
    return _grouped(rows, GROUP).cogroup(_grouped(above, GROUP // SUBTREE)).applyInArrow(emit, schema)


def _descend(rows: DataFrame, above: DataFrame, level: int, schema: str = ABOVE) -> DataFrame:
    """The way to the root of every node of a kept level, from the ways of the tops of their subtrees."""
    extra = [f.name for f in rows.schema.fields if f.name in ("doc_id",)]

    def emit(part: pa.Table, tops: pa.Table) -> pa.Table:
        upper = {r["position"]: r for r in tops.to_pylist()}
        found: dict[str, list] = {n: [] for n in ["tree", "position", *extra, "digest", "path", "subroot", "root"]}
        for number, columns, levels in (_subtrees(part, level) if part.num_rows else ()):
            top = upper.get(number)
            if top is None:
                continue  # not asked for
            for i in range(len(columns["digest"])):
                own = [{"place": p, "others": [d.decode() for k, d in enumerate(run) if k != p]} for p, run in _ways(levels, i)]
                found["path"].append(own + top["path"])
            for name in ["tree", "position", *extra, "digest"]:
                found[name] += columns[name]
            for name in ("subroot", "root"):
                found[name] += [top[name]] * len(columns["digest"])
        kinds = {"position": pa.int64(), "doc_id": pa.int64(),
                 "path": pa.list_(pa.struct([("place", pa.int32()), ("others", pa.list_(pa.string()))]))}
        return pa.table({("leaf" if n == "digest" and extra else n): pa.array(v, kinds.get(n, pa.string())) for n, v in found.items()})

    return _with_above(rows, above, emit, schema)


def write_manifest(rows: DataFrame) -> Manifest:
    """Sort the leaves of ``leaves`` into their trees and keep every third level, each as a table in the shared folder.

    Leaves ascend by id, null ids first; rows with the same id go by their
    digest.  No rows give no trees and no root.
    """
    rows = stored(rows, "merkle-leaves")
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("shown").asc_nulls_first()]
    placed = ordered_positions(rows, ["tree"], order, "position", "size").withColumnRenamed("leaf", "digest")
    levels = _kept_levels(stored(placed, "merkle-level-0"))
    tops = [
        frame.where((F.col("position") == 0) & ~_unfinished(k) & (F.lit(k == 1) | (F.col("size") > FANOUT**(STRIDE * (k - 1)))))
        .select(F.col("tree").alias("branch"), F.col("digest"), F.lit("").alias("tree"))
        for k, frame in enumerate(levels) if k
    ]
    if not tops:
        return Manifest(levels, rows.sparkSession.createDataFrame([], ABOVE), None)
    every = tops[0]
    for frame in tops[1:]:
        every = every.unionByName(frame)
    order = [F.col("branch").asc()]
    crown = stored(ordered_positions(stored(every, "merkle-subroots"), ["tree"], order, "position", "size"), "merkle-crown")
    kept = _kept_levels(crown)
    root = kept[-1].where("position = 0").select("digest").first()[0]
    start = F.expr(f"CAST(array() AS {PATH})")
    above = kept[-1].select("tree", "position", "digest", start.alias("path"), F.lit("").alias("subroot"), F.lit(root).alias("root"))
    for k in reversed(range(len(kept) - 1)):
        above = _descend(kept[k], above, k)
    named = above.join(crown.select("position", "branch"), "position")
    subroots = named.select(F.col("branch").alias("tree"), F.lit(0).cast("long").alias("position"), "digest", "path",
                            F.col("digest").alias("subroot"), "root")
    return Manifest(levels, stored(subroots, "merkle-ways"), root)


def _above_leaves(manifest: Manifest) -> DataFrame:
    """The ways of all nodes of the lowest kept level above the leaves, level by level from the subroots down."""
    levels, subroots = manifest.levels, manifest.subroots
    sizes = [frame.where("position = 0").select("tree", "size") for frame in levels]
    above = None
    for k in reversed(range(1, len(levels))):
        # trees that end on this level start here
        ending = sizes[k].where(~_unfinished(k) & (F.lit(k == 1) | (F.col("size") > FANOUT**(STRIDE * (k - 1)))))
        start = subroots.join(ending.select("tree"), "tree", "left_semi")
        if above is None:
            above = start
        else:
            above = start.unionByName(_descend(levels[k].where(_unfinished(k)), above, k))
    return above


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Proofs of all leaves, or of those at the (``tree``, ``position``) of ``wanted``.

    ``path`` has, level by level up to the root, the place in the run of eight
    and the digests of the others in that run, left to right.  Only subtrees
    with wanted leaves are hashed again.
    """
    if manifest.root is None:
        return manifest.subroots.sparkSession.createDataFrame([], PROOF_SCHEMA)
    rows, above = manifest.levels[0], _above_leaves(manifest)
    if wanted is None:
        return _descend(rows, above, 0, PROOF_SCHEMA)
    tops = wanted.select("tree", F.floor(F.col("position") / SUBTREE).alias("position")).distinct()
    above = above.join(tops, ["tree", "position"], "left_semi")
    groups = tops.select("tree", F.floor(F.col("position") / (GROUP // SUBTREE)).alias("_g")).distinct()
    rows = rows.withColumn("_g", F.floor(F.col("position") / GROUP)).join(groups, ["tree", "_g"], "left_semi").drop("_g")
    found = _descend(rows, above, 0, PROOF_SCHEMA)
    return found.join(wanted.select("tree", "position").distinct(), ["tree", "position"], "left_semi")


def fold(leaf: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and the siblings of a proof lead to."""
    node = leaf.encode()
    for place, others in path:
        run = [o.encode() for o in others]
        node = _hash(run[:place] + [node] + run[place:])
    return node.decode()


def check(manifest: Manifest) -> DataFrame:
    """Extract the proof of every leaf and fold the shown leaf with its siblings; only digests of the proofs are given out.

    ``proof_sha256`` is the hash of all siblings, ``folded_root`` what the shown
    leaf leads to, ``verified`` whether that is the root.
    """
    if manifest.root is None:
        return manifest.subroots.sparkSession.createDataFrame([], CHECK_SCHEMA)

    def emit(part: pa.Table, tops: pa.Table) -> pa.Table:
        upper = {r["position"]: r for r in tops.to_pylist()}
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "tree", "position"]
        found: dict[str, list] = {n: [] for n in names}
        for number, columns, levels in (_subtrees(part, 0) if part.num_rows else ()):
            top = upper[number]
            high = [(b"".join(o.encode() for o in w["others"][:w["place"]]), b"".join(o.encode() for o in w["others"][w["place"]:]))
                    for w in top["path"]]
            siblings_above = b"".join(left + right for left, right in high)
            for i, shown in enumerate(columns["shown"]):
                node = shown.encode() if shown else levels[0][i]
                siblings = sha256()
                for place, run in _ways(levels, i):
                    left, right = b"".join(run[:place]), b"".join(run[place + 1:])
                    siblings.update(left + right)
                    node = sha256(left + node + right).hexdigest().encode()
                siblings.update(siblings_above)
                for left, right in high:
                    node = sha256(left + node + right).hexdigest().encode()
                found["proof_sha256"].append(siblings.hexdigest())
                found["folded_root"].append(node.decode())
            n = len(columns["shown"])
            found["leaf"] += columns["digest"]
            found["subroot"] += [top["subroot"]] * n
            found["root"] += [top["root"]] * n
            for name in ("doc_id", "tree", "position"):
                found[name] += columns[name]
        found["verified"] = [a == b for a, b in zip(found["folded_root"], found["root"])]
        kinds = {"doc_id": pa.int64(), "position": pa.int64(), "verified": pa.bool_()}
        return pa.table({n: pa.array(v, kinds.get(n, pa.string())) for n, v in found.items()})

    return _with_above(manifest.levels[0], _above_leaves(manifest), emit, CHECK_SCHEMA)


def verify_documents(docs: DataFrame) -> DataFrame:
    """Write the manifest of ``docs`` and hold the copy with ``tampered`` texts against it, row by row.

    Nulls in any field count as ``-``; an empty text has zero bytes and is not
    null.  Repeated rows are leaves of their own.  An empty table gives no
    rows; columns other than ``FIELDS`` are not read.
    """
    plain = docs.select(*FIELDS)
    manifest = write_manifest(leaves(plain, tampered(plain)))
    return check(manifest).drop("tree", "position")
