"""Similarity join of word-shingle sets with PartEnum signatures, and the components of its links.

Two sets with Jaccard similarity of at least 3/4 and sizes a <= b differ in at
most (a + b) / 7 elements, and b <= 4a / 3.  Sizes fall into bands of a factor
two; a set signs in its own band, and in the next one if a partner may be
there.  In a band the domain of shingles is cut into parts.  Each differing
element spoils one part at most, so at most (a + b) / 7 parts differ.  The
enumerated subset of parts of a set is its first ``size / 3 + 1`` non-empty
parts in domain order: before the first part on which two similar sets agree
either has only parts that differ, so both enumerate that part, and the hash
of what it holds is their common signature.  The few sets with too few
non-empty parts sign with each shingle as well, so no link is lost.

Equal sets are one set throughout, named by a 64-bit hash of the set; two given
sets share a name or a shingle hash with a chance of about 2**-64.  Sets with a common signature are
compared exactly, in blocks of bounded size: first inside the block that a set
shares with the sets most like it.  Links inside one component change nothing,
so after that only the groups of a signature with sets that are still apart are
looked at: parity sketches, about one bit an element, bound the difference of
two sets from below, and only the texts of pairs within the bound are compared.
No pair of sets is written out unless it is linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.common import mixed, slices, texts, unused, windows, word_hashes
from saltmarsh.llm.components import components
from saltmarsh.session import stored

SIZE = 5
BLOCK = 96
SAMPLE_DOCS = 16_384
FREQUENT = 4
BITS = 1 << 23
OPEN_ROWS = 50_000
GROUP = 2048
TASK = 512
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_sets(values: list[str | None], size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and their number before each text.

    A text with fewer words than ``size`` has its whole sequence as one shingle, one without words has none.
    """
    _, before, words, _, _ = word_hashes(values, lower=True)
    owner = np.repeat(np.arange(len(values)), np.diff(before))
    found = windows(words, size)
    whole = owner[:len(found)] == owner[size - 1:] if len(found) else np.zeros(0, bool)
    found, owner = found[whole], owner[:len(found)][whole]
    counts = np.diff(before)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = [windows(words[before[k]:before[k + 1]], int(counts[k]))[0] + np.uint64(counts[k]) for k in short]
        found, owner = np.concatenate([found, np.array(extra, np.uint64)]), np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(values) + 1))


def _sum_by(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.uint64)


def set_name(found: np.ndarray) -> int:
    """64-bit name of one set, as a signed number."""
    return int(mixed(np.array([mixed(found).sum(dtype=np.uint64) + np.uint64(len(found))], np.uint64)).view(np.int64)[0])


def sketch(found: np.ndarray) -> bytes:
    """One bit per cell of the domain: whether the set has an odd number of elements there.

    Each element in which two sets differ flips one bit, so they differ in as many bits at most.  The
    number of cells is a power of two above the set's size, and 64 at least; halves fold by exclusive or.
    """
    bits = max(64, 1 << len(found).bit_length())
    cell = (mixed(found) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(cell, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def parts_of(band: int) -> int:
    """Parts of the domain in the band of sizes 2**(band-1) to 2**band - 1: one per two elements, more for small sets."""
    return (1 << band) * (8 if band <= 4 else 2) if band <= 7 else 1 << (band - 1)


def signatures(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Signatures of one set, given as sorted hashes; ``frequent`` are the sorted hashes that come last in the domain."""
    n = len(found)
    out, unsafe = [], False
    if len(frequent):
        late = frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] == found
        found = np.concatenate([found[~late], found[late]])
        late = np.sort(late)
    else:
        late = np.zeros(n, bool)
    content = mixed(found ^ np.uint64(0x5851F42D4C957F2D))
    high = found >> np.uint64(32)
    band = n.bit_length()
    for level in [band] + ([band + 1] if 4 * n // 3 >= 1 << band else []):
        m = np.uint64(parts_of(level))
        part = ((high * m) >> np.uint64(32)) + m * late
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        unsafe |= len(starts) <= n // 3
        out.append(mixed(_sum_by(content, starts)[:n // 3 + 1] + np.uint64(level)))
    if unsafe:
        out.append(mixed(content + np.uint64(1 << 40)))
    return np.concatenate(out)


def frequent_shingles(plain: DataFrame) -> np.ndarray:
    """Sorted hashes of the shingles of at least ``FREQUENT`` different sets among about ``SAMPLE_DOCS`` documents.

    A shingle that many documents of a large corpus share is in many of the
    sample; so many at most come back as the sample has shingles, over ``FREQUENT``.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, size=1 << 19):
            found, before = shingle_sets(part.column("text").to_pylist())
            names = [set_name(found[i:j]) if j > i else 0 for i, j in zip(before, before[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(np.repeat(np.array(names, np.int64), np.diff(before)))], names=["shingle", "name"])

    share = max(1, plain.count() // SAMPLE_DOCS)
    some = plain.where(F.pmod(F.xxhash64("_row"), F.lit(share)) == 0).mapInArrow(sets, "shingle long, name long")
    rows = some.distinct().groupBy("shingle").count().where(F.col("count") >= FREQUENT).select("shingle").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def _signer(frequent):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = frequent.value
        for part in slices(batches, size=1 << 19):
            found, before = shingle_sets(part.column("text").to_pylist())
            names, signed = [], []
            for i, j in zip(before, before[1:]):
                if j > i:
                    one = signatures(found[i:j], late)
                    names.append(np.full(len(one), set_name(found[i:j]), np.int64))
                    signed.append(one)
            if names:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(signed).view(np.int64)), pa.array(np.concatenate(names))], names=["signature", "name"])

    return sign


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, size=1 << 19):
        found, before = shingle_sets(part.column("text").to_pylist())
        sets = [found[i:j] for i, j in zip(before, before[1:])]
        yield pa.RecordBatch.from_arrays(
            [part.column("_row"), part.column("doc_id"), pa.array([set_name(x) if len(x) else None for x in sets], pa.int64()), pa.array(np.diff(before), pa.int64()),
             pa.array([sketch(x) if len(x) else None for x in sets], pa.binary())], names=["_row", "doc_id", "name", "n", "sketch"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by signature and name: those whose signature has two or more names, with the least name as leader.

    The last group of a batch stays open; once a group has more than ``OPEN_ROWS`` rows,
    they go out, its leader among them, and only the leader is remembered.  No row comes out twice.
    """
    empty = np.zeros(0, np.int64)
    sig, name, leader = empty, empty, None  # open rows of one signature; its leader if rows of it are already out
    last = None

    def rows(s: np.ndarray, n: np.ndarray, first: int | None) -> pa.RecordBatch | None:
        if not len(s):
            return None
        starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(s)]]))
        lead = n[starts]
        if first is not None:
            lead[0], sizes[0] = first, sizes[0] + 1
        keep = np.repeat(sizes > 1, np.diff(np.concatenate([starts, [len(s)]])))
        lead = np.repeat(lead, np.diff(np.concatenate([starts, [len(s)]])))
        return pa.RecordBatch.from_arrays([pa.array(s[keep]), pa.array(n[keep]), pa.array(lead[keep])], names=["signature", "name", "leader"])

    for batch in batches:
        s, n = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False), np.int64) for i in range(2))
        if not len(s):
            continue
        new = np.concatenate([[last != (s[0], n[0])], (s[1:] != s[:-1]) | (n[1:] != n[:-1])])
        last = (s[-1], n[-1])
        sig, name = np.concatenate([sig, s[new]]), np.concatenate([name, n[new]])
        current = s[-1]
        if leader is not None and len(sig) and sig[0] != led:
            leader = None  # the group whose rows are out has ended
        cut = np.searchsorted(sig, current) if len(sig) and sig[-1] == current else len(sig)
        if len(sig) - cut > OPEN_ROWS:
            out = rows(sig, name, leader)
            leader, led = leader if leader is not None and cut == 0 else int(name[cut]), current
            sig, name = empty, empty
        else:
            out = rows(sig[:cut], name[:cut], leader if cut else None)
            if cut:
                leader = None
            sig, name = sig[cut:], name[cut:]
        if out is not None and out.num_rows:
            yield out
    out = rows(sig, name, leader)
    if out is not None and out.num_rows:
        yield out


def similar(common: int, a: int, b: int) -> bool:
    return 100 * common >= 75 * (a + b - common)


def _block_links(table: pa.Table) -> pa.Table:
    """Links between the sets of two blocks (or inside one) that join different components, as far as they are not implied."""
    sets, rows = [], []
    for part in slices(iter(table.to_batches()), size=1 << 19):
        found, before = shingle_sets(part.column("text").to_pylist())
        for name, root, i, j in zip(part.column("name").to_pylist(), part.column("root").to_pylist(), before, before[1:]):
            if j > i and set_name(found[i:j]) == name:
                sets.append(found[i:j].copy())
                rows.append((name, root))
    if not sets:
        return LINKS.empty_table()
    names, root = np.array(rows, np.int64).T
    sizes = np.array([len(s) for s in sets])
    _, which, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    column = np.full(len(count), -1)
    column[shared] = np.arange(len(shared))
    owner = np.repeat(np.arange(len(sets)), sizes)
    column = column[which]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, len(shared), 1024):  # counts of common elements, by columns of the incidence matrix
        some = (column >= low) & (column < low + 1024)
        part = np.zeros((len(sets), min(1024, len(shared) - low)), np.float32)
        part[owner[some], column[some] - low] = 1
        common += part @ part.T
    linked = 100 * common >= 75 * (sizes[:, None] + sizes[None, :] - common)
    linked &= root[:, None] != root[None, :]
    united, out = {}, []

    def find(x: int) -> int:
        while united.get(x, x) != x:
            x = united[x]
        return x

    for i, j in zip(*np.nonzero(np.triu(linked))):
        p, q = find(root[i]), find(root[j])
        if p != q:
            united[max(p, q)] = min(p, q)
            out.append((names[i], names[j]))
    a, b = np.array(out, np.int64).reshape(-1, 2).T
    return pa.table([pa.array(a), pa.array(b)], schema=LINKS)


def _with_root(rows: DataFrame, roots: DataFrame, key: str, root: str) -> DataFrame:
    known = roots.select(F.col("node").alias(key), F.col("root").alias(root))
    return rows.join(known, key, "left").withColumn(root, F.coalesce(root, key))


def _blocks(groups: DataFrame) -> DataFrame:
    """``name``, ``block`` and ``home`` of every set that has a signature in common with another.

    The home of a set is the leader it shares most signatures with.  Sets tied
    by leaders form a family; a family is dealt by home to blocks of about
    ``BLOCK`` sets, and a larger home by name.  Each block also gets the leaders
    of its sets (rows with ``extra``).
    """
    pairs = stored(
        groups.where("name <> leader").groupBy(F.col("leader").alias("a"), F.col("name").alias("b")).agg(F.count("*").alias("shared")),
        "leader-pairs")
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("home")).withColumnRenamed("b", "name")
    names = pairs.select(F.col("a").alias("name")).unionByName(pairs.select(F.col("b").alias("name"))).distinct()
    placed = _with_root(names, components(pairs), "name", "family").join(best, "name", "left")
    placed = stored(placed.withColumn("home", F.coalesce("home", "name")), "families")
    homes = placed.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).alias("by_name"))
    families = placed.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("by_home"))
    block = F.when(F.col("by_name") > 1, F.xxhash64("home", F.pmod(F.xxhash64("name"), "by_name"))).otherwise(
        F.xxhash64("family", F.pmod(F.xxhash64("home"), "by_home")))
    dealt = placed.join(homes, "home").join(families, "family").select("name", block.alias("block"), "home")
    return stored(dealt, "blocks")


def _only(plain: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of ``plain`` whose row may be in ``wanted``, by a bitmap of ``BITS`` bits of hashed row numbers: a fixed size at any scale."""
    key = F.xxhash64("_row").bitwiseAND(BITS - 1)
    words = wanted.select(key.alias("key")).selectExpr("shiftright(key, 6) AS word", "shiftleft(1L, CAST(key & 63 AS INT)) AS bit")
    bitmap = np.zeros(BITS // 64, np.int64)
    for word, bits in words.groupBy("word").agg(F.bit_or("bit")).collect():  # at most BITS / 64 rows
        bitmap[word] = bits
    bitmap = plain.sparkSession.sparkContext.broadcast(bitmap)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = np.asarray(batch.column("key"), np.int64)
            found = (bitmap.value[at >> 6] >> (at & 63)) & 1 == 1
            yield batch.select(["_row", "text"]).filter(pa.array(found))

    return plain.select("_row", "text", key.alias("key")).mapInArrow(keep, "_row long, text string")


def _compared(plain: DataFrame, wanted: DataFrame) -> DataFrame:
    """Links inside each task of ``wanted`` (``_row``, ``name``, ``root``, ``task``); the sets are made in the task, as texts move cheaper."""
    rows = _only(plain, wanted).join(wanted, "_row").select("text", "name", "root", "task")
    return rows.groupBy("task").applyInArrow(_block_links, "a long, b long")


def near_pairs(root: np.ndarray, size: np.ndarray, sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets with different roots that may be similar: their sketches differ in at most a seventh of both sizes."""
    width = np.array([len(x) for x in sketches])
    first, second = [], []
    for w in np.unique(width):
        a, wide = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)
        x = np.frombuffer(b"".join(sketches[i] for i in a), np.uint64).reshape(len(a), w // 8)
        y = np.frombuffer(b"".join(sketches[i] for i in wide), np.uint64).reshape(len(wide), 2, w // 8)
        y = np.concatenate([x, y[:, 0] ^ y[:, 1]]) if len(wide) else x
        b = np.concatenate([a, wide])
        step = max(1, (1 << 20) // y.size)
        for low in range(0, len(a), step):
            some = a[low:low + step]
            apart = np.bitwise_count(x[low:low + step, None] ^ y[None]).sum(axis=2, dtype=np.int64)
            near = (7 * apart <= size[some][:, None] + size[b][None]) & (root[some][:, None] != root[b][None])
            i, j = np.nonzero(near)
            first.append(some[i])
            second.append(b[j])
    return np.concatenate(first), np.concatenate(second)


def _pieces(names: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
    """The sets of each connected piece of the pairs, as positions."""
    label = np.arange(len(names))
    while True:
        before = label.copy()
        np.minimum.at(label, first, before[second])
        np.minimum.at(label, second, before[first])
        label = label[label]
        if (label == before).all():
            break
    member = np.unique(np.concatenate([first, second]))
    member = member[np.argsort(label[member], kind="stable")]
    return np.split(member, np.flatnonzero(np.diff(label[member])) + 1) if len(member) else []


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by task: the sets that may be similar to one of another component, with their connected piece as task.

    A piece is named by its members, so the same piece found by several signatures is one; ``low`` is its least name.
    """

    def look(rows: pa.Table, starts: np.ndarray, end: int) -> pa.RecordBatch:
        names, root, size = (rows.column(c).to_numpy() for c in ("name", "root", "n"))
        sketches = rows.column("sketch").to_pylist()
        out, tasks, low = ([np.zeros(0, np.int64)] for _ in range(3))
        for i, j in zip(starts, [*starts[1:], end]):
            if (root[i:j] == root[i]).all():
                continue
            for piece in _pieces(names[i:j], *near_pairs(root[i:j], size[i:j], sketches[i:j])):
                out.append(piece + i)
                low.append(np.full(len(piece), names[piece + i].min()))
                tasks.append(np.full(len(piece), set_name(np.sort(names[piece + i]).view(np.uint64)), np.int64))
        at = np.concatenate(out)
        return pa.RecordBatch.from_arrays(
            [pa.array(names[at]), pa.array(root[at]), pa.array(np.concatenate(tasks)), pa.array(np.concatenate(low))],
            names=["name", "root", "task", "low"])

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        task = rows.column("task").to_numpy()
        if not len(task):
            continue
        starts = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1]]))
        held = rows.slice(starts[-1])
        if len(starts) > 1:
            yield look(rows, starts[:-1], starts[-1])
    if held is not None and held.num_rows:
        yield look(held, np.array([0]), held.num_rows)


def _apart(groups: DataFrame, sketches: DataFrame, roots: DataFrame, partitions: int) -> DataFrame:
    """Tasks (``name``, ``root``, ``task``) of sets in different components that share a signature and may be similar.

    Signatures with the same members are looked at once.  A group of more than ``GROUP`` sets is dealt to
    parts by name, and every two of its parts meet.  Pieces with the same least set overlap in most of their sets
    and are one task, unless that would have more than ``TASK`` sets: then each piece is its own.
    """
    placed = _with_root(groups.select("signature", "name"), roots, "name", "root")
    span = placed.groupBy("signature").agg(
        F.min("root").alias("a"), F.max("root").alias("z"), F.count("*").alias("m"), F.bit_xor(F.xxhash64("name")).alias("members"))
    once = span.where("a < z").groupBy("members", "m").agg(F.min("signature").alias("signature"))
    rows = placed.join(once.select("signature", F.ceil(F.col("m") / GROUP).alias("parts")), "signature")
    own = F.pmod(F.xxhash64("name"), "parts")
    task = F.when(F.col("parts") == 1, F.col("signature")).otherwise(F.xxhash64("signature", F.least(own, "other"), F.greatest(own, "other")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select("name", "root", task.alias("task"))
    rows = rows.join(sketches.select("name", "n", "sketch"), "name").select("task", "name", "root", "n", "sketch")
    rows = rows.repartition(partitions, "task").sortWithinPartitions("task")
    pieces = stored(rows.mapInArrow(_near, "name long, root long, task long, low long").distinct(), "pieces")
    joint = pieces.select("low", "name").distinct().groupBy("low").agg(F.count("*").alias("m")).where(F.col("m") <= TASK)
    task = F.when(F.col("m").isNotNull(), F.xxhash64("low")).otherwise(F.col("task"))
    return pieces.join(joint, "low", "left").select("name", "root", task.alias("task")).distinct()


def _labelled(plain: DataFrame) -> DataFrame:
    """``_row``, ``doc_id``, ``n``, ``root`` (null without a shingle) and ``component_id`` of each row of ``plain``.

    ``plain`` is a stored table (``_row``, ``doc_id``, ``text``).  A set is represented by one row, whose number is
    written, unique and never null, so its text is found whatever its id; ``component_id`` is null if no id is there.
    """
    spark = plain.sparkSession
    named = stored(plain.mapInArrow(_name, "_row long, doc_id long, name long, n long, sketch binary"), "set-names")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(plain))
    signed = plain.mapInArrow(_signer(frequent), "signature long, name long")
    groups = stored(
        signed.repartition(partitions, "signature").sortWithinPartitions("signature", "name")
        .mapInArrow(_groups, "signature long, name long, leader long"), "signature-groups")
    blocks = _blocks(groups)
    firsts = named.where("name IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("first"))
    sketches = named.join(blocks.select("name"), "name", "left_semi").groupBy("name").agg(
        F.min("_row").alias("_row"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    sketches = stored(sketches, "sketches")
    ids = sketches.select("name", "_row")
    inside = blocks.select("name", F.col("block").alias("task")).unionByName(
        blocks.select(F.col("home").alias("name"), F.col("block").alias("task"))).distinct()
    inside = stored(inside.join(ids, "name").withColumn("root", F.col("name")), "inside")
    links = stored(_compared(plain, inside), "links")
    roots = components(links)
    across = stored(_apart(groups, sketches, roots, partitions).join(ids, "name"), "across")
    links = stored(links.unionByName(_compared(plain, across)), "links")
    roots = components(links)
    least = _with_root(firsts, roots, "name", "root")
    found = least.groupBy("root").agg(F.min("first").alias("component_id"))
    found = stored(least.join(found, "root").select("name", "root", "component_id"), "component-ids")
    return named.join(found, "name", "left").select("_row", "doc_id", "n", "root", "component_id")


def near_copies(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the least id reachable by links.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.  Null and empty
    texts have no shingle, are linked with nothing and keep their own id.  Rows
    with the same id are documents of their own.  Rows with a null id are linked as all
    others, but a null id is never the least: only a component without any id has a null.
    An empty table gives no rows; other columns are not read.
    """
    plain = stored(texts(docs).withColumn("_row", F.monotonically_increasing_id()), "texts")
    return _labelled(plain).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its component, with all their columns.

    Rows with the same id go or stay together.  A row with a null id goes if its component has an id;
    of a component without any id one row stays.
    """
    number = unused(docs, "_row")[0]
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    labels = _labelled(rows.select(F.col(number).alias("_row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")))
    gone = labels.where("doc_id <> component_id").select("doc_id").distinct()
    nameless = labels.where("doc_id IS NULL AND root IS NOT NULL")
    kept = nameless.where("component_id IS NULL").groupBy("root").agg(F.min("_row").alias("kept"))
    nameless = nameless.join(kept, "root", "left").where("kept IS NULL OR _row <> kept")
    gone = labels.join(gone, "doc_id", "left_semi").select("_row").unionByName(nameless.select("_row"))
    return rows.join(gone.withColumnRenamed("_row", number), number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
