"""Jaccard join of word n-gram sets with prefix trees.

The n-grams of a set are hashed; the hashes are the global order, in which every set
is a path. Two sets over the threshold lack few of each other's n-grams, so they share
several within a prefix of their paths. N-grams that lie in the prefix of one set only
are found by counting; a set that keeps too few of its prefix has no partner and
leaves as a whole. Of the others, linked ones also agree in some whole segments of the
hash range, if it is cut into more segments than n-grams may differ: ordered from any
of its segments on, a set is a path again, and sets with a common first segment hang
below one node. How many segments linked sets of their sizes have in common at least is
known, so pairs with fewer are none. The other pairs form candidate clusters, and these
are joined exactly, in blocks of bounded size, by walking the prefix tree of one block
with the sets of another: shared paths once, and no further where what remains is too
short. In large clusters, components that the first blocks have tied are left whole.
Equal sets count once throughout.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cleartab.llm.bitmap import Bitmap
from cleartab.llm.common import documents, keep_only
from cleartab.llm.graph import components
from cleartab.llm.trie import mixed, spanning
from cleartab.session import Staging

WORDS = 3
PERCENT = 90
BLOCK = 1024
"""Sets of a candidate cluster that one task compares with another such block at a time."""
BLOCK_GRAMS = 1 << 20
"""N-grams of the sets of a block."""
FEW = 8
"""Blocks of a cluster that are all compared with each other at once."""
MEMO_ENTRIES = 300_000
BUCKET_BITS = 12
"""Leading bits of a key by which keys are shuffled; the keys of one bucket are in memory at once."""
HELD = 1 << 20
"""Keys that a task puts into buckets, or pairs that it counts, at a time."""
OFTEN = 16
"""Sets that have a key at most where all their pairs are counted."""


def shingler(n: int = WORDS):
    """A function from text to its sorted array of distinct n-gram hashes."""
    import xxhash

    class Memo(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = value = xxhash.xxh3_64_intdigest(word)
            return value

    memo = Memo()

    def shingles(text: str | None) -> np.ndarray:
        found = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII blanks only
        if not found:
            return np.array([], dtype=np.uint64)
        hashes = np.fromiter(map(memo.__getitem__, found), dtype=np.uint64, count=len(found))
        width = min(n, len(hashes))
        grams = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
        for k in range(width):
            grams = mixed(grams * np.uint64(31) + hashes[k:len(hashes) - width + 1 + k])
        return np.unique(mixed(grams + np.uint64(width)))

    return shingles


def digest(grams: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit sums that tell a set; equal sets have equal ones."""
    if not len(grams):
        return 0, 0
    a, b = mixed(grams).sum(), mixed(grams ^ np.uint64(0x9E3779B97F4A7C15)).sum()
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def lacking(n: int, percent: int) -> int:
    """N-grams of a set of n that no linked set need have."""
    return n - -(-percent * n // 100)


def depth(n: int, percent: int) -> int:
    """N-grams that two linked sets, both of at least n, share within their prefixes. It grows with n."""
    return max(1, n * (100 - percent) // 200)


def prefix(grams: np.ndarray, percent: int) -> np.ndarray:
    """The first n-grams of a set, which hold the first ``depth`` that it shares with any linked set.

    Of the n-grams in front of the j-th shared one, at most ``lacking`` are not shared.
    """
    n = len(grams)
    return grams[:lacking(n, percent) + depth(n, percent)] if n else grams


def may_be_linked(n: int, kept: int, percent: int) -> bool:
    """Whether a set of n may have partners if other prefixes have ``kept`` n-grams of its own.

    A linked set has the percentage of n members or more, so both prefixes share ``depth`` of that many.
    """
    return kept >= depth(-(-percent * n // 100), percent)


def bounds(percent: int, upto: int) -> list[int]:
    """First sizes of the size classes. A class spans four steps of the least ratio between linked sizes, below 90 % one.

    Wide classes need fewer keys. Below 90 % they would leave so many segments of their smaller sets
    empty that empty segments become keys, which all sets of a class share.
    """
    out, steps = [1], 4 if percent >= 90 else 1
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, int(out[-1] * (100 / percent) ** steps)))
    return out


def class_keys(grams: np.ndarray, percent: int):
    """For each size class in which a set may have partners, one key per segment, how many segments hold n-grams, and
    how many keys any partner shares.

    Sets of at most S members differ in at most d = 2 S (100 - percent) / (100 + percent)
    n-grams when linked, and a set of n and any linked one in at most n (100 - percent) / percent.
    Of more segments at least the rest are the same. A set with more segments that hold
    n-grams than may differ leaves the empty ones out: same segments that are not empty remain.
    Of two sets with fewer, the least n-gram they share is among the first ``lacking`` + 1 of both,
    so these are their keys as well; empty segments, which unlike sets share, never are.
    """
    n = len(grams)
    edges = bounds(percent, n)
    own = len(edges) - 2
    reach = n * 100 // percent
    for size_class in (own, own + 1):
        edges = edges if size_class + 1 < len(edges) else bounds(percent, edges[-1])
        if size_class > own and reach < edges[size_class]:
            break
        largest = edges[size_class + 1] - 1
        d = 2 * largest * (100 - percent) // (100 + percent)
        if d == 0:
            continue  # linked sets of this class are equal
        m = d + 1 + d // 8
        cuts = np.searchsorted(grams, (np.arange(1, m, dtype=np.float64) * (2.0 ** 64 / m)).astype(np.uint64))
        cuts = np.concatenate(([0], cuts, [n]))
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mixed(grams ^ np.uint64(0xA5A5A5A5)))))
        parts = sums[cuts[1:]] - sums[cuts[:-1]]
        filled = np.flatnonzero(cuts[1:] > cuts[:-1]).astype(np.uint64)
        salt = np.uint64(size_class << 32)
        keys = mixed(parts[filled] + mixed(salt + filled + np.uint64(1))).astype(np.int64)
        same = len(filled) - min(d, n * (100 - percent) // percent)
        if same < 1:
            first = mixed(grams[:lacking(n, percent) + 1] ^ mixed(np.array([salt]))).astype(np.int64)
            keys, same = np.concatenate([keys, first]), 1
        yield keys, len(filled), same


def segment_keys(grams: np.ndarray, percent: int) -> list[int]:
    """The keys of all size classes of a set. Linked sets that are not equal share one."""
    keys = [found for found, _, _ in class_keys(grams, percent)]
    return np.concatenate(keys).tolist() if keys else []


def _bucketed(keys: np.ndarray, nodes: np.ndarray | None = None):
    """Keys, with nodes where these are given, in one row for each of their leading bits. Without
    nodes a key has two entries at most and, as the row tells the bits before them, 32 bits of it."""
    import pyarrow as pa

    if nodes is None:
        keys, times = np.unique(keys, return_counts=True)
        keys, held = np.repeat(keys, np.minimum(times, 2)), []
    else:
        order = np.argsort(keys)
        keys, held = keys[order], [nodes[order]]
    buckets = (keys >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    starts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    held = [keys if held else (keys >> np.uint64(32 - BUCKET_BITS)).astype(np.uint32), *held]
    rows = [pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(
        (x.itemsize * np.append(starts, len(x))).astype(np.int32)), pa.py_buffer(x)]) for x in held]
    return pa.RecordBatch.from_arrays([pa.array(buckets[starts]), *rows], ["bucket", "keys", "nodes"][:1 + len(rows)])


def _spread(batches, entries):
    """Rows of ``_bucketed`` for what ``entries`` gives of every batch."""
    held, n = [], 0
    for batch in batches:
        held.append(entries(batch))
        n += len(held[-1][0])
        if n >= HELD:
            yield _bucketed(*map(np.concatenate, zip(*held)))
            held, n = [], 0
    if n:
        yield _bucketed(*map(np.concatenate, zip(*held)))


def _buckets(batches):
    """Each bucket with all its entries, one array for each column, from rows in the order of the buckets."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    for bucket, group in itertools.groupby(rows, key=lambda r: r[0]):
        yield bucket, [b"".join(x) for x in list(zip(*group))[1:]]


def repeated(table: DataFrame, entries) -> DataFrame:
    """(key): the leading bits of the keys that come more than once. ``entries`` gives a tuple of one array of
    keys for a batch of the table. Few others can come along, as only 32 bits are compared besides the bucket's."""
    def run(batches):
        import pyarrow as pa

        for bucket, (keys,) in _buckets(batches):
            keys = np.sort(np.frombuffer(keys, np.uint32))
            keys = np.unique(keys[1:][keys[1:] == keys[:-1]]).astype(np.uint64) << np.uint64(32 - BUCKET_BITS)
            keys |= np.uint64(bucket << (64 - BUCKET_BITS))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])

    cuts = table.mapInArrow(lambda batches: _spread(batches, entries), "bucket int, keys binary")
    return cuts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "key bigint")


def pairs_of(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (a, b), a > b, of the nodes of each key that at most ``OFTEN`` nodes have, a row for each key; and which
    entries are of other keys. Entries are distinct and in the order of keys and nodes."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    found = [np.empty((0, 2), np.int64)]
    for size in range(2, OFTEN + 1):
        least, greatest = np.triu_indices(size, 1)
        at = starts[sizes == size][:, None]
        found.append(np.stack([nodes[at + greatest].ravel(), nodes[at + least].ravel()], axis=1))
    found = np.concatenate(found)
    return found[:, 0], found[:, 1], np.repeat(sizes > OFTEN, sizes)


def met(table: DataFrame, entries) -> DataFrame:
    """What nodes share keys: (a, b, n) of the pairs with n keys that few nodes have, in one or several rows, and
    (key, a) of all nodes a of every other key. ``entries`` gives keys and nodes for a batch of the table."""
    def run(batches):
        import pyarrow as pa

        def counted(pairs):
            a, b = (np.concatenate(x) for x in zip(*pairs))
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            n = np.diff(np.append(starts, len(a)))
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(starts), pa.int64()), *[pa.array(x, pa.int64()) for x in (a[starts], b[starts], n)]],
                ["key", "a", "b", "n"])

        held, size = [], 0
        for _, (keys, nodes) in _buckets(batches):
            keys, nodes = np.frombuffer(keys, np.uint64), np.frombuffer(nodes, np.int64)
            order = np.lexsort((nodes, keys))
            keys, nodes = keys[order], nodes[order]
            once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])])
            keys, nodes = keys[once], nodes[once]
            a, b, often = pairs_of(keys, nodes)
            held.append((a, b))
            size += len(a)
            if size >= HELD:
                yield counted(held)
                held, size = [], 0
            if often.any():
                none = pa.nulls(int(often.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[often].view(np.int64)), pa.array(nodes[often]), none, none], ["key", "a", "b", "n"])
        if held:
            yield counted(held)

    cuts = table.mapInArrow(lambda batches: _spread(batches, entries), "bucket int, keys binary, nodes binary")
    return (cuts.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(run, "key bigint, a bigint, b bigint, n bigint"))


def candidate_clusters(signed: DataFrame, firsts, seen, percent: int, staging: Staging) -> DataFrame:
    """(node, cluster) of the sets that may be linked with another of their cluster.

    All keys are shuffled once, as a few bytes each and of one row of every set; with their sets only
    those that come twice. A partner shares as many keys of a set as it has segments that hold n-grams,
    less the n-grams in which sets of their sizes may differ. Of those, all are keys of few sets, of
    which all pairs are counted, but for the other keys that the set has. Sets that may share other
    keys alone are tied to the least such set of each.
    """
    signed = signed.filter("n_shingles > 0")
    sets = signed.select("mark", "node", "n_shingles", "prefix", "segments", "same")
    shared = staging.table(repeated(sets, lambda batch: _segments(batch, firsts, seen, percent)[:1]), "shared")
    known = signed.sparkSession.sparkContext.broadcast(Bitmap.of(shared))
    found = staging.table(met(sets, lambda batch: _segments(batch, firsts, seen, percent, known)), "met")
    often = found.filter("key is not null").select("key", F.col("a").alias("node"))
    pairs = found.filter("key is null").groupBy("a", "b").agg(F.sum("n").alias("n"))
    about = signed.groupBy("node").agg(*[F.min(c).alias(c) for c in ("n_shingles", "filled", "same")])
    about = about.join(often.groupBy("node").agg(F.count("*").alias("often")), "node", "left")
    about = staging.table(about.withColumn("often", F.coalesce("often", F.lit(0))), "about")
    for side in ("a", "b"):
        pairs = pairs.join(about.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"),
                                        (F.col("filled") - F.col("often")).alias(f"same_{side}")), side)
    differ = f"n_a + n_b - 2 * (((n_a + n_b) * {percent} + {99 + percent}) div {100 + percent})"
    edges = pairs.filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").filter(
        f"n >= greatest(same_a, same_b) - ({differ})").select("a", "b")
    many = often.join(about.filter("same <= often").select("node"), "node")
    ties = many.join(many.groupBy("key").agg(F.min("node").alias("b")), "key").filter("node <> b").select(
        F.col("node").alias("a"), "b")
    found = components(edges.unionByName(ties), staging, "candidates")
    return staging.table(found.select("node", F.col("component").alias("cluster")), "clusters")


def _blocks() -> Column:
    """Blocks, and parts of blocks, that sets with ``n_shingles`` take."""
    return F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_GRAMS)


def blocked(sets: DataFrame) -> DataFrame:
    """The first round: every set once per pair of blocks that its block is in. In clusters of more than a ``FEW`` blocks
    these are the pairs of a block with itself and with the first one. ``sets`` has (node, cluster, blocks, grams)."""
    all_of = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    others = F.when((F.col("own") == 0) | (F.col("blocks") <= FEW), all_of).otherwise(F.array(F.lit(0).cast("long"), "own"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    return paired(sets.withColumn("own", own).withColumn("other", F.explode(others)))


def unsettled(sets: DataFrame, joined: DataFrame) -> DataFrame:
    """The second round: every set of the larger clusters that are several components ``joined`` by the first round, once
    per pair of blocks that its block is in. A component of more than a block has blocks of its own, which are not
    compared with each other; the others lie whole in common blocks."""
    at = sets.filter(F.col("blocks") > FEW).select("node", "check", "cluster", "n_shingles").join(
        joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = at.groupBy("cluster", "component").agg(_blocks().alias("n"))
    whole = sizes.groupBy("cluster").agg(F.count("*").alias("parts"),
                                         F.coalesce(F.ceil(F.sum(F.when(F.col("n") <= 1, F.col("n")))), F.lit(0)).alias("common"))
    whole = whole.filter("parts > 1").select("cluster", "common")
    large = sizes.filter("n > 1").select("cluster", "component", F.ceil("n").alias("blocks"))
    numbers = lambda n: F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("k")
    # A block is told by its number and, where a component has blocks of its own, by that.
    others = large.select("cluster", F.col("component").alias("_lump"), numbers("blocks")).unionByName(
        whole.filter("common > 0").select("cluster", F.lit(None).cast("long").alias("_lump"), numbers("common")))
    others = others.select("cluster", "_lump", F.xxhash64("_lump", "k").alias("other"))
    placed = at.join(whole, "cluster").join(large, ["cluster", "component"], "left")
    lump = F.when(F.col("blocks").isNotNull(), F.col("component"))
    k = F.when(F.col("blocks").isNull(), F.pmod(F.xxhash64("component"), F.col("common"))).otherwise(
        F.pmod(F.xxhash64("node"), F.col("blocks"))) + 1
    placed = placed.select("node", "check", "cluster", lump.alias("lump"), F.xxhash64(lump, k).alias("own"))
    placed = placed.join(others, "cluster").filter(F.col("lump").isNull() | ~F.col("lump").eqNullSafe(F.col("_lump")))
    return paired(sets.select("node", "check", "grams").join(placed.select("node", "check", "cluster", "own", "other"),
                                                             ["node", "check"]))


def paired(rows: DataFrame) -> DataFrame:
    """(cluster, i, j, own, node, grams) of sets in their ``own`` block and an ``other``; pairs of blocks are (i, j)."""
    return rows.select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       "own", "node", "grams")


def links(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect all that is linked within each pair of blocks; ``rows`` from ``paired``."""
    def run(batches):
        import pyarrow as pa

        def rows_of():
            for batch in batches:
                yield from zip(*[batch.column(k).to_pylist() for k in range(6)])

        for (_, i, j), group in itertools.groupby(rows_of(), key=lambda r: r[:3]):
            group = list(group)
            left = [r for r in group if r[3] == i]
            right = None if i == j else [r for r in group if r[3] == j]
            arrays = lambda side: [np.frombuffer(r[5], dtype="<u8") for r in side]
            found = spanning(arrays(left), None if right is None else arrays(right), percent)
            if found:
                over = left if right is None else right
                yield pa.RecordBatch.from_arrays([pa.array([left[x][4] for x, _ in found], pa.int64()),
                                                  pa.array([over[y][4] for _, y in found], pa.int64())], ["a", "b"])

    return (rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
            .mapInArrow(run, "a bigint, b bigint"))


def _lists(values: list[np.ndarray], kind):
    import pyarrow as pa

    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.int32 if kind == pa.int32() else np.int64), *values])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _signed(docs: DataFrame, percent: int, n: int, pruned: bool) -> DataFrame:
    """Size, digest, prefix and segments of every text, with the number of segments that hold n-grams and of keys that
    partners share, each of the class where it is least; ``docs`` has (doc_id, text, mark).

    Of the n-grams of a prefix 32 bits, mixed as a prefix has low ones only, will do: they only tell
    what leaves. Without ``pruned`` prefixes stay empty.
    """
    def run(batches):
        import pyarrow as pa

        shingles = shingler(n)
        for batch in batches:
            sizes, nodes, checks, prefixes, segments, filled, same = [[] for _ in range(7)]
            for text in batch.column(1):
                grams = shingles(text.as_py())
                node, check = digest(grams)
                sizes.append(len(grams))
                nodes.append(node)
                checks.append(check)
                first = prefix(grams, percent) if pruned else grams[:0]
                prefixes.append((mixed(first) >> np.uint64(32)).astype(np.uint32).view(np.int32))
                keys = list(class_keys(grams, percent))
                segments.append(np.concatenate([np.empty(0, np.int64), *[k[0] for k in keys]]))
                filled.append(min([k[1] for k in keys], default=0))
                same.append(min([k[2] for k in keys], default=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *[pa.array(c, pa.int64()) for c in (sizes, nodes, checks)],
                 _lists(prefixes, pa.int32()), _lists(segments, pa.int64()), pa.array(filled, pa.int32()),
                 pa.array(same, pa.int32())],
                ["doc_id", "mark", "n_shingles", "node", "check", "prefix", "segments", "filled", "same"])

    return docs.select("doc_id", "text", "mark").mapInArrow(
        run, "doc_id bigint, mark bigint, n_shingles bigint, node bigint, check bigint, prefix array<int>, "
             "segments array<bigint>, filled int, same int")


def _parts(column) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a column of lists, and the number of entries of each."""
    return column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())


def _prefixes(batch, firsts) -> tuple[np.ndarray]:
    """Prefix n-grams of (mark, node, n_shingles, prefix, ...) of the marks ``firsts``."""
    flat, n = _parts(batch.column(3))
    first = np.repeat(firsts.value.has(batch.column(0).to_numpy().view(np.uint64)), n)
    return (flat[first].view(np.uint32).astype(np.uint64) << np.uint64(32),)


def _segments(batch, firsts, seen, percent: int, known=None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of segments and their nodes, of (mark, node, n_shingles, prefix, segments, same) of the marks ``firsts`` of sets
    that may have partners by the prefix n-grams ``seen`` twice (all sets where these are not given). With ``known``
    keys, those of the sets that have enough of them."""
    stays = firsts.value.has(batch.column(0).to_numpy().view(np.uint64))
    if seen is not None:
        flat, n = _parts(batch.column(3))
        there = seen.value.has(flat.view(np.uint32).astype(np.uint64) << np.uint64(32))
        kept = np.concatenate([[0], np.cumsum(there)])[np.concatenate([[0], np.cumsum(n)])]
        stays &= np.array([may_be_linked(size, k, percent) for size, k in
                           zip(batch.column(2).to_pylist(), np.diff(kept).tolist())], dtype=bool)
    keys, n = _parts(batch.column(4))
    keys, stays = keys.view(np.uint64), np.repeat(stays, n)
    if known is not None:
        stays &= known.value.has(keys)
        kept = np.concatenate([[0], np.cumsum(stays)])[np.concatenate([[0], np.cumsum(n)])]
        stays &= np.repeat(np.diff(kept) >= batch.column(5).to_numpy(), n)
    return keys[stays], np.repeat(batch.column(1).to_numpy(), n)[stays]


def _grams(docs: DataFrame, n: int, wanted) -> DataFrame:
    """(node, check, grams) of the texts whose mark is in a bitmap, each set about once a task; texts are not
    shuffled. ``docs`` has (text, mark)."""
    def run(batches):
        import pyarrow as pa

        shingles, seen = shingler(n), set()
        for batch in batches:
            rows = []
            for at in np.flatnonzero(wanted.value.has(batch.column(1).to_numpy().view(np.uint64))).tolist():
                found = shingles(batch.column(0)[at].as_py())
                mark = digest(found)
                if mark not in seen:
                    seen.add(mark)
                    rows.append((*mark, found.astype("<u8").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, (pa.int64(), pa.int64(), pa.binary()))],
                ["node", "check", "grams"])

    return docs.select("text", "mark").mapInArrow(run, "node bigint, check bigint, grams binary")


def join(docs: DataFrame, staging: Staging, percent: int = PERCENT, n: int = WORDS, pruned: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the least id reachable by links.

    A null text is empty; empty sets are linked with nothing, their component is
    their own id. Repeated rows are linked by their equal texts. A null id never
    names a component unless all its members have none, but links through rows
    without an id count. An empty table gives no rows; other columns are not read.

    ``pruned`` lets sets without partners leave by their prefixes before segments
    are paired. The result is the same; it pays where most n-grams occur once, as
    those of five words do, and not with shorter ones, of which a growing corpus
    repeats more and more.
    """
    docs = keep_only(docs, "doc_id", "text").withColumn("mark", F.xxhash64("doc_id", "text"))
    signed, seen = staging.table(_signed(docs, percent, n, pruned), "signed"), None
    share = docs.sparkSession.sparkContext.broadcast
    rows = staging.table(signed.select("doc_id", "mark", "n_shingles", "node", "check"), "rows")
    # One row of every set stands for the others; the few that a bitmap lets through besides do no harm.
    firsts = share(Bitmap.of(rows.filter("n_shingles > 0").groupBy("node").agg(F.min("mark").alias("key"))))
    if pruned:
        sets = signed.filter("n_shingles > 0").select("mark", "node", "n_shingles", "prefix")
        grams = staging.table(repeated(sets, lambda batch: _prefixes(batch, firsts)), "grams")
        seen = share(Bitmap.of(grams))
        staging.drop("grams")
    clusters = candidate_clusters(signed, firsts, seen, percent, staging)
    for name in ("signed", "shared", "met", "about"):
        staging.drop(name)
    # One text per different set; the digest's second half tells apart the few that share the first.
    wanted = rows.select("node", "check", "n_shingles", "mark").join(clusters, "node")
    wanted = staging.table(wanted.groupBy("node", "check", "cluster", "n_shingles").agg(F.min("mark").alias("mark")), "wanted")
    marks = share(Bitmap.of(wanted.select(F.col("mark").alias("key"))))
    many = wanted.groupBy("cluster").agg(F.ceil(_blocks()).alias("blocks"))
    placed = wanted.drop("mark").join(many, "cluster")
    sets = staging.table(_grams(docs, n, marks).join(placed, ["node", "check"]).dropDuplicates(["node", "check"]), "sets")
    found = staging.table(links(blocked(sets), percent), "links")
    joined = components(found, staging, "components")
    if not many.filter(F.col("blocks") > FEW).isEmpty():
        joined = staging.table(joined, "joined")
        more = staging.table(links(unsettled(sets, joined), percent), "more_links")
        joined = components(found.unionByName(more), staging, "all_components")
    member = rows.select("doc_id", "n_shingles", "node").join(joined, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    member = staging.table(member.drop("node"), "members")
    for name in ("rows", "clusters", "wanted", "sets", "links", "joined", "more_links"):
        staging.drop(name)
    least = member.filter("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    filled = member.filter("n_shingles > 0").join(least, "component").select("doc_id", "n_shingles", "component_id")
    empty = member.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return filled.unionByName(empty)


def representatives(docs: DataFrame, staging: Staging, percent: int = PERCENT, n: int = WORDS) -> DataFrame:
    """The documents, all columns, one of each group: the one with the least id; of repeated rows one.

    Rows with a null id are kept.
    """
    kept = join(docs, staging, percent, n).filter(F.col("doc_id") == F.col("component_id"))
    kept = kept.select(F.col("doc_id").alias("_kept")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    once = (docs.filter("doc_id is not null").select(row, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"))
            .join(kept, F.col("_id") == F.col("_kept")).dropDuplicates(["_id", "_text"]).select("_row.*"))
    return once.unionByName(docs.filter("doc_id is null"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return join(documents(spark, folder), Staging(spark), pruned=False)
