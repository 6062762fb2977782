"""Removal of repeated and nearly repeated lines across documents.

Equal lines meet by a hash of their content, whatever their length. For the rest, a
one-permutation MinHash of character shingles is cut into bands; lines that share a
band are tied to the least and the greatest line of that band, and each tie is
checked by the exact Jaccard similarity of the shingle sets. In bands whose lines
are not one component then, all lines are compared. Checked ties are joined into
components, and of each component one line stays: the first by document and place.

Two lines are compared by shingles of ``LONG`` characters when both are long, else
by shingles of ``SHORT``, in which one changed character weighs less; a line shorter
than that is one shingle. A long line that may have short partners has bands for both.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cleartab.llm.bitmap import Bitmap
from cleartab.llm.common import documents
from cleartab.llm.graph import components
from cleartab.llm.hashes import powers
from cleartab.llm.trie import Sets, linked, mixed
from cleartab.session import Staging

LONG, SHORT = 8, 4
LONG_LINE = 80
"""Characters from which on a line is long."""
LEAST_FUZZY = 5
"""Shorter lines repeat exactly or not at all: one edit takes any of them below the threshold."""
BANDS, ROWS = 10, 5
PERCENT = 80
BLOCK = 256
"""Lines of one band that a task compares with another such block at a time."""
STAGED = ("lines", "shared", "members", "ties", "texts", "links", "banded", "bands", "more_links", "first")
"""Tables that are deleted when the places to remove are known."""
FEW = 20_000
"""Up to so many pairs of lines are compared by counts of shared shingles, without a prefix tree."""
CHUNK = 60_000
"""Characters hashed at once, at least one line: what stays in a core's cache."""
HELD = 1_500_000
"""Characters of lines that are taken together, at least one line."""
COMBINED = 1 << 20
"""Band keys whose least and greatest lines a task finds before they are shuffled."""
BUCKET_BITS = 12
"""Leading bits of a band key by which keys are shuffled; the keys of one bucket are in memory at once."""
CELLS = 1 << 21
"""Entries of a table of lines by shingles."""


def normal(line: str) -> str:
    """Lines are compared without case and surrounding blanks."""
    return line.strip().lower()


def eligible(text: str | None) -> list[tuple[int, str]]:
    """(place, normal form) of the lines that take part: all but blank ones."""
    return [(i, n) for i, line in enumerate((text or "").split("\n")) if (n := normal(line))]


def mark(line: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def nearly_short(n, percent: int = PERCENT):
    """Whether a line of so many characters may be similar to a short one."""
    # Sets of linked lines differ in size by the threshold at most, and so, but for repeated shingles, do lines.
    return n * percent <= LONG_LINE * 100 + 100 * SHORT


def widths(line: str, percent: int = PERCENT) -> list[int]:
    """Lengths of the shingles by which a line may be compared with another."""
    n = len(line)
    if n < LONG_LINE:
        return [SHORT] if n >= LEAST_FUZZY else []
    return [LONG, SHORT] if nearly_short(n, percent) else [LONG]


def shingles(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every character shingle and the number of its line; a line shorter than a shingle is one.

    Running sums of code times power, taken back to the start of the shingle, hash all of them in one pass.
    """
    lines = [x if len(x) >= width else x + "\0" * (width - len(x)) for x in lines]
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.array([len(x) for x in lines])
    up, down = powers(len(codes))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up, out=sums[1:])
    h = sums[width:] - sums[:len(sums) - width]
    h *= down[:len(codes) - width + 1]
    inside = np.ones(len(h), bool)
    ends = np.cumsum(lengths)[:-1]
    inside[(ends[:, None] - np.arange(1, width)).ravel()] = False  # shingles that reach into the next line
    return mixed(h[inside]), np.repeat(np.arange(len(lines), dtype=np.int32), lengths - width + 1)


def distinct(found: np.ndarray) -> np.ndarray:
    """Sorted, each once; for some hundred numbers faster than ``np.unique``."""
    found = np.sort(found)
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def shingle_sets(lines: list[str], width: int) -> list[np.ndarray]:
    """The shingle set of every line, hashed in chunks."""
    out = []
    for part in in_chunks([(x,) for x in lines]):
        h, line = shingles([x for x, in part], width)
        out += map(distinct, np.split(h, np.searchsorted(line, np.arange(1, len(part)))))
    return out


def band_keys(lines: list[str], width: int) -> np.ndarray:
    """A row of band keys per line. Empty bins borrow from the next filled one, marked by the distance."""
    k = BANDS * ROWS
    h, line = shingles(lines, width)
    empty = np.uint64(1 << 32)
    least = np.full(len(lines) * k, empty, dtype=np.uint64)
    slot = h >> np.uint64(32)
    slot *= np.uint64(k)
    slot >>= np.uint64(32)
    slot = slot.view(np.int64)
    slot += np.multiply(line, k, dtype=np.int64)
    h &= np.uint64(0xFFFFFFFF)
    np.minimum.at(least, slot, h)
    there = least != empty
    full, bare = np.flatnonzero(there), np.flatnonzero(~there)
    row = bare // k * k
    after = full[np.minimum(np.searchsorted(full, bare), len(full) - 1)]
    round_ = (after < bare) | (after >= row + k)  # none before the end of the row: on from its start
    after = np.where(round_, full[np.searchsorted(full, row)], after)
    away = after - bare + k * round_
    least[bare] = least[after] + (away.astype(np.uint64) << np.uint64(33))
    filled = least.reshape(-1, k)
    keys = np.full((len(lines), BANDS), width, dtype=np.uint64)
    for r in range(ROWS):
        keys = mixed(keys * np.uint64(31) + filled[:, r::ROWS])
    return mixed(keys + np.arange(BANDS, dtype=np.uint64)).astype(np.int64)


def all_keys(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of all lines, one after the other, of each width by which they may be compared, and how many each has."""
    n = np.array([len(x) for x in lines], dtype=np.int64)
    use = {LONG: n >= LONG_LINE, SHORT: (n >= LEAST_FUZZY) & ((n < LONG_LINE) | nearly_short(n))}
    counts = BANDS * (use[LONG].astype(np.int64) + use[SHORT])
    first = np.cumsum(counts) - counts
    flat = np.empty(int(counts.sum()), np.int64)
    for width, used in use.items():
        for at in np.split(np.flatnonzero(used), cuts(n[used])):
            start = first[at] + (BANDS * use[LONG][at] if width == SHORT else 0)
            if len(at):
                flat[start[:, None] + np.arange(BANDS)] = band_keys([lines[i] for i in at.tolist()], width)
    return flat, counts


def width_of(x: str, y: str) -> int:
    """Length of the shingles by which two lines are compared."""
    return LONG if min(len(x), len(y)) >= LONG_LINE else SHORT


def reached(common, sizes, percent: int):
    """Whether two sets are similar enough, by what they share and the sum of their sizes."""
    return common >= -(-percent * sizes // (100 + percent))


def alike(pairs: list[tuple[str, str]], percent: int) -> np.ndarray:
    """Which pairs of lines are similar enough; many pairs are compared in one pass.

    All shingles of a chunk are sorted by pair, hash and side, so what both lines have stands side by side.
    """
    out = np.zeros(len(pairs), bool)
    for width in (LONG, SHORT):
        own = [(i, x, y, x + y) for i, (x, y) in enumerate(pairs) if width_of(x, y) == width]
        for part in in_chunks(own):
            h, line = shingles([x for _, *both, _ in part for x in both], width)
            bits = (len(part) - 1).bit_length()  # of the hash, so many give way to the number of the pair
            keys = (line >> 1).astype(np.uint64) << np.uint64(63 - bits) << np.uint64(1)
            h >>= np.uint64(bits + 1)
            keys |= h << np.uint64(1)
            keys |= (line & 1).astype(np.uint64)
            keys = distinct(keys)
            each = np.searchsorted(keys, np.arange(len(part), dtype=np.uint64) << np.uint64(63 - bits) << np.uint64(1))
            sizes = np.diff(np.append(each, len(keys)))
            twins = np.flatnonzero((keys[1:] ^ keys[:-1]) == 1)
            common = np.diff(np.append(np.searchsorted(twins, each), len(twins)))
            out[[i for i, *_ in part]] = reached(common, sizes, percent)
    return out


def overlaps(groups: list[list[str]], width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every group of lines the sizes of their shingle sets, and a table of how many shingles each two share.

    Shingles that one line alone has are left out, so the diagonal says nothing.
    """
    if not groups:
        return []
    counts = np.array([len(g) for g in groups])
    first = np.cumsum(counts) - counts
    of = np.repeat(np.arange(len(groups)), counts)
    h, line = shingles([x for g in groups for x in g], width)
    high, low = (len(groups) - 1).bit_length(), (len(of) - 1).bit_length()
    keys = of[line].astype(np.uint64) << np.uint64(63 - high) << np.uint64(1)
    h >>= np.uint64(high + low)
    keys |= h << np.uint64(low)
    keys |= line.astype(np.uint64)
    keys = distinct(keys)
    line = (keys & np.uint64((1 << low) - 1)).astype(np.int64)
    sizes = np.bincount(line, minlength=len(of))
    keys >>= np.uint64(low)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    times = np.diff(np.append(starts, len(keys)))
    line = line[np.repeat(times > 1, times)]
    times = times[times > 1]
    token, cuts, out = np.repeat(np.arange(len(times)), times), np.searchsorted(of[line], np.arange(len(groups) + 1)), []
    for g, n in enumerate(counts.tolist()):
        mine, which = line[cuts[g]:cuts[g + 1]] - first[g], token[cuts[g]:cuts[g + 1]]
        common, step = np.zeros((n, n), np.int64), max(1, CELLS // n)
        for start in range(which[0], which[-1] + 1, step) if len(which) else ():
            a, b = np.searchsorted(which, (start, start + step))
            table = np.zeros((n, min(step, which[-1] + 1 - start)), np.float32)
            table[mine[a:b], which[a:b] - start] = 1
            common += (table @ table.T).astype(np.int64)
        out.append((sizes[first[g]:first[g] + n], common))
    return out


def near(groups: list[list[str]], percent: int) -> list[np.ndarray]:
    """For every group of lines a table of which are similar enough, but for its diagonal."""
    out = [np.zeros((len(g), len(g)), bool) for g in groups]
    for width in (LONG, SHORT):
        at = [np.array([i for i, x in enumerate(g) if width == SHORT or len(x) >= LONG_LINE], np.int64) for g in groups]
        some = [k for k, g in enumerate(groups) if len(at[k]) and (width == LONG or any(len(x) < LONG_LINE for x in g))]
        for k, (sizes, common) in zip(some, overlaps([[groups[k][i] for i in at[k]] for k in some], width)):
            ok = reached(common, sizes[:, None] + sizes, percent)
            if width == SHORT:
                short = np.array([len(x) < LONG_LINE for x in groups[k]])
                ok &= short[:, None] | short
            out[k][np.ix_(at[k], at[k])] |= ok
    return out


def in_chunks(lines: list[tuple], most: int = CHUNK) -> list[list[tuple]]:
    """Cut so that a chunk has about ``most`` characters; the last entry of each item is the line."""
    at = [0, *cuts(np.array([len(item[-1]) for item in lines], dtype=np.int64), most).tolist(), len(lines)]
    return [lines[a:b] for a, b in itertools.pairwise(at) if a < b]


def cuts(lengths: np.ndarray, most: int = CHUNK) -> np.ndarray:
    """Where to cut lines of these lengths into chunks of at most ``most`` characters, or one line."""
    sums, at, out = np.cumsum(lengths), 0, []
    while at < len(sums):
        before = sums[at - 1] if at else 0
        at = max(at + 1, int(np.searchsorted(sums, before + most, "right")))
        out.append(at)
    return np.array(out[:-1], dtype=np.int64)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, place, node, keys) of every line; ``keys``, 8 bytes each, only where a line is first met in a chunk."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [(doc_id, place, line) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                     for place, line in eligible(text.as_py())]
            for chunk in in_chunks(found, HELD):
                ids, places, lines = zip(*chunk)
                nodes = {line: mark(line) for line in lines}
                flat, counts = all_keys(list(nodes))
                seen, own = set(), np.zeros(len(lines) + 1, np.int64)
                own[[i + 1 for i, x in enumerate(lines) if not (x in seen or seen.add(x))]] = counts
                offsets = np.cumsum(8 * own).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(places, pa.int32()),
                     pa.array([nodes[x] for x in lines], pa.int64()),
                     pa.Array.from_buffers(pa.binary(), len(lines), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])],
                    ["doc_id", "place", "node", "keys"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, place int, node bigint, keys binary")


def _keys(batch) -> tuple[np.ndarray, np.ndarray]:
    """All band keys of rows (node, keys), one after the other, and the node of each."""
    keys = batch.column(1)
    at = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset:keys.offset + len(keys) + 1]
    return (np.frombuffer(keys.buffers()[2], np.int64, (at[-1] - at[0]) // 8, at[0]),
            np.repeat(batch.column(0).to_numpy(), np.diff(at) // 8))


def ends(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every key once, in unsigned order, with its least and its greatest node."""
    order = np.argsort(keys.view(np.uint64))
    keys, nodes = keys[order], nodes[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.minimum.reduceat(nodes, starts), np.maximum.reduceat(nodes, starts)


def _met(lines: DataFrame) -> DataFrame:
    """(key, least, most) of the keys that several nodes have.

    Keys are shuffled as arrays, cut by their leading bits; no key has more than two entries in one of them.
    """
    def cut(held):
        import pyarrow as pa

        keys, least, most = ends(*map(np.concatenate, zip(*held)))
        times = 1 + (least < most)
        keys, nodes = np.repeat(keys, times), np.repeat(least, times)
        nodes[np.cumsum(times) - 1] = most
        buckets = (keys.view(np.uint64) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        starts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
        offsets = pa.py_buffer((8 * np.append(starts, len(keys))).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(buckets[starts]), *[pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(x)])
                                          for x in (keys, nodes)]], ["bucket", "keys", "nodes"])

    def spread(batches):
        held, n = [], 0
        for batch in batches:
            held.append(_keys(batch))
            n += len(held[-1][0])
            if n >= COMBINED:
                yield cut(held)
                held, n = [], 0
        if n:
            yield cut(held)

    def gathered(batches):
        import pyarrow as pa

        rows = ((b, k, n) for batch in batches for b, k, n in zip(*[c.to_pylist() for c in batch.columns]))
        for _, group in itertools.groupby(rows, key=lambda r: r[0]):
            keys, nodes = (np.frombuffer(b"".join(x), np.int64) for x in list(zip(*group))[1:])
            found = ends(keys, nodes)
            there = found[1] < found[2]
            yield pa.RecordBatch.from_arrays([pa.array(x[there]) for x in found], ["key", "least", "most"])

    cuts = lines.filter(F.length("keys") > 0).select("node", "keys").mapInArrow(spread, "bucket int, keys binary, nodes binary")
    return (cuts.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(gathered, "key bigint, least bigint, most bigint"))


def _shared(lines: DataFrame, keys) -> DataFrame:
    """(key, node) of the keys in a bitmap, out of the lists of keys of the lines."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            flat, owner = _keys(batch)
            there = keys.value.has(flat.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(flat[there]), pa.array(owner[there])], ["key", "node"])

    return lines.filter(F.length("keys") > 0).select("node", "keys").mapInArrow(run, "key bigint, node bigint")


def _texts(docs: DataFrame, nodes) -> DataFrame:
    """(node, line) of the lines in a bitmap, by content: which row holds a line is of no account."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lines = {line for text in batch.column(0) for _, line in eligible(text.as_py())}
            lines = np.array(list(lines), dtype=object)
            marks = np.array([mark(x) for x in lines], dtype=np.int64)
            there = nodes.value.has(marks.view(np.uint64)) if len(marks) else np.empty(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(marks[there], pa.int64()), pa.array(lines[there].tolist(), pa.string())],
                                             ["node", "line"])

    return docs.select("text").mapInArrow(run, "node bigint, line string")


def _checked(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose lines x, y are similar enough."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            good = alike(list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())), percent)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _unsettled(members: DataFrame, joined: DataFrame, staging: Staging, block: int = BLOCK) -> DataFrame:
    """(key, i, j, own, node): the lines of every band that is not one component, once per pair of blocks.

    Three lines are all checked against the least and the greatest. Of bands with the same lines one
    stands for all. A component of more than a block has blocks of its own, which are not compared
    with each other.
    """
    at = members.join(joined, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    at = staging.table(at, "banded")
    print_of = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"h{k}") for k in (0, 1)]
    sizes = at.groupBy("key", "component").agg(F.count("*").alias("n"), *print_of)
    big = F.col("n") > block
    lumps = sizes.groupBy("key", big.alias("big"), F.when(big, F.col("component")).otherwise(0).alias("id")).agg(
        F.sum("n").alias("n"), F.count("*").alias("parts"), *[F.bit_xor(h).alias(h) for h in ("h0", "h1")])
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.col("n") / block).cast("int") - 1),
                         lambda b: F.struct(F.col("big"), F.col("id"), b.alias("block")))
    bands = lumps.groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("parts").alias("parts"), *[F.bit_xor(h).alias(h) for h in ("h0", "h1")],
        F.array_sort(F.flatten(F.collect_list(blocks))).alias("blocks"))
    bands = bands.filter("parts > 1 and n > 3").dropDuplicates(["n", "h0", "h1"]).select("key", "blocks")
    rows = at.join(staging.table(bands, "bands"), "key")
    apart = F.exists("blocks", lambda b: b["big"] & (b["id"] == F.col("component")))
    rows = rows.withColumn("lump", F.struct(apart.alias("big"), F.when(apart, F.col("component")).otherwise(0).alias("id")))
    same = lambda b: (b["big"] == F.col("lump.big")) & (b["id"] == F.col("lump.id"))
    count = F.size(F.filter("blocks", same))
    own = F.array_position("blocks", F.struct(F.col("lump.big").alias("big"), F.col("lump.id").alias("id"),
                                              F.pmod(F.xxhash64("node"), count).cast("int").alias("block"))) - 1
    rows = rows.withColumn("own", own.cast("int")).select("key", "node", "own", "lump", F.posexplode("blocks").alias("other", "b"))
    rows = rows.filter(~(F.col("b.big") & same(F.col("b"))))
    return rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node")


def _compared(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that connect all similar lines of each pair of blocks; ``rows`` as from ``_unsettled``, with ``line``."""
    def run(batches):
        import pyarrow as pa

        def rows_of():
            for batch in batches:
                yield from zip(*[batch.column(k).to_pylist() for k in range(6)])

        def connecting(left, right):
            """Links that connect all that is linked: long lines by long shingles, others by short ones."""
            sides = [left] if right is None else [left, right]
            joined, shift = Sets(sum(map(len, sides))), 0 if right is None else len(left)
            for width in (LONG, SHORT):
                of = [[(i, r) for i, r in enumerate(side) if width in widths(r[5], percent)] for side in sides]
                sets = [shingle_sets([r[5] for _, r in side], width) for side in of]
                if all(sets):
                    for x, y in linked(sets[0], None if right is None else sets[1], percent):
                        (i, p), (j, q) = of[0][x], of[-1][y]
                        if (width == LONG or min(len(p[5]), len(q[5])) < LONG_LINE) and joined.join(i, j + shift):
                            yield i, j

        def connecting_few(held):
            """The same for many small groups."""
            for (left, right, _), ok in zip(held, near([[r[5] for r in left + (right or [])] for left, right, _ in held], percent)):
                joined, shift = Sets(len(ok)), 0 if right is None else len(left)
                for i, j in np.argwhere(np.triu(ok, 1)).tolist():
                    if (right is None or i < shift <= j) and joined.join(i, j):
                        yield left[i][4], (right or left)[j - shift][4]

        def connecting_long(left, right):
            """The same for few lines, too long to be taken together."""
            joined, shift = Sets(len(left) + len(right or [])), 0 if right is None else len(left)
            for i, p in enumerate(left):
                for j, q in enumerate(left[:i] if right is None else right):
                    if joined.root(i) != joined.root(j + shift) and alike([(p[5], q[5])], percent)[0]:
                        joined.join(i, j + shift)
                        yield p[4], q[4]

        def pairs_of():
            held, size = [], 0
            for (_, i, j), group in itertools.groupby(rows_of(), key=lambda r: r[:3]):
                group = list(group)
                left = [r for r in group if r[3] == i]
                right = None if i == j else [r for r in group if r[3] == j]
                n = sum(len(r[5]) for r in group)
                if len(left) * len(left if right is None else right) > FEW:
                    for x, y in connecting(left, right):
                        yield left[x][4], (left if right is None else right)[y][4]
                elif n > HELD:
                    yield from connecting_long(left, right)
                else:
                    if held and size + n > CHUNK:
                        yield from connecting_few(held)
                        held, size = [], 0
                    held.append((left, right, n))
                    size += n
            yield from connecting_few(held)

        found = pairs_of()
        while some := list(itertools.islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*some)], ["a", "b"])

    return (rows.select("key", "i", "j", "own", "node", "line").repartition("key", "i", "j")
            .sortWithinPartitions("key", "i", "j").mapInArrow(run, "a bigint, b bigint"))


def repeats(docs: DataFrame, staging: Staging, percent: int = PERCENT) -> DataFrame:
    """(doc_id, places) of the documents with lines to remove; ``places`` holds struct(place, node)."""
    share = docs.sparkSession.sparkContext.broadcast
    lines = staging.table(_lines(docs), "lines")
    # Nearly all keys occur once. The others go into a bitmap, so only theirs are shuffled again.
    shared = staging.table(_met(lines), "shared")
    members = _shared(lines, share(Bitmap.of(shared))).distinct().join(shared, "key")
    members = staging.table(members, "members")
    ties = members.select(F.explode(F.array("least", "most")).alias("b"), F.col("node").alias("a"))
    ties = staging.table(ties.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .distinct(), "ties")
    nodes = ties.select(F.explode(F.array("a", "b")).alias("node"))
    marks = share(Bitmap.of(nodes.select(F.col("node").alias("key"))))
    nodes = nodes.distinct()
    texts = staging.table(_texts(docs, marks).join(nodes, "node", "left_semi").dropDuplicates(["node"]), "texts")
    pairs = (ties.join(texts.select(F.col("node").alias("a"), F.col("line").alias("x")), "a")
             .join(texts.select(F.col("node").alias("b"), F.col("line").alias("y")), "b"))
    links = staging.table(_checked(pairs, percent), "links")
    rest = _unsettled(members, components(links, staging, "tied_components"), staging)
    more = staging.table(_compared(rest.join(texts, "node"), percent), "more_links")
    joined = components(links.unionByName(more), staging, "line_components")
    # Only lines that occur twice or lie in a component can be repeats.
    first = lines.groupBy("node").agg(F.min(F.struct("doc_id", "place", "node")).alias("first"), F.count("*").alias("n"))
    first = first.join(joined, "node", "left").filter("n > 1 or component is not null")
    first = staging.table(first.select("node", "first", F.coalesce("component", "node").alias("component")), "first")
    keep = first.groupBy("component").agg(F.min("first").alias("keep"))
    keep = first.select("node", "component").join(keep, "component").select("node", "keep")
    dropped = lines.select("doc_id", "place", "node").join(keep, "node").filter(
        ~F.struct("doc_id", "place", "node").eqNullSafe(F.col("keep")))
    return dropped.groupBy("doc_id").agg(F.collect_set(F.struct("place", "node")).alias("places"))


def dedup(docs: DataFrame, staging: Staging, percent: int = PERCENT) -> DataFrame:
    """The documents with repeated lines taken out, all columns kept, plus ``n_lines`` and ``n_dropped``.

    A null text stays null and has no lines. Where the table has ``n_chars`` it
    follows the new text. Blank lines stay. Ties go to the lowest
    (doc_id, place), then to a hash of the line. Rows repeated under one id keep and
    lose the same lines. A null id is an id. Columns named like the added ones are
    replaced. An empty table gives no rows.
    """
    docs = docs.drop("n_lines", "n_dropped", "__gone_id", "__gone")
    gone = staging.table(repeats(docs, staging, percent).select(
        F.col("doc_id").alias("__gone_id"), F.col("places").alias("__gone")), "gone")
    for name in STAGED:
        staging.drop(name)
    rows = docs.join(gone, docs["doc_id"].eqNullSafe(gone["__gone_id"]), "left").drop("__gone_id")
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType())])

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            k = names.index("text")
            columns, places = list(batch.columns[:len(names)]), batch.column(len(names))
            counts = pc.fill_null(pc.add(pc.count_substring(columns[k], "\n"), 1), 0).cast(pa.int64())
            drops, texts = np.zeros(len(batch), np.int64), {}
            for at in np.flatnonzero(pc.is_valid(places).to_numpy(zero_copy_only=False)).tolist():
                text = columns[k][at].as_py()
                lines = [] if text is None else text.split("\n")
                cut = set()
                for p in places[at].as_py():
                    if p["place"] < len(lines) and mark(normal(lines[p["place"]])) == p["node"]:
                        cut.add(p["place"])
                if cut:
                    drops[at] = len(cut)
                    texts[at] = "\n".join(x for i, x in enumerate(lines) if i not in cut)
            if texts:
                cut = pa.array(drops > 0)
                columns[k] = pc.replace_with_mask(columns[k], cut, pa.array(list(texts.values()), columns[k].type))
                if "n_chars" in names:
                    n = names.index("n_chars")
                    sizes = pa.array([len(x) for x in texts.values()]).cast(columns[n].type)
                    columns[n] = pc.replace_with_mask(columns[n], cut, sizes)
            yield pa.RecordBatch.from_arrays([*columns, counts, pa.array(drops)],
                                             [*names, "n_lines", "n_dropped"])

    return rows.mapInArrow(run, schema)


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = dedup(documents(spark, folder), Staging(spark))
    return rows.select("doc_id", "n_lines", "n_dropped", "text")
