import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from cleartab.llm import mixing, sharding
from cleartab.session import Staging


def draw(*parts):
    return (int(hashlib.md5("/".join(parts).encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52


def descend(key, leaves):
    for level in ("region", "rack", "shard"):
        weights = defaultdict(float)
        for x in leaves:
            weights[getattr(x, level)] += x.weight
        best = min(weights, key=lambda c: -math.log(draw(key, level, str(c))) / weights[c])
        leaves = [x for x in leaves if getattr(x, level) == best]
    return leaves[0].shard


def test_shards(spark, folder):
    docs = {r[0]: r[1] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = sharding.query(spark, folder).collect()
    leaves = sharding.standard(16)
    assert len(rows) == len(docs)
    slots = defaultdict(list)
    for r in rows:
        text = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        assert r["shard"] == descend(str(r["doc_id"]), leaves)
        assert r["grown_shard"] == descend(str(r["doc_id"]), sharding.grown(leaves))
        assert r["grown_shard"] in (r["shard"], 16)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_and_confined_movement(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    before = [sharding.Leaf(0, 0, 0), sharding.Leaf(0, 0, 1), sharding.Leaf(0, 1, 2, 2.0), sharding.Leaf(1, 2, 3, 4.0)]
    after = [*before[:3], sharding.Leaf(1, 2, 3, 6.0)]
    df = sharding.place(sharding.place(ids, ids["doc_id"], before, "old"), ids["doc_id"], after, "new")
    moves = Counter((r["old"], r["new"]) for r in df.collect())
    assert all(a == b or b == 3 for a, b in moves)  # only into the subtree that grew
    share = Counter(b for (_, b), n in moves.items() for _ in range(n))
    assert abs(share[3] / 20_000 - 0.6) < 0.02 and abs(share[2] / 20_000 - 0.2) < 0.02


def test_shards_odd(spark, odd, staging):
    rows = sharding.assign(spark, odd, sharding.standard(3), staging)
    assert rows.count() == odd.count()
    slots = defaultdict(list)
    for r in rows.collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign(spark, odd.limit(0), sharding.standard(3), Staging(spark)).count() == 0
    with pytest.raises(ValueError):
        sharding.place(odd, odd["doc_id"], [], "shard")


def test_written_shards(spark, odd, tmp_path):
    docs = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    placed = sharding.assign(spark, docs, sharding.standard(4), Staging(spark))
    sharding.write_shards(placed, docs, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()


def fill(sizes, weights, budget):
    """Targets by repeated sharing."""
    cap, full = {s: 2.0 * n for s, n in sizes.items()}, set()
    while True:
        left = budget - sum(cap[s] for s in full)
        heavy = sum(weights[s] for s in sizes if s not in full)
        over = {s for s in sizes if s not in full and left * weights[s] / heavy > cap[s]}
        if not over:
            return {s: cap[s] if s in full else left * weights[s] / heavy for s in sizes}
        full |= over


def test_mix_targets(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 1, None: 50}, {"b": 5, "a": 5, "c": 5, "d": 5}, {"x": 7}, {"x": 0, "y": 0}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        want = fill(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()))
        assert got == pytest.approx(want)


def test_mix(spark, folder):
    rows = mixing.query(spark, folder).collect()
    again = mixing.query(spark, folder).collect()
    assert sorted(rows) == sorted(again)
    source = {r[0]: r[1] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source").collect()}
    taken, target, size, largest = Counter(), {}, Counter(), Counter()
    for r in rows:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        size[s] += r["size"]
        target[s] = r["target"]
        largest[s] = max(largest[s], r["size"])
        assert r["taken"] <= 2 * r["size"]
    for s in target:
        assert abs(taken[s] - target[s]) <= 2 * largest[s]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))


def test_mix_odd(spark, odd, staging):
    rows = mixing.sample(spark, odd, staging)
    assert rows.count() == odd.count()
    sampled = {(r["doc_id"], r["source"]): r["copies"] for r in rows.filter("doc_id <> 4").collect()}
    mixed = mixing.mixed(spark, odd, Staging(spark))
    assert mixed.columns == odd.columns
    out = Counter((r["doc_id"], r["source"]) for r in mixed.filter("doc_id is null or doc_id <> 4").collect())
    assert all(out[k] == n for k, n in sampled.items())
    both = rows.filter("doc_id = 4").agg({"copies": "sum"}).first()[0]
    assert mixed.filter("doc_id = 4").count() == both
    assert mixing.mixed(spark, odd.limit(0), Staging(spark)).count() == 0
