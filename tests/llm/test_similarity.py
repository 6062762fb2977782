import hashlib
import itertools
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from cleartab.llm import graph, line_dedup, mixing, ngram_join, secret_ledger, simhash, trie
from cleartab.session import Staging


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(1, 120)]
    star = [(500, i) for i in range(501, 700)]
    noise = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(110)]
    pairs = path + star + noise + [(7, 7), (2, 1)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["component"] for r in graph.components(df, Staging(spark), "g").collect()}
    want = groups(pairs, {n for p in pairs if p[0] != p[1] for n in p})
    assert got == want
    assert graph.components(df.limit(0), Staging(spark), "g").count() == 0


def word_set(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_join(docs):
    sets = {i: word_set(t) for i, t in docs.items()}
    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    near = {(a, b) for ids in where.values() for a in ids for b in ids if a < b}
    links = [(a, b) for a, b in near if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in groups(links, docs).items()}


def test_join(spark, folder):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.query(spark, folder).collect()}
    assert got == brute_join(docs)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


@pytest.mark.parametrize("block,pruned", [(3, True), (128, False)])
def test_join_around_the_threshold(spark, make, monkeypatch, block, pruned):
    """Texts of all sizes with few edits, many of them near 90 %; hot groups cut into blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng, docs = random.Random(9), {}
    for size in (1, 2, 3, 5, 9, 12, 14, 20, 31, 32, 60, 100, 150, 333, 800):
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        for _ in range(14):
            docs[len(docs)] = edited(rng, base, rng.randrange(0, 1 + size // 25 + (size > 8)))
        docs[len(docs)] = " ".join(base + base[:2]).upper()
    docs |= {900: None, 901: "", 902: " \n", 903: docs[3]}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in ngram_join.join(make(*docs.items()), Staging(spark), pruned=pruned).collect()}
    assert got == brute_join(docs)


@pytest.mark.parametrize("often,cells", [(1, 200), (2, 64_000_000), (16, 200)])
def test_join_in_two_rounds(spark, make, monkeypatch, often, cells):
    """Large clusters of one component, of several and of near misses, by keys of few and of many sets."""
    for name, value in (("BLOCK", 4), ("FEW", 2), ("OFTEN", often), ("HELD", 300)):
        monkeypatch.setattr(ngram_join, name, value)
    monkeypatch.setattr(trie, "CELLS", cells)
    rng, docs = random.Random(5), {}
    for size, most in ((80, 1), (150, 3), (150, 9), (40, 2), (60, 4), (12, 1)):
        base = [f"w{rng.randrange(3000)}" for _ in range(size)]
        for _ in range(25):
            docs[len(docs)] = edited(rng, base, rng.randrange(0, 1 + most))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in ngram_join.join(make(*docs.items()), Staging(spark)).collect()}
    assert got == brute_join(docs)


class Counted(Staging):
    """Notes the rows of its tables."""

    def table(self, df, name):
        out = super().table(df, name)
        self.rows = getattr(self, "rows", {}) | {name: out.count()}
        return out


@pytest.mark.parametrize("percent,n,pruned", [(90, 3, False), (80, 5, True)])
def test_join_keeps_unlike_texts_apart(spark, make, percent, n, pruned):
    """Texts that share a passage only are no candidates: clusters of them would grow with the corpus. Nor are repeats."""
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(12)]
    texts = [" ".join([f"w{rng.randrange(10 ** 9)}" for _ in range(rng.randrange(40, 90))] + passage) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts + texts[:150] * 2)]
    staging = Counted(spark)
    got = ngram_join.join(make(*rows), staging, percent, n, pruned).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: texts.index(t) for i, t in rows}
    assert staging.rows["clusters"] == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_keys_of_unlike_sets_differ(percent):
    """Empty segments are no keys."""
    rng = np.random.default_rng(3)
    seen = set()
    for _ in range(1500):
        grams = np.unique(rng.integers(0, 2 ** 63, int(rng.integers(3, 50))).astype(np.uint64) * np.uint64(2))
        keys = set(ngram_join.segment_keys(grams, percent))
        assert keys.isdisjoint(seen)
        seen |= keys


def test_join_without_ids(spark, make):
    """Links through a row whose id is null count."""
    base = [f"w{i}" for i in range(60)]
    a, b, c = base, base[:-2] + ["x", "y"], ["p", "q"] + base[2:-2] + ["x", "y"]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(
        make((3, " ".join(a)), (None, " ".join(b)), (5, " ".join(c)), (9, "other words here")), Staging(spark)).collect()}
    near = lambda p, q: 100 * len(word_set(" ".join(p)) & word_set(" ".join(q))) >= 90 * len(word_set(" ".join(p)) | word_set(" ".join(q)))  # noqa: E731,E501
    assert near(a, b) and near(b, c) and not near(a, c)
    assert got == {3: 3, None: 3, 5: 3, 9: 9}


def test_join_odd(spark, odd, make, staging):
    rows = ngram_join.join(odd, staging).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r["component_id"] for r in rows}
    assert by[4] == by[1] == by[7] == 1 and by[2] == 2 and by[3] == 3
    kept = ngram_join.representatives(odd, Staging(spark))
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2, 3, 5, 6, 8, 9, 10]
    assert ngram_join.join(odd.limit(0), Staging(spark)).count() == 0


def test_trie_finds_all_links():
    rng = np.random.default_rng(1)
    for trial in range(40):
        base = np.sort(rng.choice(200, 40, replace=False)).astype(np.uint64)
        sets = []
        for _ in range(int(rng.integers(1, 14))):
            keep = base[rng.random(len(base)) > rng.choice([0, 0.03, 0.1, 0.4])]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 200, int(rng.integers(0, 4))).astype(np.uint64)])))
        near = lambda a, b, p: 100 * len(np.intersect1d(a, b)) >= p * len(np.union1d(a, b)) and len(a) and len(b)
        for percent in (60, 90):
            want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if near(sets[i], sets[j], percent)}
            assert set(trie.linked(sets, None, percent)) == want
            left, right = sets[::2], sets[1::2]
            want = {(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if near(a, b, percent)}
            assert set(trie.linked(left, right, percent)) == want


@pytest.mark.parametrize("percent", [80, 90])
def test_prefixes_and_segments_lose_no_link(percent):
    """Linked sets, down to the threshold, keep enough of their prefixes by each other alone, and share a segment."""
    rng = np.random.default_rng(8)
    for size in (*range(1, 60), 100, 250, 1000):
        a = np.unique(rng.integers(0, 2 ** 63, size).astype(np.uint64) * np.uint64(2))
        b = a
        while len(b):
            other = np.unique(np.concatenate([b[1:] if rng.random() < 0.5 else b[:-1] if rng.random() < 0.3 else b,
                                              rng.integers(0, 2 ** 63, rng.integers(0, 2)).astype(np.uint64)]))
            common = len(np.intersect1d(a, other))
            if 100 * common < percent * (len(a) + len(other) - common):
                break
            b = other
            both = len(np.intersect1d(ngram_join.prefix(a, percent), ngram_join.prefix(b, percent)))
            assert ngram_join.may_be_linked(len(a), both, percent) and ngram_join.may_be_linked(len(b), both, percent)
            if len(a) != len(b) or (a != b).any():
                assert set(ngram_join.segment_keys(a, percent)) & set(ngram_join.segment_keys(b, percent))


def brute_simhash(terms):
    import struct
    total, ones = len(terms), [0] * 64
    for h in terms:
        (u,) = struct.unpack("<Q", struct.pack("<q", h))
        for i in range(64):
            ones[i] += u >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > total)


def test_simhash(spark, folder):
    docs = {r[0]: r[1] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = {r["doc_id"]: r for r in simhash.query(spark, folder).collect()}
    assert rows.keys() == docs.keys()
    ids = sorted(docs)
    following = {d: ids[k - 1] for k, d in enumerate(ids)}
    like = lambda a, b: 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 64
    edits = {}
    for d, text in docs.items():
        half = len(text) // 2
        edits[d] = text[:len(text) - half] + docs[following[d]][:half]
        r = rows[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edits[d].encode()).hexdigest())
        assert r["near_edited"] == like(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == like(r["fingerprint"], rows[following[d]]["fingerprint"])
        if d % simhash.QUERY_EVERY == 0:
            near = {i for i, x in rows.items() if like(r["fingerprint"], x["fingerprint"]) >= 1 - 3 / 64}
            assert r["n_within"] == len(near) - 1
            assert r["near_classes"] == sorted({rows[i]["class_id"] for i in near})
        assert r["class_id"] == min(i for i, x in rows.items() if x["fingerprint"] == r["fingerprint"])
    mean = lambda c: sum(r[c] for r in rows.values()) / len(rows)
    assert mean("near_edited") > mean("near_next") + 0.08
    some = sorted(docs)[:40]
    from pyspark.sql import functions as F
    texts = spark.createDataFrame([(d, docs[d], edits[d]) for d in some], "doc_id long, a string, b string")
    for r in texts.select("doc_id", simhash.terms(F.col("a")).alias("a"), simhash.terms(F.col("b")).alias("b")).collect():
        assert int(rows[r["doc_id"]]["fingerprint"], 16) == brute_simhash(r["a"] or [])
        assert int(rows[r["doc_id"]]["edited_fingerprint"], 16) == brute_simhash(r["b"] or [])


def test_block_tables_find_all(spark):
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for bits in range(1, 6):
            q = p
            for b in rng.sample(range(64), bits):
                q ^= 1 << b
            prints.add(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    got = [tuple(r) for r in simhash.neighbours(df, df).collect()]
    want = {(a, b) for a in signed for b in signed if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 3}
    assert len(got) == len(set(got)) and set(got) == want


def test_simhash_odd(spark, odd, staging):
    rows = simhash.compare(spark, odd, staging).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["fingerprint"] == by[4]["fingerprint"] and by[2]["fingerprint"] == by[3]["fingerprint"] == 0
    assert by[None]["edited_sha256"] == hashlib.sha256(
        ("a text without id"[:9] + "A line that is long enough\n"[:8]).encode()).hexdigest()
    prose = {r["doc_id"]: r["text"] for r in odd.collect()}[1]
    half = len(prose) // 2  # the least known id is followed by the null one
    assert by[1]["edited_sha256"] == hashlib.sha256((prose[:len(prose) - half] + "a text without id").encode()).hexdigest()
    assert simhash.compare(spark, odd.limit(0), Staging(spark)).count() == 0
    one = simhash.compare(spark, odd.filter("doc_id = 1"), Staging(spark)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def brute_lines(docs, percent=80):
    """Exact components over all lines that take part; the first of each stays."""
    places = [(d, i, n) for d in sorted(docs) for i, n in line_dedup.eligible(docs[d])]
    lines, links, sets = {n for _, _, n in places}, [], {}
    for width in (4, 8):
        sets[width] = {n: {n[k:k + width] for k in range(max(1, len(n) - width + 1))} for n in lines}
        where = defaultdict(set)
        for n, s in sets[width].items():
            for g in s:
                where[g].add(n)
        near = {(a, b) for ns in where.values() for a in ns for b in ns if a < b}
        near = [(a, b) for a, b in near if (min(len(a), len(b)) >= 80) == (width == 8)]
        links += [(a, b) for a, b in near
                  if 100 * len(sets[width][a] & sets[width][b]) >= percent * len(sets[width][a] | sets[width][b])]
    sets = dict.fromkeys(lines)
    of, seen, gone = groups(links, sets), set(), defaultdict(set)
    for d, i, n in places:
        if of[n] in seen:
            gone[d].add(i)
        seen.add(of[n])
    return gone


def test_lines(spark, make):
    rng, docs = random.Random(6), {}
    bases = ["".join(rng.choice("abcdefghij ") for _ in range(rng.randrange(30, 200))) for _ in range(12)]
    for d in range(60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            line = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                line[rng.randrange(len(line))] = rng.choice("xyz")
            lines.append("".join(line))
        docs[d] = "\n".join(lines + ["short", "", f"{rng.random()} unique {rng.random()}"])
    want = brute_lines(docs)
    rows = {r["doc_id"]: r for r in line_dedup.dedup(make(*docs.items()), Staging(spark)).collect()}
    dropped = {d: rows[d]["n_dropped"] for d in docs}
    assert sum(dropped.values()) >= 0.95 * sum(len(p) for p in want.values())
    for d, text in docs.items():  # never more than the exact components say
        lines = text.split("\n")
        assert dropped[d] <= len(want[d]) or not want[d] and not dropped[d]
        assert rows[d]["n_lines"] == len(lines) and ("short" in rows[d]["text"].split("\n")) == (d == 0)
        assert lines[-1] in rows[d]["text"].split("\n")


@pytest.mark.parametrize("block", [3, 128])
def test_lines_around_one(spark, make, monkeypatch, block):
    """Variants that are like the common line but not like each other all go, whatever their hashes."""
    monkeypatch.setattr(line_dedup._unsettled, "__defaults__", (block,))
    rng, docs = random.Random(11), {}
    line = "".join(rng.choice("abcdefghijklmnop") for _ in range(200))
    for d in range(101):
        text = list(line)
        for k in rng.sample(range(200), 2 * (d > 0)):
            text[k] = rng.choice("uvwxyz")
        docs[d] = "".join(text)
    want = brute_lines(docs)
    rows = line_dedup.dedup(make(*docs.items()), Staging(spark)).collect()
    assert len(want) == 100 and sum(r["n_dropped"] for r in rows) >= 97


def test_banding_recall():
    """Lines at the threshold and above meet in some band nearly always."""
    rng = random.Random(4)
    hits = trials = 0
    for _ in range(300):
        a = "".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(80, 300)))
        b = list(a)
        for _ in range(max(1, len(a) // 150)):
            b[rng.randrange(len(b))] = "z"
        b = "".join(b)
        sets = [{x[k:k + 8] for k in range(len(x) - 7)} for x in (a, b)]
        if len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1]):
            keys = line_dedup.band_keys([a, b], 8)
            trials += 1
            hits += bool(set(keys[0]) & set(keys[1]))
    assert trials > 100 and hits / trials > 0.97


def test_recall_over_documents(spark, folder):
    """All lines of the smallest documents, each also with one edit, from 5 characters on: links found, against brute force."""
    rng, docs = random.Random(8), {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(60).collect():
        lines = [x for x in (r["text"] or "").split("\n")][:25]
        docs[2 * r["doc_id"]] = "\n".join(lines)
        cut = [x[:rng.randrange(5, 120)] for x in lines]
        docs[2 * r["doc_id"] + 1] = "\n".join(c for x in cut for c in (x, x[:len(x) // 2] + rng.choice("qz") + x[len(x) // 2 + 1:], x + "!"))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    want = sum(len(p) for p in brute_lines(docs).values())
    got = sum(r["n_dropped"] for r in line_dedup.dedup(frame, Staging(spark)).collect())
    assert 0.95 * want <= got <= want and want > 500


def test_lines_without_ids(spark, make):
    """Links between rows whose id is null, and through them, are found by content."""
    base = "the quick brown fox jumps over the lazy dog and runs away from it as fast as it can "
    texts = [base + "again", base + "again.", base + "again!", "short", "short"]
    rows = line_dedup.dedup(make(*[(None, t) for t in texts]), Staging(spark)).collect()
    assert sum(r["text"] == "" for r in rows) == sum(r["n_dropped"] for r in rows) == 2
    mixed = line_dedup.dedup(make((1, texts[0]), (None, texts[1]), (2, texts[2])), Staging(spark)).collect()
    assert sum(r["n_dropped"] for r in mixed) == 2


def test_clashing_names(spark, odd, staging):
    """Columns that have the names the operators use inside."""
    clash = odd
    for name in ("n_lines", "n_dropped", "_places", "_id", "_kept", "_text", "_row", "_a", "_b", "_n", "_k", "_turn", "_copies",
                 "_copy", "findings", "blob", "keys", "node", "_part", "_rank", "content", "grams"):
        clash = clash.withColumn(name, F.lit(name))
    clash = staging.table(clash, "clash")
    rows = line_dedup.dedup(clash, Staging(spark))
    assert rows.count() == odd.count() and rows.filter("_places = '_places' and n_dropped >= 0").count() == odd.count()
    kept = ngram_join.representatives(clash, Staging(spark))
    assert kept.columns == clash.columns and 0 < kept.count() < odd.count()
    mix = mixing.mixed(spark, clash, Staging(spark))
    assert mix.columns == clash.columns and mix.filter("_a <> '_a' or _row <> '_row'").count() == 0 < mix.count()
    ledger = secret_ledger.update(spark, clash, f"{staging.root}/ledger")
    assert secret_ledger.findings(clash, ledger).filter("size(findings) >= 0 and length(blob) = 64").count() == odd.count()


def test_very_long_line(spark, make):
    """A line longer than any chunk, a near copy of it, and the same as part of another text."""
    line = " ".join(f"w{i * 7919 % 100003}" for i in range(150_000))
    docs = {1: line, 2: line[:-3] + "xyz", 3: "other\n" + line.upper(), 4: "something else altogether here"}
    rows = {r["doc_id"]: r for r in line_dedup.dedup(make(*docs.items()), Staging(spark)).collect()}
    assert [rows[i]["n_dropped"] for i in (1, 2, 3, 4)] == [0, 1, 1, 0] and rows[3]["text"] == "other"


def test_lines_odd(spark, odd, make, staging):
    rows = line_dedup.dedup(odd, staging)
    assert rows.columns == [*odd.columns, "n_lines", "n_dropped"] and rows.count() == odd.count()
    by = {r["doc_id"]: r for r in rows.collect()}
    assert by[2]["text"] is None and by[2]["n_lines"] == 0 and by[1]["n_dropped"] == 0 and by[7]["text"] == ""
    assert by[10]["n_dropped"] == 4 and by[10]["n_chars"] == len(by[10]["text"])
    assert line_dedup.dedup(odd.limit(0), Staging(spark)).count() == 0


def test_shingle_sets_agree_with_unique_in_less_time():
    """Sets of many lines made in chunks are those of each line by itself."""
    draw = random.Random(8)
    lines = ["".join(draw.choices("ab \u00e9\U0001f642", k=draw.choice([1, 4, 5, 9, 300, 700]))) for _ in range(3_000)] + ["x" * 70_000, ""]
    spent = []
    for width in (line_dedup.LONG, line_dedup.SHORT):
        start = time.process_time()
        sets = line_dedup.shingle_sets(lines, width)
        middle = time.process_time()
        plain = [np.unique(line_dedup.shingles([x], width)[0]) for x in lines]
        spent.append((middle - start, time.process_time() - middle))
        assert len(sets) == len(plain) and all(np.array_equal(a, b) for a, b in zip(sets, plain))
    assert sum(a for a, _ in spent) < 0.8 * sum(b for _, b in spent)
    assert line_dedup.shingle_sets([], 4) == []


def plain_alike(x, y, percent=80):
    width = 8 if min(len(x), len(y)) >= 80 else 4
    a, b = ({z[k:k + width] for k in range(max(1, len(z) - width + 1))} for z in (x, y))
    return 100 * len(a & b) >= percent * len(a | b)


def variants(draw, n):
    """Lines of 5 to 200 characters, some of few letters, each with a near copy."""
    out = []
    for _ in range(n):
        line = "".join(draw.choices(draw.choice(["ab", "abcdefgh é\U0001f642"]), k=draw.choice([5, 9, 60, 79, 80, 81, 99, 104, 105, 200])))
        at = draw.randrange(len(line))
        out += [line, line[:at] + draw.choice(["", "z", "ab", line[at] * 3]) + line[at + 1:]]
    return out


def test_many_lines_compared_in_one_pass(monkeypatch):
    """Pairs and small groups give what sets give, whatever the chunks, in less time than one pair after the other."""
    draw = random.Random(12)
    lines = [x + "zzzzz"[len(x):] for x in variants(draw, 400)] + ["ab" * 40_000, "ab" * 30]
    pairs = [(lines[k], lines[k ^ 1]) for k in range(len(lines))] + [tuple(draw.sample(lines, 2)) for _ in range(400)]
    want = [plain_alike(x, y) for x, y in pairs]
    start = time.process_time()
    assert line_dedup.alike(pairs, 80).tolist() == want and 300 < sum(want) < len(want)
    middle = time.process_time()
    assert [bool(line_dedup.alike([pair], 80)[0]) for pair in pairs] == want
    assert middle - start < 0.5 * (time.process_time() - middle)
    groups = [[x for x in lines[k:k + n]] for k, n in zip(range(0, 700, 9), itertools.cycle([1, 2, 4, 8, 30]))]
    for cells in (7, line_dedup.CELLS):
        monkeypatch.setattr(line_dedup, "CELLS", cells)
        for group, got in zip(groups, line_dedup.near(groups, 80), strict=True):
            np.fill_diagonal(got, True)
            assert got.tolist() == [[x == y or plain_alike(x, y) for y in group] for x in group]
    assert line_dedup.alike([], 80).tolist() == line_dedup.near([], 80) == []


@pytest.mark.parametrize("combined", [5, 1 << 20])
def test_band_keys_are_shuffled_as_arrays(spark, make, monkeypatch, combined):
    """Shared keys with their least and greatest lines, as by grouping single keys, which are no rows of any shuffle."""
    monkeypatch.setattr(line_dedup, "COMBINED", combined)
    draw, plans = random.Random(13), {}
    docs = make(*[(i, "\n".join(draw.sample(variants(random.Random(i % 9), 8), 9) + ["x"])) for i in range(40)], (None, None))
    table = Staging.table
    monkeypatch.setattr(Staging, "table", lambda self, df, name: [
        plans.setdefault(name, df._jdf.queryExecution().toString()), table(self, df, name)][1])
    line_dedup.repeats(docs, Staging(spark)).collect()
    assert "explode" not in plans["shared"].lower()
    want = defaultdict(set)
    for r in docs.collect():
        for _, x in line_dedup.eligible(r["text"]):
            for key in line_dedup.all_keys([x])[0].tolist():
                want[key].add(line_dedup.mark(x))
    got = {r["key"]: (r["least"], r["most"]) for r in line_dedup._met(line_dedup._lines(docs)).collect()}
    assert got == {k: (min(v), max(v)) for k, v in want.items() if len(v) > 1} and len(got) > 50
