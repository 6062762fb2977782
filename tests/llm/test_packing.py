import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cleartab.llm import best_fit, lexical_packing, tokens
from cleartab.llm.tokens import encoder


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text, add_special_tokens=False).ids, 1]


TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a \n b", "a\n \n b", "a\n\n  b\t c", "don't we'll  'x",
         " a  b", "x 　y", "東京 は 🙂🙂 x", "<|endoftext|> a <|endoftext|>", "tab\tsep \t x", "end \n", "12 345 a1b2!! ??",
         "naïve Größe", "a​ b", "́ x ́y", "\x85 a \x85", "a \x1c b"]


def test_ids(tokenizer):
    encode = encoder()
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice(" \n\tab'sé.1 ! ") for _ in range(rng.randrange(60))) for _ in range(1500)]
    for text in texts:
        assert encode(text).tolist() == tokenizer(text), repr(text)
    assert encode(None).tolist() == [1]
    tiny = encoder(entries=3)  # forgetting changes nothing
    assert all(tiny(t).tolist() == tokenizer(t) for t in TEXTS)


def check_pieces(rows, ids):
    """Every id once, gapless sequences of at most the window."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"]
    assert by_doc.keys() == ids.keys()
    for doc_id, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at
            at += p["length"]
        assert at == len(ids[doc_id])
    sizes = []
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
        sizes.append(at)
    return sizes


def test_lexical(spark, folder, tokenizer):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {r[0]: tokenizer(r[1] or "") for r in docs.select("doc_id", "text").collect()}
    rows = lexical_packing.query(spark, folder).collect()
    sizes = check_pieces(rows, ids)
    assert sum(n < 2048 for n in sizes) <= docs.rdd.getNumPartitions()


def test_lexical_across_shards(monkeypatch):
    monkeypatch.setattr(lexical_packing, "SHARD_DOCUMENTS", 3)
    rng = np.random.default_rng(0)
    docs = [(i, rng.integers(0, 40, int(n)).astype("<u4")) for i, n in enumerate([1, 9, 64, 3, 5, 8, 8, 200, 1, 2, 7, 16, 3])]
    seen = defaultdict(list)
    filled = defaultdict(int)
    for doc_id, ids, start, stop, sequence, offset in lexical_packing.packed(docs, window=16):
        assert filled[sequence] == offset
        filled[sequence] += stop - start
        seen[doc_id].append((start, stop))
    assert all(n == 16 for n in list(filled.values())[:-1])
    for doc_id, ids in docs:
        assert sorted(seen[doc_id])[0][0] == 0 and sum(b - a for a, b in seen[doc_id]) == len(ids)


def test_bm25_neighbours():
    """The index ranks as the formula does, and the like document comes first."""
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 50, 80) for _ in range(12)]
    docs[7] = np.concatenate([docs[2][:60], docs[7][:20]])
    index = lexical_packing.Index([d.astype("<u4") for d in docs])
    mean = np.mean([len(d) for d in docs])
    score = np.zeros(12)
    for t in set(docs[2].tolist()):
        df = sum(t in d for d in docs)
        for i, d in enumerate(docs):
            tf = int((d == t).sum())
            if tf:
                score[i] += np.log1p((12 - df + .5) / (df + .5)) * tf * 2.2 / (tf + 1.2 * (.25 + .75 * len(d) / mean))
    ranked = index.ranked(docs[2].astype("<u4")).tolist()
    assert ranked == np.argsort(-score, kind="stable").tolist() and ranked[:2] == [2, 7]


def test_best_fit_tree():
    """The tree finds what a plain search finds."""
    rng = random.Random(5)
    sizes = [rng.randrange(1, 65) for _ in range(400)]
    rooms, plain = [], []
    for i in sorted(range(400), key=lambda i: -sizes[i]):
        fits = [s for s in range(len(rooms)) if rooms[s] >= sizes[i]]
        tightest = min((rooms[s] for s in fits), default=64)
        plain.append(tightest)
        s = next((s for s in fits if rooms[s] == tightest), len(rooms))
        rooms = rooms + [64] if s == len(rooms) else rooms
        rooms[s] -= sizes[i]
    groups = best_fit.best_fit(sizes, 64)
    assert sorted(i for g in groups for i in g) == list(range(400))
    assert all(sum(sizes[i] for i in g) <= 64 for g in groups)
    assert sorted(64 - sum(sizes[i] for i in g) for g in groups) == sorted(rooms)


def test_best_fit(spark, folder, tokenizer):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {r[0]: tokenizer(r[1] or "") for r in docs.select("doc_id", "text").collect()}
    back = defaultdict(dict)
    for r in best_fit.pack(docs).collect():
        row, positions = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["positions"], "<u4")
        assert len(row) == 2048 and r["cu_seqlens"][-1] == r["n_tokens"] and not row[r["n_tokens"]:].any()
        for doc_id, start, a, b in zip(r["doc_ids"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            back[doc_id][start] = row[a:b].tolist()
            assert positions[a:b].tolist() == list(range(b - a))
    assert {d: sum((p[s] for s in sorted(p)), []) for d, p in back.items()} == ids


def test_odd(spark, odd, tmp_path):
    n = odd.count()
    assert lexical_packing.pack(odd).filter("start = 0").count() == n
    best_fit.write_packed(odd, str(tmp_path / "packed"))
    written = spark.read.parquet(str(tmp_path / "packed"))
    assert written.selectExpr("inline(arrays_zip(doc_ids, starts))").filter("starts = 0").count() == n
    assert lexical_packing.pack(odd.limit(0)).count() == best_fit.pack(odd.limit(0)).count() == 0
    assert tokens.SEPARATOR == 1
