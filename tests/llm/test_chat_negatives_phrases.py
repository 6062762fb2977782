"""Chat records, hard negatives and phrases against brute force, and their odd cases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cleartab.llm import chat_format, collocations, hard_negatives

SCHEMA = "conv_id long, turn long, role string, text string, part string, segments string"


def written(spark, staging, rows, template=chat_format.CHAT):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    done = chat_format.records(chat_format.segments(df, type(staging)(spark), template), template)
    back = done.withColumn("turns", chat_format.read_back(done["formatted"], template))
    return {r.conv_id: r for r in back.collect()}


def test_chat_round_trip(spark, staging):
    """Marks, escapes and line feeds in texts and roles come back as they were; the loss covers assistant texts."""
    draw = random.Random(3)
    bits = ["<|im_end|>\n", "<|im_start|>", "<\\|", "<", "|", "\\", "\n", "<|line|>", "a", "é🙂", "<\\\\|"]
    def some():
        return "".join(draw.choice(bits) for _ in range(draw.randrange(9)))
    roles = ["user", "assistant", "system", "us<|er", "a\nb", "<\n|", "x\\n"]
    rows = [(c, t, draw.choice(roles), some()) for c in range(60) for t in range(draw.randrange(1, 8))]
    got = written(spark, staging, rows)
    for c, record in got.items():
        turns = [(role, text) for conv, _, role, text in rows if conv == c]
        assert [(t.role, t.text) for t in record.turns] == turns
        assert "".join(s.text for s in record.segments) == record.formatted
        assert [s.loss for s in record.segments] == [x for role, _ in turns for x in (False, role == "assistant", False)]
        assert record.formatted.count("<|im_start|>") == record.formatted.count("<|im_end|>") == len(turns)


def test_chat_machine(spark, staging):
    def turns(c, roles):
        return [(c, i, {"s": "system", "u": "user", "a": "assistant", "x": "tool", "-": None}[r], f"t{i}") for i, r in enumerate(roles)]
    orders = {1: "sua", 2: "uaua", 3: "us", 4: "ua" * 300, 5: "uaa", 6: "au", 7: "uxa", 8: "-", 9: "s", 10: "suaua", 11: "u"}
    got = written(spark, staging, [r for c, o in orders.items() for r in turns(c, o)])
    assert {c: r.valid for c, r in got.items()} == {c: bool(re.fullmatch("s?(ua)+", o)) for c, o in orders.items()}
    own = chat_format.Template(opens="<|a|>", closes="<|z|>", trained=("user",), moves={"empty": {"user": "answered"}})
    got = written(spark, staging, [(1, 0, "user", "<|z|>")], own)[1]
    assert got.valid and got.formatted == "<|a|>user\n<\\|z|><|z|>\n" and got.segments[1].loss and got.turns[0].text == "<|z|>"
    with pytest.raises(ValueError):
        chat_format.Template(opens="[INST]")


def test_chat_parts(spark, staging):
    """One conversation over many stretches: the machine's state passes from each to the next."""
    df = spark.range(4000).selectExpr("7 AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "cast(id AS string) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = chat_format.segments(df, staging).orderBy("part").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1 and parts[0].entered == "empty" and parts[-1].left == "answered"
    assert all(a.left == b.entered for a, b in zip(parts, parts[1:]))
    assert [s.text for p in parts for s in p.segments][1::3] == [str(i) for i in range(4000)]


def test_chat_odd(spark, staging):
    """Nulls are empty, ties go by role then text, repeated rows stay, no rows give none."""
    rows = [(None, 1, "user", None), (None, None, "system", "s"), (1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"),
            (2, 1, None, None), (3, 1, "assistant", "x" * 300_000)]
    got = written(spark, staging, rows)
    told = {c: [(t.role, t.text) for t in r.turns] for c, r in got.items()}
    assert told[None] == [("system", "s"), ("user", "")] and told[2] == [("", "")] and len(told[3][0][1]) == 300_000
    assert told[1] == [("user", "a"), ("user", "a"), ("user", "b")]


def test_chat_empty(spark, staging):
    assert written(spark, staging, []) == {}


def brute_negatives(rows):
    """(anchor, positive, rank, negative, scores) by comparing everything with everything."""
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None]
    rows = [r for r in rows if all(x is not None and np.isfinite(x) for x in r[2])]
    whole = {}
    for i, label, v in rows:
        whole.setdefault(i, []).append((label, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    whole = {i: min(c) for i, c in whole.items()}
    out = set()
    for a, (label, v) in whole.items():
        if a % 100:
            continue
        score = {i: sum(p * q for p, q in zip(v, w)) for i, (_, w) in whole.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if whole[i][0] == label][:5]:
            fits = [n for n in order if whole[n][0] != label and 80 * score[p] <= 100 * score[n] <= 100 * score[p]]
            out |= {(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(fits[:5])}
    return out


def mined(spark, staging, rows):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, label int, embedding array<float>, vec string, score int")
    ready = hard_negatives.prepared(df)
    got = hard_negatives.mine(ready, ready.filter("vec_id % 100 = 0"), staging).collect()
    return {(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got}


def test_negatives(spark, staging, monkeypatch):
    """Several blocks, near vectors, ties by equal vectors, zero and negative scores, against brute force."""
    draw = np.random.default_rng(5)
    base = draw.normal(size=(30, 20))
    rows = [(int(i) * 10, int(draw.integers(4)), [float(x) for x in base[draw.integers(30)] + draw.normal(size=20) * draw.choice([0, 0.1, 1])])
            for i in range(700)]
    rows += [(7000, 9, [1.0] * 20), (7100, 9, [0.0] * 20), (7200, 8, [0.0] * 20), (7300, 8, [-1.0] * 20)]
    for blocks in ((4096, 4096), (97, 13)):
        monkeypatch.setattr(hard_negatives, "ROWS", blocks[0])
        monkeypatch.setattr(hard_negatives, "ANCHORS", blocks[1])
        assert mined(spark, type(staging)(spark), rows) == brute_negatives(rows)


def test_negatives_odd(spark, staging):
    """Nulls and what is not finite take no part, shorter vectors count as padded, of one id the least row counts."""
    rows = [(100, 1, [1.0, 0.5]), (1, 1, [1.0]), (2, 2, [0.9, 0.1]), (3, 2, [1.0, 0.0, 5.0]), (4, None, [1.0]), (5, 2, None),
            (6, 2, [float("nan"), 1.0]), (7, 1, [float("inf")]), (8, 2, [None, 1.0]), (None, 2, [1.0, 0.5]), (2, 2, [0.9, 0.1]),
            (200, 3, []), (9, 3, []), (3, 1, [0.7])]
    got = mined(spark, staging, rows)
    assert got == brute_negatives(rows) and {g[0] for g in got} == {100, 200}


def test_negatives_empty(spark, staging):
    assert mined(spark, staging, []) == set()


def test_strip_index():
    """The index finds all pairs at or above each threshold, whatever the threshold."""
    draw = np.random.default_rng(2)
    x, a = draw.integers(-300, 300, (200, 24)), draw.integers(-300, 300, (70, 24))
    x[::3] //= 50
    index, scores = hard_negatives.StripIndex(x), a @ x.T
    for t in (-1e9, 0.0, 1e5, 4e5, 1e9):
        threshold = t * draw.random(len(a))
        got = {(i, j): s for part in index.search(a, threshold) for i, j, s in zip(*(p.tolist() for p in part))}
        assert got == {(i, j): scores[i, j] for i, j in np.argwhere(scores >= threshold[:, None]).tolist()}


def brute_phrases(docs, least, top):
    n, f = Counter(), Counter()
    for lang, text in docs:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    often = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    held = {(lang, p[i:j]) for (lang, p), a in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and a >= f[lang, p[i:j]]}
    out = {}
    for (lang, p), a in often.items():
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        if (lang, p) not in held:
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    return {(lang, i + 1, p.decode(), -a, l, r, m, -s) for lang, rows in out.items() for i, (s, a, p, l, r, m) in enumerate(sorted(rows)[:top])}


def phrases(make, staging, docs, monkeypatch, least, top):
    monkeypatch.setattr(collocations, "LEAST", least)
    monkeypatch.setattr(collocations, "TOP", top)
    got = collocations.mine(make(*[(i, text, lang) for i, (lang, text) in enumerate(docs)]), staging)
    return {tuple(r) for r in got.collect()}


@pytest.mark.parametrize("top,block", [(2000, 8 << 20), (15, 900)])
def test_phrases(make, staging, monkeypatch, top, block):
    """Against brute force; with a low bound most languages settle before all words are expanded."""
    monkeypatch.setattr(collocations, "BLOCK", block)
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = []
    for i in range(120):
        words = draw.choices(vocabulary, weights, k=80)
        for _ in range(6):
            at = draw.randrange(len(words))
            words[at:at] = draw.choice(["New York City hall", "im Großen und Ganzen", "x y", "x y z", "aa aa aa"]).split()
        text = "".join(w + draw.choice([" ", " ", " ", "  ", "\t", ". ", "\n"]) for w in words)
        docs.append((draw.choice(["en", "en", "de", None]), text))
    assert phrases(make, staging, docs, monkeypatch, 12, top) == brute_phrases(docs, 12, top)


def test_phrases_odd(make, staging, monkeypatch):
    """Nulls, empty texts, control characters, one very long text, one piece longer than a block."""
    monkeypatch.setattr(collocations, "BLOCK", 500)
    docs = [("en", None), (None, ""), ("en", "  \t"), (None, "a\x00b a\x00b \x00 a"), ("en", "Aé b\x0bAé b\x0cAé\rb"),
            ("en", "a b c d e f " * 400), ("und", "a\x00b a\x00b"), ("en", "...;;!?"), ("de", "ÄB ab " * 100 + ".")]
    for least in (1, 3):
        area = type(staging)(staging.spark)
        assert phrases(make, area, docs, monkeypatch, least, 2000) == brute_phrases(docs, least, 2000)


def test_phrases_empty(make, staging, monkeypatch):
    assert phrases(make, staging, [], monkeypatch, 2, 10) == set()


def test_blocks_keep_words_whole():
    batch = pa.record_batch([pa.array(["en"] * 3), pa.array(["a b. c", "", "d" * 50 + " e;f"])], ["lang", "text"])
    words = [w.phrase(i, 1) for w in collocations._blocks(iter([batch])) for i in range(len(w.starts))]
    assert words == [b"a", b"b", b"c", b"d" * 50, b"e", b"f"]
