import math
import random
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np

import corpus_pipeline
from cleartab.llm import language, queries, sql
from cleartab.session import Staging
from tests.compare import connect, differences
from cleartab.llm.tokens import encoder
from tests.llm.test_similarity import brute_lines, edited, groups, word_set


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    staging, columns = Staging(spark), docs.columns
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staging.table(stage(spark, docs, folder), name)
        counts[name] = docs.count()
        if name != "packing":
            assert docs.columns == columns
    assert counts["language"] >= counts["line_dedup"] >= counts["ngram_join"] > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "ngram_join", "mixing", "packing"]


def test_near_copies(spark, make):
    """The stage keeps one of each group at five words and 0.8, as brute force has them."""
    rng, docs = random.Random(5), {}
    for size in (6, 14, 40, 150, 400):
        for _ in range(4):
            base = [f"w{rng.randrange(5000)}" for _ in range(size)]
            for k in (0, 1, 2, 4, 6, 8):
                docs[len(docs)] = edited(rng, base, k * size // 150 + (k > 0))
            cut = rng.randrange(1, 2 + size // 8)
            docs[len(docs)] = " ".join(base[:size // 2] + base[size // 2 + cut:])

    def roots(n, percent):
        sets = {i: word_set(t, n) for i, t in docs.items()}
        near = [(a, b) for a in docs for b in docs if a < b
                and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        return set(groups(near, docs).values())

    kept = corpus_pipeline.join_near_copies(spark, make(*docs.items()), "")
    assert {r["doc_id"] for r in kept.collect()} == roots(5, 80)
    assert len(roots(5, 80)) < len(roots(3, 90)) - 5


def plain_scores(text, model):
    """(language, known share) by adding up logs word after word."""
    import re
    words = re.sub(r"[^a-zà-ÿ]+", " ", text.lower()).split()
    total = [0.0] * len(model["languages"])
    for word in words:
        value = model["words"].get(word)
        for size in range(4, 0, -1):
            if value is None:
                found = [model["grams"][size - 1][g] for i in range(len(word) + 3 - size) if (g := f" {word} "[i:i + size]) in model["grams"][size - 1]]
                value = sum(found) / len(found) if found else None
        total = [a + float(b) for a, b in zip(total, value if value is not None else total)] if value is not None else total
    return total, sum(w in model["words"] for w in words) / max(1, len(words)), words


def test_every_stage_against_brute_force(spark, make, tmp_path):
    """Each stage on what the one before kept, against a plain version of it; sources hot, copies, repeated lines, noise."""
    rng, rows = random.Random(12), []
    for i in range(260):
        lang = "abc"[i % 3]
        words = [lang + "".join(rng.choice("aeiou" + lang) for _ in range(4)) for _ in range(rng.randrange(60, 160))]
        lines = [" ".join(words[k:k + 25]) for k in range(0, len(words), 25)]
        if i % 4 == 0:
            lines.insert(1, "a line that many of these documents share with each other, word for word")
        text = "\n".join(lines)
        if i % 13 == 5 and rows:
            text = rows[-1][1].replace(" ", "  ", 1) + " extra"
        rows.append((i, text, lang * 2, rng.choice(["hot", "hot", "hot", "b", None])))
    rows += [(900, "12 34 !!", "aa", "b"), (901, None, "aa", "b"), (902, "zzzzz yyyyy xxxxx wwwww vvvvv", None, "b")]
    docs, staging = make(*rows), Staging(spark)
    stages = dict(corpus_pipeline.STAGES)

    def after(name, df):
        out = staging.table(stages[name](spark, df, ""), name)
        return out, out.collect()

    model = language.fit(docs, Staging(spark))
    kept = []
    for i, text, *_ in rows:
        total, known, words = plain_scores(text or "", model)
        odds = [math.exp(max(x - max(total), -700)) for x in total]
        if words and known >= language.LEAST_KNOWN and max(odds) / sum(odds) >= language.LEAST_SCORE:
            kept.append(i)
    docs, got = after("language", docs)
    assert sorted(r["doc_id"] for r in got) == kept and 900 not in kept and 902 not in kept

    texts = {r["doc_id"]: r["text"] for r in got}
    gone = brute_lines(texts)
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in texts.items()}
    docs, got = after("line_dedup", docs)
    assert {r["doc_id"]: r["text"] for r in got} == {i: t for i, t in want.items() if t.strip()}

    sets = {r["doc_id"]: word_set(r["text"], 5) for r in got}
    near = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    docs, got = after("ngram_join", docs)
    assert {r["doc_id"] for r in got} == set(groups(near, sets).values())

    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    names = [d[0] for d in con.execute(sql.ORACLES["op5_systematic_mix"]).description]
    wanted = Counter()
    for row in con.fetchall():
        row = dict(zip(names, row))
        wanted[row["doc_id"]] = row["taken"] // row["size"]
    docs, got = after("mixing", docs)
    assert Counter(r["doc_id"] for r in got) == +wanted

    encode, ids = encoder(), {r["doc_id"]: r["text"] for r in got}
    pieces = after("packing", docs)[1]
    for i, n in Counter(r["doc_id"] for r in got).items():
        whole = encode(ids[i]).tolist()
        mine = [p for p in pieces if p["doc_id"] == i]
        assert sum(p["length"] for p in mine) == n * len(whole) and {p["doc_tokens"] for p in mine} == {len(whole)}
        assert all(p["ids_crc32"] == zlib.crc32(np.array(whole[p["start"]:p["start"] + p["length"]], dtype="<u4").tobytes()) for p in mine)
        covered = Counter(k for p in mine for k in range(p["start"], p["start"] + p["length"]))
        assert set(covered.values()) == {n} and len(covered) == len(whole)
    filled = Counter()
    for p in pieces:
        filled[p["sequence_id"]] += p["length"]
    assert max(filled.values()) <= 2048


def test_pipeline_empty_and_odd(spark, odd, tmp_path):
    for name, df in (("odd", odd), ("none", odd.limit(0))):
        df.write.parquet(str(tmp_path / name / "documents.parquet"))
        rows = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert bool(rows) == (name == "odd")


def test_sql(spark, folder):
    con = connect(folder)
    for name, text in sql.ORACLES.items():
        assert differences(queries.QUERIES[name](spark, folder), con, text) == []


def test_entry_without_the_subpackage(tmp_path):
    """The rest imports and offers its queries when the subpackage is gone."""
    root = Path(__file__).parents[2]
    for part in ("__spark_entry__.py", "cleartab"):
        (tmp_path / part).symlink_to(root / part) if part.endswith(".py") else (tmp_path / part).mkdir()
    for part in (root / "cleartab").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "cleartab" / part.name).symlink_to(part)
    code = "import __spark_entry__ as e; n = e.queries(); assert n and not any(k.startswith('op1_') for k in n)"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path)},
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
