import itertools
import os
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from cleartab.llm import language, line_quality
from cleartab.session import Staging


def test_language(spark, folder):
    """Held-out accuracy, and the sample for learning leaves the held-out rows alone."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    truth = {r[0]: r[1] for r in docs.select("doc_id", "lang").collect()}
    rows = language.query(spark, folder).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.9


def test_held_out_rows_teach_nothing(spark, make):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    rest = [i for i in range(400) if i not in held]
    docs = make(*[(i, "alpha beta", "xx") for i in held], *[(i, "gamma delta", "yy") for i in rest[:30]],
                (rest[31], "gamma", None))
    assert language.fit(docs, Staging(spark))["languages"] == ["yy"]


def test_backoff():
    logs = lambda **k: {w.replace("_", " "): np.array(v, dtype=np.float32) for w, v in k.items()}
    model = {"languages": ["aa", "bb"], "words": logs(cat=[-1, -9], dog=[-9, -1]),
             "grams": [logs(o=[-8, -2], c=[-2, -8]), logs(do=[-9, -2], _d=[-9, -2]), logs(_ca=[-1, -7])]}
    score = language.scorer(model)
    assert score("CAT cat")[0] == "aa"            # known word
    assert score("car")[0] == "aa"                # by " ca", the longest known n-gram
    assert score("door")[0] == "bb"               # by " d" and "do"
    assert score("oxx")[0] == "bb"                # by "o"
    label, value, known = score("cat dog")
    assert known == 1.0 and score("cat door door car")[2] == 0.25
    assert label == "aa" and value == pytest.approx(0.5)  # a tie goes to the first name
    expected = 1 / (1 + math.exp(-8))
    assert score("cat")[1] == pytest.approx(expected)
    for text in (None, "", " 12 !! ", "3"):
        assert score(text) == ("und", 0.0, 0.0)


def test_fit_is_a_recount(spark, make, monkeypatch):
    """The model against counts in Python: words and n-grams of every language, the commonest of each, add-half logs."""
    monkeypatch.setattr(language, "VOCABULARY", 4)
    monkeypatch.setattr(language, "GRAMS", 7)
    texts = [("aa", "Cat dog cat. bird-cat; dog fish"), ("aa", "cat 12 owl"), ("bb", "Hund Katze hund"), ("cc", "neko inu neko tori kame tori saru uma")]
    rows = [(i, t, lang) for i, (lang, t) in enumerate(3 * texts) if zlib.crc32(str(i).encode()) % 4 != 2]
    model = language.fit(make(*rows), Staging(spark))
    languages = sorted({lang for _, _, lang in rows})
    assert model["languages"] == languages
    words = {lang: Counter() for lang in languages}
    for _, text, lang in rows:
        words[lang].update(re.sub(r"[^a-z]+", " ", text.lower()).split())

    def expected(counts, most):
        keep = {k for c in counts.values() for k, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:most]}
        sums = {lang: sum(c[k] + 0.5 for k in keep) for lang, c in counts.items()}
        return {k: [math.log((counts[lang][k] + 0.5) / sums[lang]) for lang in languages] for k in keep}

    def same(got, want):
        assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-5) for k in want)

    same(model["words"], expected(words, 4))
    for size in range(1, language.LONGEST + 1):
        grams = {lang: Counter() for lang in languages}
        for lang, c in words.items():
            for word, n in c.items():
                for i in range(len(word) + 3 - size):
                    grams[lang][f" {word} "[i:i + size]] += n
        same(model["grams"][size - 1], expected(grams, 7))


def test_rare_language_and_noise(spark, make):
    """A language of few documents keeps its words; of texts that no language of the model explains none stays."""
    common = [(i, " ".join(f"word{chr(97 + k % 26)}{chr(97 + (i * k) % 26)}" for k in range(60)), "aa") for i in range(300)]
    rare = [(1000 + i, "ni hao shijie zaijian pengyou", "zz") for i in range(8)]
    docs = make(*common, *rare, (2000, "qqqxz vvvkj wwwpq zzzrt jjjhg", None), (2001, "12 34", None), (2002, None, None))
    model = language.fit(docs, Staging(spark))
    kept = {r["doc_id"]: r for r in language.accepted(docs, model).collect()}
    assert set(kept) == {i for i, *_ in common + rare}
    assert {r["lang_pred"] for r in language.predict(docs, model).filter("doc_id between 1000 and 1999").collect()} == {"zz"}


def test_language_odd(spark, odd):
    model = language.fit(odd, Staging(spark))
    assert language.predict(odd, model).count() == odd.count()
    kept = language.accepted(odd, model)
    assert kept.schema == odd.schema and kept.filter("text is null or text = ''").count() == 0
    nothing = language.fit(odd.limit(0), Staging(spark))
    assert {r["lang_pred"] for r in language.predict(odd, nothing).collect()} == {"und"}
    assert language.predict(odd.limit(0), model).count() == 0


def brute_counts(text):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    words = word.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if word.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_quality(spark, folder):
    docs = {r[0]: r[1] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = line_quality.query(spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute_counts(docs[r["doc_id"]])
        assert tuple(r[1:6]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality").collect()}
    judged = [r for r in rows if r["doc_id"] in labels and not r["base_failed"]]
    good = [r["kept"] for r in judged if labels[r["doc_id"]] == 1]
    assert sum(good) / len(good) > 0.95
    bad = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 0]
    assert sum(bad) / max(1, len(bad)) < 0.3


def test_quality_blanks(spark, make):
    texts = ["a b c", "x\x0by\x0cz", "　", "a b c a b c", "l\nl\n \n \nl", "#1 $2 <x>", "a a a a"]
    rows = line_quality.judge(make(*enumerate(texts)), None).orderBy("doc_id").collect()
    assert [tuple(r[1:6]) for r in rows] == [brute_counts(t) for t in texts]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    for _ in range(30):
        n = int(rng.integers(1, 8))
        rows, weights, pairs = rng.normal(size=(n, 4)), rng.normal(size=4), rng.normal(size=(2, 2))
        emit = rows @ weights
        score = lambda ys: sum(e for e, y in zip(emit, ys) if y) + sum(pairs[a, b] for a, b in zip(ys, ys[1:]))
        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert tuple(line_quality.decoded(rows, weights, pairs)) == best


def test_field_learns():
    rng = np.random.default_rng(4)
    rows = []
    for k in range(60):
        x = rng.uniform(0, 0.3, size=(int(rng.integers(1, 9)), line_quality.FEATURES))
        x[:, 0], x[:, 2] = 1, x[:, 2] + (0.6 if k % 2 else 0)
        rows.append(x)
    weights, pairs = line_quality.fitted(rows, [np.full(len(x), 1 - k % 2) for k, x in enumerate(rows)])
    assert all(set(line_quality.decoded(x, weights, pairs)) == {1 - k % 2} for k, x in enumerate(rows))
    assert pairs[0, 0] + pairs[1, 1] > pairs[0, 1] + pairs[1, 0]


@pytest.fixture(scope="module")
def labelled(spark):
    """Texts with their labels: those the field is fitted on, and those held out."""
    folder = "/root/testdata/sf0.01"
    if not os.path.exists(f"{folder}/labels.parquet"):
        pytest.skip("no test tables")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.join(labels, "doc_id").filter("text is not null").select("doc_id", "text", "quality").collect()
    held = [(r["text"], int(r["quality"] > 0)) for r in rows if r["doc_id"] % 3 == 0 and r["text"].strip()]
    model = line_quality.fit(docs, labels.filter("doc_id % 3 <> 0"))
    return model, held


def share(text, model):
    rows, chars, _ = line_quality.described(text)
    return sum(c for c, label in zip(chars, line_quality.decoded(np.array(rows), *model)) if label) / sum(chars)


def test_lines_of_composed_documents(labelled):
    """Good text before, after and around a bad block, from held-out documents: lines of both kinds get their own label."""
    model, held = labelled
    draw, right = np.random.default_rng(1), []
    sides = [[[x for x in t.split("\n") if x.strip(line_quality.BLANK)][:8] for t, q in held if q == k] for k in (0, 1)]
    for _ in range(150):
        good, bad, more = (sides[k][draw.integers(len(sides[k]))] for k in (1, 0, 1))
        for parts in ((good, bad), (bad, good), (good, bad, more)):
            truth = [int(p is not bad) for p in parts for _ in p]
            rows = line_quality.described("\n".join(x for p in parts for x in p))[0]
            right += [a == b for a, b in zip(line_quality.decoded(np.array(rows), *model), truth)]
    assert np.mean(right) >= 0.9


def test_whole_documents_and_mixtures(labelled):
    """Held-out documents get their label, and a share strictly between 0 and 1 is no exception among mixtures."""
    model, held = labelled
    assert np.mean([(share(t, model) >= 0.5) == bool(q) for t, q in held]) >= 0.95
    good = next(t for t, q in held if q and t.count("\n") > 8)
    junk = "\n".join(f"BUY!!! NOW!!! ### $$$ {i} %%% ***" for i in range(30))
    assert 0 < share(good + "\n" + junk, model) < 1 and 0 < share(junk + "\n" + good, model) < 1


def test_pieces_cover_long_texts():
    rows = [[float(i)] for i in range(5000)]
    parts = line_quality.pieces(rows)
    assert len(parts) == line_quality.PIECES and parts[0][0] == [0.0] and parts[-1][-1] == [4999.0]
    assert line_quality.pieces(rows[:100]) == [rows[:64], rows[64:100]]


def test_quality_odd(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 0, 0), (10, 0, 0), (4, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = line_quality.fit(odd, labels)
    rows = line_quality.judge(odd, model)
    assert rows.count() == odd.count() and rows.filter("doc_id = 2").first()["base_failed"]
    assert line_quality.fit(odd, labels.limit(0)) is None and line_quality.fit(odd.limit(0), labels) is None
    assert line_quality.judge(odd.limit(0), model).count() == 0


def plain_scorer(model):
    """Word by word, without a table."""
    import regex

    letters, seen, nothing = regex.compile(r"[^\p{L}\p{M}]+"), {}, np.zeros(len(model["languages"]), dtype=np.float32)

    def backed_off(word):
        padded = f" {word} "
        for size in range(min(len(model["grams"]), len(padded)), 0, -1):
            grams = model["grams"][size - 1]
            if found := [grams[g] for i in range(len(padded) - size + 1) if (g := padded[i:i + size]) in grams]:
                return np.mean(found, axis=0)
        return nothing

    def of_word(word):
        if word in model["words"]:
            return model["words"][word]
        if word not in seen:
            seen[word] = backed_off(word)
        return seen[word]

    def score(text):
        counts = Counter(letters.sub(" ", text.lower()).split()) if text else Counter()
        if not any(c.isalpha() for word in counts for c in word):
            return language.UNKNOWN, 0.0, 0.0
        n = np.array(list(counts.values()), dtype=np.float64)
        total = n @ np.array([of_word(word) for word in counts], dtype=np.float64)
        known = n @ np.array([word in model["words"] for word in counts], dtype=np.float64)
        return (model["languages"][int(total.argmax())], float(1 / np.exp(np.maximum(total - total.max(), -700)).sum()),
                float(known / n.sum()))

    return score


def test_scorer_agrees_with_plain_method_in_less_time(monkeypatch):
    draw, letters = random.Random(5), "abcdeféßд\u0301"
    words = ["".join(draw.choices(letters, k=draw.randint(1, 14))) for _ in range(6_000)]
    row = lambda: np.float32([draw.uniform(-9, 0) for _ in range(3)])
    grams = [{w[:n]: row() for w in words[:900] if len(w) >= n and draw.random() < .8} for n in range(1, 5)]
    model = {"languages": ["de", "en", "ru"], "words": {w: row() for w in words[:300]}, "grams": grams}
    texts = [draw.choice([" ", ", ", "\u2003", "-"]).join(draw.choices(words, k=400)) for _ in range(150)]
    texts += [None, "", "12 !?", "\u0301", "Z", "zzz 东京", "AB\x1cab"]
    for remembered in (200_000, 50):
        monkeypatch.setattr(language, "REMEMBERED", remembered, raising=False)
        score, plain = language.scorer(model), plain_scorer(model)
        assert [score(t) for t in texts] == [plain(t) for t in texts]
    monkeypatch.undo()
    spent = []
    for make_scorer in (language.scorer, plain_scorer):
        score, start = make_scorer(model), time.process_time()
        for t in texts:
            score(t)
        spent.append(time.process_time() - start)
    assert spent[0] < 0.8 * spent[1]
