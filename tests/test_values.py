"""Golden rows of the column rules."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from cleartab.codebooks import courts, mortality, notifications, survey
from cleartab.functions import codes, dates, jsonfields, lists, text

DAY = dt.date


def test_date_two_formats(values):
    assert values(dates.date_two_formats, [
        "20200228", "2020-02-28", "20200230", "2020", " 20200228 ", "2020/2/8", "2020-02/28", "x", "", None,
        "2020-02-28 10:15:00", "2020-02-28x"]) == [
        DAY(2020, 2, 28), DAY(2020, 2, 28), None, None, DAY(2020, 2, 28), DAY(2020, 2, 8), None, None, None, None,
        DAY(2020, 2, 28), None]


def test_date_three_formats(values):
    def rule(c):
        return dates.within_years(dates.date_three_formats(c), 1990, 2026)
    assert values(rule, [
        "20200228101500", "2020-02-28T10:15:00.000Z", "1582848000000", "1582848000", "19891231000000",
        "20200230000000", "20200228101500\n", "20200228250000", None]) == [
        DAY(2020, 2, 28), DAY(2020, 2, 28), DAY(2020, 2, 28), None, None, None, None, None, None]


def test_year_in_number(values):
    assert values(lambda c: dates.year_in_number(c, 1990, 2026), [
        "00012345620158260001", "0001234562015826000", "00012345618008260001", None]) == [2015, None, None, None]


def test_age(values):
    assert values(codes.age_in_years, ["4025", "4120", "4121", "3006", "1005", "5010", "402", "A025", "4025\n", None]) == [
        25, 120, None, 0, 0, None, None, None, None, None]


def test_text(values):
    assert values(lambda c: text.zero_pad(c, 6), ["11001", "1234567", "", None]) == ["011001", "1234567", "000000", None]
    assert values(text.strip_leading_zeros, ["007", "000", "", "10"]) == ["7", "0", "0", "10"]
    assert values(lambda c: text.strip_leading_zeros(c, True), ["007", "000", ""]) == ["7", "0", None]
    assert values(text.clean_text, [" a\r\n\tb   c ", None, "  "]) == ["a b c", "", ""]
    assert values(text.drop_cross_reference, ["Idade (Ver VD_IDADE)\n atual", "Cor ( ver nota )"]) == ["Idade atual", "Cor"]
    assert values(text.null_placeholder, ["nan", "NaT", "", "<NA>", "NA", "x", None]) == [None, None, None, None, "NA", "x", None]
    assert values(text.normal_code, [" 11 ", "\t7\n", None]) == ["11", "7", ""]
    assert values(text.whole_number_text, [1.0, 1.5, None, -3.0], "double") == ["1", "1.5", None, "-3"]
    assert values(text.try_integer, ["12.0", "12.6", "-2.5", "x", "", " 7 ", "1e3"]) == [12, 13, -3, None, None, 7, 1000]
    assert values(text.implied_decimals, ["00012345678901", "", "x"]) == [123.45678901, None, None]


def test_slug_on_values_and_names(values):
    samples = ["Em que estado você mora?", "  Ção--Ñandú ", "???", "Straße ½ ﬁm", "été", "ÀÉÎÕÜ ç", "nº 1ª"]
    assert values(text.slug, samples) == [text.slug_name(s) for s in samples]
    assert text.slug_name("Em que estado você mora?") == "em_que_estado_voce_mora"


def test_json_values(values):
    def integers(c):
        return jsonfields.json_integers(c, "codigo")
    assert values(integers, [
        '[{"codigo":1},[{"codigo":"2"}],{"codigo":null},{"codigo":"x"}]', '[[[{"codigo":1}],{"codigo":2}],{"codigo":3}]',
        '{"codigo":5}', "[]", "null", "7", "x", None, '[{"codigo":1}', '[{"nome":"a"}]', '[null,{"codigo":2}]',
        ' [{"codigo": 12.6}] ']) == [
        [1, None, None, 2], [3, 2, 1], [5], [], [], [], None, None, None, [], [2], [13]]
    assert values(lambda c: jsonfields.json_values(c, "nome"), ['[{"nome":"a \\"b\\" ç"},{"codigo":1}]']) == [['a "b" ç']]
    assert values(integers, [
        "[" * 9 + '{"codigo":1}' + "]" * 9, '[{"codigo":1,"filho":{"codigo":2}}]', '[[[[[[[{"codigo":9}]],{"codigo":8}]]]]]',
        '{"b":[{"codigo":3},{"codigo":{"codigo":4}}],"codigo":7}', '[{"a":"[{\\"codigo\\":4}]"}]', '{"codigo":5,"n":"[x {"}']) == [
        [1], [1, 2], [8, 9], [7, 3, None, 4], [], [5]]
    assert values(lambda c: jsonfields.json_integer(c, "k"), ['{"k":"3550308.0"}', '{"k":3550308}', '{"k":null}', "x", None]) == [
        3550308, 3550308, None, None, None]


def test_json_brackets_in_strings(values):
    def integers(c):
        return jsonfields.json_integers(c, "codigo")
    assert values(integers, [
        '[{"nome":"a\\\\","filho":[[[{"codigo":1}]]]}]', '[{"nome":"}","f":{"codigo":2}}]',
        '[{"codigo":1,"nome":"a}b","f":{"codigo":2}}]', '[{"nome":"\\"}{","codigo":3},{"nome":"]\\\\\\""},{"codigo":4}]',
        '[{"codigo":"}"},{"nome":"{[","codigo":5}]', '[{"a\\"{":{"codigo":6}}]', '{"nome":"x\\\\","f":[[{"codigo":7}]]}']) == [
        [1], [2], [1, 2], [3, 4], [None, 5], [6], [7]]


def test_json_random(values):
    """Nested values with escapes and brackets in every string, against a walk in Python."""
    draw = random.Random(7)

    def name():
        return "".join(draw.choice(['"', "\\", "{", "}", "[", "]", "a", "é", "\n", "/", ","]) for _ in range(draw.randrange(5)))

    def value(depth):
        kind = draw.randrange(6 if depth else 3)
        if kind < 3:
            return [draw.randrange(100), name(), None][kind]
        if kind == 3:
            return [value(depth - 1) for _ in range(draw.randrange(4))]
        keys = [k for k in {name(): 0, "codigo": 1, name() + "x": 2} if k != "codigo" or draw.random() < 0.8]
        return {k: draw.randrange(100) if k == "codigo" and draw.random() < 0.8 else value(depth - 1) for k in keys}

    def codes(root):
        level, found = [root] if isinstance(root, dict) else root, []
        while level:
            found += [x["codigo"] for x in level if isinstance(x, dict) and "codigo" in x]
            level = [y for x in level if isinstance(x, (dict, list))
                     for y in (x if isinstance(x, list) else [x[k] for k in sorted(x)])]
        return [x if isinstance(x, int) else None for x in found]

    roots = [[value(5) for _ in range(draw.randrange(4))] for _ in range(300)]
    roots = [r for r in roots if not any(isinstance(x, str) and x.strip().isdigit() for x in r)]
    texts = [json.dumps(r, ensure_ascii=draw.random() < 0.5) for r in roots]
    assert values(lambda c: jsonfields.json_integers(c, "codigo"), texts) == [codes(r) for r in roots]


def test_lists(spark):
    df = spark.createDataFrame([([1, None, 5],), ([],), ([None],), (None,)], "c array<int>")
    got = df.select(lists.has_any(F.col("c"), [5]), lists.distinct_sorted_text(F.col("c")), lists.list_size(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [(True, "1, 5", 3), (False, None, 0), (False, None, 1), (None, None, None)]


def test_subject_order_and_outcome(spark):
    df = spark.createDataFrame([([12091, 77, 3370, 5555, 9, 12091],), ([12091, 3458],), ([12091],), ([5555, 3458],)], "c array<int>")
    names = codes.literal_map({5555: "Crime Tentado", 3370: "Homicídio Qualificado", 12091: "Feminicídio"})
    c = F.col("c")
    got = df.select(
        lists.join_list(lists.named(lists.by_priority(c, courts.PRIORITY), names, courts.NAMELESS)),
        codes.outcome(lists.has_any(c, courts.ATTEMPT), lists.has_any(c, courts.DEATH_SIGN))).collect()
    assert got[0][0] == "Crime Tentado, Homicídio Qualificado, Feminicídio, ASSUNTO 77, ASSUNTO 9"
    assert [r[1] for r in got] == ["TENTATIVA", "CONSUMADO", None, "TENTATIVA"]


def test_marked_labels(spark):
    df = spark.createDataFrame([("1", "1", "2"), (None, "9", None)], "REDE_SAU string, ENC_SAUDE string, MPU string")
    options = {k: notifications.REFERRAL[k] for k in df.columns}
    got = [r[0] for r in df.select(lists.marked_labels(options)).collect()]
    assert got == [["REDE DA SAUDE"], []]


def test_codebooks():
    assert len(mortality.assault_codes()) == len(set(mortality.assault_codes())) == 266
    assert {"Y063", "Y350", "Y074"}.isdisjoint(mortality.assault_codes())
    assert {"X85", "X850", "Y061", "Y073"} <= set(mortality.assault_codes())
    assert courts.STATE_OF_COURT["TJDFT"] == "DF" and len(courts.STATE_OF_COURT) == 27
    assert set(courts.SUBSETS["feminicidio"]) < set(courts.SUBSETS["violencia_genero"]) < set(courts.SUBSETS["contexto_domestico"])
    assert len(survey.SPANS_2013) == 32 and len(survey.SPANS_2019) == 34
    assert notifications.PLACE["09"] == notifications.PLACE["9"] == "OUTRO" and notifications.PLACE["99"] == "IGNORADO"


def test_lookup_rules(values):
    book = {"1": "A"}
    assert values(lambda c: codes.lookup(c, book), ["1", "2", None]) == ["A", None, None]
    assert values(lambda c: codes.lookup(c, book, "keep"), ["1", "2", None]) == ["A", "2", None]
    assert values(lambda c: codes.lookup(c, book, "default", "-"), ["1", "2", None]) == ["A", "-", "-"]


def test_large_book(spark):
    book = {str(i): f"label {i}" for i in range(200)}
    df = spark.createDataFrame([("7", "x"), ("999", "y"), (None, "z")], "code string, other string")
    got = {r.other: r.code for r in codes.decode(df, {"code": book}).collect()}
    assert got == {"x": "label 7", "y": "999", "z": None}
