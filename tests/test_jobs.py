"""Sources, sinks and jobs on small generated files (no real records)."""

import os

import pytest
from pyspark.sql import functions as F

from cleartab import LINEAGE
from cleartab.codebooks import courts as court_book
from cleartab.codebooks import survey
from cleartab.operators import dictionary, ingest, publish, versions
from cleartab.plans import catalog, courts, incremental, mortality, notifications, selection
from cleartab.plans import survey_dictionary, survey_fixed
from cleartab.queries import dbf_files
from cleartab.queries.dbf_files import dbf_bytes
from cleartab.session import Staging
from cleartab.sources import listing, text
from cleartab.sources.dbf import dbf_status, read_dbf

DEATH_FIELDS = [("SEXO", "C", 1), ("CAUSABAS", "C", 4), ("RACACOR", "N", 2), ("DTOBITO", "D", 8), ("IDADE", "N", 6)]


def write(path, data: bytes):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    return str(path), len(data)


def test_dbf_files_of_many_tasks(spark, tmp_path, monkeypatch):
    """Records of one file come from all tasks, without a shuffle; a shorter file replaces a longer one."""
    monkeypatch.setattr(dbf_files, "HELD", 200, raising=False)
    fields, folder = [("ID", "N", 6), ("KIND", "C", 3)], str(tmp_path / "forms")
    rows = spark.range(0, 30_000, 1, 4).selectExpr("CAST(id AS STRING) AS ID", "IF(id % 7 = 0, NULL, 'k') AS KIND")
    monkeypatch.setattr(type(rows), "sortWithinPartitions", None)  # whole rows are never sorted by file
    name = F.when(F.col("ID").cast("int") % 1000 == 3, "B.dbf").when(F.col("ID") != "5", "A.dbf")
    for part, group in ((rows, "dbf-1"), (rows.filter("ID < '2'"), "dbf-2")):
        spark.sparkContext.setJobGroup(group, "dbf")
        files = dbf_files.write_dbf(part, folder, fields, name)
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getJobInfo(j).stageIds for j in sorted(tracker.getJobIdsForGroup(group))]
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(stages[0]) == 1 and tracker.getStageInfo(stages[0][0]).numTasks == 4
        assert sorted(os.listdir(folder)) == ["A.dbf", "B.dbf"]
        assert all(os.path.getsize(path) == size for path, _, size in files)
        read = read_dbf(spark, [(path, size) for path, _, size in files], split=5_000)
        want = part.select("ID", "KIND", name.alias(LINEAGE)).filter(F.col(LINEAGE).isNotNull())
        assert read.exceptAll(want).isEmpty() and want.exceptAll(read).isEmpty()
    assert dbf_files.write_dbf(rows.limit(0), folder, fields, name) == []


def test_dbf_values_and_splits(spark, tmp_path):
    fields = [("C", "C", 6), ("N", "N", 6), ("F", "F", 6), ("D", "D", 8), ("L", "L", 1)]
    rows = [[" ã ", "7", "2.50", "20200228", "T"], ["", "12.0", "x", "00000000", "n"], ["nan", "12.5", "", "20201301", "Y"],
            ["x", "***", "3", "", "?"], ["gone", "1", "1", "20200101", "T"]] * 50
    one = write(tmp_path / "A.dbf", dbf_bytes(rows, fields, deleted={i for i in range(250) if i % 5 == 4}))
    other = write(tmp_path / "b.DBF", dbf_bytes([["only"]], [("EXTRA", "C", 5)]))
    df = read_dbf(spark, [one, other], split=500)
    assert df.columns == ["C", "N", "F", "D", "L", "EXTRA", LINEAGE]
    got = {tuple(r): r["count"] for r in df.groupBy(*df.columns).count().collect()}
    assert {k[:7] for k in got} == {
        ("ã", "7", "2.5", "2020-02-28", "True", None, "A.dbf"), (None, "12", None, None, "False", None, "A.dbf"),
        (None, "12.5", None, None, None, None, "A.dbf"), ("x", None, "3", None, None, None, "A.dbf"),
        (None, None, None, None, None, "only", "b.DBF")}
    assert sum(got.values()) == 201
    assert read_dbf(spark, [one], columns=["N", "NEW"]).columns == ["N", "NEW", LINEAGE]


def test_mortality_from_files(spark, tmp_path):
    """A bad file is reported, keeps its published rows and is not marked as done;
    a file whose rows are all filtered out loses its old ones."""
    def deaths(*rows):
        return dbf_bytes([list(r) for r in rows], DEATH_FIELDS)

    source, target, manifest = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "manifest")
    write(source / "DOEXT96.dbf", deaths(("2", "X850", "7", "19960101", ""), ("1", "X850", "1", "", ""), ("2", "Y350", "1", "", "")))
    write(source / "DOEXT05.dbf", deaths(("2", "Y061", "9", "20050101", ""), ("2", "Y063", "1", "", "")))
    write(source / "doext05.DBF", b"second spelling")
    write(source / "DOEXT2023.dbf", deaths(("2", "X85", "1", "", "")))
    write(source / "readme.dbf", b"not a source")

    def run():
        return {r.name: r.status for r in mortality.run(spark, str(source), target, manifest).collect()}

    assert run() == {"DOEXT96.dbf": "ok", "DOEXT05.dbf": "ok", "DOEXT2023.dbf": "ok"}
    out = publish.read_published(spark, target)
    assert len(out.columns) == 18
    got = {r[LINEAGE]: (r.CAUSA_BASICA, r.RACA_COR, r.LOCAL_CID, r.AGRESSOR_CID, r.SEXO) for r in out.collect()}
    assert got == {"DOEXT96.dbf": ("X850", None, "Residência", None, "FEMININO"),
                   "DOEXT05.dbf": ("Y061", "IGNORADO", None, "Pais", "FEMININO"),
                   "DOEXT2023.dbf": ("X85", "BRANCA", None, None, "FEMININO")}

    write(source / "DOEXT96.dbf", deaths(("1", "X850", "1", "", "")))
    write(source / "DOEXT05.dbf", b"broken")
    assert run() == {"DOEXT96.dbf": "ok", "DOEXT05.dbf": "failed"}
    assert {r[0] for r in publish.read_published(spark, target).select(LINEAGE).collect()} == {"DOEXT05.dbf", "DOEXT2023.dbf"}
    done = {r.source_file: r.size_bytes for r in ingest.read_manifest(spark, manifest).collect()}
    assert set(done) == {"DOEXT96.DBF", "DOEXT05.DBF", "DOEXT2023.DBF"} and done["DOEXT05.DBF"] > 6
    assert run() == {"DOEXT05.dbf": "failed"}  # tried again, nothing else touched
    os.rename(manifest, f"{manifest}__old")  # a swap that stopped between its renames
    assert run() == {"DOEXT05.dbf": "failed"}
    files = listing.list_files(spark, str(source))
    chosen = incremental.choose_files(files, ingest.read_manifest(spark, manifest), "DOEXT")
    with pytest.raises(ValueError, match="no readable"):
        incremental.from_dbf(spark, chosen, mortality.INPUT_COLUMNS)


def test_unreachable_storage_is_no_bad_file(spark):
    files = spark.createDataFrame([("wasbs://c@a.example/x.dbf", "x.dbf", 1)], "path string, name string, size_bytes bigint")
    for check in (dbf_status, listing.parquet_footers):
        with pytest.raises(Exception, match="tasks cannot open wasbs"):
            check(files).collect()


def test_notifications_from_files(spark, tmp_path):
    fields = [("CS_SEXO", "C", 1), ("DT_NOTIFIC", "D", 8), ("REL_CONJ", "C", 1)]
    write(tmp_path / "in" / "VIOLBR09.dbf", dbf_bytes([["F", "20090102", "1"], ["M", "20090102", "1"]], fields))
    target, manifest = str(tmp_path / "out"), str(tmp_path / "manifest")
    for want in ([("VIOLBR09.dbf", "ok", 2)], []):
        status = notifications.run(spark, str(tmp_path / "in"), target, manifest)
        assert [(r.name, r.status, r.n_records) for r in status.collect()] == want
    rows = publish.read_published(spark, target).collect()
    assert len(rows) == 1 and str(rows[0].DT_NOTIFICACAO) == "2009-01-02" and rows[0][LINEAGE] == "VIOLBR09.dbf"


def test_survey_manifest(spark, tmp_path):
    from cleartab.codebooks import survey as survey_book
    from cleartab.plans import survey_fixed
    width = max(end for _, end in survey_book.SPANS_2019.values())
    (tmp_path / "pns.txt").write_text("1" * width + "\n")
    args = (spark, str(tmp_path / "pns.txt"), str(tmp_path / "out"))
    manifest = str(tmp_path / "manifest")
    assert survey_fixed.run_2019(*args, manifest_path=manifest) is not None
    assert survey_fixed.run_2019(*args, manifest_path=manifest) is None
    (tmp_path / "pns.txt").write_text("1" * width + "\n" + "2" * width + "\n")
    assert survey_fixed.run_2019(*args, manifest_path=manifest) is not None


def test_missing_column_gives_empty(spark):
    df = spark.createDataFrame([("x", "f.dbf")], f"OTHER string, {LINEAGE} string")
    out = mortality.project(mortality.select_records(df))
    assert out.count() == 0 and len(out.columns) == 18
    out = notifications.project(notifications.select_records(df))
    assert out.count() == 0 and len(out.columns) == 47


def test_replacing_twice_equals_once(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "A.dbf"), (2, "B.dbf")], f"v int, {LINEAGE} string")
    publish.publish_replacing(first, path, ["A.dbf", "B.dbf"])
    second = spark.createDataFrame([(3, "a.DBF", "new")], f"v int, {LINEAGE} string, extra string")
    for _ in range(2):
        assert publish.publish_replacing(second, path, ["a.DBF"]) == 1
    got = {(r.v, r.extra) for r in publish.read_published(spark, path).collect()}
    assert got == {(2, None), (3, "new")}
    with pytest.raises(ValueError, match="outside the batch"):
        publish.publish_replacing(second, path, ["B.dbf"])
    assert publish.publish_replacing(second.limit(0), path, ["B.dbf", "a.dbf"]) == 0
    assert publish.children_by_source(spark, path) == {}


def test_swap_and_recover(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish(spark.range(3), path)
    publish.publish_swapped(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    os.rename(path, f"{path}__old")
    publish.recover(spark, path)
    assert spark.read.parquet(path).count() == 2


def test_empty_table_keeps_schema(spark, tmp_path):
    assert publish.publish(spark.range(0).withColumn("x", F.lit("a")), str(tmp_path / "e")) == 0
    assert spark.read.parquet(str(tmp_path / "e")).columns == ["id", "x"]


def test_catalog(spark, tmp_path):
    root = tmp_path / "bucket"
    publish.publish(spark.range(5).coalesce(1), str(root / "datajud" / "t"))
    write(root / "other" / "bad.parquet", b"PAR1")
    write(root / "datajud" / "_manifest.json", b"{}")
    write(root / "datajud" / "_checkpoint_x.json", b"{}")
    sources = spark.createDataFrame([("datajud", "B", 2), ("datajud", "A", 1)], "folder string, name string, position int")
    built = catalog.build(spark, str(root), sources)
    rows = {r.arquivo: r for r in built.collect()}
    assert len(rows) == 2
    good = next(r for k, r in rows.items() if k.startswith("datajud/t/"))
    assert (good.num_registros, good.num_colunas, good.fontes_relacionadas) == (5, 1, "A | B")
    assert rows["other/bad.parquet"].num_registros is None
    assert [r[0] for r in catalog.unreadable(built).collect()] == ["other/bad.parquet"]
    assert [r[0] for r in catalog.unmapped_folders(built).collect()] == ["other"]
    assert tuple(catalog.totals(built).first()) == (2, 5)
    catalog.run(spark, str(root), sources, str(tmp_path / "csv"))
    part = next(p for p in (tmp_path / "csv").iterdir() if p.name.startswith("part-"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfarquivo,diretorio,")


def test_selection(spark):
    files = spark.createDataFrame(
        [("DOEXT95.dbc", 1), ("DOEXT96.dbc", 1), ("DOEXT97.dbc", 9), ("DOEXT22.dbc", 1), ("DOEXT2023.dbc", 1),
         ("doext2023.DBC", 1), ("DOEXT2024.dbc", 5), ("DOEXTXX.dbc", 1), ("readme.txt", 1)], "name string, size_bytes bigint")
    manifest = spark.createDataFrame(
        [("DOEXT97.DBC", 1), ("DOEXT22.DBC", 1), ("DOEXT2023.DBC", 1), ("DOEXT2024.DBC", 4)], ingest.MANIFEST_SCHEMA)
    got = {r.name for r in selection.files_to_fetch(files, manifest, "DOEXT", "dbc", 1996, 2026).collect()}
    # 97 changed but is neither recent nor unknown; 2023 is recent but unchanged.
    assert got == {"DOEXT96.dbc", "DOEXT2024.dbc"}


def _line(spans, **fields):
    line = [" "] * max(b for _, b in spans.values())
    for name, value in fields.items():
        start, _ = spans[name]
        line[start:start + len(value)] = value
    return "".join(line)


def test_survey_2013(spark, tmp_path):
    spans = survey.SPANS_2013
    lines = [
        _line(spans, uf="35", sexo="2", idade="007", sofreu_violencia="1", agressor="02", peso_amostral="00012345678901"),
        _line(spans, uf="99", sexo="2", idade="000", d_sofreu_violencia="1", d_agressor="3"),
        _line(spans, uf="11", sexo="2", sofreu_violencia="1", d_sofreu_violencia="1", agressor="10"),
        _line(spans, uf="11", sexo="1", sofreu_violencia="1"), "", " " * 20, "35",
    ]
    (tmp_path / "PNS_2013.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    counts = survey_fixed.run_2013(spark, str(tmp_path / "PNS_2013.txt"), str(tmp_path / "o"))
    assert counts == {survey_fixed.KNOWN_TABLE_2013: 2, survey_fixed.UNKNOWN_TABLE_2013: 2}
    known = spark.read.parquet(str(tmp_path / "o" / survey_fixed.KNOWN_TABLE_2013))
    unknown = spark.read.parquet(str(tmp_path / "o" / survey_fixed.UNKNOWN_TABLE_2013))
    assert len(known.columns) == 22 and len(unknown.columns) == 20
    got = {r.uf: (r.idade, r.peso_amostral, r.parceiro_intimo) for r in known.collect()}
    assert got == {"São Paulo": ("7", 123.45678901, True), "Rondônia": ("0", None, False)}
    assert {(r.uf, r.agressor) for r in unknown.collect()} == {("99", "Outro"), ("Rondônia", "")}


def test_survey_2019_partner_rules(spark):
    spans = survey.SPANS_2019
    lines = [_line(spans, uf="35", sexo="2", sex_relacao_forcada_vida="1", sex_agressor="02"),
             _line(spans, uf="33", sexo="2", fis_tapa="1", fis_agressor="03"),
             _line(spans, uf="31", sexo="2", fis_tapa="2")]
    raw = text.slice_lines(spark.createDataFrame([(x,) for x in lines], "value string"), "value", spans)
    by_code = survey_fixed.table_2019(raw)
    assert len(by_code.columns) == 35
    assert {r.uf: r.parceiro_intimo for r in by_code.collect()} == {"São Paulo": True, "Rio de Janeiro": True}
    by_label = survey_fixed.table_2019(raw, strict_labels=True)
    assert {r.uf: r.parceiro_intimo for r in by_label.collect()} == {"São Paulo": False, "Rio de Janeiro": True}


def test_dictionary_names():
    names = {"P08": "em_que_estado_voce_mora", "P1": "cor", "P2": "cor"}
    assert dictionary.output_names(["P08", "P1", "P2", "X 9"], names) == ["em_que_estado_voce_mora", "cor", "cor_p2", "X 9"]
    with pytest.raises(ValueError, match="differ only by case"):
        dictionary.output_names(["a", "A"], {})


def test_survey_rounds(spark, tmp_path):
    """One round is published, a broken one is recorded, an unpaired one is left
    out; a second run skips what is done."""
    head = "Código da variável;Descrição da variável;Regra;Código da categoria;Descrição da categoria\n"
    data, books = tmp_path / "csv", tmp_path / "dict"
    write(data / "pnvd_2019.csv", "﻿P08;P1;Z\n11;2;k\n12;;\n99;1;m\n".encode())
    write(books / "pnvd_dict_2019.csv", (
        "﻿" + head + 'P08;"Em que estado\nvocê mora? (Ver P07)";;11;Rondônia\n;;;12;Acre\nSEÇÃO B;;;;\n;;;13;ignored\n'
        "P1;Cor;;-;x\n;;;1;Azul \n").encode())
    write(data / "pnvd_2021.csv", b"A;a\n1;2\n")
    write(books / "pnvd_dict_2021.csv", head.encode() + b"A;Nome;;;\nA b;;;;\n")
    write(data / "pnvd_2023.csv", b"A\n1\n")
    out, manifest = str(tmp_path / "out"), str(tmp_path / "manifest")

    def run():
        status = survey_dictionary.run(spark, listing.list_files(spark, str(data)), listing.list_files(spark, str(books)), manifest, out)
        return {r.unit: r.status for r in status.collect()}

    first = run()
    assert first["2019"] == "processed" and set(first) == {"2019", "2021"}
    table = spark.read.parquet(f"{out}/pn_violencia_domestica_2019")
    assert table.columns == ["em_que_estado_voce_mora", "cor", "Z"]
    assert {tuple(r) for r in table.collect()} == {("Rondônia", "2", "k"), ("Acre", None, None), ("99", "Azul", "m")}
    assert run()["2019"] == "skipped"


CASES = [
    {"id": "1", "dataHoraUltimaAtualizacao": "2024-01-01T10:00:00Z", "assuntos": [{"codigo": 12091, "nome": "Velho"}]},
    {"id": "1", "dataHoraUltimaAtualizacao": "2024-02-01T10:00:00Z", "assuntos": [{"codigo": 12091, "nome": "Feminicídio"}, [{"codigo": "5555"}]]},
    {"id": None, "tribunal": "TJSP", "assuntos": None}, {"id": None, "tribunal": "TJSP", "assuntos": None},
    {"id": "3", "assuntos": {"codigo": 12091, "nome": "Feminicídio"}},
    {"id": "2", "classe": {"codigo": 1268, "nome": "Medidas"}, "assuntos": [{"codigo": 777, "nome": "B"}, {"codigo": 777, "nome": "A"}]},
]


def test_courts(spark, tmp_path):
    import json
    (tmp_path / "tjsp.ndjson").write_text("\n".join(json.dumps(c) for c in CASES))
    raw = text.read_ndjson(spark, str(tmp_path / "*.ndjson"), court_book.FIELDS)
    with Staging(spark) as area:
        many = courts.build(raw, 2026, area).orderBy("ID_DATAJUD", "TRIBUNAL")
        assert len(many.columns) == 28
        few = [tuple(r) for r in many.collect()]
    assert len(few) == 5
    by_id = {r[0]: r for r in few}
    columns = many.columns
    one, two = (dict(zip(columns, by_id[k])) for k in ("1", "2"))
    assert (one["ASSUNTOS"], one["DESFECHO"], one["QTD_ASSUNTOS"]) == ("ASSUNTO 5555, Feminicídio", "TENTATIVA", 2)
    assert (two["ASSUNTOS"], two["EH_MEDIDA_PROTETIVA"], two["COD_ASSUNTOS"]) == ("A", True, "777")


@pytest.mark.parametrize("size", [10, 100_000])
def test_names_of_any_number(spark, size):
    names = spark.range(size).selectExpr("int(id) AS code", "concat('n', id) AS name")
    rows = spark.createDataFrame([(1, [3, 9, 3]), (2, []), (3, None), (4, [10 ** 6])], "id int, codes array<int>")
    got = versions.name_lists(rows, "id", "codes", names, "ASSUNTO ", "text").orderBy("id").collect()
    assert [r["text"] for r in got] == ["n3, n9, n3", None, None, "ASSUNTO 1000000"]


def test_ndjson_bad_lines(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{"id":1,"assuntos":[{"codigo": 1}]}\n{"id":\n{"id":"x"}\n')
    rows = text.read_ndjson(spark, str(tmp_path), ["id", "assuntos"], bad_lines=True).collect()
    assert sorted((r.id, r.assuntos, r._bad_line) for r in rows if r.id) == [("1", '[{"codigo": 1}]', None), ("x", None, None)]
    assert [r._bad_line for r in rows if not r.id] == ['{"id":']
    with pytest.raises(Exception):
        text.read_ndjson(spark, str(tmp_path), ["id"]).collect()


def test_delimited_surplus_stops(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A;B\n1;2\n3\n")
    (tmp_path / "b.csv").write_text("B;A\n5;6\n")
    rows = text.read_delimited(spark, str(tmp_path))
    assert sorted(tuple(r) for r in rows.select("A", "B").fillna("-").collect()) == [("1", "2"), ("3", "-"), ("6", "5")]
    (tmp_path / "c.csv").write_text("A;B\n3;4;EXTRA\n")
    with pytest.raises(Exception, match="more cells"):
        text.read_delimited(spark, str(tmp_path)).collect()


def test_court_subsets(spark, tmp_path):
    """Broken lines are set aside, and a subset that fails leaves the others alone."""
    import json
    (tmp_path / "a.ndjson").write_text("\n".join(json.dumps(c) for c in CASES) + '\n{"id":\n')
    jobs = {"one": (str(tmp_path / "a.ndjson"), str(tmp_path / "one")), "two": (str(tmp_path / "none"), str(tmp_path / "two"))}
    status = {r.unit: r for r in courts.run_subsets(spark, jobs, 2026).collect()}
    assert (status["one"].status, status["one"].n_rows, status["two"].status) == ("processed", 5, "failed")
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "one__bad_lines")).collect()] == ['{"id":']


def test_latest_version_keeps_null_ids(spark):
    df = spark.createDataFrame([("a", "1", "x"), ("a", "1", "y"), (None, "1", "p"), (None, "1", "p")], "id string, at string, v string")
    runs = [sorted((r.id or "", r.v) for r in versions.latest_version(rows, ["id"], [F.col("at").desc()]).collect())
            for rows in (df, df.repartition(3, "v"), df.orderBy(F.desc("v")).coalesce(1))]
    assert runs[0] in ([("", "p"), ("", "p"), ("a", v)] for v in "xy") and runs[1:] == runs[:1] * 2  # a tie has one winner
    nested = df.withColumn("s", F.struct(F.create_map("v", "at").alias("m")))
    assert versions.latest_version(nested, ["id"], [F.col("at").desc()]).count() == 3


def test_latest_version_in_one_pass(spark, tmp_path):
    rows = [("a", "1", "x"), ("a", "2", "y"), ("b", "1", "z")] + [(None, "1", "p")] * 5
    spark.createDataFrame(rows, "id string, at string, v string").repartition(3).write.json(str(tmp_path / "j"))
    df = text.read_ndjson(spark, str(tmp_path / "j"), ["id", "at", "v"])
    one = versions.latest_version(df, ["id"], [F.col("at").desc()], scanned=True)
    assert one._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("FileScan") == 1
    assert sorted((r.id or "", r.v) for r in one.collect()) == [("", "p")] * 5 + [("a", "y"), ("b", "z")]


def test_unlisted_columns_and_late_arrivals(spark, tmp_path):
    from cleartab.operators.columns import unlisted_columns
    from cleartab.streaming import documents as stream

    assert [r[0] for r in unlisted_columns(spark.range(1).withColumn("z", F.lit(1)), ["id"]).collect()] == ["z"]
    paths = [str(tmp_path / n) for n in ("in", "store", "progress")]
    args = (["id", "at"], ["id"], [F.col("at").desc()])
    publish.append_ndjson(spark.createDataFrame([("a", "2"), ("b", "1")], "id string, at string"), paths[0])
    stream.ingest(spark, *paths, *args)
    stream.ingest(spark, *paths, *args)  # nothing new
    publish.append_ndjson(spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "1")], "id string, at string"), paths[0])
    stream.ingest(spark, *paths, *args)
    assert sorted(tuple(r) for r in stream.current(spark, paths[1], *args).collect()) == [("a", "2"), ("b", "2"), ("c", "1")]
