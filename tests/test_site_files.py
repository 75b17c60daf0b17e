import pyarrow as pa
import pytest
from pyspark.sql import types as T

from estrato.operators import clean
from estrato.sources import site_files as S

FULL = ("Ítem;Norte;Este;De;Hasta;potencia;Vs (m/s);Vp (m/s);Nspt;(N1)60;LL %;LP;IP %;W%;"
        "Gravas;Arenas;Finos;SUCS;Qadm. (kg/cm2)")


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw files")
    full = [FULL,
            "SPT-1;100;200;0;1;-; 12 ;1e3;12;NA;<5;50/15;12d;inf;12,5;NaN;null;ML-ñ;1.5",
            ";" * 18,
            ";".join("-" * 19),
            "-5;;;1;3;;300;;;;;;;;;;;SM;2"]
    (d / "Colegio_San_Juan.csv").write_bytes("\r\n".join(full).encode("latin1"))
    (d / "Colegio_Norte.csv").write_text("Nspt;Ítem;De;Hasta;SUCS\n10;SPT-1-2;0;2;SC\n20;SPT;2;4;CL\n")
    (d / "Sin_Separador.csv").write_text("a,b,c\n1,2,3\n")
    (d / "Fila_Larga.csv").write_text("Ítem;De;Hasta\nA;1;2\nB;1;2;3\n")
    (d / "Fila_Corta.csv").write_text("Ítem;De;Hasta\nC;1\nD;1;2\n")
    (d / "Cabecera_Rara.csv").write_text("Ítem;De;De;;LP;lp\nX;1;2;3;4;5\n")
    (d / "Vacio.csv").write_text("")
    (d / "con espacio [1]+2.csv").write_text("﻿Ítem;De;Hasta\nBOM;0;1\n", encoding="utf-8")
    (d / "Citado.csv").write_text('Ítem;De;Hasta\n"a;b";0;1\n"dos\nlineas";2;3\n"""q""";4;5\n')
    (d / "Citado_Largo.csv").write_text('Ítem;De;Hasta\n"x\ny";0;1;2\n')
    (d / "otro.txt").write_text("Ítem;De;Hasta\nT;0;1\n")
    return d


@pytest.fixture(scope="module")
def ingested(spark, raw):
    return S.read_site_files(spark, f"file:{raw}", with_file=True)


def test_listing_reads_only_csv(spark, raw):
    names = {r["file_name"] for r in S.list_files(spark, f"file:{raw}").collect()}
    assert len(names) == 10 and "otro.txt" not in names and "con espacio [1]+2.csv" in names


def test_quarantine(ingested):
    got = {r["file_name"]: r["reason"] for r in ingested.quarantine().collect()}
    assert got == {"Sin_Separador.csv": "fewer than two columns",
                   "Fila_Larga.csv": "row longer than header",
                   "Citado_Largo.csv": "row longer than header",
                   "Vacio.csv": "empty file"}


def test_encoding_per_file(ingested):
    got = {r["file_name"]: r["encoding"] for r in ingested.files.collect()}
    assert got["Colegio_San_Juan.csv"] == "ISO-8859-1"
    assert got["Colegio_Norte.csv"] == "UTF-8"
    assert got["Vacio.csv"] is None
    row = ingested.table.filter("colegio = 'Colegio San Juan' and item = 'SPT-1'").first()
    assert row["sucs"] == "ML-ñ"


def test_union_by_name(ingested):
    rows = {r["item"]: r for r in ingested.table.filter("archivo = 'Colegio_Norte.csv'").collect()}
    assert rows["SPT-1-2"]["nspt"] == "10" and rows["SPT-1-2"]["vs_m_s"] is None
    assert rows["SPT"]["colegio"] == "Colegio Norte"
    short = {r["item"]: r for r in ingested.table.filter("archivo = 'Fila_Corta.csv'").collect()}
    assert short["C"]["hasta"] is None and short["D"]["hasta"] == "2"
    odd = ingested.table.filter("archivo = 'Cabecera_Rara.csv'").first()
    assert (odd["de"], odd["de_1"], odd["unnamed_3"], odd["lp"], odd["lp_1"]) == ("1", "2", "3", "4", "5")
    assert ingested.names["de_1"] == "De.1" and ingested.names["unnamed_3"] == "Unnamed: 3"
    bom = ingested.table.filter("item = 'BOM'").first()
    assert bom["colegio"] == "con espacio [1]+2"


def test_quotes_and_multi_line_records(ingested):
    got = [r["item"] for r in ingested.table.filter("archivo = 'Citado.csv'").orderBy("de").collect()]
    assert got == ["a;b", "dos\nlineas", '"q"']


def test_empty_rows_and_sentinels(ingested):
    rows = ingested.table.filter("colegio = 'Colegio San Juan'")
    assert rows.count() == 3                      # ;;; dropped, only-'-' kept
    only = rows.filter("item is null").first()
    assert only["de"] is None and only["sucs"] is None


def test_clean(ingested):
    df = clean.clean_rows(ingested.table)
    row = df.filter("colegio = 'Colegio San Juan' and item = 'SPT-1'").first()
    assert row["vs_m_s"] == 12.0 and row["vp_m_s"] == 1000.0 and row["nspt"] == 12.0
    for c in ("potencia", "n1_60", "ll_pct", "lp", "ip_pct", "w_pct", "gravas", "arenas", "finos"):
        assert row[c] is None, c
    assert row["qadm_kg_cm2"] == 1.5 and row["profundidad_media"] == 0.5
    assert row["tipo_ensayo"] == "SPT"
    assert df.filter("item = '-5'").first()["tipo_ensayo"] == ""
    assert df.filter("item is null").count() == 0   # the only-'-' row has no mid-depth
    pruned = clean.drop_null_columns(df)
    assert "potencia" not in pruned.columns and "vs_m_s" in pruned.columns
    lost = {r["column"]: r["nulled"] for r in clean.coercion_report(ingested.table).collect()}
    assert lost["w_pct"] == 1 and lost["vs_m_s"] == 0
    comma = clean.coerce_numeric(ingested.table, decimal_comma=True)
    assert comma.filter("item = 'SPT-1'").first()["gravas"] == 12.5


def test_no_rows_drops_every_column(spark):
    df = spark.createDataFrame([], "a string, b double")
    assert clean.drop_null_columns(df).columns == []


def test_no_input(spark, tmp_path):
    with pytest.raises(S.NoInputError):
        S.read_site_files(spark, f"file:{tmp_path}")
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    with pytest.raises(S.NoInputError):
        S.read_site_files(spark, f"file:{tmp_path}")


def test_inventory(spark, raw):
    got = {r["file_name"]: r for r in S.raw_inventory(spark, f"file:{raw}").collect()}
    assert got["Colegio_San_Juan.csv"]["header"] == FULL[:80]
    assert got["Vacio.csv"]["error"] == "empty file" and got["Sin_Separador.csv"]["header"] == "a,b,c"
    assert got["Colegio_Norte.csv"]["size"] > 0


def test_header_names():
    assert S.split_header("a;a;;a.1") == ["a", "a.2", "Unnamed: 2", "a.1"]
    names = S.safe_names(["LP", "lp", "Qadm. (kg/cm2)", "Ítem", "�tem", "A b"])
    assert names["LP"] == "lp" and names["lp"] == "lp_1" and names["A b"] == "a_b"
    assert names["Ítem"] == names["�tem"] == "item"


def test_large_file_is_split(spark, tmp_path):
    body = "".join(f"SPT-{i};{i % 40};{i % 40 + 1}\n" for i in range(20000))
    (tmp_path / "g.csv").write_text("Ítem;De;Hasta\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        got = S.read_site_files(spark, f"file:{tmp_path}")
        assert got.files.first()["data_rows"] == 20000
        assert got.table.count() == 20000
        assert got.table.rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_numbers_follow_the_pattern(spark):
    import re

    from estrato import config
    from estrato.functions import columns as C

    cells = ["12", " 12 ", "-1.5", "+.5", "5.", "1e3", "1E-3", "12d", "1.5f", "1D", "2F", "NaN", "nan",
             "inf", "-inf", "Infinity", "+Infinity", "0x10", "0x1p3", "12,5", "<5", "50/15", "1_000",
             "", " ", "-", ".", "e5", "1e", "1.2.3", "- 5", "1 2", "1e999", "-1e999", "٣", "1L"]
    rows = spark.createDataFrame([(c,) for c in cells], "cell string")
    got = {r[0]: r[1] for r in rows.select("cell", C.parse_number(C.col("cell"))).collect()}
    for c in cells:
        plain = re.match(config.NUMBER_PATTERN, c.strip(), re.ASCII)
        want = float(c) if plain and abs(float(c)) != float("inf") else None
        assert got[c] == want, c


@pytest.mark.parametrize("size", [64, 300, 1 << 27])
def test_quoted_line_breaks_across_splits(spark, tmp_path, size, monkeypatch):
    """Every record of a file cut anywhere, as a plain parser gives it."""
    import csv
    import io
    import random
    r = random.Random(size)
    want = []
    for k in range(6):
        rows = [(f"r{k}-{i}", r.choice(["1", '"', 'say ""no', "a;b", "x\ny", 'two\n\n"lines"\nand more ' * r.randint(1, 9), "ñ日", ""]), str(i)) for i in range(60)]
        text = "Ítem;De;Hasta\n" + "".join(f'"{a}";"{b.replace(chr(34), chr(34) * 2)}";{c}\n' if k % 2 else f'{a};"{b.replace(chr(34), chr(34) * 2)}";{c}\n' for a, b, c in rows)
        if k == 5:
            text = text.rstrip("\n")
        (tmp_path / f"s{k}.csv").write_text(text)
        want += [(f"s{k}", *x) for x in list(csv.reader(io.StringIO(text), delimiter=";"))[1:]]
    (tmp_path / "plain.csv").write_text("Ítem;De;Hasta\n" + "".join(f"p{i};{i};2\n" for i in range(50)))
    want += [("plain", f"p{i}", str(i), "2") for i in range(50)]
    (tmp_path / "wide.csv").write_text('Ítem;De;Hasta\n"x\ny";0;1\n' * 20 + '"x\nz";0;1;2\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 16)
    try:
        got = S.read_site_files(spark, f"file:{tmp_path}")
        rows = [tuple(x) for x in got.table.select("colegio", "item", "de", "hasta").collect()]
        assert {x["file_name"]: x["reason"] for x in got.quarantine().collect()} == {"wide.csv": "row longer than header"}
        assert "Exchange hash" not in got.table._jdf.queryExecution().executedPlan().toString()
        if size == 64:
            monkeypatch.setattr(S, "REST_BYTES", 2000)   # in several scans
            monkeypatch.setattr(S, "BROADCAST_FILES", 0)  # lines joined with their files
            again = S.read_site_files(spark, f"file:{tmp_path}").table.select("colegio", "item", "de", "hasta").collect()
            assert sorted(map(str, again)) == sorted(str(x) for x in got.table.select("colegio", "item", "de", "hasta").collect())
            monkeypatch.setattr(S, "RECORD_REST", 40)
            reasons = {x["reason"] for x in S.read_site_files(spark, f"file:{tmp_path}").quarantine().collect()}
            assert "record of over 40 characters" in reasons
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    blank = lambda x: None if x.strip(" ") in S.config.NA_TOKENS else x
    assert sorted(rows, key=str) == sorted([(a, *map(blank, x)) for a, *x in want], key=str)


class Handed:
    """Stands for the lines of a scan and hands out the function that tasks run."""
    columns = ["value", S.PATH, "block", "multi_line", "places"]
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField(S.PATH, T.StringType()),
                           T.StructField("block", T.LongType()), T.StructField("multi_line", T.BooleanType()),
                           T.StructField("places", T.LongType())])

    def withColumns(self, _):
        return self

    def mapInArrow(self, run, _):
        return run


def test_records_leave_by_the_batch(spark):
    run = S._glued(Handed(), ";", {("b", 0): (False, "z\";9"), ("b", 7): (True, None)})
    text, flips = [], []
    for k in range(1000):       # a record of two lines, and one of one
        text += [f'"a{k}', f'b{k}";1', f"c{k};2"]
        flips += [True, True, False]
    lines = [(v, "a", 0, f, not f) for v, f in zip(text, flips)]
    lines += [('"x', "b", 0, True, False), ('z";9', "b", 7, False, False), ("y;3", "b", 7, False, True), ('"e', "c", 0, True, False)]

    def batch(part, at):
        value, path, block, open0, open1 = zip(*part)
        return pa.RecordBatch.from_pydict({"value": value, S.PATH: path, "block": block, "multi_line": [True] * len(part),
                                           "places": list(range(at, at + len(part))), "open0": open0, "open1": open1})

    cuts = [0, 1000, 2999, 3001, 3002, len(lines)]        # in and between records
    out = list(run(iter([batch(lines[a:b], a) for a, b in zip(cuts, cuts[1:])])))
    got = [r for b in out for r in zip(b.column("value").to_pylist(), b.column("places").to_pylist())]
    want = [r for k in range(1000) for r in ((f'"a{k}\nb{k}";1', 3 * k), (f"c{k};2", 3 * k + 2))]
    assert got == [*want, ('"x\nz";9', 3000), ("y;3", 3002), ('"e', 3003)]
    assert len(out) <= 2 * len(cuts)        # not one a record


def test_lines_without_quotes_pass_no_worker(spark):
    lines = spark.createDataFrame([("a;1", "p", False, 0, "h"), ('"b', "q", True, 0, "h"), ('c";2', "q", True, 0, "h")],
                                  f"value string, {S.PATH} string, multi_line boolean, block long, header string").coalesce(1)
    borders = spark.createDataFrame([], "path string, block long, inside boolean, rest string")
    found = S._records(lines, ";", borders)
    assert sorted(r["value"] for r in found.collect()) == ['"b\nc";2', "a;1"]
    assert "Union" in found._jdf.queryExecution().optimizedPlan().toString()


def test_site_files_are_written_without_being_read(spark, tmp_path, monkeypatch):
    from checks import ingest
    rows = [(k, None, k % 50, "view" if k % 2 else "error", k / 4) for k in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"file:{tmp_path}/events.parquet")

    def read(*a, **k):
        raise AssertionError("read")

    monkeypatch.setattr(S, "read_site_files", read)
    root = ingest.site_dir(spark, f"file:{tmp_path}")
    monkeypatch.undo()
    assert S.list_files(spark, root).count() == 25
    assert ingest.ingested(spark, f"file:{tmp_path}").files.filter("reason is null").count() == 22
