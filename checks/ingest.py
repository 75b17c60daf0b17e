"""Site files derived from the given tables, written by Spark and ingested."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import geo
from checks.registry import query
from estrato import config
from estrato.plans import ingest as plan
from estrato.session import new_path
from estrato.sources import site_files, tables

# A site's parts are in one folder; its name plays the file name.
SITE = r"sitio=([^/]+)/"
_written: dict[tuple[str, str], str] = {}
_read: dict[tuple[str, str], site_files.SiteFiles] = {}
_ingested: dict[tuple[str, str], tuple[str, plan.CleanTable]] = {}

FULL = {"Ítem": "item", "Norte": "cast(9457265 + sample_id as string)", "De": "de",
        "Hasta": "hasta", "potencia": "potencia", "Vs (m/s)": "vs_m_s", "Nspt": "nspt",
        "Gravas": "gravas", "Arenas": "arenas", "Finos": "finos",
        "SUCS": "sucs || 'ñ'", "Qadm. (kg/cm2)": "qadm_kg_cm2"}
SHORT = {"Nspt": "nspt", "Ítem": "item", "De": "de", "Hasta": "hasta", "SUCS": "sucs"}
PLAIN = {"Item": "concat(item, ' \"x\"; y')", "De": "de", "Hasta": "hasta", "LP": "vs_m_s",
         "lp": "gravas"}
LINES = {"Ítem": "concat(item, chr(10), 'z')", "Hasta": "hasta", "De": "de"}
SITE_NO = "cast(sample_id % 25 as int)"


def site_dir(spark, sf) -> str:
    """Write the files once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _written:
        root = new_path(spark, "site-files-raw")
        rows = geo.raw(spark, sf).withColumn("site_no", F.expr(SITE_NO)).withColumn(
            "sitio", F.concat(F.lit("Colegio_"), F.col("site_no").cast("string"), F.lit(".csv")))

        def write(where: str, header: dict[str, str], encoding: str = "UTF-8", **options):
            part = rows.filter(where).selectExpr(
                *[f"{e} as `{h}`" for h, e in header.items()], "sitio")
            # One file per site, so that a lost or doubled file shows.
            (part.repartition("sitio").write.mode("append").partitionBy("sitio")
             .csv(root, header=True, **{"sep": ";", "encoding": encoding, "escape": '"',
                                        "nullValue": "", "emptyValue": "",
                                        "ignoreLeadingWhiteSpace": False,
                                        "ignoreTrailingWhiteSpace": False, **options}))

        spark.conf.set("spark.sql.caseSensitive", "true")     # the headers LP and lp
        try:
            write("site_no < 10", FULL, "ISO-8859-1")
            write("site_no between 10 and 15", SHORT)
            write("site_no between 16 and 18", PLAIN)
            write("site_no between 19 and 20", LINES)
            write("site_no = 21", {"a": "item", "b": "de"}, sep=",")
            # Unquoted cells with a separator: rows with more values than the header.
            write("site_no in (22, 24)",
                  {"Ítem": "item", "De": "concat(de, ';', de)", "Hasta": "hasta"}, quote="")
            # A separator at the end of every row is harmless.
            write("site_no = 23", {"Ítem;De;Hasta": "concat(item, ';', de, ';', hasta, ';')"}, sep="\x01")
        finally:
            spark.conf.set("spark.sql.caseSensitive", "false")
        _written[key] = root
    return _written[key]


def ingested(spark, sf) -> site_files.SiteFiles:
    """The files as read, once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _read:
        _read[key] = site_files.read_site_files(spark, site_dir(spark, sf), site_from=SITE, with_file=True)
    return _read[key]


def _site(path="file_path"):
    return F.regexp_extract(F.url_decode(path), SITE, 1)


RAW = f"(select *, {SITE_NO} as site_no from ({geo.RAW_SQL}) r) r"
TOKENS = ", ".join(f"'{t}'" for t in (*config.NA_TOKENS, config.SENTINEL))


def _cell(e: str, name: str) -> str:
    return f"case when cast({e} as string) not in ({TOKENS}) then cast({e} as string) end as {name}"


COLUMNS = ("item", "norte", "de", "hasta", "potencia", "vs_m_s", "gravas", "arenas", "finos",
           "sucs", "qadm_kg_cm2", "lp", "lp_1", "nspt")


def _part(where: str, cells: dict[str, str]) -> str:
    out = [_cell(cells[c], c) if c in cells else f"cast(null as string) as {c}"
           for c in COLUMNS if c != "nspt"]
    nspt = cells.get("nspt", "cast(null as double)")
    out += [f"{nspt} as nspt", "concat('Colegio ', cast(site_no as string)) as colegio"]
    return f"select {', '.join(out)} from {RAW} where {where}"


_names = config.SAFE_NAMES
UNION_SQL = " union all ".join([
    _part("site_no < 10", {_names[h]: e for h, e in FULL.items()}),
    _part("site_no between 10 and 15", {_names[h]: e for h, e in SHORT.items()}),
    _part("site_no between 16 and 18",
          {"item": PLAIN["Item"], "de": "de", "hasta": "hasta", "lp": "vs_m_s", "lp_1": "gravas"}),
    _part("site_no between 19 and 20", {"item": LINES["Ítem"], "hasta": "hasta", "de": "de"}),
    _part("site_no = 23", {"item": "item", "hasta": "hasta", "de": "de"}),
])


@query("ingest_files",
       f"select distinct concat('Colegio_', cast(site_no as string), '.csv') as site from {RAW}")
def ingest_files(spark, sf):
    return (site_files.list_files(spark, site_dir(spark, sf))
            .select(_site().alias("site")))


@query("ingest_union", f"select * from ({UNION_SQL}) u")
def ingest_union(spark, sf):
    t = ingested(spark, sf).table
    return t.select(*COLUMNS[:-1], F.col("nspt").cast("double").alias("nspt"), "colegio")


@query("ingest_encoding",
       "select distinct concat('Colegio_', cast(site_no as string), '.csv') as site, "
       f"case when site_no < 10 then 'ISO-8859-1' else 'UTF-8' end as encoding from {RAW}")
def ingest_encoding(spark, sf):
    return ingested(spark, sf).files.select(_site().alias("site"), "encoding")


@query("ingest_quarantine",
       "select distinct concat('Colegio_', cast(site_no as string), '.csv') as site, "
       "case when site_no = 21 then 'fewer than two columns' else 'row longer than header' end "
       f"as reason from {RAW} where site_no >= 21 and site_no <> 23")
def ingest_quarantine(spark, sf):
    bad = ingested(spark, sf).files.filter("reason is not null")
    return bad.select(_site().alias("site"), "reason")


@query("ingest_audit",
       f"select colegio, count(*) as n_rows from ({UNION_SQL}) u group by colegio")
def ingest_audit(spark, sf):
    return ingested(spark, sf).table.groupBy("colegio").agg(F.count("*").alias("n_rows"))


def _header(header: dict[str, str], sep: str = ";") -> str:
    return sep.join(header)[:80]


@query("raw_inventory", f"""
select distinct concat('Colegio_', cast(site_no as string), '.csv') as site,
  case when site_no < 10 then '{_header(FULL)}'
       when site_no <= 15 then '{_header(SHORT)}' when site_no <= 18 then '{_header(PLAIN)}'
       when site_no <= 20 then '{_header(LINES)}' when site_no = 21 then 'a,b'
       else 'Ítem;De;Hasta' end as header
from {RAW}""")
def raw_inventory(spark, sf):
    root = site_dir(spark, sf)
    files = site_files.sniff_files(spark, root)
    shown = site_files.raw_inventory(spark, root, files=files.withColumn("file_name", _site()))
    return shown.select(F.col("file_name").alias("site"), "header")


_num = geo.number
INGEST_CLEAN_SQL = f"""
select colegio, item, split_part(item, '-', 1) as tipo_ensayo, de, hasta,
  (de + hasta) / 2 as profundidad_media, vs_m_s, gravas, arenas, finos, sucs, nspt, qadm_kg_cm2
from (select colegio, item, {_num('de')} as de, {_num('hasta')} as hasta,
        {_num('vs_m_s')} as vs_m_s, {_num('gravas')} as gravas, {_num('arenas')} as arenas,
        {_num('finos')} as finos, sucs, nspt, {_num('qadm_kg_cm2')} as qadm_kg_cm2
      from ({UNION_SQL}) u) c
where de + hasta is not null"""


def _stored(spark, sf) -> tuple[str, plan.CleanTable]:
    """The whole job, once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ingested:
        path = new_path(spark, "combined")
        _ingested[key] = path, plan.ingest_directory(spark, site_dir(spark, sf), path, site_from=SITE)
    return _ingested[key]


@query("ingest_clean", INGEST_CLEAN_SQL)
def ingest_clean(spark, sf):
    """Files to the written clean table."""
    result = plan.ingest_directory(spark, site_dir(spark, sf), new_path(spark, "combined"), site_from=SITE)
    return result.df.select("colegio", "item", "tipo_ensayo", "de", "hasta", "profundidad_media",
                            "vs_m_s", "gravas", "arenas", "finos", "sucs", "nspt", "qadm_kg_cm2")


@query("ingest_stored", f"""
select colegio, concat(replace(colegio, ' ', '_'), '.csv') as archivo, item, split_part(item, '-', 1) as tipo_ensayo, de, hasta,
  (de + hasta) / 2 as profundidad_media, norte, vs_m_s, gravas, arenas, finos, lp, lp_1, sucs, nspt, qadm_kg_cm2
from (select colegio, item, sucs, nspt, lp_1, {", ".join(f"{_num(c)} as {c}" for c in
        ("de", "hasta", "norte", "vs_m_s", "gravas", "arenas", "finos", "lp", "qadm_kg_cm2"))}
      from ({UNION_SQL}) u) c
where de + hasta is not null""")
def ingest_stored(spark, sf):
    """The table as it is found again: without ``potencia``, which is empty."""
    return tables.load_table(spark, _stored(spark, sf)[0]).drop(plan.ROW_ID)


@query("ingest_report", f"""
with kept as (select colegio, count(*) as n from ({INGEST_CLEAN_SQL}) c group by colegio),
sites as (select distinct site_no, concat('Colegio_', cast(site_no as string), '.csv') as archivo,
    concat('Colegio ', cast(site_no as string)) as colegio from {RAW}),
each_ as (select archivo, case when site_no < 10 then 'ISO-8859-1' else 'UTF-8' end as encoding, coalesce(n, 0) as n_rows,
    case when site_no = 21 then 'fewer than two columns' when site_no in (22, 24) then 'row longer than header' end as reason
  from sites left join kept using (colegio))
select 'file' as kind, archivo, encoding, n_rows, reason from each_
union all select 'total', null, null, cast(sum(n_rows) as bigint), cast(count(reason) as string) from each_""")
def ingest_report(spark, sf):
    return _stored(spark, sf)[1].audit().drop("data_rows")
