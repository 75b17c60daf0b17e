"""Soil-test rows over the ``events`` table: the driver's tables hold no nulls
or sentinels, so these expressions plant them. The texts run unchanged in
Spark and in DuckDB."""

from __future__ import annotations

from checks.registry import table

RAW = {
    "sample_id": "event_id",
    "colegio": "concat('School ', cast(user_id % 25 as string))",
    "item": "concat(upper(substr(event_type,1,3)), '-', cast(event_id % 9 as string))",
    "de": "cast(event_id % 40 as string)",
    "hasta": "case when event_id % 17 = 0 then '-' "
             "else cast(event_id % 40 + 1 + event_id % 3 as string) end",
    "vs_m_s": "case when event_id % 11 = 0 then '-' when event_id % 29 = 0 then '12,5' "
              "else cast(150 + (event_id * 7919) % 600 as string) end",
    "gravas": "case when event_id % 5 = 0 then null else cast((event_id * 31) % 70 as string) end",
    "arenas": "case when event_id % 23 = 0 then '<5' when event_id % 31 = 0 then '12d' "
              "else concat(' ', cast((event_id * 17) % 60 as string), '.5 ') end",
    "finos": "case when event_id % 37 = 0 then 'inf' else cast((event_id * 13) % 45 as string) end",
    "sucs": "case when event_id % 13 = 0 then null else upper(substr(event_type,1,2)) end",
    "nspt": "case when event_id % 19 = 0 then null else value end",
    "qadm_kg_cm2": "case when event_id % 7 = 0 then '-' "
                   "else cast((event_id * 11) % 90 + event_id % 40 as string) end",
    "potencia": "cast(null as string)",
}
RAW_SQL = "select " + ", ".join(f"{e} as {n}" for n, e in RAW.items()) + " from events"
NUMBERS = ("de", "hasta", "vs_m_s", "gravas", "arenas", "finos", "qadm_kg_cm2", "potencia")
PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number(c: str) -> str:
    return (f"case when regexp_matches(trim({c}), '{PATTERN}') "
            f"then try_cast(trim({c}) as double) end")


COERCED_SQL = (
    "select sample_id, colegio, item, "
    + ", ".join(f"{number(c)} as {c}" for c in NUMBERS)
    + f", sucs, nspt from ({RAW_SQL}) raw")
DERIVED_SQL = (f"select *, (de + hasta) / 2 as profundidad_media, "
               f"split_part(item, '-', 1) as tipo_ensayo from ({COERCED_SQL}) coerced")
CLEAN_SQL = f"select * from ({DERIVED_SQL}) derived where profundidad_media is not null"


def raw(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} as {n}" for n, e in RAW.items()])


def clean(spark, sf_dir):
    from estrato.operators.clean import clean_rows

    return clean_rows(raw(spark, sf_dir))
