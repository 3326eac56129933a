"""Test inputs of the radiotherapy extract, derived from the driver's tables.

The driver ships TPC-H-like tables (orders, lineitem, customer, supplier,
nation, region, events).  The views below map them onto the episode,
prescription, exposure, patient, address and geography tables the extract
reads (FIXTURES.md section 2).  Each view is one SQL template; ``{name}``
marks a table reference.  Spark renders the template with DataFrame
arguments (``spark.sql(text, name=df)``), the DuckDB oracle renders it with
plain view names, so both engines read the very same definitions.

Every view scales with the driver's tables; none holds made-up rows except
the nine-row provider network look-up, which is reference data by nature.
The modulo conditions in the templates decide *what* a row is; rows that must
find no match (customers without a patient record, LSOAs without an ICB or a
deprivation quintile, lines without an exposure, months without activity) get
a key that matches nothing, so every row of every table is read and kept.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Inputs

BASE_TABLES = ("orders", "lineitem", "customer", "supplier", "nation", "region", "events")

# name -> SQL template.  Order matters: a view may only use earlier ones.
VIEW_TEMPLATES: dict[str, str] = {
    "ep0": """
SELECT o_orderkey AS k, o_custkey AS patientid, CAST(o_orderdate AS DATE) AS od,
 CASE WHEN o_orderkey % 50 IN (1,3) THEN o_orderkey-1 ELSE o_orderkey END AS epno,
 split_part('RH1,R1H,RP6,RNL,RNN,RGQ,RDE,RQ8,RAJ,RXH,E0A,RYR,RA3,RA7,7A1,ZZZ,RDD,RBA,RDZ,RD3,RNJ',',',
   CAST((CASE WHEN o_orderkey % 50 = 1 THEN o_orderkey-1 ELSE o_orderkey END) % 21 AS INT)+1) AS prov
FROM {orders}""",
    "at_episodes": """
SELECT DISTINCT e.k*10+l.l_linenumber AS attendid, concat('E',e.epno) AS radiotherapyepisodeid,
 e.patientid, e.prov AS orgcodeprovider,
 e.od + CAST(8766+(l.l_linenumber-1)*7 AS INT) AS treatmentstartdate,
 CASE WHEN e.k%10<6 THEN '02' WHEN e.k%10<8 THEN '01'
      WHEN e.k%10=8 THEN (CASE WHEN l.l_linenumber%2=0 THEN '02' ELSE '01' END)
      WHEN e.k%20=9 THEN '03' END AS radiotherapyintent,
 split_part('C021,C320,C501,D051,C151,C159,C810,C833,C61,C619,C340,C341,C349,C20,C539,C211,C679,C713,D329,C443,C189,C73,C700,C859',',',CAST(e.k%24 AS INT)+1) AS radiotherapydiagnosisicd
FROM {lineitem} l JOIN {ep0} e ON l.l_orderkey=e.k""",
    "at_prescriptions": """
SELECT DISTINCT e.k*10+l.l_linenumber AS attendid, concat('E',e.epno) AS radiotherapyepisodeid,
 e.patientid, e.prov AS orgcodeprovider, concat('RX',l.l_partkey) AS prescriptionid,
 CASE WHEN l.l_quantity=50 THEN CAST(70 AS DECIMAL(8,3))
      ELSE CAST(split_part('50,55,40,26,60,66,45,36.25,20,8,50.4,70,48,54,37.5,25,32.5,45,50,50,60,30,45,50,40,54,30,36,45,40,35,18,35,39,61,55.001,49',',',CAST(e.k%37 AS INT)+1) AS DECIMAL(8,3)) END AS rtprescribeddose,
 CASE WHEN e.k%29=0 THEN 0 WHEN e.k%31=0 THEN NULL
      ELSE CAST(split_part('28,20,15,5,30,33,25,5,6,1,28,35,15,36,15,5,4,20,25,5,5,1,5,16,28,30,12,10,10,8,4,1,12,15,30,28,28',',',CAST(e.k%37 AS INT)+1) AS INT) END AS prescribedfractions,
 CASE WHEN l.l_returnflag='A' AND l.l_discount<0.05 THEN '06' ELSE '05' END AS rttreatmentmodality,
 NULLIF(split_part('P,R,PR,A,M,O,O,,P',',',CAST(round(l.l_tax*100) AS INT)+1),'') AS rttreatmentregion
FROM {lineitem} l JOIN {ep0} e ON l.l_orderkey=e.k""",
    "at_exposures": """
SELECT CASE WHEN l.l_quantity=1 THEN -1 ELSE 1 END*(e.k*10+l.l_linenumber) AS attendid,
 concat('E',e.epno) AS radiotherapyepisodeid,
 e.patientid, e.prov AS orgcodeprovider, concat('RX',l.l_partkey) AS prescriptionid,
 CASE WHEN l.l_suppkey%10=0
  THEN split_part('RA7OT1887,RHQOT1816,RHQOT1817,R1HOT2041,R1HOT3116,RTHOT3117,RR8OT3006,RNJLA1743,RWHLA1685,RRKLA1819,RPYLA1894,RPYLA1978',',',CAST(l.l_partkey%12 AS INT)+1) ELSE concat('M',l.l_suppkey) END AS machineid
FROM {lineitem} l JOIN {ep0} e ON l.l_orderkey=e.k""",
    "at_patient": """
SELECT CASE WHEN c_custkey%103=0 THEN -c_custkey ELSE c_custkey END AS patientid,
 CASE WHEN c_custkey%101<>0 THEN CAST('1925-01-01' AS DATE) + CAST(c_custkey*37%34000 AS INT) END AS birthdatebest,
 CASE WHEN c_custkey%20=0 THEN 0 WHEN c_custkey%20=10 THEN 9 WHEN c_custkey%20=2 THEN NULL
      WHEN c_custkey%2=1 THEN 1 ELSE 2 END AS sex,
 NULLIF(split_part('A,B,C,D,E,F,G,H,J,K,L,M,N,P,R,S,Z,X,,A,A,A,A,A,T',',',c_nationkey+1),'') AS ethnicity,
 NULLIF(split_part('WHITE BRITISH,WHITE IRISH,ANY OTHER WHITE BACKGROUND,MIXED WHITE AND BLACK CARIBBEAN,MIXED WHITE AND BLACK AFRICAN,MIXED WHITE AND ASIAN,ANY OTHER MIXED BACKGROUND,ASIAN INDIAN,ASIAN PAKISTANI,ASIAN BANGLADESHI,ANY OTHER ASIAN BACKGROUND,BLACK CARIBBEAN,BLACK AFRICAN,ANY OTHER BLACK BACKGROUND,CHINESE,ANY OTHER ETHNIC GROUP,NOT STATED,NOT KNOWN,,Polish,English,WHITE,WHITE BRITISH,WHITE BRITISH,UNLISTED GROUP',',',c_nationkey+1),'') AS ethnicityname
FROM {customer}""",
    "address": """
SELECT event_id AS addressid, CAST(floor(event_id/8.0) AS BIGINT) AS patientid,
 CASE WHEN event_id%7<>0 THEN CAST('2024-01-01' AS DATE) - CAST(event_id*53%6000 AS INT) END AS dateofaddress,
 concat('P',user_id) AS postcode
FROM {events}""",
    "nspl": """
SELECT concat('P',s_suppkey) AS pcd,
 CASE WHEN s_nationkey%6=0 THEN concat('W',s_suppkey) WHEN s_nationkey%11<>0 THEN concat('E',s_suppkey) END AS lsoa11,
 s_nationkey AS hlthau
FROM {supplier}""",
    "hlthau": """
SELECT n_nationkey AS hlthaucd,
 CASE n_nationkey%4 WHEN 0 THEN 'Powys Teaching Health Board' WHEN 1 THEN 'Fife' WHEN 2 THEN 'Isle of Man' ELSE n_name END AS hlthaunm
FROM {nation}""",
    "lsoa_icb": """
SELECT concat(CASE WHEN s_suppkey%17=0 THEN 'X' ELSE 'E' END,s_suppkey) AS lsoa11cd, concat(r_name,' Integrated Care Board') AS icb22nm
FROM {supplier} JOIN {nation} ON s_nationkey=n_nationkey JOIN {region} ON n_regionkey=r_regionkey""",
    "imd": """
SELECT concat(CASE WHEN s_suppkey%19=0 THEN 'X' ELSE 'E' END,s_suppkey) AS lsoa11_code,
 split_part('1 - most deprived,2,3,4,5 - least deprived',',',CAST(s_suppkey%5 AS INT)+1) AS imd19_quintile_lsoas
FROM {supplier}""",
    "rt_networks": """
SELECT c AS provider_code, CASE WHEN c='7A1' THEN 'Wales' ELSE 'England' END AS country,
 concat('Provider ',c) AS provider_name, concat('Network ',substr(c,1,2)) AS rt_network_name,
 concat('Alliance ',substr(c,2,1)) AS cancer_alliance_old,
 CASE WHEN c<>'RDE' THEN concat('Alliance ',substr(c,2,1)) END AS cancer_alliance_new
FROM (VALUES ('R1H'),('RNN'),('RDE'),('RAJ'),('RYR'),('RA7'),('7A1'),('RH5'),('R0D')) t(c)""",
    "working_days": """
SELECT DISTINCT CAST(date_trunc('month', {od_shifted}) AS DATE) AS calendar_month,
 CAST(18 + month(od)%5 AS INT) AS working_days
FROM {ep0}
UNION SELECT DISTINCT CAST(date_trunc('month', {od_shifted} - 2922) AS DATE), CAST(20 AS INT) FROM {ep0}""",
    "trustsics": """
SELECT provider_code AS code, provider_name AS trustname FROM {rt_networks}""",
}

# Dialect differences between the two renderings.
_OD_SHIFTED = {"spark": "od + 8766", "duckdb": "CAST(od + 8766 AS DATE)"}

_REF = re.compile(r"\{(\w+)\}")


def render(name: str, dialect: str, table_ref=lambda n: n) -> str:
    """Render one view template; ``table_ref`` maps a referenced name to text."""
    text = VIEW_TEMPLATES[name]
    text = text.replace("{od_shifted}", _OD_SHIFTED[dialect])
    return _REF.sub(lambda m: table_ref(m.group(1)), text)


def view_dependencies(name: str) -> list[str]:
    text = VIEW_TEMPLATES[name].replace("{od_shifted}", "")
    return _REF.findall(text)


def input_views(spark: SparkSession, sf_dir: str) -> Inputs:
    """Every input view as a lazy DataFrame over the driver's tables."""
    frames: dict[str, DataFrame] = {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in BASE_TABLES}
    for name in VIEW_TEMPLATES:
        deps = {d: frames[d] for d in set(view_dependencies(name))}
        if name in ("at_episodes", "at_prescriptions", "at_exposures"):
            frames[name] = attendances(spark, name, frames)
        else:
            frames[name] = spark.sql(render(name, "spark", table_ref=lambda n: "{" + n + "}"), **deps)
    return Inputs(**{f: frames[f] for f in Inputs.__dataclass_fields__})


# Parts of the templates that read a line alone, and the names of their values: a flag or a number moves in place of their columns.
LINE_VALUES = {"l.l_quantity=50": "full_quantity", "l.l_quantity=1": "single_quantity",
               "l.l_returnflag='A' AND l.l_discount<0.05": "discounted_return", "CAST(round(l.l_tax*100) AS INT)": "tax_percent"}


def attendances(spark: SparkSession, name: str, frames: dict[str, DataFrame]) -> DataFrame:
    """An attendance view.  The base tables' own columns are joined, and the template's expressions are evaluated on the
    joined rows: they hold longer values than what they are made of, and more columns would move (``LINE_VALUES`` are shorter).  Prescriptions are dealt by
    attendance, where their repeats and, later, their joins find a row."""
    head, lines = render(name, "spark").split("\nFROM ")[0], frames["lineitem"]
    for part, value in LINE_VALUES.items():
        if part in head:
            head, lines = head.replace(part, value), lines.withColumn(value, F.expr(part.replace("l.", "")))
    attendance, rest = re.sub(r"\b[el]\.", "", head).removeprefix("\nSELECT ").removeprefix("DISTINCT ").split(" AS attendid,", 1)
    ep0 = render("ep0", "spark").split("\nFROM ")[0]
    joined = lines.join(frames["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.withColumn("attendid", F.expr(re.sub(r"\bk\b", "o_orderkey", attendance)))
    if name == "at_prescriptions":
        joined = joined.repartition("attendid")
    rows = spark.sql(f"SELECT attendid,{rest} FROM ({ep0}, * FROM {{joined}})", joined=joined)
    return rows.distinct() if head.startswith("\nSELECT DISTINCT") else rows


def load_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The extract's input tables over the driver's tables (any path that Spark reads), nothing copied."""
    return input_views(spark, sf_dir)
