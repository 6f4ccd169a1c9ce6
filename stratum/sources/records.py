"""Layouts of the record files that releases are made from, and their readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.sources.layout import Field, cut

# fixed values: name and width of each field, in the order of the published layouts
_WIDTHS = {
    "household_1940": """RECTYPE 1 YEAR 4 DATANUM 2 SERIAL 8 NUMPREC 2 SUBSAMP 2 HHWT 10 NUMPERHH 4 HHTYPE 1 DWELLING 8 SLPERNUM 2 CPI99 5 REGION 2 STATEICP 2
        STATEFIP 2 COUNTY 4 URBAN 1 METRO 1 METAREA 3 METAREAD 4 CITY 4 CITYPOP 5 SIZEPL 2 URBPOP 5 SEA 3 WARD 3 CNTRY 3 GQ 1 GQTYPE 1 GQTYPED 3 GQFUNDS 2
        FARM 1 OWNERSHP 1 OWNERSHPD 2 RENT 4 VALUEH 7 NFAMS 2 NSUBFAM 1 NCOUPLES 1 NMOTHERS 1 NFATHERS 1 MULTGEN 1 MULTGEND 2 ENUMDIST 4 SUPDIST 3 RESPOND 1
        SPLIT 1 SPLITHID 8 SPLITNUM 4 SPLIT40 1 SERIAL40 8 NUMPREC40 4 EDMISS 1""",
    "person_1940": """RECTYPE 1 YEAR 4 DATANUM 2 SERIAL 8 PERNUM 4 PERWT 10 SLWT 10 SLREC 1 RESPONDT 1 FAMUNIT 2 FAMSIZE 2 SUBFAM 1 SFTYPE 1 SFRELATE 1 MOMLOC 2
        STEPMOM 1 MOMRULE_HIST 1 POPLOC 2 STEPPOP 1 POPRULE_HIST 1 SPLOC 2 SPRULE_HIST 1 NCHILD 1 NCHLT5 1 NSIBS 1 ELDCH 2 YNGCH 2 RELATE 2 RELATED 4 SEX 1 AGE 3
        AGEMONTH 2 MARST 1 MARRNO 1 AGEMARR 2 CHBORN 2 RACE 1 RACED 3 HISPAN 1 HISPAND 3 BPL 3 BPLD 5 MBPL 3 MBPLD 5 FBPL 3 FBPLD 5 NATIVITY 1 CITIZEN 1 MTONGUE 2
        MTONGUED 4 SPANNAME 1 HISPRULE 1 SCHOOL 1 HIGRADE 2 HIGRADED 3 EDUC 2 EDUCD 3 EMPSTAT 1 EMPSTATD 2 LABFORCE 1 OCC 4 OCC1950 3 IND 4 IND1950 3 CLASSWKR 1
        CLASSWKRD 2 WKSWORK1 2 WKSWORK2 1 HRSWORK1 2 HRSWORK2 1 DURUNEMP 3 UOCC 3 UOCC95 3 UIND 3 UCLASSWK 1 INCWAGE 6 INCNONWG 1 OCCSCORE 2 SEI 2 PRESGL 3
        ERSCOR50 4 EDSCOR50 4 NPBOSS50 4 MIGRATE5 1 MIGRATE5D 2 MIGPLAC5 3 MIGMET5 4 MIGTYPE5 1 MIGCITY5 4 MIGSEA5 3 SAMEPLAC 1 SAMESEA5 1 MIGCOUNTY 4 VETSTAT 1
        VETSTATD 2 VET1940 1 VETWWI 1 VETPER 1 VETCHILD 1 HISTID 36 SURSIM 2 SSENROLL 1""",
    "unit_2018": "RTYPE 1 MAFID 9 FINAL_POP 5 HHLDRAGE 3 TEN 1 TEN_A 1 TEN_R 1 VACS 1 QGQTYP 3 OIDTB 22",
    "person_2018": """RTYPE 1 MAFID 9 CUF_PNC 5 QSEX 1 QAGE 3 QDB 8 QDOB_MONTH 2 QDOB_DAY 2 QDOB_YEAR 4 QSPAN1 4 QSPAN2 4 QSPAN3 4 QSPAN4 4 QSPAN5 4 QSPAN6 4 QSPAN7 4
        QSPAN8 4 QSPANX 1 CENHISP 1 QRACE1 4 QRACE2 4 QRACE3 4 QRACE4 4 QRACE5 4 QRACE6 4 QRACE7 4 QRACE8 4 QRACEX 1 CENRACE 2 IMPRACE 2 IMPRACE2 2 RACE2010 2
        FRACE2010 2 QREL 2""",
}
# fixed values: record types at the start of a line
TAGS = {"household_1940": "H", "person_1940": "P"}


def fields(layout: str) -> list[Field]:
    """Fields of a layout, all strings, lower-cased names."""
    words, at, out = _WIDTHS[layout].split(), 0, []
    for name, width in zip(words[::2], words[1::2], strict=True):
        out.append(Field(name.lower(), at, at + int(width)))
        at += int(width)
    return out


def records(lines: DataFrame, layout: str) -> DataFrame:
    """Records of ``lines(value)`` by layout; of the lines with the layout's tag only, where it has one."""
    return cut(lines, fields(layout), TAGS.get(layout))


def read_records(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return records(spark.read.text(path), layout)


def read_registered(spark: SparkSession, name: str, path: str, mapper: list[Field] | None = None, prefix: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """A file as a temp view under a free name: fixed-width text by ``mapper`` and record type, or delimited text with reader ``options``."""
    from stratum.sources.layout import fixed_width, register

    df = fixed_width(spark, path, mapper, prefix) if mapper else spark.read.options(**(options or {"header": "true"})).csv(path)
    return register(spark, name, df)


# fixed values: names, codes and abbreviations of the states and the district
_STATES = """Alabama 01 AL,Alaska 02 AK,Arizona 04 AZ,Arkansas 05 AR,California 06 CA,Colorado 08 CO,Connecticut 09 CT,Delaware 10 DE,District of Columbia 11 DC,
Florida 12 FL,Georgia 13 GA,Hawaii 15 HI,Idaho 16 ID,Illinois 17 IL,Indiana 18 IN,Iowa 19 IA,Kansas 20 KS,Kentucky 21 KY,Louisiana 22 LA,Maine 23 ME,Maryland 24 MD,
Massachusetts 25 MA,Michigan 26 MI,Minnesota 27 MN,Mississippi 28 MS,Missouri 29 MO,Montana 30 MT,Nebraska 31 NE,Nevada 32 NV,New Hampshire 33 NH,New Jersey 34 NJ,
New Mexico 35 NM,New York 36 NY,North Carolina 37 NC,North Dakota 38 ND,Ohio 39 OH,Oklahoma 40 OK,Oregon 41 OR,Pennsylvania 42 PA,Rhode Island 44 RI,South Carolina 45 SC,
South Dakota 46 SD,Tennessee 47 TN,Texas 48 TX,Utah 49 UT,Vermont 50 VT,Virginia 51 VA,Washington 53 WA,West Virginia 54 WV,Wisconsin 55 WI,Wyoming 56 WY"""


def states() -> list[tuple[str, str, str]]:
    """(name, code, abbreviation)."""
    return [tuple(x.strip().rsplit(" ", 2)) for x in _STATES.split(",")]


def with_state(df: DataFrame, column: str, how: str = "code") -> DataFrame:
    """Adds state_name, state_code and state_abbr by the ``how`` (name, code, abbr) in a column; unknown ones are null."""
    table = df.sparkSession.createDataFrame(states(), "state_name string, state_code string, state_abbr string")  # 51 rows
    return df.join(F.broadcast(table), F.lower(F.col(column).cast("string")) == F.lower(F.col(f"state_{how}")), "left")
