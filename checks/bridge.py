"""Raw clinical tables derived from the given star-schema tables.

Orders act as encounters and claims, lineitems as conditions, procedures, medications and
claim transactions, customers as patients, parts as codes, events as the smaller clinical
tables. Every raw column is text, as it would be after a CSV read, and some values are
malformed on purpose.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.operators.rows import first_n_as_columns

AS_OF = dt.date(2002, 1, 1)

STAMP = "cast({0} as string)"
DAY = "cast(cast({0} as date) as string)"


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _shape(df: DataFrame, table: str, columns: dict[str, str], state: str = "'ALL'") -> DataFrame:
    texts = [f"cast({e} as string) as {n}" for n, e in columns.items()]
    return df.selectExpr(*texts, f"'SYNTHEA.{table.upper()}' as _rec_src", f"{state} as _state")


def money(expr: str) -> str:
    return f"cast({expr} as decimal(18,2))"


def base36(number: str, width: int, offset: int = 0) -> str:
    """The number in base 36 behind an offset; fails loudly where it needs more digits."""
    shifted = f"({number} + {offset})"
    return (
        f"if({shifted} < {36**width}, lpad(conv({shifted}, 10, 36), {width}, '0'), "
        f"raise_error('a key needs more than {width} characters'))"
    )


def once(df: DataFrame, *expressions: str) -> DataFrame:
    """Columns worked out once a row, however often later filters and columns read them.

    Spark copies a column's expression into every filter that reads it, and a method of
    many such copies is too long for the JVM to compile. Rows of a generator are left alone.
    """
    return df.selectExpr(f"inline(array(named_struct({', '.join(expressions)})))")


# Icd code text of a part number: a letter, then at least two digits; from a million on, a
# number in base 36 that begins with a letter, so that no code needs more than 7 characters.
def icd_raw(p: str) -> str:
    digits = f"lpad({p}, greatest(2 + {p} % 5, length({p})), '0')"
    longer = base36(p, 6, 10 * 36**5 - 1_000_000)
    return f"concat(char(65 + {p} % 26), if({p} < 1000000, {digits}, {longer}))"


def icd(p: str) -> str:
    return icd_dotted(icd_raw(p))


def icd_dotted(raw: str) -> str:
    return f"if(length({raw}) > 3, concat(left({raw}, 3), '.', substring({raw}, 4)), {raw})"


def hcpcs(p: str) -> str:
    """Five characters: digits or A-E and digits below 20000, then F-Z and base 36."""
    rest, span = f"({p} - 20000)", 36**4
    return (
        f"case when {p} >= 20000 then if({rest} div {span} < 21, "
        f"concat(char(70 + {rest} div {span}), {base36(f'{rest} % {span}', 4)}), "
        f"raise_error('a procedure code needs more than 5 characters')) "
        f"when {p} % 2 = 0 then lpad({p}, 5, '0') "
        f"else concat(char(65 + {p} % 5), lpad({p} div 2, 4, '0')) end"
    )


def ndc(p: str) -> str:
    """Package codes in the three 10-digit shapes and the full 11-digit one."""
    a, b = f"lpad({p}, 8, '0')", f"lpad({p}, 9, '0')"
    return (
        f"case if({p} < 100000000, {p} % 4, raise_error('a drug code needs more than 8 digits')) "
        f"when 0 then concat(left({a},4), '-', right({a},4), '-10') "
        f"when 1 then concat(left({a},5), '-', right({a},3), '-20') "
        f"when 2 then concat(left({b},5), '-', right({b},4), '-3') "
        f"else concat(left({b},5), '-', right({b},4), '-40') end"
    )


def product_ndc(p: str) -> str:
    return f"substring_index({ndc(p)}, '-', 2)"


# One code of each chronic condition set, used for some parts.
CHRONIC_SAMPLE = [
    "26929004", "42343007", "709044004", "363346000", "13645005", "35489007", "44054006",
    "414545008", "64859006", "69896004", "230690007", "90688005",
]


def condition_code(p: str) -> str:
    codes = ", ".join(f"'{c}'" for c in CHRONIC_SAMPLE)
    return f"if({p} % 40 < 12, element_at(array({codes}), cast({p} % 40 + 1 as int)), cast({p} as string))"


class Raw:
    """Raw tables by name, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = getattr(self, name)()
        return self.built[name]

    def given(self, table: str) -> DataFrame:
        key = f"given {table}"
        if key not in self.built:
            self.built[key] = given(self.spark, self.sf_dir, table)
        return self.built[key]

    def _order_lines(self) -> DataFrame:
        owner = self.given("orders").select("o_orderkey", "o_custkey")
        return self.given("lineitem").join(owner, F.col("l_orderkey") == F.col("o_orderkey"))

    def _order_lines_by_text(self) -> DataFrame:
        """Order lines joined by the text that names their order in raw rows, so that what groups
        them by it needs no shuffle of its own.

        Filters of a join are named, as Spark adds them to some readers of a shuffle only, and
        the others would make it once more.
        """
        owner = self.given("orders").filter("o_orderkey is not null")
        owner = owner.selectExpr("cast(o_orderkey as string) as owned", "o_custkey")
        lines = self.given("lineitem").filter("l_orderkey is not null")
        lines = lines.withColumn("l_order", F.col("l_orderkey").cast("string"))
        return lines.join(owner, F.col("l_order") == F.col("owned"))

    def _dealt_parts(self) -> DataFrame:
        """Parts dealt out by key: their file is small and may be one task, their texts are not."""
        return self.given("part").repartition("p_partkey")

    def patients(self) -> DataFrame:
        df = self.given("customer").join(
            self.given("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        return _shape(
            df,
            "patients",
            {
                "Id": "c_custkey",
                "BIRTHDATE": "if(c_custkey % 97 = 5, '2020-13-45', "
                "cast(date_add(date'1940-01-01', cast(c_custkey * 37 % 22000 as int)) as string))",
                "DEATHDATE": "if(c_custkey % 11 = 0, "
                "cast(date_add(date'2001-01-01', cast(c_custkey % 300 as int)) as string), '')",
                "SSN": "concat('999-', c_custkey)",
                "PREFIX": "if(c_custkey % 3 = 0, null, 'Mx.')",
                "FIRST": "split_part(c_name, '#', 1)",
                "MIDDLE": "if(c_custkey % 4 = 0, 'Q', null)",
                "LAST": "split_part(c_name, '#', 2)",
                "SUFFIX": "if(c_custkey % 10 = 0, 'PhD', null)",
                "MARITAL": "element_at(array('M', 'S', 'D', 'W', null), cast(c_custkey % 5 + 1 as int))",
                "RACE": "element_at(array('white', 'black', 'asian', 'native', 'other'), "
                "cast(c_custkey % 5 + 1 as int))",
                "ETHNICITY": "if(c_custkey % 4 = 0, 'hispanic', 'nonhispanic')",
                "GENDER": "if(c_custkey % 2 = 0, 'F', 'M')",
                "ADDRESS": "c_name",
                "CITY": "concat(n_name, ' City')",
                "STATE": "n_name",
                "COUNTY": "concat(n_name, ' County')",
                "ZIP": "lpad(c_custkey % 100000, 5, '0')",
                "LAT": "concat(c_custkey % 180 - 90, '.25')",
                "LON": "concat(c_custkey % 360 - 180, '.5')",
                "HEALTHCARE_EXPENSES": money("c_acctbal"),
                "HEALTHCARE_COVERAGE": "concat(c_custkey, '.75')",
                "INCOME": f"if(c_custkey % 13 = 0, 'N/A', cast({money('c_acctbal')} as string))",
            },
            "n_name",
        )

    def encounters(self) -> DataFrame:
        hours = "timestampadd(HOUR, cast(o_orderkey % 72 as int), o_orderdate)"
        return _shape(
            self.given("orders"),
            "encounters",
            {
                "Id": "o_orderkey",
                "START": STAMP.format("o_orderdate"),
                "STOP": f"if(o_orderkey % 17 = 0, '', {STAMP.format(hours)})",
                "PATIENT": "o_custkey",
                "ORGANIZATION": "o_orderkey % 25",
                "PROVIDER": "if(o_orderkey % 41 = 0, null, o_orderkey % 10)",
                "PAYER": "o_orderkey % 5",
                "ENCOUNTERCLASS": "case left(o_orderpriority, 1) when '1' then 'emergency' "
                "when '2' then 'inpatient' when '3' then 'ambulatory' when '4' then 'outpatient' "
                "else case when o_orderkey % 31 = 0 then 'hospice' "
                "when o_orderkey % 3 = 0 then 'urgentcare' else 'wellness' end end",
                "CODE": "o_orderstatus",
                "DESCRIPTION": "concat('Encounter ', o_orderstatus)",
                "BASE_ENCOUNTER_COST": "concat(o_orderkey % 1000, '.50')",
                "TOTAL_CLAIM_COST": money("o_totalprice"),
                "PAYER_COVERAGE": "if(o_orderkey % 19 = 0, null, concat(o_orderkey % 50 * 1000, '.25'))",
                "REASONCODE": "if(o_orderkey % 3 = 0, null, concat('R', o_orderkey % 10))",
                "REASONDESCRIPTION": "if(o_orderkey % 3 = 0, null, concat('Reason ', o_orderkey % 10))",
            },
        )

    def _line_stop(self, shape: str) -> str:
        end = "timestampadd(DAY, cast(l_quantity as int), l_shipdate)"
        return f"if(l_linestatus = 'O', '', {shape.format(end)})"

    def conditions(self) -> DataFrame:
        return _shape(
            self._order_lines(),
            "conditions",
            {
                "START": DAY.format("l_shipdate"),
                "STOP": self._line_stop(DAY),
                "PATIENT": "o_custkey",
                "ENCOUNTER": "l_orderkey",
                "SYSTEM": "'SNOMED-CT'",
                "CODE": condition_code("l_partkey"),
                "DESCRIPTION": f"concat('Condition ', {condition_code('l_partkey')})",
            },
        )

    def procedures(self) -> DataFrame:
        return _shape(
            self._order_lines_by_text(),
            "procedures",
            {
                "START": STAMP.format("l_shipdate"),
                "STOP": self._line_stop(STAMP),
                "PATIENT": "o_custkey",
                "ENCOUNTER": "l_order",
                "SYSTEM": "'SNOMED-CT'",
                "CODE": hcpcs("l_partkey"),
                "DESCRIPTION": "concat('Procedure ', l_partkey)",
                "BASE_COST": "if(l_linenumber = 7, 'free', concat(cast(l_quantity as int) * 150, '.50'))",
                "REASONCODE": "if(l_linenumber % 2 = 0, null, concat('R', l_linenumber))",
                "REASONDESCRIPTION": "if(l_linenumber % 2 = 0, null, concat('Reason ', l_linenumber))",
            },
        )

    def medications(self) -> DataFrame:
        return _shape(
            self._order_lines(),
            "medications",
            {
                "START": STAMP.format("l_shipdate"),
                "STOP": self._line_stop(STAMP),
                "PATIENT": "o_custkey",
                "PAYER": "l_orderkey % 5",
                "ENCOUNTER": "l_orderkey",
                "CODE": "l_partkey",
                "DESCRIPTION": "concat('Medication ', l_partkey)",
                "BASE_COST": "concat(cast(l_quantity as int), '.25')",
                "PAYER_COVERAGE": "concat(l_linenumber * 10, '.00')",
                "DISPENSES": "if(l_linenumber = 7, '3.0', cast(l_linenumber as string))",
                "TOTALCOST": money("l_extendedprice"),
                "REASONDESCRIPTION": "if(l_linenumber % 2 = 0, null, concat('Reason ', l_linenumber))",
            },
        )

    def claims(self) -> DataFrame:
        codes = first_n_as_columns(
            self.given("lineitem"),
            "l_orderkey",
            [F.col("l_linenumber"), F.col("l_partkey")],
            {"DIAGNOSIS": (F.expr(icd("l_partkey")), 8)},
        )
        df = self.given("orders").join(codes, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        return _shape(
            df,
            "claims",
            {
                "Id": "o_orderkey",
                "PATIENTID": "o_custkey",
                "PROVIDERID": "o_orderkey % 10",
                "PRIMARYPATIENTINSURANCEID": "o_orderkey % 5",
                "SECONDARYPATIENTINSURANCEID": "if(o_orderkey % 2 = 0, null, (o_orderkey + 1) % 5)",
                **{f"DIAGNOSIS{i}": f"DIAGNOSIS{i}" for i in range(1, 8)},
                "DIAGNOSIS8": "coalesce(DIAGNOSIS8, '')",
                "APPOINTMENTID": "o_orderkey",
                "CURRENTILLNESSDATE": DAY.format("o_orderdate"),
                "SERVICEDATE": f"if(o_orderkey % 9 = 0, '', {DAY.format('o_orderdate')})",
                "OUTSTANDING1": f"if(o_orderstatus = 'F', '0', cast({money('o_totalprice')} as string))",
                "OUTSTANDING2": "if(o_orderkey % 7 = 0, null, o_orderkey % 100)",
            },
        )

    def claims_transactions(self) -> DataFrame:
        paid = "cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2)))"
        return _shape(
            self._order_lines(),
            "claims_transactions",
            {
                "ID": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
                "CLAIMID": "l_orderkey",
                "PATIENTID": "o_custkey",
                "AMOUNT": money("l_extendedprice"),
                "PAYMENTS": f"if(l_returnflag = 'N' and l_linenumber > 4, '', cast({paid} as string))",
                "ADJUSTMENTS": "'0'",
                "OUTSTANDING": "if(l_returnflag = 'A', '0', "
                f"cast({money('l_extendedprice')} as string))",
                "FROMDATE": DAY.format("l_shipdate"),
                "TODATE": DAY.format("timestampadd(DAY, cast(l_quantity as int), l_shipdate)"),
                "PROCEDURECODE": hcpcs("l_partkey"),
            },
        )

    def observations(self) -> DataFrame:
        return _shape(
            self.given("events"),
            "observations",
            {
                "DATE": "ts",
                "PATIENT": "user_id",
                "ENCOUNTER": "event_id",
                "CATEGORY": "case event_type when 'view' then 'vital-signs' when 'click' then "
                "'laboratory' when 'signup' then 'survey' when 'purchase' then 'Procedure' end",
                "CODE": "event_type",
                "DESCRIPTION": "concat('Observed ', event_type)",
                "VALUE": "case when event_id % 23 = 0 then null when event_id % 7 = 0 then '.5' "
                "when event_id % 5 = 0 then event_type "
                f"else cast({money('value')} as string) end",
                "UNITS": "if(event_id % 3 = 0, null, 'mg')",
                "TYPE": "if(event_id % 5 = 0, 'text', 'numeric')",
            },
        )

    def allergies(self) -> DataFrame:
        level = "element_at(array('MILD', 'MODERATE', 'SEVERE', null), cast({0} % 4 + 1 as int))"
        return _shape(
            self.given("events"),
            "allergies",
            {
                "START": DAY.format("ts"),
                "STOP": f"if(event_id % 3 = 0, '', {DAY.format('timestampadd(DAY, 20, ts)')})",
                "PATIENT": "user_id",
                "ENCOUNTER": "event_id",
                "CODE": "event_id % 200",
                "SYSTEM": "if(event_id % 2 = 0, null, 'RxNorm')",
                "DESCRIPTION": "concat('Allergy ', event_id % 200)",
                "TYPE": "if(event_id % 5 = 0, null, 'Allergy')",
                "CATEGORY": "if(event_id % 7 = 0, null, 'DRUG')",
                "REACTION1": "concat('RX', event_id % 9)",
                "DESCRIPTION1": "concat('Reaction ', event_id % 9)",
                "SEVERITY1": level.format("event_id"),
                "SEVERITY2": level.format("(event_id div 4)"),
            },
        )

    def careplans(self) -> DataFrame:
        return _shape(
            self.given("events"),
            "careplans",
            {
                "Id": "concat('plan-', event_id)",
                "START": DAY.format("ts"),
                "STOP": f"if(event_id % 4 = 0, '', {DAY.format('timestampadd(DAY, 45, ts)')})",
                "PATIENT": "user_id",
                "ENCOUNTER": "event_id",
                "CODE": "event_id % 50",
                "DESCRIPTION": "concat('Plan ', event_id % 50)",
                "REASONCODE": "event_id % 11",
                "REASONDESCRIPTION": "concat('Reason ', event_id % 11)",
            },
        )

    def devices(self) -> DataFrame:
        return _shape(
            self.given("events"),
            "devices",
            {
                "START": DAY.format("ts"),
                "STOP": f"if(event_id % 2 = 0, '', {DAY.format('timestampadd(DAY, 10, ts)')})",
                "PATIENT": "user_id",
                "ENCOUNTER": "event_id",
                "CODE": "if(event_id % 6 = 0, null, event_id % 30)",
                "DESCRIPTION": "concat('Device ', event_id % 30)",
                "UDI": "if(event_id % 3 = 0, concat('UDI', event_id), null)",
            },
        )

    def imaging_studies(self) -> DataFrame:
        return _shape(
            self.given("events"),
            "imaging_studies",
            {
                "Id": "concat('study-', event_id)",
                "DATE": f"if(event_id % 8 = 0, {STAMP.format('ts')}, {DAY.format('ts')})",
                "PATIENT": "user_id",
                "ENCOUNTER": "event_id",
                "SERIES_UID": "concat('1.2.', event_id)",
                "BODYSITE_CODE": "event_id % 13",
                "BODYSITE_DESCRIPTION": "concat('Site ', event_id % 13)",
                "MODALITY_CODE": "if(event_id % 2 = 0, 'CT', 'MR')",
                "MODALITY_DESCRIPTION": "if(event_id % 2 = 0, 'Computed tomography', 'Magnetic resonance')",
                "INSTANCE_UID": "concat('1.3.', event_id)",
                "SOP_CODE": "event_id % 4",
                "SOP_DESCRIPTION": "concat('Sop ', event_id % 4)",
                "PROCEDURE_CODE": "event_id % 90",
            },
        )

    def immunizations(self) -> DataFrame:
        return _shape(
            self.given("events"),
            "immunizations",
            {
                "DATE": DAY.format("ts"),
                "PATIENT": "user_id",
                "ENCOUNTER": "event_id",
                "CODE": "event_id % 20",
                "DESCRIPTION": "concat('Vaccine ', event_id % 20)",
                "BASE_COST": money("value"),
            },
        )

    def supplies(self) -> DataFrame:
        return _shape(
            self.given("events"),
            "supplies",
            {
                "DATE": DAY.format("ts"),
                "PATIENT": "user_id",
                "ENCOUNTER": "if(event_id % 4 = 0, null, event_id)",
                "CODE": "event_id % 25",
                "DESCRIPTION": "concat('Supply ', event_id % 25)",
                "QUANTITY": "if(event_id % 5 = 0, 'many', cast(event_id % 12 as string))",
            },
        )

    def payer_transitions(self) -> DataFrame:
        end = DAY.format("timestampadd(DAY, cast(o_orderkey % 900 as int), o_orderdate)")
        return _shape(
            self.given("orders"),
            "payer_transitions",
            {
                "PATIENT": "o_custkey",
                "MEMBERID": "concat('M', o_custkey)",
                "START_DATE": DAY.format("o_orderdate"),
                "END_DATE": f"if(o_orderkey % 6 = 0, '', {end})",
                "PAYER": "o_orderkey % 5",
                "PLAN_OWNERSHIP": "element_at(array('Self', 'Spouse', 'Guardian', null, 'Other'), "
                "cast(o_orderkey % 5 + 1 as int))",
                "OWNER_NAME": "concat('Owner ', o_custkey)",
            },
        )

    def organizations(self) -> DataFrame:
        return _shape(
            self.given("nation"),
            "organizations",
            {
                "Id": "n_nationkey",
                "NAME": "concat('Hospital ', n_name)",
                "ADDRESS": "concat(n_nationkey, ' Main St')",
                "CITY": "concat(n_name, ' City')",
                "STATE": "n_name",
                "ZIP": "lpad(n_nationkey, 5, '0')",
                "LAT": "concat(n_nationkey, '.')",
                "LON": "concat('-', n_nationkey, '.5')",
                "PHONE": "concat('555-', n_nationkey)",
                "REVENUE": "concat(n_nationkey * 1000, '.5')",
                "UTILIZATION": "n_nationkey * n_nationkey * 50",
            },
        )

    def providers(self) -> DataFrame:
        df = self.given("supplier").join(
            self.given("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        return _shape(
            df,
            "providers",
            {
                "Id": "s_suppkey",
                "ORGANIZATION": "s_nationkey",
                "NAME": "s_name",
                "GENDER": "if(s_suppkey % 2 = 0, 'F', 'M')",
                "SPECIALITY": "element_at(array('GENERAL PRACTICE', 'CARDIOLOGY', 'ONCOLOGY'), "
                "cast(s_suppkey % 3 + 1 as int))",
                "ADDRESS": "concat(s_suppkey, ' Side St')",
                "CITY": "concat(n_name, ' City')",
                "STATE": "n_name",
                "ZIP": "lpad(s_suppkey, 5, '0')",
                "LAT": "'N/A'",
                "LON": "concat(s_suppkey % 90, '.5')",
                "ENCOUNTERS": "s_suppkey * 3",
                "PROCEDURES": "concat(s_suppkey, '.0')",
            },
        )

    def payers(self) -> DataFrame:
        counted = self.given("orders").groupBy((F.col("o_orderkey") % 5).alias("payer")).agg(
            F.count("*").alias("n"),
            F.count_if(F.col("o_orderstatus") == "F").alias("covered"),
            F.count_distinct("o_custkey").alias("members"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"),
        )
        df = self.given("region").join(counted, F.col("r_regionkey") == F.col("payer"), "left")
        return _shape(
            df,
            "payers",
            {
                "Id": "r_regionkey",
                "NAME": "concat('Payer ', r_name)",
                "OWNERSHIP": "if(r_regionkey % 2 = 0, 'GOVERNMENT', 'PRIVATE')",
                "CITY": "concat(r_name, ' City')",
                "STATE_HEADQUARTERED": "r_name",
                "ZIP": "lpad(r_regionkey, 5, '0')",
                "PHONE": "concat('800-', r_regionkey)",
                "AMOUNT_COVERED": "r_regionkey * 1000",
                "AMOUNT_UNCOVERED": "r_regionkey * (r_regionkey - 1) * 300",
                "REVENUE": "revenue",
                "COVERED_ENCOUNTERS": "covered",
                "UNCOVERED_ENCOUNTERS": "n - covered",
                "COVERED_MEDICATIONS": "n div 2",
                "UNCOVERED_MEDICATIONS": "n div 3",
                "COVERED_PROCEDURES": "n div 4",
                "UNCOVERED_PROCEDURES": "n div 5",
                "COVERED_IMMUNIZATIONS": "n div 6",
                "UNCOVERED_IMMUNIZATIONS": "n div 7",
                "UNIQUE_CUSTOMERS": "members",
                "QOLS_AVG": "concat('0.', r_regionkey + 5)",
                "MEMBER_MONTHS": "members * 12 * r_regionkey",
            },
        )

    # --- code files, as their readers would return them -------------------------------

    def _parts(self, layout: str, columns: dict[str, str], df: DataFrame | None = None) -> DataFrame:
        from vitalmart.sources import layouts

        known = {**layouts.PIPE_COLUMNS, **layouts.TAB_COLUMNS}[layout]
        texts = [f"cast({columns.get(c, 'null')} as string) as {c}" for c in known]
        return (self.given("part") if df is None else df).selectExpr(*texts)

    TERM = (
        "case p_type when 'ECONOMY' then 'SCD' when 'STANDARD' then 'SBD' when 'SMALL' then 'IN' "
        "when 'MEDIUM' then if(p_partkey % 2 = 0, 'GPCK', 'BPCK') "
        "when 'LARGE' then if(p_partkey % 2 = 0, 'PIN', 'MIN') else 'BN' end"
    )

    def atoms(self, layout: str = "atoms") -> DataFrame:
        variants = self.given("part").withColumn("v", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
        return self._parts(
            layout,
            {
                "rxcui": "p_partkey",
                "language": "if((p_partkey + v) % 29 = 0, 'SPA', 'ENG')",
                "is_preferred": "if(v = p_partkey % 3, 'Y', 'N')",
                "rxaui": "p_partkey * 3 + v",
                "source_abbrev": "if((p_partkey + v) % 17 = 0, 'MTHSPL', 'RXNORM')",
                "term_type": f"if(v = 1, 'SCDC', {self.TERM})",
                "source_code": "p_partkey",
                "name": "concat(p_name, ' ', p_partkey, ' v', v)",
                "suppress_flag": "if((p_partkey + v) % 13 = 0, 'O', 'N')",
            },
            variants,
        )

    def attributes(self, layout: str = "attributes") -> DataFrame:
        variants = self.given("part").withColumn("v", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
        return self._parts(
            layout,
            {
                "rxcui": "p_partkey",
                "rxaui": "p_partkey * 3",
                "atn": "if(v = 2 and p_partkey % 3 > 0, 'RXTERM', 'NDC')",
                "source_abbrev": "if(v = 1, 'MTHSPL', 'RXNORM')",
                "atv": f"case v when 0 then {ndc('p_partkey')} "
                f"when 1 then replace({ndc('p_partkey')}, '-', '') else cast(p_partkey as string) end",
                "suppress_flag": "if((p_partkey + v) % 13 = 0, 'E', 'N')",
            },
            variants,
        )

    def relationships(self, layout: str = "relationships") -> DataFrame:
        return self._parts(
            layout,
            {
                "rxcui1": "p_partkey",
                "rel": "if(p_partkey % 2 = 0, 'RO', 'CHD')",
                "rxcui2": "p_partkey div 2 + 1",
                "rela": "if(p_partkey % 3 > 0, 'has_ingredient', 'isa')",
                "rui": "p_partkey",
                "source_abbrev": "'RXNORM'",
                "suppress_flag": "if(p_partkey % 10 = 9, 'O', null)",
            },
        )

    def semantic_types(self) -> DataFrame:
        return self._parts(
            "semantic_types",
            # every eighth row names a concept that is not there
            {
                "rxcui": "if(p_partkey % 8 = 0, concat('-', p_partkey), cast(p_partkey as string))",
                "tui": "concat('T', p_partkey % 5)",
                "sty": "p_type",
            },
        )

    def sources(self) -> DataFrame:
        return self._parts(
            "sources",
            {"vcui": "p_partkey", "rsab": "p_brand", "son": "p_name", "lat": "'ENG'", "ssn": "p_type"},
        )

    def doc(self) -> DataFrame:
        return self._parts(
            "doc",
            {"dockey": "p_type", "value": "p_brand", "type": "'expanded_form'", "expl": "p_name"},
        )

    def cui_history(self) -> DataFrame:
        return self._parts(
            "cui_history",
            {"cui1": "p_partkey", "ver_start": "'20AA'", "ver_end": "'21AB'", "cardinality": "p_size"},
        )

    def cui_changes(self) -> DataFrame:
        return self._parts(
            "cui_changes",
            {
                "rxaui": "p_partkey * 3",
                "code": "p_partkey",
                "sab": "'RXNORM'",
                "tty": "'SCD'",
                "str": "p_name",
                "old_rxcui": "p_partkey",
                "new_rxcui": "p_partkey + 1",
            },
        )

    def atom_archive(self) -> DataFrame:
        return self._parts(
            "atom_archive",
            {
                "rxaui": "p_partkey * 3",
                "str": "p_name",
                "code": "p_partkey",
                "is_brand": "if(p_type = 'PROMO', 'Y', 'N')",
                "rxcui": "p_partkey",
                "sab": "'RXNORM'",
                "tty": "'SCD'",
                "merged_to_rxcui": "p_partkey + 1",
            },
        )

    def prescribe_atoms(self) -> DataFrame:
        return self.atoms("prescribe_atoms")

    def prescribe_attributes(self) -> DataFrame:
        return self.attributes("prescribe_attributes")

    def prescribe_relationships(self) -> DataFrame:
        return self.relationships("prescribe_relationships")

    def ndc_product(self) -> DataFrame:
        return self._parts(
            "ndc_product",
            {
                "product_id": "concat(p_partkey, '_prod')",
                "product_ndc": product_ndc("p_partkey"),
                "product_type_name": "if(p_partkey % 4 = 1, 'HUMAN OTC DRUG', 'HUMAN PRESCRIPTION DRUG')",
                "proprietary_name": "upper(p_name)",
                "nonproprietary_name": "p_name",
                "dosage_form_name": "element_at(array('TABLET', 'CAPSULE', 'INJECTION'), "
                "cast(p_size % 3 + 1 as int))",
                "route_name": "if(p_size % 3 = 2, 'INTRAVENOUS', 'ORAL')",
                "start_marketing_date": "'20100101'",
                "end_marketing_date": "case when p_size % 7 = 0 then '20201231' when p_size % 7 = 1 then ' ' end",
                "marketing_category_name": "'NDA'",
                "application_number": "concat('NDA', p_partkey)",
                "labeler_name": "p_brand",
                "substance_name": "upper(p_name)",
                "active_numerator_strength": "p_size",
                "active_ingred_unit": "'mg/1'",
                "dea_schedule": "case when p_partkey % 10 = 0 then 'CII' when p_partkey % 10 = 1 then ' ' end",
                "ndc_exclude_flag": "if(p_partkey % 20 = 19, 'y', 'N')",
                "listing_record_certified_through": "'20251231'",
            },
        )

    def ndc_package(self) -> DataFrame:
        return self._parts(
            "ndc_package",
            {
                "product_id": "if(p_partkey % 15 = 14, 'none', concat(p_partkey, '_prod'))",
                "product_ndc": product_ndc("p_partkey"),
                "ndc_package_code": ndc("p_partkey"),
                "package_description": "concat(p_size, ' TABLET in 1 BOTTLE')",
                "start_marketing_date": "'20100101'",
                "end_marketing_date": "if(p_partkey % 9 = 8, '20191231', '')",
                "ndc_exclude_flag": "if(p_partkey % 25 = 24, 'Y', 'N')",
                "sample_package": "if(p_partkey % 6 = 5, 'Y', 'N')",
            },
        )

    def snomed_map(self) -> DataFrame:
        rows = self._dealt_parts().withColumn(
            "v", F.explode(F.expr("sequence(0, cast(p_partkey % 3 as int))"))
        )
        target = icd_raw("(p_partkey div 3 + v)")
        rows = once(
            rows, "'p_partkey', p_partkey", "'v', v", "'raw', " + target, "'concept', " + condition_code("p_partkey")
        )
        return self._parts(
            "snomed_map",
            {
                "id": "concat(p_partkey, '-', v)",
                "effective_time": "if(p_partkey % 14 = 0, ' ', '20230901')",
                "active": "if((p_partkey + v) % 12 = 11, '0', '1')",
                "snomed_concept_id": "concept",
                "snomed_concept_name": "concat('Concept ', concept)",
                "map_group": "if(p_partkey % 5 = 0, v + 1, 1)",
                "map_priority": "3 - v",
                "map_rule": "'TRUE'",
                "map_advice": "case (p_partkey + v) % 4 when 0 then 'ALWAYS X CONSIDER ADDITIONAL CODE' "
                "when 1 then 'MAP IS CONTEXT DEPENDENT FOR GENDER' "
                "when 2 then 'POSSIBLE REQUIREMENT FOR ADDITIONAL CODE' end",
                "icd10cm_code": f"if((p_partkey + v) % 11 = 10, ' ', concat({icd_dotted('raw')}, ' '))",
                "icd10cm_name": "concat('Diagnosis ', p_partkey div 3 + v)",
                "map_category_name": "element_at(array('Properly Classified', 'Context Dependent', "
                "'Cannot Be Classified', null), cast((p_partkey div 2 + v) % 4 + 1 as int))",
            },
            rows,
        )

    def hcpcs_lines(self) -> DataFrame:
        """Fixed-width procedure code lines, column ``value``."""
        fields = {
            "hcpcs_code": "code",
            "sequence_num": "'00100'",
            "record_type": "element_at(array('3', '7', '4'), cast(p_partkey % 7 % 3 + 1 as int))",
            "long_description": "concat('Long ', p_name)",
            "short_description": "concat('Short ', p_name)",
            "pricing_indicator_1": "if(p_size % 5 = 0, '', lpad(p_size % 5, 2, '0'))",
            "coverage_code": "element_at(array('C', 'D', 'I'), cast(p_size % 3 + 1 as int))",
            "betos_code": "if(p_partkey % 6 = 0, '', concat('P', p_size % 4, 'A'))",
            "code_added_date": "'20000101'",
            "termination_date": "case p_partkey % 5 when 0 then '20011231' when 1 then '20301231' else '' end",
            "action_code": "'N'",
        }
        from vitalmart.sources.layouts import PROCEDURE_CODE_RECORD

        # Blank columns between the fields are one literal.
        cells, upto = [], 1
        for name, start, width in PROCEDURE_CODE_RECORD:
            cell = fields.get(name)
            if cell is None:
                continue
            cells.append(f"space({start - upto})")
            long = f"raise_error('{name} needs more than {width} characters')"
            cells.append(f"if(length({cell}) <= {width}, rpad({cell}, {width}, ' '), {long})")
            upto = start + width
        cells.append(f"space({max(start + width for _, start, width in PROCEDURE_CODE_RECORD) - upto})")
        code = "'code', " + hcpcs("p_partkey")
        parts = once(self._dealt_parts(), *[f"'{n}', {n}" for n in ("p_partkey", "p_name", "p_size")], code)
        return once(parts, f"'value', concat({', '.join(cells)})")

    def icd_lines(self) -> DataFrame:
        """Fixed-width diagnosis code lines, column ``value``."""
        raw = "'raw', " + icd_raw("p_partkey")
        parts = once(self._dealt_parts(), *[f"'{n}', {n}" for n in ("p_partkey", "p_name", "p_size")], raw)
        return once(
            parts,
            "'value', concat(if(p_partkey < 100000, lpad(p_partkey, 5, '0'), "
            f"{base36('p_partkey', 5, 10 * 36**4 - 100_000)}), ' ', "
            "rpad(raw, 7, ' '), ' ', if(p_size % 3 = 0, '0', '1'), ' ', "
            "rpad(concat('Diagnosis ', p_partkey), 60, ' '), "
            "concat('Long diagnosis ', p_partkey, ' ', p_name))",
        )

    def note_files(self) -> DataFrame:
        """Documents as patient note files: ``path`` below the source root and ``value``."""
        uuid = "concat('00000000-0000-4000-8000-', lpad(lower(hex(doc_id)), 12, '0'))"
        return self.given("documents").selectExpr(
            f"concat(lang, '/output/notes/Person', doc_id, '_', {uuid}, '.txt') as path", "text as value"
        )

    def stray_files(self, folder: str) -> DataFrame:
        """Files between the notes whose names are no notes', one per part."""
        name = "element_at(array('index.txt', 'Person_00000000.txt', 'x.txt.bak'), cast(p_size % 3 + 1 as int))"
        return self.given("part").selectExpr(f"concat('en/output/{folder}/', p_partkey, '_', {name}) as path", "p_name as value")

    def encounter_note_files(self) -> DataFrame:
        """Conversation turns as encounter note files: ``path`` and ``value``."""
        uuid = "concat('00000000-0000-4000-8000-', lpad(lower(hex(conv_id)), 12, '0'))"
        return self.given("conversations").selectExpr(
            f"concat(role, '/output/text_encounters/Person', conv_id, '_', {uuid}, turn, '.txt') as path", "text as value"
        )
