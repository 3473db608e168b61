"""The instrument register as published: full and delta XML files to tables.

One mapping serves both formats: a record has the same paths under a full
file's record element and under each of a delta's four change elements. A
delta's change type is the name of its record's one child, its reporting date
stands in the file's header, and its records are numbered in document order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbook.functions.text import PATTERNS
from sparkbook.sources.registers import DELTA_TYPES, delta_type
from sparkbook.sources.xml_records import header_values, read_records

# Column -> element path below the record, in published order.
COLUMNS = {
    "isin": "FinInstrmGnlAttrbts.Id",
    "full_name": "FinInstrmGnlAttrbts.FullNm",
    "short_name": "FinInstrmGnlAttrbts.ShrtNm",
    "cfi_code": "FinInstrmGnlAttrbts.ClssfctnTp",
    "notional_ccy": "FinInstrmGnlAttrbts.NtnlCcy",
    "commodity_deriv_indicator": "FinInstrmGnlAttrbts.CmmdtyDerivInd",
    "issuer_lei": "Issr",
    "trading_venue_mic": "TradgVnRltdAttrbts.Id",
    "issuer_requested": "TradgVnRltdAttrbts.IssrReq",
    "admission_approval_dt": "TradgVnRltdAttrbts.AdmssnApprvlDtByIssr",
    "admission_request_dt": "TradgVnRltdAttrbts.ReqForAdmssnDt",
    "first_trade_dt": "TradgVnRltdAttrbts.FrstTradDt",
    "termination_dt": "TradgVnRltdAttrbts.TermntnDt",
    "debt_total_issued_nominal": "DebtInstrmAttrbts.TtlIssdNmnlAmt",
    "debt_maturity_dt": "DebtInstrmAttrbts.MtrtyDt",
    "debt_nominal_per_unit": "DebtInstrmAttrbts.NmnlValPerUnit",
    "derivative_expiry_dt": "DerivInstrmAttrbts.XpryDt",
    "price_multiplier": "DerivInstrmAttrbts.PricMltplr",
    "option_type": "DerivInstrmAttrbts.OptnTp",
    "option_exercise_style": "DerivInstrmAttrbts.OptnExrcStyle",
    "delivery_type": "DerivInstrmAttrbts.DlvryTp",
    "valid_from": "TechAttrbts.PblctnPrd.FrDt",
    "relevant_competent_authority": "TechAttrbts.RlvntCmptntAuthrty",
    "relevant_trading_venue": "TechAttrbts.RlvntTradgVn",
    "inconsistency_indicator": "TechAttrbts.IncnsstncyInd",
    "last_updated": "TechAttrbts.LastUpd",
}
# What only a delta record has, and the keys of a cancellation.
DELTA_COLUMNS = {"never_published": "TechAttrbts.NvrPblshd"}
KEYS = ("isin", "trading_venue_mic")
UNDERLYING = "DerivInstrmAttrbts.UndrlygInstrm"

FULL_NAME = r"^FULINS_([A-Z])_(\d{4})(\d{2})(\d{2})_.*$"
DELTA_NAME = r"^DLTINS_(\d{4})(\d{2})(\d{2})_.*$"


def _schema(paths: Sequence[str]) -> T.StructType:
    text = T.StringType()
    tree: dict = {}
    for path in paths:
        at = tree
        *parents, leaf = path.split(".")
        for p in parents:
            at = at.setdefault(p, {})
        at[leaf] = text
    index = T.StructType([T.StructField("ISIN", text), T.StructField("Nm", T.StructType([T.StructField("RefRate", T.StructType([T.StructField("Nm", text)]))]))])
    many = T.ArrayType(text)
    tree.setdefault("DerivInstrmAttrbts", {})["UndrlygInstrm"] = T.StructType([
        T.StructField("Sngl", T.StructType([T.StructField("ISIN", many), T.StructField("LEI", many), T.StructField("Indx", T.ArrayType(index))])),
        T.StructField("Bskt", T.StructType([T.StructField("ISIN", many), T.StructField("LEI", many)])),
    ])

    def build(node) -> T.DataType:
        if isinstance(node, T.DataType):
            return node
        return T.StructType([T.StructField(k, build(v)) for k, v in node.items()])

    return build(tree)


RECORD = _schema([*COLUMNS.values(), *DELTA_COLUMNS.values()])


def _published(file_col: str, pattern: str, at: int) -> Column:
    """Publication date (yyyy-MM-dd) from the file name; a name of another form fails the job."""
    name = F.col(file_col)
    date = F.concat_ws("-", *[F.regexp_extract(name, pattern, at + k) for k in range(3)])
    return F.when(name.rlike(pattern), date).otherwise(F.raise_error(F.concat(F.lit("unexpected file name: "), name)))


def read_full(spark: SparkSession, paths) -> DataFrame:
    """A full file's records with ``record`` (the struct read), lineage and the category that the file name carries."""
    raw = read_records(spark, paths, "RefData", RECORD)
    out = raw.select(
        *[F.col(f"record.{p}").alias(c) for c, p in COLUMNS.items()], F.regexp_extract("source_file", FULL_NAME, 1).alias("cfi_category"),
        "source_file", _published("source_file", FULL_NAME, 2).alias("publication_date"), "record_sequence", "record")
    return out.withColumn("ingested_at", F.current_timestamp())


def header_dates(spark: SparkSession, paths) -> DataFrame:
    """(source_file, reporting_date): the reporting period that each file's header states."""
    return header_values(spark, paths, "FinInstrm", "RptgPrd", "Dt").withColumnRenamed("value", "reporting_date")


def read_deltas(spark: SparkSession, paths) -> DataFrame:
    """Delta records with change type, header date, sequence and lineage; a
    record without exactly one known change element fails the job. The category
    is the first letter of the record's own classification."""
    kinds = T.StructType([T.StructField(k, RECORD) for k in DELTA_TYPES])
    raw = read_records(spark, paths, "FinInstrm", kinds).withColumnRenamed("record", "r")
    raw = raw.withColumn("record_type", delta_type("r")).withColumn("record", F.coalesce(*[F.col(f"r.{k}") for k in DELTA_TYPES]))
    header = header_dates(spark, paths).groupBy(F.col("source_file").alias("__file")).agg(F.min("reporting_date").alias("reporting_date"), F.count_distinct("reporting_date").alias("reporting_dates"))
    x = raw.join(header, F.col("source_file") == F.col("__file"), "left")
    return x.select(
        *[F.col(f"record.{p}").alias(c) for c, p in {**COLUMNS, **DELTA_COLUMNS}.items()], "record_type", "reporting_date", "reporting_dates", "record_sequence",
        F.substring("record.FinInstrmGnlAttrbts.ClssfctnTp", 1, 1).alias("cfi_category"), "source_file",
        _published("source_file", DELTA_NAME, 1).alias("publication_date"), F.current_timestamp().alias("ingested_at"), "record")


def underlyings(records: DataFrame) -> DataFrame:
    """Child rows of records that have underlyings: single security, single
    entity, index, then the basket's securities and entities, numbered from 1."""
    u = F.col(f"record.{UNDERLYING}")
    null = F.lit(None).cast("string")

    def branch(ids: Column, source: str, kind: str) -> Column:
        one = lambda x: F.struct(F.lit(source).alias("underlying_source"), F.lit(kind).alias("underlying_type"), x.alias("underlying_id"), null.alias("underlying_name"))
        return F.transform(F.coalesce(ids, F.array().cast("array<string>")), one)

    index = F.transform(u["Sngl"]["Indx"], lambda x: F.struct(
        F.lit("single").alias("underlying_source"), F.lit("INDEX").alias("underlying_type"), x["ISIN"].alias("underlying_id"), x["Nm"]["RefRate"]["Nm"].alias("underlying_name")))
    every = F.concat(branch(u["Sngl"]["ISIN"], "single", "ISIN"), branch(u["Sngl"]["LEI"], "single", "LEI"),
                     F.coalesce(index, branch(F.array().cast("array<string>"), "single", "INDEX")),
                     branch(u["Bskt"]["ISIN"], "basket", "ISIN"), branch(u["Bskt"]["LEI"], "basket", "LEI"))
    x = records.select(F.col("isin").alias("parent_isin"), F.col("trading_venue_mic").alias("parent_mic"), "record_sequence", "cfi_category", "source_file",
                       "publication_date", F.posexplode(every).alias("at", "c"))
    return x.select("parent_isin", "parent_mic", "record_sequence", "c.*", (F.col("at") + 1).cast("int").alias("ordinal"), "cfi_category", "source_file", "publication_date")


def delta_rules(deltas: DataFrame, children: DataFrame | None = None, payload: Sequence[str] | None = None) -> DataFrame:
    """Violations of the delta feed's structural rules as (rule, severity, keys, source_file).

    Columns that ``deltas`` lacks switch no rule on. Fatal: unknown change type,
    missing key, header date absent, repeated or other than the file's, payload
    on a cancellation, malformed identifier, child without its record. Warnings:
    no classification, no currency, termination without a date.
    """
    has = set(deltas.columns)
    payload = [c for c in (payload or [*COLUMNS, *DELTA_COLUMNS]) if c in has and c not in KEYS]
    kind, blank = F.col("record_type"), lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    rules: list[tuple[str, str, Column]] = [
        ("unknown_record_type", "fatal", ~F.coalesce(kind.isin(*DELTA_TYPES.values()), F.lit(False))),
        ("missing_key", "fatal", blank("isin") | blank("trading_venue_mic")),
    ]
    if {"reporting_date", "publication_date"} <= has:
        rules += [("no_header_date", "fatal", F.col("reporting_date").isNull()),
                  ("header_date_differs", "fatal", F.col("reporting_date").cast("date") != F.col("publication_date").cast("date"))]
    if "reporting_dates" in has:
        rules.append(("several_header_dates", "fatal", F.col("reporting_dates") > 1))
    if payload:
        rules.append(("canc_with_payload", "fatal", (kind == "CANC") & reduce(lambda a, c: a | F.col(c).isNotNull(), payload, F.lit(False))))
    rules += [(f"no_{c}", "warn", (kind != "CANC") & blank(c)) for c in ("cfi_code", "notional_ccy") if c in has]
    if "termination_dt" in has:
        rules.append(("undated_termination", "warn", (kind == "TERMNTD") & blank("termination_dt")))
    for c, form in (("isin", "ISIN"), ("trading_venue_mic", "MIC"), ("issuer_lei", "LEI")):
        if c in has and dict(deltas.dtypes)[c] == "string":
            rules.append((f"bad_{c}", "fatal", ~blank(c) & ~F.col(c).rlike(PATTERNS[form])))
    # One pass: a row explodes into the rules it breaks.
    broken = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(n).alias("rule"), F.lit(s).alias("severity"))) for n, s, cond in rules]))
    file_col = [c for c in ("source_file",) if c in has]
    out = deltas.select(F.explode(broken).alias("b"), *KEYS, *file_col).select("b.rule", "b.severity", *KEYS, *file_col)
    if children is not None:
        link = ["parent_isin", "parent_mic", "record_sequence", *file_col]
        parents = deltas.select(F.col("isin").alias("parent_isin"), F.col("trading_venue_mic").alias("parent_mic"), "record_sequence", *file_col).distinct()
        lost = children.join(parents, reduce(lambda a, c: a & children[c].eqNullSafe(parents[c]), link, F.lit(True)), "left_anti")
        keys = [F.col("parent_isin").alias(KEYS[0]), F.col("parent_mic").alias(KEYS[1]), *file_col]
        out = out.unionByName(lost.select(F.lit("orphan_underlying").alias("rule"), F.lit("fatal").alias("severity"), *keys))
        form = reduce(lambda c, k: c.when(F.col("underlying_type") == k, F.col("underlying_id").rlike(PATTERNS[k])), ("ISIN", "LEI"), F.when(F.lit(False), F.lit(True)))
        bad = children.filter(F.col("underlying_id").isNotNull() & ~F.coalesce(form, F.lit(True)))
        out = out.unionByName(bad.select(F.lit("bad_underlying_id").alias("rule"), F.lit("fatal").alias("severity"), *keys))
        nameless = children.filter(F.col("underlying_id").isNull() & F.col("underlying_name").isNull())
        out = out.unionByName(nameless.select(F.lit("unidentified_underlying").alias("rule"), F.lit("warn").alias("severity"), *keys))
    return out
