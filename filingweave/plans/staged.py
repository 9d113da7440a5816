"""The staged run: collect -> map -> export. Every stage reads and writes tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingweave import fixed_values as fv
from filingweave import schemas
from filingweave.functions.codes import company_code, is_company_code, stock_code
from filingweave.functions.text import document_hint
from filingweave.operators import mapping
from filingweave.operators.folded import FoldedTable, counted_first
from filingweave.operators.grouped import distinct_on, top_per_key, value_counts
from filingweave.operators.markup import encode_rows, extract_rows
from filingweave.operators.keyfilter import may_be_in
from filingweave.operators.keystore import KeyStore, pending_of
from filingweave.operators.merge import (
    company_summary, executive_sheet, named_only, with_columns_present, with_labels,
)
from filingweave.operators.pending import pending
from filingweave.operators.reports import select_reports, viewer_url
from filingweave.session import discard, folders, scratch, spread
from filingweave.sources.archives import of_days, unpack
from filingweave.sources.listings import items_in_window, listing_rejects
from filingweave.sources.tables import batch_name, read_or_empty, read_table, write_batch, write_table

REPORTS = schemas.strings(
    "company_id", "company", "stock_code", "report_type", "reprt_code", "url", "rcept_no", "rcept_dt",
    "report_nm", "bsns_year",
)


def companies(roster: DataFrame) -> DataFrame:
    """Roster rows with a valid company code, each company once."""
    keyed = roster.select(
        company_code(F.col("corp_code")).alias("company_id"),
        F.col("corp_name").alias("company"),
        stock_code(F.col("stock_code")).alias("stock_code"),
    ).where(is_company_code(F.col("company_id")))
    return distinct_on(keyed, ["company_id"], ["company", "stock_code"])


def choose_reports(
    roster: DataFrame, listings: DataFrame, viewer: str, as_of, years_back: int = 3,
    listing_cap: int | None = None,
) -> DataFrame:
    """The selected report of every company that has one, with the company's roster data.

    ``listings``: landed responses, or an item table (``read_listing_table``), of which the window's months are read.
    """
    items = items_in_window(listings, as_of, years_back)
    if listing_cap:
        items = top_per_key(items, ["company_id"], ["listing_pos"], listing_cap)
    chosen = select_reports(items, listing_order=["listing_pos.page", "listing_pos.at"])
    return (
        companies(roster)
        .join(chosen, "company_id")
        .withColumn("url", viewer_url(viewer, F.col("rcept_no")))
        .select(*REPORTS.names)
    )


def of_filings(archives: DataFrame, reports: DataFrame) -> DataFrame:
    """The archives that the reports ask for, and rarely another one, whose rows no report takes later.

    Content is never shuffled. An archive table (``store_archives``) is cut to the reports' receipt days, of
    which a window has some thousand at most, so other days are not even listed; then a filter of fixed
    size, however many reports there are, sorts archives out by their numbers.
    """
    return of_days(archives, reports).where(may_be_in(F.col("rcept_no"), reports.select("rcept_no")))


def document_rows(documents: DataFrame, first_document: bool = False, **options) -> DataFrame:
    """Documents -> encoded rows of their roster tables, and what could not be read, with its error."""
    hinted = documents.withColumn("table_hint", document_hint(F.col("xml_text")))
    rows = extract_rows(hinted, first_of=["rcept_no"] if first_document else None, error="error", **options)
    return encode_rows(rows)


def reported(rows: DataFrame, reports: DataFrame, unknown: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Rows, failures among them, with the data of the report they come from.

    ``unknown`` keeps rows without a report, their company and what belongs to it null; ``keep``: columns beside the layout.
    """
    how = "left" if unknown else "inner"
    joined = rows.join(reports.drop("reprt_code", "rcept_dt", "report_nm", "bsns_year"), "rcept_no", how)
    return joined.withColumns({"source_xml_index": F.col("xml_index"), "collected_at": F.current_timestamp()}).select(
        *schemas.COLLECTED.names, "entry", "error", *keep
    )


def collected_rows(rows: DataFrame) -> DataFrame:
    """Of reported rows, the table rows in the collected layout."""
    return rows.where(F.col("error").isNull()).select(*schemas.COLLECTED.names)


def archive_rejects(rows: DataFrame) -> DataFrame:
    """Of reported rows, the archives and entries that could not be read."""
    return rows.where(F.col("error").isNotNull()).select(*schemas.ARCHIVE_REJECTS.names)


def without_archive(reports: DataFrame, landed: DataFrame) -> DataFrame:
    """Reports whose number is not among the landed ones, in the layout of rejects.

    Reads no content, and of a manifest or an archive table only the reports' receipt days.
    """
    missing = pending(reports, of_days(landed, reports), ["rcept_no"])
    return missing.select(
        "company_id", "company", "rcept_no", F.lit(None).cast("string").alias("entry"),
        F.lit(None).cast("int").alias("xml_index"), F.lit("no archive").alias("error"),
    )


def collect(
    spark: SparkSession, roster: DataFrame, listings: DataFrame, archives: DataFrame, out: str, viewer: str,
    as_of, batch: str, years_back: int = 3, listing_cap: int | None = None, resume: bool = True,
    first_document: bool = False, plain_documents: bool = False, landed: DataFrame | None = None,
) -> None:
    """Append one increment of collected rows; with ``resume``, only of (company, filing) pairs not there yet.

    What cannot be read, and reports without an archive, are appended to ``archive_rejects``; they are tried
    again with the next increment. Archives are unpacked once, rows and failures written together and split.
    ``landed`` are the landed archives' numbers (``read_manifest``), by default those of ``archives``. The
    pairs that are there lie in a key store, so they are not shuffled again with every increment.
    """
    write_batch(
        choose_reports(roster, listings, viewer, as_of, years_back, listing_cap), f"{out}/reports", batch
    )
    reports = spark.read.schema(REPORTS).parquet(f"{out}/reports").where(F.col("batch") == f"b-{batch}").drop("batch")
    done = None
    if resume:
        done = followed(spark, out, "collected", batch, COLLECTED_KEY)
        reports = pending_of(reports, [done])
    documents = unpack(of_filings(archives, reports), plain_documents)
    write_batch(reported(document_rows(documents, first_document), reports), f"{out}/extracted", batch)
    stored = spark.read.parquet(f"{out}/extracted/batch=b-{batch}")
    write_batch(collected_rows(stored), f"{out}/collected", batch, even=False)
    failed = archive_rejects(stored).unionByName(without_archive(reports, archives if landed is None else landed))
    write_batch(failed, f"{out}/archive_rejects", batch, even=False)
    if "receipt_month" not in listings.columns:  # an item table has its failures beside it
        write_batch(listing_rejects(listings), f"{out}/listing_rejects", batch)
    if done:
        done.close()


COLLECTED_KEY = {"company_id": "string", "rcept_no": "string"}
ROW_KEY = COLLECTED_KEY | {"source_xml_index": "int", "row_index": "int"}


def followed(spark: SparkSession, out: str, table: str, batch: str, key: dict[str, str], final: bool = False) -> KeyStore:
    """The store of a stage table's keys, up to date but for the increment being made."""
    store = KeyStore(spark, f"{out}/{table}_keys", list(key), list(key.values()))
    fields = [f"{k} {t}" for k, t in key.items()] + (["final boolean"] if final else [])

    def read(folder: str) -> DataFrame:
        rows = spark.read.schema(", ".join(fields)).parquet(folder)
        return rows.where("final") if final else rows

    store.follow(f"{out}/{table}", read, batch)
    return store


def map_rows(
    spark: SparkSession, out: str, batch: str, ask: Callable[[str], str] | None = None,
    partitions: int = 50, model: str = "rules", resume: bool = True, strict_title: bool = True, units: int = 8,
    **options,
) -> None:
    """Map the collected rows that have no final outcome yet; named records and rejects are appended as tables.

    Final are mapped rows and all rejects but failed calls. Results are stored before they are split. A
    service's results are committed in ``units`` parts of the rows (by a hash of the key): the rows to ask for
    are written once, a folder a unit, each unit reads its own, and a run that follows a broken one asks only
    for what no committed part holds.
    """
    collected = spark.read.schema(schemas.COLLECTED).parquet(f"{out}/collected")
    stores = []
    if resume:
        stores = [followed(spark, out, "mapped", batch, ROW_KEY), followed(spark, out, "rejected", batch, ROW_KEY, final=True)]
        # keys alone say which increments have rows left; only those increments' rows are read
        left = pending_of(collected.select("batch", *schemas.SOURCE_KEY), stores).select("batch").distinct().collect()
        collected = collected.where(F.col("batch").isin([r.batch for r in left]))
    collected = spread(collected.drop("batch"))
    if resume:
        collected = pending_of(collected, stores)
    results = f"{out}/results/batch={batch_name(batch)}"
    if ask is None:
        write_table(mapping.map_by_rules(collected, strict_title), results, "overwrite")
        answers = spark.read.parquet(results)
    else:
        # every run's parts have names of their own, so that no answer that was paid for is overwritten
        run = uuid.uuid4().hex
        answered = read_or_empty(spark, results, mapping.results_schema(collected)).drop("unit")
        todo = pending(collected, answered.where(~F.col("retry")), schemas.SOURCE_KEY) if resume else collected
        asked, by_unit = scratch(spark), F.pmod(F.xxhash64(*schemas.SOURCE_KEY), F.lit(units)).cast("int")
        todo.withColumn("unit", by_unit).hint("rebalance", F.col("unit")).write.partitionBy("unit").parquet(asked)
        for unit in sorted(name.removeprefix("unit=") for name in folders(spark, asked) if name.startswith("unit=")):
            part = spark.read.schema(todo.schema).parquet(f"{asked}/unit={unit}")
            answer = mapping.map_by_service(part, ask, partitions, strict_title=strict_title, **options)
            write_table(answer, f"{results}/unit={run}-{unit}", "overwrite")
        discard(spark, asked)
        answers = read_or_empty(spark, results, T.StructType([*mapping.results_schema(collected).fields, T.StructField("unit", T.StringType())]))
        answers = answers if resume else answers.where(F.col("unit").startswith(run))
        answers = mapping.last_answers(answers.drop("unit"))
    write_batch(mapping.mapped_rows(answers, model), f"{out}/mapped", batch, even=False)
    write_batch(mapping.rejected_rows(answers), f"{out}/rejected", batch, even=False)
    for store in stores:
        store.close()


def read_increments(spark: SparkSession, folders_: Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders_) if folders_ else spark.createDataFrame([], schema)


def sheet_state(spark: SparkSession, out: str) -> DataFrame:
    """The first mapped row of each (company, name, position) and how many there are (``n``), from a state table."""
    keys = ["company", "name", "position"]

    def read(parts: list[str]) -> DataFrame:
        named = named_only(read_increments(spark, parts, schemas.MAPPED))
        return named.select(*dict.fromkeys([*fv.EXECUTIVE_LABELS, "position", *schemas.SOURCE_KEY]), F.lit(1).cast("long").alias("n"))

    state = FoldedTable(spark, f"{out}/export_state/sheet", lambda rows: counted_first(rows, keys, schemas.SOURCE_KEY))
    return state.follow(f"{out}/mapped", read)


def report_info_state(spark: SparkSession, out: str) -> DataFrame:
    """Of each company, the first mapped row's report type and, apart, url, from a state table."""

    def read(parts: list[str]) -> DataFrame:
        mapped = read_increments(spark, parts, schemas.MAPPED).where(F.col("company_id").isNotNull())
        long = F.expr("stack(2, 'report_type', report_type, 'url', url) AS (field, value)")
        return mapped.select(*schemas.SOURCE_KEY, long).where(F.col("value").isNotNull())

    state = FoldedTable(
        spark, f"{out}/export_state/reports_of_mapped", lambda rows: distinct_on(rows, ["company_id", "field"], schemas.SOURCE_KEY)
    )
    rows = state.follow(f"{out}/mapped", read)
    fields = [F.when(F.col("field") == f, F.col("value")).alias(f) for f in ("report_type", "url")]
    return rows.select(*schemas.SOURCE_KEY, *fields)


def selected_state(spark: SparkSession, out: str) -> DataFrame:
    """The best report of each company among all increments' choices, from a state table."""
    columns = [c for c in REPORTS.names if c != "reprt_code"]
    state = FoldedTable(spark, f"{out}/export_state/reports", lambda rows: select_reports(rows).select(columns))
    return state.follow(f"{out}/reports", lambda parts: read_increments(spark, parts, REPORTS).select(columns))


def export(
    spark: SparkSession, roster: DataFrame, out: str, target: str, dedupe: bool = True,
    summary_from: str = "mapped", mark_bad_codes: bool = False, fmt: str = "parquet",
) -> dict[str, Observation]:
    """Write the company summary and the executive sheet under their display labels.

    ``summary_from`` is "mapped" (companies with mapped rows) or "reports" (all with a selected report).
    Returns the row counts before and after de-duplication, counted during the write. What is picked by company
    or person lies in state tables below ``out``/export_state: an export reads these and the increments that
    are not in them yet.
    """
    info = selected_state(spark, out) if summary_from == "reports" else report_info_state(spark, out)
    summary = company_summary(roster, info, mark_bad_codes)
    write_table(with_labels(summary, fv.SUMMARY_LABELS), f"{target}/company_summary.{fmt}", "overwrite")
    seen: dict[str, Observation] = {}
    if dedupe:
        seen = {"before": Observation("before"), "after": Observation("after")}
        kept = sheet_state(spark, out).observe(seen["before"], F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        kept = kept.observe(seen["after"], F.count(F.lit(1)).alias("rows"))
        sheet = with_columns_present(kept, list(fv.EXECUTIVE_LABELS))
    else:
        sheet = executive_sheet(read_or_empty(spark, f"{out}/mapped", schemas.MAPPED), dedupe=False)
    write_table(with_labels(sheet, fv.EXECUTIVE_LABELS), f"{target}/executives.{fmt}", "overwrite")
    return seen


def summary_counts(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """How many companies have each report type, most frequent first."""
    labels = schemas.strings(*fv.SUMMARY_LABELS.values())
    return value_counts(read_table(spark, f"{target}/company_summary.{fmt}", labels), fv.SUMMARY_LABELS["report_type"])
