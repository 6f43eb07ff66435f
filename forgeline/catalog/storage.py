"""Sources and sinks: each query writes below a fresh working folder and returns what reads
back, or scans files which Spark has derived from the tables."""

from __future__ import annotations

import zipfile
from io import BytesIO
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..plans import marts
from ..plans.run import build_marts
from ..sinks import archive, parquet, published
from ..sinks.contents import contents, contents_sql
from ..sources import files, tables, workbooks
from .changes import loaded_sources, reported_sources
from .registry import Inputs, query

_LOG = "SELECT * FROM v_log"


# -- delimited files ---------------------------------------------------------------------------


def write_log_csv(i: Inputs) -> str:
    """The machine log as a directory of CSV files, written by all tasks at once."""
    path = i.work_dir("machines-csv")
    i.log.write.option("header", True).csv(path)
    return path


@query("scan_csv_dir", _LOG)
def scan_csv_dir(i: Inputs) -> DataFrame:
    return files.scan_csv_dir(i.spark, write_log_csv(i), schemas.MACHINE_LOG)


@query("scan_csv_by_header", _LOG)
def scan_csv_by_header(i: Inputs) -> DataFrame:
    """Log files in two column orders; each is read by its own header."""
    path = i.work_dir("machines-two-orders")
    swapped = i.log.select(*reversed(i.log.columns))
    i.log.filter("var5 = 1").write.option("header", True).csv(path)
    swapped.filter("var5 = 0").write.mode("append").option("header", True).csv(path)
    return files.scan_csv_dir(i.spark, path, schemas.MACHINE_LOG)


@query("scan_csv_dir_origin", "SELECT 'csv' AS suffix, count(*) AS n FROM v_log")
def scan_csv_dir_origin(i: Inputs) -> DataFrame:
    """Every row knows its file; only ``.csv`` files are read."""
    rows = files.scan_csv_dir(i.spark, write_log_csv(i), schemas.MACHINE_LOG, with_origin=True)
    return rows.groupBy(F.substring_index("file_name", ".", -1).alias("suffix")).agg(F.count("*").alias("n"))


@query(
    "scan_csv_inferred",
    """SELECT v.*, t.kind FROM (SELECT CAST("order" AS INTEGER) AS "order", CAST(partId AS INTEGER) AS partId,
  CAST(machineId AS INTEGER) AS machineId, timeOfProduction, var5 FROM v_log) v,
  (SELECT 'order int, partId int, machineId int, timeOfProduction bigint, var5 int' AS kind) t""",
)
def scan_csv_inferred(i: Inputs) -> DataFrame:
    """The log with the types that were inferred, which each row names."""
    inferred = files.scan_csv_dir(i.spark, write_log_csv(i))
    return inferred.withColumn("kind", F.lit(", ".join(f"{name} {kind}" for name, kind in inferred.dtypes)))


@query(
    "csv_bad_file_skip",
    """SELECT partId, count(*) FILTER (WHERE var5 = 0) AS loaded, count(*) FILTER (WHERE var5 = 1) AS quarantined
FROM v_log GROUP BY partId""",
)
def csv_bad_file_skip(i: Inputs) -> DataFrame:
    """Log lines of damaged units are garbled; they are set aside, the others load."""
    path = i.work_dir("machines-garbled")
    machine = F.when(F.col("var5") == 1, F.lit("?")).otherwise(F.col("machineId").cast("string"))
    i.log.withColumn("machineId", machine).write.option("header", True).csv(path)
    good, bad = files.scan_csv_quarantine(i.spark, path, schemas.MACHINE_LOG)
    kept = good.select("partId", F.lit(1).alias("ok"))
    lost = bad.select(F.split("line", ",")[1].cast("bigint").alias("partId"), F.lit(0).alias("ok"))
    return kept.unionByName(lost).groupBy("partId").agg(
        F.count_if(F.col("ok") == 1).alias("loaded"), F.count_if(F.col("ok") == 0).alias("quarantined")
    )


@query("csv_to_parquet", _LOG)
def csv_to_parquet(i: Inputs) -> DataFrame:
    target = i.work_dir("machines-parquet")
    parquet.csv_to_parquet(i.spark, write_log_csv(i), target, schema=schemas.MACHINE_LOG)
    return files.scan_parquet(i.spark, target)


# -- Parquet --------------------------------------------------------------------------------------


@query("scan_parquet", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 25")
def scan_parquet(i: Inputs) -> DataFrame:
    scan = files.scan_parquet(i.spark, f"{i.sf_dir}/lineitem.parquet")
    return scan.filter("l_quantity > 25").select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "scan_parquet_union",
    """SELECT partId, machineId, CASE WHEN var5 = 1 THEN "order" END AS "order",
  CASE WHEN var5 = 0 THEN timeOfProduction END AS timeOfProduction FROM v_log""",
)
def scan_parquet_union(i: Inputs) -> DataFrame:
    """Two directories with different columns read as one table."""
    root = i.work_dir("machines-parts")
    i.log.filter("var5 = 1").select("order", "partId", "machineId").write.parquet(f"{root}/damaged")
    i.log.filter("var5 = 0").select("machineId", "partId", "timeOfProduction").write.parquet(f"{root}/good")
    return files.scan_parquet_union(i.spark, root, output=i.work_dir("machines-all"))


@query("write_parquet_overwrite", _LOG)
def write_parquet_overwrite(i: Inputs) -> DataFrame:
    path = i.work_dir("overwrite")
    parquet.write_parquet(i.log.filter("var5 = 1"), path)
    parquet.write_parquet(i.log, path)
    return files.scan_parquet(i.spark, path)


@query("write_parquet_partitioned", _LOG)
def write_parquet_partitioned(i: Inputs) -> DataFrame:
    """A directory per damage flag; writing one of them again leaves the other alone."""
    path = i.work_dir("partitioned")
    parquet.write_parquet_partitioned(i.log, path, ["var5"])
    parquet.write_parquet_partitioned(i.log.filter("var5 = 1"), path, ["var5"])
    return files.scan_parquet(i.spark, path).select(*i.log.columns)


@query("compact_parquet", _LOG)
def compact_parquet(i: Inputs) -> DataFrame:
    """Files in a directory per damage flag; the flag stays a column."""
    source, target = i.work_dir("pieces"), i.work_dir("compact")
    parquet.csv_to_parquet(i.spark, write_log_csv(i), source, by=["var5"], schema=schemas.MACHINE_LOG)
    parquet.compact_parquet(files.scan_parquet_union(i.spark, source, target), target)
    return files.scan_parquet(i.spark, target)


@query("cluster_by_key", "SELECT * FROM v_mart_supply")
def cluster_by_key(i: Inputs) -> DataFrame:
    path = i.work_dir("clustered")
    keys = schemas.KEYS["fact_supply_chain"]
    mart = marts.fact_supply_chain(i.ods("fact_supply_chain"), order=keys[:3])
    # The counts are those of the day, machine and part.
    spread = ["materialPrice", "materialPriceDate", "partDefaultPrice"]
    parquet.write_parquet(parquet.cluster_by_key(mart, keys, spread=spread), path)
    return files.scan_parquet(i.spark, path)


@query("append_rows", "SELECT event_id, user_id, event_type FROM events")
def append_rows(i: Inputs) -> DataFrame:
    """Two batches, the second written twice as after a failure."""
    path = i.work_dir("appended")
    events = i.table("events").select("event_id", "user_id", "event_type")
    errors = F.col("event_type") == "error"
    parquet.append_batch(events.filter(~errors), path, 0)
    for _ in range(2):
        parquet.append_batch(events.filter(errors), path, 1)
    return files.scan_parquet(i.spark, path).drop("batch_id")


# -- tables --------------------------------------------------------------------------------------


@query("scan_table", "SELECT * FROM v_fact")
def scan_table(i: Inputs) -> DataFrame:
    fact = tables.scan_table(i.spark, i.ods_with("fact_supply_chain"), "fact_supply_chain")
    return fact.drop("trscMachineId", "trscPartId", "trscMaterialId", "lastUpdate")


@query("load_star_schema", contents_sql(loaded_sources()))
def load_star_schema(i: Inputs) -> DataFrame:
    """The contents of all seven operational tables as loaded."""
    root = i.ods_root
    return contents({name: tables.scan_table(i.spark, root, name) for name in schemas.TABLE_NAMES})


@query("create_table_as", contents_sql(reported_sources(after=False)))
def create_table_as(i: Inputs) -> DataFrame:
    """All seven reporting tables, each created from its query; their contents."""
    root = i.work_dir("dwh")
    for name, df in build_marts(i.spark, i.ods_root).items():
        parquet.create_table_as(df, f"{root}/{name}")
    return contents({name: tables.scan_table(i.spark, root, name, "dwh") for name in schemas.TABLE_NAMES})


@query("full_refresh", "SELECT * FROM v_mart_supply")
def full_refresh(i: Inputs) -> DataFrame:
    """A table published twice: readers get the second version."""
    root = i.work_dir("refresh")
    mart = marts.fact_supply_chain(i.ods("fact_supply_chain"))
    published.full_refresh(mart.filter("GarbageProduction > 1"), root)
    published.full_refresh(mart, root)
    return published.read_published(i.spark, root)


@query("star_schema_run", contents_sql(reported_sources(after=False)))
def star_schema_run(i: Inputs) -> DataFrame:
    """The whole batch run: the contents of every reporting table built from the stored operational ones."""
    return contents(build_marts(i.spark, i.ods_root))


@query("snapshot_table", contents_sql(reported_sources(after=False)))
def snapshot_table(i: Inputs) -> DataFrame:
    """The manifest of a snapshot of all reporting tables."""
    label = "2024-06-01 12-30-45"
    return published.snapshot_tables(build_marts(i.spark, i.ods_root), i.work_dir("snapshots"), label)


@query("restore_snapshot", contents_sql(reported_sources(after=False)).replace("AS checksum FROM", "AS checksum, 1 AS intact FROM"))
def restore_snapshot(i: Inputs) -> DataFrame:
    """A snapshot published again: the contents of each restored table and whether it matches."""
    root, target = i.work_dir("snapshots"), i.work_dir("restored")
    names = list(schemas.TABLE_NAMES)
    published.snapshot_tables(build_marts(i.spark, i.ods_root), root, "one")
    report = published.restore_snapshot(i.spark, root, "one", names, target)
    restored = contents({name: published.read_published(i.spark, f"{target}/{name}") for name in names})
    return restored.join(report.select("table", F.col("intact").cast("int").alias("intact")), "table")


_REPEATED = """SELECT 'unique' AS "check", 'timeId=' || timeId || ', machineId=' || machineId || ', partId=' || partId
  || ', materialId=' || materialId AS key, count(*) AS "rows" FROM v_mart_supply
GROUP BY timeId, machineId, partId, materialId HAVING count(*) > 1"""


@query(
    "publish_checked",
    f"""SELECT 1 AS version, "check", key, "rows" FROM ({_REPEATED})
UNION ALL SELECT 1, 'not null', 'machineId', count(*) FROM v_mart_supply WHERE materialPrice < 20 HAVING count(*) > 0""",
)
def publish_checked(i: Inputs) -> DataFrame:
    """The supply-chain mart with some machines blanked out is refused by the write gate: the
    violations it stored. A key with a blank in it is left out of the repeats, so blanks are put into rows
    beside the table's own."""
    root = i.work_dir("checked")
    mart = marts.fact_supply_chain(i.ods("fact_supply_chain"))
    # The mart is worked out once for both: a row comes back as itself and, if it is to be blanked, without its machine.
    machine, none = F.col("machineId"), F.lit(None).cast("bigint")
    machines = F.when(F.col("materialPrice") < 20, F.array(machine, none)).otherwise(F.array(machine))
    key = schemas.KEYS["fact_supply_chain"]
    try:
        published.checked_refresh(mart.withColumn("machineId", F.explode(machines)), root, key, key)
    except published.Refused as refused:
        found = i.spark.read.parquet(refused.path)
        return found.select(F.lit(1).alias("version"), "check", "key", "rows")
    raise AssertionError("a table with violations was published")


# -- files and workbooks ----------------------------------------------------------------------------


@query(
    "scan_files_recursive",
    """SELECT 'year=' || year(o_orderdate) AS folder, count(*) AS "rows", CAST(sum(length(o_orderpriority) + 1) AS BIGINT) AS bytes
FROM orders GROUP BY ALL""",
)
def scan_files_recursive(i: Inputs) -> DataFrame:
    """Order priorities as text files in a directory per year, scanned as a tree: the lines and
    the bytes of each directory."""
    root = i.work_dir("priorities")
    lines = i.table("orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("value"))
    lines.hint("rebalance", "year").write.partitionBy("year").text(root)
    tree = files.scan_files(i.spark, root).select(
        F.substring_index(files.relative_path(root), "/", 1).alias("folder"),
        "length",
        (F.size(F.split(F.decode("content", "UTF-8"), "\n")) - 1).alias("n"),
    )
    return tree.groupBy("folder").agg(F.sum("n").alias("rows"), F.sum("length").alias("bytes"))


# Bytes of a chunk here, so that larger files are read in ranges.
_CHUNK = 1 << 16


@query(
    "archive_new_files",
    """SELECT CASE WHEN var5 = 1 THEN 'damaged' ELSE 'good' END AS folder,
  CASE WHEN var5 = 1 THEN 'kept' ELSE 'archived' END AS status, count(*) AS "rows" FROM v_log GROUP BY ALL""",
)
def archive_new_files(i: Inputs) -> DataFrame:
    """Archive the log files of damaged units, then the same folder with the other files in it:
    the log rows the archive holds, by folder and by what the second run did with their file."""
    root, store = i.work_dir("landing"), i.work_dir("archive")
    i.log.filter("var5 = 1").write.option("header", True).csv(f"{root}/damaged")
    archive.archive_new_files(i.spark, root, store, chunk=_CHUNK)
    i.log.filter("var5 = 0").write.option("header", True).csv(f"{root}/good")
    report = archive.archive_new_files(i.spark, root, store, chunk=_CHUNK)
    # A line break behind each row and the header.
    held = archive.read_archive(i.spark, store).groupBy("name").agg((F.sum(archive.line_breaks("content")) - 1).alias("n"))
    folder = F.substring_index("name", "/", 1).alias("folder")
    return report.join(held, "name").groupBy(folder, "status").agg(F.sum("n").alias("rows"))


_ROWS_PER_BOOK = 500
_SHEET = "Part Information"


def _workbook(header: list[str], rows: list[list[str]]) -> bytes:
    """A workbook of one sheet with inline strings."""

    def row(number: int, cells: list[str]) -> str:
        body = "".join(
            f'<c r="{chr(65 + at)}{number}" t="inlineStr"><is><t>{escape(cell)}</t></is></c>'
            for at, cell in enumerate(cells)
        )
        return f'<row r="{number}">{body}</row>'

    return _packed("".join(row(n, cells) for n, cells in enumerate([header, *rows], start=1)), {})


def _packed(sheet: str, more: dict[str, str]) -> bytes:
    """A workbook of one sheet from the XML of its rows, with the parts ``more`` beside it."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="{_SHEET}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f'<Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{sheet}</sheetData></worksheet>")
        for name, body in more.items():
            book.writestr(name, body.format(main=main))
    return out.getvalue()


def part_workbooks(i: Inputs) -> DataFrame:
    """The part references as workbooks of 500 parts each: (path, content)."""
    columns = schemas.PART_REFERENCE.fieldNames()
    book = F.floor(F.col("id") / _ROWS_PER_BOOK).cast("bigint").alias("book")
    text = i.part_raw.select(book, *[F.col(c).cast("string").alias(c) for c in columns])

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        content = _workbook(columns, rows[columns].fillna("").values.tolist())
        return pd.DataFrame({"path": [f"parts-{rows['book'].iloc[0]}.xlsx"], "content": [content]})

    packed = text.groupBy("book").applyInPandas(pack, "path string, content binary")
    path = i.once("part-workbooks", packed.write.parquet)
    return i.spark.read.schema(packed.schema).parquet(path)


def part_sheet(books: DataFrame, sheet: str) -> DataFrame:
    rows = workbooks.sheet_rows(books, schemas.PART_REFERENCE.fieldNames(), sheet)
    return workbooks.project_sheet(rows, schemas.PART_REFERENCE)


@query("scan_workbook", "SELECT * FROM v_part_raw")
def scan_workbook(i: Inputs) -> DataFrame:
    return part_sheet(part_workbooks(i), _SHEET)


def order_workbooks(i: Inputs) -> DataFrame:
    """The orders as workbooks of 500 each, as a spreadsheet program writes them: day numbers shown as dates,
    shared strings, flags, and rows and cells that do not say where they are."""
    orders = i.table("orders").select(
        F.floor(F.col("o_orderkey") / _ROWS_PER_BOOK).cast("bigint").alias("book"),
        "o_orderkey",
        F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date")).alias("day"),
        "o_totalprice",
        "o_orderpriority",
        (F.col("o_orderpriority") < "3").cast("int").alias("urgent"),
    )
    header = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority", "urgent"]
    styles = '<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        names = header + sorted(set(rows["o_orderpriority"]))
        place = {name: at for at, name in enumerate(names)}
        sheet = "<row>" + "".join(f'<c t="s"><v>{place[name]}</v></c>' for name in header) + "</row>"
        for r in rows.itertuples():
            sheet += f'<row><c><v>{r.o_orderkey}</v></c><c s="1"><v>{r.day}</v></c><c><v>{r.o_totalprice!r}</v></c>'
            sheet += f'<c t="s"><v>{place[r.o_orderpriority]}</v></c><c t="b"><v>{r.urgent}</v></c></row>'
        shared = "".join(f"<si><t>{escape(name)}</t></si>" for name in names)
        more = {"xl/styles.xml": styles, "xl/sharedStrings.xml": "<sst {main}>" + shared + "</sst>"}
        return pd.DataFrame({"path": [f"orders-{rows['book'].iloc[0]}.xlsx"], "content": [_packed(sheet, more)]})

    packed = orders.groupBy("book").applyInPandas(pack, "path string, content binary")
    path = i.once("order-workbooks", packed.write.parquet)
    return i.spark.read.schema(packed.schema).parquet(path)


@query(
    "scan_workbook_inferred",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderpriority,
  CAST(o_orderpriority < '3' AS INTEGER) AS urgent FROM orders""",
)
def scan_workbook_inferred(i: Inputs) -> DataFrame:
    """Columns and types come from the cells alone."""
    rows = workbooks.inferred_sheet(order_workbooks(i))
    return rows.withColumn("urgent", F.col("urgent").cast("int"))


@query(
    "empty_sheet",
    """SELECT 'Part Information' AS sheet, count(*) AS "rows", min(id) AS first FROM v_part_raw
UNION ALL SELECT 'Sales', 0, NULL""",
)
def empty_sheet(i: Inputs) -> DataFrame:
    """A sheet none of the workbooks has is an empty table of the declared columns."""
    books = part_workbooks(i)

    def summary(sheet: str) -> DataFrame:
        return part_sheet(books, sheet).agg(F.count("*").alias("rows"), F.min("id").alias("first")).select(
            F.lit(sheet).alias("sheet"), "rows", "first"
        )

    return summary(_SHEET).unionByName(summary("Sales"))
