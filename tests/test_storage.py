"""Readers and writers."""

import zipfile

import pytest
from pyspark.sql import functions as F

from forgeline import schemas
from forgeline.sinks import archive, jdbc, parquet, published
from forgeline.session import materialize, temporary_work, work_dir
from forgeline.sources import files, messages, tables, workbooks


def test_csv_directory(spark, tmp_path):
    (tmp_path / "machine-1-0.csv").write_text("order,partId,machineId,timeOfProduction,var5\n1,2,3,4,0\n")
    (tmp_path / "machine-2-0.csv").write_text("order,partId,machineId,timeOfProduction,var5\n5,6,7,8,1\n")
    (tmp_path / "notes.txt").write_text("order\n9\n")
    rows = files.scan_csv_dir(spark, str(tmp_path), schemas.MACHINE_LOG, with_origin=True).orderBy("order").collect()
    assert [(r.order, r.file_name) for r in rows] == [(1, "machine-1-0.csv"), (5, "machine-2-0.csv")]
    assert files.scan_csv_dir(spark, str(tmp_path)).count() == 2


def test_bad_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order,partId,machineId,timeOfProduction,var5\n1,2,x,4,0\n5,6,7,8,1\n1,2\n")
    good, bad = files.scan_csv_quarantine(spark, str(tmp_path), schemas.MACHINE_LOG)
    assert [r.order for r in good.select("order").collect()] == [5]
    assert sorted(r.line for r in bad.collect()) == ["1,2", "1,2,x,4,0"]
    assert good.count() == 1 and bad.count() == 2


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order,partId,machineId,timeOfProduction,var5\n1,2,3,4,0\n")
    (tmp_path / "b+ c.csv").write_text("order,machineId,partId,timeOfProduction,var5\n5,7,6,8,1\n")
    (tmp_path / "d.csv").write_text("order,partId,extra\n9,10,x\n")
    rows = files.scan_csv_dir(spark, str(tmp_path), schemas.MACHINE_LOG, with_origin=True).orderBy("order").collect()
    assert [(r.order, r.partId, r.machineId, r.file_name) for r in rows] == [
        (1, 2, 3, "a.csv"), (5, 6, 7, "b+ c.csv"), (9, 10, None, "d.csv"),
    ]
    inferred = files.scan_csv_dir(spark, str(tmp_path)).orderBy("order").collect()
    assert [(r.order, r.partId, r.machineId, r.extra) for r in inferred] == [(1, 2, 3, None), (5, 6, 7, None), (9, 10, None, "x")]
    (tmp_path / "noise.csv").write_bytes(bytes(range(1, 200)))
    good, bad = files.scan_csv_quarantine(spark, str(tmp_path), schemas.MACHINE_LOG)
    assert sorted((r.order, r.partId, r.machineId) for r in good.collect()) == [(1, 2, 3), (5, 6, 7)]
    assert {r.file_name for r in bad.collect()} == {"d.csv", "noise.csv"}


def test_headers_are_read_without_the_lines(spark, tmp_path):
    """Only the first bytes of a file are opened, however long it or its header is."""
    long = ",".join(f"column{n}" for n in range(2000))
    (tmp_path / "a.csv").write_text(f"{long}\r\n1\n")
    (tmp_path / "b.csv").write_text("order,partId")
    headers = files._csv_headers(spark, str(tmp_path))
    assert {r.file_path.rsplit("/", 1)[1]: r.header for r in headers.collect()} == {"a.csv": long, "b.csv": "order,partId"}
    assert "FileScan text" not in headers._jdf.queryExecution().executedPlan().toString()
    scanned = files._headers_by_scan(spark, str(tmp_path), False)
    assert {r.header for r in scanned.collect()} == {long, "order,partId"}


def test_write_gate(spark, tmp_path):
    """A table with a repeated key or a NULL is not published; its violations are stored."""
    root = str(tmp_path / "t")
    good = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert published.checked_refresh(good, root, ["k"], ["k"]) == 1
    bad = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    with pytest.raises(published.Refused):
        published.checked_refresh(bad, root, ["k"], ["k"])
    assert published.read_published(spark, root).count() == 2
    found = published.read_violations(spark, root).collect()
    assert {(r.check, r.key, r.rows, r.version) for r in found} == {("not null", "k", 2, 2), ("unique", "k=1", 2, 2)}
    assert published.checked_refresh(bad, root, ["k"], ["k"], refuse=False) == 2
    dims = {"dim_machine": spark.createDataFrame([(1,), (1,)], "machineId bigint"), "dim_material": spark.createDataFrame([(1, "x")], "materialId bigint, name string")}
    with pytest.raises(published.Refused, match="dim_machine"):
        published.checked_load(dims, str(tmp_path / "dwh"))
    assert published.read_published(spark, str(tmp_path / "dwh" / "dim_material")).count() == 1


def test_parts_are_replaced(spark, tmp_path):
    """Readers see each part as the last version that replaced it left it, emptied ones included."""
    root = str(tmp_path / "t")
    rows = spark.range(12).select("id", (F.col("id") % 3).cast("int").alias("p"))
    assert published.replace_parts(rows, root, "p") == 1
    assert published.replace_parts(rows.filter("p = 1 AND id < 5"), root, "p", [1, 2]) == 2
    assert sorted(r.id for r in published.read_published(spark, root).collect()) == [0, 1, 3, 4, 6, 9]
    failing = rows.select(F.assert_true(F.col("id") < 2).cast("bigint").alias("id"), "p")
    with pytest.raises(Exception):
        published.replace_parts(failing, root, "p")
    assert published.read_published(spark, root).count() == 6
    assert published.replace_parts(rows.limit(0), root, "p", [0, 1, 2]) > 2
    assert published.read_published(spark, root).count() == 0


def test_union_keeps_partition_columns(spark, tmp_path):
    spark.range(6).select("id", (F.col("id") % 2).alias("p")).write.partitionBy("p").parquet(str(tmp_path / "u" / "cut"))
    spark.range(6, 9).write.parquet(str(tmp_path / "u" / "plain"))
    spark.range(9, 11).withColumn("x", F.lit(1)).write.mode("append").parquet(str(tmp_path / "u"))
    rows = files.scan_parquet_union(spark, str(tmp_path / "u")).select("id", "p", "x").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        (n, n % 2 if n < 6 else None, 1 if n > 8 else None) for n in range(11)
    ]


def test_union_refuses_an_output_inside_the_input(spark):
    with pytest.raises(ValueError, match="inside"):
        files.scan_parquet_union(spark, "/data/machines", "/data/machines/all")


def xlsx(path, sheets, shared=()):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as book:
        entries = "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>{entries}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml"/>' for k in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{targets}</Relationships>")
        for k, body in enumerate(sheets.values(), 1):
            book.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")
        if shared:
            items = "".join(f"<si><t>{s}</t></si>" for s in shared)
            book.writestr("xl/sharedStrings.xml", f"<sst {main}>{items}</sst>")


def test_workbooks(spark, tmp_path):
    """Shared strings, numbers, gaps between cells, columns in another order, two sheets."""
    body = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="s"><v>2</v></c></row>'
        '<row r="2"><c r="A2" t="inlineStr"><is><t>steel</t></is></c><c r="B2"><v>7</v></c><c r="D2" t="s"><v>3</v></c></row>'
        '<row r="3"><c r="B3"><v>not a number</v></c></row>'
    )
    xlsx(tmp_path / "one.xlsx", {"Other": "", "Material": body}, ["name", "id", "prices", "[]"])
    inline = (
        '<row r="1"><c r="A1" t="inlineStr"><is><t>id</t></is></c></row><row r="2"><c r="A2"><v>9</v></c></row>'
    )
    xlsx(tmp_path / "two.xlsx", {"Material": inline})
    rows = workbooks.scan_workbook(spark, str(tmp_path), schemas.MATERIAL_SHEET, "Material").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(7, "steel", "[]"), (None, None, None), (9, None, None)], key=str)
    empty = workbooks.scan_workbook(spark, str(tmp_path), schemas.MATERIAL_SHEET, "Sales")
    assert empty.count() == 0 and empty.schema.fieldNames() == ["id", "name", "prices"]


def test_workbook_types_are_inferred(spark, tmp_path):
    """Day numbers by built-in and own formats, both calendars, flags, errors, mixed columns, missing places."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    head = "<row>" + "".join(f'<c t="inlineStr"><is><t>{n}</t></is></c>' for n in ("day", "time", "n", "x", "flag", "mix", "none")) + "</row>"
    styles = (
        f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd hh:mm"/>'
        '<numFmt numFmtId="171" formatCode="[Red]0.0&quot;days&quot;"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>'
    )
    one = (
        '<row><c s="1"><v>45292</v></c><c s="2"><v>45292.25</v></c><c><v>7</v></c><c s="3"><v>1.5</v></c>'
        '<c t="b"><v>1</v></c><c><v>3</v></c><c t="e"><v>#N/A</v></c></row>'
        '<row r="9"><c s="1"><v>59</v></c><c r="C9"><v>8</v></c></row>'
    )
    two = '<row><c s="1"><v>0</v></c><c/><c/><c><v>2</v></c><c t="b"><v>0</v></c><c t="str"><v>text</v></c></row>'
    xlsx(tmp_path / "one.xlsx", {"S": head + one})
    xlsx(tmp_path / "two.xlsx", {"S": head + two})
    for name in ("one", "two"):
        with zipfile.ZipFile(tmp_path / f"{name}.xlsx", "a") as book:
            book.writestr("xl/styles.xml", styles)
    got = workbooks.scan_workbook(spark, str(tmp_path), sheet="S")
    kinds = {"day": "date", "flag": "boolean", "mix": "string", "n": "bigint", "time": "timestamp_ntz", "x": "double"}
    assert dict(got.dtypes) == kinds
    rows = {tuple(None if v is None else str(v) for v in r) for r in got.collect()}
    assert rows == {
        ("2024-01-01", "True", "3", "7", "2024-01-01 06:00:00", "1.5"),
        ("1900-02-28", None, None, "8", None, None),
        ("1899-12-31", "False", "text", None, None, "2.0"),
    }
    assert workbooks._from_serial(0.5, True) == ("timestamp", "1904-01-01 12:00:00")
    assert workbooks.scan_workbook(spark, str(tmp_path), sheet="none").columns == []


def test_partition_overwrite_leaves_the_others(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("g"))
    parquet.write_parquet_partitioned(df, str(tmp_path / "t"), ["g"])
    parquet.write_parquet_partitioned(df.filter("g = 1").withColumn("id", -F.col("id")), str(tmp_path / "t"), ["g"])
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 100 and back.filter("id < 0").select("g").distinct().collect()[0][0] == 1


def test_create_fails_when_the_table_exists(spark, tmp_path):
    parquet.create_table_as(spark.range(3), str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)exists"):
        parquet.create_table_as(spark.range(3), str(tmp_path / "t"))


def test_compaction_and_clustering(spark, tmp_path):
    spark.range(1000).repartition(40).write.parquet(str(tmp_path / "pieces"))
    parquet.compact_parquet(spark.read.parquet(str(tmp_path / "pieces")), str(tmp_path / "few"))
    assert len(list((tmp_path / "few").glob("*.parquet"))) < 10
    parquet.compact_parquet(spark.range(10), str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1
    ranged = parquet.cluster_by_key(spark.range(1000).repartition(9), ["id"], 4)
    bounds = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min("id").alias("a"), F.max("id").alias("b"))
    spans = sorted((r.a, r.b) for r in bounds.collect())
    assert all(left[1] < right[0] for left, right in zip(spans, spans[1:], strict=False))


def test_batches_are_idempotent(spark, tmp_path):
    for _ in range(2):
        parquet.append_batch(spark.range(5), str(tmp_path / "log"), 3)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 5


def test_readers_keep_the_old_version_until_the_new_one_is_whole(spark, tmp_path):
    root = str(tmp_path / "t")
    assert published.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, root)
    published.full_refresh(spark.range(3), root)
    failing = spark.range(5).select(F.assert_true(F.col("id") < 2).alias("x"))
    with pytest.raises(Exception):
        published.full_refresh(failing, root)
    assert published.read_published(spark, root).count() == 3
    published.full_refresh(published.read_published(spark, root).filter("id < 1"), root)
    assert published.read_published(spark, root).count() == 1


def test_snapshot_notices_a_changed_table(spark, tmp_path):
    snapshots = str(tmp_path / "snapshots")
    published.snapshot_tables({"a": spark.range(9), "b": spark.range(2)}, snapshots, "x")
    published.restore_snapshot(spark, snapshots, "x", ["a", "b"], str(tmp_path / "back"))
    assert published.read_published(spark, str(tmp_path / "back" / "a")).count() == 9
    spark.range(1, 10).write.mode("overwrite").parquet(f"{snapshots}/x/a")
    report = {r.table: r.intact for r in published.verify_snapshot(spark, snapshots, "x", ["a", "b"]).collect()}
    assert report == {"a": False, "b": True}
    with pytest.raises(ValueError, match="manifest"):
        published.restore_snapshot(spark, snapshots, "x", ["a", "b"], str(tmp_path / "back"))


def test_archive(spark, tmp_path):
    root, store = tmp_path / "in", str(tmp_path / "archive")
    (root / "a").mkdir(parents=True)
    (root / "b").mkdir()
    (root / "a" / "same.csv").write_text("1")
    (root / "b" / "same.csv").write_text("22")
    first = {r.name: r.status for r in archive.archive_new_files(spark, str(root), store).collect()}
    assert first == {"a/same.csv": "archived", "b/same.csv": "archived"}
    (root / "big.csv").write_text("x" * 50)
    (root / "c.csv").write_text("3")
    (root / "odd [1] {x}*.csv").write_text("4")
    (root / "a" / "same.csv").chmod(0)  # what is kept is not opened again
    again = {r.name: r.status for r in archive.archive_new_files(spark, str(root), store, chunk=16).collect()}
    new = {"big.csv": "archived", "c.csv": "archived", "odd [1] {x}*.csv": "archived"}
    assert again == {"a/same.csv": "kept", "b/same.csv": "kept"} | new
    rows = sorted((r.name, r.chunk, r.chunks, bytes(r.content)) for r in archive.read_archive(spark, store).collect())
    assert [r[1:] for r in rows if r[0] == "big.csv"] == [(k, 4, b"x" * (16 if k < 3 else 2)) for k in range(4)]
    whole = {n: b"".join(r[3] for r in rows if r[0] == n) for n in again}
    assert whole == {"a/same.csv": b"1", "b/same.csv": b"22", "big.csv": b"x" * 50, "c.csv": b"3", "odd [1] {x}*.csv": b"4"}


def test_an_archive_run_without_a_report_does_not_count(spark, tmp_path):
    root, store = tmp_path / "in", str(tmp_path / "archive")
    root.mkdir()
    (root / "a.csv").write_text("1")
    spark.createDataFrame([], archive.FILES).write.parquet(f"{store}/files/run=1")
    for status in ("archived", "kept"):
        assert [(r.name, r.status) for r in archive.archive_new_files(spark, str(root), store).collect()] == [("a.csv", status)]
    assert archive.read_archive(spark, store).count() == 1


def test_connector_options():
    options = jdbc.jdbc_write_options("db", "ods", "dim_time", "someone", "secret")
    assert options["url"] == "jdbc:sqlserver://db:1433;databaseName=ods" and "secret" not in options["url"]
    assert options["dbtable"] == "dim_time" and options["batchsize"] == "10000"
    scan = tables.jdbc_read_options("jdbc:x", "t", "id", 0, 100, 8)
    assert scan["numPartitions"] == "8" and scan["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        tables.jdbc_read_options("jdbc:x", "t", "id")
    kafka = messages.kafka_options(["a:1", "b:2"])
    assert kafka["startingOffsets"] == "earliest" and "material_prices" in kafka["subscribe"]


def test_working_folders(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    with temporary_work(spark):
        kept = materialize(spark.range(4), "x")
        path = kept.inputFiles()[0]
        assert kept.count() == 4
    import os

    assert not os.path.exists(path.removeprefix("file://"))


def test_contents_of_odd_values(spark):
    """Sums over the texts of odd values; values are hashed once per batch, not once per row."""
    from hashlib import md5

    from forgeline.sinks.contents import contents

    df = spark.sql(
        "SELECT * FROM VALUES (1L, 0.00005D, date'-0044-03-15', 'a|b'), (1L, -0.00004D, date'+12345-03-15', ''), "
        "(1L, 1e35D, date'2024-01-02', NULL), (NULL, cast('NaN' AS DOUBLE), NULL, '~') AS t(n, x, d, s)"
    )

    def total(*texts):
        return str(sum(int(md5(text.encode()).hexdigest()[:15], 16) for text in texts))

    found = {row["column"]: row["checksum"] for row in contents({"t": df}).collect()}
    assert found["n"] == total("1", "1", "1")
    assert found["x"] == total("0.0001", "0.0000", "1.0E35", "NaN")
    assert found["d"] == total("-0044-03-15", "+12345-03-15", "2024-01-02")
    assert found["s"] == total("a|b", "", "~")
    assert found["*"] == total("1|0.0001|-0044-03-15|a|b", "1|0.0000|+12345-03-15|", "1|1.0E35|2024-01-02|~", "~|NaN|~|~")
    assert {row["checksum"] for row in contents({"t": df.limit(0)}).collect()} == {"0"}
    assert "md5(" not in contents({"t": df})._jdf.queryExecution().executedPlan().toString()


def test_a_query_loads_the_tables_it_reads(spark):
    from pathlib import Path

    from conftest import SMALL
    from forgeline.catalog.registry import Inputs

    inputs = Inputs(spark, f"{SMALL}/")
    inputs.ods("dim_machine")
    assert {p.name for p in Path(inputs.ods_with()).iterdir() if not p.name.startswith("rejects")} == {"dim_machine"}
    assert {p.name for p in Path(inputs.ods_root).iterdir()} == {*schemas.TABLE_NAMES, "rejects"}


def test_the_checked_mart_is_worked_out_once(small, monkeypatch):
    """The rows that are blanked come from the same pass as the others."""
    from forgeline.catalog import storage
    from forgeline.sinks import published

    plans = []

    def keep(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        raise published.Refused("", f"{small.sf_dir}/nation.parquet", [])

    monkeypatch.setattr(published, "checked_refresh", keep)
    with pytest.raises(Exception):
        storage.publish_checked(small).collect()
    assert "Union" not in plans[0]
