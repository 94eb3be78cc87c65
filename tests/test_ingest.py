from __future__ import annotations

import datetime as dt
import hashlib
import time
import zipfile

import pytest
from conftest import CM_CSV, CM_HEADER, CM_ROWS, DAY, DELIV_CSV, FO_CSV, IDX_CSV, rows_of

from pyspark.sql import functions as F

from eodlake.fixtures import bridge
from eodlake.fixtures import landing as landing_files
from eodlake.plans import ingest
from eodlake.plans.ingest import update, update_product
from eodlake.sources import files, scan
from eodlake.sources.archives import member_blocks
from eodlake.sources.streams import RecordScan
from eodlake.streaming.incremental import ingest_stream

NEXT = dt.date(2024, 3, 14)


def log(store):
    return {(r.product, r.date): r for r in store["ingest_log"].collect()}


def test_ingest_rerun_force_and_missing_file(store, landing):
    path = landing.cm(DAY, CM_CSV)
    first = update_product(store, str(landing.root), "cm", [DAY, NEXT])
    assert (first.ingested, first.rows, first.non_trading, first.errors) == (1, 3, 1, 0)
    entry = log(store)["cm", DAY]
    assert (entry.status, entry.num_rows, entry.file_name) == ("ingested", 3, path.name)
    assert entry.sha256 == hashlib.sha256(path.read_bytes()).hexdigest()
    assert log(store)["cm", NEXT].status == "not_a_trading_day"
    assert {r.source_file for r in store["bhav_daily"].collect()} == {path.name}
    before = rows_of(store["bhav_daily"], "symbol", "close")

    again = update_product(store, str(landing.root), "cm", [DAY])
    assert (again.ingested, again.skipped) == (0, 1)
    forced = update_product(store, str(landing.root), "cm", [DAY], force=True)
    assert (forced.ingested, forced.rows) == (1, 3)
    assert rows_of(store["bhav_daily"], "symbol", "close") == before


def test_restated_day_replaces_rows_and_issues(store, landing):
    landing.cm(DAY, CM_CSV.replace("829.75", "90.00"))
    update_product(store, str(landing.root), "cm", [DAY])
    assert store["qc_issues"].count() == 1
    landing.cm(DAY, CM_CSV.replace("820.30", "821.15"))
    summary = update_product(store, str(landing.root), "cm", [DAY])
    assert summary.ingested == 1
    assert store["bhav_daily"].where("symbol = 'HERON'").first().close == 821.15
    assert store["qc_issues"].count() == 0


def test_a_bad_file_stops_nothing_else(store, landing):
    landing.cm(DAY, CM_CSV)
    landing.cm(NEXT, "SYMBOL,SERIES\nA,EQ\n")
    landing.cm(dt.date(2024, 3, 15), "")
    landing.cm(dt.date(2024, 3, 18), CM_HEADER + "\n")
    landing.cm(dt.date(2024, 3, 19), "\n".join([CM_HEADER, CM_ROWS[0].replace("54.97", "-")]))
    days = [DAY, NEXT, *[dt.date(2024, 3, d) for d in (15, 18, 19)]]
    summary = update_product(store, str(landing.root), "cm", days)
    assert (summary.ingested, summary.errors, summary.rows) == (1, 4, 3)
    errors = {d.day: r.error for (_, d), r in log(store).items() if r.status == "error"}
    assert "missing required columns" in errors[14]
    assert errors[15] == "file is empty"
    assert errors[18] == "no rows parsed"
    assert "NOT NULL" in errors[19]
    assert store["bhav_daily"].count() == 3


def test_error_replaces_the_log_row_but_not_the_data(store, landing):
    landing.cm(DAY, CM_CSV)
    update_product(store, str(landing.root), "cm", [DAY])
    landing.cm(DAY, "SYMBOL\nA\n")
    update_product(store, str(landing.root), "cm", [DAY])
    assert log(store)["cm", DAY].status == "error"
    assert store["bhav_daily"].count() == 3


def test_other_products_and_archives(store, landing):
    landing.idx(DAY, IDX_CSV)
    landing.fo(DAY, FO_CSV)
    landing.deliv(DAY, DELIV_CSV)
    landing.fo(NEXT, "hello", member="readme.txt")
    got = [update_product(store, str(landing.root), p, [DAY, NEXT]) for p in ("idx", "fo", "deliv")]
    assert [(s.ingested, s.errors, s.rows) for s in got] == [(1, 0, 2), (1, 1, 3), (1, 0, 3)]
    assert log(store)["fo", NEXT].error == "no CSV found in archive"
    assert store["fo_daily"].where("symbol = 'HERON'").first().option_type == "XX"


def test_plain_file_counts_before_its_zipped_twin(store, landing):
    landing.cm_zip(DAY, CM_CSV.replace("820.30", "1.00"))
    landing.cm(DAY, CM_CSV)
    landing.cm_zip(NEXT, CM_CSV.replace("13-MAR", "14-MAR").replace("13-Mar", "14-Mar"))
    summary = update_product(store, str(landing.root), "cm", [DAY, NEXT])
    assert summary.ingested == 2
    closes = rows_of(store["bhav_daily"].where("symbol = 'HERON'"), "date", "close")
    assert closes == [(DAY, 820.3), (NEXT, 820.3)]


def test_day_folder_of_parts(store, landing):
    """A folder named like the file: parts in name order, each with its header."""
    folder = landing.cm(DAY, "")
    folder.unlink()
    folder.mkdir()
    (folder / "part-0.csv").write_text("\n".join([CM_HEADER, CM_ROWS[0]]) + "\n")
    (folder / "part-1.csv").write_text(
        "\n".join([CM_HEADER, CM_ROWS[0].replace("820.30", "1.00"), *CM_ROWS[1:]]) + "\n"
    )
    summary = update_product(store, str(landing.root), "cm", [DAY])
    assert (summary.ingested, summary.rows) == (1, 3)
    assert store["bhav_daily"].where("symbol = 'HERON'").first().close == 820.3
    assert update_product(store, str(landing.root), "cm", [DAY]).skipped == 1


def test_order_survives_file_splits(spark, landing):
    """Duplicates in different splits of one file: the first one in the file is kept."""
    filler = [CM_ROWS[0].replace("HERON", f"S{i:05d}") for i in range(3000)]
    first, last = CM_ROWS[1], CM_ROWS[1].replace("34.05", "9.00")
    path = landing.cm(DAY, "\n".join([CM_HEADER, first, *filler, last]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        from eodlake.operators.clean import clean

        frame = scan.scan_plain(spark, "cm", CM_HEADER, [str(path)])
        assert frame.rdd.getNumPartitions() > 4
        cleaned = clean(frame, "cm")
        assert cleaned.rows.count() == 3001
        assert cleaned.rows.where("symbol = 'PLOVER'").first().close == 34.05
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_update_checks_products_and_ranges(store, landing):
    with pytest.raises(ValueError, match="not implemented"):
        update(store, str(landing.root), DAY, NEXT, ["bonds"])
    assert update(store, str(landing.root), NEXT, DAY, ["cm"])[0] == ingest.IngestSummary("cm")
    landing.cm(DAY, CM_CSV)
    # 2024-03-16 and 17 are a weekend: no candidates
    summary = update(store, str(landing.root), DAY, dt.date(2024, 3, 17))[0]
    assert (summary.ingested, summary.non_trading) == (1, 2)


def test_stream_takes_only_new_files(store, landing, tmp_path):
    root, checkpoint = str(landing.root), str(tmp_path / "stream")
    landing.cm(DAY, CM_CSV)
    ingest_stream(store, root, checkpoint, ["cm"]).awaitTermination()
    assert rows_of(store["ingest_log"], "date", "status") == [(DAY, "ingested")]
    landing.cm(NEXT, CM_CSV.replace("13-MAR", "14-MAR"))
    landing.idx(DAY, IDX_CSV)
    ingest_stream(store, root, checkpoint, ["cm", "idx"]).awaitTermination()
    assert store["ingest_log"].count() == 3
    before = store["ingest_log"].collect()
    ingest_stream(store, root, checkpoint, ["cm", "idx"]).awaitTermination()
    assert sorted(store["ingest_log"].collect()) == sorted(before)


@pytest.mark.parametrize("limit", [None, "10"])
def test_size_makes_no_difference(spark, store, landing, limit):
    """Two leading blank lines and a break in quotes: the same rows, plain and zipped, at any limit of Spark's."""
    text = "\n\n" + CM_CSV.replace("HERON", '"HE\nRON"')
    path = landing.cm(DAY, text)
    landing.cm_zip(NEXT, text.replace("13-MAR", "14-MAR").replace("13-Mar", "14-Mar"))
    key = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(key)
    if limit:
        spark.conf.set(key, limit)
    try:
        assert update_product(store, str(landing.root), "cm", [DAY, NEXT]).rows == 6
        assert update_product(store, str(landing.root), "cm", [DAY, NEXT]).skipped == 2
    finally:
        spark.conf.set(key, before)
    assert log(store)["cm", DAY].sha256 == hashlib.sha256(path.read_bytes()).hexdigest()
    assert {r.symbol for r in store["bhav_daily"].collect()} == {"HE\nRON", "PLOVER", "TERN"}


def test_damaged_files_fail_their_own_day(store, landing):
    good, latin, wide, torn, none = [dt.date(2024, 3, d) for d in (13, 14, 15, 18, 19)]
    landing.cm(good, CM_CSV)
    landing.cm(latin, "").write_bytes(CM_CSV.replace("HERON", "HERO\xc4").encode("latin-1"))
    head = CM_HEADER + ",NOTE" + "x" * (65535 - len(CM_HEADER) - 5)
    landing.cm(wide, head + "\xe4\n" + CM_ROWS[0].replace("13-MAR", "15-MAR") + "\n")
    filler = "\n".join([CM_HEADER, *[f"S{i:06d},{hash(i * 7919)}" for i in range(20000)]])
    archive = landing.cm_zip(torn, filler)
    content = bytearray(archive.read_bytes())
    content[len(content) // 2 : len(content) // 2 + 50] = b"\xff" * 50
    archive.write_bytes(bytes(content))
    with zipfile.ZipFile(landing.cm_zip(none, ""), "w") as empty:
        empty.writestr("readme.txt", "hello")
    summary = update_product(store, str(landing.root), "cm", [good, latin, wide, torn, none])
    assert (summary.ingested, summary.errors, summary.rows) == (2, 3, 4)
    errors = {d.day: r.error for (_, d), r in log(store).items() if r.status == "error"}
    assert errors[14] == "not UTF-8" and errors[19] == "no CSV found in archive"
    assert errors[18].startswith("unreadable archive")


def test_line_breaks_inside_quotes(store, landing):
    text = CM_CSV.replace("HERON", '"HE\nRON"').replace(" plover ", '"plo,ver"')
    landing.cm(DAY, text)
    landing.cm(NEXT, CM_CSV.replace("TERN", '"TERN"'))
    update_product(store, str(landing.root), "cm", [DAY, NEXT])
    got = [r.symbol for r in store["bhav_daily"].where("source_file LIKE '%13MAR%'").collect()]
    assert sorted(got) == ["HE\nRON", "PLO,VER"]  # the rest came again with the next file
    assert log(store)["cm", NEXT].num_rows == 3


@pytest.mark.parametrize("name", ['A 5" PIPE', '"A ""5"" X"', '"open'])
def test_same_records_plain_and_zipped(spark, landing, tmp_path, name):
    """A stray quote, escaped quotes and a quote that never closes."""
    text = "\n".join([CM_HEADER, CM_ROWS[0].replace("HERON", name), *CM_ROWS[1:]]) + "\n"
    got = []
    for put in (landing.cm, landing.cm_zip):
        path = put(DAY, text)
        parts = files.resolve_files(files.list_files(spark, [str(landing.root)]))
        data = scan.unpacked(scan.inspect(spark, parts), str(tmp_path / "out")).checkpoint()
        (frame,) = scan.scan_raw(spark, "cm", scan.group_by_layout(data))
        got.append(sorted(map(str, frame.drop("row_no").collect())))
        path.unlink()
    assert got[0] == got[1]


def test_many_lines_after_a_stray_quote():
    seen, started = RecordScan(), time.monotonic()
    seen.feed(b'A,B\n5" x,1\n')
    for _ in range(100):
        seen.feed(b"x,1\n" * 10_000)
    assert (seen.header, seen.breaks) == ("A,B", False)
    assert time.monotonic() - started < 5


def test_archive_members(tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("a.txt", "no")
        archive.writestr("One.CSV", "A,B\n")
        archive.writestr("two.csv", "C\n1\n")
    assert b"".join(member_blocks(str(path))) == b"A,B\n"
    assert b"".join(member_blocks(str(path), "TWO.csv")) == b"C\n1\n"
    with pytest.raises(ValueError, match="no CSV found in archive"):
        list(member_blocks(str(path), "none.csv"))


@pytest.mark.parametrize("write", [landing_files.write_landing, landing_files.write_archives])
def test_a_landed_day_has_few_parts_in_file_order(spark, tmp_path, write):
    """Days that alternate from row to row don't get a part in every task and batch."""
    days, rows = 6, 600
    raw = spark.range(rows).select(
        F.expr(f"date_add(DATE '2024-03-13', cast(id % {days} as int))").alias("file_date"), F.col("id").alias("row_no"), F.col("id").cast("string").alias("SYMBOL")
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        write(raw, "cm", str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = sorted(p for p in tmp_path.rglob("*") if p.suffix in (".csv", ".zip") and p.is_file())
    assert len(parts) <= rows // 50 + tasks + days
    got = {}
    for part in parts:
        text = b"".join(member_blocks(str(part))).decode() if part.suffix == ".zip" else part.read_text()
        got.setdefault(part.parent.name, []).extend(int(x.strip('"')) for x in text.split()[1:])
    assert sorted(got.values()) == [list(range(d, rows, days)) for d in range(days)]


@pytest.mark.parametrize("product", ["cm", "fo"])
def test_landed_text_is_made_after_the_shuffle(spark, tmp_path, product):
    """Events are spread as they are; their files hold the same lines in the same order as those of rows spread as text."""
    events = spark.range(400).select(
        F.col("id").alias("event_id"), F.expr("timestamp_seconds(1704070800 + id % 3 * 86400)").alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.expr("element_at(array('view', 'click', 'signup'), cast(id % 3 as int) + 1)").alias("event_type"), (F.col("id") / 4).alias("value"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    raw = bridge.raw(spark, str(tmp_path), product, ordered=True)
    before = raw._jdf.queryExecution().executedPlan().toString().split("rangepartitioning")
    assert len(before) == 2 and "lpad" in before[0] and "lpad" not in before[1]
    write = landing_files.write_archives if product == "fo" else landing_files.write_landing
    found = []
    for root, rows, ordered in ((tmp_path / "a", raw, True), (tmp_path / "b", bridge.raw(spark, str(tmp_path), product), False)):
        write(rows, product, str(root), ordered)
        days = {}
        for part in sorted(p for p in (root / product).rglob("*") if p.suffix in (".csv", ".zip") and p.is_file()):
            text = b"".join(member_blocks(str(part))) if part.suffix == ".zip" else part.read_bytes()
            days.setdefault(part.parent.name, []).extend(text.splitlines()[1:])
        found.append(days)
    assert found[0] == found[1] and sum(map(len, found[0].values())) == 400 and len(found[0]) == 3
