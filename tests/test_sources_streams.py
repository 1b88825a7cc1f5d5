"""Sources, sinks and streaming jobs on small files."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from lakeloom import api
from lakeloom.operators import retrieval
from lakeloom.plans.ingest import encode_workbook
from lakeloom.sources import sheets
from lakeloom.sources.jdbc import JdbcScan, partition_profile, plan_scan
from lakeloom.sources.writers import VersionedTable, append_table, export_parquet, insert_select, truncate_and_load
from lakeloom.streaming import jobs
from lakeloom.streaming.sinks import UpsertLog


def test_workbook_folder(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(encode_workbook({"s1": [["x", 1], [None, None], ["y & z", 2.5]], "s2": [[None, "q"]]}))
    out = {(r["file_name"], r["sheet_name"]): (r["content"], r["row_count"]) for r in sheets.ingest_sheets(spark, str(tmp_path)).collect()}
    assert out == {("a.xlsx", "s1"): ("x\t1\n\t\ny & z\t2.5", 2), ("a.xlsx", "s2"): ("\tq", 1)}


def test_workbook_shared_strings_dates_and_gaps():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>hello</t></si><si><r><t>a</t></r><r><t>b</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
                   '<row r="3"><c r="B3" s="1"><v>45000</v></c><c r="C3" t="b"><v>1</v></c></row></sheetData></worksheet>')
    assert sheets.workbook_sheets(buf.getvalue()) == [(0, "S", "hello\t\tab\n\t\t\n\t2023-03-15 00:00:00\tTrue")]


def test_jdbc_ranges_cover_every_row(spark):
    df = spark.createDataFrame([(None,)] + [(i,) for i in range(-3, 98)], "k int")
    cfg = plan_scan(df, "t", "k", 7)
    parts = {r["partition_no"]: r["n"] for r in partition_profile(df, cfg).collect()}
    assert sum(parts.values()) == 102 and set(parts) == set(range(7))
    assert JdbcScan("u", "t", "k", 0, 0, 8).predicates() == ["(1 = 1 OR k IS NULL)"]
    assert "LIMIT 10" in JdbcScan("u", "t", "k", 0, 9, row_limit=10).source()


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("g", F.col("id") % 2)
    p = str(tmp_path / "t")
    for _ in range(2):
        insert_select(df, p, ["id", "g", "m"], {"m": F.lit("x")})
    assert spark.read.parquet(p).count() == 20
    truncate_and_load(df.where("id < 3"), p)
    assert spark.read.parquet(p).count() == 3
    export_parquet(df, str(tmp_path / "e"), ["g"])
    assert {f.name for f in (tmp_path / "e").iterdir() if f.is_dir()} == {"g=0", "g=1"}
    append_table(df, "tbl_sinks", str(tmp_path / "tbl"))
    append_table(df, "tbl_sinks", str(tmp_path / "tbl"))
    assert spark.table("tbl_sinks").count() == 20


def test_versioned_table_reads_itself_while_it_writes(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "v"))
    assert t.read() is None
    t.write(spark.range(3))
    t.write(t.read().union(spark.range(10, 12).toDF("id")))
    (tmp_path / "v" / "version=9").mkdir()  # a version whose job never committed
    assert t.current() == 2 and t.read().count() == 5


def test_upsert_log_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    log = UpsertLog(spark, str(tmp_path / "log"), ["k"], df.schema)
    log.write(df, 0)
    log.write(spark.createDataFrame([(2, "c")], df.schema), 1)
    log.write(spark.createDataFrame([(2, "c")], df.schema), 1)  # retried batch
    assert sorted(map(tuple, log.latest().collect())) == [(1, "a"), (2, "c")]
    assert log.read_all().count() == 3
    small = log.compact(str(tmp_path / "log2"))
    assert sorted(map(tuple, small.latest().collect())) == [(1, "a"), (2, "c")]


def write_events(spark, folder, n, rows):
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(f"{folder}/events_{n}.parquet")


def flat(folder):
    """Part files next to each other, the way a landing folder looks."""
    import pathlib
    return [p for p in pathlib.Path(folder).rglob("*.parquet") if p.is_file()]


def test_streams_over_several_files_equal_batch(spark, tmp_path):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 23, 50)
    rows = [(i, t0 + dt.timedelta(minutes=3 * i), i % 4, ["signup", "view", "error", "purchase"][i % 4], float(i), "{}") for i in range(40)]
    land = tmp_path / "land"
    land.mkdir()

    def add(n, part):
        write_events(spark, tmp_path / "w", n, part)
        src = flat(tmp_path / "w" / f"events_{n}.parquet")[0]
        (land / "events.parquet").mkdir(exist_ok=True)
        (land / "events.parquet" / f"part-{n}.parquet").write_bytes(src.read_bytes())

    def run(build, log, cp):
        q = jobs.upsert_stream(build(jobs.table_stream(spark, str(land), "events", 1)), log, cp)
        q.awaitTermination()
        assert q.exception() is None

    def windows(s):
        return jobs.windowed_counts(s, "ts", "5 minutes", "1 hour")

    add(0, rows[10:])
    schema = windows(spark.createDataFrame(rows, spark.read.parquet(str(land / "events.parquet")).schema)).schema
    log = UpsertLog(spark, str(tmp_path / "log"), ["window_start"], schema)
    run(windows, log, str(tmp_path / "cp"))
    add(1, rows[5:10])  # late, but inside the allowed hour before the newest event? no: those are dropped
    run(windows, log, str(tmp_path / "cp"))
    total = log.latest().agg(F.sum("n")).first()[0]
    assert total in (30, 35)  # a late row is either counted or past the watermark, never counted twice

    ch = jobs.table_stream(spark, str(land), "events", 1).select(
        F.col("user_id").alias("k"), F.col("event_id").alias("seq"),
        F.expr("CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END").alias("op"), F.col("value").alias("v"))
    clog = UpsertLog(spark, str(tmp_path / "clog"), ["k"], ch.schema)
    jobs.change_stream(ch, clog, str(tmp_path / "ccp"), "k").awaitTermination()
    base = spark.createDataFrame([(0, -1.0), (2, -1.0), (77, -1.0)], "k long, v double")
    out = sorted(map(tuple, jobs.merged(base, clog, "k").collect()))
    assert out == [(0, 36.0), (1, 37.0), (3, 39.0), (77, -1.0)]  # the older file came later and lost


def test_conversation_state_is_trimmed(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    for n in range(3):
        spark.createDataFrame([(1, n * 10 + i, "user", f"m{n * 10 + i}") for i in range(10)], "conv_id long, turn long, role string, text string") \
            .coalesce(1).write.parquet(str(tmp_path / f"w{n}"))
        (land / "conversations.parquet").mkdir(exist_ok=True)
        (land / "conversations.parquet" / f"part-{n}.parquet").write_bytes(flat(tmp_path / f"w{n}")[0].read_bytes())
    s = jobs.conversation_stream(jobs.table_stream(spark, str(land), "conversations", 1), 20)
    log = UpsertLog(spark, str(tmp_path / "log"), ["conv_id"], s.schema)
    jobs.upsert_stream(s, log, str(tmp_path / "cp")).awaitTermination()
    r = log.latest().first()
    assert r["n_kept"] == 20 and "m29" in r["history"] and "m9\"" not in r["history"]


def test_rag_search_falls_back(spark):
    docs = spark.createDataFrame([(1, "a", "paid leave is twenty days"), (2, "b", "the password needs twelve signs")],
                                 "chunk_no long, doc_name string, chunk_text string")
    vec = api.default_encoder(docs, ["chunk_no", "doc_name", "chunk_text"], "chunk_text")
    q = spark.createDataFrame([(1, "paid leave days"), (2, "zebra crossing")], "question_id long, question string")
    out = {r["question_id"]: r for r in api.rag_search(vec, q, 1, 0.4).collect()}
    assert out[1]["found"] and "paid leave is twenty days" in out[1]["prompt"]
    assert not out[2]["found"] and out[2]["prompt"] == retrieval.NOT_FOUND


def test_delete_log_and_messages(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id int, doc_name string")
    ch = spark.createDataFrame([(1,), (1,), (2,)], "doc_id int")
    rest, kept, n = api.delete_document(docs, "a", ch)
    assert (rest.count(), kept[0].count(), n) == (1, 1, 2)
    row = spark.createDataFrame([("q", "a", 0.9, 0.8, "m", 12)], "query string, answer string, max_similarity double, "
                                "avg_similarity double, model_used string, latency_ms int")
    api.log_query(str(tmp_path / "log"), row)
    assert spark.read.parquet(str(tmp_path / "log")).first()["user_feedback"] is None
    assert api.execute_or_message(spark, "SELECT 1 AS x WHERE 1 = 0").first()["message"] == api.NO_DATA
    assert api.execute_or_message(spark, "SELECT 1 AS x").first()["x"] == 1


def test_batch_complete_isolates_a_bad_prompt(spark):
    def client(model, prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("refused")
        return [model + ":" + p for p in prompts]
    df = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "fine")], "i int, p string").coalesce(1)
    out = {(r["i"], r["model"]): (r["answer"], r["error"]) for r in retrieval.batch_complete(df, ["i"], "p", ["m", "n"], client, 1).collect()}
    assert out[(1, "m")] == ("m:ok", None) and out[(2, "n")] == (None, "refused") and len(out) == 6


def test_process_new_documents_twice(spark):
    docs = spark.createDataFrame([(1, "a line that is long enough\nshort\nanother line long enough")], "doc_id long, text string")
    none = spark.createDataFrame([], "chunk_id string")
    first = api.process_new_documents(docs, none)
    assert first.count() == 2
    assert api.process_new_documents(docs, first).count() == 0


@pytest.mark.parametrize("name", ["orders"])
def test_catalog(spark, name):
    from lakeloom.sources.tables import register_views
    register_views(spark, "/root/testdata/sf0.001", [name])
    assert [r["column_name"] for r in api.describe_tables(spark, [name]).orderBy("position").collect()][:2] == ["o_orderkey", "o_custkey"]
