"""Sources, sinks and table maintenance."""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from lakeloom.functions.dates import wall_time
from lakeloom.functions.text import nonblank_line_count
from lakeloom.operators import dml
from lakeloom.operators.joins import insert_missing, not_in
from lakeloom.plans.registry import query
from lakeloom.session import shared_dir
from lakeloom.sources import documents, jdbc, sheets, writers
from lakeloom.sources.inline import values_relation


@query("scan_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= DATE '2001-01-01'")
def _scan(f):
    return f.orders.where(F.col("o_orderdate") >= wall_time(dt.date(2001, 1, 1))).select(
        "o_orderkey", "o_custkey", "o_orderstatus")


PRIORITIES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]
PRIORITY_VALUES = "(VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5))"


@query("values_relation", f"""
SELECT v.label, v.rank, count(o_orderkey) AS n FROM {PRIORITY_VALUES} v(label, rank)
LEFT JOIN orders ON o_orderpriority = v.label GROUP BY 1, 2""")
def _values(f):
    v = values_relation(f.spark, ["label", "rank"], PRIORITIES)
    return v.join(f.orders, F.col("o_orderpriority") == F.col("label"), "left").groupBy("label", "rank").agg(
        F.count("o_orderkey").alias("n"))


@query("insert_select")
def _insert_select(f):
    path = shared_dir(f.spark, "insert")
    cols = ["user_id", "event_type", "value", "model", "created_at"]
    defaults = {"model": F.lit("default"), "created_at": F.current_timestamp()}
    writers.insert_select(f.events.where("event_type = 'click'"), path, cols, defaults)
    writers.insert_select(f.events.where("event_type = 'view'"), path, cols, defaults)
    return f.spark.read.parquet(path).groupBy("event_type", "model").count()


@query("append_table")
def _append_table(f):
    path = shared_dir(f.spark, "append")
    name = "t_" + path.rsplit("-", 1)[1]
    for kind in ("signup", "purchase"):
        writers.append_table(f.events.where(F.col("event_type") == kind).select("event_id", "event_type"), name, path)
    return f.spark.table(name).groupBy("event_type").count()


@query("truncate_and_load")
def _truncate(f):
    path = shared_dir(f.spark, "reload")
    for kind in ("view", "click"):  # the second load replaces the first
        writers.truncate_and_load(f.events.where(F.col("event_type") == kind).select("event_id", "event_type"), path)
    return f.spark.read.parquet(path).groupBy("event_type").count()


@query("export_parquet")
def _export(f):
    path = shared_dir(f.spark, "export")
    writers.export_parquet(f.orders.withColumn("order_year", F.year("o_orderdate")), path, ["order_year"])
    return f.spark.read.parquet(path).where("order_year >= 2000").groupBy("order_year").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("batch_questions", "SELECT item_id AS question_id, text AS question, length(text) AS n_chars FROM benchmark")
def _questions(f):
    f.benchmark.select(F.col("item_id").alias("question_id"), F.col("text").alias("question")) \
        .createOrReplaceTempView("batch_questions")
    return f.spark.sql("SELECT *, CAST(length(question) AS BIGINT) AS n_chars FROM batch_questions")


PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>',
}


def encode_workbook(tables: dict[str, list[list]]) -> bytes:
    """Minimal workbook with inline strings, to give the parser something to read."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, body in PARTS.items():
            z.writestr(name, body)
        entries, links = [], []
        for i, (name, rows) in enumerate(tables.items(), 1):
            entries.append(f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>')
            links.append(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>')
            body = []
            for row in rows:
                cells = "".join(
                    "<c/>" if v is None else f"<c><v>{v}</v></c>" if isinstance(v, (int, float)) else
                    f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' for v in row)
                body.append(f"<row>{cells}</row>")
            z.writestr(f"xl/worksheets/sheet{i}.xml",
                       f"<worksheet {main}><sheetData>{''.join(body)}</sheetData></worksheet>")
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>{"".join(entries)}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   + "".join(links) + "</Relationships>")
    return buf.getvalue()


@query("ingest_sheets", """
SELECT 'supplier_' || s_suppkey || '.xlsx' AS file_name, t.sheet_name,
  CASE t.sheet_name WHEN 'profile' THEN 'key' || chr(9) || 'name' || chr(9) || 'nation' || chr(10)
    || s_suppkey || chr(9) || s_name || chr(9) || s_nationkey
  ELSE 'note' || chr(9) || chr(10) || chr(9) || chr(10) || s_name || chr(9) || 'ok' END AS content,
  CAST(2 AS BIGINT) AS row_count
FROM supplier CROSS JOIN (VALUES ('profile'), ('notes')) t(sheet_name)""")
def _ingest_sheets(f):
    """Workbooks are made from supplier rows inside the job, then parsed sheet by sheet."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({
                "path": [f"/stage/supplier_{k}.xlsx" for k in b["s_suppkey"]],
                "content": [encode_workbook({
                    "profile": [["key", "name", "nation"], [int(k), n, int(x)]],
                    "notes": [["note", None], [None, None], [n, "ok"]]})
                    for k, n, x in zip(b["s_suppkey"], b["s_name"], b["s_nationkey"])]})

    files = f.supplier.mapInPandas(make, "path string, content binary")
    return sheets.parse_workbooks(files).drop("pos")


@query("sheet_row_count", r"""
SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '\s+', '', 'g') <> '')) AS BIGINT)
  AS row_count FROM documents""")
def _sheet_rows(f):
    return f.documents.select("doc_id", nonblank_line_count("text").alias("row_count"))


@query("sheet_concat", """
SELECT conv_id, string_agg('[Sheet: ' || role || ']' || chr(10) || text, chr(10) ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""")
def _sheet_concat(f):
    return sheets.sheet_concat(f.conversations, "conv_id", "turn", "role", "text")


@query("load_html_documents", r"""
SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(replace(
  regexp_replace(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'),
  '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'),
  '[ \t\r\n]+', ' ', 'g')) AS text FROM pages""")
def _html(f):
    return documents.html_to_text(f.pages, "html")


@query("upload_registry", """
SELECT doc_id, 'doc_' || doc_id || '.txt' AS file_name, 'txt' AS file_type, text AS raw_text,
  CAST(len(list_filter(string_split(text, chr(10)), lambda x: length(trim(x)) > 10)) AS BIGINT) AS chunk_count,
  source AS uploaded_by FROM documents""")
def _upload(f):
    from lakeloom.operators.chunking import chunk_lines
    counts = chunk_lines(f.documents, ["doc_id"], "text").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("chunk_count"))
    return f.documents.join(counts, "doc_id", "left").select(
        "doc_id", F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt")).alias("file_name"),
        F.lit("txt").alias("file_type"), F.col("text").alias("raw_text"),
        F.coalesce("chunk_count", F.lit(0).cast("long")).alias("chunk_count"),
        F.col("source").alias("uploaded_by"))


@query("jdbc_scan_options", """
WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem)
SELECT CAST(count(c.i) AS INT) AS partition_no, n FROM (
  SELECT p, CAST(count(*) AS BIGINT) AS n FROM (
    SELECT (SELECT count(*) FROM range(1, 8) r(i) WHERE l_orderkey >= lo + (hi - lo + 1) * i // 8) AS p
    FROM lineitem, b) GROUP BY p) x LEFT JOIN range(1, 8) c(i) ON c.i <= x.p GROUP BY p, n""")
def _jdbc(f):
    cfg = jdbc.plan_scan(f.lineitem, "lineitem", "l_orderkey", 8)
    return jdbc.partition_profile(f.lineitem, cfg)


# ---- table maintenance -------------------------------------------------------------------------

@query("recompute_total", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS DECIMAL(18,0))
  * CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def _recompute(f):
    li = f.lineitem.join(f.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    total = F.col("l_quantity").cast("decimal(18,0)") * F.col("p_retailprice").cast("decimal(18,2)")
    return li.withColumn("total_amount", total.cast("double")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "total_amount")


@query("fill_missing_summary", """
SELECT source_id, coalesce(ai_summary, CASE WHEN length(source_code) > 0
  THEN 'Summary of ' || file_name || ': ' || source_code END) AS ai_summary,
  CASE WHEN ai_summary IS NULL AND length(source_code) > 0 THEN TIMESTAMP '2024-01-30 00:00:00' END AS update_at
FROM src""", "src")
def _fill_missing(f):
    prompt = F.concat(F.lit("Summary of "), "file_name", F.lit(": "), "source_code")
    out = dml.fill_missing(f.src(), "ai_summary", prompt, F.length("source_code") > 0, "update_at",
                           wall_time(f.events_as_of))
    return out.select("source_id", "ai_summary", "update_at")


@query("delete_cascade", """
WITH chunk AS (SELECT doc_id, lang, source FROM (SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS c
  FROM documents) WHERE length(trim(c)) > 10)
SELECT 'documents' AS table_name, (SELECT count(*) FROM documents WHERE source <> 'src3') AS kept,
  (SELECT count(*) FROM documents WHERE source = 'src3') AS deleted
UNION ALL SELECT 'chunks', (SELECT count(*) FROM chunk WHERE source <> 'src3'),
  (SELECT count(*) FROM chunk WHERE source = 'src3')
UNION ALL SELECT 'vectors', (SELECT count(*) FROM doc_vectors WHERE source <> 'src3'),
  (SELECT count(*) FROM doc_vectors WHERE source = 'src3')""", "doc_vectors")
def _delete(f):
    from lakeloom.operators.chunking import chunk_lines
    chunks = chunk_lines(f.documents, ["doc_id"], "text").select("doc_id")
    vectors = f.doc_vectors().select(F.col("vec_id").alias("doc_id"))
    doc = f.documents.select("doc_id", "source")
    cond = F.col("source") == "src3"
    rest, kept, gone = dml.delete_cascade(doc, cond, "doc_id", chunks, vectors)
    def n(df):
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = [("documents", n(rest), n(doc.where(cond))), ("chunks", n(kept[0]), n(gone[0])),
            ("vectors", n(kept[1]), n(gone[1]))]
    out = None
    for name, k, d in rows:
        row = f.spark.range(1).select(F.lit(name).alias("table_name"), k.alias("kept"), d.alias("deleted"))
        out = row if out is None else out.unionByName(row)
    return out


@query("incremental_embed", """
SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = d.doc_id)""")
def _incremental(f):
    have = f.embeddings.select(F.col("vec_id").alias("doc_id"))
    return insert_missing(f.documents, have, "doc_id").select("doc_id", "lang")


@query("not_in_null_aware", """
SELECT 'with_null' AS target, count(*) AS n FROM documents WHERE doc_id NOT IN (
  SELECT CASE WHEN quality = 1 THEN doc_id END FROM labels)
UNION ALL SELECT 'without_null', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _not_in(f):
    docs = f.texts.select("doc_id")
    nulls = f.labels.select(F.when(F.col("quality") == 1, F.col("doc_id")).alias("doc_id"))
    out = []
    for name, target in (("with_null", nulls), ("without_null", f.labels.select("doc_id"))):
        out.append(not_in(docs, target, "doc_id").agg(F.count(F.lit(1)).alias("n"))
                   .select(F.lit(name).alias("target"), "n"))
    return out[0].unionByName(out[1])


@query("stable_ids", """
SELECT md5(doc_id || '|' || pos) AS chunk_id, doc_id, CAST(pos AS INT) AS chunk_index FROM (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
    unnest(string_split(text, chr(10))) AS c FROM documents) WHERE length(trim(c)) > 10""")
def _stable_ids(f):
    from lakeloom.operators.chunking import chunk_lines
    c = chunk_lines(f.documents, ["doc_id"], "text")
    return c.select(dml.stable_id("doc_id", "chunk_index").alias("chunk_id"), "doc_id", "chunk_index")


@query("apply_defaults")
def _defaults(f):
    src = f.src().select("source_id", "ai_summary")
    return dml.apply_defaults(src, {"ai_summary": F.lit(""), "chunk_count": F.lit(0),
                                    "uploaded_by": F.current_user(), "created_at": F.current_timestamp()})


@query("search_content_view", """
SELECT source_id, module_name, ai_summary || ' モジュール名: ' || coalesce(module_name, '') || ' 機能名: '
  || coalesce(function_name, '') || ' ファイル名: ' || coalesce(file_name, '') || ' ジョブ名: ' || coalesce(ajs_name, '')
  AS search_content FROM src WHERE ai_summary IS NOT NULL""", "src")
def _view(f):
    from lakeloom.operators.retrieval import search_content
    f.src().where(F.col("ai_summary").isNotNull()).withColumn("search_content", search_content()) \
        .createOrReplaceTempView("v_search_content")
    return f.spark.sql("SELECT source_id, module_name, search_content FROM v_search_content")


@query("constraint_check", """
SELECT 'not_null' AS check_type, 'ai_summary' AS target, count(*) - count(ai_summary) AS violations FROM src
UNION ALL SELECT 'not_null', 'module_name', count(*) - count(module_name) FROM src
UNION ALL SELECT 'primary_key', 'source_id', count(*) FROM (SELECT source_id FROM src GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'foreign_key', 'source_id', count(*) FROM src WHERE source_id NOT IN (SELECT vec_id FROM embeddings)""",
       "src")
def _constraints(f):
    return dml.constraint_check(f.src(), ["source_id"], ["ai_summary", "module_name"],
                                {"source_id": (f.embeddings, "vec_id")})
