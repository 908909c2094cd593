"""Registered e-mail queries over EML files composed from ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import email as E
from tessera.operators.skew import spread
from tessera.plans.email_ingest import ingest_emails
from tessera.session import scratch_path
from tessera.sources import eml
from tessera.sources.files import bare_path, list_files_recursive, read_binary_files
from tessera.sources.tables import documents


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    # Parsing is per-row Python work: spread the documents (a table may be a
    # single row group, i.e. one scan task) before composing and parsing.
    return spread(documents(spark, sf).select("doc_id", "text", "lang", "source"), "doc_id")


def _single(spark: SparkSession, sf: str) -> DataFrame:
    return E.messages(E.parse_emails(eml.compose_single(_docs(spark, sf))))


def _multi(spark: SparkSession, sf: str) -> DataFrame:
    return E.messages(E.parse_emails(eml.compose_multipart(_docs(spark, sf))))


def _tree(spark: SparkSession, sf: str) -> str:
    """EML tree: one single-part file and one header-less file per document."""
    root = scratch_path(spark, "eml-tree")
    docs = _docs(spark, sf)
    eml.write_eml_tree(docs, f"{root}/mail")
    eml.write_eml_tree(docs, f"{root}/junk", text=F.col("text"))
    return root


def _doc_id_of(path_col: str = "path"):
    return F.regexp_extract(F.col(path_col), r"/_?(\d+)\.$", 1).cast("bigint")


def q_email_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _single(spark, sf)


def q_email_multipart(spark: SparkSession, sf: str) -> DataFrame:
    return _multi(spark, sf)


def q_email_attachments(spark: SparkSession, sf: str) -> DataFrame:
    return E.attachment_rows(_multi(spark, sf)).drop("id")


def q_email_recipients(spark: SparkSession, sf: str) -> DataFrame:
    return _multi(spark, sf).select("path", "toRecipients", "ccRecipients", "bccRecipients",
                                    "recipients")


def q_email_id(spark: SparkSession, sf: str) -> DataFrame:
    return _single(spark, sf).select("path", "id")


def q_email_dedup(spark: SparkSession, sf: str) -> DataFrame:
    msgs = E.messages(E.parse_emails(eml.compose_single(_docs(spark, sf), with_ids=False)))
    return E.dedup_messages(msgs.drop("path"))


def q_email_rejects(spark: SparkSession, sf: str) -> DataFrame:
    root = _tree(spark, sf)
    bare = spark.range(1).select(bare_path(F.lit(root))).first()[0]
    found = E.rejects(E.parse_emails(read_binary_files(spark, root)))
    return found.select(F.replace("value", F.lit(bare), F.lit("")).alias("value"))


def q_email_ingest_stats(spark: SparkSession, sf: str) -> DataFrame:
    return E.ingest_stats(E.parse_emails(eml.compose_corpus(_docs(spark, sf))))


def q_scan_binary_files(spark: SparkSession, sf: str) -> DataFrame:
    root = _tree(spark, sf)
    return read_binary_files(spark, f"{root}/mail").select(_doc_id_of().alias("doc_id"), "content")


def q_list_files_recursive(spark: SparkSession, sf: str) -> DataFrame:
    root = _tree(spark, sf)
    return list_files_recursive(spark, root).select(
        F.regexp_extract("path", r"/(mail|junk)/", 1).alias("tree"), _doc_id_of().alias("doc_id"),
        "length")


def q_email_ingest(spark: SparkSession, sf: str) -> DataFrame:
    root = _tree(spark, sf)
    out = scratch_path(spark, "messages")
    ingest_emails(spark, root, out, overwrite=True, codec="GZIP",
                  rejects_path=scratch_path(spark, "ingestion_errors") + ".txt")
    return spark.read.parquet(out)


QUERIES = {
    "email_parse": q_email_parse,
    "email_multipart": q_email_multipart,
    "email_attachments": q_email_attachments,
    "email_recipients": q_email_recipients,
    "email_id": q_email_id,
    "email_dedup": q_email_dedup,
    "email_rejects": q_email_rejects,
    "email_ingest_stats": q_email_ingest_stats,
    "scan_binary_files": q_scan_binary_files,
    "list_files_recursive": q_list_files_recursive,
    "email_ingest": q_email_ingest,
}

# ------------------------------------------------------------------ oracle ---

_NL = "chr(10)"
_OWNER = "(source || '@example.com')"
_TO = "(lang || '@example.com')"
_EMPTY = "[]::varchar[]"
_ATT_T = "struct(name varchar, contentType varchar, content blob, size bigint)[]"


def _list(*items: str) -> str:
    return "'List(' || " + (" || ', ' || ".join(items) if items else "''") + " || ')'"


def _single_eml(with_ids: bool = True) -> str:
    h = f"'From: ' || {_OWNER} || {_NL} || 'To: ' || {_TO} || {_NL}"
    if with_ids:
        h += (f" || 'Subject: doc ' || doc_id || {_NL} || 'Message-ID: <' || doc_id || "
              f"'@example.com>' || {_NL}")
    return f"{h} || {_NL} || text"


def _msg_select(path: str, subject: str, reply: list[str], cc: list[str], bcc: list[str],
                content: str, message_id: str, attachments: str, with_path: bool = True) -> str:
    arr = lambda xs: f"[{', '.join(xs)}]::varchar[]" if xs else _EMPTY
    hashed = " || ".join([
        _OWNER, subject, _list(_OWNER), _list(*reply), "''", _list(_TO), _list(*cc), _list(*bcc),
        "''", content, message_id])
    cols = [] if not with_path else [f"{path} as path"]
    cols += [f"{_OWNER} as owner", f"{subject} as subject", f"[{_OWNER}] as \"from\"",
             f"{arr(reply)} as replyTo", "'' as sentDate", f"[{_TO}] as toRecipients",
             f"{arr(cc)} as ccRecipients", f"{arr(bcc)} as bccRecipients", "'' as receivedDate",
             f"{content} as content", f"{message_id} as messageId", "'' as contentId",
             f"{attachments} as attachments", "false as isReplica", f"{_EMPTY} as replicas",
             f"[{_TO}] || {arr(cc)} || {arr(bcc)} as recipients", f"sha256({hashed}) as id"]
    return "select " + ", ".join(cols) + " from documents"


def _path(kind: str) -> str:
    return f"'documents/{kind}/' || lang || '/' || doc_id || '.eml'"


_INNER = f"('From: inner@example.com' || {_NL} || {_NL} || 'inner ' || doc_id)"
_CRLF = "chr(13) || chr(10)"
_NESTED = (f"('--in' || {_CRLF} || 'Content-Type: text/plain' || {_CRLF} || {_CRLF} || 'nested ' || doc_id || "
           f"{_CRLF} || '--in--' || {_CRLF})")
_PAYLOAD = "encode(source || ':' || doc_id)"
_ATTS = (f"[{{'name': 'doc-' || doc_id || '.bin', "
         f"'contentType': 'application/octet-stream; name=\"doc-' || doc_id || '.bin\"', "
         f"'content': {_PAYLOAD}, 'size': cast(length(to_base64({_PAYLOAD})) as bigint)}}, "
         "{'name': 'inner.eml', 'contentType': 'message/rfc822', "
         f"'content': encode({_INNER}), 'size': cast(strlen({_INNER}) as bigint)}}]")

SINGLE_SQL = _msg_select(_path("single"), "('doc ' || doc_id)", [_OWNER], [], [], "text",
                         "('<' || doc_id || '@example.com>')", f"[]::{_ATT_T}")
MULTI_SQL = _msg_select(
    _path("multipart"), "('doc ' || doc_id)", ["('reply-' || doc_id || '@example.com')"],
    ["('\"Doe, J\" <' || source || '@example.org>')", "(lang || '@example.org')"], ["(source || '@example.net')"],
    f"(' ' || text || ' <b>doc ' || doc_id || '</b>' || ' ' || {_NESTED})", "('<' || doc_id || '@example.com>')", _ATTS)
PLAIN_SQL = _msg_select(_path("plain"), "''", [_OWNER], [], [], "text", "''", f"[]::{_ATT_T}",
                        with_path=False)
TREE_SQL = _msg_select(_path("single"), "('doc ' || doc_id)", [_OWNER], [], [],
                       "text", "('<' || doc_id || '@example.com>')", f"[]::{_ATT_T}",
                       with_path=False)

ORACLE = {
    "email_parse": SINGLE_SQL,
    "email_multipart": MULTI_SQL,
    "email_attachments": (f"with m as ({MULTI_SQL}) select path, a.name, a.contentType, a.content, "
                          "a.size from m, unnest(m.attachments) as t(a)"),
    "email_recipients": (f"with m as ({MULTI_SQL}) select path, toRecipients, ccRecipients, "
                         "bccRecipients, recipients from m"),
    "email_id": f"with m as ({SINGLE_SQL}) select path, id from m",
    "email_dedup": f"select distinct * from ({PLAIN_SQL})",
    "email_rejects": ("select distinct 'Error while reading file  /junk/' || lang || '/' || "
                      "(case doc_id % 3 when 0 then 'inbox' when 1 then '_sent_mail' else '.x' end) || '/' || "
                      "(case when doc_id % 5 = 0 then '_' else '' end) || doc_id || '.' as value from documents"),
    "email_ingest_stats": ("select 2 * count(*) as processed, count(*) as failed, "
                           "2 * count(*) as attachments, 0::bigint as skipped_attachments from documents"),
    "scan_binary_files": f"select doc_id, encode({_single_eml()}) as content from documents",
    "list_files_recursive": (
        f"select 'mail' as tree, doc_id, cast(octet_length(encode({_single_eml()})) as bigint) "
        "as length from documents union all "
        "select 'junk', doc_id, cast(octet_length(encode(text)) as bigint) from documents"),
    "email_ingest": TREE_SQL,
}
