"""E-mail (EML) parsing and the message table.

``parse_emails`` turns ``(path, content)`` rows — the ``binaryFile``
source, or bytes composed by Spark — into one row per file.  The MIME
walk is the only Python in the job: it runs in ``mapInArrow`` on the
executors, one Arrow batch at a time (nothing is buffered per partition),
and a file that cannot be read yields a row with ``error`` set instead of
failing the task.  Every derived field (recipients, id hash, constant
fields, null defaults) is a Catalyst expression in :func:`messages`.

Header/body rules reproduced:

* From falls back to Sender; the owner is the **last** From address and a
  message without any From address is rejected.
* Reply-To falls back to From.  Subject is RFC 2047-decoded; addresses
  keep their personal name (``Name <addr>``).
* Multipart (top level only): each part without a file name appends
  ``" " + text``; nested multiparts are appended as their raw body, not
  descended into.  A part with a file name is an attachment
  ``(name, contentType, decoded bytes, encoded size)``.
* Single part: decoded text, or one attachment if it has a file name.
* Bodies are decoded as UTF-8 with malformed bytes replaced (U+FFFD);
  declared charsets are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from time import perf_counter_ns

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.strings import empty_array_if_null, empty_if_null, scala_list_string

ERROR_PREFIX = "Error while reading file  "  # fixed value: two spaces before the path

ADDRESS_FIELDS = ("from", "replyTo", "toRecipients", "ccRecipients", "bccRecipients")

PARSED_DDL = (
    "path string, error string, owner string, subject string, `from` array<string>, "
    "replyTo array<string>, toRecipients array<string>, ccRecipients array<string>, "
    "bccRecipients array<string>, content string, messageId string, contentId string, "
    "attachments array<struct<name:string,contentType:string,content:binary,size:bigint>>, "
    "skippedAttachments int, elapsedMicros bigint")

# Columns of the message table, in constructor order, then the derived ones.
MESSAGE_COLUMNS = ["owner", "subject", "from", "replyTo", "sentDate", "toRecipients",
                   "ccRecipients", "bccRecipients", "receivedDate", "content", "messageId",
                   "contentId", "attachments", "isReplica", "replicas", "recipients", "id"]

# Fields of structural message equality (recipients and replicas excluded).
EQUALITY_COLUMNS = ["id", "isReplica", "owner", "subject", "from", "replyTo", "sentDate",
                    "toRecipients", "ccRecipients", "bccRecipients", "receivedDate", "content",
                    "messageId", "contentId", "attachments"]

_FOLD = re.compile(r"\r?\n[ \t]+")
_BLANK = re.compile(rb"\A\r?\n|\r?\n\r?\n")


# ------------------------------------------------------------ Python side ---

def _unfold(v) -> str:
    return _FOLD.sub(" ", str(v)).rstrip("\r\n")


def _addresses(msg, name: str):
    from email.utils import formataddr, getaddresses
    vals = msg.get_all(name)
    if not vals:
        return None
    out = []
    # lenient: commas in comments and names do not make the list invalid
    for personal, addr in getaddresses([",".join(_unfold(v) for v in vals)], strict=False):
        if not addr and not personal:
            continue
        out.append(formataddr((personal, addr)) if personal else addr)
    return out


def _decoded_text(value):
    from email.header import decode_header, make_header
    if value is None:
        return None
    s = _unfold(value)
    try:
        return str(make_header(decode_header(s)))
    except Exception:  # noqa: BLE001 - undecodable words stay as written
        return s


def _body_of(data: bytes) -> bytes:
    """What follows the first empty line of an entity's bytes."""
    m = _BLANK.search(data)
    return data[m.end():] if m else b""


def _raw_parts(data: bytes, boundary: str) -> list[bytes]:
    """The bytes of each top-level part, exactly as they stand in the file."""
    mark = b"--" + boundary.encode("ascii", "surrogateescape")
    lines = re.compile(rb"(?:^|\r?\n)" + re.escape(mark) + rb"(--)?[ \t]*(?=\r?\n|\Z)")
    parts, start = [], None
    for m in lines.finditer(_body_of(data)):
        if start is not None:
            parts.append(m.string[start:m.start()])
        if m[1]:
            return parts
        eol = re.compile(rb"\r?\n").match(m.string, m.end())
        start = eol.end() if eol else m.end()
    if start is not None:
        parts.append(_body_of(data)[start:])
    return parts


def _decoded(part, raw: bytes) -> bytes:
    """A part's body: decoded, or for parts that hold parts or a message, as
    it stands in the file."""
    return _body_of(raw) if part.is_multipart() else part.get_payload(decode=True) or b""


def _encoded_size(part, raw: bytes) -> int:
    body = part.get_payload(decode=False)
    if isinstance(body, str):
        return len(body.encode("ascii", "surrogateescape"))
    return len(_body_of(raw))


def _text(part, raw: bytes) -> str:
    return _decoded(part, raw).decode("utf-8", "replace")


def _attachment(part, raw: bytes, name: str):
    ctype = part.get("Content-Type")
    return {"name": name,
            "contentType": _unfold(ctype) if ctype is not None else "text/plain",
            "content": _decoded(part, raw),
            "size": _encoded_size(part, raw)}


def _header(msg, name: str):
    """A header's text as written, from its first non-blank character on;
    8-bit bytes are read one character each (ISO 8859-1)."""
    for key, value in msg.raw_items():
        if key.lower() == name.lower():
            raw = str(value).encode("utf-8", "surrogateescape")
            text = raw.decode("latin-1") if any("\udc80" <= c <= "\udcff" for c in str(value)) else str(value)
            return text.lstrip(" \t\r\n").rstrip("\r\n")
    return None


def _valid_text(v):
    """Strings inside ``v`` as valid Unicode; bytes and numbers untouched."""
    if isinstance(v, str):
        return v.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
    if isinstance(v, list):
        return [_valid_text(x) for x in v]
    if isinstance(v, dict):
        return {k: _valid_text(x) for k, x in v.items()}
    return v


def parse_message(path: str, data: bytes) -> dict:
    """Parse one EML file into the parsed-row dict (``error`` set on failure)."""
    from email import policy
    from email.parser import BytesParser
    try:
        msg = BytesParser(policy=policy.compat32).parsebytes(data or b"")
        frm = _addresses(msg, "From")
        if frm is None:
            frm = _addresses(msg, "Sender")
        if not frm:
            raise ValueError("message has no From address")
        reply = _addresses(msg, "Reply-To") or frm
        content, attachments, skipped = "", [], 0
        body = msg.get_payload()
        if msg.get_content_maintype() == "multipart" and isinstance(body, list):
            raws = _raw_parts(data, msg.get_boundary() or "")
            if len(raws) != len(body):  # broken delimiters: as the parser saw them
                raws = [part.as_bytes() for part in body]
            parts = list(zip(body, raws, strict=True))
        else:
            parts = [(msg, data or b"")]
        for part, raw in parts:
            name = part.get_filename()
            if name is None:
                content += (" " if part is not msg else "") + _text(part, raw)
            else:
                try:
                    attachments.append(_attachment(part, raw, name))
                except Exception:  # noqa: BLE001 - an unreadable attachment is skipped and counted
                    skipped += 1
        return _valid_text({"path": path, "error": None, "owner": frm[-1],
                "subject": _decoded_text(msg.get("Subject")),
                "from": frm, "replyTo": reply,
                "toRecipients": _addresses(msg, "To"),
                "ccRecipients": _addresses(msg, "Cc"),
                "bccRecipients": _addresses(msg, "Bcc"),
                "content": content,
                "messageId": _header(msg, "Message-ID"),
                "contentId": _header(msg, "Content-ID"),
                "attachments": attachments, "skippedAttachments": skipped})
    except Exception:  # noqa: BLE001 - any failure rejects the file, never the task
        return {"path": path, "error": ERROR_PREFIX + str(path)}


def _arrow_schema():
    import pyarrow as pa
    strs = pa.list_(pa.string())
    att = pa.list_(pa.struct([("name", pa.string()), ("contentType", pa.string()),
                              ("content", pa.binary()), ("size", pa.int64())]))
    return pa.schema([("path", pa.string()), ("error", pa.string()), ("owner", pa.string()),
                      ("subject", pa.string()), ("from", strs), ("replyTo", strs),
                      ("toRecipients", strs), ("ccRecipients", strs), ("bccRecipients", strs),
                      ("content", pa.string()), ("messageId", pa.string()),
                      ("contentId", pa.string()), ("attachments", att),
                      ("skippedAttachments", pa.int32()), ("elapsedMicros", pa.int64())])


def _parse_batches(batches: Iterator, out_rows: int = 256) -> Iterator:
    import pyarrow as pa
    schema = _arrow_schema()
    names = schema.names
    for batch in batches:
        paths = batch.column("path").to_pylist()
        contents = batch.column("content")
        for start in range(0, len(paths), out_rows):
            rows = []
            for i in range(start, min(start + out_rows, len(paths))):
                t0 = perf_counter_ns()
                row = parse_message(paths[i], contents[i].as_py())
                rows.append({k: row.get(k) for k in names} | {"elapsedMicros": (perf_counter_ns() - t0) // 1000})
            try:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
            except (pa.ArrowException, UnicodeError, TypeError, ValueError):
                for r in rows:  # only the row that cannot be stored is rejected
                    yield _one_row(r, schema)


def _one_row(row: dict, schema):
    import pyarrow as pa
    try:
        return pa.RecordBatch.from_pylist([row], schema=schema)
    except (pa.ArrowException, UnicodeError, TypeError, ValueError):
        path = str(row["path"])
        empty = dict.fromkeys(schema.names)
        return pa.RecordBatch.from_pylist([empty | {
            "path": path, "error": ERROR_PREFIX + path, "elapsedMicros": row["elapsedMicros"]}], schema=schema)


# ------------------------------------------------------------- Spark side ---

def _ship_by_value() -> None:
    """Serialise this module's worker-side functions with the task.

    The Python workers then need only the standard library and pyarrow, not
    an installed copy of this package.
    """
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def parse_emails(files: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """``(path, content)`` → parsed rows (see :data:`PARSED_DDL`).

    Rows are parsed where they are; ``min_partitions`` spreads them first,
    for an input of a few large splits.  Building the plan runs no job.
    """
    _ship_by_value()
    files = files.select("path", "content")
    if min_partitions:
        files = files.repartition(min_partitions)
    return files.mapInArrow(_parse_batches, PARSED_DDL)


def messages(parsed: DataFrame) -> DataFrame:
    """Message table of the successfully parsed rows, with derived fields.

    ``recipients`` = to ++ cc ++ bcc (order and duplicates kept); ``id`` is
    the lowercase hex SHA-256 of owner, subject, from, replyTo, sentDate,
    to, cc, bcc, receivedDate, content and messageId, lists rendered as
    ``List(a, b)``.
    """
    ok = parsed.where(F.col("error").isNull())
    base = ok.select(
        "path",
        empty_if_null(F.col("owner")).alias("owner"),
        empty_if_null(F.col("subject")).alias("subject"),
        *[empty_array_if_null(F.col(f"`{c}`")).alias(c) for c in ADDRESS_FIELDS],
        F.lit("").alias("sentDate"), F.lit("").alias("receivedDate"),
        empty_if_null(F.col("content")).alias("content"),
        empty_if_null(F.col("messageId")).alias("messageId"),
        empty_if_null(F.col("contentId")).alias("contentId"),
        F.coalesce(F.col("attachments"),
                   F.array().cast("array<struct<name:string,contentType:string,"
                                  "content:binary,size:bigint>>")).alias("attachments"),
        F.lit(False).alias("isReplica"),
        F.array().cast("array<string>").alias("replicas"))
    hashed = F.concat(
        F.col("owner"), F.col("subject"), scala_list_string(F.col("`from`")),
        scala_list_string(F.col("replyTo")), F.col("sentDate"),
        scala_list_string(F.col("toRecipients")), scala_list_string(F.col("ccRecipients")),
        scala_list_string(F.col("bccRecipients")), F.col("receivedDate"), F.col("content"),
        F.col("messageId"))
    out = base.withColumn("recipients", F.concat("toRecipients", "ccRecipients", "bccRecipients")) \
              .withColumn("id", F.sha2(hashed, 256))
    return out.select("path", *[F.col(f"`{c}`") for c in MESSAGE_COLUMNS])


def rejects(parsed: DataFrame) -> DataFrame:
    """Distinct reject messages ``Error while reading file  <path>``."""
    return parsed.where(F.col("error").isNotNull()).select(F.col("error").alias("value")).distinct()


def ingest_stats(parsed: DataFrame) -> DataFrame:
    """``(processed, failed, attachments, skipped_attachments)`` in one
    partially aggregated pass."""
    return parsed.agg(
        F.count_if(F.col("error").isNull()).alias("processed"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("error").isNull(), F.size(F.col("attachments")))), F.lit(0))
         .cast("bigint").alias("attachments"),
        F.coalesce(F.sum("skippedAttachments"), F.lit(0)).cast("bigint").alias("skipped_attachments"))


def attachment_rows(msgs: DataFrame) -> DataFrame:
    """One row per attachment: ``(path, id, name, contentType, content, size)``."""
    return msgs.select("path", "id", F.inline("attachments"))


def dedup_messages(msgs: DataFrame) -> DataFrame:
    """Drop structurally equal messages (same 15 equality fields).

    The grouping key is the id and a SHA-256 of the other fields' JSON, so
    bodies and attachment bytes are no shuffle keys; partial aggregation
    keeps one row per key and task.
    """
    rest = [F.col(f"`{c}`") for c in EQUALITY_COLUMNS if c != "id"]
    key = F.sha2(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}), 256)
    row = F.struct(*[F.col(f"`{c}`") for c in msgs.columns])
    return (msgs.groupBy("id", key.alias("_key")).agg(F.first(row).alias("_row"))
            .select("_row.*"))
