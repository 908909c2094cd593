"""E-mail inputs: a directory tree of EML files, or EML bytes composed by Spark.

``compose_*`` build ``(path, content)`` rows from the ``documents`` table
with Spark string expressions (no driver data), standing in for an EML
corpus; ``write_eml_tree`` lays such rows out as one file per message in a
mail tree (``<root>/<lang>/<folder>/<name>``) with folder and file names as
mail archives have them, some starting with ``_`` or ``.``.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.files import open_store

# Fixed values of the composed corpus.
TREE_FOLDERS = ("inbox", "_sent_mail", ".x")
BOUNDARY = "tessera-part-boundary"
MAIL_DOMAIN = "example.com"


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _headers(with_ids: bool = True) -> list[Column]:
    h = [F.lit("From: "), _s("source"), F.lit(f"@{MAIL_DOMAIN}\n"),
         F.lit("To: "), _s("lang"), F.lit(f"@{MAIL_DOMAIN}\n")]
    if with_ids:
        h += [F.lit("Subject: doc "), _s("doc_id"), F.lit("\n"),
              F.lit("Message-ID: <"), _s("doc_id"), F.lit(f"@{MAIL_DOMAIN}>\n")]
    return h


def single_part_text(with_ids: bool = True) -> Column:
    """Headers From/To[/Subject/Message-ID], blank line, the document text."""
    return F.concat(*_headers(with_ids), F.lit("\n"), F.col("text"))


def attachment_payload() -> Column:
    """The attachment's bytes: ``<source>:<doc_id>``."""
    return F.concat(_s("source"), F.lit(":"), _s("doc_id"))


def multipart_text() -> Column:
    """Multipart/mixed: text, html, base64 attachment, nested multipart and an
    attached message; plus Cc with a comment, Bcc and Reply-To."""
    return F.concat(
        *_headers(True),
        F.lit("Cc: "), _s("source"), F.lit("@example.org (Doe, J), "), _s("lang"), F.lit("@example.org\n"),
        F.lit("Bcc: "), _s("source"), F.lit("@example.net\n"),
        F.lit("Reply-To: reply-"), _s("doc_id"), F.lit(f"@{MAIL_DOMAIN}\n"),
        F.lit(f'MIME-Version: 1.0\nContent-Type: multipart/mixed; boundary="{BOUNDARY}"\n\n'),
        F.lit(f"--{BOUNDARY}\nContent-Type: text/plain; charset=utf-8\n\n"), F.col("text"),
        F.lit(f"\n--{BOUNDARY}\nContent-Type: text/html; charset=utf-8\n\n<b>doc "), _s("doc_id"),
        F.lit(f"</b>\n--{BOUNDARY}\nContent-Type: application/octet-stream; name=\"doc-"),
        _s("doc_id"), F.lit(".bin\"\nContent-Disposition: attachment; filename=\"doc-"), _s("doc_id"),
        F.lit('.bin"\nContent-Transfer-Encoding: base64\n\n'),
        F.base64(F.encode(attachment_payload(), "UTF-8")),
        F.lit(f'\n--{BOUNDARY}\nContent-Type: multipart/alternative; boundary="in"\n\n'),
        nested_text(),
        F.lit(f'\n--{BOUNDARY}\nContent-Type: message/rfc822\n'
              'Content-Disposition: attachment; filename="inner.eml"\n\n'),
        attached_message(),
        F.lit(f"\n--{BOUNDARY}--\n"))


def nested_text() -> Column:
    """A nested multipart with CRLF line ends, appended to the content as it is."""
    return F.concat(F.lit("--in\r\nContent-Type: text/plain\r\n\r\nnested "), _s("doc_id"), F.lit("\r\n--in--\r\n"))


def attached_message() -> Column:
    return F.concat(F.lit(f"From: inner@{MAIL_DOMAIN}\n\ninner "), _s("doc_id"))


def _rows(docs: DataFrame, kind: str, text: Column) -> DataFrame:
    path = F.concat(F.lit(f"documents/{kind}/"), _s("lang"), F.lit("/"), _s("doc_id"), F.lit(".eml"))
    return docs.select(path.alias("path"), F.encode(text, "UTF-8").alias("content"))


def compose_single(docs: DataFrame, with_ids: bool = True) -> DataFrame:
    kind = "single" if with_ids else "plain"
    return _rows(docs, kind, single_part_text(with_ids))


def compose_multipart(docs: DataFrame) -> DataFrame:
    return _rows(docs, "multipart", multipart_text())


def compose_raw(docs: DataFrame) -> DataFrame:
    """The bare document text as a file: no headers, so it is rejected."""
    return _rows(docs, "raw", F.col("text"))


def compose_corpus(docs: DataFrame) -> DataFrame:
    """Single-part, multipart and header-less files of every document."""
    return compose_single(docs).unionByName(compose_multipart(docs)).unionByName(compose_raw(docs))


def write_eml_tree(docs: DataFrame, root: str, text: Column | None = None) -> None:
    """Write one file per document, by the tasks: ``root`` + :func:`tree_path`."""
    t = single_part_text(True) if text is None else text

    def put(batches):
        base = None
        made = set()  # folders of this task: few, as the tree's folders are
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if base is None:  # all paths are below one root: one client
                    store, base, _ = open_store(root)
                at = base + path[len(root):]
                folder = at.rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(at) as f:
                    f.write(data)
            yield batch.select([0])

    cloudpickle.register_pickle_by_value(sys.modules[open_store.__module__])
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = docs.select(F.concat(F.lit(root), tree_path()).alias("path"), F.encode(t, "UTF-8").alias("data"))
    rows.mapInArrow(put, "path string").write.format("noop").mode("overwrite").save()


def tree_path() -> Column:
    """``/<lang>/<inbox|_sent_mail|.x>/<doc_id>.``, every fifth name with a ``_`` before."""
    folder = F.element_at(F.array(*map(F.lit, TREE_FOLDERS)), (F.col("doc_id") % 3 + 1).cast("int"))
    name = F.concat(F.when(F.col("doc_id") % 5 == 0, "_").otherwise(""), _s("doc_id"), F.lit("."))
    return F.concat(F.lit("/"), _s("lang"), F.lit("/"), folder, F.lit("/"), name)
