import datetime as dt
import os
import tempfile

import pytest

from tessera.operators import email as E
from tessera.plans.email_ingest import ingest_emails, rejects_file_name
from tessera.sources import eml
from tessera.sources.tables import documents
from support import SF_SMALL

MULTI = (b"From: a@x.org\nSubject: hi\nMIME-Version: 1.0\n"
         b"Content-Type: multipart/mixed; boundary=\"BB\"\n\n"
         b"--BB\nContent-Type: text/plain\n\nP1\n"
         b"--BB\nContent-Type: text/html\n\n<b>P2</b>\n"
         b"--BB\nContent-Type: application/pdf; name=\"f.pdf\"\n"
         b"Content-Disposition: attachment; filename=\"f.pdf\"\n"
         b"Content-Transfer-Encoding: base64\n\naGVsbG8=\n--BB--\n")

NESTED = (b"From: a@x.org\nContent-Type: multipart/mixed; boundary=\"OUT\"\n\n"
          b"--OUT\nContent-Type: multipart/alternative; boundary=\"IN\"\n\n"
          b"--IN\nContent-Type: text/plain\n\ninner\n--IN--\n"
          b"--OUT--\n")


def parse(data):
    return E.parse_message("p", data)


def test_no_from_is_rejected_with_two_spaces():
    r = parse(b"Subject: x\n\nbody")
    assert r["error"] == "Error while reading file  p"


def test_owner_is_last_from_address():
    r = parse(b"From: A B <a@x.org>, c@y.org\n\nbody")
    assert r["owner"] == "c@y.org" and r["from"] == ["A B <a@x.org>", "c@y.org"]
    assert r["replyTo"] == r["from"]


def test_sender_fallback_and_headers():
    r = parse(b"Sender: s@x.org\nTo: t@x.org, u@x.org\nCc: c@x.org\nReply-To: r@x.org\n"
              b"Subject: =?utf-8?q?caf=C3=A9?=\nMessage-ID: <1@x>\nContent-ID: <c1>\n\nbody\n")
    assert r["owner"] == "s@x.org" and r["replyTo"] == ["r@x.org"]
    assert r["toRecipients"] == ["t@x.org", "u@x.org"] and r["ccRecipients"] == ["c@x.org"]
    assert r["bccRecipients"] is None and r["subject"] == "café"
    assert (r["messageId"], r["contentId"], r["content"]) == ("<1@x>", "<c1>", "body\n")


def test_invalid_utf8_is_replaced():
    assert parse(b"From: a@x.org\n\nok \xff end")["content"] == "ok � end"


def test_multipart_content_and_attachment():
    r = parse(MULTI)
    assert r["content"] == " P1 <b>P2</b>"
    (a,) = r["attachments"]
    assert (a["name"], a["content"], a["size"]) == ("f.pdf", b"hello", 8)
    assert a["contentType"].startswith("application/pdf")


def test_nested_multipart_appends_raw_text():
    r = parse(NESTED)
    assert "--IN" in r["content"] and "inner" in r["content"]


def test_single_part_attachment():
    r = parse(b"From: a@x.org\nContent-Type: text/csv\nContent-Disposition: attachment; "
              b"filename=d.csv\n\na,b\n")
    assert r["content"] == "" and r["attachments"][0]["name"] == "d.csv"
    assert r["attachments"][0]["content"] == b"a,b\n"


def test_messages_derived_fields(spark):
    df = spark.createDataFrame([("p1", MULTI), ("p2", b"no headers here")], "path string, content binary")
    parsed = E.parse_emails(df)
    m = E.messages(parsed).first()
    assert m.recipients == [] and m.sentDate == "" and m.isReplica is False and m.replicas == []
    import hashlib
    h = ("a@x.org" + "hi" + "List(a@x.org)" + "List(a@x.org)" + "" + "List()" + "List()" + "List()"
         + "" + " P1 <b>P2</b>" + "")
    assert m.id == hashlib.sha256(h.encode()).hexdigest()
    assert [r.value for r in E.rejects(parsed).collect()] == ["Error while reading file  p2"]
    s = E.ingest_stats(parsed).first()
    assert (s.processed, s.failed, s.attachments) == (1, 1, 1)
    assert E.attachment_rows(E.messages(parsed)).count() == 1


def test_dedup_equal_messages(spark):
    df = spark.createDataFrame([("p1", MULTI), ("p2", MULTI), ("p3", NESTED)], "path string, content binary")
    assert E.dedup_messages(E.messages(E.parse_emails(df)).drop("path")).count() == 2


def test_rejects_file_name():
    t = dt.datetime(2024, 5, 6, 15, 7)
    assert rejects_file_name("/out/errors.txt", t) == "/out/errors20240506-1507.txt"
    assert rejects_file_name("/out/errors", t) == "/out/errors20240506-1507"
    assert rejects_file_name("/a.b/errors", t) == "/a.b/errors20240506-1507"


def test_ingest_pipeline_from_directory(spark):
    root = tempfile.mkdtemp(prefix="eml-")
    os.makedirs(f"{root}/in/a/b")
    with open(f"{root}/in/a/m1.eml", "wb") as f:
        f.write(MULTI)
    with open(f"{root}/in/a/b/m2.eml", "wb") as f:
        f.write(b"From: z@x.org\n\nhello")
    with open(f"{root}/in/bad.eml", "wb") as f:
        f.write(b"Subject: x\n\nno from")
    t = dt.datetime(2024, 1, 2, 13, 4)
    res = ingest_emails(spark, f"{root}/in", f"{root}/out", codec="SNAPPY",
                        rejects_path=f"{root}/errors.txt", now=t)
    assert (res["processed"], res["failed"], res["attachments"]) == (2, 1, 1)
    assert res["processed_elapsed_ms"] > 0 and 0 < res["failed_elapsed_ms"] < 60_000
    assert res["rejects_path"] == f"{root}/errors20240102-1304.txt"
    out = spark.read.parquet(f"{root}/out")
    assert sorted(r.owner for r in out.collect()) == ["a@x.org", "z@x.org"]
    rej = [r.value for r in spark.read.text(res["rejects_path"]).collect()]
    assert len(rej) == 1 and rej[0].startswith("Error while reading file  ") and rej[0].endswith("bad.eml")
    with pytest.raises(FileExistsError):
        ingest_emails(spark, f"{root}/in", f"{root}/out", overwrite=False)


def test_composed_corpus_counts(spark):
    docs = documents(spark, SF_SMALL)
    s = E.ingest_stats(E.parse_emails(eml.compose_corpus(docs))).first()
    n = docs.count()
    assert (s.processed, s.failed, s.attachments) == (2 * n, n, 2 * n)


def test_quoted_printable_and_crlf():
    r = parse(b"From: a@x.org\r\nContent-Transfer-Encoding: quoted-printable\r\n\r\ncaf=C3=A9 =\r\nok\r\n")
    assert r["owner"] == "a@x.org" and r["content"] == "café ok\r\n"


def test_crlf_multipart():
    r = parse(MULTI.replace(b"\n", b"\r\n"))
    assert r["content"] == " P1 <b>P2</b>"
    assert r["attachments"][0]["content"] == b"hello" and r["attachments"][0]["size"] == 8


def test_attachment_name_fallbacks():
    r = parse(b"From: a@x.org\nContent-Type: multipart/mixed; boundary=Z\n\n"
              b"--Z\nContent-Type: application/pdf; name=\"by-type.pdf\"\n\nx\n"
              b"--Z\nContent-Type: text/plain\nContent-Disposition: attachment; "
              b"filename*=utf-8''na%C3%AFve.txt\n\ny\n--Z--\n")
    assert [a["name"] for a in r["attachments"]] == ["by-type.pdf", "naïve.txt"]
    assert r["content"] == ""


def test_message_rfc822_part_is_text_not_walked():
    r = parse(b"From: a@x.org\nContent-Type: multipart/mixed; boundary=Z\n\n"
              b"--Z\nContent-Type: message/rfc822\n\nFrom: b@y.org\nSubject: in\n\ninner body\n--Z--\n")
    assert "inner body" in r["content"] and r["attachments"] == []


def _parsed(raw: bytes):
    return E.parse_message("p", raw)


def test_lenient_address_lists():
    r = _parsed(b"From: a@x.org (Doe, John)\nTo: b@x.org (Doe, J), c@x.org\n\nx")
    assert r["error"] is None and r["owner"] == '"Doe, John" <a@x.org>'
    assert r["toRecipients"] == ['"Doe, J" <b@x.org>', "c@x.org"]


def test_headers_are_text_whatever_their_bytes():
    r = _parsed(b"From: a@x.org\nMessage-ID: <1\xe9@x>\n\nx")
    assert r["messageId"] == "<1\xe9@x>"
    folded = _parsed(b"From: a@x.org\nMessage-ID:\n <1@x>\n\nx")
    assert folded["messageId"] == "<1@x>"


def test_eight_bit_message_id_does_not_fail_the_job(spark):
    rows = [("a", bytearray(b"From: a@x.org\nMessage-ID: <\xff\xfe>\nSubject: \xff\n\nx")),
            ("b", bytearray(b'From: a@x.org\nContent-Type: text/plain; name="\xff.txt"\n\nx'))]
    got = E.parse_emails(spark.createDataFrame(rows, "path string, content binary")).collect()
    assert [r.error for r in got] == [None, None]


def test_nested_part_and_attached_message_keep_their_bytes():
    nested = b"--in\r\nContent-Type: text/plain\r\n\r\nx\r\n--in--"
    inner = b"From: z@x.org\n\ninner text"
    raw = (b'From: a@x.org\nContent-Type: multipart/mixed; boundary="B"\n\n'
           b'--B\nContent-Type: multipart/alternative; boundary="in"\n\n' + nested +
           b'\n--B\nContent-Type: message/rfc822\nContent-Disposition: attachment; filename="m.eml"\n\n' + inner +
           b"\n--B--\n")
    r = _parsed(raw)
    assert r["content"] == " " + nested.decode()
    assert [(a["content"], a["size"]) for a in r["attachments"]] == [(inner, len(inner))]


def test_unreadable_attachment_is_counted(monkeypatch):
    def fail(*_):
        raise ValueError
    monkeypatch.setattr(E, "_attachment", fail)
    r = _parsed(b'From: a@x.org\nContent-Type: text/plain; name="f.txt"\n\nx')
    assert (r["error"], r["attachments"], r["skippedAttachments"]) == (None, [], 1)


def test_walk_finds_every_name(spark, tmp_path):
    from tessera.sources.files import list_files_recursive, read_binary_files
    names = ["u/inbox/1.", "u/inbox/_2.", "u/_sent_mail/1.", "u/_sent_mail/2.", "u/.hid/1."]
    for n in names:
        f = tmp_path / n
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(n.encode())
    for root in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        got = {r.path: r.length for r in list_files_recursive(spark, root).collect()}
        assert got == {f"{tmp_path}/{n}": len(n) for n in names}
    read = {r.path: bytes(r.content) for r in read_binary_files(spark, str(tmp_path)).collect()}
    assert read == {f"{tmp_path}/{n}": n.encode() for n in names}


def test_bare_paths(spark):
    from pyspark.sql import functions as F

    from tessera.sources.files import bare_path
    for uri in ("/a/b", "file:/a/b", "file:///a/b", "hdfs://n:1/a/b", "s3://bucket/a/b"):
        assert spark.range(1).select(bare_path(F.lit(uri))).first()[0] == "/a/b"


def test_building_a_parse_plan_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    try:
        files = spark.range(100).selectExpr("cast(id as string) as path", "cast('x' as binary) as content")
        E.dedup_messages(E.messages(E.parse_emails(files.repartition(3))))
        E.ingest_stats(E.parse_emails(files.repartition(3)))
        E.rejects(E.parse_emails(files.repartition(3)))
        assert list(tracker.getJobIdsForGroup("plan-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
