import glob
import os
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException

from tessera.sinks import writers as W
from tessera.sources import delimited as D
from tessera.sources.files import inline_source, list_files_recursive
from tessera.session import checkpoint_root, scratch_path
from support import rows


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_strict_ratings_reader(spark):
    d = tempfile.mkdtemp()
    _write(f"{d}/ok/u.data", "1\t10\t4.0\t881250949\n2\t11\t3\t881250950\n")
    assert rows(D.read_ratings_strict(spark, f"{d}/ok")) == [(1, 10, 4.0), (2, 11, 3.0)]
    _write(f"{d}/bad/u.data", "1\t10\tx\t0\n")
    with pytest.raises(Exception):
        D.read_ratings_strict(spark, f"{d}/bad").collect()
    for bad in ("1\t10\tx\t0\n", "1\t10\n", " 1\t10\t4\n", "1\t10\t\n"):
        _write(f"{d}/bad/u.data", "2\t11\t3\t0\n" + bad)
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            try:
                with pytest.raises(Exception, match="malformed rating line"):
                    D.read_ratings_strict(spark, f"{d}/bad").count()
                with pytest.raises(Exception, match="malformed rating line"):
                    D.read_ratings_strict(spark, f"{d}/bad").select("movieid").collect()
            finally:
                spark.conf.unset("spark.sql.ansi.enabled")
    _write(f"{d}/short/u.data", "1\t10\n")
    with pytest.raises(Exception):
        D.read_ratings_strict(spark, f"{d}/short").collect()


def test_permissive_reader_nulls_bad_fields(spark):
    d = tempfile.mkdtemp()
    _write(f"{d}/r/u.data", "1\t10\t4.0\t881250949\nx\t11\tbad\t5\n")
    got = rows(D.read_delimited(spark, f"{d}/r", D.RATING_SCHEMA, "\t"))
    assert got == [(None, 11, None, 5), (1, 10, 4.0, 881250949)]
    flags = "|".join(["true", "0", "FALSE"] + ["1"] * 14)
    _write(f"{d}/m/u.item", f"7|Toy Story|01-Jan-1995||http://x|{flags}\n")
    m = D.read_delimited(spark, f"{d}/m", D.MOVIE_SCHEMA, "|").first()
    assert (m.movieID, m.movieName, m.release_date, m.video_release_date) == (7, "Toy Story", None, None)
    assert (m.type_unknown, m.type_Action, m.type_Adventure, m.type_Animation) == (True, None, False, None)


def test_external_table_sees_new_files(spark):
    d = tempfile.mkdtemp()
    _write(f"{d}/part-0", "1,2,0.5\n")
    t = D.register_external_table(spark, "sim_ext_test", d, D.SIMILARITY_SCHEMA, ",")
    assert rows(t) == [(1, 2, 0.5)]
    _write(f"{d}/part-1", "3,4,0.8660254037844387\n")
    spark.catalog.refreshTable("sim_ext_test")
    got = rows(spark.table("sim_ext_test"))
    assert got[1][:2] == (3, 4) and abs(got[1][2] - 0.8660254) < 1e-6


def test_external_table_has_its_own_name_and_is_dropped(spark):
    d = tempfile.mkdtemp()
    _write(f"{d}/part-0", "1,2,0.5\n")
    before = {t.name for t in spark.catalog.listTables()}
    with D.external_table(spark, d, D.SIMILARITY_SCHEMA, ",") as one, \
            D.external_table(spark, d, D.SIMILARITY_SCHEMA, ",") as two:
        assert len({t.name for t in spark.catalog.listTables()} - before) == 2
    assert {t.name for t in spark.catalog.listTables()} == before
    assert rows(one) == rows(two) == [(1, 2, 0.5)] and os.path.exists(f"{d}/part-0")


def test_load_moves_the_files(spark):
    d = tempfile.mkdtemp()
    _write(f"{d}/old/a", "1\t1\t1.0\t1\n")
    _write(f"{d}/new/b", "2\t3\t4.0\t5\nbad\t3\t4.0\t5\n")
    _write(f"{d}/one.tsv", "7\t8\t1.5\t9\n")
    assert rows(D.load_overwrite(spark, f"{d}/old", D.RATING_SCHEMA, "\t", f"{d}/t/r")) == [(1, 1, 1.0, 1)]
    inode = os.stat(f"{d}/new/b").st_ino
    got = D.load_overwrite(spark, f"{d}/new", D.RATING_SCHEMA, "\t", f"{d}/t/r")
    assert rows(got) == [(None, 3, 4.0, 5), (2, 3, 4.0, 5)]
    assert not os.path.exists(f"{d}/new") and os.stat(f"{d}/t/r/b").st_ino == inode  # the same file, moved
    assert rows(D.load_overwrite(spark, f"{d}/one.tsv", D.RATING_SCHEMA, "\t", f"{d}/t/r")) == [(7, 8, 1.5, 9)]
    assert sorted(os.listdir(f"{d}/t")) == ["r"] and sorted(os.listdir(d)) == ["t"]


def test_failed_load_keeps_the_old_contents(spark, monkeypatch):
    d = tempfile.mkdtemp()
    _write(f"{d}/old/a", "1\t1\t1.0\t1\n")
    table = D.load_overwrite(spark, f"{d}/old", D.RATING_SCHEMA, "\t", f"{d}/t")
    with pytest.raises(FileNotFoundError):
        D.load_overwrite(spark, f"{d}/none", D.RATING_SCHEMA, "\t", f"{d}/t")
    os.makedirs(f"{d}/t/inner")
    with pytest.raises(Exception):  # a folder cannot be moved into itself: the move fails half-way
        D.move_overwrite(spark, f"{d}/t/inner", f"{d}/t")
    assert os.path.isdir(f"{d}/t/inner") and sorted(os.listdir(d)) == ["t"]
    os.rmdir(f"{d}/t/inner")
    assert rows(table) == [(1, 1, 1.0, 1)]


def test_codec_mapping_and_footer(spark):
    assert W.parquet_codec("GZIP") == "gzip" and W.parquet_codec("SNAPPY") == "snappy"
    assert W.parquet_codec("gzip") == "uncompressed" and W.parquet_codec(None) == "uncompressed"
    p = scratch_path(spark, "codec")
    W.write_parquet(spark.range(100), p, codec="GZIP")
    f = glob.glob(f"{p}/*.parquet")[0]
    assert pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "GZIP"


def test_write_modes(spark):
    p = scratch_path(spark, "modes")
    W.write_parquet(spark.range(3), p)
    with pytest.raises(AnalysisException):
        W.write_parquet(spark.range(5), p, mode="errorifexists")
    W.write_parquet(spark.range(5), p, mode="overwrite")
    assert spark.read.parquet(p).count() == 5
    W.write_parquet(spark.range(2), p, mode="append")
    assert spark.read.parquet(p).count() == 7


def test_text_and_delimited_sinks(spark):
    p = scratch_path(spark, "txt")
    df = spark.createDataFrame([(1, 2, 1e-5)], "a bigint, b bigint, c double")
    W.write_delimited(df, p)
    assert [r.value for r in spark.read.text(p).collect()] == ["1,2,1.0E-5"]


def test_pairs_roundtrip(spark):
    p = scratch_path(spark, "seq")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    W.write_pairs(df, p, "k", "v")
    assert rows(W.read_pairs(spark, p, "k bigint, v string")) == [(1, "a"), (2, "b")]


def test_inline_source_partitions(spark):
    df = inline_source(spark, [(i * 10,) for i in range(1, 7)], "x int", num_slices=3)
    assert df.rdd.getNumPartitions() == 3 and sorted(r.x for r in df.collect()) == [10, 20, 30, 40, 50, 60]


def test_recursive_listing(spark):
    d = tempfile.mkdtemp()
    for rel in ["a.eml", "x/b.eml", "x/y/z/c.eml"]:
        _write(f"{d}/{rel}", "From: a@b\n\nhi")
    got = sorted(os.path.relpath(r.path, d) for r in list_files_recursive(spark, d).collect())
    assert got == ["a.eml", "x/b.eml", "x/y/z/c.eml"]


def test_checkpoint_root_is_reused(spark):
    assert checkpoint_root(spark) == checkpoint_root(spark)
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_text_table_rules(spark):
    d = tempfile.mkdtemp()
    _write(f"{d}/u.user", "1|\\N||x|99999\n\n2| 3|M||\n")
    got = sorted((tuple(r) for r in D.read_delimited(spark, d, D.USER_SCHEMA, "|").collect()), key=str)
    assert got == [(1, None, "", "x", "99999"), (2, None, "M", "", ""), (None,) * 5]


def test_row_groups_follow_the_block_size(spark):
    p = scratch_path(spark, "row-groups")
    df = spark.range(0, 400_000, 1, 1).selectExpr("id", "sha2(cast(id as string), 256) as a", "uuid() as b")
    W.write_parquet(df, p, block_size=4 << 20)
    meta = pq.ParquetFile(glob.glob(f"{p}/*.parquet")[0]).metadata
    sizes = [meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)]
    assert len(sizes) > 3 and max(sizes) < 8 << 20
