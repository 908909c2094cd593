"""The lazy file tree: any name, linked loops, packs of equal bytes, no job while a plan is built."""
import os

import pytest

from tessera.session import checkpoint_root
from tessera.sources import files as T
from support import rows


def jobs(spark, group):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.fixture()
def tree(tmp_path):
    for name, n in [("a.eml", 3), ("_x/b.eml", 5), ("_x/.y/c", 0), ("d/e/f/g/h/i/j/deep.txt", 7), ("d/_hidden", 1)]:
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"z" * n)
    (tmp_path / "empty").mkdir()
    return tmp_path


def listing(tree):
    return sorted((os.path.join(d, f), os.path.getsize(os.path.join(d, f))) for d, _, fs in os.walk(tree) for f in fs)


@pytest.mark.parametrize("folders", [1, 3, 256])
def test_every_file_whatever_its_name(spark, tree, folders, monkeypatch):
    monkeypatch.setattr(T, "FOLDERS", folders)
    for root in (str(tree), f"file:{tree}"):
        assert rows(T.list_files_recursive(spark, root)) == listing(tree)
    read = T.read_binary_files(spark, str(tree)).collect()
    assert sorted((r.path, bytes(r.content)) for r in read) == [(p, b"z" * n) for p, n in listing(tree)]
    assert all(r.modificationTime is not None and r.length == len(r.content) for r in read)


def test_building_a_plan_runs_no_job_and_leaves_no_folder(spark, tree):
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    spark.sparkContext.setJobGroup("plan-tree", "")
    try:
        listed, read = T.list_files_recursive(spark, str(tree)), T.read_binary_files(spark, str(tree))
        assert jobs(spark, "plan-tree") == 0
        assert listed.count() == read.count() == 5 and jobs(spark, "plan-tree") > 0
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before


def test_a_linked_loop_ends_and_a_linked_folder_is_listed(spark, tree):
    plain = [p for p, _ in listing(tree)]
    os.symlink(tree, tree / "_x" / "back")          # to a folder above
    os.symlink(tree / "_x" / "me", tree / "_x" / "me")  # to itself: no folder at all
    os.symlink(tree / "d" / "e", tree / "beside")   # to another folder
    got = [p for p, _ in rows(T.list_files_recursive(spark, str(tree)))]
    assert sorted(got) == sorted(plain + [str(tree / "beside/f/g/h/i/j/deep.txt")])


def test_a_missing_folder_fails_when_read(spark, tmp_path):
    with pytest.raises(Exception, match="No such file|does not exist|Cannot"):
        T.list_files_recursive(spark, str(tmp_path / "none")).collect()


def test_one_large_and_many_tiny_files_are_dealt_by_bytes(spark):
    sizes = [100] * 5000 + [1_000_000] + [100] * 5000
    listed = spark.createDataFrame([(f"/f{i}", None, n) for i, n in enumerate(sizes)], T.LISTED).coalesce(1)
    dealt = T.packs(listed, pack_bytes=10_000, pack_files=64)
    assert dealt.selectExpr("explode(files) f").select("f.path").distinct().count() == len(sizes)
    each = [(r.n, r.b) for r in dealt.selectExpr(
        "size(files) n", "aggregate(files, 0L, (x, f) -> x + f.length) b").collect()]
    assert (1, 1_000_000) in each and max(n for n, _ in each) <= 64
    assert sorted(b for _, b in each)[-2] <= 10_000
    tasks = [r.b for r in dealt.selectExpr("spark_partition_id() p", "aggregate(files, 0L, (x, f) -> x + f.length) b")
             .where("b < 1000000").groupBy("p").sum("b").withColumnRenamed("sum(b)", "b").collect()]
    assert len(tasks) == 8 and max(tasks) <= 1.3 * sum(tasks) / len(tasks)


def test_packs_of_nothing_and_of_empty_files(spark):
    none = spark.createDataFrame([], T.LISTED)
    assert T.packs(none).count() == 0
    empty = spark.createDataFrame([(f"/f{i}", None, 0) for i in range(200)], T.LISTED).coalesce(1)
    assert sorted(r.n for r in T.packs(empty, pack_files=64).selectExpr("size(files) n").collect()) == [8, 64, 64, 64]


def test_small_contents_are_handed_on_together(tmp_path):
    import pyarrow as pa

    from tessera.sources import files as T
    sizes = [10, 0, T.BATCH_BYTES + 5, 20, 30]
    listed = []
    for i, n in enumerate(sizes):
        (tmp_path / f"_{i}").write_bytes(b"x" * n)
        listed.append({"path": ("file://" if i == 3 else "") + str(tmp_path / f"_{i}"), "modificationTime": None, "length": n})
    out = list(T._read_contents(iter([pa.RecordBatch.from_pylist([{"files": listed}])])))
    assert [b.num_rows for b in out] == [2, 1, 2]
    assert [len(c.as_py()) for b in out for c in b.column("content")] == sizes
    assert [p.as_py() for b in out for p in b.column("path")] == [r["path"] for r in listed]
