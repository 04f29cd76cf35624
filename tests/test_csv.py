import pytest

from strandweave import SegmentStore
from strandweave.sources.csv import header_schema, read_csv, read_staging, stage_csv


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, content in files.items():
        (folder / f"{name}.csv").write_bytes(content.encode())
    return str(folder)


def test_header_names_are_stripped(spark, tmp_path):
    path = write(tmp_path / "in", a='uuid, Name ,"x,y"\n1,2,3\n')
    assert header_schema(spark, path).names == ["uuid", "Name", "x,y"]
    with pytest.raises(ValueError, match="distinct"):
        header_schema(spark, write(tmp_path / "bad", a="u, u\n1,2\n"))
    with pytest.raises(ValueError, match="no header"):
        header_schema(spark, write(tmp_path / "empty", a=""))


def test_fields(spark, tmp_path):
    content = 'k,v,w\n1,"",\n2,"say ""hi"", you","two\nlines"\n3, kept ,é\n'
    rows = read_csv(spark, write(tmp_path / "in", a=content)).orderBy("k").collect()
    assert [tuple(row) for row in rows] == [
        ("1", "", None),
        ("2", 'say "hi", you', "two\nlines"),
        ("3", " kept ", "é"),
    ]


@pytest.mark.parametrize("record", ["1", "1,2,3"])
def test_wrong_width_fails(spark, tmp_path, workspace, record):
    path = write(tmp_path / "in", a=f"k,v\n0,0\n{record}\n")
    store = SegmentStore(spark, workspace.folder("staging"))
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        stage_csv(spark, path, store)
    assert store.manifest() is None


def test_ordinals_follow_files_and_lines(spark, tmp_path, workspace):
    # The largest file comes first in a scan; order must come from the names and the lines.
    files = {"a": 3, "b": 500, "c": 1, "d": 40}
    contents = {name: "k,v\n" + "".join(f"{name}{i},x\n" for i in range(count)) for name, count in files.items()}
    path = write(tmp_path / "in", **contents)
    store = SegmentStore(spark, workspace.folder("staging"))
    for multi_line in (True, False):
        rows = stage_csv(spark, path, store, multi_line=multi_line).orderBy("row_ord").collect()
        assert [row.row_ord for row in rows] == list(range(544))
        assert [row.k for row in rows] == [f"{name}{i}" for name, count in files.items() for i in range(count)]


def test_split_files(spark, tmp_path, workspace):
    """One file read as many splits still gets the ordinals of its lines."""
    path = write(tmp_path / "in", a="k,v\n" + "".join(f"{i},{'x' * (i % 7)}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert read_csv(spark, path, multi_line=False).rdd.getNumPartitions() > 3
        staged = stage_csv(spark, path, SegmentStore(spark, workspace.folder("staging")), multi_line=False)
        assert [(r.row_ord, r.k) for r in staged.orderBy("row_ord").collect()] == [(i, str(i)) for i in range(5000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_headers_of_all_files_must_agree(spark, tmp_path, workspace):
    path = write(tmp_path / "in", a="x,y\n1,2\n", b="y,x\n10,20\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        stage_csv(spark, path, SegmentStore(spark, workspace.folder("staging")))


def test_staging_is_read_by_a_plain_scan(spark, tmp_path, workspace):
    path = write(tmp_path / "in", **{f"f{i}": f" k , v\n{i},x\n" for i in range(30)})
    store = SegmentStore(spark, workspace.folder("staging"))
    plan = stage_csv(spark, path, store)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert [row.k for row in read_staging(store).orderBy("row_ord").collect()] == [str(i) for i in sorted(range(30), key=str)]
    assert read_staging(store).columns == ["row_ord", "k", "v"]


def test_staging_is_replaced(spark, tmp_path, workspace):
    store = SegmentStore(spark, workspace.folder("staging"))
    stage_csv(spark, write(tmp_path / "one", a="k,v\n1,2\n"), store)
    stage_csv(spark, write(tmp_path / "two", a="k,other\n3,\n"), store)
    assert [tuple(row) for row in read_staging(store).collect()] == [(0, "3", None)]
    assert read_staging(store).columns == ["row_ord", "k", "other"]
