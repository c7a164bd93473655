"""Listing of folder trees by Spark jobs, and scans of what was listed."""

from collections import Counter

import pytest

from lidarframe import list_las, read_las, read_listed, refresh_header_index, write_las
from lidarframe.sources.files import list_files, partition_fields


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tree") / "las")
    points = spark.range(400).selectExpr(
        "cast(id as double) as x", "cast(id % 9 as double) as y", "0D as z", "cast(id % 5 as byte) as classification",
        "cast(id % 4 as int) as day", "if(id % 7 = 0, null, concat('n=', id % 2)) as name", "cast(id % 2 + 0.5 as string) as part",
    )
    write_las(points, path, partition_by=["day", "name", "part"])
    return path


def fresh(tmp_path, count=iter(range(10**6))):
    return str(tmp_path / f"listing-{next(count)}")


def as_set(listing):
    return Counter((r.path, r.file_length, r.modified_ns, tuple(sorted(r["keys"].items(), key=str))) for r in listing.files.collect())


def plain(path, **options):
    found = list_files({"path": path, **options})
    return Counter((f.name, f.size, f.mtime_ns, tuple(sorted(f.keys, key=str))) for f in found)


@pytest.mark.parametrize("options", [{}, {"pathGlobFilter": "*.las"}, {"pathGlobFilter": "nothing"}])
def test_listing_like_the_plain_one(spark, tree, tmp_path, options):
    listing = list_las(spark, tree, fresh(tmp_path), **options)
    assert as_set(listing) == plain(tree, **options)
    if listing.files.count():
        assert [(f.name, f.dataType) for f in listing.fields] == [(f.name, f.dataType) for f in partition_fields({"path": tree, **options})]


def test_wildcards_single_files_and_base_path(spark, tree, tmp_path):
    for path, options in ((f"{tree}/day=[12]", {"basePath": tree}), (f"{tree}/day=3/*", {}), (list_files({"path": tree})[0].path, {"basePath": tree})):
        assert as_set(list_las(spark, path, fresh(tmp_path), **options)) == plain(path, **options)
    with pytest.raises(FileNotFoundError):
        list_las(spark, f"{tree}/none", fresh(tmp_path))


@pytest.mark.parametrize(
    "where",
    [None, "day = 2", "day >= 2 and name is null", "name like 'n=%' and x < 100", "part > 1 or day = 0", "classification = 1 and y > 3", "_path like '%day=1%'"],
)
def test_scan_like_the_plain_one(spark, tree, tmp_path, where):
    listing = list_las(spark, tree, fresh(tmp_path))
    columns = ["name", "x", "classification", "day", "part"]
    found = read_listed(spark, listing, columns, where=where, split_bytes=500)
    want = read_las(spark, tree, columns, where=where)
    assert found.dtypes == want.dtypes
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, want.collect()))


def test_default_columns_and_bounds(spark, tree, tmp_path):
    listing = list_las(spark, tree, fresh(tmp_path))
    assert read_listed(spark, listing).dtypes == read_las(spark, tree).dtypes
    assert read_listed(spark, listing, ["x"], where="x > 390", trustBounds=True).count() == 9
    with pytest.raises(ValueError, match="neither"):
        read_listed(spark, listing, ["nope"])


def test_folders_ruled_out_are_not_opened(spark, tree, tmp_path):
    listing = list_las(spark, tree, fresh(tmp_path))
    files = listing.files.selectExpr("*")
    spoiled = files.selectExpr("path", "file_length", "modified_ns", "root", "if(keys['day'] = '1', inner, '/gone') as inner", "keys")
    spoiled = type(listing)(spoiled, listing.fields)
    assert read_listed(spark, spoiled, ["x"], where="day + 0 = 1 and x >= 0").count() == 100


def test_index_from_a_listing(spark, tree, tmp_path):
    listing = list_las(spark, tree, fresh(tmp_path))
    index = refresh_header_index(spark, tree, str(tmp_path / "index"), listing)
    assert index.count() == listing.files.count() and index.agg({"point_count": "sum"}).first()[0] == 400


def test_ten_thousand_folders_are_listed_once_each(spark, tmp_path):
    for a in range(100):
        for b in range(99):
            (tmp_path / "in" / f"a={a}" / f"b={b}").mkdir(parents=True)
    for a in (0, 50, 99):
        (tmp_path / "in" / f"a={a}" / "b=7" / "x.las").write_bytes(b"-")
        (tmp_path / "in" / f"a={a}" / "_b" / "c").mkdir(parents=True)
    scratch = tmp_path / "listing"
    listing = list_las(spark, str(tmp_path / "in"), str(scratch))
    levels = [spark.read.parquet(str(p)).where("folder") for p in sorted(scratch.glob("level-*"))]
    listed = [r.inner for level in levels for r in level.collect()]
    assert len(listed) == len(set(listed)) == 1 + 100 + 9900
    assert listing.files.count() == 3 and [f.name for f in listing.fields] == ["a", "b"]


def test_listing_of_nothing(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    listing = list_las(spark, str(tmp_path / "empty"), fresh(tmp_path))
    assert listing.fields == [] and read_listed(spark, listing).count() == 0


def test_listing_while_a_write_is_published(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    points = spark.range(10).selectExpr("cast(id as double) as x", "0D as y", "0D as z", "cast(id % 2 as int) as k")
    write_las(points, path, partition_by=["k"])
    with monkeypatch.context() as m:
        m.setattr("lidarframe.operators.tables.publish_las", lambda *a: 0)
        write_las(points.withColumn("x", points.x + 50), path, "overwrite", partition_by=["k"])
    found = read_listed(spark, list_las(spark, path, fresh(tmp_path)), ["x", "k"]).collect()
    assert sorted((int(r.x), r.k) for r in found) == [(50 + k, k % 2) for k in range(10)]
