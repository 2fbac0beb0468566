import pathlib

import pytest
from pyspark.sql import functions as F

from tablekeeper.functions import paths, predicates
from tablekeeper.session import checkpoint_dir, scratch_path
from tablekeeper.sources import files, jdbc, listing
from tests.conftest import ids, table


def test_views(spark, staff, tmp_path):
    path = str(tmp_path / "p")
    staff.write.parquet(path)
    assert files.read_parquet(spark, path, view="people").count() == 8
    assert "people" in files.list_views(spark)
    assert files.query_view(spark, "people").count() == 8
    assert files.query_view(spark, "people", "SELECT max(salary) AS m FROM people").first().m == 99000
    assert files.view_schema(spark, "people") == staff.schema
    assert files.drop_view(spark, "people") is True and files.drop_view(spark, "people") is False
    facts = files.file_facts(spark, path)
    assert facts["rows"] == 8 and facts["schema"] == staff.schema and facts["files"] >= 1
    assert table(files.distinct_sorted(staff, "level")) == [("Junior",), ("Senior",)]


def test_merge_schema_and_globs(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a1")
    spark.range(3, 5).withColumn("extra", F.lit("x")).write.parquet(f"{tmp_path}/a2")
    merged = files.read_parquet(spark, f"{tmp_path}/a*", mergeSchema=True)
    assert set(merged.columns) == {"id", "extra"} and merged.filter("extra is null").count() == 3
    assert files.read_parquet(spark, [f"{tmp_path}/a1", f"{tmp_path}/a2"]).count() == 5


def test_writers(spark, staff, tmp_path):
    files.write_parquet(staff, f"{tmp_path}/w", partition_by=["active"])
    assert (tmp_path / "w" / "active=true").exists()
    assert spark.read.parquet(f"{tmp_path}/w").filter("active = 'true'").count() == 5
    staff.drop("active").write.option("header", True).csv(f"{tmp_path}/c")
    back = files.read_csv(spark, f"{tmp_path}/c", staff.drop("active").schema)
    assert table(back) == table(staff.drop("active"))


def test_catalog_table(spark, staff):
    name = "kept_staff"
    files.save_table(staff.limit(3), name)
    files.save_table(staff, name)
    assert spark.table(name).count() == 8
    spark.sql(f"DROP TABLE {name}")


def test_json_items_to_flat_rows(rows):
    text = rows("t string", [('{"name": "s1", "target": {"kind": "lake", "at": {"path": "/a"}}, "tags": [1]}',), ("{}",)])
    schema = "name string, target struct<kind: string, at: struct<path: string>>, tags array<int>"
    flat = files.flatten(text.select(files.parse_json(F.col("t"), schema).alias("j")).select("j.*"))
    assert flat.columns == ["name", "target_kind", "target_at_path", "tags"]
    assert table(flat.drop("tags")) == sorted([("s1", "lake", "/a"), (None, None, None)], key=repr)


def test_union_needs_equal_types(rows):
    a, b = rows("id string, n int", [("1", 1)]), rows("id string, extra string", [("2", "x")])
    both = files.union_all_by_name([a, b], [{"place": "p"}, {"place": "q"}])
    assert table(both.select("id", "n", "extra", "place")) == sorted([("1", 1, None, "p"), ("2", None, "x", "q")], key=repr)
    with pytest.raises(TypeError, match="column id"):
        files.union_all_by_name([a, rows("id bigint", [(3,)])])
    with pytest.raises(ValueError):
        files.union_all_by_name([])


def test_id_range(spark):
    assert ids(files.id_range(spark, 1, 4, "key"), "key") == [1, 2, 3]


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "store"
    for name, size in (("box/a/x.pdf", 1_500_000), ("box/y.txt", 10), ("bin/z.pdf", 0)):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x" * size)
    return root


def test_listing(spark, folder, rows, tmp_path):
    found = listing.list_files(spark, str(folder))
    assert table(found.select("container", "name", "size", "size_mb")) == [
        ("bin", "z.pdf", 0, 0.0), ("box", "a/x.pdf", 1_500_000, 1.43), ("box", "y.txt", 10, 0.0),
    ]
    assert found.filter("last_modified IS NULL").isEmpty()
    assert table(listing.list_files(spark, "file://" + str(folder)).select("size")) == [(0,), (10,), (1_500_000,)]
    assert listing.list_files(spark, str(folder), prefix="a/").count() == 1
    assert listing.list_files(spark, str(folder), glob="*.pdf").count() == 2
    allowed, missing = listing.allow_containers(found, rows("container string", [("box",), ("lost",)]))
    assert allowed.count() == 2 and table(missing) == [("lost",)]
    summary = {r.container: (r.files, r.bytes, r.mb, r.rounded_mb) for r in listing.inventory_summary(found).collect()}
    assert summary == {"box": (2, 1_500_010, 1.43, 1.43), "bin": (1, 0, 0.0, 0.0)}
    listing.export_csv(found, f"{tmp_path}/csv")
    exported = spark.read.option("header", True).csv(f"{tmp_path}/csv")
    assert exported.columns == list(listing.EXPORT_COLUMNS) and exported.count() == 3
    assert exported.first().last_modified[10] == "T"


def test_match_lists(spark, folder, tmp_path):
    found = listing.list_files(spark, str(folder))
    listing.write_matches(found, f"{tmp_path}/m")
    back = listing.read_matches(spark, f"{tmp_path}/m")
    assert table(back) == [("bin", "z.pdf"), ("box", "a/x.pdf"), ("box", "y.txt")]
    line = spark.read.text(f"{tmp_path}/m").filter("value like 'bin%'").first().value
    assert line.startswith("bin/z.pdf\t20") and line.endswith(" UTC")
    (tmp_path / "plain.txt").write_text("c1/d/e.pdf\n\nc2\n")
    assert table(listing.read_matches(spark, f"{tmp_path}/plain.txt")) == [("c1", "d/e.pdf"), ("c2", "")]


def test_metadata_flags(rows):
    data = rows(
        "i int, m map<string,string>",
        [
            (1, [("delete", "1")]), (2, [("DELETE", " 1\t")]), (3, [("delete", "0"), ("Delete", "1")]),
            (4, [("delete", "11")]), (5, []), (6, None), (7, [("del", "1")]), (8, [("delete", None)]),
        ],
    )
    assert ids(listing.flagged_for_deletion(data, "m"), "i") == [1, 2, 3]


def test_path_functions(rows):
    data = rows("p string", [("a/b.c",), (r"d:\e\f.g",), ("plain",), ("dir/",), ("",), (None,)])
    container, prefix = paths.split_container(F.col("p"))
    got = data.select("p", paths.base_name(F.col("p")), container, prefix)
    assert table(got) == sorted(
        [("a/b.c", "b.c", "a", "b.c"), (r"d:\e\f.g", "f.g", r"d:\e\f.g", ""), ("plain", "plain", "plain", ""),
         ("dir/", "", "dir", ""), ("", "", "", ""), (None, "", None, "")], key=repr)
    same = paths.split_container(F.col("p"), F.lit("given"))
    assert data.select(*same).first()[:] == ("a/b.c", "given")
    sizes = rows("n bigint", [(None,), (0,), (1_572_864,)]).select(paths.to_mb(F.col("n")))
    assert table(sizes) == [(0.0,), (0.0,), (1.5,)]
    assert rows("t timestamp_ntz", [(None,)]).select(paths.time_text(F.col("t"))).first()[0] == "unknown"


def test_text_match_is_literal_by_default(rows):
    data = rows("s string", [("a.b",), ("aXb",), (None,)])
    assert data.filter(predicates.text_match("s", "A.B")).count() == 1
    assert data.filter(predicates.text_match("s", "A.B", regex=True)).count() == 2


def test_scratch_folder(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(checkpoint_dir(spark).rstrip("/"))


class Connection:
    """Stands in for a DB-API connection: notes what it is asked to do in one file per connection."""

    def __init__(self, folder, fail=False):
        import tempfile

        self.lines, self.fail = [], fail
        self.file = tempfile.mktemp(dir=folder)

    def cursor(self):
        return self

    def execute(self, sql, values):
        if self.fail:
            raise RuntimeError("refused")
        self.lines.append(f"{sql} <- {values}")

    def commit(self):
        self.lines.append("commit")

    def rollback(self):
        self.lines.append("rollback")

    def close(self):
        pathlib.Path(self.file).write_text("\n".join(self.lines))


def test_database_delete_binds_and_commits_per_chunk(spark, rows, tmp_path):
    folder = str(tmp_path)
    keys = spark.range(25).unionAll(spark.range(25)).selectExpr("id", "if(id = 7, null, id) AS k")
    jdbc.delete_keys(keys, lambda: Connection(folder), "t", ["k"], connections=3, chunk=4)
    logs = [f.read_text().splitlines() for f in tmp_path.iterdir()]
    deletes = [line for log in logs for line in log if line.startswith("DELETE")]
    values = [v for line in deletes for v in eval(line.split(" <- ")[1])]
    assert sorted(values) == [i for i in range(25) if i != 7] and len(logs) <= 3
    assert all(len(eval(d.split(" <- ")[1])) <= 4 for d in deletes)
    assert all(a.startswith("DELETE") and b == "commit" for log in logs for a, b in zip(log[::2], log[1::2]))


def test_database_delete_failure_is_raised(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(Exception, match="refused"):
        jdbc.delete_keys(spark.range(3), lambda: Connection(folder, fail=True), "t", ["id"])


def test_statements():
    assert jdbc.statement("t", ["a"], 3) == "DELETE FROM t WHERE a IN (?, ?, ?)"
    assert jdbc.statement("t", ["a", "b"], 2, "%s") == "DELETE FROM t WHERE (a = %s AND b = %s) OR (a = %s AND b = %s)"
    assert jdbc.statement("t", ["a"], 1, scope="live = 0") == "DELETE FROM t WHERE (a IN (?)) AND (live = 0)"
    assert jdbc.staged_delete_statement("t", "s", ["a", "b"]) == (
        "DELETE FROM t WHERE EXISTS (SELECT 1 FROM s WHERE s.a = t.a AND s.b = t.b)"
    )
