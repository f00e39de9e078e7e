import zipfile

import pytest
from pyspark.sql import types as T

from keelson.presets import CSV_NULL_TOKENS
from keelson.sources import csv as C
from keelson.sources import tables as S
from keelson.spec import ContractError

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("age", T.DoubleType()), T.StructField("note", T.StringType())])


def archive(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_archives(spark, tmp_path):
    archive(tmp_path / "a.zip", {"d/raw.csv": 'k,age,note\n1,25,"two\nlines"\n2,30,NA\n', "__MACOSX/raw.csv": "junk"})
    archive(tmp_path / "b.zip", {"x.CSV": "k,age,note\n3,abc,\n"})
    df = C.read_archives(spark, str(tmp_path), SCHEMA, CSV_NULL_TOKENS)
    rows = {r["k"]: r for r in C.require_archives(df).collect()}
    assert rows[1]["note"] == "two\nlines" and rows[1]["age"] == 25.0 and rows[1]["_line"] == 0
    assert rows[2]["note"] is None and rows[3]["age"] is None and rows[3]["note"] is None and rows[2]["_source"].endswith("a.zip")


@pytest.mark.parametrize("members, problem", [
    ({"a.csv": "k\n1\n", "b.csv": "k\n1\n"}, "found 2"), ({"readme.txt": "x"}, "found 0"), ({"a.csv": "k,age\n1,2\n"}, "note")])
def test_bad_archives_are_reported(spark, tmp_path, members, problem):
    archive(tmp_path / "good.zip", {"a.csv": "k,age,note\n1,2,x\n"})
    archive(tmp_path / "bad.zip", members)
    df = C.read_archives(spark, str(tmp_path), SCHEMA)
    assert df.where("_error is null").count() == 1
    with pytest.raises(ContractError, match=problem):
        C.require_archives(df)


def test_not_an_archive(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(b"plain text")
    with pytest.raises(ContractError, match="not a zip"):
        C.require_archives(C.read_archives(spark, str(tmp_path), SCHEMA))


def test_every_failure_is_one_error_row(spark, tmp_path):
    archive(tmp_path / "late.zip", {"a.csv": b"k,age,note\n" + b"1,2,x\n" * 50 + b"2,3,\xff\xfe\n"})
    archive(tmp_path / "ragged.zip", {"a.csv": "k,age,note\n1,2,x\n1,2,x,y,z\n"})
    archive(tmp_path / "empty.zip", {"a.csv": ""})
    archive(tmp_path / "long.zip", {"a.csv": "k,age,note\n7,1," + "y" * 3_000_000 + "\n8,1,z\n"})
    (tmp_path / "cut.zip").write_bytes((tmp_path / "long.zip").read_bytes()[:500])
    rows = C.read_archives(spark, str(tmp_path), SCHEMA).collect()
    assert sorted(r["_source"].split("/")[-1] for r in rows if r["_error"]) == ["cut.zip", "empty.zip", "late.zip", "ragged.zip"]
    assert {r["k"]: len(r["note"]) for r in rows if not r["_error"]} == {7: 3_000_000, 8: 1}


def test_csv_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,age,note\n1, 25 ,"say ""hi"", now"\n2,null,N/A\nx,1e1,ok\n')
    (tmp_path / "b.csv").write_text("k,age,note\n4,1,None\n")
    got = {r["k"]: (r["age"], r["note"]) for r in C.read_csv(spark, str(tmp_path), SCHEMA, CSV_NULL_TOKENS).collect()}
    assert got == {1: (25.0, 'say "hi", now'), 2: (None, None), None: (10.0, "ok"), 4: (1.0, None)}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("extra,note,age,k\nz,n,2.5,1\n")
    assert [tuple(r) for r in C.read_csv(spark, str(tmp_path), SCHEMA).collect()] == [(1, 2.5, "n")]
    with pytest.raises(ContractError, match="height"):
        C.read_csv(spark, str(tmp_path), T.StructType([*SCHEMA.fields, T.StructField("height", T.DoubleType())]))


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,age,note\n1,2,"two\nlines"\n')
    assert C.read_csv(spark, str(tmp_path), SCHEMA, multi_line=True).first()["note"] == "two\nlines"


def test_bad_lines_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,age,note\n1,2,x\n1,2,x,y,z\n")
    df = C.read_csv(spark, str(tmp_path), SCHEMA, keep_bad=True).cache()
    assert df.where("_bad is not null").count() == 1


def test_empty_input(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,age,note\n")
    with pytest.raises(ContractError, match="no rows"):
        C.require_rows(C.read_csv(spark, str(tmp_path), SCHEMA))
    with pytest.raises(ContractError, match="no columns"):
        C.require_rows(spark.range(1).select())


def test_tables_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(i % 3, float(i), f"v{i}") for i in range(50)], "k long, x double, s string")
    S.write_table(df, str(tmp_path / "t"), "k", "x")
    assert S.read_table(spark, str(tmp_path / "t")).exceptAll(df).isEmpty() and S.read_table(spark, str(tmp_path / "t")).count() == 50
    S.write_table(df, str(tmp_path / "p"), partition_by=["k"])
    assert S.read_table(spark, str(tmp_path / "p")).where("k = 1").count() == 17
    S.write_csv_report(df, str(tmp_path / "c"))
    assert S.read_csv_report(spark, str(tmp_path / "c"), df.schema).exceptAll(df).isEmpty()
    one = spark.createDataFrame([("v1", ["a", "b"], {"n": 1}, None)], "version string, features array<string>, counts map<string,int>, parent string")
    S.write_json_document(one, str(tmp_path / "j"))
    assert S.read_json_document(spark, str(tmp_path / "j"), one.schema).first() == one.first()
    assert S.as_document(one).first()[0] == '{"version":"v1","features":["a","b"],"counts":{"n":1},"parent":null}'
    assert [r["x"] for r in S.first_rows(df, ["k", "x"], 3).collect()] == [0.0, 3.0, 6.0]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id as k", "id * 2 as v")
    S.write_bucketed(rows, "snap_a", "k", 4, path=str(tmp_path / "a"))
    S.write_bucketed(rows, "snap_b", "k", 4, path=str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("snap_a").join(spark.table("snap_b").withColumnRenamed("v", "w"), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_archive_is_parsed_in_bounded_blocks(tmp_path):
    import pyarrow as pa

    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("a.csv", "w") as f:
        f.write(b"k,age,note\n")
        for i in range(60):
            f.write(b"".join(b'%d,2,"%s\nnext"\n' % (i * 1000 + j, b"y" * 2000) for j in range(1000)))  # 120 MB unpacked
    content, seen = (tmp_path / "big.zip").read_bytes(), 0
    before = pa.total_allocated_bytes()
    for batch in C._batches(content, "big.zip", ["k", "note"], C.BLOCK):
        assert pa.total_allocated_bytes() - before < 6 * C.BLOCK
        assert batch.column("k")[0].as_py() == str(seen) and batch.column("note")[0].as_py() == "y" * 2000 + "\nnext"
        seen += batch.num_rows
    assert seen == 60_000


def test_blocks_grow_with_the_longest_row_and_long_archives_are_opened_by_path(spark, tmp_path, monkeypatch):
    archive(tmp_path / "a.zip", {"a.csv": "k,age,note\n" + "".join(f'{i},1,"{"z" * (i % 7) * 3000}\n"\n' for i in range(300))})
    archive(tmp_path / "b.zip", {"a.csv": "k,age,note\n900,1,x\n901,2"})
    whole = C.read_archives(spark, str(tmp_path), SCHEMA).orderBy("k").collect()
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    assert C.parse_archives(files, SCHEMA, block=1000).orderBy("k").collect() == whole
    monkeypatch.setattr(C, "CELL_BYTES", 200)  # a.zip is beyond it
    assert C.read_archives(spark, str(tmp_path), SCHEMA).orderBy("k").collect() == whole
    assert [r["_line"] for r in whole if r["k"] is not None and r["k"] < 300] == list(range(300)) and any(r["_error"] for r in whole)
