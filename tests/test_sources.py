import datetime as dt
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

from segmentry import config as C
from segmentry import session
from segmentry.sources import readers, split_csv, writers

HEADER = "SCH_IDX,ADS_IDX,MDA_IDX_ARR,SCH_CLK_NUM,SCH_TURN_NUM,SCH_TYPE"


def write(folder, name, *lines, encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n", encoding=encoding)
    return str(folder)


def test_lenient_load_skips_bad_lines_and_keeps_quotes(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", '1,1,"[1,2]",5,5,"say ""hi"""', "x,1,[1],5,5,CPA", "2,2,,\\N,5", "3,3,,,5,CPC")
    got = readers.read_lenient(spark, path, C.SCHEDULE_SCHEMA).orderBy("SCH_IDX").collect()
    assert [tuple(r) for r in got] == [(1, 1, "[1,2]", 5, 5, 'say "hi"'), (3, 3, None, None, 5, "CPC")]
    rejects = readers.read_rejects(spark, path, C.SCHEDULE_SCHEMA)
    assert sorted(r.line for r in rejects.collect()) == ["2,2,,\\N,5", "x,1,[1],5,5,CPA"]
    assert {r.file for r in rejects.collect()} == {"a.csv"}


def test_bad_cells_count_whatever_is_selected(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", "1,1,[1],5,5,CPA", "2,2,[1],5,bad,CPA")
    rows = readers.read_lenient(spark, path, C.SCHEDULE_SCHEMA)
    assert rows.count() == 1
    assert [r.SCH_IDX for r in rows.select("SCH_IDX").collect()] == [1]
    assert readers.read_rejects(spark, path, C.SCHEDULE_SCHEMA).select("line").count() == 1


def test_strict_load_fails_on_the_first_bad_line(spark, tmp_path):
    good = write(tmp_path / "good", "a.csv", "1,1,[1],5,5,CPA")
    bad = write(tmp_path / "bad", "a.csv", "1,1,[1],5,5,CPA", "2,2,[1],5,bad,CPA")
    assert readers.read_strict(spark, good, C.SCHEDULE_SCHEMA).count() == 1
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        readers.read_strict(spark, bad, C.SCHEDULE_SCHEMA).select("SCH_IDX").collect()


def test_shifted_header_is_refused_unless_asked(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("ADS_IDX,SCH_IDX,MDA_IDX_ARR,SCH_CLK_NUM,SCH_TURN_NUM,SCH_TYPE\n1,2,[1],5,5,CPA\n")
    with pytest.raises(Exception, match="header"):
        readers.read_lenient(spark, str(folder), C.SCHEDULE_SCHEMA).collect()
    assert readers.read_lenient(spark, str(folder), C.SCHEDULE_SCHEMA, check_header=False).first().SCH_IDX == 1


def test_byte_order_mark_and_lower_case_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("name,industry\n쇼핑,게임\n", encoding="utf-8-sig")
    assert readers.read_strict(spark, str(folder), C.MAPPING_SCHEMA).first().INDUSTRY == "게임"


def test_files_are_chosen_by_name(spark, tmp_path):
    for name, idx in (("report_2024.csv", 1), ("report_2025.csv", 2), ("other.csv", 3), ("report_x.txt", 4)):
        write(tmp_path / "in", name, f"{idx},1,[1],5,5,CPA")
    rows = readers.read_lenient(spark, str(tmp_path / "in"), C.SCHEDULE_SCHEMA, pattern="report*.csv")
    assert sorted(r.SCH_IDX for r in rows.collect()) == [1, 2]


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", '1,1,"two\nlines",5,5,CPA')
    rows = readers.read_lenient(spark, path, C.SCHEDULE_SCHEMA, multi_line=True)
    assert [r.MDA_IDX_ARR for r in rows.collect()] == ["two\nlines"]


def test_source_file_of_every_row(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "p"))
    got = readers.with_source_file(spark.read.parquet(str(tmp_path / "p")))
    assert all(r.source_file.startswith("part-") for r in got.collect())


def test_intake_goes_on_after_a_missing_file(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "b.csv").write_text("ads_save_way,ads_shape,extra\nw,s,1\n", encoding="utf-8-sig")
    status = readers.intake_files(
        spark, str(folder), ["a.csv", "t.xlsx", "b.csv"], str(tmp_path / "out"), ["ADS_SAVE_WAY", "ADS_SHAPE"]
    )
    assert {r.file: (r.status, r.n_columns) for r in status.collect()} == {
        "a.csv": ("missing", 0), "t.xlsx": ("unsupported", 0), "b.csv": ("copied", 2)
    }
    assert readers.read_lenient(spark, str(tmp_path / "out/b"), C.SHAPE_SCHEMA).first().ADS_SHAPE == "s"


def test_catalogue_views(spark, tmp_path):
    write(tmp_path / "s", "a.csv", "1,1,[1],5,5,CPA")
    spark.range(4).write.parquet(str(tmp_path / "p"))
    readers.register_sources(
        spark,
        {
            "schedule_raw": readers.Source(str(tmp_path / "s"), "csv", C.SCHEDULE_SCHEMA),
            "ids_raw": readers.Source(str(tmp_path / "p")),
        },
    )
    assert spark.sql("select count(*) from schedule_raw join ids_raw on SCH_IDX = id").first()[0] == 1


ODD_CELLS = [
    (1, None, ""), (2, 'a "b", c', "x"), (3, "line1\nline2", "y"), (4, '"', "\n"), (5, "N", "\r\n tail"), (6, "", None),
    (7, 'half"\n"other', ","),
]


@pytest.mark.parametrize("write", [writers.write_csv, writers.unload_csv])
def test_breaks_quotes_empty_text_and_null_survive(spark, tmp_path, write):
    df = spark.createDataFrame(ODD_CELLS, "i int, a string, b string")
    write(df, str(tmp_path / "u"))
    back = readers.read_lenient(spark, str(tmp_path / "u"), df.schema)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == ODD_CELLS
    assert readers.read_rejects(spark, str(tmp_path / "u"), df.schema).isEmpty()
    strict = readers.read_strict(spark, str(tmp_path / "u"), df.schema)
    assert strict.count() == len(ODD_CELLS)


def test_lines_read_apart_put_both_halves_aside(spark, tmp_path):
    df = spark.createDataFrame([("line1\nline2", "y"), ("whole", "z")], "a string, b string").coalesce(1)
    writers.write_csv(df, str(tmp_path / "u"))
    good = readers.read_lenient(spark, str(tmp_path / "u"), df.schema, multi_line=False)
    assert [tuple(r) for r in good.collect()] == [("whole", "z")]
    assert readers.read_rejects(spark, str(tmp_path / "u"), df.schema, multi_line=False).count() == 2


def test_split_keeps_missing_keys_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, None)], "v int, GMM_CLUSTER int")
    writers.split_by_key(df, str(tmp_path / "c"), "GMM_CLUSTER")
    back = spark.read.parquet(str(tmp_path / "c"))
    assert sorted((r.v, str(r.GMM_CLUSTER)) for r in back.collect()) == [(1, "0"), (2, "0"), (3, "1"), (4, "None")]
    assert back.filter("GMM_CLUSTER = 0").count() == 2


def test_batches_have_one_file_each(spark, tmp_path):
    df = spark.range(250).withColumn("batch", F.floor(F.col("id") / 100))
    writers.write_batches(df, str(tmp_path / "b"))
    assert sorted(len(list(p.glob("*.csv"))) for p in (tmp_path / "b").glob("batch=*")) == [1, 1, 1]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    runs = spark.createDataFrame([("r1", 1, 0.5), ("r2", 2, 0.25)], "run string, step int, loss double")
    long = writers.unpivot_metrics(runs, ["run", "step"], ["loss"])
    writers.append_runs(long, path, "a")
    writers.append_runs(long.limit(1), path, "a")
    writers.append_runs(long, path, "b")
    assert (readers.read_runs(spark, path, "a").count(), readers.read_runs(spark, path, "b").count()) == (3, 2)
    writers.replace_runs(long.filter("run = 'r2'"), path, "a")
    assert [tuple(r) for r in readers.read_runs(spark, path, "a").collect()] == [("r2", 2, "loss", 0.25)]
    assert readers.read_runs(spark, path, "b").count() == 2


def test_two_writers_at_once_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "runs")
    frames = [spark.range(i * 10, i * 10 + 10).select(F.col("id").alias("run")) for i in range(6)]
    with ThreadPool(6) as pool:
        pool.map(lambda df: writers.append_runs(df, path, "a"), frames)
    assert sorted(r.run for r in readers.read_runs(spark, path, "a").collect()) == list(range(60))
    with ThreadPool(3) as pool:  # a replacement beside appends: what is newer than it stays
        pool.map(lambda f: f(), [lambda: writers.replace_runs(frames[0], path, "a"), lambda: writers.append_runs(frames[1], path, "a"), lambda: writers.append_runs(frames[2], path, "b")])
    got = sorted(r.run for r in readers.read_runs(spark, path, "a").collect())
    assert got in (list(range(10)), list(range(20)))
    assert sorted(r.run for r in readers.read_runs(spark, path, "b").collect()) == list(range(20, 30))


def test_a_log_is_compacted_beside_its_writers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    one = lambda v: spark.createDataFrame([(v,)], "run int")
    runs = lambda x="a": sorted(r.run for r in readers.read_runs(spark, path, x).collect())
    writers.append_runs(one(0), path, "a")
    writers.replace_runs(one(1), path, "a")
    writers.append_runs(one(2), path, "a")
    writers.append_runs(one(9), path, "b")
    commit = writers._commit
    monkeypatch.setattr(writers, "_commit", lambda *x, **k: (commit(one(3), path, "a", writers._new_version(), "append"), commit(*x, **k)))
    assert writers.compact_runs(spark, path, "a") == 2  # a version is written while the others are merged
    monkeypatch.setattr(writers, "_commit", commit)
    assert runs() == [1, 2, 3] and runs("b") == [9]
    assert writers.vacuum_runs(spark, path, "a") == 3 and runs() == [1, 2, 3] and runs("b") == [9]
    assert writers.compact_runs(spark, path, "b") == 0
    writers.replace_runs(one(4).limit(0), path, "a")
    assert runs() == []


def test_a_version_counts_only_when_it_is_whole(spark, tmp_path):
    path = str(tmp_path / "runs")
    writers.append_runs(spark.range(3), path, "a")
    spark.range(5).write.parquet(f"{path}/experiment=a/version=z")
    assert readers.read_runs(spark, path, "a").count() == 3


def test_schemas_match_the_declared_tables():
    assert [len(s.fields) for s in (C.CAMPAIGN_SCHEMA, C.SCHEDULE_SCHEMA, C.REPORT_SCHEMA, C.SHAPE_SCHEMA, C.MAPPING_SCHEMA)] == [
        17, 6, 10, 2, 2
    ]
    assert len(C.FINAL_COLUMNS) == 28 and len(C.FLOAT_COLUMNS) == 9


def test_cut_keeps_rows_order_of_columns_and_folders(spark):
    df = spark.createDataFrame([(1, "x", dt.date(2025, 1, 1)), (2, None, None)], "a int, b string, c date")
    got = session.cut(df, ["a"])
    assert got.columns == ["a", "b", "c"] and got.schema["a"].dataType.typeName() == "integer"
    assert got.exceptAll(df).isEmpty() and df.exceptAll(got).isEmpty()
    assert session.cut(df.limit(0), ["a"]).count() == 0


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = session.fresh_path(spark, "x")
    assert folder is None or path.startswith(folder)
    assert path != session.fresh_path(spark, "x")


def broken_rows(n):
    """Cells with breaks, quotes and commas, some far longer than a split, between plain ones."""
    odd = ["plain", "a\nb", 'say "x"\r\n"y",\n', "", None, "\n" * 40, 'lone " quote', ",\n,", "line\n" * 300]
    return [(i, odd[i % len(odd)], odd[(i * 7 + 3) % len(odd)], i / 8) for i in range(n)]


@pytest.mark.parametrize("bytes_per_task", ["300", "1k", "128m"])
def test_one_file_is_read_by_many_tasks_without_loss(spark, tmp_path, bytes_per_task):
    rows = broken_rows(36)
    df = spark.createDataFrame(rows, "i int, a string, b string, x double")
    writers.write_csv(df.coalesce(1), str(tmp_path / "u"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_per_task)
    try:
        got = readers.read_lenient(spark, str(tmp_path / "u"), df.schema)
        assert sorted(map(tuple, got.collect())) == rows
        assert readers.read_strict(spark, str(tmp_path / "u"), df.schema).count() == len(rows)
        assert readers.read_rejects(spark, str(tmp_path / "u"), df.schema).isEmpty()
        n_tasks = split_csv.text_lines(spark, str(tmp_path / "u")).rdd.getNumPartitions()
        assert n_tasks > 4 if bytes_per_task != "128m" else n_tasks < 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


ODD_FILE = 'ID,T\r\n1,"a ""b"", c"\r\n\r\n2,five" disk\n3,"open" tail\n4,"two\r\nlines"\nx,bad\n5,"a",extra\n6,"never\nclosed\n'


@pytest.mark.parametrize("bytes_per_task", ["11", "128m"])
def test_odd_quotes_and_line_ends(spark, tmp_path, bytes_per_task):
    """As Spark's own one-task reader: lone quotes are text, carriage returns end lines, bad rows are set aside."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_bytes(ODD_FILE.encode())
    (tmp_path / "in/b.csv").write_bytes(b'\xef\xbb\xbfid,t\n7,"x\n\n\ny"\n8,\xff\n')
    schema = spark.createDataFrame([], "ID int, T string").schema
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_per_task)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = {r.ID: r["T"] for r in readers.read_lenient(spark, str(tmp_path / "in"), schema).collect()}
        bad = sorted((r.file, r.line) for r in readers.read_rejects(spark, str(tmp_path / "in"), schema).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = {r.ID: r["T"] for r in readers.read_lenient(spark, str(tmp_path / "in"), schema, multi_line=True).collect()}
    assert got == {1: 'a "b", c', 2: 'five" disk', 3: '"open" tail', 4: "two\r\nlines", 6: got[6], 7: "x\n\n\ny", 8: "�"}
    assert got[6].startswith(('never\nclosed', '"never\nclosed'))
    assert {k: v for k, v in whole.items() if k in (1, 7)} == {k: got[k] for k in (1, 7)}
    assert bad == [("a.csv", '5,"a",extra'), ("a.csv", "x,bad")]


@pytest.mark.parametrize("line", ['a,b', '"a', 'a,"b', '"a","b"', '"a""', '"a"""', '"a"x,"b', '""', '"",""","', 'x"y', 'x,"a""",b"', ',"', '"\r'])
def test_line_functions_equal_a_character_machine(line):
    def plain(inside):
        state = "in" if inside else "start"
        i = 0
        while i < len(line):
            c = line[i]
            if state == "in":
                if c == '"' and line[i + 1 : i + 2] == '"':
                    i += 1
                elif c == '"':
                    state = "out"
            elif c == ",":
                state = "start"
            else:
                state = "in" if c == '"' and state == "start" else "out"
            i += 1
        return state == "in"

    assert [split_csv.ends_inside(line, x) for x in (False, True)] == [plain(False), plain(True)]


def test_a_scan_of_the_splits_serves_both_branches(spark, tmp_path):
    """Only the pass over quotes and the pass over rows take lines to Python; broken splits are few."""
    df = spark.createDataFrame(broken_rows(50), "i int, a string, b string, x double")
    writers.write_csv(df.coalesce(1), str(tmp_path / "u"))
    plan = readers.read_lenient(spark, str(tmp_path / "u"), df.schema)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" not in plan
