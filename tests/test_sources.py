"""Quoted CSV cut in parallel, versioned tables, the staging run."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rentledger.sources import quoted
from rentledger.sources import snapshot as sn
from rentledger.sources import staging as st
from rentledger.sources import versions as ve

SCHEMA = "a string, b string, c string"


def write_odd_csv(path, rnd, rows, eol, last, header):
    """Fields with line breaks, doubled quotes, delimiters, blanks, NULL and nothing."""

    def cell():
        inside = "".join(rnd.choice(["x", "é", '""', ",", "\n", " ", "yy", "\n\n", "日"]) for _ in range(rnd.randrange(9)))
        return rnd.choice([f'"{inside}"'] * 4 + ["NULL", "plain", ""])

    lines = [header] + [",".join(cell() for _ in range(3)) for _ in range(rows)]
    path.write_bytes((eol.join(lines) + (eol if last else "")).encode())


@pytest.mark.parametrize("seed", range(6))
def test_quoted_csv_is_cut_as_one_reader_does(spark, tmp_path, seed):
    """Splits of any size, down to some that begin and end inside one field, give what Spark reads from whole files."""
    rnd = random.Random(seed)
    for i in range(rnd.choice([1, 3])):
        header = rnd.choice(["a,b,c", '"a","b\n b","c"'])
        write_odd_csv(tmp_path / f"{i}.csv", rnd, rnd.choice([0, 1, 150]), rnd.choice(["\n", "\r\n"]), rnd.random() < 0.5, header)
    whole = spark.read.schema(SCHEMA).options(**sn.CSV_OPTIONS, emptyValue="", multiLine="true").csv(str(tmp_path))
    want = Counter(map(tuple, whole.collect()))
    for size in (5, 40, 1000, 1 << 20):
        assert Counter(map(tuple, sn.read_csv(spark, str(tmp_path), SCHEMA, split_bytes=size).collect())) == want


def test_one_large_csv_is_read_by_many_tasks(spark, conf, tmp_path):
    """No task reads the whole file, whatever the session's own split settings are when the passes run."""
    df = spark.range(20_000).select("id", F.concat(F.lit('line one of "'), F.col("id"), F.lit('",\nline two')).alias("note"))
    sn.write_csv(df.coalesce(1), str(tmp_path))
    (file,) = tmp_path.glob("*.csv")
    size = 1 << 15
    conf("spark.sql.files.maxPartitionBytes", "1g")
    lines = quoted.physical_lines(spark, str(tmp_path), size)
    assert lines.rdd.getNumPartitions() >= file.stat().st_size // size
    read = sn.read_csv(spark, str(tmp_path), "id long, note string", split_bytes=size)
    conf("spark.sql.files.maxPartitionBytes", "10k")
    conf("spark.sql.files.minPartitionNum", "77")
    assert read.exceptAll(df).count() == 0 and read.count() == 20_000
    inside = quoted.split_states(lines).where("inside").count()
    assert 0 < inside < lines.rdd.getNumPartitions()


def test_csv_that_ends_inside_a_field_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c\n1,"two\n3,4,5\n')
    with pytest.raises(ValueError, match="ends inside"):
        sn.read_csv(spark, str(tmp_path), SCHEMA)
    (tmp_path / "x.csv").write_text("")
    assert sn.read_csv(spark, str(tmp_path), SCHEMA).count() == 0


# --- versioned tables -----------------------------------------------------------------------------


def folders(path):
    return sorted(p.name for p in path.iterdir() if not p.name.startswith((".", "_")))


def test_a_run_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        ve.read_versioned(spark, root)
    ve.write_versioned(spark.range(3), root)
    old = ve.read_versioned(spark, root)

    with monkeypatch.context() as patch:  # dies between writing and switching
        patch.setattr(ve, "switch", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            ve.write_versioned(spark.range(9), root)
    assert ve.read_versioned(spark, root).count() == old.count() == 3

    with pytest.raises(Exception, match="broken"):  # dies while writing
        ve.write_versioned(spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("broken"))).otherwise(F.lit("x")).alias("x")), root)
    assert ve.read_versioned(spark, root).count() == 3

    with monkeypatch.context() as patch:  # dies while the pointer is replaced: its new content is there, but not moved
        patch.setattr(ve._Files, "replace", lambda self, name, lines: self.fs.create(self.path(name + ".half")).close())
        ve.write_versioned(spark.range(5), root)
    assert ve.read_versioned(spark, root).count() == 3
    ve.write_versioned(spark.range(4), root)
    assert ve.read_versioned(spark, root).count() == 4 and old.count() == 3


def test_old_versions_are_removed(spark, tmp_path):
    root = tmp_path / "t"
    names = [ve.write_versioned(spark.range(n), str(root), keep=2) for n in (1, 2, 3)]
    assert folders(root) == sorted(names[1:]) and ve.read_versioned(spark, str(root)).count() == 3
    ve.switch(spark, str(root), names[1])
    assert ve.read_versioned(spark, str(root)).count() == 2
    ve.drop_table(spark, str(root))
    assert not root.exists()


def test_report_in_versions(spark, tmp_path):
    for n in (5, 6):
        sn.write_report(spark.range(n), str(tmp_path / "r"), order_by=["id"], versioned=True)
    assert ve.read_versioned(spark, str(tmp_path / "r")).count() == 6


# --- staging --------------------------------------------------------------------------------------


def test_staging_counts_while_it_writes(spark, tmp_path):
    a = spark.createDataFrame([("1", 0.5, True, None), (None, None, None, "2020-01-01")], "Id string, Fee double, On boolean, At string").withColumn("At", F.col("At").cast("timestamp"))
    b = spark.createDataFrame([], "Id string, Other int")
    counts = st.stage_all({"A": a, "B": b}, str(tmp_path), {"A": ["Id", "Fee", "On", "At"], "B": ["Id"]})
    assert counts["A"] == {"n_rows": 2, "null_keys": 1, "money_values": 1, "time_values": 1, "text_values": 1, "flag_values": 1}
    assert counts["B"] == dict.fromkeys(st.COUNTS, 0)
    staged = st.staged_tables(spark, str(tmp_path), ["A", "B"])
    assert staged["A"].schema["Fee"].dataType.typeName() == "decimal" and staged["B"].columns == ["Id"]
    assert st.count_table(spark, counts).count() == 2
    with pytest.raises(Exception):  # a table that can't be staged leaves the one staged before
        st.stage_all({"A": a.withColumn("Fee", F.raise_error(F.lit("no")).cast("double")), "B": b}, str(tmp_path), {"A": ["Id", "Fee"]})
    assert st.staged_tables(spark, str(tmp_path), ["A"])["A"].count() == 2
