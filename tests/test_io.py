"""Sources, sinks, generator, streaming and the command line."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillmark import cli, report
from quillmark.operators import contract, tagging
from quillmark.plans.registry import ANSWER, QUERY
from quillmark.sources import logs, sinks, synth
from quillmark.streaming.tagger import tag_stream

CSV = '\ufeffa,b,c\n1,"x ""q"" y",z\n\n2,"line\nbreak",NA\n3,short\n4,None,"back\\slash"\n'


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(CSV, encoding="utf-8")
    got = [tuple(r) for r in logs.read_csv(spark, str(path)).collect()]
    assert got == [("1", 'x "q" y', "z"), ("2", "line\nbreak", "NA"), ("3", "short", None), ("4", "None", "back\\slash")]
    assert logs.read_csv(spark, str(path), limit=2).count() == 2
    assert logs.read_csv(spark, str(path), columns=["c", "a"], partitions=3).columns == ["c", "a"]
    assert [r.b for r in logs.read_csv(spark, str(path), na_tokens=True).collect()][-1] is None


def test_lists_as_text(spark):
    cases = [[], ["a"], ["a", "b c"], ["it's"], ['say "x"'], ["it's \"x\""]]
    df = spark.createDataFrame([(c,) for c in cases], "f array<string>").select(sinks.list_text(F.col("f")).alias("t"))
    assert [r.t for r in df.collect()] == [str(c) for c in cases]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", ["a", "b"], 'q"\n')], "id string, Flags array<string>, t string")
    sinks.write_csv(df, str(tmp_path / "c"), keep=["t", "none", "Flags"], single_file=True)
    back = logs.read_csv(spark, str(tmp_path / "c"))
    assert back.columns == ["t", "Flags"] and tuple(back.first()) == ('q"\n', "['a', 'b']")
    sinks.write_parquet(df, str(tmp_path / "p"), keep=["Flags"])
    assert spark.read.parquet(str(tmp_path / "p")).first().Flags == ["a", "b"]


def test_generator(spark):
    rows = lambda *a: synth.generate(spark, *a).collect()
    assert rows(50, 1) == rows(50, 1) and rows(50, 1) != rows(50, 2)
    assert synth.generate(spark, 1).columns == [f.name for f in contract.FIELDS] and len(contract.FIELDS) == 36
    clean = tagging.summarize(synth.generate(spark, 300, 3)).first().asDict()
    assert {k for k, v in clean.items() if v} == {"rows"}
    spoilt = tagging.summarize(synth.generate(spark, 300, 3, "adversarial")).first().asDict()
    assert {k for k, v in spoilt.items() if not v} == {"empty_retrieved_docs", "empty_search_query"}
    with pytest.raises(ValueError):
        synth.generate(spark, 1, 0, "other")


def test_stream(spark, tmp_path):
    synth.generate(spark, 60, 1, "adversarial").select(QUERY, ANSWER).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(f"{QUERY} string, {ANSWER} string").parquet(str(tmp_path / "in"))
    tag_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    want = tagging.row_tags(spark.read.parquet(str(tmp_path / "in"))).groupBy("Flags").count().collect()
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("Flags").count().collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_cli_summary(spark, capsys, tmp_path):
    assert cli.main(["summary", "--dry-run", "--rows", "50"]) == 0
    out, err = capsys.readouterr()
    assert "RUN SUMMARY" in out and "status    : OK" in out and "running on" in err
    labels = [x[:10].strip() for x in out.splitlines() if x[10:12] == ": " or x[10:] == ":"]
    assert labels == ["version", "args", "input", "shape", "schema", "metrics", "runtime", "status"]
    assert all(report.display_width(x) <= 80 for x in out.splitlines())
    assert cli.main(["summary", "--dry-run", "--rows", "50", "--adversarial"]) == 1
    assert "CONTRACT MISMATCH" in capsys.readouterr().out
    assert cli.main(["summary", "--data", str(tmp_path / "none.csv")]) == 2
    with pytest.raises(SystemExit) as e:
        cli.main(["summary"])
    assert e.value.code == 2


def test_cli_flags(spark, capsys, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(f"{QUERY},{ANSWER}\n질문,끝에 쉼표\n질문,끝입니다.\n", encoding="utf-8")
    out = tmp_path / "o.parquet"
    assert cli.main(["flags", str(path), "-o", str(out), "--keep-cols", "Flags"]) == 0
    assert "truncated_answer" in capsys.readouterr().out
    assert sorted(map(tuple, (r.Flags for r in spark.read.parquet(str(out)).collect()))) == [(), ("truncated_answer",)]


def test_version_is_never_blank(tmp_path: Path):
    assert cli.read_version(tmp_path) == "unversioned"
    (tmp_path / "VERSION").write_text("\n")
    assert cli.read_version(tmp_path) == "unversioned"
    (tmp_path / "VERSION").write_text("1.2\n")
    assert cli.read_version(tmp_path) == "1.2"
