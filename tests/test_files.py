import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from inkstrata.functions import vectors as vx
from inkstrata.operators import sinks
from inkstrata.operators.chunking import Chunker
from inkstrata.operators.ingest import apply_converters, build_metadata, ingest
from inkstrata.sources import files, listing, specs
from pyspark.sql import functions as F


@pytest.fixture
def corpus(tmp_path, spark):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.txt").write_text(" first \n\n second\r\nthird \n")
    (tmp_path / "b.JSONL").write_text('{"text": "json", "x": 1}\n{"x": 2}\n{"text": ""}\n')
    (tmp_path / "note.md").write_text("passed over")
    spark.createDataFrame([("p",), ("",), (None,)], "text string").coalesce(1).write.parquet(str(tmp_path / "c"))
    return tmp_path


def texts(df):
    return sorted(r["text"] for r in df.collect())


def test_corpus_of_all_kinds(spark, corpus):
    assert texts(files.read_corpus(spark, [str(corpus)])) == ["first", "json", "p", "second", "third"]
    assert texts(files.read_corpus(spark, [str(corpus / "a" / "one.txt"), str(corpus / "b.JSONL")])) == [
        "first", "json", "second", "third",
    ]
    with pytest.raises(ValueError, match="note.md"):
        files.read_corpus(spark, [str(corpus / "note.md")])


def test_hidden_names_are_read(spark, corpus):
    (corpus / "a" / "_deep").mkdir()
    (corpus / "a" / "_x.txt").write_text(" hidden \n\n")
    (corpus / "a" / "_deep" / "z.TXT").write_text("deeper\r\nstill")
    (corpus / ".y.jsonl").write_text('{"text": "not lost"}\n{"text": ""}\n')
    (corpus / "_temporary").mkdir()
    (corpus / "_temporary" / "left.txt").write_text("no data")
    pq.write_table(pa.table({"text": ["q", "", None]}), str(corpus / "_q.parquet"))
    want = ["deeper", "first", "hidden", "json", "not lost", "p", "q", "second", "still", "third"]
    assert texts(files.read_corpus(spark, [str(corpus)])) == want
    assert texts(files.read_eval_corpus(spark, str(corpus))) == ["p", "q"]
    rows = files.read_corpus(spark, [str(corpus / "a")]).orderBy(*files.SCAN_ORDER).collect()
    assert [r["text"] for r in rows] == ["deeper", "still", "hidden", "first", "second", "third"]


def test_many_files_are_shared_out(spark, tmp_path, monkeypatch):
    rows = spark.range(300).select(F.concat(F.lit("d/"), (F.col("id") % 7).cast("string"), F.lit("/"), F.col("id").cast("string"), F.lit(".md")).alias("path"), F.encode(F.col("id").cast("string"), "UTF-8").alias("content"))
    listing.write_files(rows, str(tmp_path))
    (tmp_path / "d" / "0" / "other.bin").write_bytes(b"x")
    monkeypatch.setattr(listing, "TASK_FILES", 40)
    reader = listing._Reader({"path": str(tmp_path), "suffixes": ".md"})
    shares = reader.partitions()
    assert [len(s.paths) for s in shares] == [40] * 7 + [20]
    got = {r["path"]: r["text"] for r in files.read_documents(spark, str(tmp_path)).collect()}
    assert got == {f"{tmp_path}/d/{i % 7}/{i}.md": str(i) for i in range(300)}
    assert files.read_documents(spark, str(tmp_path / "d" / "1" / "1.md")).count() == 1


def test_columns_are_checked_in_tasks(spark, tmp_path):
    for i in range(30):
        pq.write_table(pa.table({"text" if i % 10 else "body": ["x"]}), str(tmp_path / f"f{i:02}.parquet"))
    names = [n for n, _ in listing.list_files(str(tmp_path), (".parquet",))]
    assert [n[-11:] for n in listing.without_column(spark, names, "text")] == ["f00.parquet", "f10.parquet", "f20.parquet"]


def test_parquet_without_text_is_an_error(spark, corpus):
    pq.write_table(pa.table({"body": ["x"]}), str(corpus / "other.parquet"))
    for read in (lambda: files.read_corpus(spark, [str(corpus)]), lambda: files.read_eval_corpus(spark, str(corpus / "other.parquet"))):
        with pytest.raises(ValueError, match="without a text column: .*other.parquet"):
            read()


def test_file_order(spark, corpus):
    (corpus / "a" / "two.txt").write_text("fourth\n")
    rows = files.read_corpus(spark, [str(corpus / "a")]).orderBy(*files.SCAN_ORDER).collect()
    assert [r["text"] for r in rows] == ["first", "second", "third", "fourth"]


def test_broken_json_is_an_error(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"text": "a"}\n{oops\n')
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "x.jsonl")).collect()


def test_eval_corpus(spark, corpus):
    assert texts(files.read_eval_corpus(spark, str(corpus))) == ["p"]
    assert texts(files.read_eval_corpus(spark, str(corpus / "note.md"))) == ["passed over"]


def test_question_sets(spark, tmp_path):
    path = tmp_path / "q.jsonl"
    path.write_text('{"question": "q", "context": "c"}\n{"question": "r", "context": "d", "answers": ["x"]}\n')
    got = files.read_qa(spark, str(path)).orderBy("question").collect()
    assert [r["answers"] for r in got] == [[], ["x"]]
    (tmp_path / "q.csv").write_text("no")
    with pytest.raises(ValueError):
        files.read_qa(spark, str(tmp_path / "q.csv"))


def test_documents(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.MD").write_bytes(b"x\r\ny\rz")
    (tmp_path / "p.htm").write_text("<p>t</p>")
    (tmp_path / "bad.md").write_bytes(b"\xff\xfe")
    (tmp_path / "c.txt").write_text("no converter")
    (tmp_path / "film.mp4").write_bytes(b"\0" * 100)
    (tmp_path / "_own.markdown").write_text("hidden")
    got = {r["path"].rsplit("/", 1)[-1]: r for r in files.read_documents(spark, str(tmp_path)).collect()}
    assert set(got) == {"a.MD", "p.htm", "_own.markdown"}
    assert got["a.MD"]["text"] == "x\ny\nz" and got["p.htm"]["converter"] == "html"
    rows = ingest(files.read_documents(spark, str(tmp_path)), Chunker(), vx.digest_embedding).collect()
    assert {(r["content"], r["metadata"]["source"]) for r in rows} == {("x\ny\nz", "MD"), ("t", "htm"), ("hidden", "markdown")}
    with pytest.raises(ValueError):
        files.read_documents(spark, str(tmp_path / "c.txt"))
    with pytest.raises(Exception, match="not UTF-8"):
        files.read_documents(spark, str(tmp_path / "bad.md")).collect()


def test_caller_metadata_wins(spark):
    base = F.create_map(F.lit("commit"), F.lit("mine"), F.lit("team"), F.lit("x"))
    got = spark.range(1).select(build_metadata(F.lit("d/a.md"), base, repo="r", commit="c").alias("m")).first()["m"]
    assert got == {"file_path": "d/a.md", "repo": "r", "commit": "mine", "source": "md", "team": "x"}
    bare = spark.range(1).select(build_metadata(F.lit("a.md")).alias("m")).first()["m"]
    assert bare == {"file_path": "a.md", "repo": "unknown", "commit": "HEAD", "source": "md"}


def test_user_converters_may_yield_nothing(spark):
    rows = spark.createDataFrame([("a.x", "1,2"), ("b.x", ""), ("c.y", "3")], "path string, text string")
    got = apply_converters(rows, {".x": lambda t: [p for p in t.split(",") if p]}).collect()
    assert sorted((r["path"], r["chunk_index"], r["content"]) for r in got) == [("a.x", 0, "1"), ("a.x", 1, "2")]


def test_workers_follow_the_list(spark, tmp_path):
    listed = []
    for name in ("z", "a", "m"):
        path = str(tmp_path / f"{name} {name}.parquet")
        pq.write_table(pa.table({"text": [name, ""]}), path)
        listed.append(path)
    got = {r["text"]: r["worker"] for r in files.read_for_workers(spark, listed, 2).collect()}
    assert got == {"z": 0, "a": 1, "m": 0}
    assert {r["worker"] for r in files.read_for_workers(spark, listed, 0).collect()} == {0}
    with pytest.raises(ValueError):
        files.read_for_workers(spark, [str(tmp_path)], 2)


def test_workers_read_tables_stored_as_folders(spark, tmp_path):
    single, folder = str(tmp_path / "one file.parquet"), str(tmp_path / "a table.parquet")
    pq.write_table(pa.table({"text": ["single", None]}), single)
    spark.createDataFrame([(f"part {i}",) for i in range(6)] + [("",)], "text string").repartition(3).write.parquet(folder)
    got = sorted((r["text"], r["file"], r["position"], r["worker"]) for r in files.read_for_workers(spark, [single, folder], 2).collect())
    assert got == [(f"part {i}", folder, 1, 1) for i in range(6)] + [("single", single, 0, 0)]


def test_specs():
    assert specs.DatasetSpec.parse("a/b:train:text") == specs.DatasetSpec("a/b", "train", "text")
    four = specs.DatasetSpec.parse("a/b:cfg:train:text")
    assert (four.config, four.directory) == ("cfg", "a_b__cfg")
    for wrong in ("a", "a:b", "a:b:c:d:e"):
        with pytest.raises(ValueError):
            specs.DatasetSpec.parse(wrong)


def test_failed_datasets(spark, tmp_path):
    spark.createDataFrame([("t", "mit")], "body string, license string").write.parquet(str(tmp_path / "ok" / "train"))
    wanted = ["ok:train:body", "gone:train:body", "ok:train:nothing"]
    union, failed = specs.read_datasets(spark, wanted, str(tmp_path), skip_failed=True)
    assert [(r["dataset"], r["text"], r["license"]) for r in union.collect()] == [("ok", "t", "mit")]
    assert {r["spec"] for r in failed.collect()} == set(wanted[1:])
    with pytest.raises(Exception):
        specs.read_datasets(spark, wanted, str(tmp_path))


def test_corpus_file_keeps_lines(spark, tmp_path):
    rows = spark.createDataFrame([("a\nb",), ("c",)], "text string")
    sinks.write_corpus(rows, str(tmp_path / "out"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["a", "b", "c"]
    assert sorted(r["value"] for r in sinks.corpus_lines(rows).collect()) == ["a", "b", "c"]
