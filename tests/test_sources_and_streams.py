import json

from pyspark.sql import functions as F

from loretable.sources import io
from loretable.streaming import intake


def test_read_texts(spark, tmp_path):
    for name, data in {"a.txt": "中文\r\nx".encode("utf-8-sig"), "b.txt": "中文".encode("gb18030"), "c.x.txt": b"\xff\xff\x80", "e.txt": b""}.items():
        (tmp_path / name).write_bytes(data)
    got = {r.source_name: (r.encoding, r.text) for r in io.read_texts(spark, str(tmp_path)).collect()}
    assert got["a"] == ("utf-8-sig", "中文\nx") and got["b"] == ("gb18030", "中文") and "e" not in got and got["c.x"][0] == "gb18030"


def test_chunks_and_records(spark, tmp_path):
    (tmp_path / "b_1.txt").write_text(" text \n", encoding="utf-8")
    (tmp_path / "b_2.txt").write_text("no meta", encoding="utf-8")
    (tmp_path / "b_1.meta.json").write_text(json.dumps({"chunk_id": "b_1", "source_file": "b.txt", "char_start": 3}), encoding="utf-8")
    got = {r.chunk_id: (r.text, r.source_file, r.char_start) for r in io.load_chunks(spark, str(tmp_path)).collect()}
    assert got == {"b_1": ("text", "b.txt", 3), "b_2": ("no meta", None, None)}
    folder = tmp_path / "r"
    folder.mkdir()
    for name, text in {"a.json": '{"chunk_id": "x", "summary": "old"}', "b.json": '{"chunk_id": "x",\n "summary": "new"}', "c.json": '{"summary": "stem"}', "d.json": "{bad"}.items():
        (folder / name).write_text(text)
    good, bad = io.load_records(spark, str(folder), "chunk_id string, summary string")
    assert {r.chunk_id: r.summary for r in good.collect()} == {"x": "new", "c": "stem"} and [r.file for r in bad.collect()] == ["d.json"]


def test_jsonl_and_maps(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\n  \nnope\n{"a": 2}\n')
    good, bad = io.read_jsonl(spark, str(tmp_path / "l.jsonl"), "a int")
    assert sorted(r.a for r in good.collect()) == [1, 2] and [r.line for r in bad.collect()] == ["nope"]
    (tmp_path / "m.json").write_text('{\n "_layer": "x",\n "小": " 大 "\n}', encoding="utf-8")
    assert [tuple(r) for r in io.read_alias_map(spark, str(tmp_path / "m.json")).collect()] == [("小", "大")]
    (tmp_path / "p.json").write_text('{"_layer": "x", "pairs": [{"a": "z", "b": "y", "reason": "r"}, {"a": "", "b": "q"}]}')
    (tmp_path / "q.json").write_text('[{"a": "1", "b": "2"}]')
    assert [tuple(r) for r in io.read_block_pairs(spark, str(tmp_path / "p.json")).collect()] == [("y", "z")]
    assert [tuple(r) for r in io.read_block_pairs(spark, str(tmp_path / "q.json")).collect()] == [("1", "2")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "b", 2), ("s2", "a", 1), ("s1", "c", 3)], "source_name string, line string, n int")
    io.write_chunks(rows, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).where("source_name = 's1'").count() == 2
    io.write_table(rows, str(tmp_path / "j"), "json")
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    io.write_texts(rows, "line", str(tmp_path / "t"), "n")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a", "b", "c"]


def batch(spark, path, rows):
    spark.createDataFrame(rows, "chunk_id string, text string, status string").coalesce(1).write.mode("append").parquet(path)


def test_intake_resumes_and_takes_each_chunk_once(spark, tmp_path):
    path, out = str(tmp_path / "in"), [str(tmp_path / x) for x in ("pending", "structural", "check")]
    schema = "chunk_id string, text string, status string"
    for rows in ([("1", "x" * 300, "a"), ("2", "short", "a")], [("1", "x" * 300, "b"), ("3", "y" * 300, "b")]):
        batch(spark, path, rows)
        intake.start_intake(intake.chunk_stream(spark, path, schema, 1), *out).awaitTermination()
    assert sorted(r.chunk_id for r in spark.read.parquet(out[0]).collect()) == ["1", "3"]
    assert [(r.chunk_id, r.reason) for r in spark.read.parquet(out[1]).collect()] == [("2", "too_short (5 chars < 200)")]


def test_once_for_ever_without_state(spark, tmp_path):
    path, root, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "chunk_id string, text string, status string"
    for n in range(4):
        rows = [(str(i), ("x" if i % 2 else "y" * 250), f"b{n}") for i in range(3 * n, 3 * n + 6)] + [("0", "again", "late"), (None, "x", "none"), (str(3 * n + 5), "y" * 250, f"b{n}")]
        batch(spark, path, rows)
        intake.start_once(intake.chunk_stream(spark, path, schema, 1), root, checkpoint).awaitTermination()
    got = intake.taken(spark, root).collect()
    assert sorted(int(r.chunk_id) for r in got) == list(range(15))
    assert {int(r.chunk_id): r.status for r in got if r.chunk_id != "0"} == {i: f"b{max(0, (i - 3) // 3)}" for i in range(1, 15)}
    assert all((r.structural_reason is None) == (len(r.text) > 200) for r in got)
    assert not list((tmp_path / "check").glob("state")) and intake.taken(spark, str(tmp_path / "none")) is None
    # a batch that runs again writes the same
    before = sorted(map(str, got))
    last = max((tmp_path / "check/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    intake.start_once(intake.chunk_stream(spark, path, schema, 1), root, checkpoint).awaitTermination()
    assert sorted(map(str, intake.taken(spark, root).collect())) == before


def test_running_counts_equal_batch_counts(spark, tmp_path):
    path = str(tmp_path / "in")
    batch(spark, path, [("1", "x", "a"), ("2", "x", "b"), ("3", "x", "a")])
    batch(spark, path, [("4", "x", "a")])
    stream = intake.running_counts(intake.chunk_stream(spark, path, "chunk_id string, text string, status string", 1), "status")
    intake.start_counts(stream, "live_counts", str(tmp_path / "cp")).awaitTermination()
    want = spark.read.parquet(path).groupBy("status").agg(F.count("*").alias("count"))
    assert sorted(map(tuple, spark.table("live_counts").collect())) == sorted(map(tuple, want.collect()))
