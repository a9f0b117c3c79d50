import random

import pytest

from loretable.sources import io, lines


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def made(rng, n):
    return ["".join(rng.choice("ab é中\r") for _ in range(rng.choice((0, 1, 9, 80, 300)))).rstrip("\r") for _ in range(n)]


@pytest.mark.parametrize(("end", "closed"), [("\n", True), ("\n", False), ("\r\n", True)])
def test_line_numbers_by_ranges(spark, tmp_path, small_ranges, end, closed):
    rng, want = random.Random(3), {}
    for name in ("a.txt", "b.txt"):
        rows = made(rng, 120) + ["last"]
        (tmp_path / name).write_bytes((end.join(rows) + (end if closed else "")).encode())
        want |= {(name, i): row for i, row in enumerate(rows, 1)}
    ranged = lines.ranged_lines(spark, str(tmp_path))
    assert ranged.select("path", "start").distinct().count() > 10
    got = lines.read_lines(spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {(r.file, r.line_no): r.line for r in got} == want


def test_jsonl_by_ranges_numbers_bad_and_blank_lines(spark, tmp_path, small_ranges):
    rows = ['{"a": %d}' % i if i % 7 else "" if i % 2 else "broken %d" % i for i in range(1, 900)]
    (tmp_path / "l.jsonl").write_text("\n".join(rows))
    good, bad = io.read_jsonl(spark, str(tmp_path / "l.jsonl"), "a int")
    assert {(r.line_no, r.a) for r in good.collect()} == {(i, i) for i in range(1, 900) if i % 7}
    assert {(r.line_no, r.line) for r in bad.collect()} == {(i, f"broken {i}") for i in range(1, 900) if i % 7 == 0 and i % 2 == 0}


def test_pieces_equal_whole_texts(spark, tmp_path, small_ranges):
    rng = random.Random(4)
    text = "\n".join(made(rng, 60)) + "\nend"
    files = {
        "utf.txt": text.encode(), "bom.txt": text.encode("utf-8-sig"), "bom_end.txt": (text + "\n").encode("utf-8-sig"), "gb.txt": text.encode("gb18030"), "bad.txt": text.encode("gb18030") + b"\n\xff\xff", "crlf.txt": text.replace("\n", "\r\n").encode(),
        "empty.txt": b"", "one": b"x", "名 字+a.b.txt": (text + "\n\n").encode(), "line.txt": b"y" * 5000, "ends.txt": b"\n", "late.txt": b"plain\n" * 400 + "字".encode("gb18030") + b"\n",
    }
    (tmp_path / "in").mkdir()
    for name, data in files.items():
        (tmp_path / "in" / name).write_bytes(data)
    whole = {r.source_file: (r.source_name, r.encoding, r.text) for r in io.read_texts(spark, str(tmp_path / "in")).collect()}
    rows = lines.read_pieces(spark, str(tmp_path / "in"), most=700).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.source_file, r.piece)):
        name, encoding, n, joined = got.get(r.source_file, (r.source_name, r.encoding, 0, ""))
        assert (name, encoding, n) == (r.source_name, r.encoding, r.piece)
        got[r.source_file] = (name, encoding, n + 1, joined + r.text)
    assert {k: (v[0], v[1], v[3]) for k, v in got.items()} == whole
    assert got["utf.txt"][2] > 5 and got["line.txt"][2] == 1 and "empty.txt" not in got


def test_buckets_of_sources(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i % 30}", i) for i in range(300)], "source_name string, n int")
    io.write_chunks(rows, str(tmp_path / "c"), buckets=4)
    assert len(list((tmp_path / "c").glob("source_bucket=*"))) <= 4
    assert io.read_chunks(spark, str(tmp_path / "c")).count() == 300
    some = io.read_chunks(spark, str(tmp_path / "c"), ["s3", "s7"], buckets=4)
    assert some.count() == 20 and some.select("source_bucket").distinct().count() <= 2
    assert "source_bucket" in some._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]
