import hashlib
import re
from collections import Counter

import tiktoken  # noqa: F401
from pyspark.sql import functions as F

from loretable.llm import token_counts as tc
from loretable.llm import warc


def changes(spark, rows):
    return spark.createDataFrame(rows, tc.CHANGES)


def totals(ledger):
    return {(r.source, r.lang, r.version): (r.documents, r.tokens) for r in ledger.totals().collect()}


def test_ledger(spark, tmp_path):
    ledger = tc.TokenLedger(spark, str(tmp_path / "l"))
    assert totals(ledger) == {} and ledger.batches() == []
    first = changes(spark, [("insert", 1, "a", "en", "v1", 10), ("insert", 2, "a", "en", "v1", 5), ("insert", 3, None, None, "v1", None), ("insert", 1, "a", "en", "v2", 7), ("insert", None, "a", "en", "v1", 1), ("noise", 9, "a", "en", "v1", 99), ("insert", 2, "a", "en", "v1", 4)])
    assert ledger.apply("one", first)
    want = {("a", "en", "v1"): (3, 16), (None, None, "v1"): (1, 0), ("a", "en", "v2"): (1, 7)}
    assert totals(ledger) == want
    assert not ledger.apply("one", first) and totals(ledger) == want
    second = changes(spark, [("revise", 1, "b", "en", "v1", 12), ("delete", 2, None, None, "v1", None), ("delete", 77, "a", "en", "v1", 3), ("delete", None, None, None, "v1", None), ("insert", 4, "a", "en", "v2", 1), ("delete", 4, "a", "en", "v2", 1)])
    assert ledger.apply("two", second) and not ledger.apply("two", first)
    assert totals(ledger) == {("b", "en", "v1"): (1, 12), (None, None, "v1"): (1, 0), ("a", "en", "v2"): (2, 8)}
    assert ledger.apply("three", changes(spark, [("delete", 4, "a", "en", "v2", None), ("delete", 2, "a", "en", "v1", 5), ("insert", 2, "a", "en", "v1", 6)]))
    assert totals(ledger) == {("b", "en", "v1"): (1, 12), ("a", "en", "v1"): (1, 6), (None, None, "v1"): (1, 0), ("a", "en", "v2"): (1, 7)}
    sums = Counter()
    for r in ledger.current().collect():
        sums[r.source, r.lang, r.version] += r.n_tokens
    assert sums == {k: v[1] for k, v in totals(ledger).items()}
    assert ledger.apply("empty", changes(spark, [])) and ledger.batches()[-1] == "empty"


def test_unfinished_batch_is_retried(spark, tmp_path):
    ledger = tc.TokenLedger(spark, str(tmp_path / "l"))
    rows = changes(spark, [("insert", 1, "a", "en", "v", 3)])
    ledger.apply("one", rows)
    next(tmp_path.glob("l/commits/0*")).unlink()
    assert totals(ledger) == {}
    assert ledger.apply("one", rows) and totals(ledger) == {("a", "en", "v"): (1, 3)}


def test_two_writers(spark, tmp_path, monkeypatch):
    """A batch that is overtaken by another one takes its effect into account; each number is given once."""
    ledger, other = (tc.TokenLedger(spark, str(tmp_path / "l")) for _ in range(2))
    ledger.apply("first", changes(spark, [("insert", 1, "a", "en", "v", 3)]))
    commit, done = tc.TokenLedger._commit, []

    def overtaken(self, *x):
        if not done:
            done.append(1)
            assert other.apply("other", changes(spark, [("revise", 1, "b", "en", "v", 10)]))
        return commit(self, *x)

    monkeypatch.setattr(tc.TokenLedger, "_commit", overtaken)
    assert ledger.apply("mine", changes(spark, [("revise", 1, "c", "en", "v", 7)]))
    assert totals(ledger) == {("c", "en", "v"): (1, 7)} and ledger.batches() == ["first", "other", "mine"]
    docs = spark.createDataFrame([(1, "x"), (None, None)], "doc_id long, text string")
    assert ledger.apply("gone", tc.deleted(docs, ["v", "w"])) and totals(ledger) == {}
    assert tc.count_tokens(docs.withColumns({"source": F.lit("s"), "lang": F.lit("en")}).limit(0)).count() == 0


def test_lost_claims_lock_nothing(spark, tmp_path):
    """Files without content under numbers, as a lost writer of another kind may leave them, are passed over."""
    ledger = tc.TokenLedger(spark, str(tmp_path / "l"))
    ledger.apply("one", changes(spark, [("insert", 1, "a", "en", "v", 3)]))
    (tmp_path / "l/commits/00000001").touch()
    (tmp_path / "l/commits/00000007").touch()
    assert ledger.apply("two", changes(spark, [("revise", 1, "a", "de", "v", 5), ("insert", 2, "b", "en", "v", 2)]))
    assert totals(ledger) == {("a", "de", "v"): (1, 5), ("b", "en", "v"): (1, 2)} and ledger.batches() == ["one", "two"]


def test_snapshots_hold_everything_before_them(spark, tmp_path):
    ledger, whole = tc.TokenLedger(spark, str(tmp_path / "l"), snapshot=3), tc.TokenLedger(spark, str(tmp_path / "w"), snapshot=99)
    for n in range(8):
        rows = [("insert", n, f"s{n % 2}", None, "v", n + 1), ("revise", n // 2, "s9", "en", "v", 10 * n), ("delete", n - 3, None, None, "v", None)]
        assert ledger.apply(f"b{n}", changes(spark, rows)) and whole.apply(f"b{n}", changes(spark, rows))
    assert len(list(tmp_path.glob("l/snapshots/0*"))) == 2 and not list(tmp_path.glob("w/snapshots/0*"))
    assert totals(ledger) == totals(whole) and ledger.batches() == [f"b{n}" for n in range(8)]
    assert sorted(map(str, ledger.current().collect())) == sorted(map(str, whole.current().collect()))
    assert not ledger.apply("b0", changes(spark, [("insert", 50, "x", "x", "v", 1)])) and totals(ledger) == totals(whole)
    # a snapshot that was not completed is not used
    next(tmp_path.glob("l/snapshots/*5")).unlink()
    assert totals(ledger) == totals(whole) and ledger.batches() == [f"b{n}" for n in range(8)]


def test_counts_against_libraries(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = {1: "Hello, World's 12 ends", 2: None, 3: "", 4: "é " * 3000}
    docs = spark.createDataFrame([(i, t, "s", "en", "x") for i, t in texts.items()], "doc_id long, text string, source string, lang string, version string")
    got = {(r.version, r.doc_id): r.n_tokens for r in tc.count_tokens(docs).collect()}
    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    byte = tc.byte_tokens(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for i, t in texts.items():
        assert got["word_bpe_49k", i] == len(word.encode(t or "", add_special_tokens=False).ids)
        assert got["byte_bpe_50k", i] == len(byte.encode_ordinary(t or ""))
    assert [r.n_tokens for r in tc.estimated_counts(docs, "v").orderBy("doc_id").collect()] == [4, 0, 0, 3000]


PAGE = '<!DOCTYPE html><html lang="de"><head><title>A &amp; B\n c</title><style>p{}</style><SCRIPT type=x>var t="</p>";</SCRIPT></head><body><!-- no --><nav><a href="/x">one</a> <a class="q" href="/y">two</a></nav><p><b>Bold</b> text &lt;ok&gt;&amp;lt;<br/>next \t line</p></body></html>'


def test_warc_records(spark):
    pages = spark.createDataFrame([(1, "http://a/", PAGE, "b", 1), (2, None, None, "b", 2), (1, "http://a/", PAGE, "b", 1)], "page_id long, url string, html string, block string, key int")
    rows = warc.derive(pages).orderBy("page_id", "record_type").collect()
    assert [(r.page_id, r.record_type) for r in rows] == [(1, "conversion")] * 2 + [(1, "metadata")] * 2 + [(2, "conversion"), (2, "metadata")]
    text, meta = rows[0], rows[2]
    assert text.block == "A & B\nc\none two\nBold text <ok>&lt;\nnext line"
    assert meta.block == f"title: A & B c\r\nlanguage: de\r\nlinks: 2\r\npayload-length: {len(PAGE)}\r\n"
    assert text.refers_to == meta.refers_to and len({text.record_id, meta.record_id, text.refers_to}) == 3
    for r in rows:
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-8[0-9a-f]{3}-8[0-9a-f]{3}-[0-9a-f]{12}>", r.record_id)
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest() and r.content_length == len(r.block.encode())
    assert text.source_digest == "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest()
    assert rows[4].block == "" and rows[4].target_uri is None
    assert warc.derive(pages.limit(0)).count() == 0


def test_source_headers_are_kept(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", PAGE, "<urn:uuid:7>", "2024-01-01T00:00:00Z", "WARC-IP-Address: 1.2.3.4")], "page_id long, url string, html string, rid string, at string, heads string")
    rows = warc.derive(pages, record_id="rid", date="at", source_headers="heads")
    assert {r.refers_to for r in rows.collect()} == {"<urn:uuid:7>"}
    warc.write_warc(rows, str(tmp_path / "w"))
    data = "".join(open(f, newline="").read() for f in sorted(tmp_path.glob("w/part-*")))
    records = data.split("WARC/1.1\r\n")[1:]
    assert len(records) == 2
    for r in records:
        head, body = r.split("\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.split("\r\n"))
        assert fields["WARC-Refers-To"] == "<urn:uuid:7>" and fields["WARC-IP-Address"] == "1.2.3.4" and fields["WARC-Date"] == "2024-01-01T00:00:00Z"
        assert body.encode()[int(fields["Content-Length"]) :] == b"\r\n\r\n"


def test_long_page(spark):
    page = "<p>" + "x <i>y</i> " * 60_000 + "<!-- " + "z" * 200_000
    got = warc.derive(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")).where(F.col("record_type") == "conversion").first()
    assert got.block.startswith("x y x y")


def test_references_and_attributes(spark):
    """References are resolved once; numbers of no character and unknown names stay; quotes of any kind."""
    cases = {
        "&#233;&#xE9;&#XE9;&#128578;": "ééé😊"[:3] + "🙂",
        "&amp;lt; &#38;lt; &#x26;#60;": "&lt; &lt; &#60;",
        "&#0; &#xD800; &#1114112; &unknown; & ; &": "&#0; &#xD800; &#1114112; &unknown; & ; &",
        "a\t\r b<p><br/> <i>c</i> </p>\n\n d": "a b\nc\nd",
        "<style\n>x</style><!-- <p> --><noscript>y</noscript>z": "z",
        "<scripts>kept</scripts>": "kept",
        "if a < b and c > d then &eacute; &ouml; &CounterClockwiseContourIntegral; &NotEqualTilde;": "if a < b and c > d then é ö ∳ ≂̸",
        "1 <2 <b>x</b> 3<4 <!DOCTYPE x><?pi?>y &nbsp;z &amp &AMP; &Eacute;&eacute": "1 <2 x 3<4 y z &amp & É&eacute",
    }
    rows = [(k, "u", f"<html class=q lang='fr'><body><a\nhref=x></a>{html}") for k, html in enumerate(cases)]
    got = warc.derive(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()
    assert [r.block for r in sorted((r for r in got if r.record_type == "conversion"), key=lambda r: r.page_id)] == list(cases.values())
    assert all("language: fr\r\nlinks: 1\r\n" in r.block for r in got if r.record_type == "metadata")


def test_date_is_never_left_out(spark):
    page = spark.createDataFrame([(1, "u", PAGE)], "page_id int, url string, html string")
    assert all("\r\nWARC-Date: 2024-05-06T07:08:09Z\r\n" in r.warc for r in warc.rendered(warc.derive(page), "2024-05-06T07:08:09Z").collect())
    assert all(re.search(r"\r\nWARC-Date: \d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ\r\n", r.warc) for r in warc.rendered(warc.derive(page)).collect())
