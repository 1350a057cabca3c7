"""WARC round trip, corpus sources, sinks, streaming and the driver contract."""

import gzip
import os
import tempfile

from pyspark.sql import functions as F


def _warc_record(kind, uri, body: bytes) -> bytes:
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\n"
    if uri:
        head += f"WARC-Target-URI: {uri}\r\n"
    head += f"Content-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def test_warc_files_plain_and_gzip(spark):
    from quarry.sources.warc import conversion_texts, read_warc, response_texts
    d = tempfile.mkdtemp(prefix="quarry-warc-")
    recs = [
        _warc_record("warcinfo", None, b"software: test"),
        _warc_record("request", "http://a", b"GET / HTTP/1.1\r\n\r\n"),
        _warc_record("response", "http://a", b"HTTP/1.1 200 OK\r\n\r\n<html><p>Hello &amp; bye</p></html>"),
        _warc_record("response", "http://b", b"<p>no header here</p>"),
        _warc_record("response", "http://c", b"HTTP/1.1 204 No Content\r\n\r\n"),
        _warc_record("response", "http://d", b"HTTP/1.1 200 OK\r\n\r\n<p>caf\xe9</p>"),
    ]
    with open(os.path.join(d, "a.warc"), "wb") as f:
        f.write(b"".join(recs))
    with open(os.path.join(d, "b.warc.gz"), "wb") as f:  # one gzip member per record
        for r in recs:
            f.write(gzip.compress(r))
    with open(os.path.join(d, "c.wet"), "wb") as f:
        f.write(_warc_record("conversion", "http://e", b"plain \xff text"))
    records = read_warc(spark, d + "/*")
    texts = {(r["path"].rsplit("/", 1)[-1], r["target_uri"]): r["text"]
             for r in response_texts(records).collect()}
    for name in ("a.warc", "b.warc.gz"):
        assert texts[(name, "http://a")] == "Hello & bye"
        assert texts[(name, "http://b")] == "no header here"
        assert texts[(name, "http://d")] == "café"
        assert (name, "http://c") not in texts          # empty body skipped
    wet = conversion_texts(records).collect()
    assert [r["text"] for r in wet] == ["plain � text"]


def test_charset_of_header_page_or_fallback(spark):
    from quarry.functions.html import decode_bytes
    cases = [  # content, header, text
        ("Привет".encode(), "charset=koi8-r", "Привет"),  # valid UTF-8 stays
        ("Привет".encode("cp1251"), "Content-Type: text/html; charset=windows-1251", "Привет"),
        ('<meta charset="gbk">你好'.encode("gbk"), "", '<meta charset="gbk">你好'),
        ("<meta content='text/html; charset=Shift_JIS'>日本".encode("shift_jis"), None, "<meta content='text/html; charset=Shift_JIS'>日本"),
        ("é".encode("latin-1"), "charset=no-such-set", "é"),
        ("é".encode("latin-1"), None, "é"),
        (b"", None, ""),
        (None, "charset=gbk", None),
    ]
    df = spark.createDataFrame([(i, bytearray(c) if c is not None else None, h) for i, (c, h, _) in enumerate(cases)],
                               "i int, content binary, header string")
    got = {r["i"]: r["t"] for r in df.select("i", decode_bytes("content", "header").alias("t")).collect()}
    assert got == {i: t for i, (_, _, t) in enumerate(cases)}


def test_pages_roundtrip_through_warc(spark):
    from quarry.sources import tables
    from quarry.sources.warc import pages_as_warc, records_from_files, response_texts
    from tests.conftest import SF001
    pages = tables.pages(spark, SF001)
    rec = response_texts(records_from_files(pages_as_warc(pages)))
    got = {r["target_uri"]: r["html"] for r in rec.collect()}
    exp = {r["url"]: r["html"] for r in pages.collect()}
    assert got == exp


def test_wiki_json_source_and_sentinel_sink(spark):
    from quarry.plans.wiki import extraction_counters, process_articles
    from quarry.sources.corpus import read_wiki_json
    from quarry.sources.sinks import write_sentinel_text
    d = tempfile.mkdtemp(prefix="quarry-wiki-")
    body = "Alpha beta gamma delta. " * 30
    lines = ['{"title": "Good", "text": "' + body + '== Notes ==\\nrefs"}',
             "{broken json",
             '{"title": null, "text": "short"}',
             '{"title": "Category:Things", "text": "' + body + '"}']
    with open(os.path.join(d, "part.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    arts = read_wiki_json(spark, d)
    assert arts.count() == 3
    p = process_articles(arts)
    c = extraction_counters(p).first()
    assert (c["n_processed"], c["n_kept"], c["n_skipped"]) == (3, 1, 1)
    kept = p.filter(F.col("status") == "kept").first()
    assert kept["out"].startswith("GoodAlpha beta") and kept["out"].endswith("\n<|endoftext|>\n")
    assert "Notes" not in kept["cleaned"]
    out = tempfile.mkdtemp(prefix="quarry-k1-") + "/corpus"
    write_sentinel_text(p.filter(F.col("status") == "kept").withColumn("doc_id", F.col("ord")),
                        out, text="cleaned")
    txt = "".join(r["value"] + "\n" for r in spark.read.text(out).collect())
    assert txt.endswith("<|endoftext|>\n")


def test_tokenizer_files_roundtrip(spark):
    from quarry.operators import tokenizer as tok
    from quarry.sources.sinks import save_model
    df = spark.createDataFrame([("the cat the hat then",)], "text string")
    model = tok.train_bpe(tok.pretoken_counts(df), 256 + 3 + 6)
    d = tempfile.mkdtemp(prefix="quarry-tok-")
    save_model(spark, model, d + "/vocab", d + "/merges")
    # one malformed merges line must be skipped
    with open(d + "/merges_extra.txt", "w") as f:
        f.write("zz\n")
    loaded = tok.load_model(spark, d + "/vocab", d + "/merges")
    assert loaded.merges == model.merges
    assert loaded.bytes_to_id() == model.bytes_to_id()


def test_streaming_matches_batch(spark):
    from quarry.sources import tables
    from quarry.streaming.clean_stream import clean_documents, start_clean_stream
    from tests.conftest import SF001
    docs = tables.documents(spark, SF001).select("doc_id", "text")
    import shutil
    src = tempfile.mkdtemp(prefix="quarry-stream-src-")
    shutil.copy(SF001 + "/documents.parquet", src + "/part-0.parquet")   # a folder of arriving files
    out = tempfile.mkdtemp(prefix="quarry-stream-") + "/out"
    q = start_clean_stream(spark, src, out,
                           spark.read.parquet(SF001 + "/documents.parquet").schema,
                           checkpoint=tempfile.mkdtemp(prefix="quarry-sckpt-"))
    q.awaitTermination(300)
    got = {r["doc_id"]: r["text"] for r in spark.read.parquet(out).select("doc_id", "text").collect()}
    exp = {r["doc_id"]: r["text"] for r in clean_documents(docs).collect()}
    assert got == exp and len(got) > 0


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and "lang" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_windows_property(spark):
    from quarry.operators.windows import doc_windows, flat_tokens, pack_windows
    toks = spark.createDataFrame([(i, list(range(i * 10, i * 10 + 7))) for i in range(5)],
                                 "doc_id long, ids array<int>")
    flat = flat_tokens(toks)
    n = flat.count()
    w = pack_windows(flat, 4, n).collect()
    stream = [x for i in range(5) for x in range(i * 10, i * 10 + 7)]
    assert len(w) == (n - 1) // 4
    for r in w:
        s = r["start"]
        assert r["x"] == stream[s:s + 4] and r["y"] == stream[s + 1:s + 5]
    dw = {r["window_id"]: (r["x"], r["y"]) for r in doc_windows(toks, 4).collect()}
    assert dw == {r["window_id"]: (r["x"], r["y"]) for r in w}
    from quarry.operators.windows import doc_random_windows, random_windows, rank_shards, shard_summary
    a = {r["k"]: (r["start"], r["x"], r["y"]) for r in random_windows(flat, n, 6, 4, seed=1).collect()}
    b = {r["k"]: (r["start"], r["x"], r["y"]) for r in doc_random_windows(toks, 6, 4, seed=1).collect()}
    assert a == b and all(v[1] == stream[v[0]:v[0] + 4] for v in a.values())
    per_tok = {r["rank"]: r["c"] for r in rank_shards(flat, n, 3).groupBy("rank")
               .agg(F.count(F.lit(1)).alias("c")).collect()}
    assert per_tok == {r["rank"]: r["n_tokens"] for r in shard_summary(toks, 3).collect()}


def _archive(records, folder, name, packed):
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        for r in records:
            f.write(gzip.compress(r) if packed else r)
    return path


def test_warc_type_filter_reaches_the_scan(spark):
    from quarry.sources.warc import read_warc
    d = tempfile.mkdtemp(prefix="quarry-warc-")
    recs = [_warc_record(k, f"http://{i}", b"x" * i) for i, k in enumerate(["response", "request", "warcinfo", "response"] * 5)]
    _archive(recs, d, "a.warc.gz", True)
    _archive(recs[:3], d, "b.warc", False)
    records = read_warc(spark, d)
    plan = records.filter("warc_type = 'response'")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters" in plan and "EqualTo(warc_type,response)" in plan.replace(" ", ""), plan
    assert "Filter (" not in plan, plan  # nothing left to filter above the scan
    got = records.filter("warc_type = 'response'").collect()
    assert {r.warc_type for r in got} == {"response"} and len(got) == 11
    assert sorted(r.record_no for r in got if r.path.endswith("gz")) == [i for i in range(20) if i % 4 in (0, 3)]
    assert records.filter("warc_type in ('request', 'warcinfo') and length(content) > 5").count() == sum(i % 4 in (1, 2) and i > 5 for i in range(20))
    assert read_warc(spark, d, types=["request"]).filter("warc_type = 'response'").count() == 0
    assert read_warc(spark, d, types=["request"]).count() == 6


def test_warc_stream_reads_in_small_pieces():
    """Members and records across chunk borders, damage, missing lengths, a body far larger than a chunk."""
    import io
    import random

    from quarry.sources import warc
    rnd = random.Random(5)
    bodies = [bytes(rnd.randrange(256) for _ in range(n)) for n in (0, 1, 5, 70_000, 3)] + [b"\0" * (9 << 20), b"WARC/1.0 inside"]
    recs = [_warc_record("response", f"http://{i}", b) for i, b in enumerate(bodies)]
    plain = b"".join(recs)
    packed = b"".join(gzip.compress(r) for r in recs)
    one = gzip.compress(plain)
    most = 0

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 1000))

    for data in (plain, packed, one):
        got = [(no, body) for no, _, _, _, body in warc.stream_records(Slow(data))]
        assert got == list(enumerate(bodies))
        most = max(most, len(got))
        assert [no for no, *_ in warc.stream_records(Slow(data), {"none"})] == []
    cut = packed[:len(gzip.compress(recs[0])) + len(gzip.compress(recs[1])) + 5] + b"broken"
    assert [r[4] for r in warc.stream_records(io.BytesIO(cut))] == bodies[:2]
    assert list(warc.stream_records(io.BytesIO(b""))) == []
    assert list(warc.stream_records(io.BytesIO(b"no archive at all"))) == []
    odd = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: many\r\n\r\n" + recs[1]
    assert [r[4] for r in warc.stream_records(io.BytesIO(odd))] == [b"", bodies[1]]


def test_warc_task_memory_does_not_grow_with_the_file():
    """60 MB of records pass through the reader with a few MB of live Python memory."""
    import tracemalloc

    from quarry.sources.warc import WarcReader
    from pyspark.sql.datasource import InputPartition
    d = tempfile.mkdtemp(prefix="quarry-warc-")
    one = gzip.compress(_warc_record("response", "http://a", b"a" * 1_000_000))
    path = _archive([], d, "big.warc.gz", True)
    with open(path, "wb") as f:
        for _ in range(60):
            f.write(one)
    tracemalloc.start()
    rows = sum(b.num_rows for b in WarcReader([path], None).read(InputPartition(path)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 60 and peak < 40e6


SAMPLES = {
    "gb18030": "中文网页常常没有说明编码，所以程序必须根据字节判断它属于哪一种编码。",
    "big5": "這個網頁沒有說明編碼，所以程式必須根據位元組判斷它屬於哪一種。",
    "shift_jis": "このページには文字コードの指定がありません。プログラムが推定します。",
    "euc_jp": "このページには文字コードの指定がありません。プログラムが推定します。",
    "euc_kr": "이 페이지에는 문자 인코딩이 지정되어 있지 않으므로 프로그램이 추정합니다.",
    "koi8_r": "На этой странице не указана кодировка, поэтому программа определяет её сама.",
    "cp1251": "На этой странице не указана кодировка, поэтому программа определяет её сама.",
    "cp866": "На этой странице не указана кодировка, поэтому программа определяет ее сама.",
    "iso8859_5": "На этой странице не указана кодировка, поэтому программа определяет её сама.",
    "cp1252": "Cette page n’indique aucun codage ; le système doit donc le déterminer à partir des octets.",
    "cp1250": "Na této stránce není uvedeno kódování, a proto je program musí určit sám. Zażółć gęślą jaźń.",
    "cp1253": "Αυτή η σελίδα δεν αναφέρει κωδικοποίηση και το πρόγραμμα πρέπει να τη βρει.",
    "cp1255": "בדף הזה לא צוין קידוד ולכן התוכנית צריכה לזהות אותו בעצמה.",
    "cp1256": "هذه الصفحة لا تذكر الترميز ولذلك يجب على البرنامج أن يحدده بنفسه.",
    "cp874": "หน้านี้ไม่ได้ระบุการเข้ารหัส ดังนั้นโปรแกรมจึงต้องตรวจหาเอง",
}


def test_charset_is_detected_where_none_is_named(spark):
    from quarry.functions import charset
    from quarry.functions.html import decode_bytes
    rows = []
    for name, text in SAMPLES.items():
        page = f"<html><p>{text}</p><p>short ascii words in between, 1999</p></html>"
        raw = page.encode(name)
        assert charset.decode(raw) == page, (name, charset.detect(raw))
        rows.append((page, bytearray(raw)))
    df = spark.createDataFrame(rows, "page string, content binary")
    assert df.filter(decode_bytes("content") != F.col("page")).count() == 0
    assert charset.decode("日本語".encode("iso2022_jp")) == "日本語"
    assert charset.decode("é".encode("utf-16")) == "é"
    assert charset.decode(b"") == "" and charset.detect(b"plain") == "ascii"
    assert charset.decode(b"\x81\x8d\xff\x00", "no-such-set")  # something, no error


def test_character_references(spark):
    from quarry.functions.html import decode_references, html_to_text
    cases = {"&#8217; &#x27; &eacute; &mdash; &amp;lt; &amp;#39;": "’ ' é — &lt; &#39;", "&copy;&nbsp;&hearts;": "©\xa0♥",
             "a & b &unknown; &#xZZ; &": "a & b &unknown; &#xZZ; &", "none": "none", "&#0;&#128;": "�€"}
    df = spark.createDataFrame([(k,) for k in [*cases, None]], "t string")
    got = {r.t: r.d for r in df.select("t", decode_references("t").alias("d")).collect()}
    assert got == {**cases, None: None}
    one = spark.createDataFrame([("<p>x &lt;b&gt; y</p>&nbsp;<br>&rarr;",)], "h string").select(html_to_text("h").alias("t")).first().t
    assert one == "x <b> y\n→"
