import datetime
import gzip

from pyspark.sql import functions as F

from millrace.sources import lines as S

GOOD = '127.0.0.1 - - [01/Aug/1995:00:00:01 -0400] "GET /images/x.gif HTTP/1.0" 200 1839'
NO_SIZE = 'host.x - - [31/Dec/1995:23:59:59 -0400] "GET / " 404 -'
STRAY = 'h - - [01/Aug/1995:00:00:01 -0400] "GET /a HTTP/1.0 " 200 5'
BAD_MONTH = 'h - - [01/Foo/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5'
BAD_SIZE = 'h - - [01/Aug/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5x'


def frame(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_log_fields(spark):
    rows = {r["value"]: r for r in S.parse_log(frame(spark, GOOD, NO_SIZE)).collect()}
    good = rows[GOOD]
    assert (good["host"], good["method"], good["endpoint"], good["protocol"]) == (
        "127.0.0.1", "GET", "/images/x.gif", "HTTP/1.0")
    assert good["date_time"] == datetime.datetime(1995, 8, 1, 0, 0, 1)
    assert (good["response_code"], good["content_size"], good["status"]) == (200, 1839, 1)
    assert rows[NO_SIZE]["content_size"] == 0
    assert rows[NO_SIZE]["status"] == 1


def test_log_grammars_and_rejects(spark):
    rows = frame(spark, GOOD, STRAY, BAD_MONTH, BAD_SIZE, "nonsense")
    strict, relaxed = S.parse_log(rows, S.LOG_STRICT), S.parse_log(rows)
    assert strict.filter("status = 1").count() == 1
    assert relaxed.filter("status = 1").count() == 2
    assert {r["status"]: r["n"] for r in S.status_counts(relaxed).collect()} == {1: 2, 0: 3}
    assert [r["value"] for r in S.rejects(relaxed, 0, 20).collect()] == sorted(
        [BAD_MONTH, BAD_SIZE, "nonsense"])
    assert relaxed.filter("value = 'nonsense'").first()["host"] is None


def test_log_grammar_runs_once(spark):
    plan = S.parse_log(frame(spark, GOOD)).filter("status = 1 and response_code <> 200")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_replace") == 1


def test_log_parser_on_a_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.log").write_text(GOOD + "\nnonsense\n")
    stream = S.parse_log(spark.readStream.text(str(folder)))
    query = (stream.select("status").writeStream.format("memory").queryName("parsed_stream")
             .option("checkpointLocation", str(tmp_path / "state")).start())
    query.processAllAvailable()
    query.stop()
    assert sorted(r["status"] for r in spark.table("parsed_stream").collect()) == [0, 1]


def test_products(spark):
    rows = frame(
        spark, '"id","title","description","manufacturer","price"',
        '"b1","a title","words, more","maker",9.99', "broken")
    got = {r["value"]: r for r in S.parse_products(rows).collect()}
    assert sorted(r["status"] for r in got.values()) == [-1, 0, 1]
    record = [r for r in got.values() if r["status"] == 1][0]
    import re
    m = re.search('^(.+),"(.+)",(.*),(.*),(.*)', record["value"])  # greedy groups
    assert record["id"] == m.group(1).replace('"', "")
    assert record["text"] == f"{m.group(2)} {m.group(3)} {m.group(4)}"


def test_gold(spark):
    rows = frame(spark, '"idAmazon","idGoogleBase"', '"b1","http://g/1"', "single")
    got = S.parse_gold(rows).orderBy("status").collect()
    assert [r["status"] for r in got] == [-1, 0, 1]
    assert (got[2]["a_id"], got[2]["g_id"]) == ("b1", "http://g/1")


def test_ratings_and_items(spark):
    got = S.parse_ratings(frame(spark, "1::914::3.0::978", "1::x::3", "7")).orderBy("value").collect()
    assert [r["status"] for r in got] == [1, -1, -1]
    assert (got[0]["usr"], got[0]["item"], got[0]["rating"]) == (1, 914, 3.0)
    item = S.parse_items(frame(spark, "1::Toy Story (1995)::Animation")).first()
    assert (item["item"], item["title"], item["status"]) == (1, "Toy Story (1995)", 1)


def test_labelled(spark):
    got = S.parse_labelled(frame(spark, "2001.0,0.5,0.25", "x,1")).orderBy("value").collect()
    assert (got[0]["label"], got[0]["features"], got[0]["status"]) == (2001.0, [0.5, 0.25], 1)
    assert got[1]["status"] == -1


def test_clicks_keep_blank_categories(spark):
    got = S.parse_clicks(frame(spark, "1\ta\t\tb\t", "0,x", "?,x")).collect()
    assert [(f["idx"], f["cat"]) for f in got[0]["feats"]] == [(0, "a"), (1, ""), (2, "b"), (3, "")]
    assert [r["status"] for r in got] == [1, 1, -1]


def test_series(spark):
    got = S.parse_series(frame(spark, " 3 4 1.5 2 \n", "3 y 1")).collect()
    assert (got[0]["x"], got[0]["y"], got[0]["series"]) == (3, 4, [1.5, 2.0])
    assert [r["status"] for r in got] == [1, -1]


def test_gzip_lines_are_dealt_out(spark, tmp_path):
    with gzip.open(tmp_path / "r.dat.gz", "wt") as out:
        out.write("".join(f"{i}::{i}::4.0\n" for i in range(100)))
    lines = S.read_lines(spark, str(tmp_path / "r.dat.gz"), partitions=3)
    assert lines.rdd.getNumPartitions() == 3
    assert S.parse_ratings(lines).filter(F.col("status") == S.VALID).count() == 100


def test_gzip_files_are_inflated_once_and_dealt_in_pieces(spark, tmp_path):
    lines = [f"{i}::{i % 7}::{i % 5}" for i in range(1000)]
    for k in (0, 1):
        with gzip.open(tmp_path / f"part-{k}.txt.gz", "wt") as out:
            out.write("\n".join(lines[500 * k : 500 * (k + 1)]) + "\n")
    found = S.read_compressed_lines(spark, str(tmp_path), 100)
    assert sorted(r["value"] for r in found.collect()) == sorted(lines)
    assert len(found.inputFiles()) == 10
    assert S.parse_ratings(found).filter("status = 1").count() == 1000


def test_expected_widths(spark):
    rows = [(1, "1.0,2.0,3.0"), (2, "1.0,2.0"), (3, "1.0,2.0,x"), (4, "1.0")]
    frame = spark.createDataFrame(rows, "id int, value string")
    status = lambda parsed: {r["id"]: r["status"] for r in parsed.collect()}
    assert status(S.parse_labelled(frame)) == {1: 1, 2: 1, 3: -1, 4: 1}
    assert status(S.parse_labelled(frame, 2)) == {1: 1, 2: -1, 3: -1, 4: -1}
    clicks = spark.createDataFrame([(1, "1,a,b"), (2, "0\ta\t"), (3, "1,a"), (4, "x,a,b")], "id int, value string")
    assert status(S.parse_clicks(clicks)) == {1: 1, 2: 1, 3: 1, 4: -1}
    assert status(S.parse_clicks(clicks, 2))[1] == 1 and status(S.parse_clicks(clicks, 2))[3] == -1
    series = spark.createDataFrame([(1, "0 1 5.0 6.0"), (2, "0 1 5.0"), (3, "0 x 5.0 6.0")], "id int, value string")
    assert status(S.parse_series(series)) == {1: 1, 2: 1, 3: -1}
    assert status(S.parse_series(series, 2)) == {1: 1, 2: -1, 3: -1}
