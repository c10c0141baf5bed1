import zipfile
from xml.etree import ElementTree

from pyspark.sql import functions as F

from harspan.operators import registry
from harspan.sinks import xlsx
from harspan.sources.delimited import read_strings, seen_keys
from harspan.streaming import dedup as streams

RAW = "customerName string, licNo string, licAddress string, licenseActivities array<string>, n int"


def test_cleaning_and_export(spark):
    df = spark.createDataFrame([("  A<BR/>B\n", "1", "x<br />y", ["p", "q"], 1), (None, None, None, None, None)], RAW)
    clean = registry.clean_fields(df).collect()
    assert (clean[0].customerName, clean[0].licAddress, clean[0].n) == ("A B", "x y", 1) and clean[1].customerName is None
    rows = registry.export_rows(df).collect()
    assert len(rows[0]) == 15 and rows[0]["Address"] == "x\ny" and rows[0]["Activities"] == "p\nq" and rows[1]["Company Name"] == "" and rows[0]["Manager"] == ""


def test_payload_records(spark):
    texts = ['{"results":[{"companyName":"","name":"N","licenseNumber":"5","issueDate":"05/03/2024","address":{"fullAddress":"F"},"manager":{"name":"M"}}, 7]}',
             '[{"business_name":"B","expiryDate":1704412800}]', '{"data":{"status":"S"}}', "x", None, "{}"]
    rows = registry.payload_records(spark.createDataFrame([(t,) for t in texts], "j string"), "j").collect()
    assert [(r.business_name, r.license_number, r.issue_date, r.expiry_date, r.address, r.manager, r.status) for r in rows] == [
        ("N", "5", "2024-03-05", None, "F", "M", ""), ("B", "", None, "2024-01-05", "", "", ""), ("", "", None, None, "", "", "S")]


def test_sheet_names_and_letters():
    used = set()
    assert [xlsx.sheet_name(n, used) for n in ("a/b", "A_B", "[]", "x" * 40, "x" * 40)] == ["a_b", "A_B_1", "sheet", "x" * 31, "x" * 29 + "_1"]
    assert [xlsx.letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_workbook(spark, tmp_path):
    df = spark.createDataFrame([("é<&\x01", 1, 1.5, None), ("=1", None, float("nan"), True)], "a string, b int, c double, `d.e` boolean")
    path = str(tmp_path / "w.xlsx")
    assert xlsx.write_workbook(path, [("One", df), ("one", df.where("false"))]) == {"One": 2, "one_1": 0}
    with zipfile.ZipFile(path) as book:
        for name in book.namelist():
            ElementTree.fromstring(book.read(name))
        text = book.read("xl/worksheets/sheet1.xml").decode()
    assert "é&lt;&amp;" in text and '<c r="B2" s="0"><v>1</v></c>' in text and "A1:D3" in text


def test_csv_to_workbook_and_seen_keys(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h,k\n1," K1 "\n"x\ny",\n')
    assert xlsx.csv_to_workbook(spark, str(tmp_path / "a.csv"), str(tmp_path / "a.xlsx")) == 2
    assert [r.key for r in seen_keys(spark, str(tmp_path / "a.csv")).collect()] == ["K1"]
    assert read_strings(spark, str(tmp_path / "a.csv")).dtypes == [("h", "string"), ("k", "string")]
    (tmp_path / "e.csv").write_text("")
    assert xlsx.csv_to_workbook(spark, str(tmp_path / "e.csv"), str(tmp_path / "e.xlsx")) == 0


def test_streaming_dedup_with_restart(spark, tmp_path):
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    schema = "i int, k string"
    batches = [[(1, "a"), (2, " a "), (3, None), (4, "")], [(5, "a"), (6, "b"), (7, None)]]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").json(source)
        stream = streams.first_of_stream(spark.readStream.schema(schema).json(source), "k")
        streams.write_files(stream, out, mark).awaitTermination()
    rows = sorted(r.i for r in spark.read.parquet(out).collect())
    assert [i for i in rows if i in (3, 4, 7)] == [3, 4, 7] and len([i for i in rows if i in (1, 2, 5)]) == 1 and 6 in rows


def test_streaming_csv_and_watermark(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(50)
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    bounded = streams.first_within(stream, "event_type", "ts", "3650 days").select("event_type", F.col("ts").cast("string").alias("ts"))
    streams.write_csv(bounded, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    found = spark.read.csv(str(tmp_path / "out"), header=True)
    assert found.count() == events.select("event_type").distinct().count()
