import csv

from pyspark.sql import functions as F

from quorumtext.__main__ import arguments, manifest, run
from quorumtext.plans.options import PipelineOptions
from quorumtext.streaming import pages as streaming


def test_dry_run_and_validation(tmp_path, capsys):
    assert run(arguments(["run", "--engine", "paddleocr", "--dry-run"])) == 0 and "ocr_fallback: paddle" in capsys.readouterr().out
    assert run(arguments(["run", "--force-ocr", "--dry-run"])) == 0 and "force_ocr: True" in capsys.readouterr().out
    assert run(arguments(["run", "--force-ocr", "--engine", "other", "--dry-run"])) == 2 and "fallback" in capsys.readouterr().err
    assert run(arguments(["run", "-c", str(tmp_path / "none.json"), "--validate-only"])) == 1
    assert run(arguments(["run", "--input-dir", "data/input", "--output-dir", "o", "--engine", "paddleocr", "--force-ocr", "--progress-csv", "p.csv", "--status-bar", "--dry-run"])) == 0
    said = capsys.readouterr().out
    assert "Mapped command:" in said and "--inputs data/input --output-root o --prefer-text-layer --ocr-fallback paddle --force-ocr --status-bar --progress-csv p.csv" in said
    assert run(arguments(["run", "--dry-run", "--", "--ocr-fallback", "none"])) == 0 and "--ocr-fallback ensemble --ocr-fallback none" in capsys.readouterr().out
    assert PipelineOptions.resolve({}, passthrough=("--ocr-fallback", "none", "--output-root", "x")).settled() == PipelineOptions(ocr_fallback=None, output_root="x")
    assert run(arguments(["run", "--validate-only"])) == 0


def test_manifest_command(spark, tmp_path, capsys):
    (tmp_path / "sample.pdf").write_bytes(b"x")
    (tmp_path / "gold.csv").write_text("PDF LINK,PAGE\nsample.pdf,1-3\nmissing.pdf,4\n")
    go = lambda *more: manifest(arguments(["manifest", "--csv", str(tmp_path / "gold.csv"), "--pdf-root", str(tmp_path), "--out", str(tmp_path / "m.tsv"), "--expand-ranges", *more]))
    assert go("--strict") == 1 and "missing.pdf" in capsys.readouterr().err
    assert [line.split("\t")[1] for line in (tmp_path / "m.tsv").read_text().splitlines()] == ["1", "2", "3"]
    assert go() == 0 and len((tmp_path / "m.tsv").read_text().splitlines()) == 4


def test_run_command(spark, tmp_path, capsys):
    pages = [(1, "a.pdf", 1, 520.0, "sa-ra-am i-na-an e-li-su DUMU\nplain trailing text", True), (2, "a.pdf", 2, 520.0, "", False)]
    spark.createDataFrame(pages, "page_id long, pdf_name string, page int, page_width double, layer_text string, layer_ok boolean").write.parquet(str(tmp_path / "pages"))
    line = "page_id long, angle int, angle_ord int, engine string, variant string, variant_ord int, line_no int, text string, bbox struct<x0:double,y0:double,x1:double,y1:double>, raw_confidence double"
    spark.createDataFrame([(2, 0, 0, e, "original", 0, 0, "read by engines", None, 0.9) for e in ("paddle", "doctr")], line).write.parquet(str(tmp_path / "lines"))
    more = ["--progress-csv", str(tmp_path / "progress.csv"), "--status-bar"]
    assert run(arguments(["run", "--pages", str(tmp_path / "pages"), "--lines", str(tmp_path / "lines"), "--output-dir", str(tmp_path / "out"), *more])) == 0
    assert "2 pages" in capsys.readouterr().err
    progress = list(csv.DictReader(open(tmp_path / "progress.csv", encoding="utf-8", newline="")))
    assert [(r["pdf_name"], r["page"], r["used_text_layer"], r["has_akkadian"]) for r in progress] == [("a.pdf", "1", "True", "True"), ("a.pdf", "2", "False", "False")]
    assert all(int(r["ms"]) >= 0 and len(r["timestamp"]) == 26 for r in progress)
    rows = list(csv.DictReader(open(tmp_path / "out/client_page_text.csv", encoding="utf-8-sig")))
    assert [(r["page"], r["has_akkadian"]) for r in rows] == [("1", "true"), ("2", "false")] and rows[1]["page_text"] == "read by engines"


def test_throughput_by_window(spark, tmp_path):
    times = ["2024-01-01 00:01:00", "2024-01-01 00:02:00", "2024-01-01 00:31:00"]
    rows = spark.createDataFrame([("a.pdf", i, "x", True, 5, t) for i, t in enumerate(times)], "pdf_name string, page int, text string, used_text_layer boolean, ms long, t string").withColumn("landed_at", F.to_timestamp("t")).drop("t")
    rows.write.parquet(str(tmp_path / "in"))
    q = streaming.throughput(streaming.landed_pages(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("throughput").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.pages, r.ms) for r in spark.sql("select * from throughput").collect()) == [(1, 5), (2, 10)]
