import lzma
import zipfile

from pyspark.sql import functions as F

from datasheaf.__main__ import parser, run
from datasheaf.sources import archives

PAGE = "<h1>Pins</h1><table><caption>Table 1. Pins</caption><tr><th>Pin</th></tr><tr><td>PA0 &amp; PA1</td></tr></table>"
HEADER = "#define B 0x10\n#define T1 ((T_TypeDef *) B)\n#define T_CR_EN_Pos 1U\n#define T_CR_EN_Msk (1UL << T_CR_EN_Pos)\ntypedef struct { uint32_t CR; } T_TypeDef;\n"


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("db/mcu/x.xml", "a  \r\nb\t\r\n")
        z.writestr("db/other.xml", "no")
        z.writestr("readme", "no")
    (tmp_path / "b.zip").write_bytes(b"none")
    got = archives.read_zip(spark, f"{tmp_path}/*.zip", ("db/mcu/",), r"\.xml$").select("member", archives.text_of("content").alias("t")).collect()
    assert [(r.member, r.t) for r in got] == [("db/mcu/x.xml", "a\nb\n")]
    (tmp_path / "v.xml.xz").write_bytes(lzma.compress(b"<v/>"))
    assert archives.read_lzma(spark, f"{tmp_path}/*.xz").first().content == b"<v/>"
    versions = spark.createDataFrame([("2.9.1",), ("2.10",)], "version string")
    assert archives.newest(versions).first().version == "2.10"


def test_jobs(spark, tmp_path):
    folder = tmp_path / "html" / "DS1-v2"
    folder.mkdir(parents=True)
    (folder / "chapter_1_pins.html").write_text(PAGE)
    out = str(tmp_path / "out")
    run(spark, parser().parse_args(["tables", str(tmp_path / "html"), out]))
    assert spark.read.parquet(out).count() == 2
    run(spark, parser().parse_args(["search", str(tmp_path / "html"), out, "--caption", "pins"]))
    assert "PA0 & PA1" in spark.read.text(out).agg(F.concat_ws("", F.collect_list("value"))).first()[0]
    (tmp_path / "h.h").write_text(HEADER)
    run(spark, parser().parse_args(["headers", str(tmp_path / "h.h"), out]))
    run(spark, parser().parse_args(["registers", f"{out}/xml/device=h.h", f"{out}/rows"]))
    r = spark.read.parquet(f"{out}/rows").first()
    assert (r.peripheral, r.address, r.register, r.field, r.position, r.width_bits) == ("T1", 16, "CR", "EN", 1, 1)
    (tmp_path / "r.json").write_text('{"rows": [{"title": "DS1", "version": "1.0"}]}')
    run(spark, parser().parse_args(["sync", str(tmp_path / "r.json"), str(tmp_path / "none"), f"{out}/new"]))
    assert spark.read.json(f"{out}/new").count() == 1
