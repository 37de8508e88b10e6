import pytest
from pyspark.sql import functions as F

from datasheaf.sources import catalogue, cheader, html, sinks, xml
from datasheaf.streaming import sync

HEADER = """
/* comment #define NOT 1 */
#define BASE 0x40000000UL
#define OFF  (BASE + 0x400U) // here
#define TIM_CR1_CEN_Pos (0U)
#define TIM_CR1_CEN_Msk (0x1UL << TIM_CR1_CEN_Pos)
#define TIM_CR1_CKD_Pos (8U)
#define TIM_CR1_CKD_Msk (0x3UL << TIM_CR1_CKD_Pos)
#define LOOP LOOP2
#define LOOP2 LOOP
#define FLASH_SIZE (0x2000UL)
#define F(x) (x)
#define EVIL __import__("os")
typedef enum { Reset_IRQn = -15, WWDG_IRQn = 0, PVD_IRQn, TIM1_IRQn = 0x10, TIM2_IRQn } IRQn_Type;
typedef struct { __IO uint32_t CR1; uint32_t RESERVED[2]; __IO uint16_t CCR[2]; __IO uint32_t DR; } TIM_TypeDef;
"""


def test_header(spark, tmp_path):
    (tmp_path / "a.h").write_text(HEADER)
    h = cheader.read_headers(spark, str(tmp_path / "a.h")).cache()
    values = cheader.evaluated(cheader.defines(h)).cache()
    got = {r.name: r.value for r in values.collect()}
    assert got == {"BASE": 0x40000000, "OFF": 0x40000400, "TIM_CR1_CEN_Pos": 0, "TIM_CR1_CEN_Msk": 1, "TIM_CR1_CKD_Pos": 8, "TIM_CR1_CKD_Msk": 0x300, "FLASH_SIZE": 0x2000}
    assert {(r.name, r.position) for r in cheader.interrupts(cheader.enumerations(h)).collect()} == {("WWDG", 0), ("PVD", 1), ("TIM1", 16), ("TIM2", 17)}
    members = cheader.expanded_members(cheader.struct_members(h)).cache()
    assert {(r.name, r.offset) for r in members.collect()} == {("CR1", 0), ("CCR.0", 12), ("CCR.1", 14), ("DR", 16)}
    fields = cheader.fields_of(members, values)
    assert {(r.register, r.field, r.position, r.width) for r in fields.collect()} == {("CR1", "CEN", 0, 1), ("CR1", "CKD", 8, 2)}


@pytest.mark.parametrize(("text", "value"), [("1 << 4 | 2", 18), ("(uint8_t)0x1FF", 255), ("~0", 0xFFFFFFFF), ("2 + 3 * 4", 14), ("1 ? 5 : 6", 5), ("017", 15), ("-7 / 2", -3), ("(1 == 1) && 0", 0)])
def test_expressions(text, value):
    assert cheader.evaluate(text, {}) == value


@pytest.mark.parametrize("text", ["", "1 +", "f(1)", "1 / 0", "'a'", "1 << 99", "a.b", "(1"])
def test_no_expressions(text):
    with pytest.raises(cheader.NotConstant):
        cheader.evaluate(text, {})


def test_register_description_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [("dev", "TIM1", None, 0x40010000, "CR1", 0, 4, "CEN", 0, 1), ("dev", "TIM1", None, 0x40010000, "CR1", 0, 4, "CKD", 8, 2), ("dev", "TIM1", None, 0x40010000, "DR", 4, 2, "D<1>", 0, 16)],
        "device string, peripheral string, type string, address bigint, register string, offset bigint, width_bytes int, field string, position int, width_bits int",
    )
    (tmp_path / "d.xml").write_text(xml.format_registers(rows).first().xml)
    back = xml.read_registers(spark, str(tmp_path / "d.xml"))
    assert sorted(map(tuple, back.drop("type").collect())) == sorted(map(tuple, rows.drop("device", "type").collect()))


def test_xpath(spark):
    df = spark.createDataFrame([("<a xmlns='u'><b n='1'/><b n='1'/><b n='2'/></a>",), (None,)], "x string")
    assert [r[0] for r in df.select(xml.query(xml.strip_namespace(F.col("x")), "//b/@n")).collect()] == [["1", "2"], []]


def test_catalogue(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"rows": [{"title": "DS1", "localizedLinks": {"en": "/x.pdf"}, "version": "9.0"}, {"title": "RM2", "version": "1.0"}]}')
    remote = catalogue.read_remote(spark, [str(tmp_path / "r.json")], "https://host")
    assert {(r.filename, r.link) for r in remote.collect()} == {("DS1-v9.pdf", "https://host/x.pdf"), ("RM2-v1.pdf", None)}
    local = catalogue.read_local(spark, str(tmp_path / "none"))
    assert local.count() == 0 and catalogue.to_fetch(remote, local).count() == 2
    catalogue.write(remote, str(tmp_path / "l"))
    assert catalogue.to_fetch(remote, catalogue.read_local(spark, str(tmp_path / "l"))).count() == 0


def test_patches(spark):
    cells = spark.createDataFrame([("d", "1", 1, "a"), ("d", "2", 1, "a"), ("e", "1", 1, "a")], "doc string, version string, cell int, html string")
    patches = spark.createDataFrame([("d", None, 1, "g"), ("d", "2", 1, "s")], "doc string, version string, cell int, patch string")
    assert {(r.doc, r.version): r.html for r in catalogue.patched(cells, patches).collect()} == {("d", "1"): "g", ("d", "2"): "s", ("e", "1"): "a"}


def test_graph_round_trip(spark, tmp_path):
    tables_ = {"Package": spark.createDataFrame([("d", "LQFP64")], "did string, name string")}
    sinks.write_graph(tables_, str(tmp_path))
    assert sinks.read_graph(spark, str(tmp_path), ["Package"])["Package"].collect() == tables_["Package"].collect()


def test_folder(spark, tmp_path):
    d = tmp_path / "RM1-v3"
    d.mkdir()
    (d / "chapter_12_timers.html").write_text("<h1>T</h1>")
    r = html.read_folder(spark, str(tmp_path)).first()
    assert (r.doc, r.version, r.chapter, r.number) == ("RM1", "v3", "chapter 12 timers", "12")


def test_streaming(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet")
    src = tmp_path / "in"
    events.limit(50).write.parquet(str(src))
    store = str(tmp_path / "store")
    for _ in range(2):
        sync.sync_new(sync.read_new_files(spark, str(src), events.schema), store, "event_id", str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(store).count() == 50
    out = sync.run_once(sync.sessions(sync.read_new_files(spark, str(src), events.schema), "ts", "2 hours", "1 day", "user_id"), "s", str(tmp_path / "cp2"), "append")
    assert out.columns == ["user_id", "start", "end", "n"]


def test_macros_with_arguments_are_no_defines(spark):
    df = spark.createDataFrame([("a.h", "#define MACRO(x) x\n#define ONE 1\n")], "header string, text string")
    assert [r.name for r in cheader.defines(df).collect()] == ["ONE"]
