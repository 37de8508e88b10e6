from pyspark.sql import functions as F

from datasheaf.functions import geometry, maps, text


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_replace_and_listify(spark):
    r = one(
        spark,
        text.replace_subs(F.lit("<b>A</b><sub>1</sub>x"), [("x", "y")], {"sub": "_$1"}).alias("a"),
        text.listify(F.lit(" PA0, PA1<br>PA2/ PA3 ")).alias("b"),
        text.listify(F.lit(None).cast("string")).alias("c"),
    )
    assert r.a == "A_1y" and r.b == ["PA0", "PA1", "PA2", "PA3"] and r.c == []


def test_names(spark):
    r = one(
        spark,
        text.expand_combo(F.lit("STM32F405/417")).alias("combo"),
        text.device_pattern(F.lit("Table of STM32F405xx/07xx and STM32F2x")).alias("pattern"),
        text.split_package(F.lit("LQFP64")).alias("package"),
        text.split_package(F.lit("none")).alias("no_package"),
        text.parse_device(F.lit("STM32F405RGT6@m4")).alias("did"),
        text.format_device(text.parse_device(F.lit("STM32F405RGT6@m4"))).alias("back"),
        text.pin_name(F.lit("PA12")).alias("pin"),
        text.clean_version(F.lit("foo_v2_1_Cube")).alias("version"),
        text.slug(F.lit("3.1 Low-power  modes (²)")).alias("slug"),
    )
    assert r.combo == ["STM32F405", "STM32F417"]
    assert r.pattern == "stm32f2.|stm32f405..|stm32f407.."
    assert tuple(r.package) == ("LQFP64", "LQFP", 64) and r.no_package is None
    assert (r.did.family, r.did.name, r.did.pin, r.did.temperature, r.did.core) == ("f4", "05", "r", "6", "m4")
    assert r.back == "stm32f405rgt6@m4"
    assert tuple(r.pin) == ("a", 12) and r.version == "v2_1" and r.slug == "low_power_modes_2"


def test_numbers(spark):
    r = one(spark, *[text.number_of(F.lit(x)).alias(f"n{i}") for i, x in enumerate(["0x1F", "0b101", "12", "0x20UL", "x"])], text.quantity(F.lit("up to 1.8 V")).alias("mv"), text.quantity(F.lit("84 MHz")).alias("hz"))
    assert [r.n0, r.n1, r.n2, r.n3, r.n4] == [31, 5, 12, 32, None] and r.mv == 1800 and r.hz == 84_000_000


def test_maps(spark):
    m = F.create_map(F.lit("AF0:SYS"), F.lit("a"), F.lit("AF1:TIM"), F.lit("b"))
    f = F.create_map(F.lit("device"), F.array(F.lit("f4.*"), F.lit("g0")), F.lit("absent"), F.array(F.lit("x")))
    blank = lambda x: x == ""
    r = one(
        spark,
        maps.match_value(m, "tim").alias("v"),
        maps.match_keys(m, "af").alias("keys"),
        maps.overlay(m, F.create_map(F.lit("AF1:TIM"), F.lit("c"))).alias("over"),
        maps.any_filter(f, F.create_map(F.lit("device"), F.lit("f405"))).alias("hit"),
        maps.any_filter(f, F.create_map(F.lit("device"), F.lit("l4"))).alias("miss"),
        maps.any_filter(f, F.create_map(F.lit("other"), F.lit("l4"))).alias("none"),
        maps.strip(F.array(*[F.lit(x) for x in ("", "a", "", "b", "")]), blank).alias("strip"),
        maps.strip(F.array(F.lit(""), F.lit("")), blank).alias("all"),
    )
    assert r.v == "b" and len(r.keys) == 2 and r.over == {"AF0:SYS": "a", "AF1:TIM": "c"}
    assert r.hit and not r.miss and r.none
    assert r.strip == ["a", "", "b"] and r["all"] == []


def test_geometry(spark):
    def box(*v):
        return F.struct(*[F.lit(float(x)).alias(k) for k, x in zip(("x0", "y0", "x1", "y1"), v, strict=True)])

    cross_a, cross_b = box(0, 4, 10, 6), box(4, 0, 6, 10)
    r = one(
        spark,
        geometry.overlaps(cross_a, cross_b).alias("true_overlap"),
        geometry.overlaps_compat(cross_a, cross_b).alias("compat"),
        geometry.joined(cross_a, cross_b).alias("joined"),
        geometry.mask_width(F.lit(0xF0).cast("bigint"), F.lit(4)).alias("width"),
        geometry.direction(F.struct(F.lit(0.0).alias("x"), F.lit(1.0).alias("y")), F.struct(F.lit(5.0).alias("x"), F.lit(1.0).alias("y"))).alias("direction"),
        geometry.interval_overlaps(F.lit(0), F.lit(2), F.lit(2), F.lit(3)).alias("touch"),
    )
    assert r.true_overlap and not r.compat and tuple(r.joined) == (0, 0, 10, 10)
    assert r.width == 4 and r.direction == "horizontal" and not r.touch


def test_vendor_rules(spark):
    def of(value, column):
        return spark.createDataFrame([(value,)], "v string").select(column).first()[0]

    assert of("<p>USART1_IRQn</p><p>EXTI[9:5]</p>", text.vector_names("v")) == ["USART1", "EXTI9_5"]
    assert of("0x00 to 0x0C", text.fold("v", text.OFFSET_RULES)) == "0x00-0x0C"
    assert of("CCMR1 Output compare mode", text.fold("v", text.REGISTER_RULES)) == "CCMR1_Output"
    assert of("Reserved", text.fold("v", text.REGISTER_RULES)) == ""
    assert of("DR [15:0]", text.fold("v", text.FIELD_RULES)) == "DR"
    assert of("USB OTG FS", text.fold("v", text.PERIPHERAL_RULES)) == "USB_OTG_FS"
    assert of("SPI2/I2S2", text.fold("v", text.PERIPHERAL_RULES)) == "SPI2"
    assert of("MOSII2S", text.fold("v", text.SIGNAL_RULES)) == "MOSI,I2S"
    assert [tuple(p) for p in of("Pin:LPQF48 or UFQFN32", text.packages("v"))] == [("LQFP48", "LQFP48", "LQFP", 48), ("UFQFPN32", "UFQFPN32", "UFQFPN", 32)]
    assert [p.name for p in of("Pin:STM32F40x, STM32F41x:LQFP64 SMPS", text.packages("v"))] == ["LQFP64+SMPS+STM32F40.|STM32F41."]
    assert [of(d, text.hal_folder("v")) for d in ("stm32f407vgt6", "stm32h7r3", "stm32wb09")] == ["f4xx", "h7rsxx", "wb0x"]
    assert [of(d, text.memory_name("v")) for d in ("irom1", "x_eeprom.flm", "ccm")] == ["flash", "eeprom", "ccm"]


def test_listify_keeps_digits(spark):
    assert spark.createDataFrame([("00 11,/ 22<br>30 04",)], "v string").select(text.listify("v")).first()[0] == ["00", "11", "22", "30", "04"]
