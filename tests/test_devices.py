from datasheaf.plans import devices

HEADER = """
#define PERIPH_BASE 0x40000000UL
#define TIM1_BASE (PERIPH_BASE + 0x100UL)
#define TIM1 ((TIM_TypeDef *) TIM1_BASE)
#define TIM_CR1_CEN_Pos (0U)
#define TIM_CR1_CEN_Msk (0x1UL << TIM_CR1_CEN_Pos)
typedef struct { __IO uint32_t CR1; __IO uint32_t DR; } TIM_TypeDef;
"""


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_header_map(spark):
    got = devices.header_map(spark.createDataFrame([("h", HEADER)], "header string, text string"))
    assert rows(got) == [("h", "TIM1", 0x40000100, "CR1", 0, "CEN", 0, 1), ("h", "TIM1", 0x40000100, "DR", 4, None, None, None)]


def test_ordered_devices(spark):
    got = devices.ordered_devices({"name": ["STM32F405", "STM32F407"], "pin": ["R", "V"], "size": ["E", "G"]}, spark.createDataFrame([("STM32F405xG",), ("STM32F407V.",)], "t string"))
    assert [r[0] for r in rows(got)] == ["stm32f405rg", "stm32f405vg", "stm32f407ve", "stm32f407vg"]


def test_instances_and_maps(spark):
    instances = spark.createDataFrame([("d", "TIM1", "1.2", 0x100), ("d", "UART4", None, 0x200), ("e", "TIM1", "1.2", 0x100), ("d", "ODD", "9", 0)], "did string, instance string, section string, address bigint")
    types = spark.createDataFrame([("TIM", "9.9"), ("USART", None), ("IM", None)], "type string, section string")
    linked = devices.link_instances(instances, types)
    assert rows(linked.select("did", "instance", "type", "tier")) == [("d", "TIM1", "TIM", 1), ("d", "UART4", "USART", 3), ("e", "TIM1", "TIM", 1)]
    registers = spark.createDataFrame([("TIM", "CR", 0)], "type string, register string, offset bigint")
    fields = spark.createDataFrame([("TIM", "CR", "EN", 3), ("TIM", "CR", "EN", 5)], "type string, register string, field string, bit int")
    maps = devices.memory_map(linked, registers, fields)
    assert rows(maps)[0] == ("d", "TIM1", 0x100, "CR", 0, "EN", 3, 3)
    assert [r.devices for r in devices.compacted(maps).collect()] == [["d", "e"]]


def test_memories(spark):
    m = spark.createDataFrame([("f4", "RAM", 0, 100, "rw"), ("f4", "x.flm", 0, 1, "r"), ("g0", "RAM", 0, 100, "rw")], "did string, name string, address bigint, size bigint, access string")
    over = spark.createDataFrame([("g0", "sram", None, 50, None)], "pattern string, name string, address bigint, size bigint, access string")
    split = spark.createDataFrame([("f4", "sram", "backup", 10)], "pattern string, name string, new_name string, size bigint")
    got = devices.repaired_memories(m, {"ram": "sram"}, {"sram": "rwx"}, over, split)
    assert rows(got) == [("f4", "backup", 90, 10, "rwx"), ("f4", "sram", 0, 90, "rwx"), ("g0", "sram", 0, 50, "rwx")]


def test_signals_and_requests(spark):
    s = spark.createDataFrame([("PA0", 1, "TIM2_CH1-TIM2_ETR"), ("PA1", 2, "NOPE")], "pin string, af int, signal string")
    m = spark.createDataFrame([("TIM2", "tim", 2), ("TIM", "tim", None)], "module string, driver string, instance int")
    assert rows(devices.split_signals(s, m)) == [("PA0", 1, "tim", 2, "CH1"), ("PA0", 1, "tim", 2, "ETR")]
    r = spark.createDataFrame([("SPI1_RX", 5), ("DAC1_CHANNEL2", 7), ("GENERATOR3", 4), ("FMAC_READ", 1), ("FMAC_RD", 9), ("HRTIM_TIMER_A", 2)], "name string, id int")
    same = {"SPI1_RX": 5, "DAC1_CHANNEL2": 7, "GENERATOR3": 4, "FMAC_READ": 1, "HRTIM_TIMER_A": 2}
    assert dict(rows(devices.request_map(r))) == same | {"DAC1_CH2": 7, "DMA_GENERATOR3": 4, "FMAC_RD": 1, "HRTIM1_A": 2}
    d = spark.createDataFrame([("d", "DMA2_Stream3", "DMA_CHANNEL_4", "a", 1), ("d", "DMA2_Stream3", "DMA_CHANNEL_4", "b", 2), ("d", "DMA2_Stream3", "DMA_CHANNEL_4", "a", 3)], "did string, parent string, name string, signal string, ord int")
    assert rows(devices.dma_channels(d)) == [("d", 2, 3, 4, ["b", "a"])]
    listed = spark.createDataFrame([("PA0", "TIM2_CH1-TIM2_ETR", 1)], "pin string, signal string, af int")
    assert rows(devices.with_alternate_functions(s.drop("af"), listed).select("pin", "af")) == [("PA0", 1), ("PA1", -1)]


def test_documents(spark):
    d = spark.createDataFrame([("stm32f405rgt7",), ("stm32f407vgt6",)], "did string")
    docs = spark.createDataFrame([("stm32f405rgt6", "DS1"), ("stm32f407vgt6", "DS2")], "device string, doc string")
    assert rows(devices.documents_of(d, docs)) == [("stm32f405rgt7", "DS1", 2), ("stm32f407vgt6", "DS2", 0)]
    rules = spark.createDataFrame([(None, "1.8 V", "24 MHz"), (None, "1.8 V", "16 MHz"), ("f4", "2.7 V", "x")], "filter string, voltage string, frequency string")
    assert rows(devices.flash_latency(rules)) == [("", 1800, [16_000_000, 24_000_000])]
    t = spark.createDataFrame([("TIM", ["stm32f4.*"]), ("ADC", None)], "type string, patterns array<string>")
    assert rows(devices.filtered_types(t, d.limit(1)).select("type")) == [("ADC",), ("TIM",)]
    recs = devices.device_records({"pins": spark.createDataFrame([("d", "PA0")], "did string, pin string")})
    assert recs.first().pins[0].pin == "PA0"


def test_captions(spark):
    items = spark.createDataFrame([("d", "About STM32F405/415", None), ("d", "", "Table 1 STM32F407xx")], "doc string, html string, caption string")
    assert {r.device for r in devices.devices_in_captions(items).collect()} == {"STM32F405", "STM32F415", "STM32F407xx"}
