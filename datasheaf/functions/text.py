"""Text functions as Columns: rule folds, list splitting, names of devices, packages and pins. No Python runs on rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Inline tags that rich cell text may carry; each is stripped unless a rule says otherwise.
INLINE_TAGS = ("u", "i", "b", "sub", "sup", "br", "p")
Rule = tuple[str, str]


def _re(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def fold(text: Column | str, rules: Sequence[Rule]) -> Column:
    """Apply (pattern, replacement) rules one after the other."""
    out = _re(text)
    for pattern, replacement in rules:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def replace_subs(html: Column | str, rules: Sequence[Rule] = (), tags: Mapping[str, str] | None = None) -> Column:
    """Rich text to text (TXT-01). The inline tags come first, in fixed order: stripped, or, if ``tags`` has the tag, its element rewritten with ``\\1`` for the content. Then ``rules`` in the caller's order."""
    tags = tags or {}
    steps = [(f"(?s)<{t}>(.*?)</{t}>", tags[t]) if t in tags else (f"</?{t}>", "") for t in INLINE_TAGS]
    return fold(html, [*steps, *rules])


def listify(text: Column | str, pattern: str = r" |,|/|<br>", strip: bool = True) -> Column:
    """Split by a pattern, trim, drop what is empty (TXT-03). A null text has no parts."""
    parts = F.split(F.coalesce(_re(text), F.lit("")), pattern)
    return F.filter(F.transform(parts, lambda x: F.trim(x)) if strip else parts, lambda x: x != "")


def split_package(name: Column | str) -> Column:
    """struct(package, family, pins) of a package name such as LQFP64; null where it is none (TXT-10)."""
    name, pattern = _re(name), r"([A-Za-z]+)(\d+)"
    found = F.struct(F.regexp_extract(name, pattern, 0).alias("package"), F.regexp_extract(name, pattern, 1).alias("family"), F.expr("cast(null as int)").alias("pins"))
    found = found.withField("pins", F.regexp_extract(name, pattern, 2).try_cast("int"))
    return F.when(name.rlike(pattern), found)


def expand_combo(name: Column | str) -> Column:
    """``ABC405/407`` to [ABC405, ABC407]: a short variant replaces the end of the first name (TXT-11)."""
    parts = F.split(_re(name), "/")
    base = parts[0]
    return F.transform(parts, lambda p, i: F.when((i == 0) | (F.length(p) >= F.length(base)), p).otherwise(F.concat(F.left(base, F.length(base) - F.length(p)), p)))


def device_pattern(caption: Column | str, prefix: str = "STM32") -> Column:
    """All device names in a caption as one lower-case pattern: variants spelled out, sorted, ``x`` for any character (TXT-12)."""
    found = F.regexp_extract_all(_re(caption), F.lit(rf"{prefix}[\w/]+"), F.lit(0))
    names = F.array_sort(F.array_distinct(F.flatten(F.transform(found, expand_combo))))
    return F.lower(F.array_join(F.transform(names, lambda n: F.replace(n, F.lit("x"), F.lit("."))), "|"))


#: Places of a device name: field, first character (from 1), length.
DEVICE_FIELDS = (("platform", 1, 5), ("family", 6, 2), ("name", 8, 2), ("pin", 10, 1), ("size", 11, 1), ("package", 12, 1), ("temperature", 13, 1), ("variant", 14, 1))


def parse_device(name: Column | str, platform: str = "stm32") -> Column:
    """struct of a device name's fields; ``@core`` at the end is one more. Fails on other platforms and short names (TXT-13)."""
    text = F.lower(_re(name))
    head = F.substring_index(text, "@", 1)
    fields = [F.substring(head, at, n).alias(f) for f, at, n in DEVICE_FIELDS]
    core = F.when(F.instr(text, "@") > 0, F.substring_index(text, "@", -1)).otherwise(F.lit("")).alias("core")
    good = F.startswith(head, F.lit(platform)) & (F.length(head) >= 13)
    return F.when(good, F.struct(*fields, core)).otherwise(F.raise_error(F.concat(F.lit("no device name: "), text)))


def format_device(fields: Column, schema: Sequence[str] = tuple(f for f, _, _ in DEVICE_FIELDS)) -> Column:
    """Join the named fields; missing ones are empty (TXT-14)."""
    name = F.concat(*[F.coalesce(fields[f], F.lit("")) for f in schema])
    return F.when(F.coalesce(fields["core"], F.lit("")) != "", F.concat(name, F.lit("@"), fields["core"])).otherwise(name)


def clean_version(version: Column | str) -> Column:
    """The part like v1_3 of a version string, else the string (TXT-15)."""
    found = F.regexp_extract(_re(version), r"v[1-9]_[0-9x]", 0)
    return F.when(found != "", found).otherwise(_re(version))


def pin_name(pin: Column | str) -> Column:
    """struct(port, number) of a pin such as PA12; null where it is none (TXT-16)."""
    pin, pattern = _re(pin), r"^P([A-K])(\d{1,2})"
    return F.when(pin.rlike(pattern), F.struct(F.lower(F.regexp_extract(pin, pattern, 1)).alias("port"), F.regexp_extract(pin, pattern, 2).try_cast("int").alias("number")))


def pin_order(pin: Column | str) -> Column:
    """Sort key of pins: port letter, then number; what is no pin comes last (TXT-16, SRT-04)."""
    p = pin_name(pin)
    return F.struct(p.isNull().alias("other"), p["port"].alias("port"), p["number"].alias("number"), _re(pin).alias("pin"))


def split_signals(name: Column | str) -> Column:
    """Names joined by a dash, each a signal of its own (TXT-17)."""
    return F.filter(F.split(_re(name), "-"), lambda x: x != "")


def visible_glyph(code: Column | str) -> Column:
    """Code point of a glyph as text has it: null for carriage return and registered sign, dash and bullet for their stand-ins (TXT-21)."""
    code = _re(code)
    return F.when(code.isin(0x0D, 0xAE), None).when(code == 2, 0x2D).when(code.isin(61623, 61664), 0x2022).otherwise(code)


def slug(title: Column | str) -> Column:
    """File stem of a heading: no digits or punctuation, blanks as single underscores (TXT-22)."""
    return F.lower(fold(F.translate(_re(title), "²", "2"), [(r"^[\d.\s]+", ""), (r"[(){}\[\]/.,:;+*'\"&-]", " "), (r"\s+", "_"), (r"_+", "_"), (r"^_|_$", "")]))


def file_name(title: Column | str) -> Column:
    """Characters that file systems object to, replaced one for one (TXT-23)."""
    return F.translate(_re(title), "/\\:*?\"<>| ", "__________")


def number_of(text: Column | str) -> Column:
    """Integer in decimal, 0x or 0b notation, underscores allowed; null where it is none (TXT-25)."""
    text = F.regexp_replace(F.lower(F.trim(_re(text))), r"[_ ]|u?l*$", "")
    digits = F.substring(text, 3, 64)
    return (
        F.when(text.rlike(r"^0x[0-9a-f]+$"), F.conv(digits, 16, 10).try_cast("bigint"))
        .when(text.rlike(r"^0b[01]+$"), F.conv(digits, 2, 10).try_cast("bigint"))
        .when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    )


#: Scale to the base unit: millivolts and hertz.
UNITS = {"mv": 1, "v": 1000, "hz": 1, "khz": 1_000, "mhz": 1_000_000, "ghz": 1_000_000_000}


def quantity(text: Column | str) -> Column:
    """First ``number unit`` in the text, scaled to mV or Hz, rounded (TXT-25)."""
    pattern = r"(?i)(\d+(?:\.\d+)?)\s*(mv|v|khz|mhz|ghz|hz)\b"
    scale = F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv])
    unit = F.lower(F.regexp_extract(_re(text), pattern, 2))
    return F.when(unit != "", F.round(F.regexp_extract(_re(text), pattern, 1).try_cast("double") * F.try_element_at(scale, unit)).cast("bigint"))


# ---- normaliser rule tables: fixed values, in the vendor's notation ----------

VECTOR_TAGS = {"p": "$1,"}  # TXT-05
VECTOR_RULES: tuple[Rule, ...] = (
    (r" +", ""),
    (r"\(.*?\)|_IRQn|_$|^-$|[Rr]eserved", ""),
    (r"\+|and", ","),
    (r"_(\w+)(LSE|BLE|I2C\d)_", "_$1,$2_"),
    (r"EXTI\[(\d+):(\d+)\]", "EXTI$1_$2"),
    (r"\[(\d+):(\d+)\]", "$2_$1"),
)
OFFSET_RULES: tuple[Rule, ...] = ((r" +", ""), ("0x000x00", "0x00"), ("to", "-"), ("×", "*"), (r"\(\d+\)", ""))  # TXT-06
REGISTER_RULES: tuple[Rule, ...] = (
    (r" +|\.+", ""),
    (r"\(COM(\d)\)", "_COM$1"),
    (r"^[Rr]es$||0x[\da-fA-FXx]+|\(.*?\)|-", ""),
    (r"(?i)reserved|resetvalue.*", ""),
    ("enabled", "_EN"),
    ("disabled", "_DIS"),
    (r"(?i)Outputcomparemode", "_Output"),
    (r"(?i)Inputcapturemode", "_Input"),
    ("mode", ""),
    (r"^TG_FS_", "OTG_FS_"),
    ("toRTC", "RTC"),
    ("SPI2S_", "SPI_"),
    (r"andTIM\d+_.*", ""),
    (r"x=[\d,]+", ""),
)
FIELD_RULES: tuple[Rule, ...] = (
    (r"\] +\d+(th|rd|nd|st)", "]"),
    (r" +|\.+|\[.*?\]|\[?\d+:\d+\]?|\(.*?\)|-|^[\dXx]+$|%|__|:0\]", ""),
    (r"Dataregister|Independentdataregister", "DATA"),
    (r"Framefilterreg0.*", "FRAME_FILTER_REG"),
    (r"[Rr]es(erved)?|[Rr]egular|x_x(bits)?|NotAvailable|RefertoSection\d+:Comparator", ""),
    (r"Sampletimebits|Injectedchannelsequence|channelsequence|conversioninregularsequencebits", ""),
    (r"conversioninsequencebits|conversionininjectedsequencebits|or|first|second|third|fourth", ""),
)
BIT_RULES: tuple[Rule, ...] = ((r".*:", ""),)
GLOBAL_OFFSET_RULES: tuple[Rule, ...] = ((r"[Rr]eserved", ""),)
PERIPHERAL_RULES: tuple[Rule, ...] = (  # TXT-07
    (r" +", ""),
    (r".*?\(([A-Z]+|DMA2D)\).*?", "$1"),
    (r"Reserved|Port|Power|Registers|Reset|\(.*?\)|_REG", ""),
    (r"(\d)/I2S\d", "$1"),
    (r"/I2S|CANMessageRAM|Cortex-M4|I2S\dext|^GPV$", ""),
    ("Ethernet", "ETH"),
    ("Flash", "FLASH"),
    (r"(?i).*ETHERNET.*", "ETH"),
    (r"(?i)Firewall", "FW"),
    (r"HDMI-|", ""),
    ("SPDIF-RX", "SPDIFRX"),
    ("SPI2S2", "SPI2"),
    ("Tamper", "TAMP"),
    ("TT-FDCAN", "FDCAN"),
    (r"USBOTG([FH])S", "USB_OTG_$1S"),
    ("LCD-TFT", "LTDC"),
    ("DSIHOST", "DSI"),
    ("TIMER", "TIM"),
    (r"^VREF$", "VREFBUF"),
    ("DelayBlock", "DLYB"),
    ("I/O", ""),
    ("DAC1/2", "DAC12"),
    (r"[a-z]", ""),
)
ADDRESS_RULES: tuple[Rule, ...] = ((r" |\(\d\)", ""),)
SECTION_RULES: tuple[Rule, ...] = ((r"-", ""),)
HEADER_RULES: tuple[Rule, ...] = ((r"Peripheral +register +map", "map"),)
BUS_RULES: tuple[Rule, ...] = ((r".*(A\wB\d).*", "$1"), ("-", ""))
PIN_RULES: tuple[Rule, ...] = ((r"sup| |D?NC|/$|\(.*?\)|.*?connected.*", ""), ("–", "-"), (r"VREF_\+", "VREF+"))  # TXT-08
ADDITIONAL_RULES: tuple[Rule, ...] = ((r"[- ]|\(.*?\)|.*?selection.*|.*?reset.*", ""), ("OPAMP", ",OPAMP"), ("COMP", ",COMP"), ("OPAMP,1", "OPAMP1"))
FUNCTION_RULES: tuple[Rule, ...] = ((r"[- ]|\(.*?\)", ""), ("LCD_SEG", ",LCD_SEG"))
POSITION_RULES: tuple[Rule, ...] = ((r"[“”\-\"]|NC|\(.*?\)", ""),)
SIGNAL_RULES: tuple[Rule, ...] = (
    (r"[- ]|\(.*?\)", ""),
    (r"(MOSI|SCK|NSS)I2S", "$1,I2S"),
    ("_µM", "_M"),
    (r"(CH\d)TIM", "$1,TIM"),
    (r"_([RT]XD\d?|DV|EN|CLK)ETH_", "_$1,ETH_"),
)
PACKAGE_RULES: tuple[Rule, ...] = (  # TXT-09
    ("UFBGA/TFBGA64", "UFBGA64/TFBGA64"),
    ("LPQF", "LQFP"),
    ("TSSPOP", "TSSOP"),
    ("UFBG100", "UFBGA100"),
    ("UBGA", "UFBGA"),
    ("UQFN", "UFQFPN"),
    ("WLCSP20L", "WLCSP20"),
    ("UFQFPN48E", "UFQFPN48+E"),
    ("UFQFN", "UFQFPN"),
    ("LQFP48 SMPS<br>UFQFPN48 SMPS", "LQFP48/UFQFPN48+SMPS"),
    ("LQFP<br>64", "LQFP64"),
    ("LQFP<br>48", "LQFP48"),
    ("UFQFPN<br>32", "UFQFPN32"),
    ("UFQFP<br>N48", "UFQFPN48"),
    ("WLCSP<br>25", "WLCSP25"),
    (r"^BGA", "UFBGA"),
    (r"\(\d\)| ", ""),
    (r"[Ee]xt-?/?", ""),
    ("<br>SMPS", "SMPS"),
    ("SMSP", "SMPS"),
    (r"with|-|_", "+"),
    ("or", "/"),
    (r"\(STM32L0.*?UxSonly\)", "+S"),
    (r"(\d+)SMPS", "$1+SMPS"),
    (r"\+GP", ""),
)
#: TXT-20
MEMORY_NAMES = {
    "irom1": "flash",
    "main_flash": "flash",
    "flash-secure": "flash_s",
    "flash-non-secure": "flash_ns",
    "flash_bank1": "flash1",
    "flash_bank2": "flash2",
    "iram1": "sram1",
    "iram2": "sram2",
    "sram-secure": "sram_s",
    "sram-non-secure": "sram_ns",
    "sram1_2": "sram1",
    "ram_d1": "d1_sram",
    "ram_d2": "d2_sram1",
    "ram_d2s2": "d2_sram2",
    "ram_d2s3": "d2_sram3",
    "ram_d3": "d3_sram",
    "axi_sram": "d1_sram",
    "ahb_sram": "d2_sram1",
    "ccm_ram": "ccm",
    "dtcmram": "dtcm",
    "dtcm_ram": "dtcm",
    "bkp_sram": "backup",
}
#: TXT-19: device names whose HAL folder isn't the family followed by xx.
FAMILY_FOLDERS = {"h7r": "h7rsxx", "h7s": "h7rsxx", "wb0": "wb0x", "wba": "wbax", "wl3": "wl3x"}


def vector_names(cell: Column | str) -> Column:
    """Interrupt names of a vector table's cell (TXT-05)."""
    return listify(replace_subs(cell, VECTOR_RULES, VECTOR_TAGS), ",")


def packages(domain: Column | str) -> Column:
    """array<struct<name, package, family, pins>> of a pinout's column domain (TXT-09).

    The domain's last part is a cell of package names; what stands after the
    first plus sign, or as devices in an earlier part, filters all of them and
    stays in ``name``. Parts that name no package are left out.
    """
    domain = _re(domain)
    listed = F.regexp_extract(domain, ":(STM32.*?):", 1)
    only = F.when(listed != "", F.concat(F.lit("+"), F.array_join(F.transform(listify(listed), lambda d: F.replace(d, F.lit("x"), F.lit("."))), "|"))).otherwise("")
    cell = F.concat(fold(F.element_at(F.split(domain, ":"), -1), PACKAGE_RULES), only)
    names, at = F.substring_index(cell, "+", 1), F.instr(cell, "+")
    suffix = F.when(at > 0, F.substring(cell, at, F.length(cell))).otherwise("")
    parts = F.filter(F.split(names, r"[/,]| or |<br>"), lambda p: p.rlike(r"[A-Za-z]+\d+"))
    return F.transform(parts, lambda p: F.struct(F.concat(p, suffix).alias("name"), split_package(p)["package"].alias("package"), split_package(p)["family"].alias("family"), split_package(p)["pins"].alias("pins")))


def hal_folder(device: Column | str) -> Column:
    """HAL folder of a device name such as stm32f407vgt6: the family and xx, but for special cases (TXT-19)."""
    name = F.lower(_re(device))
    table = F.create_map(*[F.lit(x) for kv in FAMILY_FOLDERS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.substring(name, 6, 3)), F.concat(F.substring(name, 6, 2), F.lit("xx")))


def memory_name(name: Column | str) -> Column:
    """Canonical name of a memory (TXT-20); the EEPROM is known by its loader's file."""
    out = renamed(name, MEMORY_NAMES)
    return F.when(F.contains(out, F.lit("_eeprom.flm")), "eeprom").otherwise(out)


def renamed(name: Column | str, names: Mapping[str, str]) -> Column:
    """Rename by a table; names it lacks stay (TXT-19, TXT-20)."""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(table, _re(name)), _re(name))
