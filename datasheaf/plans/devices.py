"""Recipes that join the operators: devices of a datasheet, memory maps of manuals and headers, device records of a part database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datasheaf.functions import text
from datasheaf.operators import aggregates, joins, trees, windows
from datasheaf.sources import cheader

# ---- documents ----------------------------------------------------------------


def devices_in_captions(items: DataFrame, prefix: str = "STM32") -> DataFrame:
    """(doc, device) named in headings and captions, short forms spelled out (DOM-01, DOM-03)."""
    where = F.concat_ws(" ", "html", "caption")
    found = F.regexp_extract_all(where, F.lit(rf"{prefix}[A-Z0-9]\w+(?:/\w+)*"), F.lit(0))
    return items.select("doc", F.explode(F.flatten(F.transform(found, text.expand_combo))).alias("device")).distinct()


def ordered_devices(codes: Mapping[str, Sequence[str]], templates: DataFrame) -> DataFrame:
    """(device): all code combinations that some order-code template allows, ``x`` standing for any character (DOM-01, AGG-09, JOI-04). ``codes`` are one ordering table's sections, in order."""
    spark = templates.sparkSession
    parts = [spark.createDataFrame([(c,) for c in values], f"{name} string") for name, values in codes.items()]
    made = aggregates.expand_codes(parts).select(F.lower(F.concat(*codes)).alias("device"))
    patterns = templates.select(F.replace(F.lower(templates.columns[0]), F.lit("x"), F.lit(".")).alias("pattern"))
    return joins.matches_any(made, "device", patterns)


def documents_of(devices: DataFrame, documents: DataFrame) -> DataFrame:
    """A document for each device, by its own name or that of a lower temperature range (JOI-02): did, doc, tier. ``documents``: device, doc, one document a device (AGG-10)."""

    def as_range(code: str) -> Column:
        return F.concat(F.left("did", F.lit(12)), F.lit(code), F.expr("substr(did, 14)"))

    return joins.fallback(devices, documents, [F.col("did"), as_range("7"), as_range("6"), as_range("3")], "device", ["did"]).select("did", "doc", "tier")


def datasheet_tables(items: DataFrame) -> DataFrame:
    """(doc, role, item_no) of a datasheet's tables (DOM-02): pinout, alternate functions, ordering information."""
    caption = F.lower(F.coalesce(text.replace_subs("caption"), F.lit("")))
    role = F.when(caption.rlike("alternate function"), "alternate_functions").when(caption.rlike("pin (?:definition|assignment|description)|pinout"), "pinout").when(caption.rlike("order(?:ing|able)"), "ordering")
    return items.filter("kind = 'table'").select("doc", role.alias("role"), "item_no").filter("role is not null")


def sensor_registers(rows: DataFrame) -> DataFrame:
    """(doc, register, address, access) of a sensor's register list (DOM-05, DOM-12), reserved ones left out. ``rows``: doc, name, address and access as text, the address in hex or binary."""
    clean = text.fold("name", text.REGISTER_RULES)
    bare = F.regexp_replace(F.trim("address"), r"(?i)h$", "")
    address = F.coalesce(text.number_of(F.when(bare.rlike("(?i)^0[xb]"), bare).otherwise(F.concat(F.lit("0x"), bare))), F.lit(None).cast("bigint"))
    return rows.select("doc", clean.alias("register"), address.alias("address"), F.lower("access").alias("access")).filter("register <> '' and address is not null")


def parameter(xml: Column, name: str, default: str | None = None) -> Column:
    """A named parameter of a reference element, or the default (DOM-09)."""
    found = F.xpath_string(xml, F.lit(f"//Parameter[@Name='{name}']/PossibleValue"))
    return F.when(F.coalesce(found, F.lit("")) != "", found).otherwise(F.lit(default))


# ---- memory maps ----------------------------------------------------------------


def filtered_types(types: DataFrame, devices: DataFrame) -> DataFrame:
    """Types for each device that their patterns allow: any pattern of any filter, or none stated (FLT-07). ``types`` has patterns array<string>."""
    allowed = (F.size("patterns") <= 0) | F.exists("patterns", lambda p: F.regexp_like(F.col("did"), F.concat(F.lit("^(?:"), p, F.lit(")"))))
    return devices.select("did").join(types.withColumn("patterns", F.coalesce("patterns", F.array().cast("array<string>"))), allowed)


def link_instances(instances: DataFrame, types: DataFrame) -> DataFrame:
    """Type of each instance, by the first of these that any type meets (JOI-07): the same name; a type name inside the instance's; the same section; UART for USART; BKP for RTC. Ambiguous instances are dropped (JOI-08)."""
    name, kind = F.col("instance"), F.col("type")
    tiers = [
        name == kind,
        F.contains(name, kind),
        F.coalesce(F.col("section") == F.col("type_section"), F.lit(False)),
        F.contains(F.replace(name, F.lit("UART"), F.lit("USART")), kind) & F.contains(name, F.lit("UART")),
        F.contains(F.replace(name, F.lit("BKP"), F.lit("RTC")), kind) & F.contains(name, F.lit("BKP")),
    ]
    found = joins.cascade(instances, types.withColumnRenamed("section", "type_section"), tiers, ["did", "instance"], instances["did"] == types["did"] if "did" in types.columns else None)
    # of several substrings the longest is meant
    return joins.unambiguous(found, ["instance"] if "did" in types.columns else ["did", "instance"], F.struct("tier", -F.length("type")))


def memory_map(instances: DataFrame, registers: DataFrame, fields: DataFrame) -> DataFrame:
    """(did, peripheral, address, register, offset, field, position, width): a type's registers at each instance, bits of one name made a field (DOM-04, TRE-08, AGG-01)."""
    whole = aggregates.bit_fields(fields, ["type", "register", "field"], "bit")
    placed = trees.instantiate(instances.select("did", F.col("instance").alias("peripheral"), "address", "type"), registers)
    return placed.join(whole, ["type", "register"], "left").select("did", "peripheral", "address", "register", "offset", "field", "position", "width")


def compacted(maps: DataFrame) -> DataFrame:
    """Devices of equal memory maps (AGG-02): signature, devices sorted. The signature is a digest of what is written out, so it is the same everywhere."""
    row = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("peripheral", "address", "register", "offset", "field", "position", "width")])
    made = maps.groupBy("did").agg(F.sha2(F.array_join(F.array_sort(F.collect_set(row)), "\n"), 256).alias("signature"))
    return made.groupBy("signature").agg(F.array_sort(F.collect_set("did")).alias("devices"))


def header_map(headers: DataFrame) -> DataFrame:
    """(header, peripheral, address, register, offset, field, position, width) of C headers (DOM-06): instances are the defines that cast a base address to a structure."""
    lines = cheader.defines(headers).cache()
    values = cheader.evaluated(lines)
    cast = r"^\(+\s*(\w+_TypeDef)\s*\*\s*\)\s*(\w+)\s*\)*$"
    instances = lines.filter(F.col("expr").rlike(cast)).select("header", F.col("name").alias("peripheral"), F.regexp_extract("expr", cast, 1).alias("struct"), F.regexp_extract("expr", cast, 2).alias("base"))
    at = instances.join(values.select("header", F.col("name").alias("base"), F.col("value").alias("address")), ["header", "base"])
    members = cheader.expanded_members(cheader.struct_members(headers))
    fields = cheader.fields_of(members, values)
    registers = members.withColumnRenamed("name", "register").join(fields, ["header", "struct", "register", "offset"], "left")
    return at.join(registers, ["header", "struct"]).select("header", "peripheral", "address", "register", "offset", "field", "position", "width")


def define_of_device(devices: DataFrame, defines: DataFrame) -> DataFrame:
    """(did, define): the family define that covers a device, exact or else the next in text order (JOI-20). ``devices``: did, family, key; ``defines``: family, define."""
    return joins.nearest_define(devices, defines, "family", F.lower("key"), F.lower("define"), ["did"])


# ---- part database ----------------------------------------------------------------


def flash_latency(rules: DataFrame) -> DataFrame:
    """(filter, millivolts, frequencies) sorted and distinct (AGG-03). ``rules``: filter or null for all, voltage, frequency as text."""
    rows = rules.select(F.coalesce("filter", F.lit("")).alias("filter"), text.quantity("voltage").alias("millivolts"), text.quantity("frequency").alias("hertz")).filter("millivolts is not null and hertz is not null")
    return aggregates.sets_by(rows, ["filter", "millivolts"], "hertz", "frequencies")


def repaired_memories(memories: DataFrame, names: Mapping[str, str], access: Mapping[str, str], overrides: DataFrame | None = None, splits: DataFrame | None = None) -> DataFrame:
    """(did, name, address, size, access) after renames, access fixes, overrides and splits (DOM-10).

    ``overrides``: pattern, name, and address, size or access or null. ``splits``:
    pattern, name, new_name, size: the new memory takes its size off the end of
    the other one and starts there.
    """
    out = memories.withColumn("name", text.renamed(F.lower("name"), names)).filter(~F.endswith("name", F.lit(".flm")))
    fixed = F.create_map(*[F.lit(x) for kv in access.items() for x in kv]) if access else None
    out = out if fixed is None else out.withColumn("access", F.coalesce(F.try_element_at(fixed, F.col("name")), "access"))
    if overrides is not None:
        o = overrides.select("pattern", F.col("name").alias("__n"), *[F.col(c).alias(f"__{c}") for c in ("address", "size", "access")])
        out = out.join(o, (F.col("name") == F.col("__n")) & F.expr("did rlike concat('^(?:', pattern, ')')"), "left")
        out = out.select("did", "name", *[F.coalesce(f"__{c}", c).alias(c) for c in ("address", "size", "access")])
    if splits is not None:
        s = splits.select("pattern", F.col("name").alias("__n"), "new_name", F.col("size").alias("__s"))
        hit = out.join(s, (F.col("name") == F.col("__n")) & F.expr("did rlike concat('^(?:', pattern, ')')"), "left")
        rest = hit.select("did", "name", "address", (F.col("size") - F.coalesce("__s", F.lit(0))).alias("size"), "access")
        new = hit.filter("new_name is not null").select("did", F.col("new_name").alias("name"), (F.col("address") + F.col("size") - F.col("__s")).alias("address"), F.col("__s").alias("size"), "access")
        out = rest.unionByName(new)
    return out


def dma_channels(rows: DataFrame) -> DataFrame:
    """(did, instance, stream, channel, signals) of request rows in order (AGG-14): a signal that comes again counts at its last place.

    ``rows``: did, parent, name, signal, ord. ``[`` in the parent is a request of a
    multiplexer; ``Stream`` has stream and channel, ``Request`` channel and
    request, else the channel is the stream.
    """
    number = lambda c, p: F.regexp_extract(c, p, 1).try_cast("int")
    parent = F.col("parent")
    instance = F.when(F.contains(parent, F.lit("[")), F.lit(0)).otherwise(F.coalesce(number(parent, r"DMA(\d+)"), F.lit(1)))
    stream = F.when(F.contains(parent, F.lit("[")), F.lit(0)).when(F.contains(parent, F.lit("Stream")), number(parent, r"Stream(\d+)")).otherwise(number(parent, r"Channel(\d+)"))
    channel = F.when(F.contains(F.col("name"), F.lit("_")), number("name", r"(\d+)$")).otherwise(stream)
    placed = rows.select("did", instance.alias("instance"), stream.alias("stream"), channel.alias("channel"), "signal", "ord")
    last = aggregates.keep_last_duplicate(placed, ["did", "instance", "stream", "channel"], "signal", "ord")
    return aggregates.lists_by(last, ["did", "instance", "stream", "channel"], "ord", F.col("signal"), "signals")


def numbered_mux(rows: DataFrame) -> DataFrame:
    """Position of each channel among those of its multiplexer (WIN-09)."""
    return rows.withColumn("position", windows.place(["did", "mux"], ["ord"]))


#: Other names of requests (TXT-18); fixed values.
REQUEST_ALIASES: tuple[tuple[str, str], ...] = (
    (r"^FMAC_READ$", "FMAC_RD"),
    (r"^FMAC_WRITE$", "FMAC_WR"),
    (r"^CORDIC_READ$", "CORDIC_RD"),
    (r"^CORDIC_WRITE$", "CORDIC_WR"),
    (r"^DCMI_PSSI$", "PSSI"),
    (r"^TIM16_COM$", "TIM16_TRIG_COM"),
    (r"^TIM17_COM$", "TIM17_TRIG_COM"),
    (r"^HRTIM_MASTER$", "HRTIM1_M"),
    (r"^HRTIM_TIMER_", "HRTIM1_"),
    (r"^SUBGHZSPI_RX$", "SUBGHZ_RX"),
    (r"^SUBGHZSPI_TX$", "SUBGHZ_TX"),
    (r"^DAC$", "DAC_OUT1"),
    (r"^USART_TX$", "USART1_TX"),
    (r"^USART_RX$", "USART1_RX"),
    (r"^LPUART_TX$", "LPUART1_TX"),
    (r"^LPUART_RX$", "LPUART1_RX"),
    (r"^(DAC[0-9])_CHANNEL([0-9]).*$", "$1_CH$2"),
)


def request_map(requests: DataFrame, prefix: str = "DMA") -> DataFrame:
    """(name, id) of DMA requests and of their other names (DOM-11, TXT-18): originals stay, but an alias takes its name from a request that has it. Generators get the prefix."""
    named = [F.when(F.col("name").rlike(p), F.regexp_replace("name", p, r)) for p, r in REQUEST_ALIASES]
    generator = F.when(F.startswith("name", F.lit("GENERATOR")), F.concat(F.lit(f"{prefix}_"), "name"))
    aliases = requests.select(F.explode(F.array_compact(F.array(generator, *named))).alias("name"), F.lit(1).alias("rank"), "id")
    both = requests.select("name", F.lit(0).alias("rank"), "id").unionByName(aliases)
    return both.groupBy("name").agg(F.max_by("id", F.struct("rank", "id")).alias("id"))


def resolved_requests(names: DataFrame, numbers: DataFrame) -> DataFrame:
    """(request, id) through the intermediate name (JOI-14); a name without a number fails."""
    return joins.resolve(names, numbers, ["ll_name"]).select("request", "id")


def split_signals(signals: DataFrame, modules: DataFrame) -> DataFrame:
    """(pin, af, driver, instance, name): signals by the module whose name and underscore they start with (TXT-17). ``signals``: pin, af, signal, several joined by dashes; ``modules``: module, driver, instance. Of several modules the longest; what has none is left out."""
    each = signals.select("pin", "af", F.explode(text.split_signals("signal")).alias("signal"))
    found = joins.prefix_join(each, modules.withColumn("prefix", F.concat("module", F.lit("_"))), "signal", "prefix")
    best = found.groupBy("pin", "af", "signal").agg(F.max_by(F.struct("driver", "instance", F.expr("substr(signal, length(prefix) + 1)").alias("name")), F.length("prefix")).alias("m"))
    return best.select("pin", "af", "m.*")


def with_alternate_functions(signals: DataFrame, functions: DataFrame) -> DataFrame:
    """Signals with their alternate function, -1 where none is listed (JOI-15)."""
    return joins.left_with_default(signals, functions, ["pin", "signal"], {"af": -1})


def device_records(parts: Mapping[str, DataFrame]) -> DataFrame:
    """One row a device (DOM-08): did, and an array of structs for each relation in ``parts``, sorted."""
    lists = [df.groupBy("did").agg(F.array_sort(F.collect_set(F.struct(*[c for c in df.columns if c != "did"]))).alias(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.join(b, "did", "full"), lists)
