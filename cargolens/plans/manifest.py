"""Sea manifest: one VOY line per master, then BOL with its CON and CTR lines
per shipment, then END.

``carry="clean"`` fills every shipment from its own rows only. With
``carry="reference"`` a value set by one shipment stays for the following
shipments of its master until another sets it: transport mode, consolidated
container, container totals and the dangerous-goods block.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolens.functions.text import (
    DAY_MONTH_YEAR,
    blank_to_null,
    full_address,
    in_parentheses,
    nz,
    squeeze,
    tonnes,
    without_last,
)
from cargolens.operators.joins import config_value, role_join, role_lookup
from cargolens.operators.lists import gather_lines
from cargolens.operators.numbering import assign_sequence, instalments
from cargolens.operators.ordered import first_per_key
from cargolens.operators.predicates import code_map, default_consignee, trade_code
from cargolens.session import staged

Tables = Mapping[str, DataFrame]

# Codes and texts of the manifest.
CARGO_CODES = {
    "FCL CONTAINER": "F",
    "LCL CONTAINER": "L",
    "EMPTY CONTAINER": "M",
    "BULK SOLID": "B",
    "BULK LIQUID": "Q",
    "RO-RO UNIT": "R",
    "PASSENGER": "P",
    "GENERAL CARGO ( BREAK BULK )": "G",
}
MODE_CODES = {"Ocean": "S", "Air": "A", "Road": "R"}
STORAGE_CODES = {"Direct Delivery": "D", "Storage in Sheds": "S", "Storage in Yards": "Y"}
MESSAGE_TYPE = "MFI"
COMMODITY_CODE = "770000"
CONSOLIDATED = "LCL"
END_REMARK = "Version No: 1, Product Sr. No: EDI/1.0"


def _line(tag: str, *fields: Column | str) -> Column:
    """``TAG,"a","b"``; quotes inside fields stay as they are, NULL blanks the line."""
    out = [F.lit(f'{tag},"')]
    for i, f in enumerate(fields):
        if i:
            out.append(F.lit('","'))
        out.append(F.lit(f) if isinstance(f, str) else f.cast("string"))
    return F.concat(*out, F.lit('"'))


def _line_code(t: Tables) -> Column:
    return nz(config_value(t["config_headers"], t["config_values"], "LINE_CODE"))


def _agent_code(t: Tables) -> Column:
    return nz(config_value(t["config_headers"], t["config_values"], "AGENT_CODE"))


def voyages(t: Tables) -> DataFrame:
    """Master data per master; a master without carrier, customs or port row has none."""
    carrier = first_per_key(
        t["master_carriers"].select("master_id", "vessel_name", "route_no"), ["master_id"], ["route_no", "vessel_name"]
    )
    customs = first_per_key(
        t["master_customs"].select("master_id", "rotation_no", F.lit(True).alias("_customs")), ["master_id"], ["rotation_no"]
    )
    full = (
        t["masters"]
        .join(carrier.withColumnRenamed("master_id", "id"), "id")
        .join(customs.withColumnRenamed("master_id", "id"), "id")
        .join(t["ports"].select(F.col("id").alias("destination_id"), F.col("code").alias("port_code")), "destination_id")
    )
    return full.select(
        "id",
        "vessel_name",
        "route_no",
        "port_code",
        "eta",
        "rotation_no",
        in_parentheses(F.col("service")).alias("service"),
        code_map(F.col("service_code"), CARGO_CODES).alias("cargo_code"),
    )


def voy_lines(t: Tables, first_number: int = 1) -> DataFrame:
    """``(master_id, master_uid, line)``."""
    rows = t["masters"].select("id", "master_uid").join(voyages(t), "id", "left")
    counters = t["instalments"].filter("rotation_no is not null").select("master_uid", "rotation_no", "instalment_no")
    rows = rows.join(counters, ["master_uid", "rotation_no"], "left")
    rows = assign_sequence(rows, ["id"], "_seq", base=first_number - 1)
    line = _line(
        "VOY",
        _line_code(t),
        _agent_code(t),
        nz(F.col("vessel_name")),
        F.col("route_no"),
        F.col("port_code"),
        F.date_format("eta", DAY_MONTH_YEAR),
        nz(F.col("rotation_no")),
        MESSAGE_TYPE,
        F.coalesce("instalment_no", F.lit(1)),
        F.lpad(F.col("_seq").cast("string"), 5, "0"),
    )
    return rows.select(F.col("id").alias("master_id"), "master_uid", line.alias("line"))


def master_shipments(t: Tables) -> DataFrame:
    """Distinct shipments of each master."""
    links = t["master_service_links"].select("master_id", F.col("shipment_service_id").alias("id"))
    pairs = links.join(t["shipment_services"].select("id", "shipment_header_id"), "id")
    known = t["shipments"].select(F.col("id").alias("shipment_header_id"))
    pairs = pairs.join(known, "shipment_header_id", "left_semi")
    return pairs.select("master_id", F.col("shipment_header_id").alias("shipment_id")).distinct()


# Child tables of a shipment and their foreign keys.
CHILDREN = {
    "shipments": "id",
    "shipment_services": "shipment_header_id",
    "shipment_cargo": "shipment_header_id",
    "air_documents": "source_id",
    "ocean_documents": "source_id",
    "shipment_extras": "shipment_header_id",
    "shipment_parties": "shipment_header_id",
    "shipment_containers": "shipment_id",
}


def of_shipment(t: Tables, shipment_id: int | None) -> Tables:
    """The tables cut to one shipment and its masters; all of them without an id."""
    if shipment_id is None:
        return t
    cut = {name: t[name].filter(F.col(fk) == shipment_id) for name, fk in CHILDREN.items()}
    links = t["master_service_links"].join(
        cut["shipment_services"].select(F.col("id").alias("shipment_service_id")), "shipment_service_id", "left_semi"
    )
    masters = t["masters"].join(links.select(F.col("master_id").alias("id")), "id", "left_semi")
    return ChainMap({**cut, "master_service_links": links, "masters": masters}, t)


def _first(df: DataFrame, fk: str, order: list[str], columns: Mapping[str, Column | str]) -> DataFrame:
    """First child row per shipment, columns renamed; of rows that stand alike, the one with the smallest values."""
    cols = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    # a column that is ordered by and shown goes along once
    ahead = [F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    shown = {n: f"_o{order.index(c)}" if isinstance(c, str) and c in order else n for n, c in columns.items()}
    rest = [c for c, n in zip(cols, columns, strict=True) if shown[n] == n]
    side = df.select(F.col(fk).alias("shipment_id"), F.struct(*ahead, *rest).alias("_row"))
    firsts = side.groupBy("shipment_id").agg(F.min("_row").alias("_first"))
    return firsts.select("shipment_id", *[F.col(f"_first.{c}").alias(n) for n, c in shown.items()])


def _dangerous(c=F.col) -> Column:
    degrees = "decimal(18,1)"
    unit = F.left(c("temperature_code"), F.lit(1))
    return F.struct(
        F.left(c("imo_class"), F.lit(3)).alias("imo_class"),
        F.left(c("un_number"), F.lit(5)).alias("un_number"),
        c("flash_point").try_cast(degrees).alias("flash_point"),
        unit.alias("unit"),
        code_map(c("storage_code"), STORAGE_CODES, default="").alias("storage"),
        F.left(c("refrigeration"), F.lit(1)).alias("refrigeration"),
        c("minimum_temperature").try_cast(degrees).alias("minimum"),
        c("maximum_temperature").try_cast(degrees).alias("maximum"),
    )


def _cargo(t: Tables, *names: str) -> DataFrame:
    """First cargo row of each shipment, cut to these columns."""
    c = F.col
    cargo = {
        "marks": squeeze(c("marks_and_numbers")),
        "commodity": squeeze(c("commodity_description")),
        "pieces": c("no_of_pieces").cast("long"),
        "pack_id": "pack_id",
        "volume": c("chargeable_unit").cast("decimal(18,3)"),
        "gross": c("gross_weight_kgs").cast("decimal(18,3)"),
        "hazardous": F.when(c("hazardous") == "Yes", "Y").otherwise("N"),
        "dangerous": _dangerous(),
    }
    return _first(t["shipment_cargo"], "shipment_header_id", ["id"], {n: cargo[n] for n in names or cargo})


def _packed(rows: DataFrame, t: Tables) -> DataFrame:
    return role_join(rows, t["packs"], {"pack": "pack_id"}, ["code", "name"], how="left")


def container_details(t: Tables) -> DataFrame:
    """What the container lines show of each master and shipment, without the rest of ``shipment_details``."""
    rows = master_shipments(t).join(_cargo(t, "pack_id", "hazardous", "dangerous"), "shipment_id", "left")
    rows = rows.withColumn("hazardous", F.coalesce("hazardous", F.lit("N")))
    return _packed(rows.withColumn("_dg", F.when(F.col("hazardous") == "Y", F.col("dangerous"))), t)


def box_counts(t: Tables) -> DataFrame:
    """Containers of each master and shipment."""
    boxes = t["shipment_containers"].groupBy("shipment_id").agg(F.count(F.lit(1)).alias("box_count"))
    return master_shipments(t).join(boxes, "shipment_id", "left").withColumn("box_count", F.coalesce("box_count", F.lit(0)))


def shipment_details(t: Tables, carry: str = "clean", boxes: DataFrame | None = None, dangerous: bool = True) -> DataFrame:
    """One row per master and shipment with everything its lines show.

    ``boxes`` are those of ``grouped_boxes`` where they are at hand. Without
    ``dangerous`` the block that only container lines show is left out.
    Wide rows are dealt by their shipment and stay there; what is known of a
    pair of master and shipment is brought to them.
    """
    if carry not in ("clean", "reference"):
        raise ValueError(f"unknown carry {carry!r}")
    c = F.col
    pairs = master_shipments(t)
    ships = t["shipments"].select(c("id").alias("shipment_id"), "origin_id", "destination_id", c("service_type").alias("container_service"))
    rows = ships

    other = F.when(c("other_trade") == "ReExport", "Import").otherwise(c("other_trade"))
    rows = rows.join(
        _first(t["shipment_services"], "shipment_header_id", ["id"], {"trade": trade_code(other, c("service_trade"))}), "shipment_id", "left"
    )
    shown = ["marks", "commodity", "pieces", "pack_id", "volume", "gross", "hazardous"]
    rows = rows.join(_cargo(t, *shown, *(["dangerous"] if dangerous else [])), "shipment_id", "left")
    rows = rows.withColumn("hazardous", F.coalesce("hazardous", F.lit("N")))
    for name, table, fk, number in (
        ("_air", "air_documents", "source_id", "document_no"),
        ("_ocean", "ocean_documents", "source_id", "document_no"),
        ("_extra", "shipment_extras", "shipment_header_id", "transport_document_no"),
    ):
        rows = rows.join(_first(t[table], fk, [number], {name: number}), "shipment_id", "left")
    rows = rows.withColumn("bill_no", F.coalesce("_air", "_ocean", "_extra")).drop("_air", "_ocean", "_extra")

    address_ids = {
        "shipper": "shipper_address_id",
        "consignee": "consignee_address_id",
        "notify1": "notify_customer_1_address_id",
        "notify2": "notify_customer_2_address_id",
    }
    names = ["shipper_name", "consignee_name", "notify_customer_1_id", "notify_customer_2_id"]
    party_columns = {x: x for x in [*names, *address_ids.values()]}
    parties = _first(t["shipment_parties"], "shipment_header_id", ["shipper_address_id", "consignee_address_id"], party_columns)
    country = t["countries"].select(c("id").alias("country_id"), c("code").alias("country_code"), c("name").alias("_country"))
    addresses = t["party_addresses"].join(country, "country_id", "left")
    text = full_address(c("building_no"), c("street_name"), c("city_name"), c("state_name"), c("_country"), c("po_box"))
    addresses = addresses.select("id", text.alias("address"), "country_code")
    parties = role_lookup(parties, "shipment_id", address_ids, addresses, ["address", "country_code"])
    notified = {"notify1": "notify_customer_1_id", "notify2": "notify_customer_2_id"}
    parties = role_lookup(parties, "shipment_id", notified, t["customers"].select("id", "name"), ["name"])
    rows = rows.join(parties, "shipment_id", "left")
    counted = t["shipment_containers"].groupBy("shipment_id").agg(
        F.count(F.lit(1)).alias("box_count"), F.min_by("container_sl_no", "id").alias("_box")
    )
    rows = rows.join(counted, "shipment_id", "left").withColumn("box_count", F.coalesce("box_count", F.lit(0)))
    voyage = voyages(t).groupBy(c("id").alias("master_id")).agg(F.collect_list(F.struct("service", "cargo_code")).alias("_voyages"))
    pairs = pairs.join(_totals(t, boxes), ["master_id", "shipment_id"], "left").join(voyage, "master_id", "left")
    rows = pairs.join(rows, "shipment_id")

    # Joins on the shipment came first and share one partitioning; code lookups follow.
    rows = role_join(rows, t["ports"], {"origin": "origin_id", "discharge": "destination_id"}, ["code", "country_code"], how="left")
    rows = _packed(rows, t)
    modes = first_per_key(
        t["services"].select(c("code").alias("container_service"), code_map(c("transport_mode"), MODE_CODES).alias("_mode")),
        ["container_service"],
        ["_mode"],
    )
    rows = rows.join(modes, "container_service", "left")
    consolidated = F.coalesce(c("container_service") == CONSOLIDATED, F.lit(False))
    transit = F.coalesce(F.substring(c("trade"), 1, 1) == "T", F.lit(False))
    blocks = {
        "_mode": F.when(transit, F.struct(c("_mode").alias("mode"))),
        "_lcl": F.when(
            consolidated, F.struct(c("_box").alias("box"), F.right("_box", F.lit(1)).alias("digit"), tonnes(c("gross")).alias("tonnes"))
        ),
        "_fcl": F.when(~consolidated, F.struct(c("box_count").alias("boxes"), "teu", "tare")),
    }
    if dangerous:
        blocks["_dg"] = F.when(c("hazardous") == "Y", c("dangerous"))
    if carry == "reference":
        # the shipments of a master, whose lines are one document
        so_far = Window.partitionBy("master_id").orderBy("shipment_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        blocks = {n: F.last(b, ignorenulls=True).over(so_far) for n, b in blocks.items()}
    rows = rows.withColumns(blocks).withColumn("consolidated", F.when(consolidated, "Y").otherwise("N"))
    used_up = ["_box", "teu", "tare", "dangerous", "pack_id", "origin_id", "destination_id", "container_service"]
    return rows.drop(*used_up, *address_ids.values(), *notified.values())


def _boxes(t: Tables) -> DataFrame:
    """Shipment containers that belong to a master, with type data."""
    c = F.col
    packed = t["shipment_containers"].select(
        "shipment_id",
        c("master_container_id").alias("_mc"),
        "container_sl_no",
        "external_no_of_piece",
        "gross_weight_kgs",
        "volume_in_cbm",
    )
    held = t["master_containers"].select(c("id").alias("_mc"), "master_id", c("container_id").alias("_type"), "actual_seal_number")
    types = t["container_types"].select(
        c("id").alias("_type"),
        c("teu").try_cast("decimal(18,3)").alias("teu"),
        F.coalesce(blank_to_null(c("empty_tare_weight")).try_cast("decimal(18,3)"), F.lit(0)).alias("tare"),
    )
    # types are brought to the held containers, whose rows are shorter
    return packed.join(held.join(types, "_type"), "_mc")


BOX = ["ctr_no", "digit", "external_no_of_piece", "gross_weight_kgs", "volume_in_cbm", "actual_seal_number"]


def grouped_boxes(t: Tables) -> DataFrame:
    """Containers of each master and shipment as their lines show them, alike ones as one row."""
    c = F.col
    named = {"ctr_no": without_last(c("container_sl_no")), "digit": F.right("container_sl_no", F.lit(1))}
    # dealt by their shipment, where its lines meet them
    grouped = _boxes(t).withColumns(named).repartition("shipment_id").groupBy("master_id", "shipment_id", *BOX)
    return grouped.agg(F.sum("teu").alias("_teu"), F.sum("tare").alias("_tare"))


def _totals(t: Tables, boxes: DataFrame | None = None) -> DataFrame:
    source, teu, tare = (_boxes(t), "teu", "tare") if boxes is None else (boxes, "_teu", "_tare")
    return source.groupBy("master_id", "shipment_id").agg(
        F.sum(teu).cast("decimal(18,0)").alias("teu"),
        (F.sum(tare).cast("decimal(28,3)") / 1000).cast("decimal(18,1)").alias("tare"),
    )


def bol_lines(t: Tables, details: DataFrame) -> DataFrame:
    """``(master_id, shipment_id, line)``."""
    c = F.col
    empty = ""
    fields = [
        c("bill_no"), _line_code(t), _agent_code(t), c("origin_code"), c("origin_code"), c("discharge_code"),
        c("discharge_code"), empty, empty, nz(F.substring("trade", 1, 1)), nz(c("_mode.mode")), empty, empty,
        nz(c("cargo_code")), c("consolidated"), empty, nz(c("service")), nz(c("origin_country_code")),
        *[empty] * 7,
        nz(c("shipper_name")), nz(c("shipper_address")), nz(c("shipper_country_code")),
        default_consignee(c("trade")), nz(c("consignee_name")), nz(c("consignee_address")),
        empty, nz(c("notify1_name")), nz(c("notify1_address")),
        empty, nz(c("notify2_name")), nz(c("notify2_address")),
        empty, empty, empty,
        nz(c("marks")), COMMODITY_CODE, nz(c("commodity")), nz(c("pieces")), nz(c("pack_name")), nz(c("pack_code")),
        nz(c("_lcl.box")), nz(c("_lcl.digit")), nz(c("_fcl.boxes")), nz(c("_fcl.teu")), nz(c("_fcl.tare")),
        nz(c("gross")), nz(c("gross")), nz(c("volume")), nz(c("pieces")), nz(c("_lcl.tonnes")), nz(c("pieces")),
        empty, empty, empty,
    ]
    rows = details.select("*", F.explode_outer("_voyages").alias("_voyage")).select("*", "_voyage.*")
    return rows.select("master_id", "shipment_id", _line("BOL", *fields).alias("line"))


def container_lines(t: Tables, details: DataFrame, boxes: DataFrame | None = None) -> DataFrame:
    """``(master_id, shipment_id, sr_no, line)`` with the CON and CTR text; ``boxes`` as in ``shipment_details``.

    The containers of one shipment are numbered where they meet it.
    """
    c = F.col
    keys = ["master_id", "shipment_id"]
    boxes = (grouped_boxes(t) if boxes is None else boxes).drop("_teu")
    # Cargo rows with equal texts only raise the tare, so they are counted first.
    cargo = t["shipment_cargo"].groupBy(
        c("shipment_header_id").alias("shipment_id"),
        squeeze(c("marks_and_numbers")).alias("_marks"),
        squeeze(c("commodity_description")).alias("_commodity"),
    ).agg(F.count(F.lit(1)).alias("_times"))
    wanted = ["hazardous", "_dg", "pack_name", "pack_code"]
    # joined by the shipment alone, by which the containers are dealt: an equality of masters would deal them once more
    shown = details.select("shipment_id", c("master_id").alias("_master"), *wanted)
    rows = boxes.join(shown, "shipment_id").filter((c("master_id") <= c("_master")) & (c("master_id") >= c("_master"))).drop("_master")
    rows = rows.join(cargo, "shipment_id", "left")
    place = Window.partitionBy(*keys).orderBy("digit", *BOX, "_marks", "_commodity")
    rows = rows.withColumn("sr_no", F.row_number().over(place).cast("long"))
    pieces, tare = nz(c("external_no_of_piece")), (c("_tare") * F.coalesce("_times", F.lit(1))).cast("decimal(18,1)")
    con = _line(
        "CON",
        c("sr_no"), nz(c("_marks")), nz(c("_commodity")), "", COMMODITY_CODE, pieces, nz(c("pack_name")), nz(c("pack_code")),
        pieces, nz(F.round("gross_weight_kgs").cast("decimal(18,0)")), nz(c("volume_in_cbm")), nz(c("hazardous")),
        nz(c("_dg.imo_class")), nz(c("_dg.un_number")), nz(c("_dg.flash_point")), nz(c("_dg.unit")), nz(c("_dg.storage")),
        nz(c("_dg.refrigeration")), nz(c("_dg.minimum")), nz(c("_dg.maximum")), nz(c("_dg.unit")),
    )
    ctr = _line("CTR", nz(c("ctr_no")), nz(c("digit")), nz(tare), nz(c("actual_seal_number")))
    return rows.select(*keys, "sr_no", F.concat(con, F.lit("\n"), ctr).alias("line"))


def end_lines(t: Tables, details: DataFrame) -> DataFrame:
    """``(master_id, line)``: shipments with and without containers."""
    split = details.groupBy("master_id").agg(
        F.count_if(F.col("box_count") > 0).alias("_with"), F.count_if(F.col("box_count") == 0).alias("_without")
    )
    rows = t["masters"].select(F.col("id").alias("master_id")).join(split, "master_id", "left")
    zero = F.lit(0)
    line = _line("END", F.coalesce("_with", zero), F.coalesce("_without", zero), END_REMARK)
    return rows.select("master_id", line.alias("line"))


@dataclass(frozen=True)
class ManifestLines:
    voy: DataFrame
    bol: DataFrame
    containers: DataFrame
    end: DataFrame

    def all(self) -> DataFrame:
        """``(master_id, sec, shipment_id, no, line)`` in document order."""
        c = F.col
        none, zero = F.lit(0).cast("long"), F.lit(0).cast("long")

        def shaped(df: DataFrame, section: int, shipment: Column, number: Column) -> DataFrame:
            return df.select("master_id", F.lit(section).alias("sec"), shipment.alias("shipment_id"), number.alias("no"), "line")

        return (
            shaped(self.voy, 0, none, zero)
            .unionByName(shaped(self.bol, 1, c("shipment_id"), zero))
            .unionByName(shaped(self.containers, 1, c("shipment_id"), c("sr_no")))
            .unionByName(shaped(self.end, 2, none, zero))
        )


def manifest_lines(t: Tables, shipment_id: int | None = None, carry: str = "clean", first_number: int = 1) -> ManifestLines:
    """All lines; containers and shipment details are written once and read by each kind."""
    t = of_shipment(t, shipment_id)
    boxes = staged(grouped_boxes(t), "manifest-boxes")
    details = staged(shipment_details(t, carry, boxes), "manifest-details")
    return ManifestLines(
        voy_lines(t, first_number), bol_lines(t, details), container_lines(t, details, boxes), end_lines(t, details)
    )


def manifest(
    t: Tables,
    shipment_id: int | None = None,
    carry: str = "clean",
    null_mode: str = "reference",
    first_number: int = 1,
) -> DataFrame:
    """``(doc_key, content)`` per master; with ``shipment_id`` only that shipment and its masters.

    ``null_mode="reference"`` makes a document NULL when one of its mandatory
    fields is missing; ``"blank"`` leaves that line empty.
    """
    lines = manifest_lines(t, shipment_id, carry, first_number)
    keys = lines.voy.groupBy("master_id", F.col("master_uid").alias("doc_key")).agg(F.count(F.lit(1)).cast("int").alias("times"))
    order = ["sec", "shipment_id", "no"]
    return gather_lines(lines.all(), "master_id", order, null_blanks_all=null_mode == "reference", names=keys).drop("master_id")


def manifest_counters(t: Tables, as_of_order: str = "id") -> DataFrame:
    """Instalment counters after sending every master once."""
    sends = t["masters"].select(F.col("id"), "master_uid").join(voyages(t).select("id", "rotation_no"), "id", "left")
    return instalments(sends, t["instalments"], ["master_uid", "rotation_no"], as_of_order)[1]
