import datetime as dt
from decimal import Decimal

from martforge.config import MartConfig
from martforge.plans import codes, materials, partners, purchasing
from martforge.sources.base import FrameSources

CFG = MartConfig(as_of=dt.date(2024, 6, 1))
D = Decimal


def frames(spark, **tables):
    out = {}
    for name, (schema, rows) in tables.items():
        out[name] = spark.createDataFrame(rows, schema)
    return FrameSources(spark, out)


EKKO = ("MANDT string, EBELN string, BSART string, LIFNR string, WAERS string, BEDAT string, EKORG string, "
        "EKGRP string, BUKRS string")
EKPO = ("MANDT string, EBELN string, EBELP string, MATNR string, TXZ01 string, WERKS string, RESWK string, "
        "LGORT string, MATKL string, MENGE decimal(13,3), MEINS string, NETPR decimal(11,2), PEINH decimal(5,0), "
        "WEPOS string, REPOS string, PSTYP string, KNTTP string, LOEKZ string, ELIKZ string")
EKET = ("MANDT string, EBELN string, EBELP string, ETENR string, EINDT string, SLFDT string, MENGE decimal(13,3), "
        "WEMNG decimal(13,3), BANFN string")


def po_sources(spark):
    hdr = [("400", e, "NB", "0000000001", "USD", "20240101", "4000", "G1", "0000")
           for e in ("0004000001", "0004000002", "0004000003", "0004000004", "0004000005", "0004000006")]
    hdr += [("400", "0003999999", "UB", None, "USD", "20240101", "4000", "G1", "0000"),
            ("400", "4500", "NB", None, "USD", "20240101", "4000", "G1", "0000"),
            ("300", "0004000007", "NB", None, "USD", "20240101", "4000", "G1", "0000")]

    def item(ebeln, matnr, loekz="", elikz="", peinh=1):
        return ("400", ebeln, "00010", matnr, "free text", "1001", "1002", "0001", "MG", D(10), "EA", D("12.34"),
                D(peinh), "X", "X", "0", "", loekz, elikz)

    items = [item("0004000001", "000000000000000001", loekz="X"), item("0004000002", "", elikz="X"),
             item("0004000003", None, peinh=0), item("0004000004", "000000000000000002", peinh=10),
             item("0004000005", "000000000000000001"), item("0004000006", "000000000000000001"),
             item("0003999999", "000000000000000001"), item("4500", "000000000000000001"),
             ("300", "0004000007", "00010", "M", "t", "1001", "1002", "0001", "MG", D(1), "EA", D(1), D(1), "", "",
              "0", "", "", "")]
    lines = [("400", "0004000001", "00010", "0001", "20240201", "20240201", D(10), D(0), None),
             ("400", "0004000002", "00010", "0001", "20240201", "20240201", D(10), D(0), None),
             ("400", "0004000003", "00010", "0001", "20240201", "20240201", D(10), D(10), None),
             ("400", "0004000004", "00010", "0001", "20240201", "20240201", D(10), D(4), "0000012345"),
             ("400", "0004000005", "00010", "0001", "20240201", "20240201", D(10), D(0), None),
             ("400", "0003999999", "00010", "0001", "20240201", "20240201", D(10), D(0), None)]
    return frames(
        spark, EKKO=(EKKO, hdr), EKPO=(EKPO, items), EKET=(EKET, lines),
        LFA1=("MANDT string, LIFNR string, NAME1 string", [("400", "0000000001", "Vendor One"),
                                                           ("300", "0000000001", "Wrong client")]),
        T001=("MANDT string, BUKRS string, WAERS string", [("400", "0000", "EUR")]),
        MAKT=("MANDT string, MATNR string, SPRAS string, MAKTX string",
              [("400", "000000000000000001", "E", "Bolt"), ("400", "000000000000000001", "D", "Schraube")]),
    )


def test_purchase_order_status_value_and_scope(spark):
    out = {r.purchasing_document_number: r for r in purchasing.purchase_order(po_sources(spark), CFG).collect()}
    assert set(out) == {"4000001", "4000002", "4000003", "4000004", "4000005", "4000006"}
    assert out["4000001"].po_status == "Deleted"
    assert out["4000002"].po_status == "Delivery Complete"
    assert out["4000003"].po_status == "Fully Received"
    assert out["4000004"].po_status == "Partially Received"
    assert out["4000005"].po_status == "Open"
    assert out["4000006"].po_status == "Open" and out["4000006"].schedule_line_counter is None
    assert out["4000003"].total_value is None                      # price unit 0
    assert out["4000004"].total_value == D("12.34")                # 10 * 12.34 / 10
    assert out["4000005"].total_value == D("123.40")
    assert out["4000002"].material_description == "free text"     # blank material
    assert out["4000003"].material_description == "free text"     # NULL material
    assert out["4000004"].material_description is None            # material without text
    assert out["4000001"].material_description == "Bolt"           # English only, no fan-out
    assert out["4000001"].vendor_name == "Vendor One"
    assert out["4000004"].purchase_requisition_number == "12345"
    assert out["4000001"].local_currency == "EUR"


def test_stock_transfer_range(spark):
    out = purchasing.stock_transfer(po_sources(spark), CFG).collect()
    assert [r.purchasing_document_number for r in out] == ["3999999"]
    assert out[0].supplying_plant == "1002" and out[0].sto_status == "Open"


def test_inventory_drops_all_zero_and_values(spark):
    q = "decimal(13,3)"
    src = frames(
        spark,
        MARD=(f"MANDT string, MATNR string, WERKS string, LGORT string, LABST {q}, INSME {q}, SPEME {q}, UMLME {q}, "
              f"EINME {q}, RETME {q}",
              [("400", "M1", "1001", "0001", D(0), None, D(0), None, D(0), D(0)),
               ("400", "M1", "1001", "0002", D(-1), None, None, None, None, None),
               ("400", "M1", "1001", "0003", D(3), D(1), None, None, None, None)]),
        MSKA=(f"MANDT string, MATNR string, WERKS string, LGORT string, KALAB {q}, KAINS {q}, KASPE {q}, KAEIN {q}", []),
        MSPR=(f"MANDT string, MATNR string, WERKS string, LGORT string, PRLAB {q}, PRINS {q}, PRSPE {q}, PREIN {q}", []),
        MSSL=(f"MANDT string, MATNR string, WERKS string, SOBKZ string, SLLAB {q}, SLINS {q}, SLUML {q}, SLEIN {q}",
              [("400", "M1", "1001", "W", D(5), None, None, None), ("400", "M1", "1001", "O", D(2), None, None, None)]),
        MARA=("MANDT string, MATNR string, MTART string, SPART string, MEINS string, MATKL string",
              [("400", "M1", "ZROH", "1", "EA", "G")]),
        MAKT=("MANDT string, MATNR string, SPRAS string, MAKTX string", [("400", "M1", "E", "Steel")]),
        MARC=("MANDT string, MATNR string, WERKS string, PRCTR string, ABCIN string", [("400", "M1", "1001", "PC", "A")]),
        MBEW=("MANDT string, MATNR string, BWKEY string, BWTAR string, BKLAS string, STPRS decimal(11,2), "
              "PEINH decimal(5,0)", [("400", "M1", "1001", "", "3000", D("10.05"), D(10)),
                                     ("400", "M1", "1001", None, "9999", D("99.00"), D(1))]),
    )
    out = {(r.storage_location, r.special_stock_indicator): r for r in materials.inventory(src, CFG).collect()}
    assert set(out) == {("0002", ""), ("0003", ""), (None, "O")}
    r = out[("0003", "")]
    assert r.unit_price == D("1.01") and r.total_qty == D(4) and r.total_value == D("4.04")
    assert r.valuation_class == "3000"


def test_vendor_master_preferred_email(spark):
    src = frames(
        spark,
        LFA1=("MANDT string, LIFNR string, ADRNR string, NAME1 string, NAME2 string, KTOKK string, BRSCH string, "
              "LAND1 string, REGIO string, ORT01 string, PSTLZ string, STRAS string, TELF1 string, TELFX string, "
              "STCD1 string, STCD2 string, SPERR string, LOEVM string",
              [("400", f"V{i}", f"A{i}", f"Vendor {i}", *([None] * 14)) for i in range(1, 5)]),
        ADR6=("CLIENT string, ADDRNUMBER string, SMTP_ADDR string, FLGDEFAULT string",
              [("400", "A1", "z@x", "X"), ("400", "A1", "b@x", "X"), ("400", "A1", "a@x", ""),   # two defaults
               ("400", "A2", "c@x", None), ("400", "A2", "b@x", ""),                            # no default
               ("400", "A3", "", "X"), ("400", "A3", "d@x", None),                              # blank ignored
               ("300", "A4", "other@client", "X")]),
        LFM1=("MANDT string, LIFNR string, EKORG string, ZTERM string, WAERS string, INCO1 string, INCO2 string, "
              "MINBW decimal(13,2), WEBRE string, LOEVM string",
              [("400", "V1", "4000", "N030", "USD", None, None, D(1), "X", ""),
               ("400", "V1", "4001", "N030", "USD", None, None, D(1), "X", "")]),
    )
    out = partners.vendor_master(src, CFG).collect()
    email = {r.vendor_account_number: r.email for r in out}
    assert email == {"V1": "b@x", "V2": "b@x", "V3": "d@x", "V4": None}
    assert sum(1 for r in out if r.vendor_account_number == "V1") == 2


def test_movement_type_requires_text(spark):
    src = frames(
        spark,
        T156=("MANDT string, BWART string", [("400", "101"), ("400", "999"), ("400", "551")]),
        T156T=("MANDT string, BWART string, SPRAS string, BTEXT string",
               [("400", "101", "E", "GR goods receipt"), ("400", "101", "E", "GR goods receipt"),
                ("400", "101", "D", "WE Wareneingang")]),
    )
    out = {r.movement_type: r for r in codes.movement_type(src, CFG).collect()}
    assert set(out) == {"101", "551"}
    assert out["101"].breakdown == "Goods Receipt" and out["101"].sap_description == "GR goods receipt"
    assert out["551"].breakdown == "Scrap" and out["551"].sap_description is None


def test_payment_terms_by_day_limit(spark):
    src = frames(spark,
                 T052=("MANDT string, ZTERM string, ZTAGG string, ZTAG1 string", [("400", "Z1", "00", "0"), ("400", "Z1", "15", "30")]),
                 T052U=("MANDT string, SPRAS string, ZTERM string, ZTAGG string, TEXT1 string",
                        [("400", "E", "Z1", "00", "at once"), ("400", "E", "Z1", "15", "in 30 days")]))
    got = sorted(tuple(r) for r in codes.payment_terms(src, MartConfig()).collect())
    assert got == [("Z1", "at once", "0"), ("Z1", "in 30 days", "30")]


def test_company_values_are_required(spark):
    import pytest

    src = frames(spark, T001L=("MANDT string, WERKS string, LGORT string, LGOBE string", [("400", "1", "1", "x")]))
    with pytest.raises(ValueError, match="storage_plants"):
        codes.storage_locations(src, MartConfig())
