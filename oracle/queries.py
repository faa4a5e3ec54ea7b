"""Oracle SQL per registered query: the reference semantics restated in plain SQL.

Conventions shared with the Spark side (see ``martforge.plans.registry``): as-of date
``AS_OF``; decimal results cast to the declared types; ``/`` by a price unit written as a
multiplication by its exact reciprocal (DuckDB divides decimals in DOUBLE).
"""

from __future__ import annotations

from oracle.shapes import SHAPES, with_shapes

AS_OF = "DATE '2000-01-01'"


def STRIP(x):
    return f"(case when regexp_matches({x}, '^[0-9]+$') then regexp_replace({x}, '^0+', '') else {x} end)"


def STRIP_KEEP0(x):
    return (f"(case when regexp_matches({x}, '^[0-9]+$') then "
            f"(case when ltrim({x}, '0') = '' then '0' else ltrim({x}, '0') end) else {x} end)")


def D(x):
    return f"coalesce(try_strptime({x}, '%Y%m%d')::date, try_strptime({x}, '%Y-%m-%d')::date)"


def PER(unit):
    """Exact reciprocal of a price unit (1, 10, 100, 1000); NULL for 0 or NULL."""
    return (f"(case cast({unit} as integer) when 1 then 1.000 when 10 then 0.100 when 100 then 0.010 "
            f"when 1000 then 0.001 end)")


def UNSET(x):
    return f"({x} IS NULL OR {x} = '')"


def FALLBACK(key, free, master):
    return f"(case when {UNSET(key)} then {free} else {master} end)"


SQL: dict[str, str] = {}

# ----------------------------------------------------------------------------- vendor OTD
_OTD = f"""
s AS (
  SELECT EBELN, EBELP, ETENR, EINDT, SLFDT, MENGE AS sched_menge, WEMNG AS gr_qty_wemng,
    row_number() OVER (PARTITION BY EBELN, EBELP ORDER BY EINDT, ETENR) AS sched_rank,
    sum(MENGE) OVER (PARTITION BY EBELN, EBELP ORDER BY EINDT, ETENR
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_sched
  FROM EKET WHERE MANDT = '400' AND EBELN BETWEEN '0004000000' AND '0004999999'),
r AS (
  SELECT EBELN, EBELP, BUDAT, BELNR,
    row_number() OVER (PARTITION BY EBELN, EBELP ORDER BY BUDAT, BELNR, BUZEI) AS gr_rank,
    sum(MENGE) OVER (PARTITION BY EBELN, EBELP ORDER BY BUDAT, BELNR, BUZEI
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_gr
  FROM EKBE WHERE MANDT = '400' AND BEWTP = 'E' AND SHKZG = 'S'),
m AS (
  SELECT s.*, r.BUDAT, r.BELNR, r.gr_rank, r.cum_gr,
    row_number() OVER (PARTITION BY s.EBELN, s.EBELP, s.sched_rank ORDER BY r.gr_rank ASC NULLS LAST) AS rn
  FROM s LEFT JOIN r ON s.EBELN = r.EBELN AND s.EBELP = r.EBELP AND r.cum_gr >= s.cum_sched),
otd AS (
  SELECT {STRIP('m.EBELN')} AS purchasing_document_number, {STRIP('m.EBELP')} AS purchasing_document_item,
    m.ETENR AS schedule_line_counter, k.BSART AS purchasing_document_type,
    {STRIP('k.LIFNR')} AS vendor_account_number, v.NAME1 AS vendor_name,
    {STRIP('p.MATNR')} AS material_number, {FALLBACK('p.MATNR', 'p.TXZ01', 't.MAKTX')} AS material_description,
    p.MATKL AS material_group, p.WERKS AS plant, k.EKGRP AS purchasing_group, k.EKORG AS purchasing_organization,
    k.BEDAT AS purchasing_document_date, m.EINDT AS scheduled_delivery_date, m.SLFDT AS statistics_delivery_date,
    cast(m.sched_menge AS decimal(18,3)) AS scheduled_quantity, cast(m.gr_qty_wemng AS decimal(18,3)) AS gr_quantity,
    cast(m.sched_menge - m.gr_qty_wemng AS decimal(18,3)) AS open_quantity,
    m.BUDAT AS gr_date, m.BELNR AS gr_document_number,
    case when m.BUDAT IS NULL then NULL when {D('m.BUDAT')} <= {D('m.EINDT')} then true else false end AS delivered_on_time,
    case when m.BUDAT IS NOT NULL AND m.EINDT IS NOT NULL
         then cast(datediff('day', {D('m.BUDAT')}, {D('m.EINDT')}) AS integer) end AS days_early_late,
    case when m.BUDAT IS NULL then (case when {D('m.EINDT')} < {AS_OF} then 'Overdue' else 'Open' end)
         when {D('m.BUDAT')} <= {D('m.EINDT')} then 'On Time' else 'Late' end AS otd_status
  FROM m
  JOIN EKPO p ON p.MANDT = '400' AND p.EBELN = m.EBELN AND p.EBELP = m.EBELP
  JOIN EKKO k ON k.MANDT = '400' AND k.EBELN = m.EBELN AND k.EBELN BETWEEN '0004000000' AND '0004999999'
  LEFT JOIN (SELECT LIFNR, NAME1 FROM LFA1 WHERE MANDT = '400') v ON v.LIFNR = k.LIFNR
  LEFT JOIN (SELECT MATNR, MAKTX FROM MAKT WHERE MANDT = '400' AND SPRAS = 'E') t ON t.MATNR = p.MATNR
  WHERE m.rn = 1)"""
_OTD_TABLES = ["EKET", "EKBE", "EKPO", "EKKO", "LFA1", "MAKT"]

SQL["otd_completion"] = with_shapes(_OTD_TABLES, f", {_OTD.strip()}\nSELECT * FROM otd")

SQL["otd_status_by_vendor"] = with_shapes(_OTD_TABLES, f""", {_OTD.strip()}
SELECT vendor_account_number, vendor_name, otd_status, count(*) AS lines,
  cast(sum(scheduled_quantity) AS decimal(18,3)) AS scheduled_quantity
FROM otd GROUP BY vendor_account_number, vendor_name, otd_status""")

SQL["running_qty"] = with_shapes(["EKET"], """
SELECT EBELN, EBELP, ETENR, EINDT, MENGE AS sched_menge,
  cast(sum(MENGE) OVER (PARTITION BY EBELN, EBELP ORDER BY EINDT, ETENR
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS decimal(18,3)) AS cum_sched_qty,
  cast(row_number() OVER (PARTITION BY EBELN, EBELP ORDER BY EINDT, ETENR) AS integer) AS sched_rank
FROM EKET WHERE MANDT = '400' AND EBELN BETWEEN '0004000000' AND '0004999999'""")

MAKT_E = "(SELECT MATNR, MAKTX FROM MAKT WHERE MANDT = '400' AND SPRAS = 'E')"
LFA1_N = "(SELECT LIFNR, NAME1 FROM LFA1 WHERE MANDT = '400')"


def STATUS(deleted, completed, received, scheduled):
    return (f"(case when {deleted} = 'X' then 'Deleted' when {completed} = 'X' then 'Delivery Complete' "
            f"when {received} >= {scheduled} then 'Fully Received' when {received} > 0 then 'Partially Received' "
            f"else 'Open' end)")


def Q(x, t="decimal(18,3)"):
    return f"cast({x} AS {t})"


SQL["po_lines_status"] = with_shapes(["EKKO", "EKPO", "EKET", "LFA1", "T001", "MAKT"], f"""
SELECT {STRIP('k.EBELN')} AS purchasing_document_number, {STRIP('p.EBELP')} AS purchasing_document_item,
  e.ETENR AS schedule_line_counter, k.BSART AS purchasing_document_type, {STRIP('k.LIFNR')} AS vendor_account_number,
  v.NAME1 AS vendor_name, {STRIP('p.MATNR')} AS material_number,
  {FALLBACK('p.MATNR', 'p.TXZ01', 't.MAKTX')} AS material_description, p.MEINS AS po_unit_of_measure,
  k.WAERS AS po_currency, p.WERKS AS plant, p.MATKL AS material_group, k.BEDAT AS purchasing_document_date,
  e.EINDT AS item_delivery_date, e.SLFDT AS statistics_delivery_date, c.WAERS AS local_currency,
  {Q('p.MENGE')} AS po_quantity, {Q('e.MENGE')} AS scheduled_quantity, {Q('e.WEMNG')} AS gr_quantity,
  {Q('e.MENGE - e.WEMNG')} AS quantity_to_be_delivered, {STRIP('e.BANFN')} AS purchase_requisition_number,
  {Q('p.PEINH')} AS price_unit, {Q('p.NETPR', 'decimal(18,4)')} AS net_price,
  {Q(f"round(e.MENGE * p.NETPR * {PER('p.PEINH')}, 2)", 'decimal(18,2)')} AS total_value,
  p.WEPOS AS gr_indicator, p.REPOS AS invoice_receipt_indicator, p.PSTYP AS item_category,
  p.KNTTP AS account_assignment_category, p.LOEKZ AS deletion_indicator, p.ELIKZ AS delivery_completed_indicator,
  {STATUS('p.LOEKZ', 'p.ELIKZ', 'e.WEMNG', 'e.MENGE')} AS po_status, k.EKGRP AS purchasing_group,
  p.LGORT AS storage_location, k.EKORG AS purchasing_organization
FROM EKKO k
JOIN EKPO p ON p.MANDT = '400' AND p.EBELN = k.EBELN
LEFT JOIN (SELECT * FROM EKET WHERE MANDT = '400') e ON e.EBELN = p.EBELN AND e.EBELP = p.EBELP
LEFT JOIN {LFA1_N} v ON v.LIFNR = k.LIFNR
LEFT JOIN (SELECT BUKRS, WAERS FROM T001 WHERE MANDT = '400') c ON c.BUKRS = k.BUKRS
LEFT JOIN {MAKT_E} t ON t.MATNR = p.MATNR
WHERE k.MANDT = '400' AND k.EBELN BETWEEN '0004000000' AND '0004999999'""")

SQL["sto_lines_status"] = with_shapes(["EKKO", "EKPO", "EKET", "T001", "MAKT"], f"""
SELECT {STRIP('k.EBELN')} AS purchasing_document_number, {STRIP('p.EBELP')} AS purchasing_document_item,
  e.ETENR AS schedule_line_counter, k.BSART AS purchasing_document_type, {STRIP('p.MATNR')} AS material_number,
  t.MAKTX AS material_description, p.MEINS AS po_unit_of_measure, p.WERKS AS receiving_plant,
  p.RESWK AS supplying_plant, p.MATKL AS material_group, k.BEDAT AS purchasing_document_date,
  e.EINDT AS item_delivery_date, e.SLFDT AS statistics_delivery_date, c.WAERS AS local_currency,
  {Q('p.MENGE')} AS po_quantity, {Q('e.MENGE')} AS scheduled_quantity, {Q('e.WEMNG')} AS gr_quantity,
  {Q('e.MENGE - e.WEMNG')} AS quantity_to_be_delivered, {Q('p.PEINH')} AS price_unit,
  {Q('p.NETPR', 'decimal(18,4)')} AS net_price,
  {Q(f"round(e.MENGE * p.NETPR * {PER('p.PEINH')}, 2)", 'decimal(18,2)')} AS total_value,
  p.WEPOS AS gr_indicator, p.PSTYP AS item_category, p.LOEKZ AS deletion_indicator,
  p.ELIKZ AS delivery_completed_indicator, {STATUS('p.LOEKZ', 'p.ELIKZ', 'e.WEMNG', 'e.MENGE')} AS sto_status,
  k.EKGRP AS purchasing_group, p.LGORT AS storage_location, k.EKORG AS purchasing_organization
FROM EKKO k
JOIN EKPO p ON p.MANDT = '400' AND p.EBELN = k.EBELN
LEFT JOIN (SELECT * FROM EKET WHERE MANDT = '400') e ON e.EBELN = p.EBELN AND e.EBELP = p.EBELP
LEFT JOIN (SELECT BUKRS, WAERS FROM T001 WHERE MANDT = '400') c ON c.BUKRS = k.BUKRS
LEFT JOIN {MAKT_E} t ON t.MATNR = p.MATNR
WHERE k.MANDT = '400' AND k.EBELN BETWEEN '0003000000' AND '0003999999'""")

SQL["pr_gr_linkage"] = with_shapes(["EBAN", "MAKT", "EKPO", "EKET"], f"""
SELECT {STRIP('b.BANFN')} AS purchase_requisition_number, b.BNFPO AS purchase_requisition_item,
  {STRIP('b.MATNR')} AS material_number, {FALLBACK('b.MATNR', 'b.TXZ01', 't.MAKTX')} AS material_description,
  b.EKGRP AS purchasing_group, b.MATKL AS material_group, b.STATU AS processing_status, b.FRGST AS release_status,
  b.FRGKZ AS release_indicator, {STRIP('b.EBELN')} AS purchasing_document_number,
  {STRIP('b.LIFNR')} AS vendor_account_number, b.EBAKZ AS pr_closed, b.WERKS AS plant,
  b.BADAT AS requisition_date, b.FRGDT AS release_date, b.LFDAT AS item_delivery_date, b.MEINS AS unit_of_measure,
  b.WAERS AS currency, {Q('b.PLIFZ', 'decimal(5,0)')} AS planned_delivery_time_days, {Q('b.MENGE')} AS pr_quantity,
  {Q('b.PREIS', 'decimal(18,4)')} AS pr_price, {Q('b.PEINH')} AS price_unit, {Q('b.MNG02')} AS committed_quantity,
  {Q('b.BSMNG')} AS ordered_quantity, {Q('p.NETPR', 'decimal(18,4)')} AS net_price_po, {Q('g.gr_qty')} AS gr_quantity
FROM EBAN b
LEFT JOIN {MAKT_E} t ON t.MATNR = b.MATNR
LEFT JOIN (SELECT EBELN, EBELP, NETPR FROM EKPO WHERE MANDT = '400') p ON p.EBELN = b.EBELN AND p.EBELP = b.EBELP
LEFT JOIN (SELECT EBELN, EBELP, sum(WEMNG) AS gr_qty FROM EKET WHERE MANDT = '400' GROUP BY EBELN, EBELP) g
  ON g.EBELN = b.EBELN AND g.EBELP = b.EBELP
WHERE b.MANDT = '400'""")

_STOCK = """stock AS (
  SELECT MATNR, WERKS, LGORT, '' AS ssi, coalesce(LABST, 0) AS u, coalesce(INSME, 0) AS qi, coalesce(SPEME, 0) AS bl,
    coalesce(UMLME, 0) AS tr, coalesce(EINME, 0) AS re, coalesce(RETME, 0) AS rt FROM MARD WHERE MANDT = '400'
  UNION ALL SELECT MATNR, WERKS, LGORT, 'E', coalesce(KALAB, 0), coalesce(KAINS, 0), coalesce(KASPE, 0), 0,
    coalesce(KAEIN, 0), 0 FROM MSKA WHERE MANDT = '400'
  UNION ALL SELECT MATNR, WERKS, LGORT, 'Q', coalesce(PRLAB, 0), coalesce(PRINS, 0), coalesce(PRSPE, 0), 0,
    coalesce(PREIN, 0), 0 FROM MSPR WHERE MANDT = '400'
  UNION ALL SELECT MATNR, WERKS, NULL, SOBKZ, coalesce(SLLAB, 0), coalesce(SLINS, 0), 0, coalesce(SLUML, 0),
    coalesce(SLEIN, 0), 0 FROM MSSL WHERE MANDT = '400' AND SOBKZ IN ('O', 'V'))"""

SQL["inventory_union_value"] = with_shapes(["MARD", "MSKA", "MSPR", "MSSL", "MARA", "MAKT", "MARC", "MBEW"], f""", {_STOCK},
val AS (SELECT MATNR, BWKEY AS WERKS, BKLAS, round(STPRS * {PER('PEINH')}, 2) AS unit_price
        FROM MBEW WHERE MANDT = '400' AND BWTAR = '')
SELECT {STRIP('s.MATNR')} AS material_number, t.MAKTX AS material_description, s.WERKS AS plant,
  c.PRCTR AS profit_center, a.SPART AS division, s.LGORT AS storage_location, s.ssi AS special_stock_indicator,
  a.MTART AS material_type, c.ABCIN AS abc_indicator, a.MEINS AS base_unit_of_measure, a.MATKL AS material_group,
  v.BKLAS AS valuation_class, {Q('v.unit_price', 'decimal(18,4)')} AS unit_price,
  {Q('s.u')} AS unrestricted_qty, {Q('s.qi')} AS quality_inspection_qty, {Q('s.bl')} AS blocked_qty,
  {Q('s.tr')} AS transfer_qty, {Q('s.re')} AS restricted_use_qty, {Q('s.rt')} AS returns_qty,
  {Q('s.u + s.qi + s.bl + s.tr + s.re + s.rt')} AS total_qty,
  {Q('round((s.u + s.qi + s.bl + s.tr + s.re + s.rt) * v.unit_price, 2)', 'decimal(18,2)')} AS total_value
FROM stock s
JOIN (SELECT * FROM MARA WHERE MANDT = '400') a ON a.MATNR = s.MATNR
JOIN {MAKT_E} t ON t.MATNR = s.MATNR
JOIN (SELECT * FROM MARC WHERE MANDT = '400') c ON c.MATNR = s.MATNR AND c.WERKS = s.WERKS
LEFT JOIN val v ON v.MATNR = s.MATNR AND v.WERKS = s.WERKS
WHERE s.u <> 0 OR s.qi <> 0 OR s.bl <> 0 OR s.tr <> 0 OR s.re <> 0 OR s.rt <> 0""")

SQL["material_details"] = with_shapes(["MARC", "MARA", "MAKT", "MBEW"], f"""
SELECT {STRIP('c.MATNR')} AS material_number, t.MAKTX AS material_description, c.WERKS AS plant,
  a.MTART AS material_type, a.MATKL AS material_group, a.MEINS AS base_unit_of_measure, a.SPART AS division,
  a.BISMT AS old_material_number, a.ERSDA AS creation_date, {Q('a.NTGEW')} AS net_weight,
  {Q('a.BRGEW')} AS gross_weight, a.GEWEI AS weight_unit, {Q('a.VOLUM')} AS volume, a.VOLEH AS volume_unit,
  a.MFRPN AS manufacturer_part_number, c.PRCTR AS profit_center, c.DISMM AS mrp_type, c.DISPO AS mrp_controller,
  c.DISLS AS lot_sizing_procedure, c.BESKZ AS procurement_type, c.SOBSL AS special_procurement_type,
  c.MMSTA AS plant_material_status, c.ABCIN AS abc_indicator, c.EKGRP AS purchasing_group,
  {Q('c.PLIFZ', 'decimal(5,0)')} AS planned_delivery_time_days, {Q('c.WEBAZ', 'decimal(5,0)')} AS gr_processing_time_days,
  {Q('c.EISBE')} AS safety_stock_qty, {Q('c.MINBE')} AS reorder_point, {Q('c.MABST')} AS maximum_stock_level,
  v.BKLAS AS valuation_class, v.VPRSV AS price_control, {Q('v.STPRS', 'decimal(18,4)')} AS standard_price,
  {Q('v.VERPR', 'decimal(18,4)')} AS moving_average_price, {Q('v.PEINH')} AS price_unit
FROM MARC c
JOIN (SELECT * FROM MARA WHERE MANDT = '400') a ON a.MATNR = c.MATNR
LEFT JOIN {MAKT_E} t ON t.MATNR = c.MATNR
LEFT JOIN (SELECT * FROM MBEW WHERE MANDT = '400' AND BWTAR = '') v ON v.MATNR = c.MATNR AND v.BWKEY = c.WERKS
WHERE c.MANDT = '400'""")

SQL["goods_movements"] = with_shapes(["MSEG", "MKPF", "MAKT", "MARA"], f"""
SELECT h.BUDAT AS posting_date, h.BLDAT AS document_date, s.MBLNR AS material_document_number,
  s.MJAHR AS material_document_year, s.ZEILE AS material_document_item, s.BWART AS movement_type,
  s.SHKZG AS debit_credit_indicator, {STRIP('s.MATNR')} AS material_number, t.MAKTX AS material_description,
  a.MTART AS material_type, a.MATKL AS material_group, s.WERKS AS plant, s.LGORT AS storage_location,
  s.SOBKZ AS special_stock_indicator, {Q('s.MENGE')} AS quantity, s.MEINS AS unit_of_measure,
  {Q('s.DMBTR', 'decimal(18,2)')} AS amount_local_currency, {STRIP('s.AUFNR')} AS order_number,
  {STRIP('s.EBELN')} AS purchase_order_number, {STRIP('s.EBELP')} AS purchase_order_item, s.KOSTL AS cost_center,
  {STRIP('s.RSNUM')} AS reservation_number, h.USNAM AS created_by
FROM MSEG s
JOIN (SELECT * FROM MKPF WHERE MANDT = '400') h ON h.MBLNR = s.MBLNR AND h.MJAHR = s.MJAHR
LEFT JOIN {MAKT_E} t ON t.MATNR = s.MATNR
LEFT JOIN (SELECT MATNR, MTART, MATKL FROM MARA WHERE MANDT = '400') a ON a.MATNR = s.MATNR
WHERE s.MANDT = '400'""")

SQL["last_movement"] = with_shapes(["MSEG", "MKPF", "MAKT", "MARA"], f""",
mv AS (
  SELECT s.MATNR, s.WERKS, s.BWART, s.MBLNR, h.BUDAT,
    row_number() OVER (PARTITION BY s.MATNR, s.WERKS
      ORDER BY h.BUDAT DESC NULLS LAST, s.MBLNR DESC NULLS LAST, s.MJAHR DESC NULLS LAST, s.ZEILE DESC NULLS LAST,
               s.BWART DESC NULLS LAST) AS rn
  FROM MSEG s JOIN MKPF h ON h.MANDT = '400' AND h.MBLNR = s.MBLNR AND h.MJAHR = s.MJAHR
  WHERE s.MANDT = '400')
SELECT {STRIP('mv.MATNR')} AS material_number, t.MAKTX AS material_description, a.MTART AS material_type,
  a.MATKL AS material_group, mv.WERKS AS plant, mv.BUDAT AS last_movement_date, mv.BWART AS last_movement_type,
  mv.MBLNR AS last_document_number,
  cast(datediff('day', {D('mv.BUDAT')}, {AS_OF}) AS integer) AS days_since_last_movement
FROM mv
LEFT JOIN {MAKT_E} t ON t.MATNR = mv.MATNR
LEFT JOIN (SELECT MATNR, MTART, MATKL FROM MARA WHERE MANDT = '400') a ON a.MATNR = mv.MATNR
WHERE mv.rn = 1""")

SQL["reservations_open"] = with_shapes(["RESB", "MAKT"], f"""
SELECT r.RSNUM AS reservation_number, r.RSPOS AS reservation_item, {STRIP('r.AUFNR')} AS order_number,
  {STRIP('r.MATNR')} AS material_number, t.MAKTX AS material_description, r.WERKS AS plant,
  r.LGORT AS storage_location, r.SOBKZ AS special_stock_indicator, r.RSART AS reservation_type,
  r.KNTTP AS account_assignment_category, r.BWART AS movement_type, r.BDTER AS requirement_date,
  r.MEINS AS base_unit_of_measure, {Q('r.BDMNG', 'decimal(13,3)')} AS requirement_qty,
  {Q('r.ENMNG', 'decimal(13,3)')} AS withdrawn_qty, {Q('r.BDMNG - r.ENMNG', 'decimal(13,3)')} AS difference_qty,
  r.KZEAR AS final_issue_indicator
FROM RESB r JOIN {MAKT_E} t ON t.MATNR = r.MATNR
WHERE r.MANDT = '400' AND coalesce(r.XLOEK, '') <> 'X'""")

SQL["approved_parts"] = with_shapes(["AMPL", "MARA", "MAKT", "LFA1"], f"""
SELECT {STRIP_KEEP0('a.EMATN')} AS MPN_Number,
  {STRIP_KEEP0("(case when a.BMATN IS NOT NULL AND a.BMATN <> '' then a.BMATN else a.EMATN end)")} AS Material_Number,
  t.MAKTX AS Material_Description, v.NAME1 AS Manufacturer_Name, a.MFRNR AS Manufacturer_Number,
  m.MFRPN AS Manufacturer_Material_Number, a.WERKS AS Plant, a.DATUV AS Valid_From, a.DATUB AS Valid_To
FROM AMPL a
LEFT JOIN (SELECT * FROM MARA WHERE MANDT = '400') m ON m.MATNR = a.EMATN
LEFT JOIN {MAKT_E} t ON t.MATNR = a.BMATN
LEFT JOIN {LFA1_N} v ON v.LIFNR = a.MFRNR
WHERE a.MANDT = '400' AND a.WERKS IS NOT NULL""")

SQL["class_cross"] = with_shapes(["MARA", "MARC"], """
SELECT t.MTART AS material_type, p.BESKZ AS procurement_type,
  case when t.MTART = 'ZERT' AND p.BESKZ = 'F' then 'Tradable/Resale'
       when t.MTART = 'ZALB' AND p.BESKZ = 'F' then 'Raw'
       when t.MTART = 'ZALB' AND (p.BESKZ IN ('E', 'X') OR p.BESKZ IS NULL OR p.BESKZ = '') then 'Semi-FG'
       when t.MTART = 'ZERT' AND (p.BESKZ IN ('E', 'X') OR p.BESKZ IS NULL OR p.BESKZ = '') then 'FG'
       when t.MTART IN ('ZERP', 'ZHMI', 'ZIBE') then 'Operating/Packing Supplies'
       when t.MTART = 'ZIEN' then 'Service'
       when t.MTART IN ('ZLAG', 'ZROC') then 'Non-Stock Material'
       when t.MTART = 'ZROH' then 'Raw'
       when t.MTART IN ('ZAWB', 'ZAWA') then 'Tradable/Resale'
       else 'Unknown' end AS material_class
FROM (SELECT DISTINCT MTART FROM MARA WHERE MANDT = '400' AND MTART NOT IN ('ZONT', 'ZHER', 'HERS')) t
CROSS JOIN (SELECT DISTINCT BESKZ FROM MARC WHERE MANDT = '400') p""")

_VENDOR_MASTER = f"""vm AS (
  SELECT {STRIP('l.LIFNR')} AS vendor_account_number, l.NAME1 AS vendor_name, l.NAME2 AS vendor_name_2,
    l.KTOKK AS account_group, l.BRSCH AS industry, l.LAND1 AS country, l.REGIO AS region, l.ORT01 AS city,
    l.PSTLZ AS postal_code, l.STRAS AS street_address, l.TELF1 AS telephone, l.TELFX AS fax,
    l.STCD1 AS tax_number_1, l.STCD2 AS tax_number_2, l.SPERR AS posting_block, l.LOEVM AS central_deletion_flag,
    e.SMTP_ADDR AS email, f.EKORG AS purchasing_organization, f.ZTERM AS payment_terms, f.WAERS AS order_currency,
    f.INCO1 AS incoterms, f.INCO2 AS incoterms_description, {Q('f.MINBW', 'decimal(18,2)')} AS minimum_order_value,
    f.WEBRE AS gr_based_iv_indicator, f.LOEVM AS purchasing_block
  FROM LFA1 l
  LEFT JOIN (
    SELECT ADDRNUMBER, SMTP_ADDR FROM (
      SELECT ADDRNUMBER, SMTP_ADDR, row_number() OVER (PARTITION BY ADDRNUMBER
        ORDER BY coalesce(FLGDEFAULT, '') DESC NULLS LAST, SMTP_ADDR ASC NULLS FIRST) AS rn
      FROM ADR6 WHERE CLIENT = '400' AND SMTP_ADDR IS NOT NULL AND SMTP_ADDR <> '') WHERE rn = 1
  ) e ON e.ADDRNUMBER = l.ADRNR
  LEFT JOIN (SELECT * FROM LFM1 WHERE MANDT = '400') f ON f.LIFNR = l.LIFNR
  WHERE l.MANDT = '400')"""

SQL["vendor_preferred_contact"] = with_shapes(["LFA1", "ADR6", "LFM1"], f", {_VENDOR_MASTER}\nSELECT * FROM vm")
SQL["write_mart_roundtrip"] = SQL["vendor_preferred_contact"]
SQL["surrogate_key"] = with_shapes(["LFA1", "ADR6", "LFM1"], f""", {_VENDOR_MASTER}
SELECT cast(row_number() OVER (ORDER BY vendor_account_number ASC NULLS FIRST,
  purchasing_organization ASC NULLS FIRST) AS bigint) AS surrogate_id, * FROM vm""")


def _values(mapping: dict, name: str) -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in mapping.items())
    return f"(SELECT * FROM (VALUES {rows}) AS {name}(code, label))"


def _like_any(col: str, patterns) -> str:
    return "(" + " OR ".join(f"contains(upper({col}), '{p.upper()}')" for p in patterns) + ")"


def _config():
    from martforge.plans.registry import DRIVER_CONFIG

    return DRIVER_CONFIG


def _affiliate_sql():
    cfg = _config()
    cust = with_shapes(["KNA1"], f"""
SELECT {STRIP('c.KUNNR')} AS customer_number, c.NAME1 AS customer_name, c.ORT01 AS city,
  coalesce(m.label, 'TBD') AS short_name
FROM KNA1 c LEFT JOIN {_values(cfg.customer_labels, 'labels')} m ON m.code = c.KUNNR
WHERE c.MANDT = '400' AND {_like_any('c.NAME1', cfg.customer_name_patterns)}
  AND (c.LOEVM IS NULL OR c.LOEVM = '') AND (c.SPERR IS NULL OR c.SPERR = '')
  AND NOT starts_with(c.NAME1, '{cfg.customer_excluded_name_prefix}')
  AND NOT contains(c.KUNNR, '{cfg.customer_excluded_number_part}')""")
    vend = with_shapes(["LFA1"], f"""
SELECT {STRIP('v.LIFNR')} AS vendor_number, v.NAME1 AS vendor_name, v.LAND1 AS country,
  coalesce(m.label, 'TBD') AS short_name
FROM LFA1 v LEFT JOIN {_values(cfg.vendor_labels, 'labels')} m ON m.code = v.LIFNR
WHERE v.MANDT = '400' AND {_like_any('v.NAME1', cfg.vendor_name_patterns)}""")
    return cust, vend


SQL["affiliates_customers"], SQL["affiliates_vendors"] = _affiliate_sql()

# ----------------------------------------------------------------------------- bill of materials
TIEBREAK = ("plant ASC NULLS FIRST, parent_matnr ASC NULLS FIRST, bom_usage ASC NULLS FIRST, "
            "alt_bom ASC NULLS FIRST, item_node DESC NULLS LAST, item_number ASC NULLS FIRST, "
            "component_matnr ASC NULLS FIRST")
REV = "'^([0-9]+)([A-Z])$'"
def _bom(scope: str = "bom_number", assigned: str = "true") -> str:
    return f"""mast_d AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY MATNR, WERKS, STLAN, STLAL ORDER BY STLNR DESC NULLS LAST) AS rn
                 FROM MAST WHERE MANDT = '400') WHERE rn = 1 AND {assigned}),
stko_d AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY STLNR, STLAL
                   ORDER BY case when STLTY = 'M' then 0 else 1 end, STLTY ASC NULLS FIRST) AS rn
                 FROM STKO WHERE MANDT = '400') WHERE rn = 1),
stas_d AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY STLTY, STLNR, STLAL, STLKN ORDER BY DATUV DESC NULLS LAST) AS rn
                 FROM STAS WHERE MANDT = '400' AND {D('DATUV')} <= {AS_OF}) WHERE rn = 1),
stpo_d AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY STLTY, STLNR, STLKN
                   ORDER BY DATUV DESC NULLS LAST, STPOZ DESC NULLS LAST) AS rn
                 FROM STPO WHERE MANDT = '400' AND coalesce(LKENZ, '') <> 'X' AND {D('DATUV')} <= {AS_OF}) WHERE rn = 1),
direct AS (
  SELECT {STRIP('m.MATNR')} AS parent_matnr, m.WERKS AS plant, m.STLAN AS bom_usage, k.STLTY AS bom_category,
    k.STLNR AS bom_number, k.STLAL AS alt_bom, p.POSNR AS item_number, {STRIP('p.IDNRK')} AS component_matnr,
    p.MENGE AS qty, p.MEINS AS uom, p.POSTP AS item_category, p.DATUV AS valid_from, p.STLKN AS item_node,
    p.STPOZ AS item_counter
  FROM mast_d m JOIN stko_d k ON k.STLNR = m.STLNR AND k.STLAL = m.STLAL
  JOIN stas_d s ON s.STLTY = k.STLTY AND s.STLNR = k.STLNR AND s.STLAL = k.STLAL
  JOIN stpo_d p ON p.STLTY = s.STLTY AND p.STLNR = s.STLNR AND p.STLKN = s.STLKN),
layer1 AS (
  SELECT * EXCLUDE (mn) FROM (SELECT *, min(alt_bom) OVER (PARTITION BY parent_matnr, plant, bom_usage) AS mn FROM direct)
  WHERE alt_bom = mn),
layer2 AS (
  SELECT * EXCLUDE (base, rn) FROM (
    SELECT *, regexp_extract(component_matnr, {REV}, 1) AS base,
      row_number() OVER (PARTITION BY {scope}, regexp_extract(component_matnr, {REV}, 1)
        ORDER BY regexp_extract(component_matnr, {REV}, 2) DESC NULLS LAST, {TIEBREAK}) AS rn
    FROM layer1) WHERE base = '' OR (base <> '' AND rn = 1)),
layer3 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {scope}, alt_bom, component_matnr, qty, uom
      ORDER BY valid_from DESC NULLS LAST, {TIEBREAK}) AS rn FROM layer2) WHERE rn = 1),
layer4 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {scope}, alt_bom, item_number
      ORDER BY item_node DESC NULLS LAST, {TIEBREAK}) AS rn FROM layer3) WHERE rn = 1)"""

_BOM_TABLES = ["MAST", "STKO", "STAS", "STPO"]

_BOM_COLS = f"""parent_matnr, plant, bom_usage, bom_category, bom_number, alt_bom, item_number, component_matnr,
  {Q('qty')} AS qty, uom, item_category, valid_from, item_node, item_counter"""
SQL["bom_dedup_layers"] = with_shapes(_BOM_TABLES, f", {_bom()} SELECT {_BOM_COLS} FROM layer4")
SQL["bom_dedup_plant_scope"] = with_shapes(_BOM_TABLES, f", {_bom('bom_number, plant, parent_matnr')} SELECT {_BOM_COLS} FROM layer4")


def _explosion(more: str = "", where: str = "", **bom) -> str:
    """Every level; a component on its own trail is kept and not expanded."""
    return with_shapes(_BOM_TABLES + ["MAKT", "MARA"], f""", {_bom(**bom)},
ex AS (
  SELECT parent_matnr AS top_material, plant AS top_plant, parent_matnr AS parent_material,
    component_matnr AS component_material, 1 AS bom_level, [parent_matnr] AS trail,
    parent_matnr || '_' || plant || '|' || lpad(item_number, 8, '0') AS sort_path,
    plant, bom_usage, bom_category, bom_number, alt_bom, item_number, qty, uom, item_category, valid_from
  FROM layer4
  UNION ALL
  SELECT e.top_material, e.top_plant, e.component_material, d.component_matnr, e.bom_level + 1,
    list_append(e.trail, e.component_material),
    e.sort_path || '|' || lpad(d.item_number, 8, '0'), d.plant, d.bom_usage, d.bom_category, d.bom_number,
    d.alt_bom, d.item_number, d.qty, d.uom, d.item_category, d.valid_from
  FROM ex e JOIN layer4 d ON d.parent_matnr = e.component_material AND d.plant = e.top_plant
    AND d.bom_usage = e.bom_usage
  WHERE NOT list_contains(e.trail, e.component_material)),
txt AS (SELECT {STRIP('MATNR')} AS m, MAKTX FROM MAKT WHERE MANDT = '400' AND SPRAS = 'E')
SELECT ex.top_material, ex.top_plant, cast(ex.bom_level AS integer) AS bom_level, ex.parent_material,
  pt.MAKTX AS parent_description, ex.component_material, ct.MAKTX AS component_description, ex.plant, ex.bom_usage,
  ex.bom_number, ex.alt_bom, ex.bom_category, ex.item_number, {Q('ex.qty')} AS qty, ex.uom, ex.item_category,
  ex.valid_from{more}
FROM ex LEFT JOIN txt pt ON pt.m = ex.parent_material LEFT JOIN txt ct ON ct.m = ex.component_material{where}""",
        recursive=True)


SQL["bom_explosion"] = _explosion()
SQL["bom_depth_first"] = _explosion(", ex.sort_path")
SQL["bom_filtered"] = _explosion(assigned="WERKS = '1001' AND STLAN = '1'")
SQL["bom_from_materials"] = _explosion(where=f" WHERE ex.top_material IN (SELECT {STRIP('MATNR')} FROM MARA WHERE MANDT = '400' AND MTART LIKE 'Z%')")

# ----------------------------------------------------------------------------- controlling
_TIERS = """h AS (SELECT * FROM PROFIT_CENTER_HIERARCHY),
l1 AS (SELECT CHILD AS l1_child, CHILD_DESC AS l1_desc FROM h WHERE LEVEL = '1'),
l2 AS (SELECT CHILD AS l2_child, CHILD_DESC AS l2_desc, PARENT AS l2_parent FROM h WHERE LEVEL = '2'),
l3 AS (SELECT CHILD AS l3_child, CHILD_DESC AS l3_desc, PARENT AS l3_parent FROM h WHERE LEVEL = '3'),
l4 AS (SELECT CHILD AS l4_child, PARENT AS l4_parent FROM h WHERE LEVEL = '4'),
leaf3 AS (SELECT * FROM l3 WHERE NOT EXISTS (SELECT 1 FROM l4 WHERE l4.l4_parent = l3.l3_child)),
tiers AS (
  SELECT l4.l4_child AS node, l3.l3_child AS level_3_dept, l3.l3_desc AS level_3_dept_desc,
    l2.l2_child AS level_2_site, l2.l2_desc AS level_2_site_desc, l1.l1_child AS level_1_top, l1.l1_desc AS level_1_top_desc
  FROM l4 LEFT JOIN l3 ON l4.l4_parent = l3.l3_child LEFT JOIN l2 ON l3.l3_parent = l2.l2_child
  LEFT JOIN l1 ON l2.l2_parent = l1.l1_child
  UNION ALL
  SELECT leaf3.l3_child, NULL, NULL, l2.l2_child, l2.l2_desc, l1.l1_child, l1.l1_desc
  FROM leaf3 LEFT JOIN l2 ON leaf3.l3_parent = l2.l2_child LEFT JOIN l1 ON l2.l2_parent = l1.l1_child)"""

SQL["hierarchy_ragged"] = with_shapes(["PROFIT_CENTER_HIERARCHY", "CEPC", "CEPCT"], f""", {_TIERS}
SELECT c.PRCTR AS profit_center, t.KTEXT AS description, c.LOCK_IND AS lock_indicator, tiers.level_3_dept,
  tiers.level_3_dept_desc, tiers.level_2_site, tiers.level_2_site_desc, tiers.level_1_top, tiers.level_1_top_desc
FROM CEPC c
LEFT JOIN (SELECT PRCTR, KTEXT FROM CEPCT WHERE MANDT = '400' AND KOKRS = 'CA01' AND DATBI = '99991231'
           AND SPRAS = 'E') t ON t.PRCTR = c.PRCTR
LEFT JOIN tiers ON tiers.node = c.PRCTR
WHERE c.MANDT = '400' AND c.KOKRS = 'CA01' AND c.DATBI = '99991231'""")

SQL["leaf_nodes_anti"] = with_shapes(["PROFIT_CENTER_HIERARCHY"], """
SELECT CHILD AS node, CHILD_DESC AS description, PARENT AS parent FROM PROFIT_CENTER_HIERARCHY n
WHERE LEVEL = '3' AND NOT EXISTS (
  SELECT 1 FROM PROFIT_CENTER_HIERARCHY c WHERE c.LEVEL = '4' AND c.PARENT = n.CHILD)""")

SQL["active_validity"] = with_shapes(["CSKS", "CSKT"], f"""
SELECT {STRIP('s.KOSTL')} AS cost_center, t.KTEXT AS description, s.KOKRS AS controlling_area,
  s.VERAK AS responsible_person, s.ABTEI AS department
FROM CSKS s
LEFT JOIN (SELECT * FROM CSKT WHERE MANDT = '400' AND SPRAS = 'E') t
  ON t.KOSTL = s.KOSTL AND t.KOKRS = s.KOKRS AND t.DATBI = s.DATBI
WHERE s.MANDT = '400' AND {D('s.DATBI')} = DATE '9999-12-31'""")

# ----------------------------------------------------------------------------- code and text dimensions
from martforge.functions import codes as _codes  # noqa: E402  (fixed code tables are data, shared)

SQL["code_lookup_required"] = with_shapes(["T156", "T156T"], f"""
SELECT b.BWART AS movement_type, t.BTEXT AS sap_description, m.label AS movement_type_text,
  coalesce(c.label, 'Unknown') AS breakdown
FROM (SELECT BWART FROM T156 WHERE MANDT = '400') b
LEFT JOIN (SELECT DISTINCT BWART, BTEXT FROM T156T WHERE MANDT = '400' AND SPRAS = 'E') t ON t.BWART = b.BWART
LEFT JOIN {_values(_codes.MOVEMENT_TYPE_TEXT, 'texts')} m ON m.code = b.BWART
LEFT JOIN {_values(_codes.MOVEMENT_CATEGORY, 'cats')} c ON c.code = b.BWART
WHERE m.label IS NOT NULL""")

SQL["code_lookup_default"] = with_shapes(["TVAPT"], f"""
SELECT PSTYV AS item_category, VTEXT AS description, coalesce(m.label, 'TBD') AS billing_type
FROM TVAPT LEFT JOIN {_values(_codes.BILLING_TYPE, 'bt')} m ON m.code = PSTYV
WHERE MANDT = '400' AND SPRAS = 'E'""")

SQL["so_reject_codes"] = with_shapes(["TVAGT"], f"""
SELECT ABGRU AS rejection_code, BEZEI AS description, coalesce(m.label, 'none') AS status
FROM TVAGT LEFT JOIN {_values(_codes.REJECT_STATUS, 'rs')} m ON m.code = ABGRU
WHERE MANDT = '400' AND SPRAS = 'E'""")

SQL["so_document_type"] = with_shapes(["TVAK", "TVAKT"], f"""
SELECT d.AUART AS sales_doc_type, t.BEZEI AS description, coalesce(m.label, 'Unused') AS order_type
FROM TVAK d
LEFT JOIN (SELECT AUART, BEZEI FROM TVAKT WHERE MANDT = '400' AND SPRAS = 'E') t ON t.AUART = d.AUART
LEFT JOIN {_values(_codes.ORDER_TYPE, 'ot')} m ON m.code = d.AUART
WHERE d.MANDT = '400'""")

SQL["text_dim_left"] = with_shapes(["T052", "T052U"], """
SELECT p.ZTERM AS payment_terms, t.TEXT1 AS description, p.ZTAG1 AS baseline_date
FROM T052 p LEFT JOIN (SELECT ZTERM, ZTAGG, TEXT1 FROM T052U WHERE MANDT = '400' AND SPRAS = 'E') t
  ON t.ZTERM = p.ZTERM AND t.ZTAGG = p.ZTAGG
WHERE p.MANDT = '400'""")

SQL["code_text_dim"] = with_shapes(["TVFST"], """
SELECT FAKSP AS billing_block, VTEXT AS description FROM TVFST WHERE MANDT = '400' AND SPRAS = 'E'""")

SQL["delivery_blocks"] = with_shapes(["TVLST"], """
SELECT LIFSP AS delivery_block, VTEXT AS description FROM TVLST WHERE MANDT = '400' AND SPRAS = 'E'""")

SQL["purchasing_groups"] = with_shapes(["T024"], """
SELECT EKGRP AS purchasing_group, EKNAM AS buyer_name FROM T024 WHERE MANDT = '400'""")

SQL["plants_in_list"] = with_shapes(["T001L"], f"""
SELECT WERKS AS plant, {STRIP('LGORT')} AS storage_location, LGOBE AS description FROM T001L
WHERE MANDT = '400' AND WERKS IN ('4001', '4005', '4010')""")

SQL["strip_zeros_both"] = with_shapes(["MARA"], f"""
SELECT MATNR AS material_key, {STRIP('MATNR')} AS stripped, {STRIP_KEEP0('MATNR')} AS stripped_keep_zero
FROM MARA WHERE MANDT = '400'""")


# ----------------------------------------------------------------------------- completion on larger items
def _completion_items(item_exprs):
    items = ", ".join(f"{e} AS item_{i}" for i, e in enumerate(item_exprs))
    keys = ", ".join(f"item_{i}" for i in range(len(item_exprs)))
    on = " AND ".join(f"r.item_{i} = s.item_{i}" for i in range(len(item_exprs)))
    return f"""
WITH base AS (
  SELECT {items}, l_orderkey AS ord, l_linenumber AS line, l_partkey AS part, cast(l_shipdate AS date) AS due,
    cast(l_quantity AS decimal(13,3)) AS qty, l_returnflag AS flag FROM lineitem),
s AS (
  SELECT {keys}, ord, line, part,
    cast(row_number() OVER (PARTITION BY {keys} ORDER BY due, ord, line, part) AS integer) AS sched_rank,
    sum(qty) OVER (PARTITION BY {keys} ORDER BY due, ord, line, part
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_sched_qty
  FROM base),
r AS (
  SELECT {keys}, ord AS r_ord, line AS r_line, due + 7 AS received,
    cast(row_number() OVER (PARTITION BY {keys} ORDER BY due + 7, ord, line, part) AS integer) AS gr_rank,
    sum(qty) OVER (PARTITION BY {keys} ORDER BY due + 7, ord, line, part
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_gr_qty
  FROM base WHERE flag <> 'N'),
m AS (
  SELECT s.*, r.gr_rank, r.cum_gr_qty, r.received, r.r_ord, r.r_line,
    row_number() OVER (PARTITION BY {", ".join(f"s.item_{i}" for i in range(len(item_exprs)))}, s.sched_rank
                       ORDER BY r.gr_rank ASC NULLS LAST) AS rn
  FROM s LEFT JOIN r ON {on} AND r.cum_gr_qty >= s.cum_sched_qty)
SELECT {keys}, ord, line, part, sched_rank, cast(cum_sched_qty AS decimal(18,3)) AS cum_sched_qty, gr_rank,
  cast(cum_gr_qty AS decimal(18,3)) AS cum_gr_qty, received, r_ord, r_line
FROM m WHERE rn = 1"""


def _completion_asof(item: str) -> str:
    """The same match for items of very many lines: quantities are positive, so the first receipt that
    reaches a line's cumulative quantity is the one with the smallest cumulative quantity that does."""
    textbook = _completion_items([item])
    head = textbook[:textbook.index("m AS (")].rstrip().rstrip(",")
    return head + """
SELECT s.item_0, s.ord, s.line, s.part, sched_rank, cast(cum_sched_qty AS decimal(18,3)) AS cum_sched_qty, gr_rank,
  cast(cum_gr_qty AS decimal(18,3)) AS cum_gr_qty, received, r_ord, r_line
FROM s ASOF LEFT JOIN r ON s.item_0 = r.item_0 AND s.cum_sched_qty <= r.cum_gr_qty"""


SQL["completion_hot_items"] = _completion_asof("l_linestatus")
SQL["completion_dense_items"] = _completion_items(["l_suppkey", "l_partkey % 20"])
SQL["completion_supplier_items"] = _completion_items(["l_suppkey"])

SQL["bom_levels"] = f"""SELECT cast(bom_level AS integer) AS bom_level, count(*) AS rows,
  cast(sum(qty) AS decimal(18,3)) AS qty
FROM ({SQL["bom_explosion"]}) x GROUP BY bom_level"""

# ----------------------------------------------------------------------------- refresh, keys, quarantine, tables
SQL["published_refresh"] = SQL["vendor_preferred_contact"]
SQL["bom_listing"] = SQL["bom_depth_first"]
SQL["po_lines_bucketed"] = SQL["po_lines_status"]
SQL["stable_keys"] = with_shapes(["LFA1", "ADR6", "LFM1"], f""", {_VENDOR_MASTER},
k AS (SELECT DISTINCT vendor_account_number AS v, purchasing_organization AS o FROM vm),
n AS (SELECT v, o, row_number() OVER (ORDER BY o IS DISTINCT FROM '4001', v NULLS FIRST, o NULLS FIRST) AS no FROM k)
SELECT n.no AS surrogate_id, vm.* FROM vm JOIN n ON n.v IS NOT DISTINCT FROM vendor_account_number AND n.o IS NOT DISTINCT FROM purchasing_organization""")

_BAD_QTY = "substr(EBELN, 10, 1) = '7' AND EBELP = '00010'"
_BAD_RECEIVED = "substr(EBELN, 10, 1) = '3' AND EBELP = '00020'"
_EKET = f"EKET AS (\n{SHAPES['EKET']}\n)"
SQL["quarantined_po_lines"] = SQL["po_lines_status"].replace(_EKET, f"""EKET AS (
SELECT * REPLACE (CASE WHEN substr(EBELN, 10, 1) = '5' AND EBELP = '00030' THEN NULL ELSE MENGE END AS MENGE) FROM ({SHAPES['EKET']})
WHERE NOT ({_BAD_QTY}) AND NOT ({_BAD_RECEIVED}))""")
SQL["rejected_schedule_lines"] = f"""WITH {_EKET}
SELECT MANDT, EBELN, EBELP, ETENR, 'MENGE' AS "column", '12,5 EA' AS value, 'decimal(13,3)' AS wanted FROM EKET WHERE {_BAD_QTY}
UNION ALL SELECT MANDT, EBELN, EBELP, ETENR, 'WEMNG', '99999999999999', 'decimal(13,3)' FROM EKET WHERE {_BAD_RECEIVED}"""
SQL["table_refresh"] = f"""SELECT row_number() OVER (ORDER BY MPN_Number NULLS FIRST, Material_Number NULLS FIRST, Material_Description NULLS FIRST, Manufacturer_Name NULLS FIRST,
  Manufacturer_Number NULLS FIRST, Manufacturer_Material_Number NULLS FIRST, Plant NULLS FIRST, Valid_From NULLS FIRST, Valid_To NULLS FIRST) AS row_key, * FROM ({SQL["approved_parts"]})"""
