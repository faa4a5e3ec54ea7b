"""Code tables and code decoding.

The tables below are FIXED VALUES: they must equal the business definitions the reports
were specified with, so they are written out plainly, in their original order.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES: movement type (BWART) -> plain-language text.
# Movement types absent from this table are left out of the movement-type dimension.
# ---------------------------------------------------------------------------
MOVEMENT_TYPE_TEXT = {
    '101': 'Goods receipt (PO)',
    '102': 'Goods receipt (PO) Reversal',
    '107': 'Goods Receipt to valuated blocked stock',
    '108': 'Goods Receipt to valuated blocked stock Reversal',
    '109': 'Goods Receipt from valuated blocked stock',
    '110': 'Goods Receipt from valuated blocked stock Reversal',
    '122': 'Return to Material to PO',
    '123': 'Return to Material to PO Reversal',
    '161': 'Return to supplier (PO)',
    '162': 'Return to supplier (PO) Reversal',
    '201': 'Goods issue (cost center)',
    '202': 'Goods issue (cost center) Reversal',
    '221': 'Goods issue (Project)',
    '222': 'Goods issue (Project) Reversal',
    '241': 'Goods issue (Asset)',
    '242': 'Goods issue (Asset) Reversal',
    '261': 'Goods issue (Production Order)',
    '262': 'Goods issue (Production Order) Reversal',
    '281': 'Goods issue (Network)',
    '282': 'Goods issue (Network) Reversal',
    '301': 'Transfer (Plant to Plant) - 1 Step',
    '302': 'Transfer (Plant to Plant) - 1 Step Reversal',
    '303': 'Transfer (Plant to Plant) - 2 Step',
    '304': 'Transfer (Plant to Plant) - 2 Step Reversal',
    '309': 'Transfer (material to material)',
    '310': 'Transfer (material to material) Reversal',
    '311': 'Transfer (Storage Location to Storage Location in 1 Step)',
    '312': 'Transfer (Storage Location to Storage Location in 1 Step) Reversal',
    '313': 'Transfer (Storage location to Storage Location in 2 Steps)',
    '314': 'Transfer (Storage location to Storage Location in 2 Steps) Reversal',
    '321': 'Transfer (Inspection Stock to Unrestricted Stock)',
    '322': 'Transfer (Inspection Stock to Unrestricted Stock) Reversal',
    '323': 'Transfer (Inspection Stock to Inspection Stock)',
    '324': 'Transfer (Inspection Stock to Inspection Stock) Reversal',
    '325': 'Transfer (Storage Location to Storage Location; Blocked Stock)',
    '326': 'Transfer (Storage Location to Storage Location; Blocked Stock) Reversal',
    '341': 'Status Change of a Batch (Unrestricted to restricted)',
    '342': 'Status Change of a Batch (Unrestricted to restricted) Reversal',
    '343': 'Transfer (Blocked Stock to Unrestricted Stock)',
    '344': 'Transfer (Blocked Stock to Unrestricted Stock) Reversal',
    '349': 'Transfer (Blocked Stock to Inspection Stock)',
    '350': 'Transfer (Blocked Stock to Inspection Stock) Reversal',
    '411': 'Transfer (Special Stock (E/K/Q) to Unrestricted Stock)',
    '412': 'Transfer (Special Stock (E/K/Q) to Unrestricted Stock) Reversal',
    '501': 'Goods Receipt (No PO to Unrestricted Stock)',
    '502': 'Goods Receipt (No PO to Unrestricted Stock) Reversal',
    '511': 'Goods Receipt (Free-of-Charge from Vendor)',
    '512': 'Goods Receipt (Free-of-Charge from Vendor) Reversal',
    '531': 'Goods Receipt (By-product from an order - Such as negative qty on WO)',
    '532': 'Goods Receipt (By-product from an order - Such as negative qty on WO) Reversal',
    '541': 'Transfer (Unrestricted Stock to Vendor Stock)',
    '542': 'Transfer (Unrestricted Stock to Vendor Stock) Reversal',
    '543': 'Goods Issue (Consumption of Vendor Subcontract Stock)',
    '544': 'Goods Issue (Consumption of Vendor Subcontract Stock) Reversal',
    '551': 'Scrap (from Unrestricted Stock)',
    '552': 'Scrap (from Unrestricted Stock) Reversal',
    '561': 'Initial Entry of Stock (to Unrestricted Stock)',
    '562': 'Initial Entry of Stock (to Unrestricted Stock) Reversal',
    '581': 'Goods Receipt (Network to Unrestricted Stock)',
    '582': 'Goods Receipt (Network to Unrestricted Stock) Reversal',
    '601': 'Goods Issue (Customer Order)',
    '602': 'Goods Issue (Customer Order) Reversal',
    '621': 'Transfer (Unrestricted Stock to Customer Stock)',
    '622': 'Transfer (Unrestricted Stock to Customer Stock) Reversal',
    '623': 'Goods Issue (from Customer Stock)',
    '624': 'Goods Issue (from Customer Stock) Reversal',
    '631': 'Transfer (Unrestricted Stock to Customer Consignment Stock)',
    '632': 'Transfer (Unrestricted Stock to Customer Consignment Stock) Reversal',
    '641': 'Goods Issue (Interco Stock Transfer)',
    '642': 'Goods Issue (Interco Stock Transfer) Reversal',
    '653': 'Returns (From Customer to Unrestricted Stock)',
    '654': 'Returns (From Customer to Unrestricted Stock) Reversal',
    '701': 'Inventory Adjustments (unrestricted stock)',
    '702': 'Inventory Adjustments (unrestricted stock) Reversal',
    '703': 'Inventory Adjustments (inspection stock)',
    '704': 'Inventory Adjustments (inspection stock) Reversal',
    '707': 'Inventory Adjustments (blocked stock)',
    '708': 'Inventory Adjustments (blocked stock) Reversal',
    '901': 'Goods Issue (Direct to Cost Center)',
    '902': 'Goods Issue (Direct to Cost Center) Reversal',
    '971': 'Transfer (Quality to Unrestricted Stock)',
}

# ---------------------------------------------------------------------------
# FIXED VALUES: movement type -> reporting category (same key set as above).
# ---------------------------------------------------------------------------
MOVEMENT_CATEGORY = {
    '101': 'Goods Receipt', '102': 'Goods Receipt', '107': 'Goods Receipt',
    '108': 'Goods Receipt', '109': 'Goods Receipt', '110': 'Goods Receipt',
    '161': 'Goods Receipt', '162': 'Goods Receipt', '501': 'Goods Receipt',
    '502': 'Goods Receipt', '511': 'Goods Receipt', '512': 'Goods Receipt',
    '531': 'Goods Receipt', '532': 'Goods Receipt', '581': 'Goods Receipt',
    '582': 'Goods Receipt',
    '201': 'Goods Issue', '202': 'Goods Issue', '221': 'Goods Issue',
    '222': 'Goods Issue', '241': 'Goods Issue', '242': 'Goods Issue',
    '261': 'Goods Issue', '262': 'Goods Issue', '281': 'Goods Issue',
    '282': 'Goods Issue', '543': 'Goods Issue', '544': 'Goods Issue',
    '601': 'Goods Issue', '602': 'Goods Issue', '621': 'Goods Issue',
    '622': 'Goods Issue', '623': 'Goods Issue', '624': 'Goods Issue',
    '631': 'Goods Issue', '632': 'Goods Issue', '641': 'Goods Issue',
    '642': 'Goods Issue', '653': 'Goods Issue', '654': 'Goods Issue',
    '901': 'Goods Issue', '902': 'Goods Issue',
    '122': 'Transfer', '123': 'Transfer', '301': 'Transfer', '302': 'Transfer',
    '303': 'Transfer', '304': 'Transfer', '309': 'Transfer', '310': 'Transfer',
    '311': 'Transfer', '312': 'Transfer', '313': 'Transfer', '314': 'Transfer',
    '321': 'Transfer', '322': 'Transfer', '323': 'Transfer', '324': 'Transfer',
    '325': 'Transfer', '326': 'Transfer', '341': 'Transfer', '342': 'Transfer',
    '343': 'Transfer', '344': 'Transfer', '349': 'Transfer', '350': 'Transfer',
    '411': 'Transfer', '412': 'Transfer', '541': 'Transfer', '542': 'Transfer',
    '971': 'Transfer',
    '551': 'Scrap', '552': 'Scrap',
    '561': 'Adjustment', '562': 'Adjustment', '701': 'Adjustment',
    '702': 'Adjustment', '703': 'Adjustment', '704': 'Adjustment',
    '707': 'Adjustment', '708': 'Adjustment',
}

# ---------------------------------------------------------------------------
# FIXED VALUES: sales document type (AUART) -> order type; others are 'Unused'.
# ---------------------------------------------------------------------------
ORDER_TYPE = {
    'ZAP': 'Standard',
    'ZOR': 'Standard',
    'ZPOR': 'Standard',
    'ZRC1': 'Standard',
    'ZRS1': 'Standard',
    'ZIN': 'Inquiry',
    'ZLI': 'Consignment',
    'ZLP': 'Consignment',
    'ZLPU': 'Consignment',
    'ZLN': 'Customer Loan',
    'ZPQT': 'Quotation',
    'ZQT': 'Quotation',
    'ZPRE': 'Return',
    'ZRE': 'Return',
    'ZRC': 'Warranty/Repair',
    'ZRC3': 'Warranty/Repair',
    'ZRS': 'Warranty/Repair',
    'ZRS2': 'Warranty/Repair',
    'ZRS3': 'Warranty/Repair',
}
ORDER_TYPE_DEFAULT = 'Unused'

# ---------------------------------------------------------------------------
# FIXED VALUES: sales item category (PSTYV) -> billing type; others are 'TBD'.
# ---------------------------------------------------------------------------
BILLING_TYPE = {
    'AFTX': 'Standard', 'AGTX': 'Standard', 'G2N': 'Standard', 'G2TX': 'Standard',
    'L2N': 'Standard', 'TANN': 'Standard', 'TATX': 'Standard', 'ZAFN': 'Standard',
    'ZAGN': 'Standard', 'ZAGX': 'Standard', 'ZATX': 'Standard', 'ZBF2': 'Standard',
    'ZBIF': 'Standard', 'ZBIN': 'Standard', 'ZBM1': 'Standard', 'ZBOM': 'Standard',
    'ZBQT': 'Standard', 'ZCFC': 'Standard', 'ZCON': 'Standard', 'ZCOS': 'Standard',
    'ZCOT': 'Standard', 'ZCRS': 'Standard', 'ZCST': 'Standard', 'ZCXS': 'Standard',
    'ZDSR': 'Standard', 'ZFBD': 'Standard', 'ZFBF': 'Standard', 'ZFCP': 'Standard',
    'ZFFR': 'Standard', 'ZFOR': 'Standard', 'ZFQT': 'Standard', 'ZG2N': 'Standard',
    'ZGNN': 'Standard', 'ZKA1': 'Standard', 'ZKAN': 'Standard', 'ZKB1': 'Standard',
    'ZKBN': 'Standard', 'ZKBP': 'Standard', 'ZKEN': 'Standard', 'ZKOM': 'Standard',
    'ZKRN': 'Standard', 'ZL2N': 'Standard', 'ZL2W': 'Standard', 'ZLAN': 'Standard',
    'ZLNN': 'Standard', 'ZOBF': 'Standard', 'ZOFR': 'Standard', 'ZOSR': 'Standard',
    'ZPI': 'Standard', 'ZQAB': 'Standard', 'ZQBM': 'Standard', 'ZQM1': 'Standard',
    'ZQSF': 'Standard', 'ZQSR': 'Standard', 'ZRAF': 'Standard', 'ZRAL': 'Standard',
    'ZRAT': 'Standard', 'ZRCE': 'Standard', 'ZRCR': 'Standard', 'ZRE1': 'Standard',
    'ZRE2': 'Standard', 'ZREN': 'Standard', 'ZRGN': 'Standard', 'ZRIN': 'Standard',
    'ZRLA': 'Standard', 'ZRLB': 'Standard', 'ZRRB': 'Standard', 'ZRRE': 'Standard',
    'ZRRP': 'Standard', 'ZRRS': 'Standard', 'ZRVE': 'Standard', 'ZRWS': 'Standard',
    'ZSCQ': 'Standard', 'ZSNC': 'Standard', 'ZTAC': 'Standard', 'ZTAD': 'Standard',
    'ZTAJ': 'Standard', 'ZTAN': 'Standard', 'ZTAS': 'Standard', 'ZTAX': 'Standard',
    'ZTFS': 'Standard', 'ZWAR': 'Standard', 'ZWRP': 'Standard', 'ZWRR': 'Standard',
    'ZWVC': 'Standard', 'ZWVM': 'Standard', 'ZWVN': 'Standard', 'ZWVQ': 'Standard',
    'DLP': 'Billing Plan', 'ZBFB': 'Billing Plan', 'ZBFC': 'Billing Plan',
    'ZBFD': 'Billing Plan', 'ZBFF': 'Billing Plan', 'ZBM3': 'Billing Plan',
    'ZBOI': 'Billing Plan', 'ZSER': 'Billing Plan', 'ZSFR': 'Billing Plan',
    'ZTSB': 'Billing Plan',
    'ZADD': 'Milestone', 'ZPFC': 'Milestone', 'ZPRR': 'Milestone',
}
BILLING_TYPE_DEFAULT = 'TBD'

# ---------------------------------------------------------------------------
# FIXED VALUES: rejection reason (ABGRU) -> status; others are 'none'.
# ---------------------------------------------------------------------------
REJECT_STATUS = {
    '08': 'Canceled', '20': 'Canceled', '21': 'Canceled', '22': 'Canceled',
    '23': 'Canceled', '24': 'Canceled', '25': 'Canceled', '26': 'Canceled',
    '27': 'Canceled', '28': 'Canceled', '29': 'Canceled', '30': 'Canceled',
    'Z5': 'Closed',
}
REJECT_STATUS_DEFAULT = 'none'

# ---------------------------------------------------------------------------
# FIXED VALUES: material class by (material type, procurement type).
# First matching rule wins; procurement None means "in-house or unset" (E, X, blank, NULL);
# '*' means any procurement type.
# ---------------------------------------------------------------------------
MATERIAL_CLASS_EXCLUDED_TYPES = ('ZONT', 'ZHER', 'HERS')
MATERIAL_CLASS_RULES = (
    (('ZERT',), 'F', 'Tradable/Resale'),
    (('ZALB',), 'F', 'Raw'),
    (('ZALB',), None, 'Semi-FG'),
    (('ZERT',), None, 'FG'),
    (('ZERP', 'ZHMI', 'ZIBE'), '*', 'Operating/Packing Supplies'),
    (('ZIEN',), '*', 'Service'),
    (('ZLAG', 'ZROC'), '*', 'Non-Stock Material'),
    (('ZROH',), '*', 'Raw'),
    (('ZAWB', 'ZAWA'), '*', 'Tradable/Resale'),
)
MATERIAL_CLASS_DEFAULT = 'Unknown'
IN_HOUSE_PROCUREMENT = ('E', 'X')


def code_map(mapping: dict) -> Column:
    """Literal map column; its size is fixed by the code table, so it ships inside the plan."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def decode_codes(col, mapping: dict, default: str | None = None) -> Column:
    """Look a code up in ``mapping``; unknown or NULL codes give ``default`` (NULL if None)."""
    c = F.col(col) if isinstance(col, str) else col
    looked_up = code_map(mapping)[c]
    return looked_up if default is None else F.coalesce(looked_up, F.lit(default))


def classify(type_col, proc_col, rules=MATERIAL_CLASS_RULES, default=MATERIAL_CLASS_DEFAULT) -> Column:
    """CASE ladder over (type, procurement) rules; see MATERIAL_CLASS_RULES."""
    t = F.col(type_col) if isinstance(type_col, str) else type_col
    p = F.col(proc_col) if isinstance(proc_col, str) else proc_col
    expr = None
    for types, proc, label in rules:
        cond = t.isin(*types)
        if proc is None:
            cond = cond & (p.isin(*IN_HOUSE_PROCUREMENT) | p.isNull() | (p == ""))
        elif proc != "*":
            cond = cond & (p == proc)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)
