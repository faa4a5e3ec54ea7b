"""Comments of the mart columns, by column name."""

from __future__ import annotations

from collections.abc import Sequence

from martforge.sources.schemas import Col

KEY = Col("row_key", "bigint", "Number of the row: in column order of the last refresh, or kept for good where a key registry is used")

COMMENTS = {
    "MPN_Number": "Internal number of the manufacturer part", "Manufacturer_Material_Number": "The maker's own number for the part",
    "Manufacturer_Name": "Name of the maker", "Manufacturer_Number": "Vendor account of the maker",
    "Material_Description": "Short text of the approved material", "Material_Number": "Material that the approval is for",
    "Plant": "Plant in which the approval holds", "Valid_From": "First day of the approval", "Valid_To": "Last day of the approval",
    "abc_indicator": "Class A, B or C by share in consumption", "account_assignment_category": "Kind of object that bears the cost",
    "account_group": "Group that the account belongs to", "alt_bom": "Alternative within the bill of materials",
    "amount_local_currency": "Amount posted, in local currency", "base_unit_of_measure": "Unit in which stock is kept",
    "baseline_date": "Day from which the payment period runs", "billing_block": "Code that stops billing",
    "billing_type": "Kind of billing that the item takes part in", "blocked_qty": "Stock that is blocked",
    "bom_category": "Kind of bill of materials, M for materials", "bom_level": "Steps below the top material, from 1",
    "bom_number": "Internal number of the bill of materials", "bom_usage": "Purpose of the bill, such as production",
    "breakdown": "Category that the movement type belongs to", "buyer_name": "Name of the buyer or buying group",
    "central_deletion_flag": "X if the record is to be deleted everywhere", "city": "Town of the address",
    "committed_quantity": "Quantity confirmed so far", "component_description": "Short text of the component",
    "component_material": "Material used in the parent", "controlling_area": "Area for cost accounting", "cost_center": "Number of the cost center",
    "country": "Country code of the address", "created_by": "User who created the record", "creation_date": "Day on which the record was created",
    "currency": "Currency of the amounts in the row", "customer_name": "Name of the customer", "customer_number": "Account of the customer",
    "days_early_late": "Days from receipt to due date; negative if late", "days_since_last_movement": "Days from the last goods movement to the reference date",
    "debit_credit_indicator": "S for a debit, H for a credit", "deletion_indicator": "Mark of a deleted line",
    "delivered_on_time": "Whether the completing receipt came by the due date; empty while open", "delivery_block": "Code that stops deliveries",
    "delivery_completed_indicator": "X once no further delivery is expected", "department": "Department in charge", "description": "Text of the code or object",
    "difference_qty": "Required less withdrawn quantity", "division": "Product division", "document_date": "Date on the document",
    "email": "Preferred e-mail address", "fax": "Fax number", "final_issue_indicator": "X once the reservation is fully issued",
    "gr_based_iv_indicator": "X if invoices are checked against receipts", "gr_date": "Posting day of the receipt that completes the line",
    "gr_document_number": "Document of the receipt that completes the line", "gr_indicator": "X if a goods receipt is expected",
    "gr_processing_time_days": "Workdays from arrival to availability", "gr_quantity": "Quantity received", "gross_weight": "Weight with packaging",
    "incoterms": "Code of the delivery terms", "incoterms_description": "Place or text of the delivery terms", "industry": "Branch of industry",
    "invoice_receipt_indicator": "X if an invoice is expected", "item_category": "Kind of item", "item_delivery_date": "Day on which the item is wanted",
    "item_number": "Number of the item within its bill", "last_document_number": "Document of the latest goods movement",
    "last_movement_date": "Posting day of the latest goods movement", "last_movement_type": "Movement type of the latest goods movement",
    "level_1_top": "Top node of the organisation tree", "level_1_top_desc": "Text of the top node", "level_2_site": "Site node above the profit center",
    "level_2_site_desc": "Text of the site node", "level_3_dept": "Department node above the profit center; empty for centers directly below a site",
    "level_3_dept_desc": "Text of the department node", "local_currency": "Currency of the company code", "lock_indicator": "X if the profit center is locked",
    "lot_sizing_procedure": "Rule by which lots are sized", "manufacturer_part_number": "Part number that the maker uses",
    "material_class": "Class derived from material type and procurement", "material_description": "Short text of the material",
    "material_document_item": "Line of the material document", "material_document_number": "Number of the material document",
    "material_document_year": "Year of the material document", "material_group": "Group that the material belongs to",
    "material_number": "Material, without leading zeros", "material_type": "Type of the material, such as finished or raw",
    "maximum_stock_level": "Stock that must not be exceeded", "minimum_order_value": "Least value of an order", "movement_type": "Code of the goods movement",
    "movement_type_text": "Text of the goods movement", "moving_average_price": "Average price of the stock", "mrp_controller": "Planner in charge",
    "mrp_type": "Planning procedure", "net_price": "Price after discounts, per price unit", "net_price_po": "Net price in the linked order",
    "net_weight": "Weight without packaging", "old_material_number": "Number in a former system", "open_quantity": "Quantity still to come",
    "order_currency": "Currency of the order", "order_number": "Order that the movement belongs to", "order_type": "Kind of order derived from the document type",
    "ordered_quantity": "Quantity that has been ordered", "otd_status": "On Time, Late, Open or Overdue", "parent_description": "Short text of the parent",
    "parent_material": "Material that the component goes into", "payment_terms": "Code of the payment terms",
    "planned_delivery_time_days": "Calendar days that a delivery should take", "plant": "Plant code", "plant_material_status": "Status of the material in the plant",
    "po_currency": "Currency of the purchase order", "po_quantity": "Quantity on the order line", "po_status": "Delivery status of the order line",
    "po_unit_of_measure": "Unit of the order quantity", "postal_code": "Postal code of the address", "posting_block": "X if postings are blocked",
    "posting_date": "Day on which the movement was posted", "pr_closed": "X if the requisition is closed", "pr_price": "Price estimated in the requisition",
    "pr_quantity": "Quantity requested", "price_control": "S for standard price, V for moving average", "price_unit": "Number of units that the price is for",
    "processing_status": "Stage of processing", "procurement_type": "In-house, external or both", "profit_center": "Number of the profit center",
    "purchase_order_item": "Line of the purchase order", "purchase_order_number": "Number of the purchase order",
    "purchase_requisition_item": "Line of the requisition", "purchase_requisition_number": "Number of the requisition",
    "purchasing_block": "X if buying is blocked", "purchasing_document_date": "Date of the purchasing document",
    "purchasing_document_item": "Line of the purchasing document", "purchasing_document_number": "Number of the purchasing document",
    "purchasing_document_type": "Type of the purchasing document", "purchasing_group": "Buyer or buying group", "purchasing_organization": "Unit that buys",
    "qty": "Quantity of the component per base quantity of its parent", "quality_inspection_qty": "Stock under inspection",
    "quantity": "Quantity moved", "quantity_to_be_delivered": "Quantity due that has not arrived", "receiving_plant": "Plant that gets the goods",
    "region": "State or region code", "rejection_code": "Reason for rejecting a sales item", "release_date": "Day of release",
    "release_indicator": "What the release allows", "release_status": "Releases given so far", "reorder_point": "Stock at which to reorder",
    "requirement_date": "Day on which the material is needed", "requirement_qty": "Quantity reserved", "requisition_date": "Day of the requisition",
    "reservation_item": "Line of the reservation", "reservation_number": "Number of the reservation", "reservation_type": "Kind of record of the reservation",
    "responsible_person": "Person in charge", "restricted_use_qty": "Stock of restricted batches", "returns_qty": "Stock of customer returns",
    "safety_stock_qty": "Stock kept for safety", "sales_doc_type": "Type of the sales document", "sap_description": "Text kept in the ERP system",
    "schedule_line_counter": "Number of the schedule line", "scheduled_delivery_date": "Day on which the line is due",
    "scheduled_quantity": "Quantity of the schedule line", "short_name": "Site label of the account, TBD if none is set",
    "sort_path": "Top, then item numbers down the path; sorts depth-first",
    "special_procurement_type": "Special way of procurement", "special_stock_indicator": "Kind of special stock",
    "standard_price": "Standard price per price unit", "statistics_delivery_date": "Due date used for statistics", "status": "Status derived from the code",
    "sto_status": "Delivery status of the transfer line", "storage_location": "Storage location within the plant", "street_address": "Street and number",
    "supplying_plant": "Plant that sends the goods", "tax_number_1": "First tax number", "tax_number_2": "Second tax number", "telephone": "Telephone number",
    "top_material": "Material at the top of the explosion", "top_plant": "Plant of the top material", "total_qty": "Sum of the stock categories",
    "total_value": "Total quantity at unit price", "transfer_qty": "Stock in transfer", "unit_of_measure": "Unit of the quantities",
    "unit_price": "Price for one unit", "unrestricted_qty": "Stock free to use", "uom": "Unit of the component quantity",
    "valid_from": "Day from which the item holds", "valuation_class": "Class that assigns accounts", "vendor_account_number": "Account of the vendor",
    "vendor_name": "Name of the vendor", "vendor_name_2": "Second line of the vendor's name", "vendor_number": "Account of the vendor",
    "volume": "Volume per base unit", "volume_unit": "Unit of the volume", "weight_unit": "Unit of the weights", "withdrawn_qty": "Quantity withdrawn so far",
}


def documented(schema: Sequence[Col]) -> list[Col]:
    """``schema`` with the comments of its columns; a column without one is an error."""
    return [Col(c.name, c.type, c.comment or COMMENTS[c.name]) for c in schema]
