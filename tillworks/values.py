"""The form layout, the reference data and the accepted values the results depend on."""

from __future__ import annotations

from typing import NamedTuple


class Tab(NamedTuple):
    """One form tab: the raw table it fills and its (form header, column name) pairs in order."""

    table: str
    headers: tuple[tuple[str, str], ...]

    @property
    def columns(self) -> list[str]:
        return [column for _, column in self.headers]


# --- fixed values: form tabs, their exact headers and the raw columns they become ---------------------------------
TABS: dict[str, Tab] = {
    "Sales": Tab("sales_raw", (
        ("Timestamp", "Timestamp"),
        ("Date", "Date"),
        ("Salesperson Name", "Salesperson_Name"),
        ("Product", "Product"),
        ("Units Sold", "Units_Sold"),
        ("Unit Price (KES)", "Unit_Price_KES"),
        ("Discount Amount (KES)", "Discount_Amount_KES"),
        ("Payment Method", "Payment_Method"),
        ("Customer Phone Number", "Customer_Phone_Number"),
        ("Customer Type", "Customer_Type"),
        ("Business Unit", "Business_Unit"),
        ("Notes", "Notes"),
    )),
    "Expenses": Tab("expenses_raw", (
        ("Timestamp", "Timestamp"),
        ("Date of Expense", "Date_of_Expense"),
        ("Expense Category", "Expense_Category"),
        ("Amount (KES)", "Amount_KES"),
        ("Description", "Description"),
        ("Paid Via", "Paid_Via"),
        ("Recorded By", "Recorded_By"),
        ("Business Unit", "Business_Unit"),
    )),
    "Inventory": Tab("inventory_purchases_raw", (
        ("Timestamp", "Timestamp"),
        ("Date of Purchase", "Date_of_Purchase"),
        ("Product Purchased", "Product_Purchased"),
        ("Units Purchased", "Units_Purchased"),
        ("Unit Cost (KES)", "Unit_Cost_KES"),
        ("Supplier Name", "Supplier_Name"),
        ("Payment Method", "Payment_Method"),
        ("Notes/Comments (Optional)", "Notes_Comments"),
        ("Business Unit", "Business_Unit"),
    )),
    "Returns": Tab("returns_raw", (
        ("Timestamp", "Timestamp"),
        ("Date of Return", "Date_of_Return"),
        ("Salesperson Name", "Salesperson_Name"),
        ("Product Returned (Select Item)", "Product_Returned"),
        ("Units Returned (Must be greater than 0)", "Units_Returned"),
        ("Original Unit Price (KES) - What was the item sold for?", "Original_Unit_Price_KES"),
        ("Reason for Return", "Reason_for_Return"),
        ("Requested Refund Method", "Requested_Refund_Method"),
        ("Customer Phone Number (Optional)", "Customer_Phone_Number"),
        ("Notes and Further Explanation (Optional)", "Notes"),
        ("Business Unit", "Business_Unit"),
    )),
    "Products": Tab("products_raw", (
        ("Timestamp", "Timestamp"),
        ("Product Name (Must be exact for identification purposes)", "Product_Name"),
        ("Category", "Category"),
        ("Unit of Measure (UoM)", "Unit_of_Measure"),
        ("Current Selling Price (KES)", "Current_Selling_Price"),
        ("Reorder Level (units) - Default is 5", "Reorder_Level"),
        ("Is this product currently active?", "Is_Active"),
        ("Cost Price (KES)", "Cost_Price_KES"),
    )),
}

# --- fixed values: audit columns and the cell texts that mean "no value" -----------------------------------------
LOADED_AT, SOURCE = "_loaded_at", "_source"
SOURCE_LABEL = "google_sheets_python_etl"
NULL_SENTINELS = ("", "None", "nan")

# --- fixed values: layer databases -------------------------------------------------------------------------------
RAW_DB, STAGING_DB, MARTS_DB = "retail_raw", "retail_staging", "retail_marts"

# --- fixed values: reference data --------------------------------------------------------------------------------
BUSINESS_UNITS = (
    "Cosmic Choices FB & IG",
    "Cosmic Choices website",
    "Jesilog FB & IG",
    "Jesilog Website",
    "Tabasamu FB & IG",
    "Tabasamu website",
    "Onpoint",
    "Nayomie",
    "Prince",
    "Hope",
    "Hope & Home",
    "Tsavo",
)
PRODUCT_CATEGORIES = (
    ("Flooring", "Carpets grass tiles SPC interlocking and other floor coverings"),
    ("Window Treatments", "Blinds rods rails curtains films and privacy screens"),
    ("Wall & Ceiling Decor", "Wallpapers panels partitions and decorative sheets"),
    ("Bathroom & Balcony", "Shower curtains and balcony privacy shields"),
    ("Home Accessories", "Storage covers bags and decorative vases"),
    ("Hardware & Fixings", "Locks glue and fitting accessories"),
    ("Other", "Miscellaneous items not in other categories"),
)

# --- fixed values: accepted values -------------------------------------------------------------------------------
CATEGORY_NAMES = tuple(name for name, _ in PRODUCT_CATEGORIES)
UNITS_OF_MEASURE = ("Piece", "Metre", "Sq Metre", "Roll", "Set")
PAYMENT_METHODS = ("M-Pesa", "Bank")
EXPENSE_CATEGORIES = ("Water", "Stationery", "Supplier Transport", "Customer Delivery", "Other")
RETURN_REASONS = ("Defective", "Wrong Item", "Customer Changed Mind", "Other")
REFUND_METHODS = ("M-Pesa", "Bank", "Store Credit", "No Refund")

# --- fixed values: business thresholds and defaults --------------------------------------------------------------
DEFAULT_REORDER_LEVEL = 5
VIP_FROM, REGULAR_FROM = 10000, 3000
PHONE_PATTERN = r"^(07|01)[0-9]{8}$"
TRUE_WORDS = ("yes", "true", "1")
