"""Small hand-made raw tables."""

from __future__ import annotations

from tillworks.plans import staging
from tillworks.values import TABS

BY_TABLE = {tab.table: tab for tab in TABS.values()}


def raw(spark, table, *rows):
    """A raw table from dicts; columns that are left out are NULL."""
    columns = BY_TABLE[table].columns
    data = [tuple(row.get(c) for c in columns) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))


def staged(spark, table, *rows):
    builder, raw_table = staging.BUILDERS[table]
    return builder(raw(spark, raw_table, *rows))


def product(name="Locks - Moment", **more):
    return {"Timestamp": "1/1/2025 8:00:00", "Product_Name": name, "Category": "Other", "Unit_of_Measure": "Piece",
            "Current_Selling_Price": "300", "Reorder_Level": "10", "Is_Active": "Yes", "Cost_Price_KES": "200"} | more


def sale(day="5/4/2025", **more):
    return {"Timestamp": "5/4/2025 9:00:00", "Date": day, "Salesperson_Name": "Ann", "Product": "Locks - Moment",
            "Units_Sold": "2", "Unit_Price_KES": "KES 300", "Discount_Amount_KES": "50", "Payment_Method": "M-Pesa",
            "Customer_Phone_Number": "0712345678", "Business_Unit": "Hope"} | more


def returned(day="5/4/2025", **more):
    return {"Timestamp": "5/4/2025 9:00:00", "Date_of_Return": day, "Salesperson_Name": "Ann",
            "Product_Returned": "Locks - Moment", "Units_Returned": "1", "Original_Unit_Price_KES": "300",
            "Reason_for_Return": "Defective", "Requested_Refund_Method": "Bank", "Business_Unit": "Hope"} | more


def expense(day="5/4/2025", **more):
    return {"Timestamp": "5/4/2025 9:00:00", "Date_of_Expense": day, "Expense_Category": "Water", "Amount_KES": "100",
            "Paid_Via": "Bank", "Recorded_By": "ann", "Business_Unit": "Hope"} | more


def purchase(day="5/1/2025", **more):
    return {"Timestamp": "5/1/2025 9:00:00", "Date_of_Purchase": day, "Product_Purchased": "Locks - Moment",
            "Units_Purchased": "20", "Unit_Cost_KES": "200", "Supplier_Name": "S", "Payment_Method": "Bank",
            "Business_Unit": "Hope"} | more


def given_tables(spark, folder, parts=(), lines=()):
    """The given star-schema tables with one customer, supplier and nation, and an order for each line's order number."""
    orders = [(o, 1, "2000-01-05", "2-HIGH", 12.0, "F") for o in sorted({line[0] for line in lines})]
    tables = {
        "nation": ("n_nationkey int, n_name string", [(1, "KENYA")]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(1, "Ann", 1)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int", [(1, "Bob", 1)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double", list(parts)),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate string, o_orderpriority string, o_totalprice double, "
                   "o_orderstatus string", orders),
        "lineitem": ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate string, l_returnflag string, "
                     "l_linestatus string, l_quantity double, l_discount double", list(lines)),
    }
    for name, (schema, rows) in tables.items():
        df = spark.createDataFrame(rows, schema)
        df.withColumns({c: df[c].cast("date") for c in df.columns if c.endswith("date")}).write.parquet(f"{folder}/{name}.parquet")
