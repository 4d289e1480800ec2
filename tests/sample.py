"""The reference's two sample batches (customers JSON, products CSV), as
fixture files. Tiny by design; written by the test, not by a query."""

import json
import os

CUSTOMERS = {
    "customers_2026-01.json": [
        ("101", "John", "San Francisco", "2026-01-01"),
        ("102", "Mary", "San Jose", "2026-01-01"),
        ("103", "Charles", "Palo Alto", "2026-01-01"),
    ],
    "customers_2026-06.json": [
        ("101", "John", "Mountain View", "2026-06-01"),
        ("102", "Mary", "Cupertino", "2026-06-01"),
        ("103", "Charles", "Palo Alto", "2026-06-01"),
        ("104", "Anna", "Sunnyvale", "2026-06-01"),
    ],
}
PRODUCTS = {
    "products_2026-01.csv": [
        ("P001", "iPhone 15", "Electronics", "999.00", "2026-01-01"),
        ("P002", "MacBook Pro", "Electronics", "2499.00", "2026-01-01"),
        ("P003", "T-Shirt", "Clothing", "29.90", "2026-01-01"),
        ("P004", "Coffee Beans", "Groceries", "15.90", "2026-01-01"),
    ],
    "products_2026-06.csv": [
        ("P001", "iPhone 15", "Electronics", "899.00", "2026-01-01"),
        ("P002", "MacBook Pro", "Electronics", "2499.00", "2026-01-01"),
        ("P003", "T-Shirt", "Clothing", "34.90", "2026-01-01"),
        ("P004", "Coffee Beans", "Groceries", "15.90", "2026-01-01"),
        ("P005", "Wireless Headphones", "Electronics", "199.00", "2026-06-01"),
    ],
}
CUSTOMER_COLS = ("customer_id", "name", "city", "event_date")
PRODUCT_COLS = ("product_id", "product_name", "category", "price", "launch_date")


def write_customers(d, files=CUSTOMERS, extra=None):
    os.makedirs(d, exist_ok=True)
    for name, rows in files.items():
        with open(os.path.join(d, name), "w") as f:
            for r in rows:
                obj = dict(zip(CUSTOMER_COLS, r))
                if extra and name in extra:
                    obj.update(extra[name])
                f.write(json.dumps(obj) + "\n")


def write_products(d, files=PRODUCTS, header=PRODUCT_COLS):
    os.makedirs(d, exist_ok=True)
    for name, rows in files.items():
        order = [PRODUCT_COLS.index(h) for h in header]
        with open(os.path.join(d, name), "w") as f:
            f.write(",".join(header) + "\n")
            for r in rows:
                f.write(",".join(r[i] for i in order) + "\n")
