"""Split a flat file into normalized tables.

Customers, Products and Orders are DISTINCT projections of the flat file,
OrderDetails a plain projection. Each takes one shuffle at most:

* the order columns of the flat file are laid out by OrderID once (``order_lines``, six narrow
  columns). Share the result, and both its tables come off it without a further shuffle: rows that
  are equal share their OrderID, so DISTINCT finds them in place. Orders and OrderDetails are then
  both hash-partitioned by OrderID, and their join needs no exchange;
* a table takes only its columns of the flat file; where that is itself a join, one that ends with the
  table most columns come from carries little more than keys (``sources.fixtures.FLAT_JOINS``);
* Customers and Products are de-duplicated before and after a shuffle on their columns. Nothing joins
  them on a layout of their own, so they get none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# The columns of the four tables, in the reference's order.
CUSTOMER_COLUMNS = ["CustomerID", "CustomerName", "Phone", "Address", "City", "State", "Zip",
                    "Country", "Notes"]
PRODUCT_COLUMNS = ["CookieID", "CookieName", "RevenuePerCookie", "CostPerCookie"]
ORDER_COLUMNS = ["OrderID", "OrderDate", "OrderTotal", "CustomerID"]
DETAIL_COLUMNS = ["OrderID", "CookieID", "Quantity"]

# The key a table is laid out by, for the join of the two.
KEYS = {"orders": "OrderID", "order_details": "OrderID"}


@dataclass
class Normalized:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_details: DataFrame

    def named(self) -> dict[str, DataFrame]:
        return {"Customers": self.customers, "Products": self.products,
                "Orders": self.orders, "OrderDetails": self.order_details}


def order_lines(flat: DataFrame, partitions: int | None = None) -> DataFrame:
    """The columns of Orders and OrderDetails, laid out by OrderID.

    The partition count is fixed (by default the session's shuffle partitions), as two tables that
    join in place need the same one; size it to the shuffle volume."""
    n = partitions or int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = list(dict.fromkeys(ORDER_COLUMNS + DETAIL_COLUMNS))
    return flat.select(*columns).repartition(n, "OrderID")


def normalize(flat: DataFrame, lines: DataFrame | None = None) -> Normalized:
    """The four tables of ``flat``; ``lines``: its shared ``order_lines``."""
    lines = order_lines(flat) if lines is None else lines
    return Normalized(
        customers=flat.select(*CUSTOMER_COLUMNS).distinct(),
        products=flat.select(*PRODUCT_COLUMNS).distinct(),
        orders=lines.select(*ORDER_COLUMNS).distinct(),
        order_details=lines.select(*DETAIL_COLUMNS),
    )
