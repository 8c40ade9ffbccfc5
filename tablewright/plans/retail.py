"""The retail flat-file script of week 16: normalize, check, join, report.

The four normalized tables are built from the flat file once, those that a
report reads (see ``Model`` and ``operators.normalize``), then
every report reads them, as the reference's queries and views do.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import sum_decimal
from ..operators import normalize as N
from ..operators import quality as Q
from ..operators import relational as R
from ..sources import fixtures
from ..session import scratch_path
from .cache import cached

# Re-aimed parameters: the reference filters state 'WA', customer 5 and
# February 2022, and sketches yearly partitions from 2022; the test orders
# run from 1995 to 2001, so the month and year edges move into that range.
STATE = "WA"
CUSTOMER = 5
MONTH_START, MONTH_END = dt.date(2000, 2, 1), dt.date(2000, 3, 1)
YEAR_EDGES = (dt.date(1998, 1, 1), dt.date(1999, 1, 1), dt.date(2000, 1, 1))
PRUNE_YEAR = 1999


class Model:
    """The normalized tables of a folder, each built when it is first read and then shared.

    The flat file isn't stored: every table takes its own columns of it, so that the joins carry
    those alone. Orders and OrderDetails share their lines; OrderDetails is a projection of them,
    so it isn't stored a second time.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _flat(self, last: str) -> DataFrame:
        return fixtures.flat_file(self.spark, self.sf_dir, last)

    def _cached(self, name: str, build, bucket_by=None) -> DataFrame:
        return cached(self.spark, ("norm", name, self.sf_dir), build, bucket_by=bucket_by)

    def _of_lines(self) -> N.Normalized:
        flat = self._flat("orders")
        lines = self._cached("order_lines", lambda: N.order_lines(flat), bucket_by=["OrderID"])
        return N.normalize(flat, lines)

    @property
    def customers(self) -> DataFrame:
        return self._cached("customers", lambda: N.normalize(self._flat("customer")).customers)

    @property
    def products(self) -> DataFrame:
        return self._cached("products", lambda: N.normalize(self._flat("part")).products)

    @property
    def orders(self) -> DataFrame:
        return self._cached("orders", lambda: self._of_lines().orders, bucket_by=[N.KEYS["orders"]])

    @property
    def order_details(self) -> DataFrame:
        return self._of_lines().order_details

    named = N.Normalized.named


def model(spark: SparkSession, sf_dir: str) -> Model:
    return Model(spark, sf_dir)


# ---------------------------------------------------------------- reports

def pk_violations(m: N.Normalized) -> DataFrame:
    def one(name, df, keys):
        # A NULL part is shown as such: (NULL, 1) and (1) are different keys.
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
        return (Q.duplicate_keys(df, keys)
                .select(F.lit(name).alias("TableName"), key.alias("KeyValue"), "DuplicateRows"))
    parts = [one("Customers", m.customers, ["CustomerID"]),
             one("Products", m.products, ["CookieID"]),
             one("Orders", m.orders, ["OrderID"]),
             one("OrderDetails", m.order_details, ["OrderID", "CookieID"])]
    return reduce(DataFrame.unionAll, parts)


def damaged(m: N.Normalized) -> N.Normalized:
    """The tables with broken rules: some parents removed, some details without an order.

    A flat file split by DISTINCT can't break the rules by itself, so the checks run on this copy.
    """
    lost = (m.order_details.filter(F.col("OrderID") % 400 == 0)
            .withColumn("OrderID", F.lit(None).cast(m.order_details.schema["OrderID"].dataType)))
    return N.Normalized(
        customers=m.customers.filter(F.col("CustomerID") % 40 != 0),
        products=m.products.filter(F.col("CookieID") % 40 != 0),
        orders=m.orders.filter(F.col("OrderID") % 50 != 0),
        order_details=m.order_details.unionByName(lost).unionByName(lost))


def fk_orphans(m: N.Normalized) -> DataFrame:
    def one(name, child, parent, ck, pk):
        return (Q.orphans(child, parent, ck, pk)
                .select(F.lit(name).alias("TableName"), F.lit(ck).alias("ColumnName"),
                        F.col(ck).cast("string").alias("KeyValue")))
    parts = [one("Orders", m.orders, m.customers, "CustomerID", "CustomerID"),
             one("OrderDetails", m.order_details, m.orders, "OrderID", "OrderID"),
             one("OrderDetails", m.order_details, m.products, "CookieID", "CookieID")]
    return reduce(DataFrame.unionAll, parts)


# NOT NULL columns declared by the DDL.
NOT_NULL = {
    "Customers": ["CustomerID", "CustomerName"],
    "Products": ["CookieID", "CookieName", "RevenuePerCookie", "CostPerCookie"],
    "Orders": ["OrderID", "OrderDate", "OrderTotal", "CustomerID"],
    "OrderDetails": ["OrderID", "CookieID", "Quantity"],
}


def not_null_report(m: N.Normalized) -> DataFrame:
    named = m.named()
    return reduce(DataFrame.unionAll,
                  [Q.null_counts_long(named[t], t, cols) for t, cols in NOT_NULL.items()])


def order_breakdown(m: N.Normalized) -> DataFrame:
    # Customers are joined to the orders, which are fewer than their details; those are laid out by
    # OrderID already and join in place.
    o, od = m.orders.alias("O"), m.order_details.alias("OD")
    c, p = m.customers.alias("C"), m.products.alias("P")
    return (o.join(c, F.col("O.CustomerID") == F.col("C.CustomerID"))
            .join(od, F.col("O.OrderID") == F.col("OD.OrderID"))
            .join(p, F.col("OD.CookieID") == F.col("P.CookieID"))
            .select("O.OrderID", "O.OrderDate", "C.CustomerName", "P.CookieName",
                    "OD.Quantity", "P.RevenuePerCookie", "P.CostPerCookie", "O.OrderTotal")
            .orderBy(F.col("OrderID"), F.col("CookieName")))


def product_sales(m: N.Normalized) -> DataFrame:
    """Products with the quantity sold of each: details are summed by product before the join, so a
    product that holds a large part of them is one small row per task."""
    sold = m.order_details.groupBy(F.col("CookieID").alias("_id")).agg(F.sum("Quantity").alias("Sold"))
    return m.products.join(sold, F.col("CookieID") == F.col("_id"))


def profit_by_product(m: N.Normalized) -> DataFrame:
    q, r, c = F.col("Sold"), F.col("RevenuePerCookie"), F.col("CostPerCookie")
    return (product_sales(m).groupBy("CookieName")
            .agg(F.sum(q).alias("TotalQuantitySold"),
                 sum_decimal(q * r).alias("TotalRevenue"),
                 sum_decimal(q * c).alias("TotalCost"),
                 sum_decimal(q * (r - c)).alias("EstimatedProfit")))


def year_partition(date_col: str, edges) -> F.Column:
    """RANGE RIGHT partition number: edge values belong to the right side, NULL to 1."""
    d = F.col(date_col)
    expr = F.when(d.isNull(), F.lit(1))
    for i, edge in enumerate(edges, start=1):
        expr = expr.when(d < F.lit(edge), F.lit(i))
    return expr.otherwise(F.lit(len(edges) + 1))


def orders_pruned(spark: SparkSession, m: N.Normalized) -> DataFrame:
    """Orders written partitioned by year, then read back for one year.

    The year filter becomes a partition filter: only that folder is read.
    """
    path = scratch_path(spark, "orders_by_year")
    (m.orders.withColumn("OrderYear", F.year("OrderDate"))
     .write.mode("overwrite").partitionBy("OrderYear").parquet(path))
    return (spark.read.parquet(path).filter(F.col("OrderYear") == PRUNE_YEAR)
            .select(*N.ORDER_COLUMNS))


def revenue_by_customer(m: N.Normalized) -> DataFrame:
    bought = (m.orders.groupBy(F.col("CustomerID").alias("_id"))
              .agg(F.count("OrderID").alias("n"), F.sum("OrderTotal").alias("total")))
    return (m.customers.join(bought, F.col("CustomerID") == F.col("_id"))
            .groupBy("CustomerName")
            .agg(F.sum("n").alias("TotalOrders"), sum_decimal("total").alias("TotalRevenue")))


def quantity_by_product(m: N.Normalized) -> DataFrame:
    return product_sales(m).groupBy("CookieName").agg(F.sum("Sold").alias("TotalQuantitySold"))


def monthly_revenue(m: N.Normalized) -> DataFrame:
    return (m.orders.groupBy(F.year("OrderDate").alias("OrderYear"),
                             F.month("OrderDate").alias("OrderMonth"))
            .agg(sum_decimal("OrderTotal").alias("MonthlyRevenue")))


# The reporting views: (view name, definition, order used when reading it).
VIEWS = {
    "revenue_by_customer": ("vw_TotalRevenueByCustomer", revenue_by_customer,
                            [("TotalRevenue", True)]),
    "quantity_by_product": ("vw_TotalQuantitySoldByProduct", quantity_by_product,
                            [("TotalQuantitySold", True)]),
    "monthly_revenue": ("vw_MonthlyRevenueTrend", monthly_revenue,
                        [("OrderYear", False), ("OrderMonth", False)]),
    "profit_by_product": ("vw_EstimatedProfitByProduct", lambda m: profit_by_product(m),
                          [("EstimatedProfit", True)]),
}


def read_view(key: str):
    name, definition, order = VIEWS[key]
    return lambda s, m: R.view(definition(m), name).orderBy(
        *[F.desc(c) if d else F.asc(c) for c, d in order])


REPORTS = {
    "norm_customers": lambda s, m: m.customers,
    "norm_products": lambda s, m: m.products,
    "norm_orders": lambda s, m: m.orders,
    "norm_order_details": lambda s, m: m.order_details,
    "norm_row_counts": lambda s, m: Q.row_counts(m.named()),
    "norm_pk_violations": lambda s, m: pk_violations(m),
    "norm_fk_orphans": lambda s, m: fk_orphans(m),
    "norm_pk_violations_damaged": lambda s, m: pk_violations(damaged(m)),
    "norm_fk_orphans_damaged": lambda s, m: fk_orphans(damaged(m)),
    "norm_notnull_check": lambda s, m: not_null_report(m),
    "cust_in_state": lambda s, m: m.customers.filter(F.col("State") == STATE).select(
        "CustomerID", "CustomerName", "Phone", "City", "State", "Country"),
    "orders_of_customer": lambda s, m: m.orders.filter(F.col("CustomerID") == CUSTOMER)
    .select(*N.ORDER_COLUMNS).orderBy("OrderDate"),
    "orders_with_customer": lambda s, m: (
        m.orders.alias("O").join(m.customers.alias("C"),
                                 F.col("O.CustomerID") == F.col("C.CustomerID"))
        .select("O.OrderID", "O.OrderDate", "C.CustomerName", "C.Phone", "O.OrderTotal")
        .orderBy("OrderDate")),
    "order_breakdown": lambda s, m: order_breakdown(m),
    "revenue_by_customer": read_view("revenue_by_customer"),
    "quantity_by_product": read_view("quantity_by_product"),
    "profit_by_product": read_view("profit_by_product"),
    "orders_in_february": lambda s, m: (
        m.orders.filter((F.col("OrderDate") >= F.lit(MONTH_START))
                        & (F.col("OrderDate") < F.lit(MONTH_END)))
        .select(*N.ORDER_COLUMNS).orderBy("OrderDate")),
    "monthly_revenue": read_view("monthly_revenue"),
    "order_year_partition": lambda s, m: m.orders.select(
        "OrderID", "OrderDate", year_partition("OrderDate", YEAR_EDGES).alias("PartitionNumber")),
    "orders_year_pruned": lambda s, m: orders_pruned(s, m),
}


# --------------------------------------------------------------- the oracle

ORACLE_CTES = f"""
n_customers AS (SELECT DISTINCT {', '.join(N.CUSTOMER_COLUMNS)} FROM flat_file),
n_products AS (SELECT DISTINCT {', '.join(N.PRODUCT_COLUMNS)} FROM flat_file),
n_orders AS (SELECT DISTINCT {', '.join(N.ORDER_COLUMNS)} FROM flat_file),
n_details AS (SELECT {', '.join(N.DETAIL_COLUMNS)} FROM flat_file),
x_customers AS (SELECT * FROM n_customers WHERE CustomerID % 40 <> 0),
x_products AS (SELECT * FROM n_products WHERE CookieID % 40 <> 0),
x_orders AS (SELECT * FROM n_orders WHERE OrderID % 50 <> 0),
x_lost AS (SELECT NULL AS OrderID, CookieID, Quantity FROM n_details WHERE OrderID % 400 = 0),
x_details AS (SELECT * FROM n_details UNION ALL SELECT * FROM x_lost UNION ALL SELECT * FROM x_lost)"""

_E1, _E2, _E3 = (e.isoformat() for e in YEAR_EDGES)


def _nn(table: str, cte: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS TableName, '{c}' AS ColumnName, "
        f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS NullRows FROM {cte}"
        for c in NOT_NULL[table])


def _key(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), 'NULL')"


# The checks on the damaged tables; with n_ for x_, on the tables as they are.
PK_SQL = (
        f"SELECT 'Customers' AS TableName, {_key('CustomerID')} AS KeyValue, "
        "COUNT(*) AS DuplicateRows FROM x_customers GROUP BY CustomerID HAVING COUNT(*) > 1 "
        f"UNION ALL SELECT 'Products', {_key('CookieID')}, COUNT(*) FROM x_products "
        "GROUP BY CookieID HAVING COUNT(*) > 1 "
        f"UNION ALL SELECT 'Orders', {_key('OrderID')}, COUNT(*) FROM x_orders "
        "GROUP BY OrderID HAVING COUNT(*) > 1 "
        f"UNION ALL SELECT 'OrderDetails', {_key('OrderID')} || '|' || "
        f"{_key('CookieID')}, COUNT(*) FROM x_details GROUP BY OrderID, CookieID "
        "HAVING COUNT(*) > 1")
FK_SQL = (
        "SELECT 'Orders' AS TableName, 'CustomerID' AS ColumnName, "
        "CAST(CustomerID AS VARCHAR) AS KeyValue FROM x_orders o WHERE CustomerID IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM x_customers c WHERE c.CustomerID = o.CustomerID) "
        "UNION ALL SELECT 'OrderDetails', 'OrderID', CAST(OrderID AS VARCHAR) FROM x_details d "
        "WHERE OrderID IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM x_orders o WHERE o.OrderID = d.OrderID) "
        "UNION ALL SELECT 'OrderDetails', 'CookieID', CAST(CookieID AS VARCHAR) FROM x_details d "
        "WHERE CookieID IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM x_products p WHERE p.CookieID = d.CookieID)")

ORACLE = {
    "norm_customers": "SELECT * FROM n_customers",
    "norm_products": "SELECT * FROM n_products",
    "norm_orders": "SELECT * FROM n_orders",
    "norm_order_details": "SELECT * FROM n_details",
    "norm_row_counts": "SELECT 'Customers' AS TableName, COUNT(*) AS TotalRows FROM n_customers "
                       "UNION ALL SELECT 'Products', COUNT(*) FROM n_products "
                       "UNION ALL SELECT 'Orders', COUNT(*) FROM n_orders "
                       "UNION ALL SELECT 'OrderDetails', COUNT(*) FROM n_details",
    "norm_pk_violations": PK_SQL.replace("x_", "n_"),
    "norm_fk_orphans": FK_SQL.replace("x_", "n_"),
    "norm_pk_violations_damaged": PK_SQL,
    "norm_fk_orphans_damaged": FK_SQL,
    "norm_notnull_check": " UNION ALL ".join([
        _nn("Customers", "n_customers"), _nn("Products", "n_products"),
        _nn("Orders", "n_orders"), _nn("OrderDetails", "n_details")]),
    "cust_in_state": "SELECT CustomerID, CustomerName, Phone, City, State, Country "
                     f"FROM n_customers WHERE State = '{STATE}'",
    "orders_of_customer": "SELECT OrderID, OrderDate, OrderTotal, CustomerID FROM n_orders "
                          f"WHERE CustomerID = {CUSTOMER} ORDER BY OrderDate",
    "orders_with_customer": "SELECT O.OrderID, O.OrderDate, C.CustomerName, C.Phone, "
                            "O.OrderTotal FROM n_orders O INNER JOIN n_customers C "
                            "ON O.CustomerID = C.CustomerID ORDER BY O.OrderDate",
    "order_breakdown": "SELECT O.OrderID, O.OrderDate, C.CustomerName, P.CookieName, "
                       "OD.Quantity, P.RevenuePerCookie, P.CostPerCookie, O.OrderTotal "
                       "FROM n_orders O JOIN n_customers C ON O.CustomerID = C.CustomerID "
                       "JOIN n_details OD ON O.OrderID = OD.OrderID "
                       "JOIN n_products P ON OD.CookieID = P.CookieID "
                       "ORDER BY O.OrderID, P.CookieName",
    "revenue_by_customer": "SELECT C.CustomerName, COUNT(O.OrderID) AS TotalOrders, "
                           "SUM(O.OrderTotal) AS TotalRevenue FROM n_customers C "
                           "JOIN n_orders O ON C.CustomerID = O.CustomerID "
                           "GROUP BY C.CustomerName ORDER BY TotalRevenue DESC",
    "quantity_by_product": "SELECT P.CookieName, CAST(SUM(OD.Quantity) AS BIGINT) "
                           "AS TotalQuantitySold FROM n_products P JOIN n_details OD "
                           "ON P.CookieID = OD.CookieID GROUP BY P.CookieName "
                           "ORDER BY TotalQuantitySold DESC",
    "profit_by_product": "SELECT P.CookieName, CAST(SUM(OD.Quantity) AS BIGINT) "
                         "AS TotalQuantitySold, SUM(OD.Quantity * P.RevenuePerCookie) "
                         "AS TotalRevenue, SUM(OD.Quantity * P.CostPerCookie) AS TotalCost, "
                         "SUM(OD.Quantity * (P.RevenuePerCookie - P.CostPerCookie)) "
                         "AS EstimatedProfit FROM n_products P JOIN n_details OD "
                         "ON P.CookieID = OD.CookieID GROUP BY P.CookieName "
                         "ORDER BY EstimatedProfit DESC",
    "orders_in_february": "SELECT OrderID, OrderDate, OrderTotal, CustomerID FROM n_orders "
                          f"WHERE OrderDate >= DATE '{MONTH_START.isoformat()}' "
                          f"AND OrderDate < DATE '{MONTH_END.isoformat()}' ORDER BY OrderDate",
    "monthly_revenue": "SELECT CAST(year(OrderDate) AS INTEGER) AS OrderYear, "
                       "CAST(month(OrderDate) AS INTEGER) AS OrderMonth, "
                       "SUM(OrderTotal) AS MonthlyRevenue FROM n_orders "
                       "GROUP BY year(OrderDate), month(OrderDate) ORDER BY 1, 2",
    "order_year_partition": "SELECT OrderID, OrderDate, CASE WHEN OrderDate IS NULL THEN 1 "
                            f"WHEN OrderDate < DATE '{_E1}' THEN 1 "
                            f"WHEN OrderDate < DATE '{_E2}' THEN 2 "
                            f"WHEN OrderDate < DATE '{_E3}' THEN 3 ELSE 4 END "
                            "AS PartitionNumber FROM n_orders",
    "orders_year_pruned": "SELECT OrderID, OrderDate, OrderTotal, CustomerID FROM n_orders "
                          f"WHERE year(OrderDate) = {PRUNE_YEAR}",
}


def oracle_sql(key: str) -> str:
    return fixtures.duckdb_with(["flat_file"], ORACLE[key], extra=ORACLE_CTES)


def queries():
    return {key: ((lambda f: lambda s, d: f(s, model(s, d)))(fn), oracle_sql(key))
            for key, fn in REPORTS.items()}
